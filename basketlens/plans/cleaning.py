"""Queries for casting, filtering, cleaning and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.functions.dates import date_prefix, parse_timestamp
from basketlens.functions.labels import income_score
from basketlens.functions.numeric import round_half_up
from basketlens.operators import cleaning as c
from basketlens.operators.numbering import number_rows
from basketlens.plans.registry import query
from basketlens.plans.tables import (
    ROW_KEY,
    SCORED_INCOME,
    TYPED_SQL,
    clean_table,
    over_clean,
    over_profile,
    over_retail,
    round_sql,
    stored_retail,
)
from basketlens.schema import TYPED_SCHEMA, apply_schema, drop_if_present
from basketlens.sources.adapter import retail

@query("typed_schema", over_retail(TYPED_SQL))
def typed_schema(spark, sf_dir):
    return apply_schema(retail(spark, sf_dir))


@query("drop_columns", over_retail(
    "SELECT * EXCLUDE (Email, Name, Zipcode, Address, Phone, City, State, Order_Status, Time, "
    "Date, Amount, Total_Amount) FROM retail"
))
def drop_columns(spark, sf_dir):
    return drop_if_present(retail(spark, sf_dir), c.DROPPED_COLUMNS)


@query("parse_dates", over_retail("""
SELECT Transaction_ID, Total_Amount, try_cast(t AS timestamp) AS parsed FROM (
  SELECT *, CASE WHEN Transaction_ID % 3 = 0 THEN 'no date' ELSE Time END AS t FROM retail) x"""))
def parse_dates(spark, sf_dir):
    text = F.when(F.col("Transaction_ID") % 3 == 0, "no date").otherwise(F.col("Time"))
    return retail(spark, sf_dir).select(
        *ROW_KEY, parse_timestamp(text).cast("timestamp_ntz").alias("parsed")
    )


@query("date_from_time", over_retail(
    "SELECT Transaction_ID, Total_Amount, try_cast(substring(Time, 1, 10) AS date) AS Date FROM retail"
))
def date_from_time(spark, sf_dir):
    return retail(spark, sf_dir).select(*ROW_KEY, date_prefix(F.col("Time")).alias("Date"))


@query("month_from_date", over_retail(
    "SELECT Transaction_ID, Total_Amount, cast(month(Date) AS int) AS Month FROM retail"
))
def month_from_date(spark, sf_dir):
    return retail(spark, sf_dir).select(*ROW_KEY, F.month("Date").alias("Month"))


@query("drop_null_subset", over_retail("""
SELECT Transaction_ID, Total_Amount, Customer_ID, Age, Month, Date FROM retail
WHERE Month IS NOT NULL AND Date IS NOT NULL AND Customer_ID IS NOT NULL AND Age IS NOT NULL"""))
def drop_null_subset(spark, sf_dir):
    columns = [*ROW_KEY, "Customer_ID", "Age", "Month", "Date"]
    return c.drop_unattributed(c.drop_undated(retail(spark, sf_dir).select(*columns)))


@query("drop_null_any", over_retail(
    "SELECT * FROM retail WHERE " + " AND ".join(f"{n} IS NOT NULL" for n in TYPED_SCHEMA.names)
))
def drop_null_any(spark, sf_dir):
    return retail(spark, sf_dir).dropna("any")


@query("negative_count", over_retail(
    "SELECT count(*) FILTER (WHERE Amount < 0) AS negative_count FROM retail"
))
def negative_count(spark, sf_dir):
    return c.count_negative(retail(spark, sf_dir))


@query("fill_year_month", over_retail("""
SELECT Transaction_ID, Total_Amount, cast(coalesce(Year, year(Date)) AS int) AS Year,
  cast(coalesce(Month, month(Date)) AS int) AS Month FROM retail"""))
def fill_year_month(spark, sf_dir):
    return c.fill_year_month(retail(spark, sf_dir)).select(*ROW_KEY, "Year", "Month")


@query("fill_year_month_from_time", over_retail("""
SELECT Transaction_ID, Total_Amount, cast(substring(Time, 1, 10) AS date) AS Date,
  cast(coalesce(Year, year(cast(substring(Time, 1, 10) AS date))) AS int) AS Year,
  cast(coalesce(Month, month(cast(substring(Time, 1, 10) AS date))) AS int) AS Month FROM retail"""))
def fill_year_month_from_time(spark, sf_dir):
    filled = c.fill_year_month(retail(spark, sf_dir), source="time")
    return filled.select(*ROW_KEY, "Date", "Year", "Month")


@query("derive_quantity", over_retail(f"""
SELECT Transaction_ID, Total_Amount, coalesce(Total_Purchases,
  CASE WHEN Amount <> 0 THEN {round_sql("Total_Amount / Amount", 0)} END) AS Total_Purchases
FROM retail"""))
def derive_quantity(spark, sf_dir):
    return c.derive_quantity(retail(spark, sf_dir)).select(*ROW_KEY, "Total_Purchases")


@query("dense_ids", over_retail("""
SELECT row_number() OVER (ORDER BY Transaction_ID, Total_Amount) AS position, Transaction_ID,
  Total_Amount FROM retail"""))
def dense_ids(spark, sf_dir):
    return number_rows(stored_retail(spark, sf_dir, *ROW_KEY), ROW_KEY)


@query("rename_transaction_id", over_retail("""
SELECT Transaction_ID AS Old_Transaction_ID, Total_Amount,
  row_number() OVER (ORDER BY Transaction_ID, Total_Amount) AS Transaction_ID FROM retail"""))
def rename_transaction_id(spark, sf_dir):
    return c.renumber(stored_retail(spark, sf_dir, *ROW_KEY), ROW_KEY)


@query("fill_defaults", over_retail("""
SELECT Transaction_ID, Total_Amount, coalesce(Product_Category, 'Other') AS Product_Category,
  coalesce(Product_Brand, 'Other') AS Product_Brand, coalesce(Feedback, 'Average') AS Feedback,
  coalesce(Shipping_Method, 'Standard') AS Shipping_Method,
  coalesce(Payment_Method, 'Credit Card') AS Payment_Method, coalesce(Ratings, 3.0) AS Ratings
FROM retail"""))
def fill_defaults(spark, sf_dir):
    return c.fill_defaults(retail(spark, sf_dir)).select(*ROW_KEY, *c.FILL_DEFAULTS)


def _profile(spark, sf_dir):
    dated = c.drop_undated(c.fill_year_month(retail(spark, sf_dir)))
    return c.customer_profile(c.drop_unattributed(dated))


@query("customer_profile", over_profile("SELECT * FROM profile"))
def customer_profile(spark, sf_dir):
    return _profile(spark, sf_dir)


@query("mode_or_default", over_profile(
    "SELECT Customer_ID, Country, Gender, Customer_Segment FROM profile"
))
def mode_or_default(spark, sf_dir):
    return _profile(spark, sf_dir).select("Customer_ID", *c.CUSTOMER_DEFAULTS)


@query("age_mode_or_mean", over_profile("SELECT Customer_ID, Age FROM profile"))
def age_mode_or_mean(spark, sf_dir):
    return _profile(spark, sf_dir).select("Customer_ID", "Age")


@query("income_score", over_retail(f"""
SELECT Customer_ID, {round_sql(f"avg({SCORED_INCOME})", 1)} AS Income FROM retail
WHERE Customer_ID IS NOT NULL GROUP BY Customer_ID"""))
def income_score_by_customer(spark, sf_dir):
    scored = retail(spark, sf_dir).where("Customer_ID IS NOT NULL")
    mean = F.avg(income_score(F.col("Income")))
    return scored.groupBy("Customer_ID").agg(round_half_up(mean, 1).alias("Income"))


@query("clean_transactions", over_clean("SELECT * FROM clean"))
def clean_transactions(spark, sf_dir):
    return clean_table(spark, sf_dir, sort=True)


@query("clean_step_counts", over_retail("""
, flags AS (SELECT coalesce(Month, month(Date)) IS NOT NULL AND Date IS NOT NULL AS dated,
  Customer_ID IS NOT NULL AND Age IS NOT NULL AS owned FROM retail),
counts AS (SELECT count(*) AS a, count(*) FILTER (WHERE dated) AS b,
  count(*) FILTER (WHERE dated AND owned) AS c FROM flags)
SELECT 1 AS step_no, 'initial' AS step, a AS row_count FROM counts
UNION ALL SELECT 2, 'dates_processed', a FROM counts
UNION ALL SELECT 3, 'undated_dropped', b FROM counts
UNION ALL SELECT 4, 'quantity_derived', b FROM counts
UNION ALL SELECT 5, 'unattributed_dropped', c FROM counts
UNION ALL SELECT 6, 'final', c FROM counts"""))
def clean_step_counts(spark, sf_dir):
    return c.clean_step_counts(retail(spark, sf_dir), ROW_KEY)  # read once: what is read again is stored there


@query("dedupe_rows", over_retail("""
SELECT DISTINCT * FROM (SELECT * FROM retail UNION ALL SELECT * FROM retail WHERE Transaction_ID % 3 = 0) d"""))
def dedupe_rows(spark, sf_dir):
    # The joins behind the rows run once: those that come twice are copied, not read again.
    times = F.when(F.col("Transaction_ID") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return retail(spark, sf_dir).withColumn("copy", F.explode(times)).drop("copy").dropDuplicates()


@query("fill_year_month_from_either", over_retail("""
SELECT Transaction_ID, Total_Amount, cast(coalesce(Year, year(d)) AS int) AS Year,
  cast(coalesce(Month, month(d)) AS int) AS Month
FROM (SELECT *, coalesce(Date, try_cast(substring(Time, 1, 10) AS timestamp)) AS d FROM retail) e"""))
def fill_year_month_from_either(spark, sf_dir):
    return c.fill_year_month(retail(spark, sf_dir), "either").select(*ROW_KEY, "Year", "Month")


@query("clean_strict", over_retail(
    "SELECT DISTINCT * EXCLUDE (Email, Phone, Address) REPLACE (cast(month(Date) AS int) AS Month) "
    "FROM retail WHERE " + " AND ".join(f"{n} IS NOT NULL" for n in TYPED_SCHEMA.names)
))
def clean_strict(spark, sf_dir):
    return c.clean_strict(retail(spark, sf_dir))
