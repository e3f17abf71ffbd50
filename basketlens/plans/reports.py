"""Queries for reports, cross-tabs and pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.functions.labels import MONTH_NAMES
from basketlens.operators import reports as r
from basketlens.operators.crosstab import Spec, crosstab, crosstab_many, key_column, pivot_wide
from basketlens.plans.registry import query
from basketlens.plans.tables import (
    over_retail,
    round_sql,
    rounded,
    rounded_avg_sql,
    rounded_sum_sql,
    stored_retail,
)
from basketlens.sources.adapter import retail

TOTAL = rounded_sum_sql("Total_Amount", 2)
MONTH = "coalesce(cast(Month AS int), 0)"
AGE_GROUP = (
    "concat_ws('-', cast(floor(Age / 10) * 10 AS int), cast(floor(Age / 10) * 10 + 9 AS int))"
)


@query("avg_amount_by_category", over_retail(
    f"SELECT Product_Category, {rounded_avg_sql('Amount', 6)} AS Avg_Amount FROM retail GROUP BY 1"
))
def avg_amount_by_category(spark, sf_dir):
    averages = r.average_by(retail(spark, sf_dir), "Product_Category", "Amount", "Avg_Amount")
    return rounded(averages, 6, "Avg_Amount")


@query("customer_spending", over_retail(
    f"SELECT Customer_ID, {TOTAL} AS Total_Spending FROM retail GROUP BY 1"
))
def customer_spending(spark, sf_dir):
    return r.customer_spending(retail(spark, sf_dir))


@query("top_customers", over_retail(
    f"SELECT Customer_ID, {TOTAL} AS Total_Spending FROM retail GROUP BY 1 "
    "ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 10"
))
def top_customers(spark, sf_dir):
    return r.top_customers(retail(spark, sf_dir))


@query("spend_tiers", over_retail(f"""
SELECT CASE WHEN s > 5000 THEN 'VIP' WHEN s > 1000 THEN 'Regular' ELSE 'Low Spender' END AS Segment,
  count(*) AS count
FROM (SELECT Customer_ID, {TOTAL} AS s FROM retail GROUP BY 1) t GROUP BY 1"""))
def spend_tiers(spark, sf_dir):
    return r.spend_tiers(retail(spark, sf_dir))


@query("monthly_sales", over_retail(
    f"SELECT cast(month(Date) AS int) AS Month, {TOTAL} AS Total_Sales FROM retail GROUP BY 1 ORDER BY 1"
))
def monthly_sales(spark, sf_dir):
    return r.monthly_sales(retail(spark, sf_dir))


@query("sales_by_category", over_retail(
    f"SELECT Product_Category, {TOTAL} AS Total_Sales FROM retail GROUP BY 1"
))
def sales_by_category(spark, sf_dir):
    totals = r.total_by(retail(spark, sf_dir), "Product_Category", "Total_Amount", "Total_Sales")
    return rounded(totals, 2, "Total_Sales")


@query("tx_by_payment", over_retail(
    "SELECT Payment_Method, count(Transaction_ID) AS Total_Transactions FROM retail GROUP BY 1"
))
def tx_by_payment(spark, sf_dir):
    return r.count_by(
        retail(spark, sf_dir), "Payment_Method", "Transaction_ID", "Total_Transactions"
    )


@query("payment_avg_amount", over_retail(
    f"SELECT Payment_Method, {rounded_avg_sql('Amount', 2)} AS Avg_Amount, "
    "count(Transaction_ID) AS Transaction_Count FROM retail GROUP BY 1"
))
def payment_avg_amount(spark, sf_dir):
    return r.average_and_count_by(retail(spark, sf_dir), "Payment_Method")


@query("segment_sales", over_retail(
    f"SELECT Customer_Segment, {TOTAL} AS Total_Sales, count(Transaction_ID) AS Transaction_Count "
    "FROM retail GROUP BY 1"
))
def segment_sales(spark, sf_dir):
    return r.sales_and_count_by(retail(spark, sf_dir), "Customer_Segment")


@query("top_category_share", over_retail(f"""
SELECT Product_Category, count(*) AS count,
  {round_sql("count(*) * 100.0 / (SELECT cast(count(*) AS double) FROM retail)", 4)} AS percentage
FROM retail WHERE Product_Category IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def top_category_share(spark, sf_dir):
    return r.top_share(stored_retail(spark, sf_dir, "Product_Category"), "Product_Category")


MONTHS = f"""
, months AS (SELECT cast(month(Date) AS int) AS Month, fsum(Amount) AS sales,
  count(*) AS transactions FROM retail WHERE Date IS NOT NULL GROUP BY 1)"""


@query("monthly_trend", over_retail(
    f"{MONTHS} SELECT Month, round(sales, 4) AS sales, transactions, "
    "round(sales / transactions, 4) AS average_sale FROM months"
))
def monthly_trend(spark, sf_dir):
    return rounded(r.monthly_trend(retail(spark, sf_dir)), 4, "sales", "average_sale")


@query("monthly_moving_avg", over_retail(f"""{MONTHS}
SELECT Month, round(sales, 4) AS sales, {round_sql('''CASE WHEN count(sales) OVER w = 2 THEN avg(sales) OVER w END''', 4)} AS moving_average
FROM months WINDOW w AS (ORDER BY Month ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)"""))
def monthly_moving_avg(spark, sf_dir):
    return rounded(r.monthly_moving_average(retail(spark, sf_dir)), 4, "sales")


NAMES = "[" + ", ".join(f"'{m}'" for m in MONTH_NAMES) + "]"


@query("trend_facts", over_retail(f"""{MONTHS},
named AS (SELECT *, {NAMES}[Month] AS name FROM months),
best AS (SELECT *, row_number() OVER (ORDER BY sales DESC, Month) AS rn FROM named),
worst AS (SELECT *, row_number() OVER (ORDER BY sales, Month) AS rn FROM named)
SELECT (SELECT {round_sql("(arg_max(sales, Month) - arg_min(sales, Month)) * 100 / arg_min(sales, Month)", 4)} FROM months) AS growth_rate,
  (SELECT string_agg(name, ', ' ORDER BY rn) FROM best WHERE rn <= 3) AS peak_season,
  (SELECT string_agg(name, ', ' ORDER BY rn) FROM worst WHERE rn <= 3) AS slow_season,
  (SELECT name FROM best WHERE rn = 1) AS highest_month,
  (SELECT round(sales, 4) FROM best WHERE rn = 1) AS highest_sales,
  (SELECT name FROM worst WHERE rn = 1) AS lowest_month,
  (SELECT round(sales, 4) FROM worst WHERE rn = 1) AS lowest_sales"""))
def trend_facts(spark, sf_dir):
    return rounded(r.trend_facts(retail(spark, sf_dir)), 4, "highest_sales", "lowest_sales")


BOTH = "Product_Category IS NOT NULL AND Product_Brand IS NOT NULL"


@query("category_brand", over_retail(
    "SELECT Product_Category, Product_Brand, sum(Total_Purchases) AS Total_Purchases FROM retail "
    f"WHERE {BOTH} GROUP BY 1, 2"
))
def category_brand(spark, sf_dir):
    return r.category_brand(retail(spark, sf_dir))


@query("category_brand_rollup", over_retail(f"""
SELECT Product_Category, Product_Brand,
  cast(2 - grouping(Product_Category) - grouping(Product_Brand) AS int) AS level,
  sum(Total_Purchases) AS Total_Purchases
FROM retail WHERE {BOTH} GROUP BY ROLLUP (Product_Category, Product_Brand)"""))
def category_brand_rollup(spark, sf_dir):
    return r.category_brand_rollup(retail(spark, sf_dir))


# The two-way tables of the report.
SPECS = [
    Spec("Country", "Product_Category", "Total_Purchases", "sum"),
    Spec("Country", "Product_Category", "Total_Purchases", "avg"),
    Spec("Age", "Gender", "Total_Purchases", "avg"),
    Spec("Customer_Segment", "Shipping_Method", "Customer_ID", "count"),
    Spec("Customer_Segment", "Payment_Method", "Customer_ID", "count"),
    Spec("Gender", "Product_Category", "Total_Purchases", "sum"),
    Spec("Gender", "Product_Category", "Customer_ID", "count"),
    Spec("Year", "Month", "Total_Purchases", "sum"),
    Spec("Month", "Product_Brand", "Total_Purchases", "sum"),
    Spec("Month", "Product_Category", "Total_Purchases", "sum"),
    Spec("Payment_Method", "Feedback", "Customer_ID", "count"),
    Spec("Shipping_Method", "Feedback", "Customer_ID", "count"),
    Spec("Country", "Payment_Method", "Customer_ID", "count"),
    Spec("Country", "Shipping_Method", "Customer_ID", "count"),
    Spec("Country", "Customer_Segment", "Total_Purchases", "sum"),
    Spec("Product_Brand", "Product_Category", "Total_Purchases", "sum"),
    Spec("Product_Type", "Product_Category", "Total_Purchases", "sum"),
    Spec("Age", "Customer_Segment", "Customer_ID", "count"),
    Spec("Product_Category", "Feedback", "Total_Purchases", "avg"),
    Spec("Product_Brand", "Feedback", "Total_Purchases", "avg"),
]


def _key_sql(name: str) -> str:
    return MONTH if name == "Month" else name


def _register_crosstab(spec: Spec) -> None:
    sql = over_retail(
        f"SELECT {_key_sql(spec.f1)} AS {spec.f1}, {_key_sql(spec.f2)} AS {spec.f2}, "
        f"{spec.op}({spec.metric}) AS value FROM retail GROUP BY 1, 2"
    )

    @query(f"xt_{spec.short_name}", sql)
    def build(spark, sf_dir):
        return crosstab(retail(spark, sf_dir), spec)


for _spec in SPECS:
    _register_crosstab(_spec)


@query("crosstab_many", over_retail(" UNION ALL ".join(
    f"SELECT '{s.short_name}' AS spec, cast({_key_sql(s.f1)} AS varchar) AS f1, "
    f"cast({_key_sql(s.f2)} AS varchar) AS f2, cast({s.op}({s.metric}) AS double) AS value "
    f"FROM retail GROUP BY {_key_sql(s.f1)}, {_key_sql(s.f2)}" for s in SPECS
)))
def all_crosstabs(spark, sf_dir):
    return crosstab_many(retail(spark, sf_dir), SPECS)


TOP_BRANDS = """SELECT Product_Brand, sum(Total_Purchases) AS Total_Sales FROM retail
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
BOTTOM_BRANDS = """SELECT Product_Brand, sum(Total_Purchases) AS Total_Sales FROM retail
  WHERE Product_Brand IS NOT NULL GROUP BY 1 ORDER BY 2, 1 LIMIT 5"""
CHOSEN_BRANDS = f", tops AS ({TOP_BRANDS}), bottoms AS ({BOTTOM_BRANDS})"


@query("top_brands", over_retail(TOP_BRANDS))
def top_brands(spark, sf_dir):
    return r.top_brands(retail(spark, sf_dir))


@query("bottom_brands", over_retail(BOTTOM_BRANDS))
def bottom_brands(spark, sf_dir):
    return r.bottom_brands(retail(spark, sf_dir))


@query("brand_membership", over_retail(f"""{CHOSEN_BRANDS}
SELECT Transaction_ID, Total_Amount, Product_Brand FROM retail
WHERE Product_Brand IN (SELECT Product_Brand FROM tops UNION ALL SELECT Product_Brand FROM bottoms)"""))
def brand_membership(spark, sf_dir):
    columns = ["Transaction_ID", "Total_Amount", "Product_Brand", "Total_Purchases"]
    rows = r.brand_members(stored_retail(spark, sf_dir, *columns))
    return rows.select("Transaction_ID", "Total_Amount", "Product_Brand")


@query("brand_monthly_trend", over_retail(f"""{CHOSEN_BRANDS}
SELECT {MONTH} AS Month_Index, Product_Brand, sum(Total_Purchases) AS Total_Purchases,
  Product_Brand IN (SELECT Product_Brand FROM tops WHERE Product_Brand IS NOT NULL) AS is_top,
  Product_Brand IN (SELECT Product_Brand FROM bottoms) AS is_bottom
FROM retail
WHERE Product_Brand IN (SELECT Product_Brand FROM tops UNION ALL SELECT Product_Brand FROM bottoms)
GROUP BY 1, 2"""))
def brand_monthly_trend(spark, sf_dir):
    rows = stored_retail(spark, sf_dir, "Month", "Product_Brand", "Total_Purchases")
    return r.brand_monthly_trend(rows)


@query("age_group", over_retail(
    f"SELECT Transaction_ID, Total_Amount, Age, {AGE_GROUP} AS Age_Group FROM retail"
))
def age_group(spark, sf_dir):
    rows = r.with_age_group(retail(spark, sf_dir))
    return rows.select("Transaction_ID", "Total_Amount", "Age", "Age_Group")


@query("age_gender_sum", over_retail(
    f"SELECT {AGE_GROUP} AS Age_Group, Gender, sum(Total_Purchases) AS Total_Purchases FROM retail GROUP BY 1, 2"
))
def age_gender_sum(spark, sf_dir):
    return r.age_gender(retail(spark, sf_dir), "sum")


@query("age_gender_avg", over_retail(
    f"SELECT {AGE_GROUP} AS Age_Group, Gender, avg(Total_Purchases) AS Avg_Purchases FROM retail GROUP BY 1, 2"
))
def age_gender_avg(spark, sf_dir):
    return r.age_gender(retail(spark, sf_dir), "avg")


@query("monthly_quantity", over_retail(
    f"SELECT {MONTH} AS Month_Index, sum(Total_Purchases) AS Total_Purchases FROM retail GROUP BY 1 ORDER BY 1"
))
def monthly_quantity(spark, sf_dir):
    return r.monthly_quantity(retail(spark, sf_dir))


@query("payment_segment", over_retail(
    "SELECT Payment_Method, Customer_Segment, count(*) AS count FROM retail GROUP BY 1, 2"
))
def payment_segment(spark, sf_dir):
    return r.payment_segment(retail(spark, sf_dir))


# What the columns of the test tables hold.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SHIPPING = ["Express", "Same-Day", "Standard"]
GENDERS = ["Female", "Male"]
COUNTRIES = ["USA"] + [f"NATION_{i}" for i in range(25)]
BRANDS = [f"Brand#{i}" for i in range(1, 26)]


def _pivot_sql(rows: str, alias: str, column: str, values: list[str], cell: str, empty: str,
               nulls: bool = True, where: str = "", other: bool = True) -> str:
    """``cell`` holds {cond}, the test for one column; ``other``: a column for all further labels."""
    cells = [
        f"coalesce({cell.format(cond=f'''{column} = '{v}' ''')}, {empty}) AS \"{v}\"" for v in values
    ]
    if nulls:
        cells.append(f"coalesce({cell.format(cond=f'{column} IS NULL')}, {empty}) AS \"null\"")
    if other:
        listed = ", ".join(f"'{v}'" for v in values)
        cells.append(f"coalesce({cell.format(cond=f'{column} NOT IN ({listed})')}, {empty}) AS other")
    return over_retail(f"SELECT {rows} AS {alias}, {', '.join(cells)} FROM retail {where} GROUP BY 1")


SUM_CELL = "sum(Total_Purchases) FILTER (WHERE {cond})"
AVG_CELL = "avg(Total_Purchases) FILTER (WHERE {cond})"
COUNT_CELL = "count(*) FILTER (WHERE {cond})"


@query("pivot_age_gender_sum", _pivot_sql(AGE_GROUP, "Age_Group", "Gender", GENDERS, SUM_CELL, "0.0"))
def pivot_age_gender_sum(spark, sf_dir):
    rows = r.with_age_group(stored_retail(spark, sf_dir, "Age", "Gender", "Total_Purchases"))
    return pivot_wide(rows, "Age_Group", "Gender", F.sum("Total_Purchases"), GENDERS)


@query("pivot_age_gender_avg", _pivot_sql(AGE_GROUP, "Age_Group", "Gender", GENDERS, AVG_CELL, "0.0"))
def pivot_age_gender_avg(spark, sf_dir):
    rows = r.with_age_group(stored_retail(spark, sf_dir, "Age", "Gender", "Total_Purchases"))
    return pivot_wide(rows, "Age_Group", "Gender", F.avg("Total_Purchases"), GENDERS)


@query("pivot_category_country", _pivot_sql(
    "Product_Category", "Product_Category", "Country", COUNTRIES, SUM_CELL, "0.0", other=False
))
def pivot_category_country(spark, sf_dir):
    """A column for every country that the table holds, whatever their names; none is merged with another."""
    rows = stored_retail(spark, sf_dir, "Product_Category", "Country", "Total_Purchases")
    return pivot_wide(rows, "Product_Category", "Country", F.sum("Total_Purchases"))


@query("pivot_segment_shipping", _pivot_sql(
    "Customer_Segment", "Customer_Segment", "Shipping_Method", SHIPPING, COUNT_CELL, "0"
))
def pivot_segment_shipping(spark, sf_dir):
    rows = stored_retail(spark, sf_dir, "Customer_Segment", "Shipping_Method")
    return pivot_wide(rows, "Customer_Segment", "Shipping_Method", F.count(F.lit(1)), SHIPPING)


@query("pivot_month_brand", _pivot_sql(
    MONTH, "Month", "Product_Brand", BRANDS, SUM_CELL, "0.0", nulls=False,
    where="WHERE Product_Brand IS NOT NULL",
))
def pivot_month_brand(spark, sf_dir):
    rows = stored_retail(spark, sf_dir, "Month", "Product_Brand", "Total_Purchases")
    named = rows.dropna(subset=["Product_Brand"])
    by_number = named.withColumn("Month", key_column("Month"))
    wide = pivot_wide(by_number, "Month", "Product_Brand", F.sum("Total_Purchases"), BRANDS, nulls=False)
    return wide.orderBy("Month")


@query("pivot_payment_segment", _pivot_sql(
    "Payment_Method", "Payment_Method", "Customer_Segment", SEGMENTS, COUNT_CELL, "0"
))
def pivot_payment_segment(spark, sf_dir):
    rows = stored_retail(spark, sf_dir, "Payment_Method", "Customer_Segment")
    return pivot_wide(rows, "Payment_Method", "Customer_Segment", F.count(F.lit(1)), SEGMENTS)
