"""Queries for profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.functions.labels import INCOME_SCORES, label_code
from basketlens.operators import profiling as p
from basketlens.operators import sketches as k
from basketlens.operators.staging import staged
from basketlens.plans.registry import query
from basketlens.plans.tables import over_retail, stored_retail, ten_digits, ten_digits_sql
from basketlens.schema import RAW_SCHEMA
from basketlens.sources.adapter import retail

RAW = RAW_SCHEMA.names
NUMBERS = [
    "Transaction_ID", "Customer_ID", "Zipcode", "Age", "Year", "Month", "Total_Purchases",
    "Amount", "Total_Amount", "Ratings",
]
TEXTS = [c for c in RAW if c not in NUMBERS and c != "Date"]


def _union(parts: list[str]) -> str:
    return over_retail(" UNION ALL ".join(parts))


@query("null_counts", _union(
    [f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM retail" for c in RAW]
))
def null_counts(spark, sf_dir):
    return p.null_counts(retail(spark, sf_dir))


_RATED = "retail2 AS (SELECT * REPLACE (CASE WHEN Amount < 0 THEN cast('NaN' AS double) ELSE Amount END AS Amount) FROM retail)"


@query("null_nan_counts", over_retail(f", {_RATED} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL"
    + (f" OR isnan({c})" if c in ("Total_Purchases", "Amount", "Total_Amount", "Ratings") else "")
    + ") AS nulls FROM retail2" for c in RAW
)))
def null_nan_counts(spark, sf_dir):
    amount = F.when(F.col("Amount") < 0, F.lit(float("nan"))).otherwise(F.col("Amount"))
    return p.null_nan_counts(retail(spark, sf_dir).withColumn("Amount", amount))


def _with_odd_amounts(spark, sf_dir):
    """Negative amounts become NaN, and zeros -0.0 or 0.0."""
    zero = F.when(F.col("Transaction_ID") % 2 == 0, F.lit(-0.0)).otherwise(F.lit(0.0))
    amount = F.when(F.col("Amount") < 0, F.lit(float("nan"))).when(F.col("Amount") == 0, zero)
    return retail(spark, sf_dir).withColumn("Amount", amount.otherwise(F.col("Amount")))


@query("distinct_counts", over_retail(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM retail"
    + (" WHERE Amount >= 0" if c == "Amount" else "") for c in RAW
)))
def distinct_counts(spark, sf_dir):
    return p.distinct_counts(_with_odd_amounts(spark, sf_dir))


def _moments(c: str) -> str:
    x = f"cast({c} AS double)"
    return (f"{ten_digits_sql(f'avg({x})')} AS mean, {ten_digits_sql(f'stddev_samp({x})')} AS stddev")


@query("describe", _union([
    f"SELECT '{c}' AS \"column\", count({c}) AS count, {_moments(c)}, "
    f"cast(min({c}) AS double) AS min_number, cast(max({c}) AS double) AS max_number, "
    "cast(NULL AS varchar) AS min_text, cast(NULL AS varchar) AS max_text FROM retail" for c in NUMBERS
] + [
    f"SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, min({c}), max({c}) FROM retail" for c in TEXTS
]))
def describe(spark, sf_dir):
    return ten_digits(p.describe(retail(spark, sf_dir)), "mean", "stddev")


def _quartiles(x: str) -> str:
    return ", ".join(
        f"{ten_digits_sql(f'quantile_cont(cast({x} AS double), {q})')} AS {name}"
        for name, q in p.QUARTILES.items()
    )


@query("describe_quartiles", _union([
    f"SELECT '{c}' AS \"column\", count({c}) AS count, {_moments(c)}, cast(min({c}) AS double) AS min, "
    f"{_quartiles(c)}, cast(max({c}) AS double) AS max FROM retail" for c in NUMBERS
]))
def describe_quartiles(spark, sf_dir):
    described = p.describe_quartiles(stored_retail(spark, sf_dir, *NUMBERS))
    return ten_digits(described, "mean", "stddev", *p.QUARTILES)


RANK_ERROR, DISTINCT_ERROR, PARTS = 0.01, 0.02, ["Year", "Month"]


@query("approx_quartiles", _union([
    f"SELECT '{c}' AS \"column\", count({c}) AS count, '{q}' AS quantile, TRUE AS within FROM retail"
    for c in NUMBERS for q in p.QUARTILES
]))
def approx_quartiles(spark, sf_dir):
    """Quartiles merged from states by month, and whether their ranks are as exact as was asked for."""
    rows = stored_retail(spark, sf_dir, *NUMBERS)
    states = staged(k.quantile_states(rows, NUMBERS, PARTS, RANK_ERROR))
    quartiles = staged(k.merged_quantiles(states, NUMBERS, p.QUARTILES))
    errors = k.rank_errors(rows, quartiles, p.QUARTILES)
    return errors.join(quartiles.select("column", "count"), "column").select(
        "column", "count", "quantile", (F.col("error") <= RANK_ERROR).alias("within")
    )


@query("approx_distinct", _union([
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS exact, TRUE AS within FROM retail"
    + (" WHERE Amount >= 0" if c == "Amount" else "") for c in RAW
]))
def approx_distinct(spark, sf_dir):
    """Distinct counts merged from states by month, next to the exact ones."""
    rows = staged(_with_odd_amounts(spark, sf_dir))
    states = staged(k.distinct_states(rows, RAW, PARTS, DISTINCT_ERROR))
    exact = p.distinct_counts(rows).withColumnRenamed("distinct_values", "exact")
    away = F.abs(F.col("distinct_values") - F.col("exact"))
    return k.merged_distinct(states, RAW).join(exact, "column").select(
        "column", "exact", (away <= DISTINCT_ERROR * F.col("exact")).alias("within")
    )


@query("value_counts", over_retail(
    "SELECT Product_Category, count(*) AS count FROM retail GROUP BY 1 ORDER BY 2 DESC, 1"
))
def value_counts(spark, sf_dir):
    return p.value_counts(retail(spark, sf_dir), "Product_Category")


@query("value_counts_dropna", over_retail(
    "SELECT Product_Category, count(*) AS count FROM retail WHERE Product_Category IS NOT NULL GROUP BY 1"
))
def value_counts_dropna(spark, sf_dir):
    return p.value_counts(retail(spark, sf_dir), "Product_Category", dropna=True)


SUMMARY = ["mean", "std", "median"]
_SUMMARY = f"""count(*) AS row_count, count(Amount) AS value_count,
  {ten_digits_sql("fsum(Amount) / count(Amount)")} AS mean, min(Amount) AS min, max(Amount) AS max,
  {ten_digits_sql("stddev_samp(Amount)")} AS std, {ten_digits_sql("quantile_cont(Amount, 0.5)")} AS median"""


@query("amount_summary", over_retail(f"SELECT {_SUMMARY} FROM retail"))
def amount_summary(spark, sf_dir):
    summary = p.value_summary(stored_retail(spark, sf_dir, "Amount"), "Amount")
    return ten_digits(summary, *SUMMARY)


@query("income_amount_stats", over_retail(f"SELECT Income, {_SUMMARY} FROM retail GROUP BY Income"))
def income_amount_stats(spark, sf_dir):
    rows = stored_retail(spark, sf_dir, "Income", "Amount")
    return ten_digits(p.value_summary(rows, "Amount", ["Income"]), *SUMMARY)


@query("log_histogram", over_retail(f"""
, logs AS (SELECT log10(Amount) AS x FROM retail WHERE Amount > 0),
lim AS (SELECT min(x) AS low, max(x) AS high FROM logs),
counts AS (SELECT least(cast(floor((x - low) * 50 / (high - low)) AS int), 49) AS bin, count(*) AS n
  FROM logs, lim GROUP BY 1)
SELECT cast(b.bin AS int) AS bin, {ten_digits_sql("low + b.bin * ((high - low) / 50)")} AS low,
  {ten_digits_sql("low + (b.bin + 1) * ((high - low) / 50)")} AS high, coalesce(n, 0) AS count
FROM (SELECT range AS bin FROM range(50)) b CROSS JOIN lim LEFT JOIN counts c ON b.bin = c.bin"""))
def log_histogram(spark, sf_dir):
    return ten_digits(p.log_histogram(stored_retail(spark, sf_dir, "Amount"), "Amount"), "low", "high")


@query("log_density", over_retail(f"""
, logs AS (SELECT log10(Amount) AS x, count(*) AS n FROM retail WHERE Amount > 0 GROUP BY 1),
lim AS (SELECT min(x) AS low, max(x) AS high, sum(n) AS total FROM logs),
dev AS (SELECT stddev_samp(log10(Amount)) AS s FROM retail WHERE Amount > 0),
params AS (SELECT low, total, s * pow(cast(total AS double), -0.2) AS h, (high - low) / 199 AS step FROM lim, dev),
grid AS (SELECT cast(range AS int) AS point, low + range * step AS g, h, total FROM range(200), params)
SELECT point, {ten_digits_sql("any_value(g)")} AS x,
  {ten_digits_sql("sum(n * exp(-0.5 * pow((x - g) / h, 2))) / (any_value(total) * any_value(h) * sqrt(2 * pi()))")} AS density
FROM logs, grid GROUP BY point"""))
def log_density(spark, sf_dir):
    return ten_digits(p.log_density(stored_retail(spark, sf_dir, "Amount"), "Amount"), "x", "density")


def _box(group: str, value: str) -> str:
    return over_retail(f"""
, rows_in AS (SELECT {group}, cast({value} AS double) AS v FROM retail WHERE {group} IS NOT NULL AND {value} IS NOT NULL),
boxes AS (SELECT {group}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
  quantile_cont(v, 0.75) AS q3 FROM rows_in GROUP BY 1),
fenced AS (SELECT r.*, q1, median, q3, v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) AS inside
  FROM rows_in r JOIN boxes b USING ({group}))
SELECT {group}, count(*) AS count, {ten_digits_sql("fsum(v) / count(v)")} AS mean,
  {ten_digits_sql("any_value(q1)")} AS q1, {ten_digits_sql("any_value(median)")} AS median,
  {ten_digits_sql("any_value(q3)")} AS q3,
  {ten_digits_sql("min(v) FILTER (WHERE inside)")} AS whisker_low,
  {ten_digits_sql("max(v) FILTER (WHERE inside)")} AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS outliers
FROM fenced GROUP BY {group}""")


BOX = ["mean", *p.QUARTILES, "whisker_low", "whisker_high"]


@query("box_income_amount", _box("Income", "Amount"))
def box_income_amount(spark, sf_dir):
    rows = stored_retail(spark, sf_dir, "Income", "Amount")
    return ten_digits(p.box_summary(rows, "Income", "Amount"), *BOX)


_SCORE = "CASE Income WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 END"


@query("box_segment_income", _box("Customer_Segment", _SCORE))
def box_segment_income(spark, sf_dir):
    rows = stored_retail(spark, sf_dir, "Customer_Segment", "Income")
    scored = rows.withColumn("Income", label_code(F.col("Income"), INCOME_SCORES))
    return ten_digits(p.box_summary(scored, "Customer_Segment", "Income"), *BOX)


@query("preview_by_date", over_retail("""
SELECT Transaction_ID, Customer_ID, Date, Amount, Product_Category FROM retail
ORDER BY Date NULLS FIRST, Transaction_ID LIMIT 5"""))
def preview_by_date(spark, sf_dir):
    columns = ["Transaction_ID", "Customer_ID", "Date", "Amount", "Product_Category"]
    return p.preview(retail(spark, sf_dir), columns, ["Date", "Transaction_ID"])
