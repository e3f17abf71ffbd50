"""The tables the queries start from, as DataFrames and as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.numeric import round_half_up
from basketlens.operators.cleaning import PROFILE_COLUMNS, clean
from basketlens.operators.features import INDEXED_COLUMNS, model_sources, model_table
from basketlens.operators.staging import staged
from basketlens.schema import CLEAN_COLUMNS, MODEL_COLUMNS, TYPED_SCHEMA
from basketlens.sources.adapter import retail, retail_oracle_sql

ROW_KEY = ["Transaction_ID", "Total_Amount"]

RETAIL = f"retail AS ({retail_oracle_sql()})"


_SQL_TYPES = {"bigint": "bigint", "int": "int", "double": "double", "string": "varchar",
              "timestamp": "timestamp"}
TYPED_SQL = "SELECT " + ", ".join(
    f"try_cast({f.name} AS {_SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}"
    for f in TYPED_SCHEMA.fields
) + " FROM retail"


def stored_retail(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The columns of the retail table, joined once and stored.

    For operators that read their input several times: the joins behind the table are the
    costliest part of such a query.
    """
    rows = retail(spark, sf_dir)
    return staged(rows.select(*columns) if columns else rows)


def clean_table(
    spark: SparkSession, sf_dir: str, sort: bool = False, columns: list[str] | None = None
) -> DataFrame:
    """The clean table, or the given columns of it.

    Rows are stored only if they are read several times, for identifiers or profiles: once they are dated, with the columns
    that are read again.
    """
    wanted = columns or CLEAN_COLUMNS
    names = dict.fromkeys(
        [*wanted, "Customer_ID", "Age", "Year", "Month", "Date", "Amount", "Total_Amount"]
    )
    several = {"Transaction_ID", *PROFILE_COLUMNS}.intersection(wanted)

    def stored(step: str, rows: DataFrame) -> DataFrame:
        return staged(rows) if several and step == "quantity_derived" else rows

    rows = retail(spark, sf_dir).select(*names)
    return clean(rows, order=ROW_KEY, sort=sort, columns=wanted, watch=stored)


def over_retail(sql: str) -> str:
    return f"WITH {RETAIL} {sql}"


def round_sql(x: str, digits: int) -> str:
    """Ties of decimals are kept by more places than are asked for; small numbers have room for many."""
    return f"cast(round(cast({x} AS decimal(38,{8 if digits < 6 else 14})), {digits}) AS double)"


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """``df`` with some columns rounded for comparison, as two engines add doubles differently."""
    return df.withColumns({c: round_half_up(F.col(c), digits) for c in columns})


def rounded_sum_sql(x: str, digits: int) -> str:
    """Added up with compensation in double precision, then rounded."""
    return f"round(fsum({x}), {digits})"


def rounded_avg_sql(x: str, digits: int) -> str:
    return f"round(fsum({x}) / nullif(count({x}), 0), {digits})"


def ten_digits(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with some columns to ten significant digits, for statistics of any magnitude."""
    text = {c: F.format_string("%.9e", F.col(c)).try_cast("double") for c in columns}
    return df.withColumns({c: F.when(F.col(c).isNotNull(), x) for c, x in text.items()})


def ten_digits_sql(x: str) -> str:
    return f"cast(printf('%.9e', cast({x} AS double)) AS double)"


def top_sql(column: str) -> str:
    """Most frequent value by customer and how often it occurs, ties to the smallest."""
    return f"""
  SELECT Customer_ID, '{column}' AS attribute, cast({column} AS varchar) AS v, n FROM (
    SELECT *, row_number() OVER (PARTITION BY Customer_ID ORDER BY n DESC, {column} NULLS LAST) AS rn
    FROM (SELECT Customer_ID, {column}, count({column}) AS n FROM kept GROUP BY 1, 2) c
  ) r WHERE rn = 1"""


SCORED_INCOME = (
    "CASE coalesce(Income, 'Medium') WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 END"
)

# dated: rows with a date; kept: dated rows with customer and age; profile: one row a customer.
PROFILE = f"""
{RETAIL},
dated AS (
  SELECT * REPLACE (
    cast(coalesce(Year, year(Date)) AS int) AS Year,
    cast(coalesce(Month, month(Date)) AS int) AS Month,
    coalesce(Total_Purchases, CASE WHEN Amount <> 0 THEN {round_sql("Total_Amount / Amount", 0)} END) AS Total_Purchases)
  FROM retail WHERE coalesce(Month, month(Date)) IS NOT NULL AND Date IS NOT NULL
),
kept AS (SELECT * FROM dated WHERE Customer_ID IS NOT NULL AND Age IS NOT NULL),
means AS (SELECT Customer_ID, avg(Age) AS age_mean, avg({SCORED_INCOME}) AS income_mean FROM kept GROUP BY 1),
facts AS (
  {" UNION ALL ".join(top_sql(c) for c in ["Country", "Gender", "Customer_Segment", "Age"])}
  UNION ALL SELECT Customer_ID, 'age_mean', cast(age_mean AS varchar), 2 FROM means
  UNION ALL SELECT Customer_ID, 'income_mean', cast(income_mean AS varchar), 2 FROM means
),
profile AS (
  SELECT Customer_ID,
    coalesce(max(v) FILTER (WHERE attribute = 'Country' AND n > 1), 'USA') AS Country,
    coalesce(max(v) FILTER (WHERE attribute = 'Gender' AND n > 1), 'Female') AS Gender,
    coalesce(max(v) FILTER (WHERE attribute = 'Customer_Segment' AND n > 1), 'Regular') AS Customer_Segment,
    cast({round_sql("""cast(coalesce(max(v) FILTER (WHERE attribute = 'Age' AND n > 1),
      max(v) FILTER (WHERE attribute = 'age_mean')) AS double)""", 0)} AS int) AS Age,
    {round_sql("cast(max(v) FILTER (WHERE attribute = 'income_mean') AS double)", 1)} AS Income
  FROM facts GROUP BY Customer_ID
)"""

CLEAN = f"""
{PROFILE},
numbered AS (
  SELECT * REPLACE (row_number() OVER (ORDER BY Transaction_ID, Total_Amount) AS Transaction_ID) FROM dated
),
clean AS (
  SELECT n.Customer_ID, p.Country, p.Age, p.Gender, p.Income, p.Customer_Segment, n.Year, n.Month,
    n.Total_Purchases, coalesce(n.Product_Category, 'Other') AS Product_Category,
    coalesce(n.Product_Brand, 'Other') AS Product_Brand, n.Product_Type,
    coalesce(n.Feedback, 'Average') AS Feedback,
    coalesce(n.Shipping_Method, 'Standard') AS Shipping_Method,
    coalesce(n.Payment_Method, 'Credit Card') AS Payment_Method,
    coalesce(n.Ratings, 3.0) AS Ratings, n.products, n.Transaction_ID
  FROM numbered n JOIN profile p ON n.Customer_ID = p.Customer_ID
  WHERE n.Age IS NOT NULL
)"""


def over_profile(sql: str) -> str:
    return f"WITH {PROFILE} {sql}"


def over_clean(sql: str) -> str:
    return f"WITH {CLEAN} {sql}"


def model(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The model table, or the given columns of it, stored.

    Nothing but the clean columns behind the wanted ones is built. These are stored too if values
    are indexed, as they are read again for that. The new identifiers tell rows apart.
    """
    wanted = list(columns) or [*MODEL_COLUMNS, "Products_Index"]
    rows = clean_table(spark, sf_dir, columns=model_sources(wanted))
    indexed = {"Products_Index", *INDEXED_COLUMNS}.intersection(wanted)
    table = model_table(staged(rows) if indexed else rows, wanted, unique="Transaction_ID")
    return table if "Transaction_ID" in wanted else staged(table)


def _indexed(column: str) -> str:
    return (
        f"cast(dense_rank() OVER (ORDER BY n_{column} DESC, cast(c.{column} AS varchar)) - 1 AS bigint)"
    )


def _model_sql() -> str:
    feedback = (
        "CASE Feedback WHEN 'Bad' THEN 1.0::double WHEN 'Average' THEN 2.0::double "
        "WHEN 'Good' THEN 3.0::double WHEN 'Excellent' THEN 4.0::double END"
    )
    computed = {
        **{c: _indexed(c) for c in INDEXED_COLUMNS if c != "products"},
        "Month_Index": "cast(coalesce(Month, 0) AS int)",
        "Products": "c.products",
        "Feedback_Rating": feedback,
        "Combined_Rating": f"0.5::double * Ratings + 0.5::double * ({feedback})",
    }
    columns = ", ".join(f"{computed.get(c, 'c.' + c)} AS {c}" for c in MODEL_COLUMNS)
    counts = ", ".join(f"count(*) OVER (PARTITION BY {c}) AS n_{c}" for c in INDEXED_COLUMNS)
    # No null reaches the indexed columns of the clean test table.
    return (
        f"{CLEAN}, counted AS (SELECT *, {counts} FROM clean), "
        f"model AS (SELECT {columns}, {_indexed('products')} AS Products_Index FROM counted c)"
    )


MODEL = _model_sql()


def training_sql(key: str, share: float = 0.8, seed: int = 42) -> str:
    digits = f"substr(md5(concat(cast({key} AS varchar), ':{seed}')), 1, 8)"
    return f"cast(concat('0x', {digits}) AS bigint) % 10000 < {int(share * 10_000)}"


def over_model(sql: str) -> str:
    return f"WITH {MODEL} {sql}"


def scaled_sql(columns: list[str], keep: str, source: str = "model") -> str:
    """SELECT of ``keep`` and v0, v1, ...: the columns scaled by their range."""
    cells = []
    for i, c in enumerate(columns):
        low, high = f"(SELECT min({c}) FROM {source})", f"(SELECT max({c}) FROM {source})"
        cells.append(
            f"CASE WHEN {high} = {low} THEN 0.5 ELSE (cast({c} AS double) - {low}) / cast({high} - {low} AS double) END AS v{i}"
        )
    return f"SELECT {keep}, {', '.join(cells)} FROM {source}"


def rounded_sql(size: int, prefix: str = "v") -> str:
    return ", ".join(f"{round_sql(f'{prefix}{i}', 6)} AS {prefix}{i}" for i in range(size))
