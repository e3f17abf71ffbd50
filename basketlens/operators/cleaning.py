"""Raw transactions to the clean table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from basketlens.functions.dates import date_prefix, parse_timestamp
from basketlens.functions.labels import income_score
from basketlens.functions.numeric import round_half_up
from basketlens.operators.numbering import number_rows
from basketlens.operators.staging import staged
from basketlens.schema import CLEAN_COLUMNS, CONTACT_COLUMNS, drop_required, require_columns

# Fixed values.
FILL_DEFAULTS = {
    "Product_Category": "Other",
    "Product_Brand": "Other",
    "Feedback": "Average",
    "Shipping_Method": "Standard",
    "Payment_Method": "Credit Card",
    "Ratings": 3,
}
PROFILE_COLUMNS = ["Country", "Gender", "Customer_Segment", "Age", "Income"]
CUSTOMER_DEFAULTS = {"Country": "USA", "Gender": "Female", "Customer_Segment": "Regular"}
DROPPED_COLUMNS = [
    "Email", "Name", "Zipcode", "Address", "Phone", "City", "State", "Old_Transaction_ID",
    "Order_Status", "Time", "Date", "Amount", "Total_Amount",
]


def parse_date_column(df: DataFrame, name: str = "Date") -> DataFrame:
    """Text becomes a timestamp, or null where it holds no date; other types stay."""
    if isinstance(df.schema[name].dataType, StringType):
        return df.withColumn(name, parse_timestamp(F.col(name)))
    return df


def fill_year_month(df: DataFrame, source: str = "date") -> DataFrame:
    """Complete Year and Month from the date.

    ``source="date"`` takes the Date column, ``source="time"`` replaces it by the date at the
    start of Time, ``source="either"`` takes that date where Date holds none.
    """
    from_time = date_prefix(F.col("Time").cast("string")) if source != "date" else None
    if source == "time":
        df = df.withColumn("Date", from_time)
    else:
        df = parse_date_column(df)
    if source == "either":
        df = df.withColumn("Date", F.coalesce("Date", from_time.cast(df.schema["Date"].dataType)))
    parts = {"Year": F.year("Date"), "Month": F.month("Date")}
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), part.cast(df.schema[name].dataType))
            for name, part in parts.items()
        }
    )


def drop_undated(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["Month", "Date"])


def drop_unattributed(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["Customer_ID", "Age"])


def derive_quantity(df: DataFrame) -> DataFrame:
    """A missing quantity is the total over the unit price, rounded; null if the price is 0."""
    quantity = round_half_up(F.try_divide("Total_Amount", "Amount"), 0)
    return df.withColumn("Total_Purchases", F.coalesce("Total_Purchases", quantity))


def renumber(df: DataFrame, order: list[str]) -> DataFrame:
    """Keep the old Transaction_ID as Old_Transaction_ID and number the rows 1..N."""
    renamed = df.withColumnRenamed("Transaction_ID", "Old_Transaction_ID")
    order = ["Old_Transaction_ID" if c == "Transaction_ID" else c for c in order]
    return number_rows(renamed, order, name="Transaction_ID")


def fill_defaults(df: DataFrame) -> DataFrame:
    return df.fillna({c: value for c, value in FILL_DEFAULTS.items() if c in df.columns})


def customer_profile(df: DataFrame, wanted: list[str] = PROFILE_COLUMNS) -> DataFrame:
    """One row per customer: the (wanted) attributes that every row of the customer gets.

    Country, Gender and Customer_Segment are the most frequent value if it occurs more than
    once, else a default; Age is the most frequent age if it repeats, else the mean; Income is
    the mean income score. Ties go to the smallest value.

    All of it comes from one table of counts by (customer, attribute, value): a customer with
    very many rows is collapsed by partial aggregation before anything is keyed by customer
    alone.
    """
    attributes = [name for name in PROFILE_COLUMNS if name in wanted]
    pairs: list[Column] = []
    for name in attributes:
        value = income_score(F.col(name)) if name == "Income" else F.col(name)
        pairs += [F.lit(name), value.cast("string")]
    counts = (
        df.select("Customer_ID", F.stack(F.lit(len(attributes)), *pairs).alias("attribute", "value"))
        .groupBy("Customer_ID", "attribute", "value")
        .agg(F.count("value").alias("n"))
        .withColumn("number", F.col("value").try_cast("double"))
    )

    def only(name: str, value: Column) -> Column:
        return F.when(F.col("attribute") == name, value)

    def winner(name: str) -> Column:
        ranked = F.struct((-F.col("n")).alias("rank"), "number", "value")
        return F.min(only(name, F.when(F.col("n") > 0, ranked))).alias(f"{name}_top")

    def mean(name: str) -> Column:
        total = F.sum(only(name, F.col("number") * F.col("n")))
        return F.try_divide(total, F.sum(only(name, F.col("n")))).alias(f"{name}_mean")

    profile = counts.groupBy("Customer_ID").agg(
        *[winner(name) for name in attributes if name != "Income"],
        *[mean(name) for name in attributes if name in ("Age", "Income")],
    )

    def repeated(name: str, field: str) -> Column:
        top = F.col(f"{name}_top")
        return F.when(top["rank"] < -1, top[field])

    def found(name: str) -> Column:
        if name == "Income":
            return round_half_up(F.col("Income_mean"), 1)
        if name == "Age":
            age = F.coalesce(repeated("Age", "number"), F.col("Age_mean"))
            return round_half_up(age, 0).cast("int")
        return F.coalesce(repeated(name, "value"), F.lit(CUSTOMER_DEFAULTS[name]))

    return profile.select("Customer_ID", *[found(name).alias(name) for name in attributes])


def apply_profile(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Replace the customer attributes of every row by those of the profile.

    One equi-join, by broadcast if the profile is small. Otherwise a customer with very many rows
    makes one skewed partition on the left, which adaptive execution splits. It does so only if
    the profile is a table of its own, not if the join is planned right on its aggregation:
    pass a stored profile.
    """
    attributes = [c for c in profile.columns if c != "Customer_ID"]
    columns = list(dict.fromkeys([*df.columns, *attributes]))  # those that df lacks come last
    joined = df.drop(*attributes).join(profile, "Customer_ID", "left")
    return joined.select(
        *[
            F.coalesce(F.col(c), F.lit(CUSTOMER_DEFAULTS[c])).alias(c)
            if c in CUSTOMER_DEFAULTS
            else F.col(c)
            for c in columns
        ]
    )


def clean(
    df: DataFrame,
    order: list[str],
    source: str = "date",
    sort: bool = True,
    columns: list[str] | None = None,
    watch: Callable[[str, DataFrame], DataFrame] = lambda step, rows: rows,
) -> DataFrame:
    """The whole pipeline: 30 raw columns to 18 clean ones, or to the ``columns`` wanted.

    ``order`` is the row order that the new identifiers follow; its columns must identify a
    row. Identifiers are given before rows without customer or age are dropped, so they have
    gaps. Rows are numbered, and profiles built, only if a wanted column needs it. ``watch`` sees
    the rows after each step and returns them.
    """
    wanted = [c for c in CLEAN_COLUMNS if c in (columns or CLEAN_COLUMNS)]
    attributes = [c for c in PROFILE_COLUMNS if c in wanted]
    sources = {c for c in wanted if c != "Transaction_ID"} | {"Month", "Date", "Customer_ID", "Age"}
    if "Total_Purchases" in wanted:
        sources |= {"Amount", "Total_Amount"}
    if "Transaction_ID" in wanted:
        sources |= set(order)
    require_columns(df, sorted(sources))
    dated = watch("dates_processed", fill_year_month(watch("initial", df), source))
    dated = watch("undated_dropped", drop_undated(dated))
    if "Total_Purchases" in wanted:
        dated = derive_quantity(dated)
    # What is stored here are the columns that the steps below read, and no others.
    rows = dated = watch("quantity_derived", dated.select(*dict.fromkeys([
        *[c for c in wanted if c != "Transaction_ID"], "Customer_ID", "Age",
        *(order if "Transaction_ID" in wanted else []),
    ])))
    # The profile replaces these, so they need not be dealt with the rows; Age tells which rows to drop.
    own = [c for c in wanted if c not in attributes]
    rows = rows.drop(*[c for c in attributes if c != "Age" and c not in order])
    if "Transaction_ID" in wanted:
        rows = renumber(rows, order)
    owned = watch("unattributed_dropped", drop_unattributed(rows))
    result = fill_defaults(owned.select(*dict.fromkeys([*own, "Customer_ID"])))
    if attributes:
        profile = staged(customer_profile(drop_unattributed(dated), attributes))
        result = apply_profile(result, profile)
    result = watch("final", result.select(*wanted))
    return result.orderBy("Customer_ID", "Transaction_ID") if sort else result


STEPS = [
    "initial", "dates_processed", "undated_dropped", "quantity_derived", "unattributed_dropped",
    "final",
]


def clean_counted(
    df: DataFrame, order: list[str], source: str = "date", sort: bool = True
) -> tuple[DataFrame, dict[str, Observation]]:
    """:func:`clean`, and for each step an observation that counts its rows while it runs.

    Rows are stored before they are numbered and before they are sorted: both look at a sample of
    the rows first, and the steps before would count it too.
    """
    seen: dict[str, Observation] = {}

    def watch(step: str, rows: DataFrame) -> DataFrame:
        seen[step] = Observation(f"rows after {step}")
        rows = rows.observe(seen[step], F.count(F.lit(1)).alias("rows"))
        return staged(rows) if step in ("quantity_derived", "final") else rows

    return clean(df, order, source, sort, watch=watch), seen


def clean_step_counts(df: DataFrame, order: list[str], source: str = "date") -> DataFrame:
    """Rows left after each step of :func:`clean`, counted by the steps themselves."""
    _, seen = clean_counted(df, order, source, sort=False)
    rows = [(i, step, seen[step].get["rows"]) for i, step in enumerate(STEPS, 1)]
    return df.sparkSession.createDataFrame(rows, "step_no int, step string, row_count bigint")


def clean_strict(df: DataFrame) -> DataFrame:
    """The second flow: no contact columns, no nulls, Month from Date, no duplicate rows."""
    complete = drop_required(df, CONTACT_COLUMNS).dropna("any")
    dated = parse_date_column(complete)
    return dated.withColumn("Month", F.month("Date")).dropDuplicates()


def count_negative(df: DataFrame, name: str = "Amount") -> DataFrame:
    return df.agg(F.count_if(F.col(name) < 0).alias("negative_count"))
