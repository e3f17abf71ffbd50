"""The table shapes the operators work on, and checks against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

LONG, INT, DOUBLE, STRING, TIME = (
    LongType(), IntegerType(), DoubleType(), StringType(), TimestampType()
)

# The typed transaction table, column by column.
TYPED_COLUMNS = {
    "Transaction_ID": LONG, "Customer_ID": LONG, "Name": STRING, "City": STRING,
    "State": STRING, "Zipcode": LONG, "Country": STRING, "Age": INT, "Gender": STRING,
    "Income": STRING, "Customer_Segment": STRING, "Date": TIME, "Year": INT, "Month": INT,
    "Time": STRING, "Total_Purchases": INT, "Amount": DOUBLE, "Total_Amount": DOUBLE,
    "Product_Category": STRING, "Product_Brand": STRING, "Product_Type": STRING,
    "Feedback": STRING, "Shipping_Method": STRING, "Payment_Method": STRING,
    "Order_Status": STRING, "Ratings": DOUBLE, "products": STRING,
}
TYPED_SCHEMA = StructType([StructField(name, kind) for name, kind in TYPED_COLUMNS.items()])

# The columns that identify a person.
CONTACT_COLUMNS = ["Email", "Phone", "Address"]

# As stored in text files: dates come in several notations and months also as names.
RAW_COLUMNS = {
    **TYPED_COLUMNS, "Date": STRING, "Month": STRING, **dict.fromkeys(CONTACT_COLUMNS, STRING),
}
RAW_SCHEMA = StructType([StructField(name, kind) for name, kind in RAW_COLUMNS.items()])

# Fixed values.
CLEAN_COLUMNS = [
    "Customer_ID", "Country", "Age", "Gender", "Income", "Customer_Segment", "Year", "Month",
    "Total_Purchases", "Product_Category", "Product_Brand", "Product_Type", "Feedback",
    "Shipping_Method", "Payment_Method", "Ratings", "products", "Transaction_ID",
]

# Fixed values.
MODEL_COLUMNS = [
    "Customer_ID", "Age", "Gender", "Country", "Income", "Customer_Segment", "Transaction_ID",
    "Year", "Month_Index", "Payment_Method", "Shipping_Method", "Total_Purchases", "Products",
    "Product_Category", "Product_Brand", "Product_Type", "Ratings", "Feedback_Rating",
    "Combined_Rating",
]


class MissingColumns(ValueError):
    """The input lacks columns an operator needs."""


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Return ``df`` unchanged, or fail while the plan is still being built."""
    present = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in present]
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")
    return df


def cast_or_null(x: Column, kind: DataType, text: bool = False) -> Column:
    """``x`` as ``kind``; null if it does not fit. An integer may be written as "4.0".

    Of ``text`` with a point the integer is not tried, as it never fits and every cast that fails costs an exception.
    """
    if isinstance(kind, IntegralType):
        number = x.try_cast("double").try_cast(kind)
        whole = F.coalesce(x.try_cast(kind), number)
        return F.when(x.contains("."), number).otherwise(whole) if text else whole
    return x.try_cast(kind)


def apply_schema(df: DataFrame, schema: StructType = TYPED_SCHEMA) -> DataFrame:
    """Select and cast to ``schema``; a value that does not fit its type becomes null."""
    require_columns(df, schema.names)
    return df.select(
        [cast_or_null(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields]
    )


def drop_if_present(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def drop_required(df: DataFrame, names: list[str]) -> DataFrame:
    return require_columns(df, names).drop(*names)
