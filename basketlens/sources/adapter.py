"""The retail table derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Valid unchanged in Spark SQL and in the SQL checks.
RETAIL_SQL = """
SELECT
  ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 100000 + l_suppkey AS Transaction_ID,
  CASE WHEN k % 41 = 0 OR (o_custkey % 10 = 0 AND k % 16 <> 0) THEN NULL ELSE o_custkey END AS Customer_ID,
  c_name AS Name,
  concat('c', cast(o_custkey AS string), '@example.com') AS Email,
  concat('555-', cast(o_custkey AS string)) AS Phone,
  concat(cast(o_custkey AS string), ' Main St') AS Address,
  concat('City_', cast(o_custkey % 50 AS string)) AS City,
  r_name AS State,
  10000 + o_custkey % 90000 AS Zipcode,
  CASE WHEN k % 23 = 0 THEN NULL WHEN k % 5 = 0 THEN 'USA' ELSE n_name END AS Country,
  CASE WHEN k % 37 = 0 THEN NULL ELSE cast(18 + o_custkey % 50 + k % 3 AS int) END AS Age,
  CASE WHEN k % 29 = 0 THEN NULL WHEN (o_custkey + (CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END)) % 2 = 0 THEN 'Male' ELSE 'Female' END AS Gender,
  CASE WHEN k % 19 = 0 THEN NULL WHEN c_acctbal < 3000 THEN 'Low' WHEN c_acctbal < 7000 OR k % 3 = 0 THEN 'Medium' ELSE 'High' END AS Income,
  CASE WHEN k % 31 = 0 THEN NULL ELSE c_mktsegment END AS Customer_Segment,
  CASE WHEN k % 43 = 0 THEN NULL ELSE o_orderdate END AS Date,
  concat(cast(cast(o_orderdate AS date) AS string), ' 12:00:00') AS Time,
  CASE WHEN k % 17 = 0 THEN NULL ELSE cast(year(o_orderdate) AS int) END AS Year,
  CASE WHEN k % 17 = 1 THEN NULL ELSE cast(month(o_orderdate) AS int) END AS Month,
  CASE WHEN k % 11 = 0 THEN NULL ELSE l_quantity END AS Total_Purchases,
  CASE WHEN k % 47 = 0 THEN 0.0 WHEN k % 53 = 0 THEN -l_extendedprice / l_quantity ELSE l_extendedprice / l_quantity END AS Amount,
  l_extendedprice AS Total_Amount,
  CASE WHEN k % 13 = 0 THEN NULL ELSE p_type END AS Product_Category,
  CASE WHEN k % 59 = 0 THEN NULL ELSE p_brand END AS Product_Brand,
  concat('Type', cast(p_size % 5 AS string)) AS Product_Type,
  p_name AS products,
  CASE WHEN k % 7 = 0 THEN NULL WHEN k % 4 = 0 THEN 'Bad' WHEN k % 4 = 1 THEN 'Average' WHEN k % 4 = 2 THEN 'Good' ELSE 'Excellent' END AS Feedback,
  CASE WHEN k % 67 = 0 THEN NULL WHEN l_suppkey % 3 = 0 THEN 'Same-Day' WHEN l_suppkey % 3 = 1 THEN 'Express' ELSE 'Standard' END AS Shipping_Method,
  CASE WHEN k % 71 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'Credit Card' WHEN o_orderkey % 4 = 1 THEN 'Debit Card' WHEN o_orderkey % 4 = 2 THEN 'Cash' ELSE 'PayPal' END AS Payment_Method,
  o_orderstatus AS Order_Status,
  CASE WHEN k % 73 = 0 THEN NULL ELSE cast(1 + k % 5 AS double) END AS Ratings
FROM (
  SELECT *, l_orderkey * 31 + l_linenumber * 7 + l_partkey * 3 + l_suppkey AS k
  FROM {lineitem}
  JOIN {orders}   ON l_orderkey = o_orderkey
  JOIN {customer} ON o_custkey = c_custkey
  JOIN {nation}   ON c_nationkey = n_nationkey
  JOIN {region}   ON n_regionkey = r_regionkey
  JOIN {part}     ON l_partkey = p_partkey
) j
"""

# The identifier above is exact up to about 9.2 million orders; beyond, 64 bits are too few for it. What fits is the same
# here. What does not wraps around instead of ending the query: the exact number modulo 2^64. As 10^12 is 2^12 * 5^12,
# the order's part is shifted to its place, which drops what is above. From 3.7e10 orders on it is an error again.
TRANSACTION_ID = "((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 100000 + l_suppkey AS Transaction_ID"
_LINE = "(l_linenumber * 100000000000L + l_partkey * 100000 + l_suppkey)"
WRAPPED_ID = f"shiftleft(l_orderkey * 244140625L + shiftright({_LINE}, 12), 12) | ({_LINE} & 4095L) AS Transaction_ID"

JOINS, END = "{lineitem}", "\n) j"  # what lies between are the joins
RETAIL_TABLES = ["lineitem", "orders", "customer", "nation", "region", "part"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per purchase, 30 columns, with nulls, zero and negative amounts.

    The joins of the SQL in another order: orders get their customer first, so purchases, the largest table, are
    dealt once by order and once by part, and not by customer. Transaction_ID wraps around for large keys, see above.
    """
    read = {name: table(spark, sf_dir, name) for name in RETAIL_TABLES}
    places = read["nation"].join(read["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    owners = read["customer"].join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    owned = read["orders"].join(owners, F.col("o_custkey") == F.col("c_custkey"))
    purchases = read["lineitem"].join(owned, F.col("l_orderkey") == F.col("o_orderkey"))
    joined = purchases.join(read["part"], F.col("l_partkey") == F.col("p_partkey"))
    columns, joins = RETAIL_SQL.replace(TRANSACTION_ID, WRAPPED_ID).split(JOINS)
    return spark.sql(f"{columns}{{joined}}{joins[joins.index(END):]}", joined=joined)


def retail_oracle_sql() -> str:
    return RETAIL_SQL.format(**{name: name for name in RETAIL_TABLES})
