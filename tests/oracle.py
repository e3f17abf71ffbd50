"""Run a query on Spark and its SQL on DuckDB, and compare rows and types."""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v if v is None else str(v)


def compare(spark_df, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    names = sorted(spark_df.columns)
    got = sorted(
        (tuple(map(plain, (r[n] for n in names))) for r in spark_df.collect()), key=repr
    )
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    if sorted(columns) != names:
        return f"columns {names} != {sorted(columns)}"
    at = [columns.index(n) for n in names]
    types = [str(cur.description[i][1]) for i in at]
    kinds = [SPARK_TYPES[dict(spark_df.dtypes)[n]] for n in names]
    if types != kinds:
        return f"types differ: {[x for x in zip(names, kinds, types) if x[1] != x[2]]}"
    want = sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0][0]} != {bad[0][1]}"
    return None


def main(sf_dir: str, wanted: list[str]) -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(build(spark, sf_dir), con, sqls[name])
            else:
                problem = None if build(spark, sf_dir).collect() else "no rows"
        except Exception as e:  # a report over all queries, not a handler
            problem = f"{type(e).__name__}: {str(e)[:400]}"
        failed += problem is not None
        note = "" if name in sqls else " (no sql)"
        print(f"{time.time() - start:6.1f}s {name}{note}: {problem or 'ok'}", flush=True)
    print(f"failed: {failed}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
