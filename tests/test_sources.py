import datetime
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from __spark_entry__ import queries
from basketlens.operators.cleaning import parse_date_column
from basketlens.operators import staging
from basketlens.operators.staging import shared_folder, staged
from basketlens.pipeline import process_csv
from basketlens.plans.tables import clean_table
from basketlens.schema import cast_or_null
from basketlens.sources import readers, writers
from basketlens.sources.adapter import retail


@pytest.fixture(scope="module")
def raw(spark):
    return staged(retail(spark, "/root/testdata/sf0.001"))


def rows_of(df):
    return sorted(str(r) for r in df.select(*sorted(df.columns)).collect())


def test_csv_round_trip(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    writers.write_csv(raw, path)
    back = readers.read_csv(spark, path)
    typed = raw.select(
        *[F.col(c).cast(back.schema[c].dataType).alias(c) for c in back.columns if c != "Date"]
    )
    assert rows_of(back.drop("Date")) == rows_of(typed)
    dates = parse_date_column(back).select(F.col("Date").cast("timestamp_ntz"))
    assert rows_of(dates) == rows_of(raw.select("Date"))


def test_csv_with_shuffled_and_missing_columns(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Age,time,Customer_ID,other\n30,22:03:55,7,x\nold,,,\n")
    got = readers.read_csv(spark, str(tmp_path / "t.csv")).orderBy("Customer_ID").collect()
    assert [r.asDict() for r in got] == [
        {"Customer_ID": None, "Age": None, "Time": None},
        {"Customer_ID": 7, "Age": 30, "Time": "22:03:55"},
    ]


def test_csv_inference_is_opt_in(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,y\n")
    inferred = readers.read_csv(spark, str(tmp_path / "t.csv"), schema=None)
    assert inferred.dtypes == [("a", "int"), ("b", "string")]


def test_missing_input_is_an_error(spark, tmp_path):
    for read in (readers.read_csv, readers.read_parquet):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            read(spark, str(tmp_path / "nothing"))


def test_collection_is_replaced(spark, raw, tmp_path):
    options = {"path": str(tmp_path / "collection")}
    writers.write_collection(raw.limit(0), "json", **options)
    for _ in range(2):
        writers.write_collection(raw, "json", **options)
    back = readers.read_collection(spark, "json", raw.schema, **options)
    assert rows_of(back) == rows_of(raw)


def test_parquet_is_replaced_and_partitioned(spark, raw, tmp_path):
    path = str(tmp_path / "p")
    for _ in range(2):
        writers.write_parquet(raw, path, ["Year"])
    assert rows_of(readers.read_parquet(spark, path)) == rows_of(raw)
    writers.write_parquet(raw.limit(3), path)
    assert readers.read_parquet(spark, path).count() == 3


def test_sample_is_ordered_and_without_document_id(spark, raw, tmp_path):
    path = str(tmp_path / "s")
    writers.write_sample(raw.withColumn("_id", F.uuid()), path, ["Transaction_ID", "Total_Amount"], 10)
    back = readers.read_csv(spark, path)
    want = [r[0] for r in raw.orderBy("Transaction_ID").limit(10).select("Transaction_ID").collect()]
    assert sorted(r.Transaction_ID for r in back.collect()) == want
    assert "_id" not in spark.read.option("header", True).csv(path).columns


def test_json_records_keep_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    records = [json.loads(r.record) for r in writers.json_records(df).collect()]
    assert records == [{"a": 1, "b": None}, {"a": 2, "b": "x"}]
    writers.write_json(df, str(tmp_path / "j"))
    assert rows_of(spark.read.schema(df.schema).json(str(tmp_path / "j"))) == rows_of(df)


def test_local_rows(spark):
    schema = StructType([StructField("a", IntegerType())])
    assert readers.from_rows(spark, [(1,), (None,)], schema).count() == 2


def test_rows_are_counted_while_written(spark, raw, tmp_path):
    df, seen = writers.counted(raw)
    writers.write_parquet(df, str(tmp_path / "c"))
    assert seen.get["rows"] == raw.count()


def test_whole_job(spark, raw, sf_dir, tmp_path):
    writers.write_csv(raw, str(tmp_path / "in"))
    report = process_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    expected = clean_table(spark, sf_dir)
    assert report["steps"]["initial"] == raw.count()
    assert report["steps"]["final"] == report["written"] == expected.count()
    assert set(report["nulls"]) == set(expected.columns)
    assert report["nulls"]["Country"] == 0
    out = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert out.agg(F.sum("Transaction_ID")).head()[0] == expected.agg(F.sum("Transaction_ID")).head()[0]


def test_what_is_staged_inside_a_block_goes_with_it(spark, raw, tmp_path):
    with staging.staging(spark):
        path = staged(spark.range(3)).inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("///", "/")
        assert os.path.isdir(path)
    assert not os.path.exists(path) and raw.count()


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {"spark.sql.warehouse.dir": "file:/tmp/warehouse", "spark.checkpoint.dir": None}

    Session.conf = type("Conf", (), {"get": lambda self, key, default=None: {"spark.sql.warehouse.dir": "file:/tmp/w"}.get(key, default)})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())


def test_staged_tables_lie_in_the_shared_folder(spark, raw):
    assert shared_folder(spark).rsplit("/", 1)[1] in raw.inputFiles()[0]


def test_rejected_cells_and_lines_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "Age,time,Customer_ID,other,Ratings\n30,22:03:55,7,x,1.5\nold,,seven,,\n41,1,8,x,2.0,extra,more\n5.0,1\n,,,,bad\n"
    )
    checked = readers.read_csv_checked(spark, str(tmp_path / "t.csv"))
    rows = sorted((r.Age, r.Customer_ID, r.Ratings) for r in checked.rows.fillna(-1).collect())
    assert rows == [(-1, -1, -1.0), (-1, -1, -1.0), (5, -1, -1.0), (30, 7, 1.5), (41, 8, 2.0)]
    assert checked.counts.get == {"lines": 2, "Age": 1, "Customer_ID": 1, "Ratings": 1}
    rejected = sorted((r.column or "", r.text or "", r.line or "") for r in checked.rejected.collect())
    assert rejected == [
        ("", "", "41,1,8,x,2.0,extra,more"), ("", "", "5.0,1"), ("Age", "old", ""), ("Customer_ID", "seven", ""), ("Ratings", "bad", ""),
    ]
    plain = readers.read_csv(spark, str(tmp_path / "t.csv"))
    assert rows_of(plain) == rows_of(checked.rows)


def test_nothing_rejected(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    writers.write_csv(raw.drop("Date"), path)
    checked = readers.read_csv_checked(spark, path)
    assert checked.rows.count() and rows_of(checked.rows) == rows_of(readers.read_csv(spark, path))
    assert checked.rejected.isEmpty()
    writers.write_csv(spark.range(1).selectExpr("'x' as _line"), str(tmp_path / "clash"))
    with pytest.raises(ValueError, match="_line"):
        readers.read_csv_checked(spark, str(tmp_path / "clash"))


def test_a_collection_is_replaced_as_a_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "docs")
    old = spark.range(40).selectExpr("id", "if(id % 2 = 0, null, 'a') as name")
    writers.replace_collection(old, path)
    assert rows_of(readers.read_replaced(spark, path, old.schema)) == rows_of(old)
    first = readers.current_version(spark, path)

    # A task fails after others have written.
    failing = spark.range(0, 4000, 1, 8).select(
        F.when(F.col("id") == 3999, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(Exception, match="broken"):
        writers.replace_collection(failing, path)
    assert readers.current_version(spark, path) == first
    assert rows_of(readers.read_replaced(spark, path, old.schema)) == rows_of(old)
    assert sorted(p.name for p in (tmp_path / "docs").iterdir() if not p.name.startswith(".")) == ["current.txt", first]

    # From itself, and with a reader that is still at the version before.
    reader = readers.read_replaced(spark, path, old.schema)
    writers.replace_collection(reader.where("id < 10"), path)
    assert reader.count() == 40 and readers.read_replaced(spark, path, old.schema).count() == 10
    writers.replace_collection(old.limit(0), path)
    assert readers.read_replaced(spark, path, old.schema).count() == 0 and not (tmp_path / "docs" / first).exists()


def test_refreshing_a_year_leaves_the_others_alone(spark, tmp_path):
    path = tmp_path / "years"
    rows = spark.range(60).selectExpr("id", "cast(2000 + id % 3 as int) as Year")
    writers.write_parquet(rows, str(path), ["Year"])

    def files(year):
        return {(f.name, f.stat().st_mtime_ns) for f in (path / f"Year={year}").glob("*.parquet")}

    before = {year: files(year) for year in (2000, 2001, 2002)}
    writers.refresh_parquet(rows.where("Year = 2001").selectExpr("id + 1000 as id", "Year"), str(path), ["Year"])
    assert files(2000) == before[2000] and files(2002) == before[2002] and not files(2001) & before[2001]
    back = readers.read_parquet(spark, str(path))
    assert back.count() == 60 and {r.id >= 1000 for r in back.where("Year = 2001").collect()} == {True}
    one = back.where("Year = 2001")
    assert "PartitionFilters: [isnotnull(Year" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="partition columns"):
        writers.refresh_parquet(rows, str(path), [])


def test_collections_and_the_csv_job_are_written_compressed(spark, raw, tmp_path):
    some = raw.limit(20)
    writers.replace_collection(some, str(tmp_path / "c"))
    writers.write_csv(raw, str(tmp_path / "in"), compression="gzip")
    process_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), compression="gzip")
    for folder in ("c", "in", "out"):
        names = [f.name for f in (tmp_path / folder).rglob("part-*")]
        assert names and all(name.endswith(".gz") for name in names)
    assert readers.read_replaced(spark, str(tmp_path / "c"), raw.schema).count() == 20


def test_purchases_are_dealt_by_order_and_part_only(spark, sf_dir):
    """Between the scan of the purchases and the result there are two exchanges, none by customer."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = retail(spark, sf_dir)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "l_orderkey" in line)
    above, depth = [], lines[at].index("- ")
    for line in reversed(lines[:at]):
        if "- " in line and line.index("- ") < depth:
            depth = line.index("- ")
            above.append(line)
    dealt = [line for line in above if "Exchange hashpartitioning(" in line]
    assert len(dealt) == 2 and not any("custkey" in line for line in dealt)


def test_keys_of_large_tables_have_identifiers(spark, tmp_path):
    """Up to 64 bits the identifier is the exact number, beyond it wraps around; nulls stay null."""
    limit = 9_223_372  # the first order whose identifiers need not fit
    keys = [
        (order, line, part, supplier)
        for order in (0, 1, limit - 1, limit, limit + 1, 18_446_744, 53_999_999, 30_000_000_000)
        for line in (1, 7)
        for part, supplier in ((0, 0), (36_854, 77_580), (36_854, 77_581), (7_199_999, 359_999))
    ]
    tables = {
        "lineitem": ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                     "l_extendedprice double", [(*k, 2.0, 10.0) for k in keys] + [(1, 1, 0, None, 2.0, 10.0)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
                   [(k, 1, "O", datetime.datetime(2024, 1, 2)) for k in {k[0] for k in keys}]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(1, "a", 1, 1.0, "m")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "n", 1)]),
        "region": ("r_regionkey int, r_name string", [(1, "r")]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int",
                 [(k, "p", "b", "t", 1) for k in {k[2] for k in keys}]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    exact = [((order * 10 + line) * 1_000_000 + part) * 100_000 + supplier for order, line, part, supplier in keys]
    wrapped = [(x + 2**63) % 2**64 - 2**63 for x in exact]
    assert {w == x for w, x in zip(wrapped, exact)} == {True, False}
    found = [r["Transaction_ID"] for r in retail(spark, str(tmp_path)).select("Transaction_ID").collect()]
    assert sorted(found, key=str) == sorted([*wrapped, None], key=str)
    numbered = queries()["dense_ids"](spark, str(tmp_path)).collect()
    assert sorted(r["position"] for r in numbered) == list(range(1, len(keys) + 2))


def test_rejected_cells_are_read_from_a_compressed_file(spark, sf_dir):
    found = queries()["csv_rejected"](spark, sf_dir)
    [path] = {os.path.dirname(name) for name in found.inputFiles()}
    names = [name for name in os.listdir(path.removeprefix("file:")) if name.startswith("part-")]
    assert names and all(name.endswith(".csv.gz") for name in names)


def test_text_with_a_point_is_read_as_a_number_only(spark):
    texts = {
        "4": 4, "4.0": 4, " 4 ": 4, "4.7": 4, "-4.9": -4, "+3": 3, "1e3": 1000, "1.5e3": 1500, ".5": 0, "5.": 5, "x": None,
        "x.y": None, "": None, ".": None, "2147483647.0": 2147483647, "2147483648.0": None, "1,000.0": None, None: None,
    }
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    found = df.select("x", cast_or_null(F.col("x"), IntegerType(), text=True).alias("n")).collect()
    assert {r.x: r.n for r in found} == texts
    big = spark.createDataFrame([("9007199254740993",)], "x string")
    assert big.select(cast_or_null(F.col("x"), LongType(), text=True)).head()[0] == 9007199254740993
