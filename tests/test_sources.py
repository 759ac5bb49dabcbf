"""CSV ingest and bulk-load formats (A1, A3, A11, A12) and session settings."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import types as T


def _write(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_raw_csv_null_empty_and_marker_text(spark, tmp_path):
    from cardlake.sources.csv_io import read_raw_csv
    path = str(tmp_path / "mcc_data.csv")
    _write(path, 'code,description,notes,updated_by\n'
                 '5411,"","He said ""hi""",\\N\n'
                 '5412,,  padded  ,x\n')
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("code", "description", "notes", "updated_by")])
    rows = {r["code"]: r for r in read_raw_csv(spark, path, schema).collect()}
    assert rows["5411"]["description"] == "" and rows["5411"]["notes"] == 'He said "hi"'
    assert rows["5411"]["updated_by"] == "\\N"
    assert rows["5412"]["description"] is None and rows["5412"]["notes"] == "  padded  "
    assert rows["5411"]["_seq"]["row"] < rows["5412"]["_seq"]["row"]


def test_raw_csv_malformed_row_fails(spark, tmp_path):
    import pytest
    from cardlake.sources.csv_io import read_raw_csv
    path = str(tmp_path / "bad.csv")
    _write(path, "id,n\n1,2\nx,3\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.IntegerType())])
    with pytest.raises(Exception):
        read_raw_csv(spark, path, schema).collect()


def test_bulk_csv_null_marker_round_trip(spark, scratch):
    from cardlake.sources.csv_io import read_bulk_csv, write_bulk_csv
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    df = spark.createDataFrame([(1, None), (2, ""), (3, " a,b ")], schema)
    marked = f"{scratch}/bulk-{uuid.uuid4().hex[:8]}"
    write_bulk_csv(df, marked)
    got = {r["k"]: r["v"] for r in read_bulk_csv(spark, marked, schema).collect()}
    assert got == {1: None, 2: "", 3: " a,b "}
    empty = f"{scratch}/bulk-{uuid.uuid4().hex[:8]}"
    write_bulk_csv(df, empty, null_marker="")
    got = {r["k"]: r["v"] for r in read_bulk_csv(spark, empty, schema, null_marker="").collect()}
    assert got == {1: None, 2: None, 3: " a,b "}


def test_table_name_from_file(spark):
    from pyspark.sql import functions as F

    from cardlake.sources.csv_io import table_name_from_file
    assert table_name_from_file("/data/in/Users_Data.csv") == "users_data"
    df = spark.createDataFrame([("/data/in/MCC_Data.csv",)], "p string")
    assert df.select(table_name_from_file(F.col("p"))).first()[0] == "mcc_data"


def test_queries_apply_utc_session(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        E.queries()["dedup_report"](spark, SF_SMALL)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_arrival_order_is_file_order(spark, tmp_path):
    """Spark packs the larger file first; keep-first must still take the first file's row."""
    from cardlake.operators.dedup import keep_first
    from cardlake.sources.csv_io import read_raw_csv
    _write(str(tmp_path / "part-00000.csv"), "code,description\n1,early\n1,later\n")
    _write(str(tmp_path / "part-00001.csv"), "code,description\n" + "1,late\n" * 50_000)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("code", "description")])
    got = keep_first(read_raw_csv(spark, str(tmp_path), schema), ["code"], ["_seq"]).collect()
    assert [(r["code"], r["description"]) for r in got] == [("1", "early")]


def test_arrival_order_over_splits_of_one_file(spark, tmp_path):
    from cardlake.sources.csv_io import read_raw_csv
    _write(str(tmp_path / "a.csv"), "code,description\n" + "".join(f"{k},x\n" for k in range(20_000)))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("code", "description")])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_raw_csv(spark, str(tmp_path), schema)
        assert df.rdd.getNumPartitions() > 3
        assert [int(r["code"]) for r in df.orderBy("_seq").collect()] == list(range(20_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_quoted_line_ends(spark, tmp_path):
    from cardlake.sources.csv_io import read_raw_csv
    _write(str(tmp_path / "a.csv"), 'code,description\n1,"two\nlines"\n2,one\n')
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("code", "description")])
    got = {r["code"]: r["description"] for r in read_raw_csv(spark, str(tmp_path), schema, multiline=True).collect()}
    assert got == {"1": "two\nlines", "2": "one"}


def test_deliveries_are_made_from_one_pass_over_the_raw_table(spark, monkeypatch):
    import cardlake.queries as Q
    from conftest import SF_SMALL
    read, write = [], Q.csv_io.write_raw_csv

    def watched(df, *args, **options):
        read.append(df.inputFiles())
        write(df, *args, **options)

    monkeypatch.setattr(Q.csv_io, "write_raw_csv", watched)
    got = Q._arrival_order(spark, SF_SMALL)
    assert [any("lineitem" in f for f in files) for files in read].count(True) == 1
    assert all(f.endswith(".csv.gz") for f in got.inputFiles())
    first = got.where(Q.FIRST_FILE)
    assert 0 < first.count() < got.count() == got.select("id").distinct().count()
    assert {tuple(r) for r in first.select("amount", "errors").distinct().collect()} == {("$1.00", "first\nline")}
    assert got.where(f"NOT ({Q.FIRST_FILE}) AND errors = 'first\nline'").count() == 0


def test_odd_texts_survive_two_compressed_deliveries(spark, tmp_path):
    from cardlake.sources.csv_io import read_raw_csv, write_raw_csv
    texts = ["", None, " a ", 'say "x", y', "one\ntwo", "cr\r\nlf", "\\N", "\\", '"', ",", "é "]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "code string, description string").coalesce(1)
    for k in range(2):
        write_raw_csv(df, str(tmp_path / f"{k}"), compression="gzip")
        df = read_raw_csv(spark, str(tmp_path / f"{k}"), df.schema, with_arrival_seq=False, multiline=True)
    assert [r["description"] for r in df.orderBy(df.code.cast("int")).collect()] == texts


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    from cardlake.session import shuffles_removed
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before, old = files(), spark.conf.get(key)
    with shuffles_removed(spark):
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "a"))
    assert files() <= before and spark.conf.get(key) == old
