"""Table operators: keep-first, mode per group, dense keys, insert-if-absent,
missing-value normalising, quality checks."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F


def test_keep_first_picks_smallest_seq_and_groups_nulls(spark):
    from cardlake.operators.dedup import keep_first
    df = spark.createDataFrame(
        [(3, 1, "c"), (1, 1, "a"), (2, 1, "b"), (5, None, "n2"), (4, None, "n1"), (6, 2, "z")],
        "_seq long, k int, v string")
    got = {r["k"]: (r["_seq"], r["v"]) for r in keep_first(df, ["k"], ["_seq"]).collect()}
    assert got == {1: (1, "a"), None: (4, "n1"), 2: (6, "z")}


def test_keep_first_hot_key(spark):
    """One key holding most rows: result is still one row, the first."""
    from cardlake.operators.dedup import keep_first
    df = spark.range(0, 50_000).select(F.col("id").alias("_seq"),
                                       F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("k"))
    out = keep_first(df.repartition(16), ["k"], ["_seq"])
    assert out.count() == 1 + len(range(0, 50_000, 3))
    assert out.where("k = -1").first()["_seq"] == 1


def test_mode_per_group_ties(spark):
    from cardlake.operators.dedup import mode_per_group
    rows = [(1, "B", "X"), (1, "B", "X"), (1, "A", "X"), (1, "A", "X"),      # tie -> A
            (2, None, "X"), (2, "A", "X"),                                       # tie NULL vs A -> A
            (3, "C", None), (3, "C", None), (3, "C", "Y")]                       # count wins
    df = spark.createDataFrame(rows, "m int, city string, state string")
    got = {r["m"]: (r["city"], r["state"], r["cnt"]) for r in mode_per_group(df, "m", ["city", "state"]).collect()}
    assert got == {1: ("A", "X", 2), 2: ("A", "X", 1), 3: ("C", None, 2)}


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_dense_key_equals_global_row_number(spark, parts):
    from cardlake.operators.keys import dense_key
    base = spark.range(0, 10_007).select(((F.col("id") * 7919) % 100_003).alias("bk")).repartition(parts)
    keyed = dense_key(base, "bk", "k")
    expected = base.select("bk", F.row_number().over(Window.orderBy("bk")).alias("k_ref"))
    diff = keyed.join(expected, "bk").where(F.col("k") != F.col("k_ref")).count()
    assert keyed.count() == 10_007 and diff == 0
    assert keyed.agg(F.min("k"), F.max("k")).first() == (1, 10_007)


def test_insert_if_absent(spark):
    from cardlake.operators.sinks import insert_if_absent
    target = spark.createDataFrame([(1, "old"), (2, "old")], "id long, v string")
    batch = spark.createDataFrame([(0, 2, "new"), (1, 3, "first"), (2, 3, "second"), (3, None, "nokey")],
                                  "_seq long, id long, v string")
    got = sorted((r["id"], r["v"]) for r in insert_if_absent(batch, target, "id").collect())
    assert got == [(3, "first")]  # no key, no insert


def test_sanitize_missing(spark):
    from cardlake.operators.sinks import sanitize_missing
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5), (3, None)], "id int, x double")
    got = {r["id"]: r["x"] for r in sanitize_missing(df).collect()}
    assert got == {1: None, 2: 1.5, 3: None}


def test_schema_probe_reads_no_rows(spark):
    from cardlake.operators.sinks import schema_probe
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    assert schema_probe(df) == [("id", "bigint"), ("v", "string")]


def test_dedup_report(spark):
    from cardlake.operators.dedup import dedup_report
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id int")
    r = dedup_report(df, "id", "t").first()
    assert (r["rows_before"], r["rows_after"], r["duplicates_removed"]) == (5, 3, 2)


def test_primary_and_foreign_key_checks(spark):
    from cardlake.operators.quality import check_foreign_key, check_primary_key
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "k int")
    r = check_primary_key(df, ["k"], "t").first()
    assert (r["total_rows"], r["null_key_rows"], r["duplicate_keys"], r["duplicate_rows"]) == (5, 1, 1, 2)
    parent = spark.createDataFrame([(1,)], "k int")
    r = check_foreign_key(df, "k", parent, "k", "fk").first()
    assert (r["violating_rows"], r["violating_keys"]) == (1, 1)


def test_broadcast_only_when_bounded(spark):
    from cardlake.operators.joins import broadcast_if_bounded, row_count_at_most
    small = spark.range(10)
    assert row_count_at_most(small, 10) and not row_count_at_most(small, 9)
    big = spark.range(0, 1000).withColumnRenamed("id", "k")
    plan = big.join(broadcast_if_bounded(spark.range(5).withColumnRenamed("id", "k"), 100), "k")._jdf \
        .queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    unbounded = big.join(broadcast_if_bounded(spark.range(500).withColumnRenamed("id", "k"), 100), "k")
    hint = unbounded._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in hint.lower()


def test_broadcast_skipped_above_byte_estimate(spark, scratch):
    from cardlake.operators.joins import broadcast_if_bounded, estimated_size_bytes
    path = f"{scratch}/bytes-{__import__('uuid').uuid4().hex[:8]}"
    spark.range(0, 5000).withColumnRenamed("id", "k").write.parquet(path)
    side = spark.read.parquet(path)
    est = estimated_size_bytes(side)
    assert est is not None and est > 0
    assert "broadcast" not in broadcast_if_bounded(side, max_bytes=est - 1)._jdf.queryExecution() \
        .analyzed().toString().lower()
    assert "broadcast" in broadcast_if_bounded(side, max_bytes=est + 1)._jdf.queryExecution() \
        .analyzed().toString().lower()


def test_div_round_half_away_from_zero(spark):
    from cardlake.functions.numbers import div_round
    df = spark.createDataFrame([(5, 2), (1, 8), (-5, 2), (1, 0)], "a long, b long")
    got = [r[0] for r in df.select(div_round(F.col("a"), F.col("b"), 0)).collect()]
    assert [None if g is None else float(g) for g in got] == [3.0, 0.0, -3.0, None]
    assert not any(isinstance(g, float) and math.isnan(g) for g in got)


def test_shuffle_partition_sizing(spark):
    from cardlake.session import input_size_bytes, size_shuffle_partitions
    from conftest import SF_SMALL
    size = input_size_bytes(spark, [f"{SF_SMALL}/lineitem.parquet", f"{SF_SMALL}/missing.parquet"])
    assert size > 0
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert size_shuffle_partitions(spark, size) == 8                     # never below the session setting
        assert size_shuffle_partitions(spark, 100 * 2**40) == 819_200         # 100 TB: in proportion
        assert size_shuffle_partitions(spark, 100 * 2**40, 2**30) == 102_400  # a deployment's larger partitions
        assert size_shuffle_partitions(spark, 2**40) == 8192                  # 1 TB / 128 MB
        assert spark.conf.get(key) == "8192"
    finally:
        spark.conf.unset(key)
