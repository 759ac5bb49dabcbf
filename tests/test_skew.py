"""Hot keys: one customer holds a third of all fact rows.  Results must not
change with the physical strategy, and AQE must split the hot partition of
the per-customer statistics join instead of giving it to one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_fact(spark, n=30_000):
    hot = F.col("id") % 3 == 0
    return spark.range(0, n).select(
        F.col("id").alias("transaction_id"),
        F.when(hot, F.lit(1)).otherwise(2 + F.col("id") % 997).alias("customer_key"),
        (F.col("id") % 5 + 1).alias("date_key"),
        F.lit(1).cast("long").alias("card_key"),
        (F.col("id") % 2 + 1).alias("channel_key"),
        F.when(F.col("id") % 1000 == 7, F.lit(5000)).otherwise(F.col("id") % 50 + 1).cast("decimal(12,2)").alias("amount"),
        F.when(F.col("id") % 401 == 0, F.lit("Bad PIN")).alias("errors"),
    )


def _dims(spark):
    import datetime as dt
    channel = spark.createDataFrame([(1, "Swipe", "In-Store"), (2, "Chip", "In-Store")],
                                    "channel_key long, source_use_chip string, channel_group string")
    customers = spark.range(1, 1000).select(F.col("id").alias("customer_key"), (F.col("id") + 100).alias("customer_id"))
    dates = spark.createDataFrame([(k, dt.date(2020, 1, k)) for k in range(1, 6)], "date_key long, date date")
    return channel, customers, dates


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_suspicious_with_hot_customer(spark, skew_conf, scratch):
    import uuid

    from cardlake.plans.customer import customer_stats, suspicious_transactions
    base = f"{scratch}/skew-{uuid.uuid4().hex[:8]}"
    _hot_fact(spark).write.parquet(f"{base}/fct")
    fct = spark.read.parquet(f"{base}/fct")
    channel, customers, dates = _dims(spark)
    customer_stats(fct, customers).write.parquet(f"{base}/stats")
    stats = spark.read.parquet(f"{base}/stats")
    out = suspicious_transactions(fct, stats, dates, channel)
    got = _rows(out)
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("Initial Plan")]
    assert "SortMergeJoin" in final and "isSkewJoin=true" in final.replace(" ", "").replace("(skew=true)", "isSkewJoin=true")

    for k in SKEW_CONF:
        spark.conf.unset(k)
    assert _rows(suspicious_transactions(fct, stats, dates, channel)) == got
    assert any(r[1] == 1 for r in got)


def test_keep_first_and_mode_with_hot_key(spark, skew_conf):
    from cardlake.operators.dedup import keep_first, mode_per_group
    df = spark.range(0, 30_000).select(
        F.col("id").alias("_seq"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 4).cast("string").alias("city")).repartition(16)
    first = keep_first(df, ["k"], ["_seq"]).where("k = -1").first()
    assert first["_seq"] == 0 and first["city"] == "0"
    mode = {r["k"]: (r["city"], r["cnt"]) for r in mode_per_group(df, "k", ["city"]).where("k = -1").collect()}
    # ids 0, 3, 6, ... : city cycles 0, 3, 2, 1 -> 2,500 each; tie broken by the smallest city
    assert mode == {-1: ("0", 2500)}


def test_fact_star_join_with_hot_client(spark, skew_conf, scratch, monkeypatch):
    """A third of all transactions carry one client id.  With every dimension
    join a shuffle join, AQE splits the hot partition of the left outer join
    and the fact is the same as with broadcast joins."""
    import uuid

    from cardlake.operators import joins
    from cardlake.plans import curated as C
    from cardlake.plans.pipeline import layers_for
    from conftest import SF_SMALL

    l = layers_for(spark, SF_SMALL)
    hot_id = l.dim_customers.agg(F.min("customer_id")).first()[0]
    path = f"{scratch}/hot-tx-{uuid.uuid4().hex[:8]}"
    # many input files: AQE splits a skewed partition along map-output blocks
    l.tx.withColumn("client_id", F.when(F.col("id") % 3 == 0, F.lit(hot_id)).otherwise(F.col("client_id"))) \
        .repartition(16).write.parquet(path)
    tx = spark.read.parquet(path)

    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    fact = C.build_fact(tx, l.dims())
    got = _rows(fact)
    final = fact._jdf.queryExecution().executedPlan().toString()
    final = final[:final.index("Initial Plan")]
    assert "BroadcastHashJoin" not in final and "SortMergeJoin(skew=true)" in final

    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 1_000_000)
    for k in SKEW_CONF:
        spark.conf.unset(k)
    assert _rows(C.build_fact(tx, l.dims())) == got
    assert sum(1 for r in got if r[2] is not None and r[2] == 1) >= len(got) // 3
