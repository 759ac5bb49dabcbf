"""End-to-end: the driver contract, oracle parity of every registered query
at sf0.001, and pipeline properties (row-count invariants, order
independence, idempotent incremental load)."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, raw_frame

import __spark_entry__ as E
from cardlake.queries import QUERIES
from oracle.duckdb_sql import queries as oracle_queries

SQL = oracle_queries()


def test_entry_runs_with_stable_schema(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema
    assert a.count() > 0
    assert {"year", "month", "total_revenue"} <= set(a.columns)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    from oracle.compare import duckdb_views
    return duckdb_views(SF_SMALL)


@pytest.mark.parametrize("key", sorted(SQL))
def test_oracle_parity(spark, duck, key):
    from oracle.compare import rows_of
    got = E.queries()[key](spark, SF_SMALL).toPandas()
    want = duck.execute(SQL[key]).df()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_fact_has_one_row_per_clean_transaction(spark):
    from cardlake.plans.pipeline import layers_for
    l = layers_for(spark, SF_SMALL)
    ids = l.tx.where(F.col("id").isNotNull()).select("id").distinct().count()
    assert l.fact.count() == ids == l.tx.count()


def test_cleaning_independent_of_input_order(spark):
    from cardlake.plans.transform import clean_transactions
    from cardlake.sources.fixtures import raw_table
    raw = raw_table(spark, SF_SMALL, "transactions_data")
    a = clean_transactions(raw)
    b = clean_transactions(raw.repartition(7, F.rand(seed=3)))
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_incremental_replay_adds_nothing(spark, scratch):
    from cardlake.sources.fixtures import raw_table
    from cardlake.streaming import incremental as INC
    base = f"{scratch}/test-stream-{uuid.uuid4().hex[:8]}"
    INC.land_raw_transactions(raw_table(spark, SF_SMALL, "transactions_data"), f"{base}/landing")
    counts = []
    for ckpt in ("c1", "c1", "c2"):          # resume, then a fresh checkpoint replays every file
        INC.stream_tx_load(spark, f"{base}/landing", f"{base}/target", f"{base}/{ckpt}").awaitTermination()
        t = spark.read.parquet(f"{base}/target")
        counts.append((t.count(), t.select("id").distinct().count()))
    assert counts[0] == counts[1] == counts[2]
    assert counts[0][0] == counts[0][1] > 0


def test_run_pipeline_writes_layers_and_marts(spark, scratch):
    from cardlake.plans.pipeline import STORED, run_pipeline
    out = f"{scratch}/test-pipeline-{uuid.uuid4().hex[:8]}"
    marts = run_pipeline(spark, SF_SMALL, out)
    assert len(marts) == 14
    for name in marts:
        written = spark.read.parquet(f"{out}/marts/{name}")
        assert written.count() == marts[name].count() == spark.sql(f"SELECT * FROM {name}").count()
    for names in STORED.values():
        for name in names:
            assert spark.sql(f"SELECT COUNT(*) AS n FROM {name}").first()["n"] > 0, name


def test_writes_observe_their_checks(spark, scratch):
    from cardlake.operators.quality import QualityError, fact_missing_keys
    from cardlake.plans.pipeline import run_layers
    from cardlake.sources.fixtures import raw_tables
    out = f"{scratch}/test-observe-{uuid.uuid4().hex[:8]}"
    raw = raw_tables(spark, SF_SMALL)
    with pytest.raises(QualityError, match="curated.fact_transactions.card_key"):
        run_layers(spark, raw, out, max_missing=0.0)
    got = {(r["table_name"], r["check_name"], r["column_name"]): r["rows"] for r in spark.read.parquet(f"{out}/checks/write_metrics").collect()}
    fact = spark.read.parquet(f"{out}/curated/fact_transactions")
    wanted = fact_missing_keys(fact).first().asDict()
    assert got["curated.fact_transactions", "rows", ""] == wanted["fact_rows"]
    for c, n in wanted.items():
        if c != "fact_rows":
            assert got["curated.fact_transactions", "missing", c.removeprefix("missing_")] == n
    rejects = spark.read.parquet(f"{out}/transformation/rejects").groupBy("table_name").count().collect()
    for r in rejects:
        if r["table_name"] != "mcc_data":
            assert got[f"transformation.{r['table_name']}", "rejected", ""] == r["count"]
    cards = spark.read.parquet(f"{out}/transformation/cards_data_staged")
    assert got["transformation.cards_data", "over_length", "issuer_bank_name"] == cards.where("length(issuer_bank_name) > 100").count() > 0


def test_an_empty_table_is_observed(spark, scratch):
    from cardlake.sources.layers import LayerStore
    store = LayerStore(spark, f"{scratch}/test-empty-{uuid.uuid4().hex[:8]}", refresh=True, lengths={})
    store.write(spark.createDataFrame([], "id long, a_key long"), "curated", "t", "id")
    assert sorted(store.metrics) == [("curated.t", "missing", "a_key", 0), ("curated.t", "null_key", "id", 0), ("curated.t", "rows", "", 0)]


def test_run_pipeline_is_a_full_refresh(spark, scratch):
    """A second run into the same folder with other input replaces every table."""
    from cardlake.plans.pipeline import run_pipeline
    out = f"{scratch}/test-refresh-{uuid.uuid4().hex[:8]}"
    run_pipeline(spark, SF_SMALL, out)
    small = spark.read.parquet(f"{out}/curated/fact_transactions").count()
    run_pipeline(spark, "/root/testdata/sf0.01", out)
    assert spark.read.parquet(f"{out}/curated/fact_transactions").count() > small


def test_results_same_without_any_broadcast(spark, scratch, monkeypatch):
    """Above the broadcast bounds every dimension join is a shuffle join;
    the fact and the marts must not change."""
    from cardlake.operators import joins
    from cardlake.plans import curated as C
    from cardlake.plans import customer as CU
    from cardlake.plans import finance as FI
    from cardlake.plans import merchant as ME
    from cardlake.plans.pipeline import marts_for

    l, m = marts_for(spark, SF_SMALL)

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    def views():
        fact = C.build_fact(l.tx, l.dims())
        return {"fact": rows(fact),
                "ltv": rows(CU.customer_ltv(m.fact_customer, m.dim_customer, l.dim_date)),
                "suspicious": rows(CU.suspicious_transactions(m.fact_customer, m.customer_stats, l.dim_date,
                                                              m.dim_channel)),
                "monthly": rows(FI.monthly_revenue(m.fact_finance, l.dim_date)),
                "yoy": rows(ME.industry_growth_yoy(l.fact, l.dim_date, l.dim_mcc))}

    expected = views()
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = C.build_fact(l.tx, l.dims())._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert views() == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_pipeline_from_csv_files_matches(spark, scratch):
    """The four raw tables landed as CSV files (file order = arrival order)
    give the same layers as the in-memory raw tables."""
    from cardlake.plans.pipeline import run_pipeline, run_pipeline_from_csv
    from cardlake.sources import csv_io
    from cardlake.sources.fixtures import raw_table
    base = f"{scratch}/test-csv-{uuid.uuid4().hex[:8]}"
    for file_name, table in (("Users_Data.csv", "users_data"), ("Cards_Data.csv", "cards_data"),
                             ("MCC_Data.csv", "mcc_data"), ("Transactions_Data.csv", "transactions_data")):
        raw = raw_table(spark, SF_SMALL, table)
        csv_io.write_raw_csv(raw.orderBy("_seq").coalesce(1).drop("_seq"), f"{base}/landing/{file_name}")
    from_csv = run_pipeline_from_csv(spark, f"{base}/landing", f"{base}/csv_out")
    from_tables = run_pipeline(spark, SF_SMALL, f"{base}/table_out")
    for layer, name in (("curated", "fact_transactions"), ("curated", "dim_customers"), ("curated", "dim_cards")):
        a = spark.read.parquet(f"{base}/csv_out/{layer}/{name}")
        b = spark.read.parquet(f"{base}/table_out/{layer}/{name}")
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0
    for name in ("finance_monthly_revenue", "suspicious_transactions", "merchant_volume"):
        assert sorted(map(tuple, from_csv[name].collect())) == sorted(map(tuple, from_tables[name].collect()))


def test_incremental_load_from_csv_deliveries(spark, scratch):
    """CSV landing files give the same target as Parquet landing files."""
    from cardlake.sources.fixtures import raw_table
    from cardlake.streaming import incremental as INC
    from cardlake.sources.csv_io import RAW_SCHEMAS
    base = f"{scratch}/test-stream-csv-{uuid.uuid4().hex[:8]}"
    raw = raw_table(spark, SF_SMALL, "transactions_data")
    INC.land_raw_transactions(raw, f"{base}/csv", source_format="csv")
    INC.land_raw_transactions(raw, f"{base}/pq")
    INC.stream_tx_load(spark, f"{base}/csv", f"{base}/t_csv", f"{base}/c_csv",
                       schema=RAW_SCHEMAS["transactions_data"], source_format="csv").awaitTermination()
    INC.stream_tx_load(spark, f"{base}/pq", f"{base}/t_pq", f"{base}/c_pq").awaitTermination()
    a, b = spark.read.parquet(f"{base}/t_csv"), spark.read.parquet(f"{base}/t_pq")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_entry_from_another_working_directory(tmp_path):
    """The driver imports __spark_entry__ by path from elsewhere: executor
    Python workers must not need the package on their path."""
    import os
    import subprocess
    import sys

    from conftest import ROOT
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "from pyspark.sql import SparkSession\n"
            "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
            ".config('spark.sql.shuffle.partitions', '4').getOrCreate()\n"
            "import __spark_entry__ as E\n"
            "print('ROWS', E.entry(spark).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=600)
    assert res.returncode == 0, res.stderr[-3000:]
    assert "ROWS 0" not in res.stdout and "ROWS" in res.stdout


def test_incremental_load_running_picks_up_new_files(spark, scratch):
    """A running load (processing-time trigger) picks up a delivery that lands
    after it started, and ignores a re-delivery of ids it already holds."""
    import time

    from cardlake.sources.fixtures import raw_table
    from cardlake.streaming import incremental as INC
    base = f"{scratch}/test-stream-live-{uuid.uuid4().hex[:8]}"
    raw = raw_table(spark, SF_SMALL, "transactions_data")
    first = raw.where("date < '1998-01-01'")
    INC.land_raw_transactions(first, f"{base}/landing")
    q = INC.stream_tx_load(spark, f"{base}/landing", f"{base}/target", f"{base}/ckpt", every="1 second")
    try:
        q.processAllAvailable()
        n_first = spark.read.parquet(f"{base}/target").count()
        INC.land_raw_transactions(raw, f"{base}/landing", mode="append")  # all, incl. a re-delivery
        deadline = time.time() + 120
        while time.time() < deadline:
            q.processAllAvailable()
            if spark.read.parquet(f"{base}/target").count() > n_first:
                break
            time.sleep(1)
    finally:
        q.stop()
    t = spark.read.parquet(f"{base}/target")
    assert 0 < n_first < t.count() == t.select("id").distinct().count()


def test_plans_have_no_cross_joins_or_global_windows(spark):
    """Every registered query: no nested-loop / cartesian join, every window
    partitioned (except the dense key's per-partition offset table, one row
    per partition), Python only where fuzzy scoring runs."""
    import re
    python_ok = {"fuzzy_canonicalize"}   # elsewhere the scored table is a checkpoint
    problems = []
    for key, fn in QUERIES.items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        if re.search(r"BroadcastNestedLoopJoin|CartesianProduct", plan):
            problems.append((key, "nested loop"))
        for first_arg in re.findall(r"windowspecdefinition\(([^,]*)", plan):
            if (" ASC" in first_arg or " DESC" in first_arg) and not first_arg.startswith("_pid"):
                problems.append((key, "unpartitioned window " + first_arg))
        if re.search(r"MapInPandas|ArrowEvalPython|BatchEvalPython", plan) and key not in python_ok:
            problems.append((key, "python"))
    assert problems == []


def test_command_line_run(tmp_path):
    """`python -m cardlake --tables-dir ... --out ...` writes every layer and
    prints one line per table."""
    import os
    import subprocess
    import sys

    from conftest import ROOT
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = tmp_path / "out"
    res = subprocess.run([sys.executable, "-m", "cardlake", "--tables-dir", SF_SMALL, "--out", str(out)],
                         cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert res.returncode == 0, res.stderr[-3000:]
    lines = dict(line.split("\t") for line in res.stdout.splitlines() if "\t" in line)
    assert {"transformation.transactions_data", "curated.fact_transactions"} <= set(lines)
    import duckdb
    for name in ("finance_monthly_revenue", "finance_refund_summary", "finance_revenue_by_state", "finance_revenue_by_mcc",
                 "finance_by_channel", "customer_ltv", "customer_channel_behavior", "customer_active_cards",
                 "suspicious_transactions", "customer_suspicion_profile", "merchant_volume", "industry_growth_yoy",
                 "merchant_error_rates", "merchant_geo_revenue"):
        n = duckdb.sql(f"SELECT COUNT(*) FROM '{out}/marts/{name}/*.parquet'").fetchall()[0][0]
        assert str(n) == lines[f"marts.{name}"] != "0", name
    assert lines["curated.fact_transactions"] == lines["transformation.transactions_data"] != "0"


BAD_IDS = [(0, "7", "$1.00"), (1, "07", "$2.00"), (2, " 7 ", "$3.00"), (3, "+7", "$4.00"), (4, "abc", "$5.00"), (5, None, "$6.00"),
           (6, "8", "$123,456,789.00"), (7, "9", "0.009999999"), (8, "10", "99999999.99"), (9, "11", "1e30")]


def _bad_transactions(spark, mcc="5411"):
    rows = [dict(_seq=k, id=i, amount=a, date="2020-01-01 10:00:00", client_id=1, card_id=1, merchant_id="1", mcc=mcc) for k, i, a in BAD_IDS]
    return raw_frame(spark, "transactions_data", rows)


def test_transaction_ids_are_unique_numbers(spark):
    from cardlake.plans.transform import clean_transactions, rejected_transactions
    raw = _bad_transactions(spark)
    assert sorted((r["id"], str(r["amount"])) for r in clean_transactions(raw).collect()) == [(7, "1.00"), (10, "99999999.99")]
    assert set(map(tuple, rejected_transactions(raw).collect())) == {
        ("amount_overflow", "11"), ("amount_overflow", "8"), ("bad_id", None), ("bad_id", "abc")}
    assert {r["reason"] for r in rejected_transactions(_bad_transactions(spark, "5411.0")).collect()} == {"bad_mcc", "bad_id", "amount_overflow"}


def test_fact_guard_keeps_one_row_per_transaction(spark):
    from cardlake.operators.dedup import keep_first_if_repeated
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "transaction_id long, v string")
    assert sorted(map(tuple, keep_first_if_repeated(df, "transaction_id").collect())) == [(1, "a"), (2, "c")]
    once = df.where("v != 'b'")
    assert keep_first_if_repeated(once, "transaction_id") is once


def test_replay_with_bad_ids_adds_nothing(spark, scratch):
    from cardlake.streaming.incremental import load_batch
    target = f"{scratch}/test-replay-{uuid.uuid4().hex[:8]}"
    for _ in range(3):
        load_batch(_bad_transactions(spark), target)
        assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [7, 10]


def test_stream_keeps_its_rejects_once(spark, scratch):
    from cardlake.plans.transform import rejected_transactions
    from cardlake.sources.fixtures import raw_table
    from cardlake.streaming import incremental as INC
    base = f"{scratch}/test-rejects-{uuid.uuid4().hex[:8]}"
    raw = raw_table(spark, SF_SMALL, "transactions_data")
    INC.land_raw_transactions(raw, f"{base}/landing")
    wanted = sorted((r["reason"], str(r["id"])) for r in rejected_transactions(raw).collect())
    assert {r for r, _ in wanted} >= {"bad_id", "amount_overflow"}
    for ckpt in ("c1", "c2"):  # a fresh checkpoint replays every file
        INC.stream_tx_load(spark, f"{base}/landing", f"{base}/target", f"{base}/{ckpt}").awaitTermination()
        got = spark.read.parquet(INC.rejects_of(f"{base}/target"))
        assert sorted((r["reason"], str(r["id"])) for r in got.collect()) == wanted


def test_an_unreadable_target_is_an_error(spark, scratch):
    from cardlake.streaming.incremental import _existing
    assert _existing(spark, f"{scratch}/no-such-target-{uuid.uuid4().hex[:8]}") is None
    spark.range(3).write.csv(f"{scratch}/test-target-{(tag := uuid.uuid4().hex[:8])}")
    with pytest.raises(Exception):
        _existing(spark, f"{scratch}/test-target-{tag}").collect()


def test_users_and_cards_that_no_column_holds_are_rejected(spark):
    from cardlake.plans import transform as T
    users = raw_frame(spark, "users_data", [dict(_seq=i, id=i, yearly_income=v) for i, v in enumerate(
        ["1e25", "9223372036854775807", "$9,223,372,036,854,775,808", "5", "1e400", "9e33k", None, "-1e19"])])
    assert {r["id"]: r["yearly_income"] for r in T.clean_users(users, "2025-06-15").collect()} == {1: 9223372036854775807, 3: 0, 6: None}
    got = T.reject_rows(T.stage_users(users, "2025-06-15"), "users_data").collect()
    assert sorted((r["reason"], r["id"]) for r in got) == [("money_overflow", str(i)) for i in (0, 2, 4, 5, 7)]
    cards = raw_frame(spark, "cards_data", [dict(_seq=i, id=i) for i in range(4)])
    cards = cards.withColumn("id", F.when(F.col("id") == 1, "x1").otherwise(F.col("id").cast("string")))
    cards = cards.withColumn("num_cards_issued", F.when(F.col("id") == "2", 1 << 40).otherwise(3))
    assert sorted(r["id"] for r in T.clean_cards(cards).collect()) == [0, 3]
    assert sorted((r["reason"], r["id"]) for r in T.reject_rows(T.stage_cards(cards), "cards_data").collect()) == [("bad_id", "x1"), ("bad_num_cards_issued", "2")]


def test_load_reads_only_the_buckets_it_touches(spark, scratch):
    from cardlake.plans.transform import clean_transactions
    from cardlake.streaming import incremental as INC
    target = f"{scratch}/test-buckets-{uuid.uuid4().hex[:8]}"
    row = lambda i: dict(_seq=i, id=str(i), amount="$1.00", date="2020-01-01", client_id=1, card_id=1, merchant_id="1", mcc="1")
    first = raw_frame(spark, "transactions_data", [row(i) for i in range(1, 100)])
    INC.load_batch(first, target, bucket_ids=10)
    batch = INC.with_bucket(clean_transactions(raw_frame(spark, "transactions_data", [row(i) for i in (95, 101)])), 10)
    read = INC.touched(spark.read.parquet(target), batch)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "id_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {f.split("id_bucket=")[1].split("/")[0] for f in (r["p"] for r in read.selectExpr("_metadata.file_path p").distinct().collect())} == {"9"}
    INC.load_batch(raw_frame(spark, "transactions_data", [row(i) for i in (95, 101)]), target, bucket_ids=10)
    assert spark.read.parquet(target).count() == 100


def test_a_changed_input_is_read_again(spark, scratch):
    """Same path, other rows: the layer store must not answer from the old ones."""
    import os
    import shutil

    from cardlake.queries import QUERIES as Q
    folder = f"{scratch}/test-changed-{uuid.uuid4().hex[:8]}".removeprefix("file:")
    os.makedirs(folder)
    for t in ("customer", "part", "orders", "lineitem"):
        shutil.copyfile(f"{SF_SMALL}/{t}.parquet", f"{folder}/{t}.parquet")
    before = Q["clean_users"](spark, folder).count()
    import pyarrow.parquet as pq
    pq.write_table(pq.read_table(f"{folder}/customer.parquet").slice(0, 50), f"{folder}/customer.parquet")
    after = Q["clean_users"](spark, folder).count()
    assert (before, after) == (150, 50)


def test_declared_types(spark):
    """Types of the layer tables themselves, before any cast for comparison."""
    from cardlake.plans.pipeline import layers_for
    l = layers_for(spark, SF_SMALL)
    kind = lambda df: {f.name: f.dataType.simpleString() for f in df.schema.fields}
    tx = kind(l.tx)
    assert {c: tx[c] for c in ("id", "date", "amount", "refund_amount", "mcc", "is_refund")} == {
        "id": "bigint", "date": "timestamp_ntz", "amount": "decimal(10,2)", "refund_amount": "decimal(10,2)", "mcc": "int", "is_refund": "boolean"}
    users = kind(l.users)
    assert {c: users[c] for c in ("current_age", "birth_year", "latitude", "yearly_income")} == {
        "current_age": "int", "birth_year": "int", "latitude": "double", "yearly_income": "bigint"}
    assert kind(l.dim_date)["date"] == "date" and kind(l.fact)["amount"] == "decimal(12,2)" and kind(l.mcc)["code"] == "int"


def test_label_join_never_shuffles_users_by_spelling(spark, monkeypatch):
    """The written fuzzy table is small whatever the size of its input."""
    from cardlake.operators import joins
    from cardlake.plans.transform import clean_users
    from cardlake.sources.fixtures import raw_table
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 64 * 1024)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = clean_users(raw_table(spark, "/root/testdata/sf0.01", "users_data"), "2025-06-15")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "_status_key" in plan
    assert not [line for line in plan.splitlines() if "hashpartitioning(_employment_status_key" in line or "hashpartitioning(_education_level_key" in line]


def test_a_cluster_needs_a_shared_folder():
    import pytest

    from cardlake.session import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_a_layer_table_builds_only_what_it_is_made_of(spark, scratch):
    """Findings 2 to 21: cleaned users, cards and categories built every fact."""
    import uuid

    from cardlake.plans.pipeline import CURATED, Layers, TRANSFORMATION
    from cardlake.sources.fixtures import raw_tables
    from cardlake.sources.layers import LayerStore

    raw = raw_tables(spark, SF_SMALL)
    raw["transactions_data"] = raw["transactions_data"].withColumn("id", F.raise_error(F.lit("not asked for")).cast("string"))
    store = LayerStore(spark, f"{scratch}/lazy-{uuid.uuid4().hex[:8]}")
    layers = Layers(store, raw)
    assert layers.dim_customers.count() and layers.dim_cards.count() and layers.dim_mcc.count()
    assert store.has(TRANSFORMATION, "users_data_staged") and store.has(CURATED, "dim_mcc")
    assert not store.has(TRANSFORMATION, "transactions_data_staged")


def test_raw_transactions_from_one_join_are_those_of_the_sql(spark):
    """NULLs, repeated orders and repeated lines included; the two tables meet once."""
    import datetime as dt

    from cardlake.sources import fixtures as X

    rows = [(o, line, o * 211 % 600, o % 40, float(line % 5 + 1) if o % 9 else None, 10.5 * o, 0.1, 0.2, "NR"[o % 2], "O", dt.date(1996, 1, 1 + o % 28))
            for o in range(1, 200) for line in (1, 2, 2)]
    lineitem = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date")
    orders = spark.createDataFrame([(o, None if o % 11 == 0 else o) for o in range(1, 190)] + [(7, 35), (8, 91)], "o_orderkey long, o_custkey long")
    tables = {"lineitem": lineitem, "orders": orders}
    want, got = spark.sql(X.TRANSACTIONS_SQL, **tables), spark.sql(X.SPARK_SQL["transactions_data"], **tables)
    assert want.dtypes == got.dtypes
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1


def test_shuffle_partitions_of_the_layers_hold_a_few_megabytes_of_input(spark):
    from cardlake.plans.pipeline import SHUFFLE_BYTES
    from cardlake.session import size_shuffle_partitions

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    try:
        assert size_shuffle_partitions(spark, 5 << 30, SHUFFLE_BYTES) >= 600
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        if before is not None:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", before)


def _below(plan: str, node: str) -> str:
    """A plan's text under its first `node`."""
    at = plan.index(node)
    return plan[plan.index("\n", at):]


def test_rows_are_numbered_before_their_texts_are_made(spark):
    """The shuffle and the sort of the numbering carry the tables' own columns."""
    from cardlake.sources.fixtures import raw_table

    plan = raw_table(spark, SF_SMALL, "transactions_data")._jdf.queryExecution().optimizedPlan().toString()
    assert "Transaction" in plan and "Transaction" not in _below(plan, "Window [")


def test_users_and_categories_are_cleaned_after_keep_first(spark):
    """Cleaning runs on the shuffled rows that stay, not in the few tasks that read a small file."""
    from cardlake.plans import transform as T

    user = {"birth_year": 1990, "birth_month": 2, "address": " a  b ", "employment_status": "Employed"}
    users = raw_frame(spark, "users_data", [user | {"id": 1, "gender": "M"}, user | {"id": 1, "gender": "F"}, user | {"id": 2, "gender": "F"}])
    mcc = raw_frame(spark, "mcc_data", [{"code": "MCC 7", "description": "one  a"}, {"code": "7.0", "description": "two"}, {"code": "x", "description": "three"}])
    cleaned, codes = T.stage_users(users, "2025-06-15"), T.clean_mcc(mcc)
    assert {(r.id, r.gender, r.address) for r in cleaned.collect()} == {(1, "Male", "A B"), (2, "Female", "A B")}
    assert [(r.code, r.description) for r in codes.collect()] == [(7, "One A")]
    for df in (cleaned, codes):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract_all" in plan and "regexp_extract_all" not in _below(plan, "Aggregate [")


def test_one_pass_over_the_feed_yields_rows_and_rejects(spark, tmp_path):
    """Rows without a number as id all stay among the rejects, and the feed is read once for both."""
    from cardlake.plans.transform import reject_rows, stage_transactions, stored_rows

    row = {"amount": "$5.00", "date": "2020-01-02", "merchant_id": "1", "mcc": "5411"}
    huge = {**row, "amount": "$123,456,789.00"}
    raw_frame(spark, "transactions_data", [
        {**row, "id": "1"}, {**row, "id": "01"}, row, row, {**row, "id": "tx-1"}, {**row, "id": "tx-1"},
        {**row, "id": "tx-2", "amount": "oops"}, {**huge, "id": " +7 "}, {**huge, "id": "8"},
    ]).write.parquet(f"{tmp_path}/raw")
    staged = stage_transactions(spark.read.parquet(f"{tmp_path}/raw"))
    assert staged._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    got = sorted((str(r.id), r.reason) for r in reject_rows(staged, "transactions_data").collect())
    assert got == sorted([("None", "bad_id")] * 2 + [("tx-1", "bad_id")] * 2 + [("tx-2", "bad_id"), (" +7 ", "amount_overflow"), ("8", "amount_overflow")])
    assert [(r.id, float(r.amount)) for r in stored_rows(staged).collect()] == [(1, 5.0)]
    assert staged.where("_reason = 'bad_id' and (date is not null or amount is not null or is_online is not null)").count() == 0
    assert staged.where("_reason is null and _raw_id is not null").count() == 0
