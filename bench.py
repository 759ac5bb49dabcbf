"""Benchmark: full pipeline build + every mart query at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  `queries` holds per-step seconds: `build_*` are the
layer builds (raw -> transformation -> curated -> mart tables, each written
to Parquet in a fresh scratch folder), the rest run each registered mart
query to completion on the `noop` sink (no collect).  `value` is the sum.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardlake.plans import curated as C  # noqa: E402
from cardlake.plans import pipeline as P  # noqa: E402
from cardlake.plans import transform as T  # noqa: E402
from cardlake.queries import QUERIES  # noqa: E402
from cardlake.session import local_session  # noqa: E402
from cardlake.sources.fixtures import raw_tables  # noqa: E402

MART_QUERIES = [
    "finance_monthly_revenue", "finance_refund_summary", "finance_revenue_by_state", "finance_revenue_by_mcc",
    "finance_by_channel", "customer_ltv", "customer_channel_behavior", "customer_active_cards",
    "suspicious_transactions", "customer_suspicion_profile", "merchant_volume", "industry_growth_yoy",
    "merchant_error_rates", "merchant_geo_revenue",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app_name="cardlake-bench")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", scratch + "/ckpt")
    spark.sparkContext.setCheckpointDir(scratch + "/ckpt")

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # the same store the registered queries use, built step by step here
    store = P.store_for(spark, sf_dir)
    raw = raw_tables(spark, sf_dir)
    w = store.write
    TR, CU = P.TRANSFORMATION, P.CURATED
    users = timed("build_clean_users",
                  lambda: P.split_tables(raw, store, names=("users_data",))["users_data"][0])
    cards = timed("build_clean_cards", lambda: P.split_tables(raw, store, names=("cards_data",))["cards_data"][0])
    mcc = timed("build_clean_mcc", lambda: w(T.clean_mcc(raw["mcc_data"]), TR, "mcc_data", "code"))
    tx = timed("build_clean_transactions",
               lambda: P.split_tables(raw, store, names=("transactions_data",))["transactions_data"][0])
    timed("build_rejects", lambda: P.reject_table(raw, store))
    dc = timed("build_dim_customers", lambda: w(C.build_dim_customers(users), CU, "dim_customers", "customer_key"))
    dk = timed("build_dim_cards", lambda: w(C.build_dim_cards(cards), CU, "dim_cards", "card_key"))
    dm = timed("build_dim_mcc", lambda: w(C.build_dim_mcc(mcc), CU, "dim_mcc", "mcc_key"))
    dme = timed("build_dim_merchants", lambda: w(C.build_dim_merchants(tx), CU, "dim_merchants", "merchant_key"))
    dd = timed("build_dim_date", lambda: w(C.build_dim_date(tx), CU, "dim_date", "date_key"))
    timed("build_fact_transactions",
          lambda: w(C.build_fact(tx, C.Dims(dc, dk, dme, dm, dd)), CU, "fact_transactions", "transaction_id"))
    # mart tables (channel dimension, finance and customer facts)
    timed("build_mart_tables", lambda: P.marts_for(spark, sf_dir))
    for name in MART_QUERIES:
        df = QUERIES[name](spark, sf_dir)
        timed(name, lambda: df.write.format("noop").mode("overwrite").save())

    total = round(sum(times.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "pipeline_build_plus_mart_queries",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
