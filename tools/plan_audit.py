"""Physical-plan audit of the layer builds and of every registered query of the card pipeline.

For each key: shuffles (hash / range), broadcasts, single-partition
exchanges, sort-based aggregates, windows, Python stages and nested-loop /
cartesian joins in the executed (pre-AQE) plan.  Usage:

    python tools/plan_audit.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardlake.plans import curated as C  # noqa: E402
from cardlake.plans import customer as CU  # noqa: E402
from cardlake.plans import finance as FI  # noqa: E402
from cardlake.plans import transform as T  # noqa: E402
from cardlake.plans.pipeline import DEFAULT_AS_OF, marts_for  # noqa: E402
from cardlake.queries import QUERIES  # noqa: E402
from cardlake.session import local_session  # noqa: E402
from cardlake.sources.fixtures import raw_tables  # noqa: E402

PATTERNS = {
    "hash_shuffle": r"Exchange hashpartitioning",
    "range_shuffle": r"Exchange rangepartitioning",
    "single_partition": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "sort_agg": r"SortAggregate",
    "window": r"\bWindow \[",
    "python": r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas",
    "nested_loop": r"BroadcastNestedLoopJoin|CartesianProduct",
}


def audit(plan: str) -> dict[str, int]:
    return {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}


def builds(spark, sf):
    """The lazy DataFrame of each table's build, over the written tables before it."""
    raw, (l, m) = raw_tables(spark, sf), marts_for(spark, sf)
    return {
        "build clean_users": lambda: T.clean_users(raw["users_data"], DEFAULT_AS_OF),
        "build clean_cards": lambda: T.clean_cards(raw["cards_data"]),
        "build clean_mcc": lambda: T.clean_mcc(raw["mcc_data"]),
        "build clean_transactions": lambda: T.clean_transactions(raw["transactions_data"]),
        "build dim_customers": lambda: C.build_dim_customers(l.users),
        "build dim_merchants": lambda: C.build_dim_merchants(l.tx),
        "build dim_date": lambda: C.build_dim_date(l.tx),
        "build fact_transactions": lambda: C.build_fact(l.tx, l.dims()),
        "build fact_finance": lambda: FI.build_fact_finance(l.fact, m.dim_channel),
        "build fact_customer": lambda: CU.build_fact_customer(l.fact, m.dim_channel),
        "build customer_stats": lambda: CU.customer_stats(m.fact_customer, m.dim_customer),
    }


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_session()
    print("| query | " + " | ".join(k.replace("_", " ") for k in PATTERNS) + " |\n|" + "---|" * (len(PATTERNS) + 1))
    jobs = {**builds(spark, sf), **{k: (lambda f=f: f(spark, sf)) for k, f in QUERIES.items()}}
    for key, fn in jobs.items():
        if only and key not in only:
            continue
        plan = fn()._jdf.queryExecution().executedPlan().toString()
        counts = audit(plan)
        print(f"| `{key}` | " + " | ".join(str(counts[k]) for k in PATTERNS) + " |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
