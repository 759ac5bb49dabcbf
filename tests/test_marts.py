"""Mart cells (FIXTURES.md §3: I19, I21, I24) on small hand-built facts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

FCT = ("transaction_id long, customer_key long, date_key long, card_key long, channel_key long, "
       "amount decimal(12,2), errors string")


def _dims(spark):
    channel = spark.createDataFrame([(1, "Online", "Online"), (2, "Swipe", "In-Store"), (3, "__UNKNOWN__", "Unknown")],
                                    "channel_key long, source_use_chip string, channel_group string")
    dim_customer = spark.createDataFrame([(k, 100 + k) for k in range(1, 6)], "customer_key long, customer_id long")
    dim_date = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 3, 1))], "date_key long, date date")
    return channel, dim_customer, dim_date


def test_preferred_channel(spark):
    from cardlake.plans.customer import customer_channel_behavior
    channel, dim_customer, _ = _dims(spark)
    rows = [(1, 1, 1, 1, 1, Decimal("5"), None), (2, 1, 1, 1, 1, Decimal("5"), None), (3, 1, 1, 1, 2, Decimal("5"), None),
            (4, 2, 1, 1, 1, Decimal("5"), None), (5, 2, 1, 1, 2, Decimal("5"), None),
            (6, 3, 1, 1, 3, Decimal("5"), None)]
    out = customer_channel_behavior(spark.createDataFrame(rows, FCT), dim_customer, channel)
    got = {r["customer_key"]: r["preferred_channel"] for r in out.collect()}
    assert got == {1: "Online", 2: "Balanced", 3: "Balanced"}


def test_suspicion_reasons(spark):
    from cardlake.plans.customer import customer_stats, suspicious_transactions
    from cardlake.functions import fixed_values as V
    channel, dim_customer, dim_date = _dims(spark)
    rows, tid = [], 0

    def add(cust, amount, err=None):
        nonlocal tid
        tid += 1
        rows.append((tid, cust, 1, 1, 2, Decimal(amount), err))
        return tid

    for c in (1, 4):
        for _ in range(30):
            add(c, "10")
    outlier = add(1, "1000")
    error_small = add(1, "10", "Bad PIN")
    error_and_outlier = add(4, "1000", "Bad PIN")
    add(3, "5")                                   # single row, no error: not flagged
    fct = spark.createDataFrame(rows, FCT)
    out = suspicious_transactions(fct, customer_stats(fct, dim_customer), dim_date, channel)
    got = {r["transaction_id"]: r["suspicion_reason"] for r in out.collect()}
    assert got == {outlier: V.REASON_OUTLIER, error_small: V.REASON_ERROR, error_and_outlier: V.REASON_ERROR}


def test_industry_yoy_previous_available_year(spark):
    from cardlake.plans.merchant import industry_growth_yoy
    fact = spark.createDataFrame(
        [(1, 1, 1, Decimal("100"), "No"), (2, 2, 1, Decimal("150"), "No"), (3, 2, 1, Decimal("70"), "Yes"),
         (4, 3, 1, Decimal("-5"), "No")],
        "transaction_id long, date_key long, mcc_key long, amount decimal(12,2), is_refund string")
    dim_date = spark.createDataFrame([(1, 2019), (2, 2021), (3, 2022)], "date_key long, year int")
    dim_mcc = spark.createDataFrame([(1, 5411, "Grocery")], "mcc_key long, mcc_code int, description string")
    got = {r["year"]: (r["total_revenue"], r["prev_year_revenue"], r["yoy_growth_pct"])
           for r in industry_growth_yoy(fact, dim_date, dim_mcc).collect()}
    assert got == {2019: (Decimal("100.00"), None, None), 2021: (Decimal("150.00"), Decimal("100.00"), Decimal("50.00"))}


def test_monthly_revenue_rounding(spark):
    """Average of positive rows, rounded half away from zero at 2 places."""
    from cardlake.plans.finance import monthly_revenue
    ff = spark.createDataFrame(
        [(1, 1, Decimal("0.01"), Decimal("0"), Decimal("0.01"), 1, 0, 0),
         (2, 1, Decimal("0.02"), Decimal("0"), Decimal("0.02"), 1, 0, 0),
         (3, 2, Decimal("0"), Decimal("0"), Decimal("0"), 1, 0, 1)],
        "transaction_id long, date_key long, gross_revenue decimal(12,2), refund_amount decimal(12,2), "
        "net_amount decimal(12,2), transaction_count int, refund_flag int, error_flag int")
    dim_date = spark.createDataFrame([(1, 2020, 1, "January"), (2, 2020, 3, "March")],
                                     "date_key long, year int, month int, month_name string")
    rows = monthly_revenue(ff.withColumn("merchant_key", F.lit(1)).withColumn("mcc_key", F.lit(1))
                           .withColumn("channel_key", F.lit(1)), dim_date).collect()
    got = {(r["year"], r["month"]): r.asDict() for r in rows}
    jan = got[(2020, 1)]
    assert jan["transaction_count"] == 2 and float(jan["total_revenue"]) == 0.03
    assert float(jan["avg_transaction"]) == 0.02
    assert got[(2020, 3)]["avg_transaction"] is None
