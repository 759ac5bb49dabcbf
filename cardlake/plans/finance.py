"""Finance mart: channel dimension, finance fact and five revenue views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.functions import fixed_values as V
from cardlake.functions.numbers import div_round
from cardlake.operators.joins import broadcast_if_bounded
from cardlake.operators.keys import dense_key

MONEY = "decimal(38,2)"


def channel_source(c: Column) -> Column:
    return F.coalesce(c, F.lit(V.UNKNOWN_CHANNEL))


def build_dim_channel(fact: DataFrame, online_sources: Sequence[str] = V.ONLINE_CHANNEL_SOURCES) -> DataFrame:
    """Distinct channel labels, keyed in label order, grouped Online / Unknown / In-Store.

    `online_sources` defaults to the source's literal, which the cleaned
    channel text never equals (every group is then In-Store or Unknown);
    pass ("Online",) for the corrected grouping.
    """
    src = fact.select(channel_source(F.col("use_chip")).alias("source_use_chip")).distinct()
    group = (F.when(F.col("source_use_chip").isin(list(online_sources)), F.lit("Online"))
             .when(F.col("source_use_chip") == V.UNKNOWN_CHANNEL, F.lit(V.UNKNOWN_LABEL))
             .otherwise(F.lit("In-Store")))
    keyed = dense_key(src, "source_use_chip", "channel_key")
    return keyed.select("channel_key", "source_use_chip", group.alias("channel_group"))


def _join_channel(fact: DataFrame, channel: DataFrame) -> DataFrame:
    ch = broadcast_if_bounded(channel.select("channel_key", "source_use_chip"))
    return fact.join(ch, channel_source(fact["use_chip"]) == ch["source_use_chip"], "inner")


def build_fact_finance(fact: DataFrame, channel: DataFrame, amount_col: str = "amount") -> DataFrame:
    """Finance fact.  `amount_col` picks the amount used for revenue/refund
    split (default: the stored, always-positive amount, as in the source)."""
    f = _join_channel(fact, channel)
    amt = F.col(amount_col)
    err = F.col("errors")
    return f.select(
        "transaction_id", "date_key", "merchant_key", "mcc_key", "channel_key",
        F.when(amt > 0, amt).otherwise(F.lit(0)).cast("decimal(12,2)").alias("gross_revenue"),
        F.when(amt < 0, F.abs(amt)).otherwise(F.lit(0)).cast("decimal(12,2)").alias("refund_amount"),
        amt.cast("decimal(12,2)").alias("net_amount"),
        F.lit(1).alias("transaction_count"),
        F.when(amt < 0, 1).otherwise(0).alias("refund_flag"),
        F.when(err.isNotNull() & (err != "") & (err != V.NO_ERROR_TEXT), 1).otherwise(0).alias("error_flag"),
    )


def signed_amount(fact: DataFrame) -> DataFrame:
    """Fact with `signed_amount`: refunds negative again (from is_refund)."""
    return fact.withColumn("signed_amount",
                           F.when(F.col("is_refund") == "Yes", -F.col("amount")).otherwise(F.col("amount")))


# ---------------------------------------------------------------- views
# Each view first aggregates the finance fact by the foreign key it joins on
# (map-side combined: at most one row per key per task reaches the shuffle),
# then joins the dimension and rolls the partial sums up.  Sums and counts
# roll up exactly, so the averages are computed from them at the end.

def _preagg(ff: DataFrame, key: str) -> DataFrame:
    gross = F.col("gross_revenue")
    return ff.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum(gross).alias("_gross"),
        F.sum("refund_amount").alias("_refund"),
        F.sum("net_amount").alias("_net"),
        F.sum("transaction_count").alias("_n"),
        F.sum(F.when(gross > 0, gross)).alias("_pos_sum"),
        F.count(F.when(gross > 0, gross)).alias("_pos_n"),
        F.sum("refund_flag").alias("_refund_n"),
        F.sum("error_flag").alias("_error_n"),
    )


def _avg_positive() -> Column:
    return div_round(F.sum("_pos_sum"), F.sum("_pos_n"), 2).cast(MONEY).alias("avg_transaction")


def _revenue_rollup() -> list[Column]:
    return [
        F.sum("_gross").cast(MONEY).alias("gross_revenue"),
        F.sum("_refund").cast(MONEY).alias("refund_amount"),
        F.sum("_net").cast(MONEY).alias("net_revenue"),
        F.sum("_n").cast("long").alias("transaction_count"),
        _avg_positive(),
    ]


def monthly_revenue(ff: DataFrame, dim_date: DataFrame) -> DataFrame:
    d = broadcast_if_bounded(dim_date.select("date_key", "year", "month", "month_name"))
    return (_preagg(ff, "date_key").join(d, "date_key").groupBy("year", "month", "month_name").agg(
        F.sum("_gross").cast(MONEY).alias("total_revenue"),
        F.sum("_n").cast("long").alias("transaction_count"),
        _avg_positive(),
    )).orderBy("year", "month")


def refund_summary(ff: DataFrame, dim_date: DataFrame) -> DataFrame:
    d = broadcast_if_bounded(dim_date.select("date_key", "year", "month", "month_name"))
    agg = _preagg(ff, "date_key").join(d, "date_key").groupBy("year", "month", "month_name").agg(
        F.sum("_n").cast("long").alias("total_transactions"),
        F.sum("_refund_n").cast("long").alias("refund_count"),
        F.sum("_refund").cast(MONEY).alias("refund_amount"),
        F.sum("_gross").cast(MONEY).alias("_gross"),
    )
    return agg.select(
        "year", "month", "month_name", "total_transactions", "refund_count", "refund_amount",
        div_round(F.col("refund_count") * 100, F.col("total_transactions"), 2).cast(MONEY).alias("refund_pct_by_count"),
        div_round(F.col("refund_amount") * 100, F.col("_gross"), 2).cast(MONEY).alias("refund_pct_by_amount"),
    ).orderBy("year", "month")


def revenue_by_state(ff: DataFrame, dim_merchants: DataFrame) -> DataFrame:
    m = dim_merchants.select("merchant_key", F.coalesce("merchant_state", F.lit(V.UNKNOWN_LABEL)).alias("merchant_state"))
    return _preagg(ff, "merchant_key").join(m, "merchant_key").groupBy("merchant_state") \
        .agg(*_revenue_rollup()).orderBy(F.desc_nulls_first("net_revenue"))


def revenue_by_mcc(ff: DataFrame, dim_mcc: DataFrame) -> DataFrame:
    m = dim_mcc.select("mcc_key", "mcc_code", F.coalesce("description", F.lit(V.UNKNOWN_LABEL)).alias("description"))
    return _preagg(ff, "mcc_key").join(broadcast_if_bounded(m), "mcc_key").groupBy("mcc_code", "description") \
        .agg(*_revenue_rollup()).orderBy(F.desc_nulls_first("net_revenue"))


def by_channel(ff: DataFrame, channel: DataFrame) -> DataFrame:
    ch = broadcast_if_bounded(channel)
    return _preagg(ff, "channel_key").join(ch, "channel_key").groupBy("channel_group", "source_use_chip").agg(
        F.sum("_gross").cast(MONEY).alias("gross_revenue"),
        F.sum("_refund").cast(MONEY).alias("refund_amount"),
        F.sum("_net").cast(MONEY).alias("net_revenue"),
        F.sum("_n").cast("long").alias("transaction_count"),
        F.sum("_error_n").cast("long").alias("error_count"),
    ).orderBy(F.desc_nulls_first("net_revenue"))
