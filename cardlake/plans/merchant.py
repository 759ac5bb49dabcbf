"""Merchant mart: volume, industry growth, error rates, geographic revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.functions import fixed_values as V
from cardlake.functions.numbers import div_round
from cardlake.operators.joins import broadcast_if_bounded
from cardlake.plans.finance import MONEY


def _sales(fact: DataFrame) -> DataFrame:
    """Non-refund rows with a positive amount."""
    return fact.where((F.col("is_refund") == "No") & (F.col("amount") > 0))


def _per_merchant(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("merchant_key").isNotNull()).groupBy("merchant_key").agg(
        F.sum("amount").alias("_sum"), F.count(F.lit(1)).alias("_n"))


def merchant_volume(fact: DataFrame, dim_merchants: DataFrame) -> DataFrame:
    m = dim_merchants.select("merchant_key", "merchant_id", "merchant_city", "merchant_state")
    return _per_merchant(_sales(fact)).join(m, "merchant_key").select(
        "merchant_key", "merchant_id", "merchant_city", "merchant_state",
        F.col("_sum").cast(MONEY).alias("total_revenue"),
        F.col("_n").cast("long").alias("transaction_count"),
        div_round(F.col("_sum"), F.col("_n"), 2).cast(MONEY).alias("avg_transaction"),
    ).orderBy(F.desc("transaction_count"))


def industry_growth_yoy(fact: DataFrame, dim_date: DataFrame, dim_mcc: DataFrame) -> DataFrame:
    """Revenue per (year, MCC) and growth over the previous *available* year."""
    d = broadcast_if_bounded(dim_date.select("date_key", "year"))
    m = broadcast_if_bounded(dim_mcc.select("mcc_key", "mcc_code", F.col("description").alias("mcc_description")))
    yearly = (_sales(fact).where(F.col("mcc_key").isNotNull()).join(d, "date_key")
              .groupBy("year", "mcc_key").agg(F.sum("amount").alias("_rev"))
              .join(m, "mcc_key")
              .groupBy("year", "mcc_code", "mcc_description").agg(F.sum("_rev").alias("total_revenue")))
    prev = F.lag("total_revenue").over(Window.partitionBy("mcc_code").orderBy("year"))
    lagged = yearly.withColumn("prev_year_revenue", prev)
    p = F.col("prev_year_revenue")
    growth = F.when(p.isNotNull() & (p != 0),
                    div_round((F.col("total_revenue") - p) * 100, p, 2))
    return lagged.select(
        "year", "mcc_code", "mcc_description",
        F.col("total_revenue").cast(MONEY).alias("total_revenue"),
        p.cast(MONEY).alias("prev_year_revenue"),
        growth.cast(MONEY).alias("yoy_growth_pct"),
    ).orderBy(F.desc("year"), F.desc_nulls_last("yoy_growth_pct"))


def merchant_error_rates(fact: DataFrame, dim_merchants: DataFrame,
                         min_transactions: int = V.ERROR_RATE_MIN_TRANSACTIONS) -> DataFrame:
    m = dim_merchants.select("merchant_key", "merchant_id", "merchant_city", "merchant_state")
    per = fact.where(F.col("merchant_key").isNotNull()).groupBy("merchant_key").agg(
        F.count(F.lit(1)).cast("long").alias("total_transactions"),
        F.count_if(F.col("errors").isNotNull()).cast("long").alias("error_transaction_count"),
    ).where(F.col("total_transactions") >= min_transactions)
    return per.join(m, "merchant_key").select(
        "merchant_key", "merchant_id", "merchant_city", "merchant_state",
        "total_transactions", "error_transaction_count",
        div_round(F.col("error_transaction_count") * 100, F.col("total_transactions"), 2)
        .cast(MONEY).alias("error_rate_pct"),
    ).orderBy(F.desc_nulls_first("error_rate_pct"), F.desc("total_transactions"))


def merchant_geo_revenue(fact: DataFrame, dim_merchants: DataFrame) -> DataFrame:
    m = dim_merchants.select("merchant_key", "merchant_id",
                             F.coalesce("merchant_state", F.lit(V.UNKNOWN_LABEL)).alias("merchant_state"))
    per = _per_merchant(_sales(fact)).join(m, "merchant_key")
    agg = per.groupBy("merchant_state").agg(
        F.sum("_sum").alias("_sum"),
        F.sum("_n").cast("long").alias("transaction_count"),
        F.count_distinct("merchant_id").cast("long").alias("merchant_count"),
    )
    return agg.select(
        "merchant_state",
        F.col("_sum").cast(MONEY).alias("total_revenue"),
        "transaction_count", "merchant_count",
        div_round(F.col("_sum"), F.col("merchant_count"), 2).cast(MONEY).alias("avg_revenue_per_merchant"),
    ).orderBy(F.desc_nulls_first("total_revenue"))
