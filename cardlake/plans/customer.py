"""Customer mart: customer fact and five customer views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.functions import fixed_values as V
from cardlake.functions.numbers import div_round
from cardlake.operators.joins import broadcast_if_bounded
from cardlake.plans.finance import MONEY, _join_channel


def build_dim_customer(dim_customers: DataFrame) -> DataFrame:
    return dim_customers.select("customer_key", "customer_id").distinct()


def build_dim_card(dim_cards: DataFrame) -> DataFrame:
    return dim_cards.select("card_key", "credit_limit").distinct()


def build_fact_customer(fact: DataFrame, channel: DataFrame) -> DataFrame:
    f = _join_channel(fact, channel)
    amt = F.col("amount")
    return f.select(
        "transaction_id", "customer_key", "date_key", "card_key", "channel_key", "amount",
        F.lit(1).alias("transaction_count"),
        F.when(amt > 0, 1).otherwise(0).alias("positive_transaction_flag"),
        F.when(F.col("errors").isNotNull(), 1).otherwise(0).alias("error_transaction_flag"),
        "errors",
    )


def customer_ltv(fct: DataFrame, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Spend, count, average, first/last date and lifespan of positive rows.

    Aggregated per customer key first (date dimension broadcast, bounded by
    the calendar), then joined to the customer dimension.
    """
    d = broadcast_if_bounded(dim_date.select("date_key", "date"))
    amt = F.col("amount")
    pos = amt > 0
    per = fct.where(F.col("customer_key").isNotNull()).join(d, "date_key").groupBy("customer_key").agg(
        F.sum(F.when(pos, amt).otherwise(F.lit(0))).cast(MONEY).alias("total_spend"),
        F.count_if(pos).cast("long").alias("positive_transaction_count"),
        div_round(F.sum(F.when(pos, amt)), F.count(F.when(pos, amt)), 2).cast(MONEY).alias("avg_transaction_amount"),
        F.min(F.when(pos, F.col("date"))).alias("first_transaction_date"),
        F.max(F.when(pos, F.col("date"))).alias("last_transaction_date"),
    ).withColumn("lifespan_days", F.datediff("last_transaction_date", "first_transaction_date"))
    return per.join(dim_customer, "customer_key").select(
        "customer_key", "customer_id", "total_spend", "positive_transaction_count", "avg_transaction_amount",
        "first_transaction_date", "last_transaction_date", "lifespan_days")


def customer_channel_behavior(fct: DataFrame, dim_customer: DataFrame, channel: DataFrame) -> DataFrame:
    ch = broadcast_if_bounded(channel.select("channel_key", "channel_group"))
    amt = F.col("amount")
    online = (F.col("channel_group") == "Online") & (amt > 0)
    store = (F.col("channel_group") == "In-Store") & (amt > 0)
    per = fct.where(F.col("customer_key").isNotNull()).join(ch, "channel_key").groupBy("customer_key").agg(
        F.sum(F.when(online, amt).otherwise(F.lit(0))).cast(MONEY).alias("online_spend"),
        F.count_if(online).cast("long").alias("online_transaction_count"),
        F.sum(F.when(store, amt).otherwise(F.lit(0))).cast(MONEY).alias("instore_spend"),
        F.count_if(store).cast("long").alias("instore_transaction_count"),
    )
    on, st = F.col("online_transaction_count"), F.col("instore_transaction_count")
    preferred = F.when(on > st, F.lit("Online")).when(on < st, F.lit("In-Store")).otherwise(F.lit("Balanced"))
    return per.join(dim_customer, "customer_key").select(
        "customer_key", "customer_id", "online_spend", "online_transaction_count",
        "instore_spend", "instore_transaction_count", preferred.alias("preferred_channel"))


def customer_active_cards(fct: DataFrame, dim_customer: DataFrame, dim_card: DataFrame) -> DataFrame:
    active = fct.where(F.col("amount") > 0).select("customer_key", "card_key").distinct()
    joined = active.join(dim_customer, "customer_key").join(dim_card, "card_key")
    return joined.groupBy("customer_key", "customer_id").agg(
        F.count("card_key").cast("long").alias("active_card_count"),
        F.sum("credit_limit").alias("total_credit_limit"),
        F.round(F.avg("credit_limit"), 2).alias("avg_credit_limit"),
    )


def customer_spend_stats(fct: DataFrame) -> DataFrame:
    """Mean, sample standard deviation and count of positive amounts per customer.

    Returned unrounded for the outlier test; `avg_spend` is an exact decimal.
    """
    amt = F.col("amount")
    return fct.where((amt > 0) & F.col("customer_key").isNotNull()).groupBy("customer_key").agg(
        div_round(F.sum(amt), F.count(amt), 12).alias("avg_spend"),
        F.stddev_samp(amt.cast("double")).alias("stddev_spend"),
        F.count(F.lit(1)).cast("long").alias("txn_count"),
    )


def customer_stats(fct: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Per-customer spend statistics with the customer id (one row per
    customer).  Materialised as a mart table: the suspicious-transaction
    view then joins the fact to a table scan, a join whose two inputs are
    both plain shuffles, which is the shape AQE can split for a hot customer.
    """
    return customer_spend_stats(fct).join(dim_customer, "customer_key")


def suspicious_transactions(fct: DataFrame, stats: DataFrame, dim_date: DataFrame,
                            channel: DataFrame) -> DataFrame:
    """Rows with an error, or above the customer's mean + 3 sample sd.

    `stats` is `customer_stats` (read back from its table).  The fact takes
    part in exactly one shuffle join, on customer_key; the filter runs right
    after it, before the small (broadcast) dimension joins.
    """
    amt = F.col("amount")
    outlier = ((F.col("txn_count") >= V.OUTLIER_MIN_COUNT) & F.col("stddev_spend").isNotNull()
               & (amt.cast("double") > F.col("avg_spend").cast("double") + V.OUTLIER_SIGMAS * F.col("stddev_spend")))
    has_error = F.col("errors").isNotNull()
    flagged = fct.join(stats, "customer_key").where(has_error | outlier).select(
        "transaction_id", "customer_key", "customer_id", "date_key", "channel_key", "amount", "errors",
        "avg_spend", "stddev_spend",
        F.when(has_error, F.lit(V.REASON_ERROR)).when(outlier, F.lit(V.REASON_OUTLIER))
        .otherwise(F.lit(V.REASON_NONE)).alias("suspicion_reason"),
    )
    d = broadcast_if_bounded(dim_date.select("date_key", F.col("date").alias("transaction_date")))
    ch = broadcast_if_bounded(channel.select("channel_key", "channel_group"))
    return flagged.join(d, "date_key").join(ch, "channel_key").select(
        "transaction_id", "customer_key", "customer_id", "transaction_date", "channel_group", "amount",
        F.round(F.col("avg_spend"), 4).alias("customer_avg_spend"),
        F.round(F.col("stddev_spend"), 4).alias("customer_stddev"),
        "errors", "suspicion_reason",
    )


def customer_suspicion_profile(suspicious: DataFrame) -> DataFrame:
    reason = F.col("suspicion_reason")
    return suspicious.groupBy("customer_key", "customer_id").agg(
        F.count(F.lit(1)).cast("long").alias("suspicious_transaction_count"),
        F.sum(F.when(reason == V.REASON_ERROR, 1).otherwise(0)).cast("long").alias("error_flag_count"),
        F.sum(F.when(reason == V.REASON_OUTLIER, 1).otherwise(0)).cast("long").alias("amount_outlier_count"),
        F.max("transaction_date").alias("last_suspicious_transaction_date"),
    )
