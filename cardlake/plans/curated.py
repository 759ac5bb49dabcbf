"""Curated layer: five dimensions with dense surrogate keys and the fact table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.functions import fixed_values as V
from cardlake.functions.dates import day_name, is_weekend, month_name
from cardlake.functions.text import strip_ws
from cardlake.operators.dedup import keep_first_if_repeated, mode_per_group
from cardlake.operators.joins import broadcast_if_bounded
from cardlake.operators.keys import dense_key

DIM_CUSTOMERS_COLUMNS = [
    "customer_key", "customer_id", "gender", "birth_year", "birth_month", "current_age",
    "retirement_age", "address", "latitude", "longitude", "per_capita_income",
    "yearly_income", "total_debt", "credit_score", "num_credit_cards",
    "employment_status", "education_level",
]
DIM_CARDS_COLUMNS = [
    "card_key", "card_id", "client_id", "card_brand", "card_type", "masked_card_number",
    "expires", "has_chip", "num_cards_issued", "credit_limit", "acct_open_date",
    "year_pin_last_changed", "card_on_dark_web", "issuer_bank_name", "issuer_bank_state",
    "issuer_bank_type", "issuer_risk_rating",
]
DIM_MCC_COLUMNS = ["mcc_key", "mcc_code", "description", "notes", "updated_by"]
DIM_MERCHANTS_COLUMNS = ["merchant_key", "merchant_id", "merchant_city", "merchant_state", "zip"]
DIM_DATE_COLUMNS = ["date_key", "date", "year", "month", "day", "month_name", "day_name", "is_weekend"]
FACT_COLUMNS = [
    "transaction_id", "date_key", "customer_key", "card_key", "merchant_key", "mcc_key",
    "amount", "use_chip", "errors", "is_refund", "has_error", "is_online",
]


def _stripped(cols: list[str]) -> list[Column]:
    return [strip_ws(F.col(c)).alias(c) for c in cols]


def build_dim_customers(users: DataFrame) -> DataFrame:
    text = ["gender", "address", "employment_status", "education_level"]
    df = users.select(
        F.col("id").cast("long").alias("customer_id"),
        *[F.col(c) for c in users.columns if c not in text and c != "id"],
        *_stripped(text),
    ).where(F.col("customer_id").isNotNull())
    return dense_key(keep_first_if_repeated(df, "customer_id"), "customer_id", "customer_key").select(*DIM_CUSTOMERS_COLUMNS)


def mask_card_number(c: Column) -> Column:
    s = strip_ws(F.replace(c, F.lit(" "), F.lit("")))
    return F.when(F.length(s) >= 4, F.concat(F.lit(V.CARD_MASK_PREFIX), F.right(s, F.lit(4))))


def build_dim_cards(cards: DataFrame) -> DataFrame:
    text = ["card_brand", "card_type", "expires", "has_chip", "acct_open_date", "card_on_dark_web",
            "issuer_bank_name", "issuer_bank_state", "issuer_bank_type", "issuer_risk_rating"]
    df = cards.select(
        F.col("id").cast("long").alias("card_id"),
        F.col("client_id").cast("long").alias("client_id"),
        F.col("num_cards_issued"), F.col("credit_limit").cast("double").alias("credit_limit"),
        F.col("year_pin_last_changed"),
        mask_card_number(F.col("card_number")).alias("masked_card_number"),
        *_stripped(text),
    ).where(F.col("card_id").isNotNull())
    return dense_key(keep_first_if_repeated(df, "card_id"), "card_id", "card_key").select(*DIM_CARDS_COLUMNS)


def build_dim_mcc(mcc: DataFrame) -> DataFrame:
    df = mcc.select(F.col("code").cast("long").alias("mcc_code"),
                    *_stripped(["description", "notes", "updated_by"])) \
            .where(F.col("mcc_code").isNotNull())
    return dense_key(keep_first_if_repeated(df, "mcc_code"), "mcc_code", "mcc_key").select(*DIM_MCC_COLUMNS)


def build_dim_merchants(tx: DataFrame) -> DataFrame:
    """Each merchant's most frequent (city, state, zip)."""
    df = tx.where(F.col("merchant_id").isNotNull()).select(
        F.col("merchant_id").cast("long").alias("merchant_id"),
        *_stripped(["merchant_city", "merchant_state", "zip"]))
    mode = mode_per_group(df, "merchant_id", ["merchant_city", "merchant_state", "zip"])
    return dense_key(mode.drop("cnt"), "merchant_id", "merchant_key").select(*DIM_MERCHANTS_COLUMNS)


def build_dim_date(tx: DataFrame) -> DataFrame:
    """Calendar rows for the dates that occur (gaps stay gaps)."""
    dates = tx.where(F.col("date").isNotNull()).select(F.to_date("date").alias("date")).distinct()
    df = dates.select(
        "date",
        F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
        month_name("date").alias("month_name"), day_name("date").alias("day_name"),
        is_weekend("date").alias("is_weekend"),
    )
    return dense_key(df, "date", "date_key").select(*DIM_DATE_COLUMNS)


def _yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("Yes")).otherwise(F.lit("No"))


@dataclass
class Dims:
    customers: DataFrame
    cards: DataFrame
    merchants: DataFrame
    mcc: DataFrame
    date: DataFrame


def build_fact(tx: DataFrame, dims: Dims) -> DataFrame:
    """One row per transaction with the five surrogate keys (left joins).

    Key-only projections of each dimension are joined; each is broadcast
    only after its row count is checked, otherwise Spark shuffles (AQE may
    still choose broadcast at run time and splits skewed keys).  Flags pass
    the joins as booleans; their texts are made after the last one.
    """
    fact = tx.select(
        F.col("id").cast("long").alias("transaction_id"),
        F.to_date("date").alias("_date"),
        F.col("client_id").cast("long").alias("_client_id"),
        F.col("card_id").cast("long").alias("_card_id"),
        F.col("merchant_id").cast("long").alias("_merchant_id"),
        F.col("mcc").cast("long").alias("_mcc"),
        F.col("amount").cast("decimal(12,2)").alias("amount"),
        strip_ws(F.col("use_chip")).alias("use_chip"),
        strip_ws(F.col("errors")).alias("errors"),
        F.coalesce(F.col("is_refund"), F.lit(False)).alias("is_refund"),
        F.coalesce(F.col("is_online"), F.lit(False)).alias("is_online"),
    ).where(F.col("transaction_id").isNotNull())
    fact = keep_first_if_repeated(fact, "transaction_id")

    joins = [
        (dims.customers, "customer_id", "customer_key", "_client_id"),
        (dims.cards, "card_id", "card_key", "_card_id"),
        (dims.merchants, "merchant_id", "merchant_key", "_merchant_id"),
        (dims.mcc, "mcc_code", "mcc_key", "_mcc"),
        (dims.date, "date", "date_key", "_date"),
    ]
    for dim, bk, sk, fk in joins:
        side = broadcast_if_bounded(dim.select(F.col(bk).alias(fk), F.col(sk)))
        fact = fact.join(side, fk, "left")
    texts = {"is_refund": F.col("is_refund"), "has_error": F.col("errors").isNotNull(), "is_online": F.col("is_online")}
    return fact.select(*[_yes_no(texts[c]).alias(c) if c in texts else c for c in FACT_COLUMNS])
