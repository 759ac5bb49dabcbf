"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator key.

Layers are built once per session and input (see `pipeline.layers_for`) and
every query reads them; each returns `comparable(df)`: integers as BIGINT,
decimals and doubles as DOUBLE, dates/timestamps as ISO text, so the result
compares value-for-value with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.operators import quality as Q
from cardlake.operators.dedup import dedup_report, keep_first
from cardlake.operators.keys import dense_key
from cardlake.operators.sinks import insert_if_absent, sanitize_missing
from cardlake.plans.limits import LENGTHS
from cardlake.plans import curated as C
from cardlake.plans import customer as CU
from cardlake.plans import finance as FI
from cardlake.plans import merchant as ME
from cardlake.plans import transform as TR
from cardlake.plans.pipeline import DEFAULT_AS_OF, layers_for, marts_for, with_channels
from cardlake.session import ensure_conf, scratch_dir, shuffles_removed
from cardlake.sources import csv_io
from cardlake.sources.fixtures import raw_table
from cardlake.streaming import incremental as INC


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c, t = F.col(f.name), f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("long")
        elif isinstance(t, (T.DecimalType, T.FloatType, T.DoubleType)):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


Query = Callable[[SparkSession, str], DataFrame]


def _layer(attr: str) -> Query:
    return lambda spark, sf: comparable(getattr(layers_for(spark, sf), attr))


def _mart_table(attr: str) -> Query:
    def run(spark, sf):
        _, marts = marts_for(spark, sf)
        return comparable(getattr(marts, attr))
    return run


def _view(fn) -> Query:
    def run(spark, sf):
        layers, marts = marts_for(spark, sf)
        return comparable(fn(layers, marts))
    return run


def _refund_signed(layers, marts):
    ff = FI.build_fact_finance(FI.signed_amount(layers.fact), marts.dim_channel, "signed_amount")
    return FI.refund_summary(ff, layers.dim_date)


def _channel_online(spark, sf):
    layers, marts = marts_for(spark, sf)
    marts = with_channels(layers, marts, ("Online",), "_online")
    return comparable(CU.customer_channel_behavior(marts.fact_customer, marts.dim_customer, marts.dim_channel))


def _suspicious(layers, marts):
    return CU.suspicious_transactions(marts.fact_customer, marts.customer_stats, layers.dim_date, marts.dim_channel)


def _spend_stats(layers, marts):
    s = CU.customer_spend_stats(marts.fact_customer)
    return s.select("customer_key", F.round("avg_spend", 4).alias("avg_spend"),
                    F.round("stddev_spend", 4).alias("stddev_spend"), "txn_count")


def _csv_roundtrip(table: str) -> Query:
    """Raw table -> CSV files -> ingest reader (A1, A2): must give the same rows,
    NULL and '' kept apart."""
    def run(spark, sf):
        raw = raw_table(spark, sf, table)
        path = scratch_dir(spark, f"{table}.csv")
        csv_io.write_raw_csv(raw, path)
        return comparable(csv_io.read_raw_csv(spark, path, csv_io.with_seq(csv_io.RAW_SCHEMAS[table])))
    return run


def _bulk_roundtrip(spark, sf):
    """Fact table through a bulk-load CSV with the \\N NULL marker."""
    fact = layers_for(spark, sf).fact
    path = scratch_dir(spark, "fact_bulk")
    csv_io.write_bulk_csv(fact, path)
    return comparable(csv_io.read_bulk_csv(spark, path, fact.schema))


def _bulk_empty_null_roundtrip(spark, sf):
    """Cleaned transactions through a bulk-load CSV whose NULL marker is the
    empty string (A12): empty text comes back as NULL."""
    tx = layers_for(spark, sf).tx
    path = scratch_dir(spark, "tx_bulk_empty")
    csv_io.write_bulk_csv(tx, path, null_marker="")
    return comparable(csv_io.read_bulk_csv(spark, path, tx.schema, null_marker=""))


def _stream_load(spark, sf):
    """Raw transactions landed as files, loaded by the streaming job twice
    (the second run must add nothing)."""
    base = scratch_dir(spark, "stream")
    INC.land_raw_transactions(raw_table(spark, sf, "transactions_data"), f"{base}/landing")
    for _ in range(2):
        q = INC.stream_tx_load(spark, f"{base}/landing", f"{base}/target", f"{base}/checkpoint")
        q.awaitTermination()
    return comparable(spark.read.parquet(f"{base}/target").drop(INC.BUCKET))


def _dedup_report(spark, sf):
    parts = [dedup_report(raw_table(spark, sf, t), "id", t) for t in ("users_data", "cards_data", "transactions_data")]
    return comparable(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _tables(spark, sf) -> dict[str, DataFrame]:
    """Every table of every layer under `layer.name`, the raw ones included."""
    l, m = marts_for(spark, sf)
    out = {f"raw.{t}": raw_table(spark, sf, t) for t in csv_io.RAW_SCHEMAS}
    out |= {"transformation.users_data": l.users, "transformation.cards_data": l.cards,
            "transformation.mcc_data": l.mcc, "transformation.transactions_data": l.tx,
            "transformation.rejects": l.rejects,
            "curated.dim_customers": l.dim_customers, "curated.dim_cards": l.dim_cards,
            "curated.dim_mcc": l.dim_mcc, "curated.dim_merchants": l.dim_merchants,
            "curated.dim_date": l.dim_date, "curated.fact_transactions": l.fact,
            "marts.dim_channel": m.dim_channel, "marts.dim_customer": m.dim_customer, "marts.dim_card": m.dim_card,
            "marts.fact_finance_transactions": m.fact_finance,
            "marts.fact_customer_transactions": m.fact_customer}
    return out


# (table, key): declared primary and unique keys, and the same keys on the raw tables, which do not hold there
KEYS = (
    ("raw.users_data", "id"), ("raw.cards_data", "id"), ("raw.mcc_data", "code"), ("raw.transactions_data", "id"),
    ("transformation.users_data", "id"), ("transformation.cards_data", "id"), ("transformation.mcc_data", "code"),
    ("transformation.transactions_data", "id"),
    ("curated.dim_customers", "customer_key"), ("curated.dim_customers", "customer_id"),
    ("curated.dim_cards", "card_key"), ("curated.dim_cards", "card_id"),
    ("curated.dim_mcc", "mcc_key"), ("curated.dim_mcc", "mcc_code"),
    ("curated.dim_merchants", "merchant_key"), ("curated.dim_merchants", "merchant_id"),
    ("curated.dim_date", "date_key"), ("curated.dim_date", "date"), ("curated.fact_transactions", "transaction_id"),
    ("marts.dim_channel", "channel_key"), ("marts.dim_channel", "source_use_chip"),
    ("marts.dim_customer", "customer_key"), ("marts.dim_card", "card_key"),
    ("marts.fact_finance_transactions", "transaction_id"), ("marts.fact_customer_transactions", "transaction_id"),
)

# (child, key, parent, key): declared foreign keys, the star's other references, and those of the cleaned
# transactions, some of which name no card, user or category
REFERENCES = (
    ("marts.fact_customer_transactions", "customer_key", "marts.dim_customer", "customer_key"),
    ("marts.fact_customer_transactions", "card_key", "marts.dim_card", "card_key"),
    ("marts.fact_customer_transactions", "channel_key", "marts.dim_channel", "channel_key"),
    ("marts.fact_finance_transactions", "channel_key", "marts.dim_channel", "channel_key"),
    ("marts.fact_finance_transactions", "date_key", "curated.dim_date", "date_key"),
    ("marts.fact_finance_transactions", "merchant_key", "curated.dim_merchants", "merchant_key"),
    ("marts.fact_finance_transactions", "mcc_key", "curated.dim_mcc", "mcc_key"),
    ("curated.fact_transactions", "date_key", "curated.dim_date", "date_key"),
    ("transformation.transactions_data", "client_id", "transformation.users_data", "id"),
    ("transformation.transactions_data", "card_id", "transformation.cards_data", "id"),
    ("transformation.transactions_data", "mcc", "transformation.mcc_data", "code"),
)


def _primary_keys(spark, sf):
    t = _tables(spark, sf)
    return comparable(_union([Q.check_primary_key(t[name], [key], name) for name, key in KEYS]))


def _foreign_keys(spark, sf):
    t = _tables(spark, sf)
    return comparable(_union([Q.check_foreign_key(t[c], k, t[p], pk, f"{c}.{k}") for c, k, p, pk in REFERENCES]))


def _stage_counts(spark, sf):
    return comparable(Q.stage_row_counts(_tables(spark, sf)))


def _schema_rejects(spark, sf):
    """K4 reject table: rows that break a declared column length (the table and its key)."""
    t = _tables(spark, sf)
    return comparable(_union([
        Q.schema_limit_rejects(t[name], limits).select(F.lit(name).alias("table_name"), F.col(key).cast("long").alias("id"))
        for name, (key, limits) in LENGTHS.items()]))


def _schema_limits(spark, sf):
    """Declared lengths of every table, and the amounts before their cast to DECIMAL(10,2)."""
    t = _tables(spark, sf)
    before = TR.transaction_amounts(t["raw.transactions_data"])
    checks = [Q.check_schema_limits(t[name], name, limits) for name, (_, limits) in LENGTHS.items()]
    return comparable(_union([*checks, Q.check_schema_limits(before, "transformation.transactions_data", {}, {"amount": (10, 2)})]))


def _rejects(spark, sf):
    """Raw rows that no cleaned table can hold, with the reason."""
    return comparable(layers_for(spark, sf).rejects)


FIRST_FILE = "merchant_id LIKE '%7'"


def _arrival_order(spark, sf):
    """A1, A4: two deliveries in files of unequal sizes.  The small first one
    repeats ids of the second with other amounts and with line ends inside
    quoted fields; keep-first by arrival over both must take its rows.

    The raw table is made once, for the second delivery, which the first one
    is taken from.  Both are compressed: a file with line ends in its fields
    is one task either way."""
    raw = keep_first(raw_table(spark, sf, "transactions_data"), ["id"], ["_seq"]).drop("_seq")
    schema = csv_io.RAW_SCHEMAS["transactions_data"]
    base = scratch_dir(spark, "arrival")
    first, second = f"{base}/0-first.csv", f"{base}/1-second.csv"
    with shuffles_removed(spark):
        csv_io.write_raw_csv(raw, second, compression="gzip")
    late = csv_io.read_raw_csv(spark, second, schema, with_arrival_seq=False, multiline=True)
    early = late.where(FIRST_FILE).withColumn("amount", F.lit("$1.00")).withColumn("errors", F.lit("first\nline"))
    csv_io.write_raw_csv(early, first, compression="gzip")
    both = csv_io.read_raw_csv(spark, [first, second], schema, multiline=True)
    # dealt by id before keep-first sorts them: an id has two rows at most here, so nothing is lost by not
    # combining where files are read, and a task that reads many compressed files holds none of their rows
    return comparable(keep_first(both.repartition("id"), ["id"], ["_seq"]).drop("_seq"))


# ---------------------------------------------------------------- cleaning maps
def _clean_map(table: str, raw_cols: tuple, clean_cols: tuple) -> Query:
    """Raw spelling -> cleaned value(s) with row counts, for one cleaner, over
    the whole raw table (the cleaning job runs once with the raw columns
    carried through)."""
    def run(spark, sf):
        raw = raw_table(spark, sf, table)
        if table == "users_data":
            cleaned = TR.clean_users(raw, DEFAULT_AS_OF, carry=raw_cols)
        elif table == "cards_data":
            cleaned = TR.clean_cards(raw, carry=raw_cols)
        else:
            cleaned = TR.clean_transactions(raw, carry=raw_cols)
        return comparable(Q.cleaning_map(cleaned, [f"raw_{c}" for c in raw_cols], clean_cols))
    return run


def _mcc_code_map(spark, sf):
    """H25 over every raw MCC row (rows without a valid code included)."""
    raw = raw_table(spark, sf, "mcc_data")
    code = TR.mcc_code(F.col("code"))
    return comparable(Q.cleaning_map(raw.select(F.col("code").alias("raw_code"), code.alias("code")),
                                     ["raw_code"], ["code"]))


def _mask_map(spark, sf):
    """Cleaned card number -> masked number, on the card dimension's input."""
    cards = layers_for(spark, sf).cards
    masked = cards.select("card_number", C.mask_card_number(F.col("card_number")).alias("masked_card_number"))
    return comparable(Q.cleaning_map(masked, ["card_number"], ["masked_card_number"]))


def _fuzzy(spark, sf):
    """Distinct spellings no alias resolved -> closest canonical label."""
    return comparable(TR.fuzzy_matches(raw_table(spark, sf, "users_data")))


# ---------------------------------------------------------------- operators on whole tables
def _keep_first(table: str) -> Query:
    """First arrival per id over the whole raw table."""
    return lambda spark, sf: comparable(keep_first(raw_table(spark, sf, table), ["id"], ["_seq"]))


def _surrogate_key(spark, sf):
    """dense 1..n key over the largest cleaned table, no single-partition window."""
    tx = layers_for(spark, sf).tx
    return comparable(dense_key(tx.select("id"), "id", "tx_key"))


# two overlapping deliveries of the raw feed (by the raw date text)
CHUNK_A = "date < '1999-01-01'"
CHUNK_B = "date >= '1998-07-01' OR date IS NULL"


def _insert_if_absent(spark, sf):
    """A10: two overlapping raw chunks, each cleaned on its own (keep-first
    inside the chunk, then the amount filter); the first is loaded, the second
    inserted where its id is absent.  Returns the target after both loads."""
    raw = raw_table(spark, sf, "transactions_data")
    path = scratch_dir(spark, "insert_if_absent")
    TR.clean_transactions(raw.where(CHUNK_A)).write.mode("overwrite").parquet(path)
    fresh = insert_if_absent(TR.clean_transactions(raw.where(CHUNK_B)), spark.read.parquet(path), "id", order=None)
    fresh.write.mode("append").parquet(path)
    return comparable(spark.read.parquet(path))


def _full_refresh(spark, sf):
    """A table written over an older, different table at the same path
    holds exactly the new rows."""
    l = layers_for(spark, sf)
    path = scratch_dir(spark, "full_refresh")
    l.dim_mcc.write.mode("overwrite").parquet(path)
    l.users.write.mode("overwrite").parquet(path)
    return comparable(spark.read.parquet(path))


def _sanitize(spark, sf):
    """NaN -> NULL before the sink, on the customer dimension."""
    return comparable(sanitize_missing(layers_for(spark, sf).dim_customers))


MANIFEST_FILES = {"Users_Data.csv": "users_data", "Cards_Data.csv": "cards_data",
                  "MCC_Data.csv": "mcc_data", "Transactions_Data.csv": "transactions_data"}


def _file_manifest(spark, sf):
    """A3/A4: four CSV files land in one folder; each is loaded into the
    table its file name names.  Returns rows and distinct ids per table."""
    folder = scratch_dir(spark, "landing")
    for file_name, table in MANIFEST_FILES.items():
        csv_io.write_raw_csv(raw_table(spark, sf, table), f"{folder}/{file_name}")
    loaded = csv_io.ingest_files(spark, {f: f"{folder}/{f}" for f in MANIFEST_FILES},
                                 {t: csv_io.with_seq(s) for t, s in csv_io.RAW_SCHEMAS.items()})
    parts = [df.agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).cast("long").alias("rows"),
                    F.count_distinct(df.columns[1]).cast("long").alias("distinct_keys"))
             for t, df in sorted(loaded.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return comparable(out)


QUERIES: dict[str, Query] = {
    # transformation layer
    "clean_users": _layer("users"),
    "clean_cards": _layer("cards"),
    "clean_mcc": _layer("mcc"),
    "clean_transactions": _layer("tx"),
    # curated layer
    "dim_customers": _layer("dim_customers"),
    "dim_cards": _layer("dim_cards"),
    "dim_mcc": _layer("dim_mcc"),
    "dim_merchants": _layer("dim_merchants"),
    "dim_date": _layer("dim_date"),
    "fact_transactions": _layer("fact"),
    "fact_missing_keys": lambda spark, sf: comparable(Q.fact_missing_keys(layers_for(spark, sf).fact)),
    # finance mart
    "dim_channel": _mart_table("dim_channel"),
    "fact_finance_transactions": _mart_table("fact_finance"),
    "fact_customer_transactions": _mart_table("fact_customer"),
    "finance_monthly_revenue": _view(lambda l, m: FI.monthly_revenue(m.fact_finance, l.dim_date)),
    "finance_refund_summary": _view(lambda l, m: FI.refund_summary(m.fact_finance, l.dim_date)),
    "finance_refund_summary_signed": _view(_refund_signed),
    "finance_revenue_by_state": _view(lambda l, m: FI.revenue_by_state(m.fact_finance, l.dim_merchants)),
    "finance_revenue_by_mcc": _view(lambda l, m: FI.revenue_by_mcc(m.fact_finance, l.dim_mcc)),
    "finance_by_channel": _view(lambda l, m: FI.by_channel(m.fact_finance, m.dim_channel)),
    # customer mart
    "customer_ltv": _view(lambda l, m: CU.customer_ltv(m.fact_customer, m.dim_customer, l.dim_date)),
    "customer_channel_behavior": _view(
        lambda l, m: CU.customer_channel_behavior(m.fact_customer, m.dim_customer, m.dim_channel)),
    "customer_channel_behavior_online": _channel_online,
    "customer_active_cards": _view(lambda l, m: CU.customer_active_cards(m.fact_customer, m.dim_customer, m.dim_card)),
    "customer_spend_stats": _view(_spend_stats),
    "suspicious_transactions": _view(_suspicious),
    "customer_suspicion_profile": _view(lambda l, m: CU.customer_suspicion_profile(_suspicious(l, m))),
    # merchant mart
    "merchant_volume": _view(lambda l, m: ME.merchant_volume(l.fact, l.dim_merchants)),
    "industry_growth_yoy": _view(lambda l, m: ME.industry_growth_yoy(l.fact, l.dim_date, l.dim_mcc)),
    "merchant_error_rates": _view(lambda l, m: ME.merchant_error_rates(l.fact, l.dim_merchants)),
    "merchant_geo_revenue": _view(lambda l, m: ME.merchant_geo_revenue(l.fact, l.dim_merchants)),
    # sources / sinks (A1-A2, A11), incremental load
    "ingest_csv_roundtrip_users": _csv_roundtrip("users_data"),
    "ingest_csv_roundtrip_transactions": _csv_roundtrip("transactions_data"),
    "ingest_csv_roundtrip_cards": _csv_roundtrip("cards_data"),
    "ingest_csv_roundtrip_mcc": _csv_roundtrip("mcc_data"),
    "csv_null_marker_roundtrip": _bulk_roundtrip,
    "csv_empty_null_roundtrip": _bulk_empty_null_roundtrip,
    "stream_tx_load": _stream_load,
    # de-duplication report and data-quality checks
    "dedup_report": _dedup_report,
    "check_primary_key": _primary_keys,
    "check_foreign_key": _foreign_keys,
    "check_schema_limits": _schema_limits,
    "schema_limit_rejects": _schema_rejects,
    "stage_row_counts": _stage_counts,
    "rejected_rows": _rejects,
    "ingest_arrival_order": _arrival_order,
    # whole-table operators
    "dedup_keep_first_users": _keep_first("users_data"),
    "dedup_keep_first_cards": _keep_first("cards_data"),
    "dedup_keep_first_transactions": _keep_first("transactions_data"),
    "surrogate_key": _surrogate_key,
    "ingest_file_manifest": _file_manifest,
    "full_refresh_roundtrip": _full_refresh,
    "insert_if_absent": _insert_if_absent,
    "sanitize_missing": _sanitize,
    # cleaning maps: raw spelling -> cleaned value, rows
    "clean_users_money": _clean_map("users_data", ("per_capita_income", "yearly_income", "total_debt"),
                                    ("per_capita_income", "yearly_income", "total_debt")),
    "clean_users_gender": _clean_map("users_data", ("gender",), ("gender",)),
    "clean_users_employment": _clean_map("users_data", ("employment_status",), ("employment_status",)),
    "clean_users_education": _clean_map("users_data", ("education_level",), ("education_level",)),
    "fuzzy_canonicalize": _fuzzy,
    "title_case": _clean_map("users_data", ("address",), ("address",)),
    "clean_users_ranges": _clean_map("users_data", ("birth_month", "birth_year", "retirement_age", "credit_score",
                                                    "num_credit_cards", "latitude", "longitude"),
                                     ("birth_month", "birth_year", "retirement_age", "credit_score",
                                      "num_credit_cards", "latitude", "longitude")),
    "customer_age": _clean_map("users_data", ("birth_year", "birth_month", "current_age"), ("current_age",)),
    "clean_cards_money": _clean_map("cards_data", ("credit_limit",), ("credit_limit",)),
    "clean_cards_dates": _clean_map("cards_data", ("expires", "acct_open_date"), ("expires", "acct_open_date")),
    "clean_cards_flags": _clean_map("cards_data", ("has_chip", "card_on_dark_web"), ("has_chip", "card_on_dark_web")),
    "clean_cards_categories": _clean_map("cards_data", ("card_brand", "card_type", "issuer_bank_type",
                                                        "issuer_risk_rating"),
                                         ("card_brand", "card_type", "issuer_bank_type", "issuer_risk_rating")),
    "clean_cards_bank": _clean_map("cards_data", ("issuer_bank_name", "issuer_bank_state"),
                                   ("issuer_bank_name", "issuer_bank_state")),
    "clean_cards_number": _clean_map("cards_data", ("card_number", "cvv"), ("card_number", "cvv")),
    "mask_card_number": _mask_map,
    "clean_mcc_code": _mcc_code_map,
    "tx_refund_split": _clean_map("transactions_data", ("amount",), ("amount", "refund_amount", "is_refund")),
    "tx_date_parts": _clean_map("transactions_data", ("date",),
                                ("date", "transaction_year", "transaction_month", "transaction_quarter",
                                 "transaction_hour", "day_of_week")),
    "tx_online_rules": _clean_map("transactions_data", ("use_chip", "merchant_city"),
                                  ("use_chip", "merchant_city", "is_online")),
    "tx_state_zip": _clean_map("transactions_data", ("merchant_state", "zip", "merchant_city"),
                               ("merchant_state", "zip")),
}



def _with_session_conf(fn: Query) -> Query:
    """Every query first applies the settings the plans rely on (UTC session
    time zone, AQE with skew-join splitting) to whatever session it gets."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_conf(spark)
        return fn(spark, sf_dir)
    run.__doc__ = fn.__doc__
    return run


QUERIES = {k: _with_session_conf(v) for k, v in QUERIES.items()}

FLAGSHIP = "finance_monthly_revenue"
