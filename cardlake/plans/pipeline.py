"""End-to-end pipeline: raw -> transformation -> curated -> marts.

Every layer is written to the layer store and read back before the next one
uses it, so each stage's lineage is cut at a durable Parquet table (a lost
executor re-runs only tasks of the current stage).
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import os
from copy import copy
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.plans import curated as C
from cardlake.plans import customer as CU
from cardlake.plans import finance as FI
from cardlake.plans import merchant as ME
from cardlake.plans import transform as T
from cardlake.plans.limits import LENGTHS
from cardlake.session import checkpoint_root, ensure_conf, input_signature, input_size_bytes, size_shuffle_partitions
from cardlake.sources.fixtures import RAW_INPUTS, raw_tables
from cardlake.sources import csv_io
from cardlake.operators.quality import QualityError, violations
from cardlake.operators.sinks import write_table
from cardlake.sources.layers import LayerStore

DEFAULT_AS_OF = "2025-06-15"

TRANSFORMATION = "transformation"
CURATED = "curated"
MARTS = "marts"
CHECKS = "checks"

#: Compressed input for each shuffle partition: its rows are some ten times as large when they are sorted.
SHUFFLE_BYTES = 8 << 20

#: Part of a fact's rows that may miss a dimension before a run ends with an error.
MAX_MISSING = 0.5


#: Staged tables: their cleaned rows and their rejects come from one write.
SPLIT = ("users_data", "cards_data", "transactions_data")


def split_tables(raw: dict[str, DataFrame], store: LayerStore, as_of: str | _dt.date = DEFAULT_AS_OF,
                 names: tuple[str, ...] = SPLIT) -> dict[str, tuple[DataFrame, DataFrame]]:
    """name -> (cleaned rows, rejected rows), each table staged and written once."""
    stage = {"users_data": lambda df: T.stage_users(df, as_of), "cards_data": T.stage_cards, "transactions_data": T.stage_transactions}
    return {n: store.get_or_build_split(TRANSFORMATION, n, lambda n=n: stage[n](raw[n]), "id") for n in names}


def reject_table(raw: dict[str, DataFrame], store: LayerStore, as_of: str | _dt.date = DEFAULT_AS_OF) -> DataFrame:
    """(table_name, reason, id) of the raw rows that no cleaned table can hold."""
    parts = [T.reject_rows(rejects, name) for name, (_, rejects) in split_tables(raw, store, as_of).items()]
    return _write_rejects(raw, store, parts)


def _write_rejects(raw: dict[str, DataFrame], store: LayerStore, parts: list[DataFrame]) -> DataFrame:
    mcc = T.rejected_mcc(raw["mcc_data"]).select(F.lit("mcc_data").alias("table_name"), "reason", "id")
    for part in parts:
        mcc = mcc.unionByName(part)
    return store.get_or_build(TRANSFORMATION, "rejects", lambda: mcc)


class Layers:
    """Transformation and curated layers, built once per store: a table is
    written when it is first asked for, with the tables it is made of and no others."""

    def __init__(self, store: LayerStore, raw: dict[str, DataFrame], as_of: str | _dt.date = DEFAULT_AS_OF):
        self.store, self._raw, self._as_of = store, raw, as_of

    def _table(self, layer: str, name: str, build, key: str) -> DataFrame:
        return self.store.get_or_build(layer, name, build, key)

    def _split(self, name: str) -> tuple[DataFrame, DataFrame]:
        return split_tables(self._raw, self.store, self._as_of, (name,))[name]

    @cached_property
    def _users(self) -> tuple[DataFrame, DataFrame]:
        return self._split("users_data")

    @cached_property
    def _cards(self) -> tuple[DataFrame, DataFrame]:
        return self._split("cards_data")

    @cached_property
    def _tx(self) -> tuple[DataFrame, DataFrame]:
        return self._split("transactions_data")

    @property
    def users(self) -> DataFrame:
        return self._users[0]

    @property
    def cards(self) -> DataFrame:
        return self._cards[0]

    @property
    def tx(self) -> DataFrame:
        return self._tx[0]

    @cached_property
    def mcc(self) -> DataFrame:
        return self._table(TRANSFORMATION, "mcc_data", lambda: T.clean_mcc(self._raw["mcc_data"]), "code")

    @cached_property
    def rejects(self) -> DataFrame:
        split = zip(SPLIT, (self._users, self._cards, self._tx))
        return _write_rejects(self._raw, self.store, [T.reject_rows(rejected, name) for name, (_, rejected) in split])

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._table(CURATED, "dim_customers", lambda: C.build_dim_customers(self.users), "customer_key")

    @cached_property
    def dim_cards(self) -> DataFrame:
        return self._table(CURATED, "dim_cards", lambda: C.build_dim_cards(self.cards), "card_key")

    @cached_property
    def dim_mcc(self) -> DataFrame:
        return self._table(CURATED, "dim_mcc", lambda: C.build_dim_mcc(self.mcc), "mcc_key")

    @cached_property
    def dim_merchants(self) -> DataFrame:
        return self._table(CURATED, "dim_merchants", lambda: C.build_dim_merchants(self.tx), "merchant_key")

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._table(CURATED, "dim_date", lambda: C.build_dim_date(self.tx), "date_key")

    @cached_property
    def fact(self) -> DataFrame:
        return self._table(CURATED, "fact_transactions", lambda: C.build_fact(self.tx, self.dims()), "transaction_id")

    def dims(self) -> C.Dims:
        return C.Dims(self.dim_customers, self.dim_cards, self.dim_merchants, self.dim_mcc, self.dim_date)


LAYER_TABLES = ("users", "cards", "tx", "mcc", "rejects", "dim_customers", "dim_cards", "dim_mcc", "dim_merchants", "dim_date", "fact")


def build_layers(spark: SparkSession, raw: dict[str, DataFrame], store: LayerStore,
                 as_of: str | _dt.date = DEFAULT_AS_OF) -> Layers:
    """Every table of the transformation and curated layers, written."""
    layers = Layers(store, raw, as_of)
    for name in LAYER_TABLES:
        getattr(layers, name)
    return layers


class MartTables:
    """The mart layer's tables, each written when it is first asked for."""

    def __init__(self, layers: Layers):
        self._layers = layers

    def _table(self, name: str, build, key: str) -> DataFrame:
        return self._layers.store.get_or_build(MARTS, name, build, key)

    @cached_property
    def dim_channel(self) -> DataFrame:
        return self._table("dim_channel", lambda: FI.build_dim_channel(self._layers.fact, FI.V.ONLINE_CHANNEL_SOURCES), "channel_key")

    @cached_property
    def fact_finance(self) -> DataFrame:
        return self._table("fact_finance_transactions", lambda: FI.build_fact_finance(self._layers.fact, self.dim_channel), "transaction_id")

    @cached_property
    def fact_customer(self) -> DataFrame:
        return self._table("fact_customer_transactions", lambda: CU.build_fact_customer(self._layers.fact, self.dim_channel), "transaction_id")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._table("dim_customer", lambda: CU.build_dim_customer(self._layers.dim_customers), "customer_key")

    @cached_property
    def dim_card(self) -> DataFrame:
        return self._table("dim_card", lambda: CU.build_dim_card(self._layers.dim_cards), "card_key")

    @cached_property
    def customer_stats(self) -> DataFrame:
        return self._table("customer_stats", lambda: CU.customer_stats(self.fact_customer, self.dim_customer), "customer_key")


def build_mart_tables(layers: Layers) -> MartTables:
    """Every table of the mart layer, written."""
    marts = MartTables(layers)
    for name in ("dim_channel", "fact_finance", "fact_customer", "dim_customer", "dim_card", "customer_stats"):
        getattr(marts, name)
    return marts


def with_channels(layers: Layers, marts: MartTables, online_sources, tag: str) -> MartTables:
    """The same facts under another grouping of channels: keys do not depend
    on the grouping, so only the few-row channel dimension differs."""
    channel = layers.store.get_or_build(MARTS, f"dim_channel{tag}", lambda: FI.build_dim_channel(layers.fact, online_sources), "channel_key")
    regrouped = copy(marts)
    regrouped.fact_customer, regrouped.fact_finance = marts.fact_customer, marts.fact_finance
    regrouped.dim_channel = channel
    return regrouped


def mart_views(layers: Layers, marts: MartTables) -> dict[str, DataFrame]:
    """All mart outputs as lazy DataFrames (views and CTAS bodies)."""
    ff, fct, ch = marts.fact_finance, marts.fact_customer, marts.dim_channel
    suspicious = CU.suspicious_transactions(fct, marts.customer_stats, layers.dim_date, ch)
    return {
        "finance_monthly_revenue": FI.monthly_revenue(ff, layers.dim_date),
        "finance_refund_summary": FI.refund_summary(ff, layers.dim_date),
        "finance_revenue_by_state": FI.revenue_by_state(ff, layers.dim_merchants),
        "finance_revenue_by_mcc": FI.revenue_by_mcc(ff, layers.dim_mcc),
        "finance_by_channel": FI.by_channel(ff, ch),
        "customer_ltv": CU.customer_ltv(fct, marts.dim_customer, layers.dim_date),
        "customer_channel_behavior": CU.customer_channel_behavior(fct, marts.dim_customer, ch),
        "customer_active_cards": CU.customer_active_cards(fct, marts.dim_customer, marts.dim_card),
        "suspicious_transactions": suspicious,
        "customer_suspicion_profile": CU.customer_suspicion_profile(suspicious),
        "merchant_volume": ME.merchant_volume(layers.fact, layers.dim_merchants),
        "industry_growth_yoy": ME.industry_growth_yoy(layers.fact, layers.dim_date, layers.dim_mcc),
        "merchant_error_rates": ME.merchant_error_rates(layers.fact, layers.dim_merchants),
        "merchant_geo_revenue": ME.merchant_geo_revenue(layers.fact, layers.dim_merchants),
    }


# tables of each layer (the mart outputs of `mart_views` come on top)
STORED = {
    TRANSFORMATION: ("users_data", "cards_data", "mcc_data", "transactions_data", "rejects"),
    CURATED: ("dim_customers", "dim_cards", "dim_mcc", "dim_merchants", "dim_date", "fact_transactions"),
    MARTS: ("dim_channel", "fact_finance_transactions", "fact_customer_transactions", "dim_customer", "dim_card"),
}


def stored_table(store: LayerStore, layer: str, name: str) -> DataFrame:
    """A table of `STORED`, read back."""
    return store.read_split(layer, name, False) if name in SPLIT else store.read(layer, name)


def run_layers(spark: SparkSession, raw: dict[str, DataFrame], out_root: str,
               as_of: str | _dt.date = DEFAULT_AS_OF, input_bytes: int = 0, max_missing: float = MAX_MISSING) -> dict[str, DataFrame]:
    """Full refresh of every layer under `out_root` from the four raw tables.

    Transformation, curated and mart tables are written as Parquet, and so
    are all mart outputs.  The layer tables and every mart output are also
    registered as temporary views under their names, so SQL reaches them; the
    mart outputs are returned too (name -> DataFrame).

    Every write of a layer table observes its row count, rejects, NULL keys,
    missing references and over-long texts; they are written as
    `checks/write_metrics` (also a view), and a NULL key or more than
    `max_missing` of a fact's references missing ends the run with
    `QualityError` before any mart output is written.
    """
    ensure_conf(spark)
    size_shuffle_partitions(spark, input_bytes, SHUFFLE_BYTES)
    store = LayerStore(spark, out_root, refresh=True, lengths=LENGTHS)
    layers = build_layers(spark, raw, store, as_of)
    marts = build_mart_tables(layers)
    metrics = spark.createDataFrame(store.metrics, "table_name string, check_name string, column_name string, rows long")
    write_table(metrics.coalesce(1), store.path(CHECKS, "write_metrics"))
    store.read(CHECKS, "write_metrics").createOrReplaceTempView("write_metrics")
    broken = violations(store.metrics, max_missing)
    if broken:
        raise QualityError("; ".join(broken))
    views = mart_views(layers, marts)
    out = {}
    for name, df in views.items():
        write_table(df, store.path(MARTS, name))
        out[name] = store.read(MARTS, name)
    for layer, names in STORED.items():
        for name in names:
            stored_table(store, layer, name).createOrReplaceTempView(name)
    for name, df in out.items():
        df.createOrReplaceTempView(name)
    return out


def input_paths(sf_dir: str) -> list[str]:
    """The driver tables that the raw tables are derived from."""
    tables = sorted({t for ts in RAW_INPUTS.values() for t in ts})
    return [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables]


def run_pipeline(spark: SparkSession, sf_dir: str, out_root: str,
                 as_of: str | _dt.date = DEFAULT_AS_OF) -> dict[str, DataFrame]:
    """Every layer from the raw tables derived from the test tables in `sf_dir`."""
    size = input_size_bytes(spark, input_paths(sf_dir))
    return run_layers(spark, raw_tables(spark, sf_dir), out_root, as_of, size)


def run_pipeline_from_csv(spark: SparkSession, csv_dir: str, out_root: str,
                          as_of: str | _dt.date = DEFAULT_AS_OF, multiline: bool = False) -> dict[str, DataFrame]:
    """Every layer from the four raw CSV files in `csv_dir` (header, comma,
    UTF-8; each file loads into the table its name names, e.g.
    `Users_Data.csv` -> users_data; arrival order = file order; `multiline`: see
    `csv_io.read_raw_csv`)."""
    files = csv_io.list_csv_files(spark, csv_dir)
    raw = csv_io.ingest_files(spark, files, multiline=multiline)
    missing = sorted(set(RAW_INPUTS) - set(raw))
    if missing:
        raise ValueError(f"no CSV file for {missing} in {csv_dir}")
    return run_layers(spark, raw, out_root, as_of, input_size_bytes(spark, list(files.values())))


# ---------------------------------------------------------------- per-session cache
_CODE_HASH = None
_CACHE: dict = {}


def _code_fingerprint() -> str:
    global _CODE_HASH
    if _CODE_HASH is None:
        h = hashlib.sha1()
        base = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        for dirpath, _, files in sorted(os.walk(base)):
            for f in sorted(files):
                if f.endswith(".py"):
                    with open(os.path.join(dirpath, f), "rb") as fh:
                        h.update(fh.read())
        _CODE_HASH = h.hexdigest()[:12]
    return _CODE_HASH


def store_for(spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF) -> LayerStore:
    """Layer store for the test tables in `sf_dir` under the session's
    checkpoint folder, keyed by the input files (names, sizes, modification
    times), the as-of date and the code: a changed input is a new store."""
    ensure_conf(spark)
    files = input_signature(spark, input_paths(sf_dir))
    key = hashlib.sha1(f"{files}|{as_of}|{_code_fingerprint()}".encode()).hexdigest()[:16]
    return LayerStore(spark, f"{checkpoint_root(spark)}/cardlake-layers/{key}")


def layers_for(spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF) -> Layers:
    """Layers for the test tables in `sf_dir`, each table materialised once per session."""
    store = store_for(spark, sf_dir, as_of)
    cache_key = (spark.sparkContext.applicationId, id(spark), store.root)
    if cache_key not in _CACHE:
        size_shuffle_partitions(spark, input_size_bytes(spark, input_paths(sf_dir)), SHUFFLE_BYTES)
        _CACHE[cache_key] = Layers(store, raw_tables(spark, sf_dir), as_of)
    return _CACHE[cache_key]


def marts_for(spark: SparkSession, sf_dir: str) -> tuple[Layers, MartTables]:
    layers = layers_for(spark, sf_dir)
    if not hasattr(layers, "marts"):
        layers.marts = MartTables(layers)
    return layers, layers.marts
