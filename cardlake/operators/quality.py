"""Data-quality checks as Spark jobs (the source's table constraints and
printed counts, re-aimed as result tables).

Each check is one or two aggregations over the whole table; nothing is
collected row by row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FACT_KEYS = ("customer_key", "card_key", "merchant_key", "mcc_key", "date_key")


def check_primary_key(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """One row: total rows, rows with a NULL key part, keys occurring more than
    once and the surplus rows they carry (0/0/0 means the key is a primary key)."""
    keys = list(keys)
    null_key = F.greatest(*[F.col(k).isNull().cast("int") for k in keys]) if len(keys) > 1 \
        else F.col(keys[0]).isNull().cast("int")
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(null_key).alias("_null"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("_null") == 1, F.col("_n"))), F.lit(0)).cast("long").alias("null_key_rows"),
        F.count_if((F.col("_n") > 1) & (F.col("_null") == 0)).cast("long").alias("duplicate_keys"),
        F.coalesce(F.sum(F.when((F.col("_n") > 1) & (F.col("_null") == 0), F.col("_n") - 1)), F.lit(0))
        .cast("long").alias("duplicate_rows"),
    )


def check_foreign_key(child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str) -> DataFrame:
    """One row: child rows whose non-NULL `fk` has no parent, and how many
    distinct such keys.  Rows are counted per key value first (map-side
    combined, so a hot key is one row per task), then only the distinct
    child keys are anti-joined against the parent keys."""
    per_key = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.select(F.col(pk).alias(fk)).distinct()
    bad = per_key.join(parents, fk, "left_anti")
    return bad.agg(F.lit(name).alias("constraint_name"),
                   F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("violating_rows"),
                   F.count(F.lit(1)).cast("long").alias("violating_keys"))


def fact_missing_keys(fact: DataFrame, keys: Sequence[str] = FACT_KEYS) -> DataFrame:
    """Fact row count and, per surrogate key, rows where the lookup missed."""
    return fact.agg(
        F.count(F.lit(1)).cast("long").alias("fact_rows"),
        *[F.count_if(F.col(k).isNull()).cast("long").alias(f"missing_{k}") for k in keys],
    )


def check_schema_limits(df: DataFrame, table: str, max_lengths: Mapping[str, int],
                        decimal_limits: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """(table_name, column_name, check_name, violating_rows): rows longer
    than the declared VARCHAR length, and rows that overflow a declared
    DECIMAL(p, s).  One aggregate over the table, unpivoted to long form."""
    aggs = []
    for c, n in max_lengths.items():
        aggs.append(F.count_if(F.length(F.col(c)) > n).cast("long").alias(f"{c}|over_length"))
    for c, (p, s) in (decimal_limits or {}).items():
        bound = 10 ** (p - s)
        aggs.append(F.count_if(F.abs(F.col(c)) >= bound).cast("long").alias(f"{c}|overflow"))
    wide = df.agg(*aggs)
    long = wide.unpivot([], wide.columns, "check", "violating_rows")
    parts = F.split(F.col("check"), r"\|")
    return long.select(F.lit(table).alias("table_name"), parts[0].alias("column_name"),
                       parts[1].alias("check_name"), "violating_rows")


class QualityError(RuntimeError):
    """A finished write breaks a check that must hold."""


def write_metrics(columns: Sequence[str], key: str | None, lengths: Mapping[str, int], stored: Column | None = None) -> list[Column]:
    """Aggregates that a running write observes (no scan of their own), named
    `check|column`: rows, rejected rows, NULLs of the key and of every
    `*_key` column, texts over their declared length.  `stored` tells the
    stored rows of a staged table from its rejects."""
    kept = F.lit(True) if stored is None else stored
    out = [F.count_if(kept).alias("rows|")]
    if stored is not None:
        out.append(F.count_if(~kept).alias("rejected|"))
    keys = dict.fromkeys([*([key] if key else []), *[c for c in columns if c.endswith("_key")]])
    out += [F.count_if(kept & F.col(c).isNull()).alias(f"{'null_key' if c == key else 'missing'}|{c}") for c in keys]
    out += [F.count_if(kept & (F.length(F.col(c)) > n)).alias(f"over_length|{c}") for c, n in lengths.items() if c in columns]
    return out


def violations(metrics: Sequence[tuple[str, str, str, int]], max_missing: float) -> list[str]:
    """What must stop a run: a NULL key of a curated or mart table, and a
    reference that misses its dimension in more than `max_missing` of the rows.
    Over-long texts are reported, not fatal."""
    rows = {table: n for table, check, _, n in metrics if check == "rows"}
    out = []
    for table, check, column, n in metrics:
        if check == "null_key" and n and not table.startswith("transformation."):
            out.append(f"{table}.{column}: {n} NULL keys")
        if check == "missing" and n > max_missing * rows[table]:
            out.append(f"{table}.{column}: {n} of {rows[table]} rows without a reference")
    return out


def schema_limit_rejects(df: DataFrame, max_lengths: Mapping[str, int]) -> DataFrame:
    """Rows that break any declared length (the reject table)."""
    bad = None
    for c, n in max_lengths.items():
        cond = F.coalesce(F.length(F.col(c)) > n, F.lit(False))
        bad = cond if bad is None else (bad | cond)
    return df.where(bad)


def stage_row_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """(stage, rows) for each stage: one count aggregate per stage, unioned."""
    parts = [df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).cast("long").alias("rows"))
             for name, df in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cleaning_map(df: DataFrame, raw_cols: Sequence[str], clean_cols: Sequence[str]) -> DataFrame:
    """Each distinct (raw value(s), cleaned value(s)) pair and its row count:
    what the cleaner did to every spelling, over the whole table (one
    map-side-combined aggregation)."""
    return df.groupBy(*raw_cols, *clean_cols).agg(F.count(F.lit(1)).cast("long").alias("rows"))
