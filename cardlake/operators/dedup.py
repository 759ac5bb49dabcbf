"""Keep-first de-duplication and per-group mode.

Both are written as aggregations, not windows: a window sends every row of a
key to one task, while an aggregation combines map-side first, so a key that
holds a third of all rows still reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per `keys` value: the row with the smallest `order` tuple.

    NULL keys form one group (like pandas `drop_duplicates`).  `order` must be
    non-NULL (an arrival sequence); rows equal on it must be equal rows.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = order + rest
    picked = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_first"))
    return picked.select(*[F.col(c) for c in keys],
                         *[F.col(f"_first.{c}").alias(c) for c in fields]).select(*df.columns)


def dedup_report(df: DataFrame, key: str, label: str) -> DataFrame:
    """rows, distinct keys and duplicates removed by keep-first, in one aggregate."""
    return df.agg(
        F.lit(label).alias("stage"),
        F.count(F.lit(1)).alias("rows_before"),
        (F.count_distinct(F.col(key)) + F.max(F.col(key).isNull().cast("int"))).alias("rows_after"),
    ).withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after"))


def keep_first_if_repeated(df: DataFrame, key: str) -> DataFrame:
    """Guard for a business key that earlier stages made unique: one row per
    key, the smallest by its other columns.  The check counts keys only, so
    the whole rows are shuffled only when a key really repeats."""
    if not df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").limit(1).count():
        return df
    return keep_first(df, [key], [c for c in df.columns if c != key])


def mode_per_group(df: DataFrame, group: str, attrs: Sequence[str], count_col: str = "cnt") -> DataFrame:
    """Most frequent `attrs` tuple per `group` (NULLs are values).

    Ties: smaller attrs first, each ascending with NULLs last.  Two
    aggregations: count per tuple (map-side combined), then pick per group.
    """
    attrs = list(attrs)
    counts = df.groupBy(group, *attrs).agg(F.count(F.lit(1)).alias(count_col))
    rank = [(-F.col(count_col)).alias("_neg")]
    for i, a in enumerate(attrs):
        rank += [F.col(a).isNull().alias(f"_n{i}"), F.col(a).alias(f"_v{i}")]
    best = counts.groupBy(group).agg(F.min(F.struct(*rank, F.col(count_col))).alias("_best"))
    return best.select(group, *[F.col(f"_best._v{i}").alias(a) for i, a in enumerate(attrs)],
                       F.col(f"_best.{count_col}").alias(count_col))
