"""Sink operators: insert-if-absent, missing-value normalising, schema probe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.operators.dedup import keep_first


def insert_if_absent(batch: DataFrame, target: DataFrame | None, key: str,
                     order: Sequence[str] | None = ("_seq",)) -> DataFrame:
    """Rows of `batch` to append so that `key` stays unique in the target.

    Rows with a NULL key are left out (a key column holds none; callers send
    them to a reject table).  Keep-first inside the batch (by `order`;
    `order=None` when the batch is already unique by key, which skips that
    shuffle), then drop keys the target already holds (left anti join on the
    key column only).
    """
    batch = batch.where(F.col(key).isNotNull())
    if order is None:
        fresh = batch
    else:
        order = [c for c in order if c in batch.columns]
        fresh = keep_first(batch, [key], order) if order else batch.dropDuplicates([key])
    if target is None:
        return fresh
    return fresh.join(target.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def sanitize_missing(df: DataFrame) -> DataFrame:
    """NaN -> NULL in floating columns (no stage may emit NaN)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None) -> None:
    """The one way a cleaned table reaches storage: NaN never does."""
    writer = sanitize_missing(df).write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def schema_probe(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types without reading data (`LIMIT 0` analogue)."""
    return [(f.name, f.dataType.simpleString()) for f in df.limit(0).schema.fields]
