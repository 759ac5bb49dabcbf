"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only below both bounds (checked before hinting).
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024  # Catalyst's size estimate of the projected side
_UNKNOWN_SIZE = 1 << 62  # estimates at or above this are Spark's "unknown" default


def estimated_size_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of `df` (file sizes scaled to the projected
    columns for a Parquet scan); None when unknown."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no JVM plan access (e.g. a remote session)
        return None
    return None if size >= _UNKNOWN_SIZE else size


def row_count_at_most(df: DataFrame, limit: int) -> bool:
    """True when df has <= limit rows (reads at most limit + 1 rows per partition)."""
    return df.limit(limit + 1).count() <= limit


def broadcast_if_bounded(df: DataFrame, max_rows: int | None = None,
                         max_bytes: int | None = None) -> DataFrame:
    """Broadcast hint only after checking the size.

    A known size estimate above `max_bytes` rules the broadcast out without
    reading anything; otherwise the row count is checked (at most
    `max_rows` + 1 rows are read).  A small estimate alone is not enough:
    Parquet sizes are compressed, and a well-compressed column can hold far
    more rows than its bytes suggest, so the count is the size proof.  Above either bound the plain DataFrame is
    returned and Spark plans a shuffle join (AQE may still switch to
    broadcast from runtime sizes, and splits skewed partitions).  Use on
    materialised tables, where both checks are cheap.
    """
    max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    est = estimated_size_bytes(df)
    if est is not None and est > max_bytes:
        return df
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df
