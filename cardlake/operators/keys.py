"""Dense surrogate keys without a single-partition window.

`row_number() OVER (ORDER BY k)` pulls the whole table into one task.  Here:
range-partition on the business key and sort inside each partition; persist
that (with partition id and in-partition position) as a scratch table so both
uses below see the same rows; count rows per partition (a
table with one row per partition - its size is bounded by the partition
count, so broadcasting it is safe); the key is the running offset of the
partition plus the position inside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.session import write_scratch

_POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | position


def dense_key(df: DataFrame, order_col: str, key_name: str) -> DataFrame:
    """Add `key_name` = 1-based rank of `order_col` (values must be unique, non-NULL)."""
    ranged = write_scratch(
        df.repartitionByRange(F.col(order_col))
        .sortWithinPartitions(order_col)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id()), "keys")
    per_part = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = per_part.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _POS_BITS)
    keyed = ranged.join(F.broadcast(offsets), "_pid")
    return keyed.select((F.col("_off") + pos + 1).cast("long").alias(key_name), *df.columns)
