"""Layer store: each pipeline table is a Parquet directory under one root.

A table is present when its `_SUCCESS` marker exists (written by Spark at job
commit), so a half-written directory is rebuilt, never read.  Writes are full
refreshes (overwrite), which makes a re-run after a lost executor or a failed
job idempotent.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardlake.operators.quality import write_metrics
from cardlake.operators.sinks import write_table


class LayerStore:
    """`refresh=True` rewrites every table on each build (a full-refresh run);
    `refresh=False` reuses complete tables (a cache keyed by its root).  With
    `lengths` (table -> key and declared text lengths) every write also
    observes its checks, kept in `metrics` as (table, check, column, rows)."""

    def __init__(self, spark: SparkSession, root: str, refresh: bool = False,
                 lengths: Mapping[str, tuple[str, Mapping[str, int]]] | None = None):
        self.lengths = lengths
        self.metrics: list[tuple[str, str, str, int]] = []
        self.spark = spark
        self.root = root.rstrip("/")
        self.refresh = refresh

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def has(self, layer: str, name: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        marker = jvm.org.apache.hadoop.fs.Path(self.path(layer, name) + "/_SUCCESS")
        return bool(marker.getFileSystem(conf).exists(marker))

    def write(self, df: DataFrame, layer: str, name: str, sort_by: str | None = None) -> DataFrame:
        """Full refresh of one table; rows sorted by `sort_by` inside each file
        (tight min/max statistics for key lookups), no global sort."""
        out = df.sortWithinPartitions(sort_by) if sort_by else df
        self._write_observed(out, layer, name, name, sort_by)
        return self.read(layer, name)

    def _write_observed(self, df: DataFrame, layer: str, name: str, folder: str, key: str | None, stored: Column | None = None,
                        partition_by: str | None = None) -> None:
        if self.lengths is None:
            write_table(df, self.path(layer, folder), partition_by=partition_by)
            return
        table = f"{layer}.{name}"
        _, lengths = self.lengths.get(table, (key, {}))
        seen = Observation()
        write_table(df.observe(seen, *write_metrics(df.columns, key, lengths, stored)), self.path(layer, folder), partition_by=partition_by)
        self.metrics += [(table, *check.split("|"), n) for check, n in seen.get.items()]

    def write_split(self, staged: DataFrame, layer: str, name: str, sort_by: str) -> None:
        """A staged table (cleaned rows and rejects, told apart by `_reason`) in
        one write, its rejects in a folder of their own."""
        split = staged.withColumn("rejected", F.col("_reason").isNotNull()).sortWithinPartitions("rejected", sort_by)
        self._write_observed(split, layer, name, f"{name}_staged", sort_by, ~F.col("rejected"), "rejected")

    def read_split(self, layer: str, name: str, rejected: bool) -> DataFrame:
        """The cleaned rows of a staged table, or its rejects: the filter is on the partition column."""
        rows = self.read(layer, f"{name}_staged").where(F.col("rejected") == rejected).drop("rejected")
        return rows if rejected else rows.drop("_reason", "_raw_id")

    def get_or_build_split(self, layer: str, name: str, build, sort_by: str) -> tuple[DataFrame, DataFrame]:
        """(cleaned rows, rejects) of a staged table."""
        if self.refresh or not self.has(layer, f"{name}_staged"):
            self.write_split(build(), layer, name, sort_by)
        return self.read_split(layer, name, False), self.read_split(layer, name, True)

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def get_or_build(self, layer: str, name: str, build, sort_by: str | None = None) -> DataFrame:
        if not self.refresh and self.has(layer, name):
            return self.read(layer, name)
        return self.write(build(), layer, name, sort_by)
