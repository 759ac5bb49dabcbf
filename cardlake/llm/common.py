"""Helpers shared by the operators: tables, shared scratch, hashing, components."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.session import checkpoint_root, ensure_conf

#: Rows per Arrow batch: with texts of 100,000 characters a batch stays near 50 MB.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on (small Arrow batches: texts are long)."""
    ensure_conf(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) != str(BATCH_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/llm/{tag}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    if getattr(spark.sparkContext, "_jsc", None) is not None:
        try:
            remove_path(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone; the folder is scratch
            pass


class Scratch:
    """Tables written to the shared folder; `drop` removes those no longer
    read, the rest (what a returned DataFrame still reads) goes at exit."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, tag: str) -> DataFrame:
        path = scratch_path(self.spark, tag)
        df.write.parquet(path)
        self.paths[tag] = path
        atexit.register(_remove_at_exit, self.spark, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tags: str) -> None:
        for t in tags:
            path = self.paths.pop(t, None)
            if path:
                remove_path(self.spark, path)


def id_crc(col: str = "doc_id") -> Column:
    """crc32 of the id as text (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def hash_order(col: str = "doc_id") -> list[Column]:
    """A fixed pseudo-random order of ids, for bounded samples."""
    return [F.xxhash64(F.lit(7), F.col(col)), F.col(col)]


class WordHash(dict):
    """word -> 64-bit hash with a bounded memory (emptied when it is full)."""

    LIMIT = 400_000

    def __missing__(self, word):
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def array(self, words: Sequence) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of the result depends on every bit of h."""
    h = h ^ (h >> _S)
    h = h * _M1
    h ^= h >> _S
    h *= _M2
    h ^= h >> _S
    return h


def components(spark: SparkSession, edges: DataFrame, tag: str) -> DataFrame:
    """Connected components of `edges` (src, dst: long) -> (node, label), label
    being the smallest node reachable.

    Minimum labels spread along the edges, and each round also replaces a
    label by its own label, so chains shorten by half a round.  Rows only
    ever meet in joins of two written tables (a hub's rows can be split by
    AQE) and in minimum aggregations (combined before the shuffle).
    """
    sc = Scratch(spark)
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    e = sc.write(both.where("src != dst").distinct(), f"{tag}-edges")
    lab = sc.write(e.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("m"))
                   .select("node", F.least("node", "m").alias("label")), f"{tag}-0")
    k = 0
    while True:
        k += 1
        near = (e.join(lab.withColumnRenamed("node", "src"), "src").select(F.col("dst").alias("node"), "label")
                .unionByName(lab).groupBy("node").agg(F.min("label").alias("label")))
        step = sc.write(near, f"{tag}-{k}a")
        jump = (step.alias("a").join(step.select(F.col("node").alias("label"), F.col("label").alias("up")), "label")
                .select("node", F.least("label", "up").alias("label")))
        new = sc.write(jump, f"{tag}-{k}")
        changed = new.join(lab.withColumnRenamed("label", "old"), "node").where("label != old").limit(1).count()
        sc.drop(f"{tag}-{k}a", f"{tag}-{k - 1}")
        lab = new
        if not changed:
            sc.drop(f"{tag}-edges")
            return lab
