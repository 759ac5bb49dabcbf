"""SparkSession helpers.

On a cluster the session already exists and carries its own settings; we only
fill in what is unset.  Locally (tests, bench) we build a session tuned for
`local[N]`.
"""

from __future__ import annotations

import atexit
import hashlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  UTC makes timestamp parsing and date
# extraction independent of the machine; AQE re-plans joins and partition
# counts from runtime sizes and splits skewed shuffle partitions.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "cardlake") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply REQUIRED_CONF on an existing session (runtime SQL confs only)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must be a shared file
    system; without it nothing can run there.  Only a local master (tests)
    gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
    if not current and not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all machines share")
    if not current:
        current = tempfile.mkdtemp(prefix="cardlake-ckpt-", dir=os.environ.get("CARDLAKE_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)
        elif path.startswith(("/", "file:/")):  # the session has ended
            shutil.rmtree("/" + path.removeprefix("file:").lstrip("/"), ignore_errors=True)
    except Exception:  # noqa: BLE001 - scratch only: a failed removal must not fail the job
        pass


def scratch_dir(spark: SparkSession, what: str) -> str:
    """A new folder under the shared checkpoint folder, removed when the
    program ends (results that are read lazily may need it until then)."""
    path = f"{checkpoint_root(spark)}/cardlake-io/{what}-{uuid.uuid4().hex[:12]}"
    atexit.register(_delete_at_exit, spark, path)
    return path


def write_scratch(df: DataFrame, what: str) -> DataFrame:
    """df written to a scratch folder and read back: cuts the lineage, and later
    size estimates are those of the rows themselves."""
    spark = df.sparkSession
    path = scratch_dir(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each query run inside go when that query has ended,
    not when the driver happens to collect its garbage.  For writes: a
    DataFrame's own plan, run twice, would lack the files."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def input_signature(spark: SparkSession, paths) -> str:
    """Names, sizes and modification times of all files under `paths`, as one
    digest (file-system metadata only): changes when an input changes."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    lines = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            lines.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(lines)).encode()).hexdigest()


def input_size_bytes(spark: SparkSession, paths) -> int:
    """Total bytes under `paths` (file-system metadata only, nothing is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += int(fs.getContentSummary(path).getLength())
    return total


def size_shuffle_partitions(spark: SparkSession, input_bytes: int,
                            bytes_per_partition: int = 128 * 1024 * 1024) -> int:
    """Initial shuffle partition count for AQE to coalesce from.

    The largest shuffles (keep-first of the raw transactions, the fact joins)
    move about as much data as the input, so they start with one partition
    per `bytes_per_partition` of (compressed) input; AQE then merges small
    partitions and splits skewed ones.  Never lowers the session's own
    setting; a deployment that wants fewer, larger partitions passes
    `bytes_per_partition`.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-input_bytes // bytes_per_partition)
    n = max(current, wanted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n
