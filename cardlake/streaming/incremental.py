"""Incremental transaction load with Structured Streaming.

The source reads raw transactions in 300,000-row chunks and inserts each
cleaned chunk with "ON CONFLICT (id) DO NOTHING".  Here: a file stream over
the landing folder, whose micro-batches are sized in bytes; `foreachBatch`
cleans each one (keep-first by the id as a number; rows that cannot be stored
go to a reject folder, keyed by the batch), anti-joins it against the ids already in the target and appends the
rest.  The target is laid out by ranges of ids (`id_bucket`), and only the
buckets that a batch touches are read.  The checkpoint records which files
were processed; if a batch is re-run after a failure the anti-join makes the
replay add nothing that is already there, so the load is effectively
exactly-once.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from cardlake.functions.numbers import try_integer_text
from cardlake.operators.sinks import insert_if_absent, write_table
from cardlake.plans.transform import reject_rows, stage_transactions, stored_rows
from cardlake.sources import csv_io

RAW_TX_SCHEMA = T.StructType([
    T.StructField("_seq", T.LongType()), T.StructField("id", T.StringType()),
    T.StructField("date", T.StringType()), T.StructField("client_id", T.IntegerType()),
    T.StructField("card_id", T.IntegerType()), T.StructField("amount", T.StringType()),
    T.StructField("use_chip", T.StringType()), T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_city", T.StringType()), T.StructField("merchant_state", T.StringType()),
    T.StructField("zip", T.StringType()), T.StructField("mcc", T.StringType()),
    T.StructField("errors", T.StringType()),
])


def _existing(spark: SparkSession, target_path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(target_path)
    except AnalysisException as e:  # no target yet, or one without a row; anything else is an error
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


BUCKET = "id_bucket"
#: Ids of one bucket of the target.
BUCKET_IDS = 10_000_000
#: A batch that touches more buckets than this prunes by their range instead of a list.
LISTED_BUCKETS = 1000


def with_bucket(df: DataFrame, bucket_ids: int = BUCKET_IDS) -> DataFrame:
    return df.withColumn(BUCKET, F.floor(F.col("id") / F.lit(bucket_ids)).cast("long"))


def touched(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The target's rows in the buckets of `batch`: a filter on the partition
    column, so files of other buckets are never opened."""
    lo, hi, buckets = batch.agg(F.min(BUCKET), F.max(BUCKET), F.count_distinct(BUCKET)).first()
    if lo is None:
        return target.limit(0)
    if buckets <= LISTED_BUCKETS:
        return target.where(F.col(BUCKET).isin([r[0] for r in batch.select(BUCKET).distinct().collect()]))
    return target.where(F.col(BUCKET).between(lo, hi))


def rejects_of(target_path: str) -> str:
    """Where the load into `target_path` keeps its rejected rows."""
    return f"{target_path.rstrip('/')}_rejects"


def load_batch(batch: DataFrame, target_path: str, bucket_ids: int = BUCKET_IDS, batch_id: int = 0) -> None:
    """Clean one micro-batch and append the ids the target does not hold.  Rows
    that cannot be stored go to `rejects_of(target_path)`, as the folder of this
    batch: a replay of the batch writes the same folder again."""
    spark = batch.sparkSession
    if "_place" in batch.columns:
        batch = csv_io.arrival_of_place(batch)
    staged = stage_transactions(batch).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        reject_rows(staged, "transactions_data").write.mode("overwrite").parquet(f"{rejects_of(target_path)}/batch_id={batch_id}")
        cleaned = with_bucket(stored_rows(staged), bucket_ids)
        target = _existing(spark, target_path)
        if target is not None:
            target = touched(target, cleaned)
        fresh = insert_if_absent(cleaned, target, "id", order=None)
        write_table(fresh.sortWithinPartitions(BUCKET, "id"), target_path, "append", BUCKET)
    finally:
        staged.unpersist()


def stream_tx_load(spark: SparkSession, landing_dir: str, target_path: str, checkpoint_dir: str,
                   batch_bytes: int = 64 << 30, schema: T.StructType = RAW_TX_SCHEMA,
                   source_format: str = "parquet", every: str | None = None, bucket_ids: int = BUCKET_IDS):
    """Start the incremental load; returns the StreamingQuery.

    By default (availableNow) it processes what has landed, in batches of
    about `batch_bytes`, then stops; with `every` (e.g. "5 minutes") it
    keeps running and picks up new files on that schedule.

    `source_format="csv"` reads raw CSV deliveries with the batch ingest's
    options (header, doubled-quote escaping, NULL only for unquoted empty
    fields, malformed rows fail); without a `_seq` column the arrival order
    inside a batch is file name, then place in the file.
    """
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(batch_bytes))
    if source_format == "csv":
        reader = (reader.option("header", True).option("quote", '"').option("escape", '"')
                  .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
                  .option("nullValue", csv_io.NO_NULL_TEXT).option("mode", "FAILFAST"))
    stream = reader.format(source_format).load(landing_dir)
    if "_seq" not in schema.fieldNames():
        stream = csv_io.with_place(stream)
    writer = (stream.writeStream
              .foreachBatch(lambda df, epoch: load_batch(df, target_path, bucket_ids, epoch))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def land_raw_transactions(raw: DataFrame, landing_dir: str, source_format: str = "parquet",
                          mode: str = "overwrite") -> None:
    """Land raw rows as files sized by the shuffle, every id (as a number)
    within one file (CSV: in arrival order inside each file, without the
    `_seq` column).  `mode="append"` adds a later delivery next to earlier ones."""
    landed = raw.repartition(try_integer_text(F.col("id"), "bigint"))
    if source_format == "csv":
        csv_io.write_raw_csv(landed.sortWithinPartitions("_seq").drop("_seq"), landing_dir, mode)
    else:
        landed.write.mode(mode).parquet(landing_dir)
