"""CSV sources and sinks with the source system's text semantics.

Ingest (header, comma, UTF-8, doubled-quote escaping, any malformed row fails
the load): an unquoted empty field is NULL, a quoted empty field `""` is the
empty string, and a literal `\\N` stays text.  Spark's CSV reader treats a
field equal to `nullValue` as NULL; setting it to a sentinel that never occurs
keeps `""` as '' while unquoted empty fields still read as NULL.

Bulk-load files written with the `\\N` NULL marker round-trip NULL and ''
distinctly; files written with an empty NULL marker lose the difference
(empty -> NULL on load).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.functions.text import nullif_blank

S, I, D, L = T.StringType(), T.IntegerType(), T.DoubleType(), T.LongType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Raw layer schemas (money, dates, ids and codes are deliberately text)
RAW_SCHEMAS = {
    "users_data": _schema(
        ("id", I), ("current_age", I), ("retirement_age", I), ("birth_year", I), ("birth_month", I),
        ("gender", S), ("address", S), ("latitude", D), ("longitude", D), ("per_capita_income", S),
        ("yearly_income", S), ("total_debt", S), ("credit_score", I), ("num_credit_cards", I),
        ("employment_status", S), ("education_level", S)),
    "cards_data": _schema(
        ("id", I), ("client_id", I), ("card_brand", S), ("card_type", S), ("card_number", S), ("expires", S),
        ("cvv", I), ("has_chip", S), ("num_cards_issued", I), ("credit_limit", S), ("acct_open_date", S),
        ("year_pin_last_changed", I), ("card_on_dark_web", S), ("issuer_bank_name", S),
        ("issuer_bank_state", S), ("issuer_bank_type", S), ("issuer_risk_rating", S)),
    "mcc_data": _schema(("code", S), ("description", S), ("notes", S), ("updated_by", S)),
    "transactions_data": _schema(
        ("id", S), ("date", S), ("client_id", I), ("card_id", I), ("amount", S), ("use_chip", S),
        ("merchant_id", S), ("merchant_city", S), ("merchant_state", S), ("zip", S), ("mcc", S),
        ("errors", S)),
}

# a NULL marker that never occurs in data: only unquoted empty fields are NULL
NO_NULL_TEXT = "\u0000<null>\u0000"
NULL_MARKER = "\\N"


def with_seq(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("_seq", L, True)] + list(schema.fields))


# arrival: file name, the split's place in the file, the row's place in the split's task
ARRIVAL = T.StructType([T.StructField("file", S), T.StructField("start", L), T.StructField("row", L)])
_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id = partition index << 33 | row


def with_place(df: DataFrame) -> DataFrame:
    """Add `_place`, a file scan's file name and the split's place in the file."""
    return df.select(F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")).alias("_place"),
                     *df.columns)


def arrival_of_place(df: DataFrame) -> DataFrame:
    """`_place` -> `_seq`, the arrival order over all files: by file name, then
    place in the file, however Spark packs splits into tasks."""
    seq = F.struct(F.col("_place.file").alias("file"), F.col("_place.start").alias("start"),
                   F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("row"))
    return df.select(seq.alias("_seq"), *[c for c in df.columns if c != "_place"])


def with_arrival(df: DataFrame) -> DataFrame:
    """Add `_seq` to a batch file scan."""
    return arrival_of_place(with_place(df))


def read_raw_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, with_arrival_seq: bool = True,
                 multiline: bool = False) -> DataFrame:
    """Read raw CSV files with an explicit schema, failing on any malformed
    row.  `_seq` is the arrival order (see `with_arrival`).  `multiline`
    accepts line ends inside quoted fields; a file is then one task, because
    it can no longer be split at line ends."""
    df = (spark.read.schema(schema)
          .option("header", True).option("sep", ",").option("encoding", "UTF-8")
          .option("quote", '"').option("escape", '"')
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .option("nullValue", NO_NULL_TEXT).option("multiLine", multiline)
          .option("mode", "FAILFAST")
          .csv(path))
    return with_arrival(df) if with_arrival_seq and "_seq" not in schema.fieldNames() else df


def write_raw_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """Write a table as raw CSV: NULL as an unquoted empty field, '' as `""`.
    A compressed file (`gzip`) cannot be split into tasks when it is read."""
    (df.write.mode(mode).option("header", True).option("compression", compression)
       .option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def table_name_from_file(file_name):
    """File name -> table name: the stem, lower-cased (Column or str)."""
    if isinstance(file_name, str):
        return os.path.splitext(os.path.basename(file_name))[0].lower()
    base = F.regexp_extract(file_name, r"([^/]*)$", 1)
    return F.lower(F.regexp_replace(base, r"\.[^.]*$", ""))


def ingest_files(spark: SparkSession, files: dict[str, str],
                 schemas: dict[str, T.StructType] = RAW_SCHEMAS, multiline: bool = False) -> dict[str, DataFrame]:
    """Load several raw CSV files, each into the table its file name names."""
    out = {}
    for file_name, path in files.items():
        table = table_name_from_file(file_name)
        out[table] = read_raw_csv(spark, path, schemas[table], multiline=multiline)
    return out


def list_csv_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """{file name: path} of the `.csv` entries (files or Spark output folders)
    directly under `folder` - a listing of names, no data is read."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    out = {}
    for status in path.getFileSystem(conf).listStatus(path):
        name = status.getPath().getName()
        if name.lower().endswith(".csv"):
            out[name] = status.getPath().toString()
    return out


def write_bulk_csv(df: DataFrame, path: str, null_marker: str = NULL_MARKER) -> None:
    """Bulk-load file: NULL written as `null_marker` ('\\N' keeps '' distinct)."""
    (df.write.mode("overwrite").option("header", False)
       .option("nullValue", null_marker).option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def read_bulk_csv(spark: SparkSession, path: str, schema: T.StructType,
                  null_marker: str = NULL_MARKER) -> DataFrame:
    df = (spark.read.schema(schema).option("header", False)
          .option("nullValue", null_marker).option("quote", '"').option("escape", '"')
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .option("mode", "FAILFAST").csv(path))
    if null_marker == "":
        # empty = NULL loading: every empty text becomes NULL
        df = df.select(*[nullif_blank(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
                         else F.col(f.name) for f in schema.fields])
    return df
