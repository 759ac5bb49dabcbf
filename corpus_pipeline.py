"""Corpus cleaning pipeline: STAGES applied one after the other to `documents`.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next stage's docs.  All columns of docs
stay, extra ones too, up to the last stage, which returns the encoded documents
(doc_id, lang, source, ids and digests) instead of their texts; a document with a null doc_id or text is kept unless a
stage finds something in its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import Scratch, id_crc, table
from cardlake.llm.decontam import find_contamination
from cardlake.llm.jaccard_trie import jaccard_classes
from cardlake.llm.pii import redact, train_tagger
from cardlake.llm.piece_codec import encode_documents
from cardlake.llm.toxicity import THRESHOLD, score, train


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model (operator 6) scores under its threshold."""
    model = train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), id_crc() % 3 != 1)
    scored = score(docs.withColumn("__row", F.struct(*docs.columns)).select("__row", F.col("text")), model)
    return scored.where(F.col("toxicity") < THRESHOLD).select("__row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each class of the n-gram Jaccard join
    (operator 5): five-word shingles, similarity 0.8 or more.  Where a doc_id
    repeats, each of its texts is a document of its own, known by a hash of id
    and text; rows equal in both are one.  Rows with a null doc_id all stay."""
    known = docs.where("doc_id is not null")
    if known.groupBy("doc_id").count().where("count > 1").limit(1).count():
        known = known.withColumn("__key", F.xxhash64("doc_id", "text", F.col("text").isNull())).dropDuplicates(["__key"])
    else:
        known = known.withColumn("__key", F.col("doc_id"))
    classes = jaccard_classes(known.select(F.col("__key").alias("doc_id"), "text"), n=5, percent=80)
    keep = classes.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("__key"))
    return known.join(keep, "__key", "left_semi").select(*docs.columns).unionByName(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item (operator 1)."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    found = Scratch(spark).write(found, "contaminated")  # joins need its size
    return docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"]), "left_anti")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data (operator 2) replaced by its kind; n_chars follows the text."""
    clean = redact(docs, train_tagger(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source with the token ids of the text (operator 7), their count, and the decoded text's digest."""
    coded = encode_documents(docs.select("doc_id", "lang", "source", "text"))
    return coded.select("doc_id", "lang", "source", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("sentencepiece", encode),
]

#: Models and similarity classes are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to the whole `documents` table."""
    scratch = Scratch(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
