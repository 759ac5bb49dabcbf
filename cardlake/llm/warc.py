"""WARC archives with a Zstandard dictionary in a leading skippable frame.

An archive holds a dictionary built from a bounded sample of its own records
(`SAMPLE_BYTES`), in a skippable frame with the magic number 0x184D2A5D, then
every record as a Zstandard frame of its own, compressed with it.  Archives
are rows of a table (name, content) in the shared folder, written by Spark's
commit protocol, so a lost executor's archives are written again and never
twice; `export_archives` turns rows into files.

Of records with equal payloads of `LEAST_BYTES` bytes or more, that with the
largest page_id is a response and the others are revisits that refer to it.

Defined cases: a null html is an empty payload, a null url an empty target; a
null page_id is never the largest unless all are null, and then all are
responses; rows that repeat the largest page_id are all responses; very long
payloads make an archive of their own; an empty table gives no archive.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import Scratch, prepare, table
from cardlake.operators.joins import broadcast_if_bounded

MAGIC = 0x184D2A5D
LEAST_BYTES = 1000
#: Payload bytes of an archive; bytes of its records that the dictionary is built from, and its size.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 16 << 20, 2 << 20, 32 << 10
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _urn(page_id) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit (refers_to) has the HTTP header only."""
    body = _HTTP % len(payload)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}",
            f"WARC-Date: {DATE}", "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"), f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is None:
        body += payload
    else:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n"


def build_archive(records: list[bytes]) -> bytes:
    """Dictionary frame (left out when the records are too few for one), then a frame for each record."""
    sample, held = [], 0
    for r in records[::max(1, sum(map(len, records)) // SAMPLE_BYTES)]:
        sample.append(r[:64 << 10])
        held += len(sample[-1])
        if held >= SAMPLE_BYTES:
            break
    out, known = [], None
    if len(sample) >= 8:
        try:
            known = zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, held // 8)), sample, k=256, d=8)
        except zstandard.ZstdError:  # too little in common
            known = None
    if known is not None:
        raw = known.as_bytes()
        out.append(struct.pack("<II", MAGIC, len(raw)) + raw)
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
    out += [press.compress(r) for r in records]
    return b"".join(out)


def read_records(archive: bytes) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of each record of an archive."""
    at, known = 0, None
    if len(archive) >= 8 and struct.unpack_from("<I", archive)[0] == MAGIC:
        size = struct.unpack_from("<I", archive, 4)[0]
        known = zstandard.ZstdCompressionDict(archive[8:8 + size])
        at = 8 + size
    expand = zstandard.ZstdDecompressor(dict_data=known)
    rest = memoryview(archive)[at:]
    while len(rest):
        frame = expand.decompressobj()
        plain = frame.decompress(rest)
        if not frame.eof:
            raise ValueError("the archive ends within a record")
        rest = rest[len(rest) - len(frame.unused_data):]
        head, _, block = plain.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
        yield fields, block[:int(fields["Content-Length"])]


def with_record_types(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to) of each page."""
    spark = prepare(pages.sparkSession)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    p = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"))
    p = p.withColumn("digest", F.sha1("payload"))
    same = (p.where(F.octet_length("payload") >= LEAST_BYTES).groupBy("digest")  # combined before the shuffle
            .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    same = Scratch(spark).write(same, "same")
    joined = p.join(broadcast_if_bounded(same), "digest", "left")
    return joined.select("page_id", "url", "payload", "digest",
                         F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame) -> DataFrame:
    """(archive, content): the archives of all pages, written to the shared folder."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, k = [], 0, 0

        def flush():
            nonlocal held, size, k
            name = f"part-{TaskContext.get().partitionId():05d}-{k:05d}.warc.zst"
            out = pd.DataFrame({"archive": [name], "content": [build_archive(held)]})
            held, size, k = [], 0, k + 1
            return out

        for pdf in batches:
            for i, url, payload, digest, refers in zip(pdf["page_id"], pdf["url"], pdf["payload"], pdf["digest"], pdf["refers_to"]):
                held.append(record(None if pd.isna(i) else int(i), url, payload, digest, None if pd.isna(refers) else int(refers)))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
        if held:
            yield flush()

    # ids as text: a column of ids and nulls would turn into floating point numbers
    rows = with_record_types(pages).withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return Scratch(pages.sparkSession).write(rows.mapInPandas(build, "archive string, content binary"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """One row for each record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and
    the payload of responses.  A response whose payload does not have its digest raises an error."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = lambda urn: None if urn is None or urn == "<urn:x-page:null>" else int(urn[len("<urn:x-page:"):-1])
        for pdf in batches:
            for content in pdf["content"]:
                rows = []
                for h, block in read_records(bytes(content)):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(http.rpartition(b"Content-Length: ")[2])
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if h["WARC-Type"] == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"payload of {h['WARC-Record-ID']} differs from its digest")
                    rows.append((number(h["WARC-Record-ID"]), h["WARC-Target-URI"], length, digest, h["WARC-Type"],
                                 number(h.get("WARC-Refers-To")), payload if h["WARC-Type"] == "response" else None))
                out = pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
                for c in ("page_id", "refers_to"):
                    out[c] = pd.array([r[0 if c == "page_id" else 5] for r in rows], "Int64")
                yield out

    return archives.mapInPandas(parse, schema)


def export_archives(archives: DataFrame, folder: str) -> None:
    """Each archive as a file of a folder that all executors have mounted (written aside, then renamed)."""
    def save(rows):
        for r in rows:
            path = os.path.join(folder, r["archive"])
            with open(f"{path}.{os.getpid()}.part", "wb") as f:
                f.write(r["content"])
            os.replace(f.name, path)

    archives.foreachPartition(save)


def op9_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all pages, as read back from the archives."""
    archives = write_archives(table(spark, sf_dir, "pages"))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NOT DISTINCT FROM page_id THEN NULL ELSE first END AS refers_to
FROM f
"""
