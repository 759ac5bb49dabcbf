"""Byte-level BPE encoding and decoding with the tokenizers library.

A rank file (one token's bytes and its rank a line) becomes a BPE model of
that library: each byte stands for one printable character (those of Latin-1
that print stand for themselves, the others for the characters from U+0100
on), and the merge that makes a token is read off by merging its bytes without
the token itself.  Texts come in Arrow batches.  A text is split into the
matches of the pattern, and each match is encoded alone; a worker remembers
the ids of the short matches it has seen, so the library sees each of them
once.  The fast splitter knows a newer Unicode than the library, so the class
of every character is compared with the library's when it first comes up, and
texts with a character on which they differ are split by the library.

Offsets count code points of the text, end exclusive; tokens that hold only a
part of a character cover the whole of it.  Decoding maps ids back to their
bytes by the reversed table and joins them before they are read as UTF-8, so
characters split over several tokens come back whole.

Defined cases: a null or empty text has no ids and decodes to no bytes; ids
outside the vocabulary and null ids decode to no bytes; bytes that are no UTF-8
decode to U+FFFD in the text (not in the bytes); all other columns stay as they
are, those named like a result column are replaced; repeated rows are each
encoded; an empty table gives an empty table.  Texts of any length are read
whole, in blocks of matches.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import prepare, table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Matches that a worker remembers before it starts afresh, and the longest of them in characters.
MEMORY, LONGEST = 300_000, 48
#: Matches of one text that are encoded at a time.
BLOCK = 100_000


def byte_characters() -> list[str]:
    """The character that stands for each byte."""
    printable = {b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two tokens whose merge makes `token`: what is left of its bytes when
    all other merges are done, lowest rank first.  None: no merge makes it."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, at = min((ranks.get(a + b, len(ranks) + 1), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank > len(ranks):
            return None
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


class ByteCodec:
    """Encoder and decoder for one rank file and one pattern."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        shown = byte_characters()

        def spell(token: bytes) -> str:
            return "".join(shown[b] for b in token)

        made = sorted((t for t in ranks if len(t) > 1), key=ranks.get)
        merges = [(spell(m[0]), spell(m[1])) for m in (last_merge(t, ranks) for t in made) if m]
        self.tokenizer = Tokenizer(models.BPE({spell(t): r for t, r in ranks.items()}, merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.splitter = pre_tokenizers.Split(Regex(pattern), "isolated")
        self.pattern = regex.compile(pattern)
        self.classes = [(regex.compile(c), pre_tokenizers.Split(Regex(c), "removed", invert=True)) for c in (r"\p{L}", r"\p{N}", r"\s")]
        self.checked: set[str] = set()
        self.differ: set[str] = set()
        of_character = {c: b for b, c in enumerate(shown)}  # the reversed table
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for spelled, i in self.tokenizer.get_vocab().items():
            self.bytes_of[i] = bytes(of_character[c] for c in spelled)
        self.seen: dict[str, tuple[int, bytes]] = {}

    def _differs(self, text: str) -> bool:
        """Has the text a character that splitter and library put in different classes?"""
        if text.isascii():
            return False
        new = set(text) - self.checked
        if new:
            self.checked |= new
            joined = "".join(sorted(new))
            for quick, library in self.classes:
                theirs = {c for part, _ in library.pre_tokenize_str(joined) for c in part}
                self.differ |= {c for c in new if bool(quick.match(c)) != (c in theirs)}
        return bool(self.differ) and not self.differ.isdisjoint(text)

    def blocks(self, text: str) -> Iterator[list[str]]:
        """The matches of the pattern, in blocks (the pattern matches every character)."""
        if self._differs(text):
            matches = iter([part for part, _ in self.splitter.pre_tokenize_str(text)])
        elif len(text) <= BLOCK:
            yield self.pattern.findall(text)
            return
        else:
            matches = (m.group() for m in self.pattern.finditer(text))
        while block := list(islice(matches, BLOCK)):
            yield block

    def encoded(self, text: str | None) -> Iterator[tuple[int, bytes]]:
        """(number of ids, ids as little-endian unsigned 32-bit integers) of each match."""
        for words in self.blocks(text) if text else ():
            seen, once = self.seen, {}
            new = [w for w in set(words) if w not in seen]
            if new:
                if len(seen) + len(new) > MEMORY:
                    seen.clear()
                    new = list(set(words))
                for w, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
                    (seen if len(w) <= LONGEST else once)[w] = len(e.ids), np.array(e.ids, "<u4").tobytes()
            yield from (map(seen.__getitem__, words) if not once else (once.get(w) or seen[w] for w in words))

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(e[1] for e in self.encoded(text)), "<u4")

    def offsets(self, text: str | None) -> tuple[list[int], list[int], list[int]]:
        """ids, and the first and the last code point (exclusive) of each."""
        ids, starts, ends, at = [], [], [], 0
        for words in self.blocks(text) if text else ():
            for w, e in zip(words, self.tokenizer.encode_batch(words, add_special_tokens=False)):
                ids += e.ids
                starts += [at + a for a, _ in e.offsets]
                ends += [at + b for _, b in e.offsets]
                at += len(w)
        return ids, starts, ends

    def decode(self, ids) -> bytes:
        table, size = self.bytes_of, len(self.bytes_of)
        try:
            return b"".join(map(table.__getitem__, ids))
        except (IndexError, TypeError):  # ids outside the vocabulary, nulls
            return b"".join(table[i] for i in ids if i is not None and 0 <= i < size)

    def texts(self, ids) -> list[str]:
        """Each id's text: a character split over several ids stands at the one that ends it."""
        read = codecs.getincrementaldecoder("utf-8")("replace")
        out = [read.decode(self.decode([i])) for i in ids]
        rest = read.decode(b"", True)
        if rest:
            out[-1] += rest
        return out

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the ids, SHA-256 of the bytes decoded from them)."""
        ids = self.encode(text)
        return len(ids), hashlib.sha256(ids.data).hexdigest(), hashlib.sha256(self.decode(ids.tolist())).hexdigest()


def _codec(path: str | None, pattern: str | None) -> ByteCodec:
    """The worker process's codec: it outlives the task, with the matches it has seen."""
    import sys
    import types

    if path is None or pattern is None:
        import public_tokenizers

        path = path or str(public_tokenizers.path(RANKS))
        pattern = pattern or public_tokenizers.PATTERN
    kept = sys.modules.setdefault("_byte_codecs", types.ModuleType("_byte_codecs")).__dict__
    if path + pattern not in kept:
        kept[path + pattern] = ByteCodec(path, pattern)
    return kept[path + pattern]


def _with(df: DataFrame, column, types: list[str]) -> DataFrame:
    mine = {t.split()[0] for t in types}
    return df.withColumn("__made", column).select(*[c for c in df.columns if c not in mine], "__made.*")


def encode_documents(documents: DataFrame, path: str | None = None, pattern: str | None = None, digests_only: bool = False) -> DataFrame:
    """documents with `n_tokens`, and with `digests_only` `ids_sha256` and
    `decoded_sha256`, else `ids`, `starts` and `ends`.  `path`, `pattern`: a
    rank file every executor can open and the pattern that splits texts; None:
    the installed ones."""
    prepare(documents.sparkSession)
    types = ["n_tokens long"] + (["ids_sha256 string", "decoded_sha256 string"] if digests_only
                                 else ["ids array<long>", "starts array<long>", "ends array<long>"])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(path, pattern)
        for texts in batches:
            if digests_only:
                rows = [codec.digest(t) for t in texts]
            else:
                rows = [(len(o[0]), *o) for o in map(codec.offsets, texts)]
            yield pd.DataFrame(rows, columns=[t.split()[0] for t in types])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return _with(documents, F.pandas_udf(run, ", ".join(types))(F.col("text")), types)


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """encoded (with `ids`) with `decoded_bytes`, `decoded` (its text) and
    `pieces` (each id's part of the text)."""
    prepare(encoded.sparkSession)
    types = ["decoded_bytes binary", "decoded string", "pieces array<string>"]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(path, pattern)
        for lists in batches:
            rows = []
            for ids in lists:
                ids = [] if ids is None else [None if pd.isna(i) else int(i) for i in ids]
                raw = codec.decode(ids)
                rows.append((raw, raw.decode("utf-8", "replace"), codec.texts(ids)))
            yield pd.DataFrame(rows, columns=[t.split()[0] for t in types])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return _with(encoded, F.pandas_udf(run, ", ".join(types))(F.col("ids")), types)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, digests_only=True).drop("text")
