"""SentencePiece BPE encoding with a merge-type prefix table, and decoding.

Encoding a word (a run of the space mark, then everything up to the next one)
fills a table of one entry per prefix: the last token of the prefix's
encoding, which is unique.  Candidates for it are the pieces that end there,
found by an Aho-Corasick automaton, longest first; a candidate holds if it and
the last token of the prefix before it are a compatible pair, that is, the
pair itself is what the merges make of its joined text.  Ids are then read
backwards from the end.  Words are independent because no piece has a space
mark after another character (checked when the model is read), so each task
remembers the words it has seen (they part before punctuation and at line ends
too, where no piece goes across).  Characters outside the vocabulary become
byte pieces.  Runs of spaces, whose pieces share one score, and texts of a
model that fails the check, are merged directly, lowest rank first.

Defined cases: a null or empty text has no ids and decodes to the empty text;
all other columns stay as they are.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import prepare, table

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
#: Words that a task, and pairs of pieces that a worker remembers before it starts afresh.
MEMORY = 200_000


class PieceCodec:
    """Encoder and decoder for one model (BPE with byte fallback, identity normaliser, dummy prefix)."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)  # vocabulary only
        size = model.get_piece_size()
        self.piece = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(size)]
        self.id = {p: i for i, p in enumerate(self.piece) if not special[i]}
        self.score = {p: model.get_score(i) for p, i in self.id.items()}
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.of_byte = {i: b for b, i in enumerate(self.byte)}
        self.ends = ahocorasick.Automaton()
        for p, i in self.id.items():
            if self.merge(p) == [p]:  # others never come up
                self.ends.add_word(p, (i, len(p)))
        self.ends.make_automaton()
        self.pairs: dict[int, bool] = {}
        known = {c for p in self.id for c in p}
        self.splits = all(SPACE not in p.lstrip(SPACE) for p in self.id) and all(c in self.id for c in known)
        # Words part at line ends too, and after a letter or digit that no other character follows in a piece;
        # texts with one of the others (`joins`) are parted at space marks only.
        line = "" if "\n" in known else "\\n"
        joins = {a for p in self.id for a, b in zip(p, p[1:]) if re.match(r"\w", a) and b != SPACE and not re.match(r"\w", b)}
        self.joins = re.compile("[" + "".join(map(re.escape, sorted(joins) or SPACE)) + "]")
        end = f"|{line}" if line else ""
        self.coarse = re.compile(f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+{end}")
        self.fine = re.compile(f"{SPACE}*[^\\w{SPACE}{line}]*\\w+|{SPACE}*[^\\w{SPACE}{line}]+|{SPACE}+{end}")
        self.seen: dict[str, tuple[int, str, str]] = {}

    def merge(self, text: str) -> list[str]:
        """Plain merging: the adjacent pair of the best score first, leftmost of equals."""
        part: list[str | None] = list(text)
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap: list[tuple[float, int, int, int, str]] = []

        def offer(i, j):
            if i >= 0 and j < len(part):
                joined = part[i] + part[j]
                if joined in self.id:
                    heapq.heappush(heap, (-self.score[joined], i, j, len(joined), joined))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, size, joined = heapq.heappop(heap)
            if part[i] is None or part[j] is None or after[i] != j or len(part[i]) + len(part[j]) != size:
                continue
            part[i], part[j] = joined, None
            after[i] = after[j]
            if after[j] < len(part):
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in part if p is not None]

    def compatible(self, left: str, right: str) -> bool:
        """Do the merges of left + right end in exactly these two?"""
        return self.merge(left + right) == [left, right]

    def pieces(self, word: str) -> list[str]:
        """A word's pieces by the prefix table; a character outside the vocabulary stands alone."""
        last: list[int | None] = [None] * (len(word) + 1)
        pairs, size = self.pairs, len(self.piece)
        for end, (piece, length) in self.ends.iter(word):  # of one end, the longest piece first
            end += 1
            if last[end] is not None:
                continue
            before = last[end - length]
            if before is not None:
                hit = pairs.get(before * size + piece)
                if hit is None:
                    if len(pairs) >= MEMORY:
                        pairs.clear()
                    hit = pairs[before * size + piece] = self.compatible(self.piece[before], self.piece[piece])
                if not hit:
                    continue
            last[end] = piece  # nothing before it, or a character in no piece
        out, i = [], len(word)
        while i:
            out.append(word[i - 1] if last[i] is None else self.piece[last[i]])
            i -= len(out[-1])
        return out[::-1]

    def _word(self, word: str) -> tuple[int, str, str]:
        """(number of ids, the ids joined by commas, their decoded text)."""
        pieces = self.merge(word) if not self.splits or SPACE * 2 in word else self.pieces(word)
        ids: list[int] = []
        for p in pieces:
            if p in self.id:
                ids.append(self.id[p])
            else:
                ids += [self.byte[b] for b in p.encode("utf-8", "replace")]
        return len(ids), ",".join(map(str, ids)), self.text(ids)

    def text(self, ids: list[int]) -> str:
        """The text of ids, space marks as spaces; nothing is stripped."""
        out, raw = [], bytearray()
        for i in ids:
            if i in self.of_byte:
                raw.append(self.of_byte[i])
            else:
                if raw:
                    out.append(raw.decode("utf-8", "replace"))
                    raw = bytearray()
                out.append(self.piece[i].replace(SPACE, " "))
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    def words(self, text: str) -> list[str]:
        marked = SPACE + text.replace(" ", SPACE)
        if not self.splits:
            return [marked]
        return (self.coarse if self.joins.search(text) else self.fine).findall(marked)

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for e in self._entries(text) for i in e[1].split(",")]

    def decode(self, ids: list[int]) -> str:
        out = self.text(ids)
        return out[1:] if out[:1] == " " else out  # the dummy prefix

    def _entries(self, text: str | None) -> list[tuple[int, str, str]]:
        if not text:
            return []
        seen, out = self.seen, []
        for w in self.words(text):
            e = seen.get(w)
            if e is None:
                e = self._word(w)
                if len(w) <= 64:
                    if len(seen) >= MEMORY:
                        seen.clear()
                    seen[w] = e
            out.append(e)
        return out

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text)."""
        entries = self._entries(text)
        decoded = "".join(e[2] for e in entries)
        decoded = decoded[1:] if decoded[:1] == " " else decoded
        return (sum(e[0] for e in entries), hashlib.sha256(",".join(e[1] for e in entries).encode()).hexdigest(),
                hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest())


def _codec(model_path: str | None) -> PieceCodec:
    """The worker process's codec: it outlives the task, with its pairs of pieces but without the words seen
    (`encode_documents`), which would lie beside whatever the process runs next."""
    import sys
    import types

    if model_path is None:
        import public_tokenizers

        model_path = str(public_tokenizers.path(MODEL))
    kept = sys.modules.setdefault("_piece_codecs", types.ModuleType("_piece_codecs")).__dict__
    if model_path not in kept:
        kept[model_path] = PieceCodec(model_path)
    return kept[model_path]


def encode_documents(documents: DataFrame, model_path: str | None = None, digests_only: bool = False) -> DataFrame:
    """documents with `n_tokens`, `ids_sha256` and `decoded_sha256`, and unless
    `digests_only` the `ids` themselves and the text decoded from them.
    `model_path`: a path every executor can open; None: the installed model."""
    prepare(documents.sparkSession)
    added = ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"] + ([] if digests_only else ["ids array<int>", "decoded string"])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(model_path)
        try:
            for texts in batches:
                rows = []
                for t in texts:
                    row = codec.digest(t)
                    if not digests_only:
                        ids = codec.encode(t)
                        row += (ids, codec.decode(ids))
                    rows.append(row)
                yield pd.DataFrame(rows, columns=[a.split()[0] for a in added])
        finally:
            codec.seen.clear()

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    coded = F.pandas_udf(run, ", ".join(added))(F.col("text"))
    mine = {a.split()[0] for a in added}
    return (documents.withColumn("__coded", coded)
            .select(*[c for c in documents.columns if c not in mine], "__coded.*"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, digests_only=True).drop("text")
