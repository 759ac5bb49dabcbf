"""Benchmark decontamination: CGK embedding, repeated bit sampling over item-sized windows, exact check.

Texts and items are sequences of lower-cased words.  A document is
contaminated by an item of n words if some passage of it is within
floor(`EDITS` * n) word edits (insertions, deletions, substitutions).

The CGK random walk reads a sequence one symbol per step and moves on, or not,
by a random bit of (step, symbol): sequences at a small edit distance then
agree at most steps.  The share of agreeing steps falls with the length, so
items over `PIECE_WORDS` words are searched by pieces of at most so many: of a
passage within the item's allowance, one piece at least is within its own
(edits add up to `EDITS` * n at most, so not every piece can have more than
`EDITS` of its words).  Windows of the size of a piece start at every word that
a q-gram count bound allows (d edits leave at least n - 1 - 2 d of a piece's
word pairs, so a window with fewer pairs of any piece cannot match); each one
is embedded by `WALKS` independent walks, and every table samples `SAMPLED`
steps of one walk.  The number of tables follows from the target recall and
the share of steps on which a passage at the largest distance still agrees
(`AGREEMENT`, of pieces; recall by kind of edit and length is tested).  Windows
and pieces that meet in a table make their items candidates; the whole item's
best passage is then found by exact dynamic programming.

Items go to the executors in blocks of at most `BLOCK_CHARS` characters, so
what is broadcast is bounded whatever the size of the benchmark.

Defined cases: null or empty texts have no words and match nothing; an item
of fewer than `LEAST_WORDS` words takes no part; rows with a null doc_id are
searched like others and come back with a null doc_id; repeated rows give
repeated results, items with equal texts are each reported; items with a null
item_id likewise; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import WordHash, mix, prepare, table

EDITS = 0.2
LEAST_WORDS = 3
BLOCK_CHARS = 4_000_000
RECALL, AGREEMENT = 0.995, 0.5
WALKS, SAMPLED = 8, 3
#: Words of a piece of an item at most.
PIECE_WORDS = 16
#: Pieces of one class differ in length by this factor at most.
CLASS_RATIO = 1.2
WORD = re.compile(r"\w+")
_BITS = 20
_TWO, _TOP = np.uint64(2), np.uint64(63)
#: Words that are searched together.
PART_WORDS = 500_000


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def allowed(n: int) -> int:
    """Word edits allowed to a passage of n words."""
    return int(EDITS * n + 1e-9)


def tables_needed() -> int:
    """Tables that reach RECALL when a sampled step agrees with probability AGREEMENT."""
    return math.ceil(math.log(1 - RECALL) / math.log(1 - AGREEMENT ** SAMPLED))


def pieces(n: int) -> list[tuple[int, int]]:
    """(first, end) words of the pieces of an item of n words, about equal."""
    count = -(-n // PIECE_WORDS)
    return [(n * k // count, n * (k + 1) // count) for k in range(count)]


def pair_hashes(w: np.ndarray) -> np.ndarray:
    return mix(w[:-1] * np.uint64(3) + w[1:] * np.uint64(0x9E3779B97F4A7C15))


def walk(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, steps: int, seed: int) -> np.ndarray:
    """CGK walks from each start (up to its end): the symbol read at each step, (steps, starts); 0 past the end.
    The random bit of (step, symbol) is the top bit of the symbol times an odd number of the step."""
    odd = np.random.default_rng([29, seed]).integers(0, 1 << 63, steps, np.uint64) * _TWO + np.uint64(1)
    at = starts.copy()
    out = np.zeros((steps, len(starts)), np.uint64)
    for j in range(steps):
        live = at < ends
        np.multiply(symbols[np.where(live, at, 0)], live, out=out[j])
        at += (live & (out[j] * odd[j] >> _TOP).astype(bool)).view(np.int8)
    return out


def _sample(rng, steps: int) -> np.ndarray:
    """Sampled steps, at least two apart where there is room: neighbours often read the same word twice."""
    count = min(SAMPLED, steps)
    room = steps - count + 1
    if room < count:
        return np.sort(rng.choice(steps, count, replace=False))
    return np.sort(rng.choice(room, count, replace=False)) + np.arange(count)


class ItemIndex:
    """The tables of one block of items, by class of length of their pieces."""

    def __init__(self, items: list[tuple], seed: int = 17):
        hashes = WordHash()
        self.items = [(i, hashes.array(w)) for i, t in items if len(w := words_of(t)) >= LEAST_WORDS]
        self.items.sort(key=lambda x: len(x[1]))
        #: (item position, first word in the item, words)
        self.pieces = sorted(((i, a, w[a:b]) for i, (_, w) in enumerate(self.items) for a, b in pieces(len(w))), key=lambda x: len(x[2]))
        self.known = np.zeros(1 << _BITS, np.uint64)  # of each word pair: the classes that have it, as bits
        self.item_pairs: dict[int, np.ndarray] = {}  # item position -> its word pairs, once needed
        self.classes = []
        rng = np.random.default_rng(seed)
        k = 0
        while k < len(self.pieces):
            low, first = len(self.pieces[k][2]), k
            while k < len(self.pieces) and len(self.pieces[k][2]) <= CLASS_RATIO * low:
                k += 1
            bit = np.uint64(1 << min(63, len(self.classes)))
            for _, _, w in self.pieces[first:k]:
                self.known[self._place(w)] |= bit
            self.classes.append(self._class(first, k, rng) | {"bit": bit})

    @staticmethod
    def _place(w: np.ndarray) -> np.ndarray:
        return (pair_hashes(w) >> np.uint64(64 - _BITS)).astype(np.int64)

    def _class(self, first: int, last: int, rng) -> dict:
        low, high = len(self.pieces[first][2]), len(self.pieces[last - 1][2])
        need = min(len(w) - 1 - 2 * allowed(len(w)) for _, _, w in self.pieces[first:last])
        steps = 2 * low  # a walk reads half a symbol a step: these steps stay within every piece of the class
        picks = [_sample(rng, steps) for _ in range(tables_needed())]
        c = {"span": high + allowed(high), "need": max(1, need), "steps": steps, "picks": picks, "tables": [defaultdict(list) for _ in picks]}
        symbols = np.concatenate([w for _, _, w in self.pieces[first:last]])
        size = np.array([len(w) for _, _, w in self.pieces[first:last]])
        ends = np.cumsum(size)
        for table_no, key in self._keys(c, symbols, ends - size, ends):
            for j, x in enumerate(key.tolist()):
                c["tables"][table_no][x].append(first + j)
        c["sorted"] = [np.array(sorted(rows), np.uint64) for rows in c["tables"]]
        return c

    @staticmethod
    def _keys(c: dict, symbols, starts, ends) -> Iterator[tuple[int, np.ndarray]]:
        for seed in range(WALKS):
            tables = range(seed, len(c["picks"]), WALKS)
            if not tables:
                continue
            seen = walk(symbols, starts, ends, 1 + int(max(c["picks"][t][-1] for t in tables)), seed)
            for t in tables:
                key = np.zeros(len(starts), np.uint64)
                for j in c["picks"][t]:
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + seen[j] + np.uint64(1))
                yield t, key

    def candidates(self, texts: list[np.ndarray]) -> dict[tuple[int, int], list[list[int]]]:
        """(text, item position) -> stretches [first, last start] of passages that the windows stand for
        which meet a piece of the item in a table (a start before the text's is negative)."""
        size = np.array([len(w) for w in texts], np.int64)
        if not self.items or size.sum() < 2:
            return {}
        w = np.concatenate(texts)
        ends = np.cumsum(size)
        known = np.append(self.known[self._place(w)], np.uint64(0))
        known[ends[size > 0] - 1] = 0  # the pair across two texts
        found: dict[tuple[int, int], set[int]] = defaultdict(set)
        for c in self.classes:
            hit = (known & c["bit"]) != 0
            if int(hit.sum()) < c["need"]:
                continue
            upto = np.r_[0, np.cumsum(hit)]
            last = np.minimum(np.arange(len(w)) + c["span"] - 1, len(w))
            starts = np.flatnonzero(upto[last] - upto[:-1] >= c["need"])
            text = np.searchsorted(ends, starts, side="right")
            stop = np.minimum(starts + c["span"], ends[text])
            fits = upto[np.maximum(stop - 1, starts)] - upto[starts] >= c["need"]  # within the text
            starts, text, stop = starts[fits], text[fits], stop[fits]
            if not len(starts):
                continue
            from_ = starts - (ends - size)[text]
            for t, key in self._keys(c, w, starts, stop):
                rows = c["tables"][t]
                for k in np.flatnonzero(np.isin(key, c["sorted"][t])).tolist():
                    for piece in rows[int(key[k])]:
                        item, before, _ = self.pieces[piece]
                        found[int(text[k]), item].add(int(from_[k]) - before)
        out = {}
        for (text, item), at in found.items():
            n, runs = len(self.items[item][1]), []
            for s in sorted(at):
                if runs and s - runs[-1][1] <= n:
                    runs[-1][1] = s
                else:
                    runs.append([s, s])
            out[text, item] = runs
        return out

    def _enough_pairs(self, item: int, pairs: np.ndarray) -> bool:
        """Whether some passage as long as a match can be has the word pairs of the item that d edits leave."""
        own = self.items[item][1]
        n, d = len(own), allowed(len(own))
        if item not in self.item_pairs:
            self.item_pairs[item] = np.unique(pair_hashes(own))
        known = self.item_pairs[item]
        at = np.searchsorted(known, pairs)
        at[at == len(known)] = 0
        upto = np.zeros(len(pairs) + 1, np.int64)
        np.cumsum(known[at] == pairs, out=upto[1:])
        size = min(len(pairs), n + d - 1)
        return int((upto[size:] - upto[:len(upto) - size]).max()) >= n - 1 - 2 * d

    def matches(self, texts: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        """(text, item position, distance, first word, end word) of each item's best passage within its allowance."""
        out, pairs = [], (-1, None)
        for (text, item), runs in sorted(self.candidates(texts).items()):
            own, w = self.items[item][1], texts[text]
            n, d = len(own), allowed(len(own))
            best = None
            if pairs[0] != text:
                pairs = text, pair_hashes(w)
            for a, b in runs:
                low, high = max(0, a - 2 * d), min(len(w), b + n + 3 * d + 1)  # d before the piece, d around its window
                if not self._enough_pairs(item, pairs[1][low:max(low, high - 1)]):
                    continue
                dist, x, y = nearest_passage(own, w[low:high], d)
                if dist <= d and (best is None or (dist, low + x) < best[:2]):
                    best = (dist, low + x, low + y)
            if best:
                out.append((text, item, *best))
        return out


def nearest_passage(item: np.ndarray, text: np.ndarray, most: int | None = None) -> tuple[int, int, int]:
    """(distance, start, end) of the passage of text nearest to item by word edits; the first of equals.
    One row per item word; the insertions of a row are a running minimum.  When no passage is
    within `most` edits, any distance above it may come back (a row's least value never falls)."""
    m = len(text)
    ramp = np.arange(m + 1)
    row, origin = np.zeros(m + 1, np.int64), ramp.copy()
    swap, before = np.empty(m + 1, np.int64), np.zeros(m + 1, np.int64)
    swap[0] = m + len(item) + 9
    for k, x in enumerate(item, 1):
        drop = row + 1
        np.add(row[:-1], text != x, out=swap[1:])
        new = np.minimum(drop, swap)
        new[0] = k
        before[1:] = origin[:-1]
        from_ = np.where(swap <= drop, before, origin)
        from_[0] = 0
        slack = new - ramp
        run = np.minimum.accumulate(slack)
        at = np.maximum.accumulate(np.where(slack == run, ramp, 0))  # where the running minimum was last reached
        row, origin = run + ramp, from_[at]
        if most is not None and row.min() > most:
            break
    end = int(row.argmin())
    return int(row[end]), int(origin[end]), end


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // BLOCK_CHARS)
    for k in range(count):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(count)) == k) if count > 1 else items
        yield [tuple(r) for r in part.collect()]  # about BLOCK_CHARS characters


def _parts(hashed: list[np.ndarray]) -> Iterator[slice]:
    """Runs of texts of about PART_WORDS words together."""
    first, held = 0, 0
    for k, w in enumerate(hashed, 1):
        held += len(w)
        if held >= PART_WORDS or k == len(hashed):
            yield slice(first, k)
            first, held = k, 0


_FOUND = "doc_id long, item_id long, distance int, item_words int, start int, end int"


def find_contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, item_words, start, end): each document's best passage for each
    item within the allowance; start and end are code points of the text."""
    spark = prepare(documents.sparkSession)
    docs, out = documents.select("doc_id", "text").where("text is not null"), None
    for items in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index, hashes = ItemIndex(shared.value), WordHash()
            for pdf in batches:
                rows, ids, texts = [], pdf["doc_id"].tolist(), pdf["text"].tolist()
                hashed = [hashes.array(words_of(t)) for t in texts]
                for part in _parts(hashed):
                    for k, item, dist, a, b in index.matches(hashed[part]):
                        k += part.start
                        at = [m.span() for m in WORD.finditer(texts[k])]
                        span = (at[a][0], at[b - 1][1]) if len(at) >= b > a else (0, len(texts[k]))
                        rows.append((ids[k], index.items[item][0], dist, len(index.items[item][1]), *span))
                out = pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "item_words", "start", "end"])
                yield out.astype({"doc_id": "Int64", "item_id": "Int64"})

        found = docs.mapInPandas(search, _FOUND)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], _FOUND) if out is None else out


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's passages of benchmark items, one row per document and item."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
