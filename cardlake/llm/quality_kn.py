"""Quality: interpolated modified Kneser-Ney perplexity, thresholded per language.

A word bigram model is trained on all trusted documents (label quality 1) of
one half, by a hash of the id.  Its vocabulary are their `VOCABULARY` most
frequent words that occur twice; every other word, and the place before the
first, is the unknown word, which a byte-pair model of their words spells out.
Words and bigrams are counted in Spark.  What has the size of the vocabulary
(continuation probabilities, back-off weights, bigrams with the unknown word)
goes to every executor.  The bigram counts are sharded by the context word,
and the documents' bigrams meet them by shard: packed, in rows of at most
`PIECE` bigrams, sorted behind their shard's counts and summed in a stream,
so a task holds one shard's counts and a few rows, however many a frequent
word has.  Above `SLOT_CHARS` characters a shard's rows are dealt to several
slots, each with its copy of the counts.  Sums return packed to the documents.

A
document is kept if its perplexity is at most the `QUANTILE` quantile of the
perplexities of all trusted documents of the other half in its language (in
all languages if its language has none).

Defined cases: a null or blank text has no perplexity and is not kept; rows
with a null doc_id come back with null results and are not kept; rows that repeat a doc_id are scored together; a null lang is a
language of its own; without any trusted document nothing is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import Scratch, WordHash, prepare, table
from cardlake.operators.joins import broadcast_if_bounded

VOCAB_BITS = 17
VOCABULARY = (1 << VOCAB_BITS) - 1
QUANTILE = 0.995
#: A shard of the bigram counts for each so many characters of input, at least so many, rounded up to a power of two.
SHARD_CHARS, LEAST_SHARDS = 256 << 20, 64
#: Slots of a shard: one for each so many characters of input.
SLOT_CHARS = 4 << 30
FLUSH = 3_000_000
#: Places of byte pairs among the counted keys: behind those of all word pairs.
SPELLED = 1 << 2 * VOCAB_BITS
#: Bigrams of one row at most.
PIECE = 1 << 16


class Vocabulary(WordHash):
    """word -> its id, or, of a word without one, the log-probability of its spelling (0 or less)."""

    def __init__(self, hashes: np.ndarray, spelling: np.ndarray | None = None):
        super().__init__()
        self.hashes, self.spelling = hashes, spelling  # sorted; (byte, next byte) log-probabilities

    def __missing__(self, word):
        if len(self) >= self.LIMIT:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        at = int(np.searchsorted(self.hashes, np.uint64(h)))
        if at < len(self.hashes) and int(self.hashes[at]) == h:
            got = float(at + 1)
        else:
            got = 0.0 if self.spelling is None else float(self.spelling[spelled(word)].sum())
        self[word] = got
        return got

    def ids(self, text: str | None) -> tuple[np.ndarray, float]:
        """Ids of the words of a whole text (0: unknown), and the log-probability of the unknown ones' spellings."""
        words = words_of(text)
        got = np.fromiter(map(self.__getitem__, words), np.float64, len(words))
        return np.maximum(got, 0).astype(np.int64), float(np.minimum(got, 0).sum())


def spelled(word: bytes) -> np.ndarray:
    """Places of a word's byte pairs, its ends included, in a table of 256 x 256."""
    b = np.frombuffer(b"\0" + word + b"\0", np.uint8).astype(np.int64)
    return b[:-1] << 8 | b[1:]


def words_of(text: str | None) -> list[bytes]:
    """Words between white space, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more, from the counts of counts."""
    return discounts_of([float((counts == k).sum()) for k in (1, 2, 3, 4)])


def discounts_of(n: list[float]) -> np.ndarray:
    """The same from the numbers of counts 1, 2, 3 and 4."""
    if min(n[:3]) == 0 or n[0] + 2 * n[1] == 0:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n[0] / (n[0] + 2 * n[1])
    d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return np.array([0.0, *(min(max(x, 0.05), k) for x, k in zip(d, (0.95, 1.9, 2.9)))])


def kneser_ney(v: np.ndarray, w: np.ndarray, c: np.ndarray, size: int) -> dict:
    """Bigram counts (v, w, c) over ids below `size` -> the model's tables.

    p(w | v) = seen(v, w) + backoff[v] * lower[w]."""
    d = discounts(c)
    total = np.bincount(v, c, size)
    taken = d[np.minimum(c, 3)]
    seen = (c - taken) / total[v]
    backoff = np.ones(size)
    has = total > 0
    backoff[has] = np.bincount(v, taken, size)[has] / total[has]
    follow = np.bincount(w, minlength=size)  # different words before w
    return {"seen": seen, "backoff": backoff, "lower": continuation(follow)}


def continuation(follow: np.ndarray) -> np.ndarray:
    """Different words before each word -> the lower order's probabilities."""
    size, n = len(follow), follow.sum()
    if not n:
        return np.full(size, 1.0 / size)
    d = discounts(follow[follow > 0])
    taken = d[np.minimum(follow, 3)]
    return (follow - taken) / n + taken.sum() / n / size


#: One half of the trusted documents may teach the model, the other half sets the thresholds.
_TAUGHT = "pmod(xxhash64(13, doc_id), 2) = 0"


#: So many ids are broadcast at most (long keys); beyond, texts of that half meet them in a shuffle.
TAUGHT_BROADCAST = 4_000_000


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("q")).where("q = 1").select("doc_id")


def train(documents: DataFrame, labels: DataFrame, shards: int) -> dict | None:
    """The tables of vocabulary size for broadcast, and `counts`: the counts of known pairs by shard, written."""
    spark = prepare(documents.sparkSession)
    sc = Scratch(spark)
    ids = sc.write(trusted_ids(labels).where(_TAUGHT), "taught")
    texts = documents.select("doc_id", "text").where(_TAUGHT).join(broadcast_if_bounded(ids, TAUGHT_BROADCAST), "doc_id", "left_semi")
    taught = sc.write(texts, "trusted")

    def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHash()
        for pdf in batches:
            h = [hashes.array(w) for t in pdf["text"] if (w := words_of(t))]
            if h:
                h, n = np.unique(np.concatenate(h), return_counts=True)
                yield pd.DataFrame({"h": h.view(np.int64), "n": n})

    words = taught.mapInPandas(count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    known = words.orderBy(F.desc("n"), "h").limit(VOCABULARY).select("h").toPandas()["h"].to_numpy(np.int64)
    hashes = np.sort(known.view(np.uint64))
    size = len(hashes) + 1
    shared = spark.sparkContext.broadcast(hashes)

    def count_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary(shared.value)
        for pdf in batches:
            keys, spelt = [], set()
            for t in pdf["text"]:
                words = words_of(t)
                if words:
                    w = np.fromiter(map(vocabulary.__getitem__, words), np.float64, len(words)).astype(np.int64)
                    keys.append(np.r_[0, w[:-1]] << VOCAB_BITS | w)
                    spelt.update(words)
            if spelt:
                b = np.frombuffer(b"\0" + b"\0".join(spelt) + b"\0", np.uint8).astype(np.int64)
                keys.append(SPELLED + (b[:-1] << 8 | b[1:]))
            if keys:
                k, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pd.DataFrame({"k": k, "n": n})

    counted = sc.write(taught.mapInPandas(count_pairs, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")), "pairs")
    sc.drop("trusted", "taught")
    if not counted.limit(1).count():
        return None
    letters = counted.where(F.col("k") >= SPELLED).toPandas()  # at most 65,536
    spelling = np.full(1 << 16, 0.1)
    spelling[letters["k"].to_numpy(np.int64) - SPELLED] += letters["n"].to_numpy(float)
    spelling = spelling.reshape(256, 256)
    spelling = np.log(spelling / spelling.sum(1, keepdims=True)).astype(np.float32).ravel()
    pairs = counted.where(F.col("k") < SPELLED).select(F.expr(f"k div {1 << VOCAB_BITS}").alias("v"), F.expr(f"k % {1 << VOCAB_BITS}").alias("w"), "n")
    tables = _tables(pairs, size)
    d, total = tables.pop("discounts"), tables.pop("total")
    packed = (pairs.where("v > 0 and w > 0").withColumn("shard", (F.col("v") % shards).cast("int"))
              .groupBy("shard").applyInPandas(_pack(spark.sparkContext.broadcast((d, total)), shards), "shard int, keys binary, seen binary"))
    counts = sc.write(packed, "counts")
    sc.drop("pairs")
    return {"hashes": hashes, "spelling": spelling, **tables, "counts": counts}


def _tables(pairs: DataFrame, size: int) -> dict:
    """Counts of all word pairs (v, w, n) -> the model's tables, each of vocabulary size; no table of pairs leaves Spark."""
    classes = [F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]
    d = discounts_of([float(x or 0) for x in pairs.agg(*classes).first()])

    def by(df: DataFrame, col: str, **columns) -> list[np.ndarray]:
        got = df.groupBy(col).agg(*[c.alias(k) for k, c in columns.items()]).toPandas()
        out = []
        for k in columns:
            a = np.zeros(size, np.int64)
            a[got[col].to_numpy(np.int64)] = got[k].to_numpy(np.int64)
            out.append(a)
        return out

    total, one, two, more = by(pairs, "v", total=F.sum("n"), one=F.count_if(F.col("n") == 1), two=F.count_if(F.col("n") == 2),
                               more=F.count_if(F.col("n") > 2))
    [follow] = by(pairs, "w", follow=F.count(F.lit(1)))
    [first] = by(pairs.where("v = 0"), "w", n=F.sum("n"))
    [last] = by(pairs.where("w = 0"), "v", n=F.sum("n"))
    backoff, has = np.ones(size), total > 0
    backoff[has] = (one * d[1] + two * d[2] + more * d[3])[has] / total[has]
    seen = lambda c, n: ((c - d[np.minimum(c, 3)]) / np.maximum(n, 1)).astype(np.float32)
    return {"backoff": backoff.astype(np.float32), "lower": continuation(follow).astype(np.float32),
            "before": seen(first, total[0]), "after": seen(last, total), "discounts": d, "total": total}


def _pack(shared, shards: int):
    """Counts of a shard's word pairs -> rows of at most `PIECE` pairs, ascending."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        d, total = shared.value
        v, w, c = (pdf[x].to_numpy(np.int64) for x in ("v", "w", "n"))
        seen = ((c - d[np.minimum(c, 3)]) / total[v]).astype(np.float32)
        key = ((v // shards) << VOCAB_BITS | w).astype(np.uint32)
        order = np.argsort(key)
        key, seen = key[order], seen[order]
        return pd.DataFrame([(int(pdf["shard"].iloc[0]), key[a:a + PIECE].tobytes(), seen[a:a + PIECE].tobytes()) for a in range(0, len(key), PIECE)],
                            columns=["shard", "keys", "seen"])

    return run


_EVENTS = "shard int, docs binary, sizes binary, keys binary, logs binary, words binary"


def _deal(shared, shards: int):
    """Texts -> one row per shard: the known pairs of each document; the first row of a flush
    also holds what needs no join: the log-probability of pairs with the unknown word, and the words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        vocabulary = Vocabulary(m["hashes"], m["spelling"])
        docs, texts, spell, held, turn = [], [], [], 0, 0

        def flush():
            ids = np.array(docs, np.int64)
            size = np.array([len(w) for w in texts], np.int64)
            w = np.concatenate(texts)
            v = np.r_[0, w[:-1]] if len(w) else w.copy()
            v[(np.cumsum(size) - size)[size > 0]] = 0
            owner = np.repeat(np.arange(len(ids)), size)
            free = (v == 0) | (w == 0)
            fv, fw = v[free], w[free]
            p = np.where(fv == 0, m["before"][fw], m["after"][fv]) + m["backoff"][fv] * m["lower"][fw]
            logs = np.bincount(owner[free], np.log(p), len(ids)) + np.array(spell)
            v, w, owner = v[~free], w[~free], owner[~free]
            shard = v % shards
            order = np.argsort(shard.astype(np.int32), kind="stable")
            shard, owner = shard[order], owner[order]
            key = ((v // shards) << VOCAB_BITS | w)[order].astype(np.uint32)
            cut = np.searchsorted(shard, np.arange(shards + 1))
            for s in range(shards):
                for a in range(cut[s], max(cut[s + 1], cut[s] + 1), PIECE):
                    b = min(a + PIECE, cut[s + 1])
                    extra = s == turn % shards and a == cut[s]
                    mine, n = np.unique(owner[a:b], return_counts=True)
                    if extra:
                        mine, n = np.arange(len(ids)), np.bincount(owner[a:b], minlength=len(ids))
                    if len(mine):
                        yield (s, np.diff(ids[mine], prepend=0).tobytes(), n.astype(np.uint32).tobytes(), key[a:b].tobytes(),
                               logs.astype(np.float32).tobytes() if extra else b"", size.astype(np.uint32).tobytes() if extra else b"")

        for pdf in batches:
            for i, t in zip(pdf["doc_id"], pdf["text"]):
                docs.append(i)
                ids, log = vocabulary.ids(t)
                texts.append(ids)
                spell.append(log)
                held += len(texts[-1]) + 1
            if held >= FLUSH:
                yield pd.DataFrame(list(flush()), columns=["shard", "docs", "sizes", "keys", "logs", "words"])
                docs, texts, spell, held, turn = [], [], [], 0, turn + 1
        if docs:
            yield pd.DataFrame(list(flush()), columns=["shard", "docs", "sizes", "keys", "logs", "words"])

    return run


_SUMS = "home int, docs binary, logs binary, words binary"


def _join(shared, shards: int, homes: int):
    """A shard's counts (`table` rows) and behind them its rows of pairs -> the documents' sums, packed by home."""

    def one(m: dict, s, table_, seen, d, n, k, logs, words) -> Iterator[tuple]:
        ids, n, key = np.cumsum(np.frombuffer(d, np.int64)), np.frombuffer(n, np.uint32), np.frombuffer(k, np.uint32)
        at = np.searchsorted(table_, key)
        hit = np.where(table_[at] == key, seen[at], 0)
        v = (key >> np.uint32(VOCAB_BITS)).astype(np.int64) * shards + s
        p = hit + m["backoff"][v] * m["lower"][key & np.uint32(VOCABULARY)]
        total = np.bincount(np.repeat(np.arange(len(ids)), n), np.log(p), len(ids))
        size = np.frombuffer(words, np.uint32) if words else np.zeros(len(ids), np.uint32)
        if logs:
            total = total + np.frombuffer(logs, np.float32)
        home = ids % homes
        order = np.argsort(home, kind="stable")
        cut = np.searchsorted(home[order], np.arange(homes + 1))
        for h in np.flatnonzero(np.diff(cut)):
            o = order[cut[h]:cut[h + 1]]
            yield (h, np.diff(ids[o], prepend=0).tobytes(), total[o].astype(np.float32).tobytes(), size[o].tobytes() if words else b"")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, pieces, counts = None, [], None
        for pdf in batches:
            rows = []
            for s, slot, piece, d, n, k, logs, words in pdf.itertuples(index=False, name=None):
                if (s, slot) != of:
                    of, pieces, counts = (s, slot), [], None
                if piece >= 0:
                    pieces.append((np.frombuffer(k, np.uint32), np.frombuffer(logs, np.float32)))
                    continue
                if counts is None:
                    keys, seen = zip(*pieces) if pieces else ((), ())  # in any order: keys tell theirs
                    keys, seen = np.concatenate([np.empty(0, np.uint32), *keys]), np.concatenate([np.empty(0, np.float32), *seen])
                    order, pieces = np.argsort(keys, kind="stable"), []
                    counts = np.r_[keys[order], np.uint32(0xFFFFFFFF)], np.r_[seen[order], np.float32(0)]  # the last: none
                rows += one(shared.value, s, *counts, d, n, k, logs, words)
            yield pd.DataFrame(rows, columns=["home", "docs", "logs", "words"])

    return run


def _gather(pdf: pd.DataFrame) -> pd.DataFrame:
    ids = [np.cumsum(np.frombuffer(d, np.int64)) for d in pdf["docs"]]
    size = [np.frombuffer(w, np.uint32) if w else np.zeros(len(i), np.uint32) for i, w in zip(ids, pdf["words"])]
    doc, at = np.unique(np.concatenate(ids), return_inverse=True)
    logs = np.bincount(at, np.concatenate([np.frombuffer(x, np.float32) for x in pdf["logs"]]), len(doc))
    words = np.bincount(at, np.concatenate(size), len(doc)).astype(np.int64)
    ppl = np.where(words > 0, np.exp(np.minimum(-logs / np.maximum(words, 1), 700)), np.nan)
    return pd.DataFrame({"doc_id": doc, "n_words": words, "perplexity": [None if np.isnan(x) else x for x in ppl]})


def perplexities(documents: DataFrame, labels: DataFrame) -> DataFrame | None:
    """(doc_id, n_words, perplexity), written; None without a trusted document."""
    spark = prepare(documents.sparkSession)
    sc = Scratch(spark)
    texts = documents.where("doc_id is not null").select("doc_id", "text")
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = _power(max(LEAST_SHARDS, chars // SHARD_CHARS))
    model = train(texts, labels, shards)
    if model is None:
        return None
    counts = model.pop("counts")
    shared = spark.sparkContext.broadcast(model)  # five arrays of the size of the vocabulary
    events = texts.mapInPandas(_deal(shared, shards), _EVENTS)
    slots = max(1, chars // SLOT_CHARS)
    slot = F.pmod(F.xxhash64("docs"), F.lit(slots)).cast("int")
    none = F.lit(b"")
    table_ = counts.select("shard", F.explode(F.sequence(F.lit(0), F.lit(int(slots) - 1))).alias("slot"), F.lit(0).alias("piece"),
                           none.alias("docs"), none.alias("sizes"), "keys", F.col("seen").alias("logs"), none.alias("words"))
    dealt = events.select("shard", slot.alias("slot"), F.lit(-1).alias("piece"), "docs", "sizes", "keys", "logs", "words")
    met = table_.unionByName(dealt).repartition("shard", "slot").sortWithinPartitions("shard", "slot", F.desc("piece"))
    sums = met.mapInPandas(_join(shared, shards, shards), _SUMS)
    return sc.write(sums.groupBy("home").applyInPandas(lambda pdf: _gather(pdf), "doc_id long, n_words long, perplexity double"), "ppl")


def _power(n: int) -> int:
    """The next power of two, at most 1 << VOCAB_BITS."""
    return min(1 << VOCAB_BITS, 1 << max(0, int(n) - 1).bit_length())


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, lang, n_words, perplexity, threshold, keep) for every document row."""
    sc = Scratch(documents.sparkSession)
    docs = documents.select("doc_id", "lang")
    ppl = perplexities(documents, labels)
    if ppl is None:
        return docs.select("doc_id", "lang", F.lit(None).cast("long").alias("n_words"), F.lit(None).cast("double").alias("perplexity"),
                           F.lit(None).cast("double").alias("threshold"), F.lit(False).alias("keep"))
    trusted = docs.join(trusted_ids(labels), "doc_id", "left_semi").where(f"not ({_TAUGHT})").join(ppl, "doc_id")
    by = sc.write(trusted.groupBy("lang").agg(F.percentile_approx("perplexity", QUANTILE, 10000).alias("own")), "by")
    every = trusted.agg(F.percentile_approx("perplexity", QUANTILE, 10000)).first()[0]  # one number
    scored = docs.join(ppl, "doc_id", "left").join(broadcast_if_bounded(by.withColumnRenamed("lang", "of")), F.col("lang").eqNullSafe(F.col("of")), "left")
    limit = F.coalesce("own", F.lit(every).cast("double"))
    return scored.select("doc_id", "lang", "n_words", "perplexity", limit.alias("threshold"),
                         F.coalesce(F.col("perplexity") <= limit, F.lit(False)).alias("keep"))


def op4_quality_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and decision for every document."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
