"""N-gram Jaccard join with a prefix tree over globally ordered n-gram sets.

Words are `[^ \\t\\n\\v\\f\\r]+` of the text with A-Z lower-cased; a document's
set holds its distinct word n-grams (one for the whole sequence when it has
fewer words), as 64-bit hashes.  Two documents link when
100 * |A & B| >= percent * |A | B|.

The global order of n-grams is (document frequency, hash), rarest first:

1. Equal texts are one document (the smallest id stands for its copies).
2. n-grams are counted in buckets of the hash space.  They travel packed, one
   row per map task and bucket, so a frequent n-gram is never a hot key.  A
   bucket sends back only n-grams that two documents share.
3. A document that shares fewer than ceil(percent * n / 100) n-grams can link
   with nothing.  The others' ordered sets meet only if their prefixes, of
   n - ceil(percent * n / 100) + 1 n-grams, share one: documents joined by
   shared prefix n-grams form blocks (connected components).
4. Each block's sets go into a prefix tree, which every set of the block
   traverses; shared beginnings are matched once, subtrees are left when the
   matches so far plus the rest that remains cannot reach the threshold.  A
   block over `TILE` documents is dealt out as chunks, each of which also meets
   `PIVOTS` documents of the block: one pass, linear in the block's size, that
   leaves few classes of a group of near copies.  Then only documents with a
   prefix n-gram that two classes share are compared again, as pairs of chunks
   of near sizes and different classes.  Each pair is a bounded tile, which
   returns one link at most for two classes it joins; nothing is capped.
5. Links give classes (connected components).

Defined cases: a null text is empty; an empty document has 0 n-grams and
links with nothing; a row with a null doc_id takes no part and comes back
with null results; rows that repeat a doc_id with the same text count once
(doc_id is a key: of different texts under one id the one with the smallest
digest counts); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlake.llm.common import Scratch, WordHash, components, mix, prepare, table
from cardlake.operators.joins import broadcast_if_bounded

#: Documents of a block's chunk; a tile holds two chunks, or one and the block's pivots.
TILE = 128
#: Documents of a large block that all others of it are compared with first.
PIVOTS = 16
#: n-grams that a map task packs before it sends them on.
FLUSH = 4_000_000
_P = np.uint64(0x9E3779B97F4A7C15)


def ngram_hashes(text: str | None, n: int, hashes: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    w = hashes.array(words)
    size = min(n, len(w))
    h = w[:len(w) - size + 1].copy()
    for k in range(1, size):
        h = h * _P + w[k:len(w) - size + 1 + k]
    return np.unique(mix(h + np.uint64(size)))


def bucket_count(total_chars: int) -> int:
    """Buckets of about a million n-grams, of up to 64 million when there are many."""
    tokens = max(1, total_chars // 6)
    return int(max(64, -(-tokens // min(64_000_000, max(1_000_000, tokens // 4096)))))


def needed(n, percent: int):
    """Smallest number of shared n-grams that a set of n must have with a partner."""
    return -(-percent * n // 100)


def home_of(ids: np.ndarray, homes: int) -> np.ndarray:
    """Group of each document, whatever the stride of the ids."""
    return (mix(ids.astype(np.uint64)) % np.uint64(homes)).astype(np.int64)


_PACKED = "bucket int, docs binary, counts binary, grams binary, sizes binary"


def _pack(n: int, buckets: int):
    """Texts -> one row per bucket: the n-grams of the bucket (low 32 bits,
    document by document), and the set sizes of the documents it is home to."""

    def flush(ids, sets):
        ids = np.array(ids, np.int64)
        sizes = np.array([len(s) for s in sets], np.uint32)
        grams = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        b = ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(b, kind="stable")
        b, owner, grams = b[order], owner[order], grams[order]
        home = home_of(ids, buckets)
        cut = np.searchsorted(b, np.arange(buckets + 1))
        for k in range(buckets):
            own = owner[cut[k]:cut[k + 1]]
            at_home = np.flatnonzero(home == k)
            if not len(own) and not len(at_home):
                continue
            here, count = np.unique(np.concatenate([own, at_home.astype(np.int32)]), return_counts=True)
            is_home = np.isin(here, at_home)
            count = count - is_home
            yield (k, np.diff(ids[here], prepend=0).tobytes(), count.astype(np.uint32).tobytes(),
                   grams[cut[k]:cut[k + 1]].tobytes(), np.where(is_home, sizes[here].astype(np.int64), -1).tobytes())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, ids, sets, held = WordHash(), [], [], 0
        cols = ["bucket", "docs", "counts", "grams", "sizes"]
        for pdf in batches:
            for i, t in zip(pdf["doc_id"], pdf["text"]):
                s = ngram_hashes(t, n, hashes)
                ids.append(i)
                sets.append(s)
                held += len(s) + 1
            if held >= FLUSH:
                yield pd.DataFrame(list(flush(ids, sets)), columns=cols)
                ids, sets, held = [], [], 0
        if ids:
            yield pd.DataFrame(list(flush(ids, sets)), columns=cols)

    return run


_SHARED = "home int, docs binary, counts binary, grams binary, freq binary, sizes binary"


def _share(homes: int):
    """All n-grams of a bucket -> those in two documents or more, packed by the documents' home."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        docs, counts, sizes = [], [], []
        for d, c, s in zip(pdf["docs"], pdf["counts"], pdf["sizes"]):
            docs.append(np.cumsum(np.frombuffer(d, np.int64)))
            counts.append(np.frombuffer(c, np.uint32))
            sizes.append(np.frombuffer(s, np.int64))
        docs, counts, sizes = np.concatenate(docs), np.concatenate(counts), np.concatenate(sizes)
        grams = np.concatenate([np.frombuffer(g, np.uint64) for g in pdf["grams"]])
        owner = np.repeat(np.arange(len(docs), dtype=np.int64), counts)
        order = np.argsort(grams, kind="stable")
        g = grams[order]
        start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.empty(0, np.int64)
        freq = np.diff(np.r_[start, len(g)])
        each = np.empty(len(g), np.uint32)
        each[order] = np.repeat(freq, freq).astype(np.uint32)
        keep = each >= 2
        owner, grams, each = owner[keep], grams[keep], each[keep]
        count = np.bincount(owner, minlength=len(docs)).astype(np.uint32)
        used = (count > 0) | (sizes >= 0)
        home = home_of(docs, homes)
        by_doc = np.lexsort((docs, home))
        by_doc = by_doc[used[by_doc]]
        place = np.empty(len(docs), np.int64)
        place[by_doc] = np.arange(len(by_doc))
        order = np.argsort(place[owner], kind="stable")
        grams, each = grams[order], each[order]
        docs, count, sizes, home = docs[by_doc], count[by_doc], sizes[by_doc], home[by_doc]
        cut = np.searchsorted(home, np.arange(homes + 1))
        at = np.r_[0, np.cumsum(count)]
        rows = []
        for h in range(homes):
            a, b = cut[h], cut[h + 1]
            if a < b:
                rows.append((h, np.diff(docs[a:b], prepend=0).tobytes(), count[a:b].tobytes(),
                             grams[at[a]:at[b]].tobytes(), each[at[a]:at[b]].tobytes(), sizes[a:b].tobytes()))
        return pd.DataFrame(rows, columns=["home", "docs", "counts", "grams", "freq", "sizes"])

    return run


_SETS = "doc_id long, n long, alone int, grams binary"


def _collect_sets(percent: int):
    """A home's rows -> per document its size, and its ordered shared n-grams if it can have links."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        docs = np.concatenate([np.cumsum(np.frombuffer(d, np.int64)) for d in pdf["docs"]])
        counts = np.concatenate([np.frombuffer(c, np.uint32) for c in pdf["counts"]])
        sizes = np.concatenate([np.frombuffer(s, np.int64) for s in pdf["sizes"]])
        grams = np.concatenate([np.frombuffer(g, np.uint64) for g in pdf["grams"]])
        freq = np.concatenate([np.frombuffer(f, np.uint32) for f in pdf["freq"]])
        ids, place = np.unique(docs, return_inverse=True)
        n = np.zeros(len(ids), np.int64)
        np.maximum.at(n, place, sizes)
        owner = np.repeat(place, counts)
        order = np.lexsort((grams, freq, owner))
        owner, grams = owner[order], grams[order]
        new = np.r_[True, (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])] if len(owner) else np.empty(0, bool)
        owner, grams = owner[new], grams[new]
        at = np.searchsorted(owner, np.arange(len(ids) + 1))
        shared = np.diff(at)
        can = (shared >= needed(n, percent)) & (n > 0)
        return pd.DataFrame({"doc_id": ids, "n": n, "alone": (n - shared).astype(np.int32),
                             "grams": [grams[at[k]:at[k + 1]].tobytes() if c else None for k, c in enumerate(can)]})

    return run


def _stars(percent: int):
    """Sets -> (src, dst) edges from a document to the smallest one of the task
    that has the same prefix n-gram, and (gram, smallest) for the other tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs, grams, held = [], [], 0

        def out():
            d, g = np.concatenate(docs), np.concatenate(grams)
            order = np.lexsort((d, g))
            d, g = d[order], g[order]
            first = np.r_[True, g[1:] != g[:-1]]
            low = d[np.flatnonzero(first)]
            edge = np.unique(np.stack([d, np.repeat(low, np.diff(np.r_[np.flatnonzero(first), len(g)]))], 1), axis=0)
            edge = edge[edge[:, 0] != edge[:, 1]]
            yield pd.DataFrame({"gram": pd.array([None] * len(edge), "Int64"), "src": edge[:, 0], "dst": edge[:, 1]})
            yield pd.DataFrame({"gram": pd.array(g[first].astype(np.int64), "Int64"), "src": low, "dst": low})

        for pdf in batches:
            for i, n, alone, b in zip(pdf["doc_id"], pdf["n"], pdf["alone"], pdf["grams"]):
                take = n - needed(n, percent) + 1 - alone
                g = np.frombuffer(b, np.uint64)[:max(0, take)]
                if len(g):
                    docs.append(np.full(len(g), i, np.int64))
                    grams.append(g)
                    held += len(g)
            if held >= FLUSH:
                yield from out()
                docs, grams, held = [], [], 0
        if held:
            yield from out()

    return run


class _Node:
    __slots__ = ("seg", "kids", "docs", "low", "high", "deep")

    def __init__(self, seg):
        self.seg, self.kids, self.docs, self.low, self.high, self.deep = seg, {}, [], 1 << 60, 0, 0


class PrefixTree:
    """Path-compressed trie over ordered n-gram sequences; a node knows the
    smallest and largest set size and the longest sequence below it."""

    def __init__(self):
        self.root = _Node(())

    def add(self, seq: tuple, n: int, doc) -> None:
        node, i = self.root, 0
        while True:
            node.low, node.high, node.deep = min(node.low, n), max(node.high, n), max(node.deep, len(seq))
            if i == len(seq):
                node.docs.append(doc)
                return
            kid = node.kids.get(seq[i])
            if kid is None:
                kid = node.kids[seq[i]] = _Node(seq[i:])
                kid.low = kid.high = n
                kid.deep = len(seq)
                kid.docs.append(doc)
                return
            seg, k, most = kid.seg, 1, min(len(kid.seg), len(seq) - i)
            while k < most and seg[k] == seq[i + k]:
                k += 1
            if k < len(seg):  # the new sequence leaves the segment: split it
                top = _Node(seg[:k])
                top.low, top.high, top.deep = kid.low, kid.high, kid.deep
                kid.seg = seg[k:]
                top.kids[kid.seg[0]] = kid
                node.kids[seq[i]] = top
                kid = top
            node, i = kid, i + k

    def partners(self, members: frozenset, n: int, shared: int, percent: int, skip) -> Iterator:
        """Documents of the tree whose set links with the set `members` (`shared`
        of its n n-grams can match at all).  `skip(doc)`: no need to report it."""
        stack = [(self.root, 0, 0)]
        while stack:
            node, got, depth = stack.pop()
            got += len(members.intersection(node.seg))
            depth += len(node.seg)
            # a partner of size m needs got >= percent * (n + m) / (100 + percent)
            low, high = node.low, node.high
            reach = got + min(shared - got, node.deep - depth)
            if 100 * n < percent * low or 100 * high < percent * n or reach * (100 + percent) < percent * (n + low):
                continue
            for doc, m in node.docs:
                if got * (100 + percent) >= percent * (n + m) and not skip(doc):
                    yield doc
            stack.extend((kid, got, depth) for kid in node.kids.values())


def link_tile(docs: list[tuple], percent: int, cross: bool) -> list[tuple]:
    """Spanning links of a tile: docs = (id, n, ordered shared n-grams, side, label); documents
    of one label are linked already.  `cross`: only pairs of different sides count here."""
    parent = {d[4]: d[4] for d in docs}
    if len(parent) == 1:
        return []
    label = {d[0]: d[4] for d in docs}

    def find(x):
        x = label[x]
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    docs = sorted(docs, key=lambda d: (d[3], d[1], d[0]))
    out, tree = [], PrefixTree()
    for i, n, seq, side, _ in docs:
        if not cross or side != docs[0][3]:
            hits = tree.partners(frozenset(seq), n, len(seq), percent, lambda j: find(j) == find(i))
            for j in hits:
                parent[find(i)] = find(j)
                out.append((i, j))
        if not cross or side == docs[0][3]:
            tree.add(tuple(seq), n, (i, n))
    return out


def _tiles(percent: int):
    """Rows of tiles, those of a tile together -> its links."""

    def links(docs, cross):
        return link_tile([(i, n, np.frombuffer(g, np.uint64).tolist(), s, k) for i, n, g, s, k in docs], percent, cross)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, docs, crossed = None, [], False
        for pdf in batches:
            found = []
            for t, x, i, n, g, s, k in zip(pdf["tile"], pdf["cross"], pdf["doc_id"], pdf["n"], pdf["grams"], pdf["side"], pdf["label"]):
                if t != key:
                    if docs:
                        found += links(docs, crossed)
                    key, docs, crossed = t, [], x
                docs.append((i, n, g, s, k))
            if found:
                yield pd.DataFrame(found, columns=["src", "dst"])
        if docs and (found := links(docs, crossed)):
            yield pd.DataFrame(found, columns=["src", "dst"])

    return run


def _link(tiles: DataFrame, percent: int) -> DataFrame:
    """Links of tiles (tile, cross, doc_id, n, grams, side, label)."""
    parts = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tiles.repartition(parts, "tile").sortWithinPartitions("tile").mapInPandas(_tiles(percent), "src long, dst long")


def _chunk_links(placed: DataFrame, percent: int) -> DataFrame:
    """First pass, linear in a block's size: links inside each chunk of a block,
    and of every document of a large block with the block's pivots.

    placed: doc_id, n, grams, block, k (chunks of the block)."""
    chunk = F.pmod(F.xxhash64("doc_id"), F.col("k")).cast("int")
    large = placed.where("k > 1")
    pivot = (large.groupBy("block", "k", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(PIVOTS)).alias("slot"))
             .agg(F.min(F.struct(F.xxhash64(F.lit(5), "doc_id").alias("h"), "doc_id")).alias("p"))
             .select(F.col("p.doc_id").alias("doc_id"), "block", "k"))
    guests = (large.select("doc_id", "n", "grams").join(pivot, "doc_id")
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).drop("k"))
    rows = placed.withColumn("chunk", chunk).drop("k").unionByName(guests)
    return _link(rows.select(F.struct("block", "chunk").alias("tile"), F.lit(False).alias("cross"), "doc_id", "n", "grams",
                             F.lit(0).alias("side"), F.col("doc_id").alias("label")), percent)


def _prefixes(percent: int):
    """Sets -> (gram, doc_id, label) of their prefix n-grams."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            takes, grams = [], [np.empty(0, np.uint64)]
            for n, alone, b in zip(pdf["n"], pdf["alone"], pdf["grams"]):
                grams.append(np.frombuffer(b, np.uint64)[:max(0, n - needed(n, percent) + 1 - alone)])
                takes.append(len(grams[-1]))
            yield pd.DataFrame({"gram": np.concatenate(grams).view(np.int64), "doc_id": np.repeat(pdf["doc_id"].to_numpy(), takes),
                                "label": np.repeat(pdf["label"].to_numpy(), takes)})

    return run


def _cross_links(spark: SparkSession, sc: Scratch, large: DataFrame, percent: int) -> DataFrame:
    """Second pass over large blocks: links between documents that the first pass left in different classes.

    Only prefix n-grams that two classes share matter, so a document without
    any takes no part, and blocks are formed anew from these n-grams.  Sizes
    of partners are in the same or the next band, so chunks are of one band;
    two chunks of one class do not meet.

    large: doc_id, n, alone, grams, label (class of the first pass)."""
    rows = sc.write(large.mapInPandas(_prefixes(percent), "gram long, doc_id long, label long"), "prefixes")
    mixed = (rows.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("doc_id").alias("dst"))
             .where("low != high").select("gram", "dst"))
    near = rows.join(mixed, "gram").where("doc_id != dst").select(F.col("doc_id").alias("src"), "dst").distinct()
    blocks = components(spark, near, "cross").withColumnRenamed("label", "block").withColumnRenamed("node", "doc_id")
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent)) * (1 - 1e-9)).cast("int")  # partners: bands differ by 1 at most
    docs = sc.write(large.select("doc_id", "n", "grams", "label").join(blocks, "doc_id").withColumn("band", band), "cross-docs")
    own = docs.groupBy("block", "band", "label").agg(F.count("*").alias("c"))
    of = sc.write(own.withColumn("pure", F.when(F.col("c") > TILE, F.col("label")))
                  .withColumn("all", F.sum("c").over(Window.partitionBy("block", "band", "pure")))
                  .select("block", "band", "label", "pure", F.ceil(F.col("all") / TILE).cast("int").alias("k")), "cross-of")
    chunks = sc.write(of.select("block", "band", "pure", "k").distinct()
                      .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
                      .select("block", "band", "pure", "chunk", F.xxhash64("block", "band", "pure", F.col("pure").isNull(), "chunk").alias("id")),
                      "cross-chunks")
    x, y = chunks.alias("x"), chunks.alias("y")
    pairs = sc.write(x.join(y, "block").where("x.band = y.band and x.id <= y.id or x.band + 1 = y.band")
                     .where("x.pure is null or y.pure is null or x.pure != y.pure")
                     .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")), "cross-pairs")
    sides = (pairs.select("a", "b", F.col("a").alias("id"), F.lit(0).alias("side"))
             .unionByName(pairs.where("a != b").select("a", "b", F.col("b").alias("id"), F.lit(1).alias("side"))))
    placed = (docs.join(of, ["block", "band", "label"])
              .withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("k")).cast("int"))
              .withColumn("id", F.xxhash64("block", "band", "pure", F.col("pure").isNull(), "chunk")))
    tiles = placed.join(sides, "id").select(F.struct("a", "b").alias("tile"), (F.col("a") != F.col("b")).alias("cross"),
                                            "doc_id", "n", "grams", "side", "label")
    return _link(tiles, percent)


def jaccard_classes(documents: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document."""
    spark = prepare(documents.sparkSession)
    sc = Scratch(spark)
    text = F.coalesce("text", F.lit(""))
    heads = sc.write(documents.where("doc_id is not null").groupBy("doc_id")
                     .agg(F.min(F.struct(F.md5(text.cast("binary")).alias("digest"), F.length(text).alias("chars"))).alias("t"),
                          F.max(F.md5(text.cast("binary"))).alias("last"))
                     .select("doc_id", "t.*", "last"), "heads")
    total = heads.agg(F.sum("chars")).first()[0] or 0
    first = sc.write(heads.groupBy("digest").agg(F.min("doc_id").alias("rep")), "first")
    member = sc.write(heads.select("doc_id", "digest").join(first, "digest").select("doc_id", "rep"), "member")
    copies = member.where("rep != doc_id").select("doc_id")
    texts = (documents.where("doc_id is not null").select("doc_id", "text")
             .join(broadcast_if_bounded(copies), "doc_id", "left_anti"))
    unequal = heads.where("digest != last").select("doc_id", "digest")
    if unequal.limit(1).count():
        texts = (texts.join(broadcast_if_bounded(unequal), "doc_id", "left")
                 .where(F.col("digest").isNull() | (F.md5(text.cast("binary")) == F.col("digest"))).select("doc_id", "text"))

    buckets = bucket_count(total)
    packed = texts.mapInPandas(_pack(n, buckets), _PACKED)
    shared = packed.groupBy("bucket").applyInPandas(lambda pdf: _share(buckets)(pdf), _SHARED)
    sets = sc.write(shared.groupBy("home").applyInPandas(lambda pdf: _collect_sets(percent)(pdf), _SETS), "sets")

    able = sets.where("grams is not null")
    stars = sc.write(able.mapInPandas(_stars(percent), "gram long, src long, dst long"), "stars")
    across = (stars.where("gram is not null").groupBy("gram").agg(F.collect_set("src").alias("ends"))  # one per map task
              .where(F.size("ends") > 1)
              .select(F.array_min("ends").alias("dst"), F.explode("ends").alias("src")))
    near = stars.where("gram is null").select("src", "dst").unionByName(across.select("src", "dst"))
    blocks = components(spark, near.where("src != dst").distinct(), "block").withColumnRenamed("label", "block")

    count = sc.write(blocks.groupBy("block").agg(F.count("*").alias("c"))
                     .select("block", F.ceil(F.col("c") / TILE).cast("int").alias("k")).where("k > 1"), "count")
    placed = sc.write(able.join(blocks.withColumnRenamed("node", "doc_id"), "doc_id")
                      .join(broadcast_if_bounded(count), "block", "left").withColumn("k", F.coalesce("k", F.lit(1))), "placed")
    links = sc.write(_chunk_links(placed.drop("alone"), percent), "links")
    if count.limit(1).count():
        first_classes = components(spark, links, "chunked").withColumnRenamed("node", "doc_id")
        large = sc.write(placed.where("k > 1").select("doc_id", "n", "alone", "grams").join(first_classes, "doc_id", "left")
                         .withColumn("label", F.coalesce("label", "doc_id")), "large")
        links = links.unionByName(sc.write(_cross_links(spark, sc, large, percent), "cross-links"))
    classes = components(spark, links, "class").withColumnRenamed("node", "rep")

    of = sets.select(F.col("doc_id").alias("rep"), "n").join(classes, "rep", "left")
    of = sc.write(of.select("rep", F.col("n").alias("n_shingles"), F.coalesce("label", "rep").alias("component_id")), "of")
    sc.drop("heads", "first", "stars", "sets", "count", "placed", "links", "large", "prefixes", "cross-docs", "cross-of",
            "cross-chunks", "cross-pairs", "cross-links")
    # empty documents link with nothing, not even with other empty ones
    done = member.join(of, "rep").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    null = documents.where("doc_id is null").select(
        "doc_id", F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return done.unionByName(null)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id: 4-word shingles, 85 percent."""
    return jaccard_classes(table(spark, sf_dir, "documents"))
