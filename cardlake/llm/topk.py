"""Exact top-k inner products: one KD-tree per shard, searched best first.

Vectors are dealt to shards by a hash of their id.  A shard's KD-tree splits
at the median of its widest component; every node keeps the tight bounding
box of its vectors.  No vector in a box scores more against a query q than
sum(max(q * low, q * high)), so a traversal takes nodes by falling bound and
ends at the first bound below the k-th score known so far.  That k-th score
is propagated: each group of queries first meets a single shard, and carries
the scores found there, and then from shard to shard of a cell of the grid
(groups of queries x groups of shards).  A cell returns k rows a query at
most; the best k of all cells is the result.

Defined cases: a vector that is null, empty or holds a null or non-finite
component, or one whose component exceeds 2^28 after scaling (scores fit a
long), takes no part, nor does a row with a null vec_id; rows that repeat a
vec_id count once (the smallest vector); vectors only meet vectors of their
own length; ties go to the smaller vec_id; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import Scratch, prepare, table

#: Vectors of a shard, shards of a cell, vectors of a leaf.
SHARD, CELL_SHARDS, LEAF = 8192, 16, 256
LEAST_SHARDS = 64
#: Queries of a cell: a shard is sent once for each group of queries, so groups
#: grow with the queries (about QUERY_GROUPS of them) up to what a task holds.
CELL_QUERIES, MOST_QUERIES, QUERY_GROUPS = 256, 8192, 64
LARGEST = 1 << 28


class KdTree:
    """Nodes 0.. with bounding boxes; leaves hold slices of the reordered vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order, low, high, kids, span = np.arange(len(ids)), [], [], [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            part = vectors[order[a:b]]
            me = len(low)
            low.append(part.min(0))
            high.append(part.max(0))
            kids.append([-1, -1])
            span.append((a, b))
            if parent >= 0:
                kids[parent][side] = me
            width = high[-1] - low[-1]
            if b - a > LEAF and width.max() > 0:
                axis, half = int(width.argmax()), (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(part[:, axis], half, kind="introselect")]
                todo += [(a, a + half, me, 0), (a + half, b, me, 1)]
        self.ids, self.vectors = ids[order], vectors[order]
        self.low, self.high, self.kids, self.span = np.array(low), np.array(high), kids, span

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, (queries, nodes)."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, best: "Best") -> None:
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < best.kth:
                return
            left, right = self.kids[node]
            if left < 0:
                a, b = self.span[node]
                best.offer(self.vectors[a:b] @ query, self.ids[a:b], own)
            else:
                heapq.heappush(heap, (-bounds[left], left))
                heapq.heappush(heap, (-bounds[right], right))


class Best:
    """The k best (score, id) so far, ties to the smaller id; `kth` starts from what is known elsewhere."""

    def __init__(self, k: int, kth):
        self.k, self.kth = k, kth
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray, own: int) -> None:
        ok = (scores >= self.kth) & (ids != own)
        if not ok.any():
            return
        scores, ids = np.r_[self.scores, scores[ok].astype(np.int64)], np.r_[self.ids, ids[ok]]
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.kth = max(self.kth, int(self.scores[-1]))


def _matrix(blob: bytes, rows: int) -> np.ndarray:
    """int32 rows as a type in which their inner products are exact."""
    m = np.frombuffer(blob, np.int32).reshape(rows, -1)
    largest = int(np.abs(m.astype(np.int64)).max()) if m.size else 0
    return m.astype(np.float64 if largest ** 2 * m.shape[1] < 1 << 53 else np.int64)


_BLOCK = "part long, dim int, ids binary, vectors binary"


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id")
    return pd.DataFrame({"part": [pdf["part"].iloc[0]], "dim": [pdf["dim"].iloc[0]],
                         "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                         "vectors": [np.stack(pdf["v"].to_numpy()).astype(np.int32).tobytes()]})


_HITS = "query_id long, vec_id long, score long"


def _cell(k: int):
    """Query blocks (with the k-th scores known) x shards of a cell -> the cell's best k of each query."""

    def run(queries: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        out = []
        trees = []
        for ids, v in zip(shards["ids"], shards["vectors"]):
            ids = np.frombuffer(ids, np.int64)
            trees.append(KdTree(ids, _matrix(v, len(ids))))
        for ids, v, kth in zip(queries["ids"], queries["vectors"], queries["kth"]):
            own = np.frombuffer(ids, np.int64)
            q = _matrix(v, len(own))
            floor = np.frombuffer(kth, np.int64) if kth is not None else np.full(len(own), -(1 << 62))
            every = [t.bounds(q) if t.vectors.dtype == q.dtype else t.bounds(q.astype(np.int64)) for t in trees]
            for j, me in enumerate(own):
                best = Best(k, int(floor[j]))
                for t in sorted(range(len(trees)), key=lambda t: -every[t][j, 0]):  # the most promising shard first
                    trees[t].search(q[j].astype(trees[t].vectors.dtype), me, every[t][j], best)
                out.append(pd.DataFrame({"query_id": me, "vec_id": best.ids, "score": best.scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    return run


def _with_floor(k: int):
    """A query block and its first shard -> the block with each query's k-th score there."""
    first = _cell(k)

    def run(queries: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, block in queries.iterrows():
            hits = first(pd.DataFrame([block]).assign(kth=None), shards)
            ids = np.frombuffer(block["ids"], np.int64)
            kth = hits.groupby("query_id")["score"].agg(["size", "min"]).reindex(ids)
            floor = np.where(kth["size"] == k, kth["min"].fillna(0), -(1 << 62)).astype(np.int64)
            rows.append((block["part"], block["dim"], block["ids"], block["vectors"], floor.tobytes()))
        return pd.DataFrame(rows, columns=["part", "dim", "ids", "vectors", "kth"])

    return run


def quantised(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v: array<int>, dim): floor(scale * x) of every vector that takes part."""
    x = F.transform("embedding", lambda e: e.cast("double") * scale)
    good = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) <= LARGEST))
    return (embeddings.where("vec_id is not null and embedding is not null").select("vec_id", x.alias("x"))
            .where((F.size("x") > 0) & F.coalesce(good, F.lit(False)))
            .select("vec_id", F.transform("x", lambda e: F.floor(e).cast("int")).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")))


def top_k(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) of the queries, every row whose vec_id is divisible by `every`."""
    spark = prepare(embeddings.sparkSession)
    sc = Scratch(spark)
    v = sc.write(quantised(embeddings), "vectors")
    n = v.count()
    shards_n = max(LEAST_SHARDS, -(-n // SHARD))
    ask = v.where(F.col("vec_id") % every == 0)
    asked_n = ask.count()
    blocks_n = max(1, -(-asked_n // min(MOST_QUERIES, max(CELL_QUERIES, asked_n // QUERY_GROUPS))))
    groups_n = -(-shards_n // CELL_SHARDS)

    def packed(df, parts, salt):
        return df.withColumn("part", F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(parts))).groupBy("part", "dim").applyInPandas(_pack, _BLOCK)

    shards = sc.write(packed(v, shards_n, 1), "shards")
    blocks = sc.write(packed(ask, blocks_n, 2), "blocks")
    floor = (blocks.withColumn("shard", F.pmod("part", F.lit(shards_n))).groupBy("shard", "dim")
             .cogroup(shards.withColumn("shard", F.col("part")).groupBy("shard", "dim"))
             .applyInPandas(lambda a, b: _with_floor(k)(a, b), _BLOCK + ", kth binary"))
    floor = sc.write(floor, "floor")
    # the grid: each group of queries against all groups of shards, in blocks
    asked = floor.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(groups_n - 1)))).withColumn("row", F.col("part"))
    held = (shards.withColumn("cell", F.pmod("part", F.lit(groups_n)).cast("int"))
            .withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks_n - 1).cast("long")))))
    hits = (asked.groupBy("row", "cell", "dim").cogroup(held.groupBy("row", "cell", "dim"))
            .applyInPandas(lambda a, b: _cell(k)(a, b), _HITS))
    best = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("b"))
    return (best.select("query_id", F.posexplode(F.slice("b", 1, k)).alias("rank", "hit"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score")))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of every query vector."""
    return top_k(table(spark, sf_dir, "embeddings"))


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
