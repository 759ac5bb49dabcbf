"""LM scoring: masked pseudo-likelihood of a bidirectional window network.

Every word of a text is predicted from the `REACH` words on either side of
it, itself masked out: its hidden state is the tanh of the sum of one
embedding per neighbour and place.  The vocabulary are the 32,767 most
frequent words of the whole corpus, each with an id of its own; every other
word is the unknown word (id 0), which a byte-pair model of the corpus's
unknown words spells out.  An id is predicted as its row (a softmax of
`ROWS`) and its column given the row (a second one of `SIDE`), so a word costs
384 logits.  A document's score is the sum of its words' log-probabilities,
unknown words' spellings included.

Training is data parallel: all documents are gathered into shards of
`SHARD_CHARS` characters; each round every shard runs stochastic gradient
descent over all its words from the common weights, and the shards' weights
are averaged, weighted by their words, `FAN` sets at a time.  So what is
learnt from, and what is shuffled, grows with the corpus, while weights keep
their size (about 8.5 MB).

A batch's softmaxes and products are one graph of onnxruntime (`graph.py`);
without it numpy computes the same, more slowly.

Defined cases: a null or blank text has 0 words, log-probability 0 and a null
mean; a table without words leaves the initial uniform model, in which every
word is the unknown one, unspelled; repeated rows score alike; rows with a null doc_id are scored, not learnt from.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm import graph as G
from cardlake.llm.common import Scratch, prepare, table
from cardlake.llm.quality_kn import Vocabulary  # noqa: F401 - the same ids and spellings, word by word

#: Ids fit 16 bits.
ROWS, SIDE = 128, 256
IDS = ROWS * SIDE
KNOWN = IDS - 1
PAD = IDS
REACH, HIDDEN = 2, 16
SHARD_CHARS = 32 << 20
ROUNDS, BATCH, RATE = 2, 512, 1.0
#: Sets of weights that meet in one task.
FAN = 16
#: Words scored together: their logits stay in the processor's cache.
CHUNK = 512
#: Words counted together.
FLUSH = 3_000_000


def new_model(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    f = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
    emb = f(2 * REACH, IDS + 1, HIDDEN)
    zero = lambda *s: np.zeros(s, np.float32)
    return {"emb": emb, "row": zero(HIDDEN, ROWS), "col": zero(HIDDEN, SIDE), "row_b": zero(ROWS), "col_b": zero(ROWS, SIDE)}


def neighbours(ids: np.ndarray, starts: np.ndarray, order: np.ndarray | None = None) -> np.ndarray:
    """(2 * REACH, words): the ids around each word, PAD past its document's ends.
    `starts`: first words of the documents that ids joins together; `order`: the words asked for."""
    sizes = np.diff(np.r_[starts, len(ids)])
    place = np.arange(len(ids)) + np.repeat(np.arange(1, len(starts) + 1) * REACH, sizes)
    apart = np.full(len(ids) + (len(starts) + 1) * REACH, PAD, np.int32)  # REACH pads between documents
    apart[place] = ids
    place = place if order is None else place[order]
    return np.stack([apart.take(place + shift) for shift in (*range(-REACH, 0), *range(1, REACH + 1))])


def _sums(m: dict, near: np.ndarray) -> np.ndarray:
    h = m["emb"][0].take(near[0], 0)
    for k in range(1, len(near)):
        h += m["emb"][k].take(near[k], 0)
    return h


def _hidden(m: dict, near: np.ndarray) -> np.ndarray:
    return np.tanh(h := _sums(m, near), out=h)


def _room(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Memory for the logits of n words and for their columns' biases, used again and again."""
    return np.empty((n, ROWS + SIDE), np.float32), np.empty((n, SIDE), np.float32)


_ONES = np.ones(SIDE, np.float32)


def _predict(m: dict, ids: np.ndarray, near: np.ndarray, room: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hidden states; e to the power of the row and column logits (in room; over their sum, the softmax);
    the sums of both; log p of the words."""
    n, at = len(ids), np.arange(len(ids))
    r, c = ids // SIDE, ids % SIDE
    h, x, bias = _hidden(m, near), room[0][:n], room[1][:n]
    m["col_b"].take(r, 0, out=bias, mode="clip")

    def logits() -> None:
        np.matmul(h, np.hstack([m["row"], m["col"]]), out=x)
        x[:, :ROWS] += m["row_b"]
        x[:, ROWS:] += bias

    def sums() -> np.ndarray:
        np.exp(x, out=x)
        return np.stack([x[:, :ROWS] @ _ONES[:ROWS], x[:, ROWS:] @ _ONES])

    logits()
    hit = x[at, r] + x[at, ROWS + c]
    with np.errstate(over="ignore"):
        total = sums()
    if not (total.min() > 1e-20 and total.max() < 1e30):  # large logits: less the largest of each softmax
        logits()
        for part in (x[:, :ROWS], x[:, ROWS:]):
            top = part.max(1)
            part -= top[:, None]
            hit -= top
        total = sums()
    return h, x, total, hit - np.log(total).sum(0)


_READ = {"sum": (G.FLOAT, 2), "at_r": (G.LONG, 2), "at_c": (G.LONG, 2), "row": (G.FLOAT, 2), "row_b": (G.FLOAT, 1), "col": (G.FLOAT, 2), "bias": (G.FLOAT, 2)}


def _softmaxes(op: str) -> list[bytes]:
    """Hidden states h and both softmaxes (p, q), as nodes of a graph."""
    return [G.node("Tanh", ["sum"], "h"), G.node("Gemm", ["h", "row", "row_b"], "x"), G.node("Gemm", ["h", "col", "bias"], "y"),
            G.node(op, ["x"], "p", axis=-1), G.node(op, ["y"], "q", axis=-1)]


@cache
def _score_graph():
    """log p of the words."""
    nodes = [*_softmaxes("LogSoftmax"), G.node("GatherElements", ["p", "at_r"], "p_hit", axis=1), G.node("GatherElements", ["q", "at_c"], "q_hit", axis=1),
             G.node("Add", ["p_hit", "q_hit"], "log_p")]
    return G.session(nodes, _READ, {"log_p": 2})


#: What _step_graph returns, with the ranks.
_STEP = {"h": 2, "dh": 2, "d_row": 2, "d_col": 2, "d_row_b": 2, "d_col_b": 2}


@cache
def _step_graph():
    """Hidden states; the logits' gradients (softmaxes, less 1 at the words themselves) times the weights (dh) and
    times the hidden states (d_row and d_col, a row for each logit), and their sums (d_row_b, d_col_b)."""
    less = [G.node("ScatterElements", [x, at, "less"], f"d{x}", axis=1, reduction="add") for x, at in (("p", "at_r"), ("q", "at_c"))]
    nodes = [*_softmaxes("Softmax"), *less,
             G.node("Gemm", ["dp", "row"], "dh_row", transB=1), G.node("Gemm", ["dq", "col", "dh_row"], "dh", transB=1),
             G.node("Gemm", ["dp", "h"], "d_row", transA=1), G.node("Gemm", ["dq", "h"], "d_col", transA=1),
             G.node("MatMul", ["ones", "dp"], "d_row_b"), G.node("ScatterND", ["zeros", "at_r", "dq"], "d_col_b", reduction="add")]
    return G.session(nodes, _READ | {"less": (G.FLOAT, 2), "ones": (G.FLOAT, 2), "zeros": (G.FLOAT, 2)}, _STEP)


def _feed(m: dict, ids: np.ndarray, near: np.ndarray, bias: np.ndarray) -> dict[str, np.ndarray]:
    """What both graphs read. bias: memory for the columns' biases."""
    r, c = np.divmod(ids.astype(np.int64, copy=False), SIDE)
    m["col_b"].take(r, 0, out=bias[:len(ids)], mode="clip")
    return {"sum": _sums(m, near), "at_r": r[:, None], "at_c": c[:, None], "row": m["row"], "row_b": m["row_b"], "col": m["col"], "bias": bias[:len(ids)]}


def log_probabilities(m: dict, ids: np.ndarray, near: np.ndarray) -> np.ndarray:
    """log p(word | its neighbours) of each word."""
    out, room = np.empty(len(ids), np.float32), _room(min(len(ids), CHUNK))
    for a in range(0, len(ids), CHUNK):
        some = ids[a:a + CHUNK], near[:, a:a + CHUNK]
        out[a:a + CHUNK] = _score_graph().run(["log_p"], _feed(m, *some, room[1]))[0][:, 0] if G.onnxruntime else _predict(m, *some, room)[-1]
    return out


def _subtract_at(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """A table's rows `at` (some repeat) less `rows`, two floats at a time as a complex number."""
    half = table.shape[-1] // 2
    np.subtract.at(table.reshape(-1).view(np.complex64), (at[:, None] * half + np.arange(half)).ravel(), rows.reshape(-1).view(np.complex64))


def _plain_step(m: dict, ids: np.ndarray, near: np.ndarray, room: tuple) -> tuple[np.ndarray, ...]:
    """What _step_graph returns, without it."""
    n, at = len(ids), np.arange(len(ids))
    r, c = ids // SIDE, ids % SIDE
    h, x, total, _ = _predict(m, ids, near, room)
    x[at, r] -= total[0]
    x[at, ROWS + c] -= total[1]
    p, q, (a, b) = x[:, :ROWS], x[:, ROWS:], 1 / total[:, :, None]  # the logits' gradients: p * a and q * b
    dh = (p @ m["row"].T) * a + (q @ m["col"].T) * b
    d_col_b = np.zeros_like(m["col_b"])
    _subtract_at(d_col_b, r, np.multiply(q, -b, out=room[1][:n]))
    return h, dh, p.T @ (a * h), q.T @ (b * h), a.T @ p, d_col_b


_NONE = np.zeros((ROWS, SIDE), np.float32)


def _graph_step(m: dict, ids: np.ndarray, near: np.ndarray, room: tuple) -> tuple[np.ndarray, ...]:
    one = np.ones((1, len(ids)), np.float32)
    return _step_graph().run(list(_STEP), _feed(m, ids, near, room[1]) | {"less": -one.T, "ones": one, "zeros": _NONE})


def gradient_step(m: dict, ids: np.ndarray, near: np.ndarray, rate: float, room: tuple | None = None) -> None:
    """One step of gradient descent on a batch."""
    h, dh, d_row, d_col, d_row_b, d_col_b = (_graph_step if G.onnxruntime else _plain_step)(m, ids, near, room or _room(len(ids)))
    step = np.float32(rate / len(ids))
    fast = 8 * step  # few words share an embedding
    m["row"] -= step * d_row.T
    m["col"] -= step * d_col.T
    m["row_b"] -= step * d_row_b[0]
    d_col_b *= fast
    m["col_b"] -= d_col_b
    dh *= (1 - h * h) * fast
    places = near + np.arange(len(near))[:, None] * (IDS + 1)
    _subtract_at(m["emb"], places.ravel(), np.broadcast_to(dh, (len(near), *dh.shape)))


def run_shard(m: dict, texts: list[np.ndarray], rate: float, seed: int) -> tuple[dict, int]:
    """Descend over all words of a shard once, in random order."""
    texts = [t for t in texts if len(t)]
    m = {k: v.copy() for k, v in m.items()}
    if not texts:
        return m, 0
    ids = np.concatenate(texts)
    size = np.array([len(t) for t in texts])
    order, room = np.random.default_rng(seed).permutation(len(ids)), _room(BATCH)
    near, ids = neighbours(ids, np.cumsum(size) - size, order), ids[order]
    for a in range(0, len(ids), BATCH):
        gradient_step(m, ids[a:a + BATCH], near[:, a:a + BATCH], rate, room)
    return m, len(ids)


def _descend(shared, rate: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, shard = pdf.sort_values(["doc_id", "ids"]), int(pdf["shard"].iloc[0])
        m, n = run_shard(shared.value, [np.frombuffer(b, np.int16).astype(np.int32) for b in pdf["ids"]], rate, shard)
        return pd.DataFrame({"part": [shard], "words": [n], "weights": [pickle.dumps(m)]})

    return run


def _average(pdf: pd.DataFrame) -> pd.DataFrame:
    """The mean of sets of weights, weighted by their words (a shard without words counts nothing)."""
    total = int(pdf["words"].sum())
    mean: dict = {}
    for n, b in zip(pdf["words"], pdf["weights"]):
        for name, w in pickle.loads(b).items():
            mean[name] = mean.get(name, 0) + w * np.float32(n / total if total else 1 / len(pdf))
    return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "words": [total], "weights": [pickle.dumps(mean)]})


def _words(texts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different words (`words_of`) of some texts and their hashes; which of them each word of the texts is; words per text."""
    text = pc.ascii_trim_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string(), from_pandas=True)))
    split = pc.ascii_split_whitespace(pc.if_else(pc.equal(text, ""), None, text))
    seen = split.flatten().dictionary_encode()
    words = seen.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return words, hashes, seen.indices.to_numpy(), pc.list_value_length(split).fill_null(0).to_numpy()


def _ids(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Ids of words by their hashes, 0 for those not among the known ones (sorted)."""
    if not len(known):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at + 1, 0)


def _byte_pairs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of some words' byte pairs, their ends included, in a table of 256 x 256 (`spelled`); pairs per word."""
    b = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8).astype(np.int64)
    return b[:-1] << 8 | b[1:], np.fromiter(map(len, words), np.int64, len(words)) + 1


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, counts, size = [], [], 0

    def counted() -> pd.DataFrame:
        h, at = np.unique(np.concatenate(held), return_inverse=True)
        return pd.DataFrame({"h": h.view(np.int64), "n": np.bincount(at, np.concatenate(counts)).astype(np.int64)})

    for pdf in batches:
        words, hashes, which, _ = _words(pdf["text"])
        held.append(hashes)
        counts.append(np.bincount(which, minlength=len(words)))
        size += len(which)
        if size >= FLUSH:
            yield counted()
            held, counts, size = [], [], 0
    if size:
        yield counted()


def _read(shared):
    """Documents as ids; and one row without a doc_id: the byte pairs of the unknown words, counted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = np.zeros(1 << 16, np.int64)
        for pdf in batches:
            words, hashes, which, sizes = _words(pdf["text"])
            ids = _ids(shared.value, hashes)
            unknown = np.flatnonzero(ids == 0)
            if len(unknown):
                at, each = _byte_pairs(words[unknown])
                times = np.bincount(which, minlength=len(words))[unknown]
                pairs += np.bincount(at, np.repeat(times, each), 1 << 16).astype(np.int64)
            texts = np.split(ids.astype(np.int16)[which], np.cumsum(sizes)[:-1])
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "ids": [t.tobytes() for t in texts[:len(pdf)]]})
        yield pd.DataFrame({"doc_id": pd.array([None], "Int64"), "ids": [pairs.tobytes()]})

    return run


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n = np.zeros(1 << 16, np.int64)
    for pdf in batches:
        for b in pdf["ids"]:
            n += np.frombuffer(b, np.int64)
    at = np.flatnonzero(n)
    yield pd.DataFrame({"at": at, "n": n[at]})


def train(documents: DataFrame) -> dict:
    """The weights, and (of a table with words) the vocabulary: `hashes` and `spelling`."""
    spark = prepare(documents.sparkSession)
    sc = Scratch(spark)
    docs = documents.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(4, -(-chars // SHARD_CHARS))

    counts = docs.mapInPandas(_count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    known = counts.orderBy(F.desc("n"), "h").limit(KNOWN).select("h").toPandas()["h"].to_numpy(np.int64)
    if not len(known):
        return new_model()
    hashes = np.sort(known.view(np.uint64))
    read = sc.write(docs.mapInPandas(_read(spark.sparkContext.broadcast(hashes)), "doc_id long, ids binary")
                    .withColumn("shard", F.pmod(F.xxhash64(F.lit(29), "doc_id"), F.lit(shards)).cast("int")), "words")
    words = read.where("doc_id is not null")
    letters = read.where("doc_id is null").mapInPandas(_pairs, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    spelling = np.full(1 << 16, 0.1)
    spelling[letters["at"].to_numpy(np.int64)] += letters["n"].to_numpy(float)
    spelling = spelling.reshape(256, 256)
    spelling = np.log(spelling / spelling.sum(1, keepdims=True)).astype(np.float32).ravel()
    model = new_model()
    for k in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)  # a fixed size
        rate = RATE / (1 + k)

        kind = "part int, words long, weights binary"
        apart = words.repartitionById(shards, "shard")  # each shard in a task of its own
        sets, left = apart.groupBy("shard").applyInPandas(_descend(shared, rate), kind), shards
        while left > 1:
            left = -(-left // FAN)
            sets = sets.withColumn("part", F.pmod("part", F.lit(left))).groupBy("part").applyInPandas(_average, kind)
        got = sets.collect()  # one set of weights
        if got:
            model = pickle.loads(bytes(got[0]["weights"]))
    sc.drop("words")
    return model | {"hashes": hashes, "spelling": spelling}


def score(documents: DataFrame, model: dict) -> DataFrame:
    """documents with `n_words`, `log_prob` (sum over all words) and `mean_log_prob`."""
    prepare(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        known, spelling = m.get("hashes", np.empty(0, np.uint64)), m.get("spelling")
        for texts in batches:
            words, hashes, which, size = _words(texts)
            ids, spell, total = _ids(known, hashes), np.zeros(len(words)), np.zeros(len(texts))
            unknown = np.flatnonzero(ids == 0)
            if spelling is not None and len(unknown):
                at, each = _byte_pairs(words[unknown])
                spell[unknown] = np.add.reduceat(spelling[at].astype(np.float64), np.cumsum(each) - each)
            full = np.flatnonzero(size)
            if len(full):
                joined, starts = ids[which], (np.cumsum(size) - size)[full]
                p = log_probabilities(m, joined, neighbours(joined, starts))
                total[full] = np.add.reduceat(p + spell[which], starts)
            mean = [s / n if n else None for s, n in zip(total, size)]
            yield pd.DataFrame({"n_words": size, "log_prob": total, "mean_log_prob": mean})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    udf = F.pandas_udf(run, "n_words long, log_prob double, mean_log_prob double")
    cols = [c for c in documents.columns if c not in ("n_words", "log_prob", "mean_log_prob")]
    return documents.withColumn("__lm", udf(F.col("text"))).select(*cols, "__lm.*")


def op10_lm_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, train(docs)).drop("text")
