"""Masked pseudo-likelihood: gradients, normalisation, learning, defined cases."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd
from pyspark import TaskContext

from cardlake.llm import lm_score as M
from cardlake.llm.quality_kn import words_of


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    m = M.new_model()
    for k in ("row", "col", "row_b", "col_b"):
        m[k] += rng.normal(0, 0.5, m[k].shape).astype(np.float32)
    near = np.repeat(rng.integers(0, M.IDS, (2 * M.REACH, 1)), M.IDS, 1)
    assert abs(np.exp(M.log_probabilities(m, np.arange(M.IDS), near).astype(float)).sum() - 1) < 1e-3


def test_a_word_does_not_see_itself_or_other_documents():
    ids = np.array([1, 2, 3, 4, 5])
    near = M.neighbours(ids, np.array([0, 3]))
    assert near.tolist() == [[M.PAD, M.PAD, 1, M.PAD, M.PAD], [M.PAD, 1, 2, M.PAD, 4], [2, 3, M.PAD, 5, M.PAD], [3, M.PAD, M.PAD, M.PAD, M.PAD]]


def test_a_step_follows_the_gradient():
    rng = np.random.default_rng(2)
    m = M.new_model()
    m["row"] += rng.normal(0, 0.3, m["row"].shape).astype(np.float32)
    ids, near = rng.integers(0, M.IDS, 64), rng.integers(0, M.IDS + 1, (4, 64))
    loss = lambda x: -float(M.log_probabilities(x, ids, near).astype(float).mean())
    before = {k: v.copy() for k, v in m.items()}
    rate = 1e-2
    M.gradient_step(m, ids, near, rate)
    for name, scale in (("row", 1), ("row_b", 1), ("col_b", 8), ("emb", 8)):
        g = (before[name] - m[name]) / (rate * scale)
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        up, down = {k: v.copy() for k, v in before.items()}, {k: v.copy() for k, v in before.items()}
        up[name][at] += 1e-2
        down[name][at] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - g[at]) < 0.05 * abs(g[at]) + 1e-4, name


def test_learning(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"a{k % 7} b{k % 7}" for k in rng.integers(0, 50, 120))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learnt = M.score(docs, M.train(docs)).agg({"mean_log_prob": "avg"}).first()[0]
    assert learnt > np.log(1 / M.IDS) + 2


def test_every_document_teaches(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD_CHARS", 100)  # more shards than meet in one task
    seen, run = spark.sparkContext.accumulator(0), M.run_shard

    def count(m, texts, rate, seed):
        seen.add(sum(len(t) for t in texts))
        return run(m, texts, rate, seed)

    monkeypatch.setattr(M, "run_shard", count)
    docs = spark.createDataFrame([(i, f"w{i} " * 10) for i in range(200)], "doc_id long, text string")
    M.train(docs)
    assert seen.value == M.ROUNDS * 2000


def test_words_are_told_apart(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 20000, 2000))) for i in range(60)]  # more words than 64 x 64
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    m = M.train(docs)
    distinct = sorted({w for _, t in rows for w in t.split()})
    ids = [int(M.Vocabulary(m["hashes"]).ids(w)[0][0]) for w in distinct]
    assert 0 not in ids and len(set(ids)) == len(distinct)
    many = docs.unionByName(spark.createDataFrame([(100, "seldom qqqq"), (101, "seldom seldon")], "doc_id long, text string"))
    got = {r.doc_id: r for r in M.score(many, m).collect()}
    assert got[100].log_prob != got[101].log_prob  # unknown words are spelled


def test_unknown_words_are_spelled_as_the_corpus_spells_them(spark, monkeypatch):
    monkeypatch.setattr(M, "KNOWN", 2)  # two known words
    docs = spark.createDataFrame([(1, "the the the of of abab baba abba")], "doc_id long, text string")
    m = M.train(docs)
    assert len(m["hashes"]) == 2
    v = M.Vocabulary(m["hashes"], m["spelling"])
    assert v.ids("the")[1] == 0 > v.ids("baab")[1] > v.ids("zzzz")[1]
    assert np.allclose(np.exp(m["spelling"].reshape(256, 256)).sum(1), 1, atol=1e-3)


def test_defined_cases(spark):
    rows = [(1, None), (2, " \n"), (3, "one"), (4, "one two three"), (4, "one two three"), (None, "word " * 50000)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, log_prob int")
    m = M.new_model()
    got = M.score(df, m).collect()
    assert [r.n_words for r in got] == [0, 0, 1, 3, 3, 50000]
    assert got[0].log_prob == 0 and got[0].mean_log_prob is None and got[3].log_prob == got[4].log_prob
    assert abs(got[3].mean_log_prob - np.log(1 / M.IDS)) < 0.01
    assert M.score(df.limit(0), M.train(df.limit(0))).count() == 0


def plain_step(m, ids, near, rate):
    """The weights after a step, one word at a time, in double precision."""
    m = {k: v.astype(float) for k, v in m.items()}
    new = {k: v.copy() for k, v in m.items()}
    for w, around in zip(ids.tolist(), near.T.tolist()):
        r, c = divmod(w, M.SIDE)
        h = np.tanh(sum(m["emb"][k][v] for k, v in enumerate(around)))
        dh = 0
        for logits, weights, biases, hit, fast in ((h @ m["row"] + m["row_b"], "row", new["row_b"], r, 1), (h @ m["col"] + m["col_b"][r], "col", new["col_b"][r], c, 8)):
            g = np.exp(logits - logits.max())
            g /= g.sum()
            g[hit] -= 1
            dh = dh + m[weights] @ g
            new[weights] -= rate / len(ids) * np.outer(h, g)
            biases -= fast * rate / len(ids) * g
        for k, v in enumerate(around):
            new["emb"][k][v] -= 8 * rate / len(ids) * dh * (1 - h * h)
    return new


def test_a_step_equals_one_word_at_a_time():
    for size in (0.3, 60):  # 60: exponentials overflow unless the largest logit is taken off
        rng = np.random.default_rng(5)
        m = M.new_model()
        for k in ("row", "col", "row_b", "col_b"):
            m[k] += rng.normal(0, size, m[k].shape).astype(np.float32)
        ids, near = rng.integers(0, 700, 40), rng.integers(0, 9, (4, 40))  # rows and neighbours repeat
        want, room = plain_step(m, ids, near, 0.5), M._room(64)
        M.gradient_step(m, ids, near, 0.5, room)
        for k in m:
            assert np.allclose(m[k], want[k], rtol=1e-3, atol=2e-5 * max(size, 1)), (size, k)


def test_scoring_holds_the_logits_of_few_words():
    rng = np.random.default_rng(6)
    m, ids, near = M.new_model(), rng.integers(0, M.IDS, 20000), rng.integers(0, M.IDS + 1, (4, 20000))
    tracemalloc.start()
    try:
        M.log_probabilities(m, ids, near)
        assert tracemalloc.get_traced_memory()[1] < 4 << 20  # all logits of 8,192 words are 12 MB
    finally:
        tracemalloc.stop()


def test_words_are_those_of_the_vocabulary():
    texts = ["", None, " \n\x0b", "One one\ttwo  ", "\x0cÄ ä\u00a0b\u2003c \x1cd", "a\0b \0 x\x85y", "LAST"]
    for some in (texts, texts[:3], []):
        words, hashes, which, sizes = M._words(pd.Series(some, dtype=object))
        assert words[which].tolist() == [w for t in some for w in words_of(t)]
        assert sizes.tolist() == [len(words_of(t)) for t in some]
        v = M.Vocabulary(known := np.sort(hashes[::2]))
        assert M._ids(known, hashes).tolist() == [int(v[w]) for w in words]
    near = M.neighbours(np.arange(10), np.array([0, 3, 4]))
    order = np.random.default_rng(7).permutation(10)
    assert (M.neighbours(np.arange(10), np.array([0, 3, 4]), order) == near[:, order]).all()


def test_every_shard_has_its_own_task(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD_CHARS", 1000)
    monkeypatch.setattr(M, "ROUNDS", 1)
    tasks, run = spark.sparkContext.accumulator(0), M.run_shard

    def count(m, texts, rate, seed):
        tasks.add(1 << 8 * TaskContext.get().partitionId())
        return run(m, texts, rate, seed)

    monkeypatch.setattr(M, "run_shard", count)
    M.train(spark.createDataFrame([(i, f"w{i} " * 10) for i in range(160)], "doc_id long, text string"))
    shards = [b for b in tasks.value.to_bytes(64, "little") if b]
    assert len(shards) > 4 and max(shards) == 1


def test_graphs_compute_what_numpy_computes(monkeypatch):
    rng = np.random.default_rng(8)
    for size in (0.3, 60):
        m = M.new_model()
        for k in ("row", "col", "row_b", "col_b"):
            m[k] += rng.normal(0, size, m[k].shape).astype(np.float32)
        ids, near = rng.integers(0, M.IDS, 1300).astype(np.int32), rng.integers(0, M.IDS + 1, (4, 1300))
        ids[::3] = 5  # a word that occurs often

        def result():
            new = {k: v.copy() for k, v in m.items()}
            for a in range(0, 1300, 500):
                M.gradient_step(new, ids[a:a + 500], near[:, a:a + 500], 0.5)
            return new | {"score": M.log_probabilities(m, ids, near)}

        with monkeypatch.context() as with_graphs:
            with_graphs.setattr(M, "_predict", None)  # neither a step nor a score goes by numpy's exponentials
            got = result()
        with monkeypatch.context() as without:
            without.setattr(M.G, "onnxruntime", None)
            want = result()
        for k in want:
            assert np.allclose(got[k], want[k], rtol=1e-3, atol=2e-5 * max(size, 1)), (size, k)
    assert M.log_probabilities(m, ids[:0], near[:, :0]).shape == (0,)
