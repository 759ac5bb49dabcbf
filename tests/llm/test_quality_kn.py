"""Kneser-Ney: distributions, the sharded join against a direct computation, defined cases."""

from __future__ import annotations

import numpy as np
import pytest

from cardlake.llm import quality_kn as Q


def test_distributions_sum_to_one():
    rng = np.random.default_rng(1)
    size = 30
    k = np.unique(rng.integers(0, size * size, 300))
    v, w, c = k // size, k % size, rng.geometric(0.4, len(k))
    m = Q.kneser_ney(v, w, c, size)
    assert abs(m["lower"].sum() - 1) < 1e-9
    for x in range(size):
        assert abs(m["seen"][v == x].sum() + m["backoff"][x] * m["lower"].sum() - 1) < 1e-9


def test_discounts_follow_the_counts_of_counts():
    c = np.repeat([1, 2, 3, 4], [40, 20, 10, 5])
    y = 40 / 80
    assert np.allclose(Q.discounts(c), [0, 1 - 2 * y * 20 / 40, 2 - 3 * y * 10 / 20, 3 - 4 * y * 5 / 10])


def text(rng, n):
    return " ".join(f"w{min(int(x), 60)}" for x in rng.geometric(0.08, n))


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(2)
    rows = [(i, text(rng, int(rng.integers(1, 200))), "en" if i % 3 else None) for i in range(200)]
    rows += [(900, None, "en"), (901, " ", "en"), (902, "%% ## !!" * 30, "en"), (903, text(rng, 30000), "xx"), (None, "w1 w2", "en")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, n_words int")
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(200)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_sharded_join_equals_a_direct_computation(spark, tables, monkeypatch):
    monkeypatch.setattr(Q, "FLUSH", 3000)  # several rows for each shard
    rows, docs, labels = tables
    texts = docs.where("doc_id is not null").select("doc_id", "text")
    model = Q.train(texts, labels, 8)
    seen = {}
    for r in model["counts"].collect():
        for k, s in zip(np.frombuffer(r["keys"], np.uint32).tolist(), np.frombuffer(r["seen"], np.float32).tolist()):
            seen[(k >> Q.VOCAB_BITS) * 8 + r["shard"], k & Q.VOCABULARY] = s
    vocabulary = Q.Vocabulary(model["hashes"], model["spelling"])
    got = {r.doc_id: r for r in Q.perplexities(docs, labels).collect()}
    for i, t, _ in rows:
        if i is None:
            assert i not in got
            continue
        ids, log = vocabulary.ids(t)
        last = 0
        for w in ids.tolist():
            s = model["before"][w] if last == 0 else model["after"][last] if w == 0 else seen.get((last, w), 0)
            log += np.log(s + model["backoff"][last] * model["lower"][w])
            last = w
        assert got[i].n_words == len(ids)
        if len(ids):
            assert abs(np.log(got[i].perplexity) + log / len(ids)) < 1e-3
        else:
            assert got[i].perplexity is None


def test_a_frequent_word_is_dealt_in_small_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(Q, "PIECE", 50)
    rows, docs, labels = tables
    hot = docs.unionByName(spark.createDataFrame([(1000 + i, "w1 w2 w1 w3 " * 500, "en", 1) for i in range(10)], docs.schema))
    texts = hot.where("doc_id is not null").select("doc_id", "text")
    model = Q.train(texts, labels, 8)
    model.pop("counts")
    events = texts.mapInPandas(Q._deal(spark.sparkContext.broadcast(model), 8), Q._EVENTS)
    assert events.selectExpr("max(length(keys))").first()[0] <= 4 * 50
    small = {r.doc_id: r.perplexity for r in Q.perplexities(hot, labels).collect()}
    monkeypatch.setattr(Q, "PIECE", 1 << 16)
    whole = {r.doc_id: r.perplexity for r in Q.perplexities(hot, labels).collect()}
    assert small.keys() == whole.keys()
    assert all(small[i] == whole[i] or abs(np.log(small[i] / whole[i])) < 1e-3 for i in whole)


def test_decisions(spark, tables):
    rows, docs, labels = tables
    got = {r.doc_id: r for r in Q.classify(docs, labels).collect()}
    assert len(got) == len(rows)
    assert not got[900].keep and not got[901].keep and not got[902].keep and not got[None].keep
    assert sum(got[i].keep for i in range(200)) > 180
    none = Q.classify(docs, labels.limit(0))
    assert not any(r.keep for r in none.collect())
    assert Q.classify(docs.limit(0), labels).count() == 0


def test_every_trusted_document_of_the_half_teaches(spark):
    docs = spark.range(15000).selectExpr("id as doc_id", "concat('a b w', id, ' w', id) as text")
    labels = spark.range(15000).selectExpr("id as doc_id", "1 as quality")
    model = Q.train(docs, labels, 8)
    taught = docs.where(Q._TAUGHT).count()
    assert taught > 6000
    assert len(model["hashes"]) == taught + 2  # each document's own word occurs twice in it
    known = sum(len(r["keys"]) // 4 for r in model["counts"].collect())
    assert known == 1 + 2 * taught  # a b; b w<id>, w<id> w<id>


def test_tables_equal_those_of_one_task(spark):
    rng = np.random.default_rng(4)
    size, shards = 40, 4
    k = np.unique(rng.integers(0, size * size, 700))
    v, w, c = k // size, k % size, rng.geometric(0.4, len(k))
    m = Q.kneser_ney(v, w, c, size)
    got = Q._tables(spark.createDataFrame([tuple(map(int, x)) for x in zip(v, w, c)], "v long, w long, n long"), size)
    assert np.allclose(got["backoff"], m["backoff"]) and np.allclose(got["lower"], m["lower"])
    for name, pick, at in (("before", v == 0, w), ("after", w == 0, v)):
        want = np.zeros(size)
        want[at[pick]] = m["seen"][pick]
        assert np.allclose(got[name], want)


def test_slots_change_nothing(spark, tables, monkeypatch):
    rows, docs, labels = tables
    one = {r.doc_id: r.perplexity for r in Q.perplexities(docs, labels).collect()}
    monkeypatch.setattr(Q, "SLOT_CHARS", 50_000)
    monkeypatch.setattr(Q, "FLUSH", 3000)
    many = {r.doc_id: r.perplexity for r in Q.perplexities(docs, labels).collect()}
    assert one.keys() == many.keys()
    assert all(one[i] == many[i] or abs(np.log(one[i] / many[i])) < 1e-3 for i in one)
