"""FTRL toxicity: learning, sparsity, and the defined cases."""

from __future__ import annotations

import numpy as np

from cardlake.llm.toxicity import DIM, Ftrl, op6_toxicity_ftrl, score, train


def rows(rng, n):
    out = []
    for i in range(n):
        words = [f"w{rng.integers(400)}" for _ in range(rng.integers(5, 40))]
        bad = rng.random() < 0.3
        if bad:
            words.insert(rng.integers(len(words)), rng.choice(["vile", "rotten"]))
        out.append((i, " ".join(words), int(bad)))
    return out


def test_held_out_documents(spark):
    data = rows(np.random.default_rng(1), 600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in data], "doc_id long, quality int, toxic int")
    model = train(docs, labels, docs["doc_id"] < 400)
    assert 0 < len(model["index"]) // 4 < 200  # sparse
    got = {r.doc_id: r.toxicity for r in score(docs, model).collect()}
    hit = [(got[i] >= 0.5) == bool(y) for i, _, y in data if i >= 400]
    assert np.mean(hit) > 0.97


def test_ftrl_without_regularisation_fits_a_bias():
    x = [np.array([DIM])] * 400
    y = np.array(([1.0] + [0.0] * 3) * 100)
    w = Ftrl(l1=0.0, l2=0.0).fit(x, y, np.ones(400), 5)
    assert abs(1 / (1 + np.exp(-w[DIM])) - 0.25) < 0.08


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "vile", 0.5), (3, "vile", 0.5), (None, "word " * 40000, 0.5)],
                                 "doc_id long, text string, toxicity double")
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    model = train(docs.drop("toxicity"), labels, docs["doc_id"].isNotNull())
    got = score(docs, model).collect()
    assert len(got) == 5 and all(0 <= r.toxicity <= 1 for r in got)
    assert got[0].toxicity == got[1].toxicity and got[2].toxicity == got[3].toxicity
    none = train(docs, labels.limit(0), docs["doc_id"].isNotNull())
    assert all(r.toxicity < 1e-9 for r in score(docs, none).collect())
    assert score(docs.limit(0), none).count() == 0


def test_query_over_the_small_tables(spark):
    got = op6_toxicity_ftrl(spark, "/root/testdata/sf0.001")
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "boolean", "double", "int"]
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
