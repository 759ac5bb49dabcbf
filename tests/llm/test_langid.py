"""Language mixtures: held-out accuracy, EM, defined cases."""

from __future__ import annotations

import numpy as np

from cardlake.llm import langid as L


def test_em_recovers_proportions():
    rng = np.random.default_rng(1)
    logp = np.log(rng.dirichlet(np.full(300, 0.3), 3) + 1e-6)
    logp = np.pad(logp, ((0, 0), (0, L.BINS - 300)), constant_values=-30)
    p = np.exp(logp[:, :300])
    draw = lambda k, n: rng.choice(300, n, p=p[k] / p[k].sum())
    chosen, share = L.infer(logp, np.r_[draw(0, 1400), draw(2, 600)])
    found = dict(zip(chosen.tolist(), share))
    assert set(found) == {0, 2} and abs(found[0] - 0.7) < 0.06
    chosen, share = L.infer(logp, draw(1, 300))
    assert chosen.tolist() == [1]


def test_likelihood_never_falls():
    rng = np.random.default_rng(2)
    p, count = rng.random((50, 4)) + 0.01, rng.integers(1, 9, 50)
    last = -np.inf
    for rounds in range(1, 12):
        _, fit = L.mixture(p, count, np.ones(4), rounds)
        assert fit >= last - 1e-9
        last = fit


def test_held_out_accuracy(spark):
    got = L.op8_language_mixture(spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    held = both[both["held_out"]]
    assert len(held) > 100 and (held["lang_pred"] == held["lang"]).mean() > 0.95
    assert both["score"].between(0, 1).all()


def test_defined_cases(spark):
    rows = [(1, "the house and the garden of the king", "en"), (2, "das haus und der garten des königs", "de"), (3, None, "en"), (4, "", "de"),
            (5, "12 %% 4", None), (6, "the king", None), (6, "the king", None), (None, "und der " * 20000, "de")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, lang_score double")
    model = L.train(df, df["doc_id"].isNull() | (df["doc_id"] < 5))
    got = L.predict(df, model).collect()
    assert [r.lang_pred for r in got] == ["en", "de", "und", "und", "und", "en", "en", "de"]
    assert [r.lang_score for r in got][2:5] == [0.0] * 3
    nothing = L.train(df.limit(0), df["doc_id"].isNotNull())
    assert {r.lang_pred for r in L.predict(df, nothing).collect()} == {"und"}
    assert L.predict(df.limit(0), model).count() == 0
