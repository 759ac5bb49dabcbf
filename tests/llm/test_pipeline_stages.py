"""The pipeline against a brute-force version of each stage, on sf0.001 and on odd rows."""

from __future__ import annotations

import importlib
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

C = importlib.import_module("corpus_pipeline")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows by doc_id, as written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, root = [("documents", docs)], tmp_path_factory.mktemp("stages")
    for name, f in C.STAGES:
        f(spark, out[-1][1], SF).write.parquet(f"{root}/{name}")
        out.append((name, spark.read.parquet(f"{root}/{name}")))
    return dict(out)


def rows(df):
    return {r.doc_id: r.asDict() for r in df.collect()}


def test_toxicity(stages):
    before, after = rows(stages["documents"]), rows(stages["toxicity"])
    assert set(after) <= set(before) and all(after[i] == before[i] for i in after)
    assert len(after) > 0.8 * len(before)


def test_near_duplicates(stages):
    from test_jaccard_trie import brute

    before, after = rows(stages["toxicity"]), rows(stages["ngram_jaccard_join"])
    classes = brute([(i, r["text"]) for i, r in before.items()], 5, 80)
    assert set(after) == {i for i, (_, c) in classes.items() if c == i}
    assert all(after[i] == before[i] for i in after)


def test_decontamination(stages, spark):
    before, after = rows(stages["ngram_jaccard_join"]), rows(stages["benchmark_decontamination"])
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {i for i, r in before.items() if any(t in r["text"] for t in items)}
    assert dirty and not dirty & set(after)
    assert len(set(before) - set(after) - dirty) <= 0.02 * len(before)


def test_pii(stages):
    from cardlake.llm.pii import base_spans

    before, after = rows(stages["benchmark_decontamination"]), rows(stages["pii"])
    assert set(before) == set(after)
    for i, r in after.items():
        assert not base_spans(r["text"])
        assert r["n_chars"] == len(r["text"])
        if not base_spans(before[i]["text"]) and "<" not in r["text"]:
            assert r == before[i]


def test_encoding(stages):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    before, after = rows(stages["pii"]), rows(stages["sentencepiece"])
    assert set(before) == set(after)
    for i, r in after.items():
        assert r["ids"] == library.encode(before[i]["text"])


def test_odd_rows(spark):
    """Nulls, empty texts, repeated rows and extra columns go through every stage."""
    data = [(1, None, "en", "s", None, "x"), (2, "", "en", "s", 0, "x"), (None, "no id", None, None, 5, "x"), (None, "no id", None, None, 5, "x"),
            (3, "twice the same row of words", "en", "s", 27, "x"), (3, "twice the same row of words", "en", "s", 27, "x"), (4, "mail a@b.org", None, "s", 12, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, toxicity string")
    for name, f in C.STAGES[:-1]:
        docs = f(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "toxicity"], name
    got = sorted((r.doc_id or 0, r.text) for r in docs.collect() if r.text is not None)
    assert got == [(0, "no id"), (0, "no id"), (2, ""), (3, "twice the same row of words"), (4, "mail <email>")]
    coded = C.STAGES[-1][1](spark, docs, SF)
    assert coded.count() == 6 and coded.where("n_tokens = 0").count() == 2
    empty = spark.createDataFrame([], docs.schema)
    for _, f in C.STAGES:
        assert f(spark, empty, SF).count() == 0


def test_different_texts_under_one_id_are_no_copies(spark):
    a, b = "a b c d e f g h i j", "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, a), (1, b), (1, b), (2, a), (3, "alone in here"), (None, a)], "doc_id long, text string")
    kept = C.drop_near_duplicates(spark, docs, "")
    assert kept.columns == ["doc_id", "text"]
    rows = [tuple(r) for r in kept.collect()]
    assert sorted(t for i, t in rows if i) == sorted([a, b, "alone in here"]) and (1, b) in rows and (None, a) in rows
