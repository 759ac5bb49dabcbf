"""SentencePiece codec against the library, on hypothesis texts and Spark rows."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cardlake.llm.piece_codec import MODEL, PieceCodec, encode_documents

PATH = str(public_tokenizers.path(MODEL))
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
CODEC = PieceCodec(PATH)

ALPHABET = st.sampled_from(list("abcdeinorstTHE    \n\t.,'0123_².é▁ßñ漢字①🙂​　<>")) | st.characters(exclude_categories=["Cs"])


def _same(text):
    ids = LIBRARY.encode(text)
    assert CODEC.encode(text) == ids
    assert CODEC.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.text(ALPHABET, max_size=60))
def test_any_text(text):
    _same(text)


@pytest.mark.parametrize("text", ["", " ", "   ", "a" * 500, "ab" * 300, " " * 700 + "x" + " " * 33, "\n\n\n x", "the " * 400,
                                  "<s> <0x0A> </s>", "▁▁a ▁", "\x00\x01", "aaaa aaa aa", "Thtieding. Onhe in haedea\nit ha"])
def test_cases(text):
    _same(text)


def test_rows(spark):
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "x" * 5000)]
    df = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, n_tokens int")
    got = encode_documents(df, PATH).collect()
    assert len(got) == 5
    for r in got:
        ids = LIBRARY.encode(r["text"] or "")
        assert (r["n_tokens"], list(r["ids"]), r["decoded"]) == (len(ids), ids, LIBRARY.decode(ids))
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert encode_documents(df.limit(0), PATH).count() == 0


def test_a_worker_keeps_no_words_after_its_task(spark):
    """Words remembered by one task would lie in the worker's memory under all later work."""
    import pandas as pd

    docs = spark.createDataFrame([(i, f"plain words and word{i}") for i in range(200)], "doc_id long, text string").repartition(2)
    encode_documents(docs).agg({"n_tokens": "sum"}).collect()

    def kept(batches):
        import sys
        for pdf in batches:
            codecs = [c for c in vars(sys.modules.get("_piece_codecs", sys)).values() if hasattr(c, "seen")]
            yield pd.DataFrame({"n": [sum(len(c.seen) for c in codecs)]})

    assert {r.n for r in spark.range(4, numPartitions=4).mapInPandas(kept, "n long").collect()} == {0}
