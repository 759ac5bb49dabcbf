"""Byte-level BPE against the tiktoken library, on hypothesis texts and Spark rows."""

from __future__ import annotations

import base64
import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cardlake.llm import byte_codec
from cardlake.llm.byte_codec import RANKS, ByteCodec, byte_characters, decode_documents, encode_documents, op13_byte_bpe

PATH = str(public_tokenizers.path(RANKS))
with open(PATH, "rb") as f:
    LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks={base64.b64decode(t): int(r) for t, r in map(bytes.split, f)})
CODEC = ByteCodec(PATH, public_tokenizers.PATTERN)

# U+0558, U+A7CE, U+11DE0: in classes of a newer Unicode than the library's
ALPHABET = st.sampled_from(list("abcdeinorstTHE    \n\t.,'0123_².é▁ßñ漢字①🙂​　<>՘꟎\U00011de0\x00\x85᠎")) | st.characters(exclude_categories=["Cs"])


def _same(text):
    ids = LIBRARY.encode_ordinary(text)
    assert CODEC.encode(text).tolist() == ids
    assert CODEC.decode(ids) == LIBRARY.decode_bytes(ids) == text.encode()
    got, starts, ends = CODEC.offsets(text)
    assert got == ids
    covered = [False] * len(text)
    for i, a, b in zip(ids, starts, ends):
        part = text[a:b]
        assert CODEC.bytes_of[i] in part.encode()
        covered[a:b] = [True] * (b - a)
    assert all(covered)
    assert "".join(CODEC.texts(ids)) == text


@settings(max_examples=400, deadline=None)
@given(st.text(ALPHABET, max_size=60))
def test_any_text(text):
    _same(text)


@pytest.mark.parametrize("text", [" ", "   ", "a" * 5000, "ab" * 3000, " " * 7000 + "x" + " " * 33, "\n\n\n x", "the " * 400,
                                  "<|endoftext|> it's we'LL", "!!꟎!!", "漢" * 3000, "🙂" * 9, "՘a՘"])
def test_cases(text):
    _same(text)


def test_every_character_is_split_as_the_library_splits_it():
    texts = ["".join(chr(c) for c in range(a, a + 4096) if not 0xD800 <= c < 0xE000) for a in range(0, 0x110000, 4096)]
    for t in texts:
        if t:
            assert CODEC.encode(t).tolist() == LIBRARY.encode_ordinary(t)


def test_the_byte_table_is_one_to_one():
    shown = byte_characters()
    assert len(set(shown)) == 256 and shown[ord("A")] == "A" and shown[0] == "Ā" and shown[32] == "Ġ"


def test_blocks_and_a_full_memory_change_nothing(monkeypatch):
    text = "one two, three 12345 four.  five\n" * 200 + "x" * 100
    monkeypatch.setattr(byte_codec, "BLOCK", 7)
    monkeypatch.setattr(byte_codec, "MEMORY", 5)
    codec = ByteCodec(PATH, public_tokenizers.PATTERN)
    assert codec.encode(text).tolist() == LIBRARY.encode_ordinary(text)
    assert codec.offsets(text)[0] == LIBRARY.encode_ordinary(text)


def test_rows(spark):
    rows = [(1, None), (2, ""), (3, "one 漢字🙂"), (3, "one 漢字🙂"), (None, "x y " * 30_000)]
    df = spark.createDataFrame([(i, t, 9, "k") for i, t in rows], "doc_id long, text string, n_tokens int, pieces string")
    got = encode_documents(df, PATH)
    assert got.count() == 5
    for r in decode_documents(got, PATH).collect():
        ids = LIBRARY.encode_ordinary(r["text"] or "")
        assert (r["n_tokens"], list(r["ids"]), r["decoded"]) == (len(ids), ids, r["text"] or "")
        assert bytes(r["decoded_bytes"]) == (r["text"] or "").encode() and "".join(r["pieces"]) == (r["text"] or "")
        assert len(r["starts"]) == len(r["ends"]) == len(ids)
    for r in encode_documents(df, PATH, digests_only=True).collect():
        ids = LIBRARY.encode_ordinary(r["text"] or "")
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert encode_documents(df.limit(0), PATH).count() == 0


def test_decoding_split_and_unknown_ids(spark):
    smile = LIBRARY.encode_ordinary("🙂")
    assert len(smile) > 1
    df = spark.createDataFrame([(1, smile), (2, smile[:-1]), (3, None), (4, [10 ** 9, -1, None]), (5, [])], "k int, ids array<long>")
    got = {r["k"]: r for r in decode_documents(df, PATH).collect()}
    assert got[1]["decoded"] == "🙂" and got[1]["pieces"] == [""] * (len(smile) - 1) + ["🙂"]
    assert got[2]["decoded"] == "�" and got[2]["pieces"][-1] == "�"
    assert bytes(got[2]["decoded_bytes"]) == "🙂".encode()[:len(bytes(got[2]["decoded_bytes"]))]
    assert got[3]["decoded"] == got[4]["decoded"] == got[5]["decoded"] == ""


def test_query(spark):
    got = {r["doc_id"]: r for r in op13_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len({d["doc_id"] for d in docs})
    for d in docs:
        ids = LIBRARY.encode_ordinary(d["text"] or "")
        assert got[d["doc_id"]]["n_tokens"] == len(ids)
        assert got[d["doc_id"]]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
