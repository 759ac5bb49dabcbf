"""The audit against plain Python counting and the SQL, the transducer against sorted lists."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardlake.llm import source_audit
from cardlake.llm.source_audit import OP12_SQL, Transducer, audit, op12_source_audit, plain, probabilities

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute(rows, least=10):
    rows = [tuple("" if c is None else c for c in r) for r in rows]  # text, lang, source
    out = set()
    for lang in {r[1] for r in rows}:
        mine = [(TERM.findall(t.translate(LOWER)), s) for t, of, s in rows if of == lang]
        docs = Counter(w for words, _ in mine for w in set(words))
        kept = sorted((w for w in docs if docs[w] >= least), key=str.encode)
        v = len(kept)
        counts = {s: Counter() for _, s in mine}
        for words, s in mine:
            counts[s].update(w for w in words if docs[w] >= least)
        whole = sum(counts.values(), Counter())

        def p(c):
            n = sum(c.values())
            return {w: 1 + 1_000_000_000 * (c[w] + 2) // (n + 2 * v) for w in kept}

        ps, q = {s: p(c) for s, c in counts.items()}, p(whole)

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in counts:
            pairs = [(-sum(f(ps[s][w], ps[o][w]) for w in kept), o.encode(), o) for o in counts if o != s]
            terms = [(-f(ps[s][w], q[w]), w.encode(), w) for w in kept if counts[s][w] and ps[s][w] > q[w]]
            out |= {(lang, s, "pair", item, -value, i) for i, (value, _, item) in enumerate(sorted(pairs), 1)}
            out |= {(lang, s, "term", item, -value, i) for i, (value, _, item) in enumerate(sorted(terms)[:10], 1)}
    return out


def _rows(df):
    got = [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abcé漢", min_size=1, max_size=6), min_size=1, max_size=60), st.lists(st.text("abcé漢", min_size=1, max_size=7), max_size=20))
def test_ordinals(kept, others):
    terms = sorted(t.encode() for t in kept)
    t = Transducer.load(Transducer.build(terms).dump())
    assert list(t.terms()) == terms
    asked = terms + [o.encode() for o in others]
    stream = np.frombuffer(b" ".join(asked) + b" ", np.uint8)
    ends = np.cumsum([len(a) + 1 for a in asked]) - 1
    starts = ends - [len(a) for a in asked]
    assert t.ordinals(stream, starts, ends).tolist() == [terms.index(a) if a in terms else -1 for a in asked]


def test_the_transducer_is_minimal():
    t = Transducer.build(sorted(a + b for a in (b"a", b"b", b"cc") for b in (b"ing", b"ed", b"s")))
    assert len(t.final) == 7  # root, c, the shared stem end, i, n, one before d and g apart: e, and the end


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_terms_of_a_text(text):
    assert plain(text).split() == [w.encode("utf-8", "replace") for w in TERM.findall(text.translate(LOWER))]


def test_probabilities_are_exact():
    random = np.random.default_rng(5)
    for size in (10, 10 ** 6, 10 ** 12, 4 * 10 ** 15):
        counts = random.integers(0, size, 50)
        total, v = counts + random.integers(1, size, 50), 17
        wanted = [1 + 1_000_000_000 * (int(c) + 2) // (int(t) + 2 * v) for c, t in zip(counts, total)]
        assert probabilities(counts, total, v).tolist() == wanted


def _fixture():
    rows = [("Alpha beta-Beta GAMMA é", "en", "web")] * 12 + [("alpha alpha delta", "en", "book")] * 11 + [("12 ;;", "en", "empty")]
    rows += [("漢字 Été été", "fr", "web")] * 10 + [("漢字", "fr", None), (None, "fr", "news"), ("", "xx", "a"), ("rare", "xx", "b")]
    rows += [("alpha \x00beta\x7fgamma " * 3000, "en", "long"), ("a" * 50_000 + " alpha", "en", "long"), ("beta", None, None)]
    return rows + [(f"w{chr(97 + i % 7)} tie{chr(97 + i % 3)}", "de", f"s{i % 4}") for i in range(120)]


def test_small_rows(spark):
    rows = _fixture()
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "text string, lang string, source string, ordinal int, term string")
    wanted = _brute(rows)
    assert _rows(audit(df.repartition(5))) == wanted
    assert _rows(audit(df, least_docs=1)) == _brute(rows, 1)


def test_small_blocks_passes_and_slabs_change_nothing(spark, monkeypatch):
    rows = _fixture()
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    monkeypatch.setattr(source_audit, "HELD", 3)
    monkeypatch.setattr(source_audit, "STREAM", 64)
    assert _rows(audit(df, block_terms=2, pass_bytes=3000, slab=5)) == _brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert audit(df).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("text", "lang", "source").collect()
    got = _rows(op12_source_audit(spark, folder))
    assert got == _brute([tuple(r) for r in docs])
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    assert {tuple(r) for r in con.execute(OP12_SQL).fetchall()} == got
