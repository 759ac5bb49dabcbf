"""N-gram Jaccard join against brute force."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pytest

from cardlake.llm import jaccard_trie as J
from cardlake.llm.common import Scratch, components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus(rng, families, size):
    rows, i = [], 0
    for _ in range(families):
        base = [f"W{rng.integers(40)}" for _ in range(rng.integers(1, 120))]
        for _ in range(rng.integers(1, size)):
            own = list(base)
            for _ in range(rng.integers(0, 4)):
                own[rng.integers(len(own))] = f"w{rng.integers(40)}"
            rows.append((i, " ".join(own)))
            i += 1
    return rows


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80)])
def test_against_brute_force(spark, n, percent):
    rng = np.random.default_rng(n)
    rows = corpus(rng, 40, 7)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), n, percent).collect()}
    assert got == brute(rows, n, percent)


def test_a_block_of_many_chunks(spark, monkeypatch):
    """A group of near copies larger than a tile, most pairs just under or over the threshold."""
    monkeypatch.setattr(J, "TILE", 16)
    rng = np.random.default_rng(3)
    base = [f"t{k}" for k in range(80)]
    rows = []
    for i in range(150):
        own = list(base)
        for at in rng.integers(0, 80, 2 + i % 4):
            own[at] = f"x{rng.integers(5)}"
        rows.append((i, " ".join(own)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 4, 85)


def test_links_of_a_group_stay_linear(spark):
    """Near copies in chunks: the first pass gives fewer than two links a document and one class, so no chunks meet again."""
    for size in (512, 2048):
        rows = [(i, 40, 0, np.arange(40, dtype=np.uint64).tobytes(), 0, size // J.TILE) for i in range(size)]
        placed = spark.createDataFrame(rows, "doc_id long, n long, alone int, grams binary, block long, k int")
        links = J._chunk_links(placed.drop("alone"), 85).collect()
        assert size - 1 <= len(links) < 2 * size
        sc = Scratch(spark)
        large = placed.withColumnRenamed("block", "label").drop("k")
        assert J._cross_links(spark, sc, large, 85).count() == 0


def test_a_tile_joins_two_classes_once():
    seq = list(range(20))
    docs = [(i, 20, seq, i % 2, i % 2) for i in range(50)]
    assert len(J.link_tile(docs, 85, True)) == 1
    assert J.link_tile(docs[::2], 85, False) == []


def test_several_texts_under_one_id(spark):
    a, b = "a b c d e f g h", "m n o p q r s t"
    rows = [(1, a), (1, b), (2, a), (3, b)]
    got = {r.doc_id: r.component_id for r in J.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == 3 and got[2] != got[3] and got[1] == 1 and 1 in (got[2], got[3])


def test_homes_do_not_follow_the_stride_of_ids():
    count = np.bincount(J.home_of(np.arange(10_000, dtype=np.int64) * 1024, 64), minlength=64)
    assert count.max() < 250


def test_defined_cases(spark):
    long = " ".join(f"q{k % 5000}" for k in range(60000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one two three"), (7, "a b c d e f"), (7, "a b c d e f"),
            (8, long), (9, long + " end"), (None, "a b c d e f"), (10, "É a b"), (11, "é a b")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n_shingles int, block int")
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in J.jaccard_classes(df).collect() if r.doc_id)
    assert got == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 3, 7), (8, 5000, 8), (9, 5001, 8), (10, 1, 10), (11, 1, 11)]
    null = [tuple(r) for r in J.jaccard_classes(df).collect() if r.doc_id is None]
    assert null == [(None, None, None)]
    assert J.jaccard_classes(df.limit(0)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(9)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1040)]
    got = {r.node: r.label for r in components(spark, spark.createDataFrame(edges, "src long, dst long"), "t").collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in touched}
