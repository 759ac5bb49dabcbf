"""Benchmark decontamination against brute force, and planted passages."""

from __future__ import annotations

import numpy as np

from cardlake.llm.decontam import ItemIndex, allowed, find_contamination, nearest_passage, pair_hashes, words_of


def plain_distance(item, text):
    """Semi-global word edit distance by the textbook table."""
    row = [0] * (len(text) + 1)
    for k, x in enumerate(item, 1):
        new = [k]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_nearest_passage_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(300):
        item, text = rng.integers(1, 5, rng.integers(1, 9)), rng.integers(1, 5, rng.integers(0, 14))
        d, a, b = nearest_passage(item, text)
        assert d == plain_distance(item.tolist(), text.tolist())
        # the reported passage has this distance
        part = text[a:b].tolist()
        whole = np.arange(len(part) + 1)
        for k, x in enumerate(item.tolist(), 1):
            new = [k]
            for j, y in enumerate(part, 1):
                new.append(min(whole[j] + 1, new[-1] + 1, whole[j - 1] + (x != y)))
            whole = new
        assert whole[-1] == d


def edited(words, edits, rng):
    out = list(words)
    for _ in range(edits):
        k, at = rng.integers(3), rng.integers(len(out))
        if k == 0:
            out[at] = f"new{rng.integers(9999)}"
        elif k == 1:
            out.insert(at, f"more{rng.integers(9999)}")
        else:
            del out[at]
    return out


def test_recall_of_edited_passages():
    rng = np.random.default_rng(2)
    common = [f"c{k}" for k in range(30)]
    word = lambda: common[rng.integers(30)] if rng.random() < 0.5 else f"w{rng.integers(3000)}"
    items = [(k, " ".join(word() for _ in range(rng.integers(12, 60)))) for k in range(60)]
    index = ItemIndex(items)
    from cardlake.llm.common import WordHash

    hashes, hit, total = WordHash(), 0, 0
    for k, text in items:
        for share in (0.0, 0.5, 1.0):
            body = words_of(text)
            body = edited(body, int(allowed(len(body)) * share), rng)
            doc = [word() for _ in range(200)] + body + [word() for _ in range(150)]
            want = [i for i, t in items if plain_distance(words_of(t), doc) <= allowed(len(words_of(t)))]
            got = [index.items[m[1]][0] for m in index.matches([hashes.array(doc)])]
            assert set(got) <= set(want)  # the check is exact
            hit, total = hit + len(set(got)), total + len(want)
    assert hit / total >= 0.98, (hit, total)


def test_recall_at_full_edits_by_kind_and_length():
    from cardlake.llm.common import WordHash

    rng = np.random.default_rng(6)
    word = lambda: f"w{rng.integers(3000)}"
    hashes = WordHash()
    for n in (8, 16, 17, 33, 59, 120, 300):
        items = [(k, " ".join(word() for _ in range(n))) for k in range(40)]
        index = ItemIndex(items)
        place = {i: k for k, (i, _) in enumerate(index.items)}
        for kind in range(3):
            docs = []
            for _, t in items:
                body = t.split()
                for e in range(allowed(n)):
                    at = rng.integers(len(body))
                    body[at:at + (kind != 1)] = [] if kind == 2 else [f"new{e}"]
                docs.append(hashes.array([word() for _ in range(30)] + body + [word() for _ in range(30)]))
            got = {m[:2] for m in index.matches(docs)}
            assert sum((k, place[k]) in got for k in range(40)) >= 39, (n, kind)


def test_rows(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, f"x {item} y", 5), (2, "nothing here", 5), (3, None, 5), (4, "", 5), (None, item.upper(), 5),
                                  (1, f"x {item} y", 5), (6, "z " * 30000 + item.replace("five", "5"), 5)],
                                 "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(7, item, 1), (8, item, 1), (9, None, 1), (10, "", 1), (11, "two words", 1), (None, "x y z w v u", 1)],
                                  "item_id long, text string, doc_id int")
    got = sorted(((r.doc_id or 0), r.item_id, r.distance) for r in find_contamination(docs, bench).collect())
    assert got == [(0, 7, 0), (0, 8, 0), (1, 7, 0), (1, 7, 0), (1, 8, 0), (1, 8, 0), (6, 7, 1), (6, 8, 1)]
    row = find_contamination(docs, bench).where("doc_id = 1").first()
    assert (row.start, row.end) == (2, 2 + len(item))
    assert find_contamination(docs.limit(0), bench).count() == 0
    assert find_contamination(docs, bench.limit(0)).count() == 0


def test_bounds_before_the_exact_distance_lose_nothing():
    rng = np.random.default_rng(8)
    for _ in range(400):
        n = int(rng.integers(3, 40))
        item = rng.integers(1, 30, n).astype(np.uint64)
        own = item.tolist()
        for _ in range(int(rng.integers(0, allowed(n) + 3))):
            at = int(rng.integers(len(own) + 1))
            own[at:at + int(rng.integers(0, 2))] = rng.integers(1, 30, int(rng.integers(0, 2))).tolist()
        text = np.array([*rng.integers(1, 30, 9), *own, *rng.integers(1, 30, 9)], np.uint64)
        index = ItemIndex([])
        index.items = [(0, item)]
        exact, d = nearest_passage(item, text), allowed(n)
        short = nearest_passage(item, text, d)
        assert short == exact if exact[0] <= d else short[0] > d
        assert index._enough_pairs(0, pair_hashes(text)) or exact[0] > d
