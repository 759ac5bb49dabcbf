"""Base patterns against plain regular expressions; the tagger on unseen windows; the defined cases."""

from __future__ import annotations

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cardlake.llm import pii as P


def plain(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], P.KINDS.index(s[0])))


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from("0123456789.@+ -()ab%_\né٣"), max_size=60))
def test_base_patterns(text):
    assert P.base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    for t in ("1" * 200_000, "a" * 200_000 + "@", "1 " * 100_000, "+1 " * 60_000, "1." * 100_000, "@" * 100_000):
        P.base_spans(t)


def test_gradient():
    rng = np.random.default_rng(0)
    chars, tags = rng.integers(0, P.CLASSES, (12, 5)), rng.integers(0, P.TAGS, (12, 5))
    model = P.new_model(1)
    _, grad = P.loss_and_gradient(model, chars, tags)
    for name, g in grad.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, step = model[name][at], 2e-3
        model[name][at] = keep + step
        up, _ = P.loss_and_gradient(model, chars, tags)
        model[name][at] = keep - step
        down, _ = P.loss_and_gradient(model, chars, tags)
        model[name][at] = keep
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 0.02, name


def test_viterbi_and_the_margin_proof():
    rng = np.random.default_rng(4)
    emit, trans = rng.normal(0, 2, (5, 40, 3)), rng.normal(0, 1, (3, 3))
    got = P.viterbi(emit, trans)
    import itertools
    for b in range(40):
        best = max(itertools.product(range(3), repeat=5), key=lambda p: sum(emit[t, b, x] for t, x in enumerate(p)) + sum(trans[x, y] for x, y in zip(p, p[1:])))
        assert tuple(got[:, b]) == best
        margin = (emit[:, b, 0] - emit[:, b, 1:].max(1)).min()
        if margin >= 2 * max(0.0, trans.max() - trans[0, 0]):
            assert best == (0,) * 5
    emit[:, :, 0] += 9
    assert not P.viterbi(emit, trans).any()


def test_windows_cover_every_position():
    for n in (1, 511, 767, 768, 769, 1472, 1473, 5000):
        w = P.windows_of(n)
        assert w[0][2] == 0 and w[-1][3] == n
        assert all(x[3] == y[2] for x, y in zip(w, w[1:]))
        assert all(a <= x <= y <= b <= n for a, b, x, y in w)
        assert all((x - a >= P.CONTEXT or a == 0) and (b - y >= P.CONTEXT or b == n) for a, b, x, y in w)


def test_windows_read_little_twice():
    for n in range(769, 6000, 37):
        w = P.windows_of(n)
        assert len({b - a for a, b, _, _ in w}) == 1
        assert sum(b - a for a, b, _, _ in w) < n + (2 * P.CONTEXT + 1) * len(w)


def texts(rng, n):
    word = lambda: "".join(rng.choice(list("abcdeilmnorst"), rng.integers(2, 9)))
    out = []
    for _ in range(n):
        w = [word() for _ in range(rng.integers(10, 60))]
        w.insert(rng.integers(len(w)), f"{word()}@{word()}.org" if rng.random() < 0.5 else f"+1 {rng.integers(200, 999)} 555-{rng.integers(1000, 9999)}")
        out.append(" ".join(w))
    return out


def test_tagger_on_unseen_texts(spark):
    rng = np.random.default_rng(5)
    data = texts(rng, 500)
    docs = spark.createDataFrame(list(enumerate(data[:400])), "doc_id long, text string")
    model = P.train_tagger(docs)
    hit = total = 0
    for t in data[400:]:
        found = P.spans_of(P.decode(model, P.char_classes(t).reshape(-1, 1))[:, 0])
        want = P.base_spans(t)
        hit, total = hit + len(set(found) & set(want)), total + len(want)
    assert hit / total > 0.9, (hit, total)


def test_defined_cases(spark):
    rows = [(1, None, 7), (2, "", 7), (3, "to a.b@c.org, 10.0.0.1", 7), (3, "to a.b@c.org, 10.0.0.1", 7), (None, "x" * 40000 + " +44 20 7946 0958", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii_base int")
    got = P.find_spans(df, None).collect()
    assert [len(r.pii_spans) for r in got] == [0, 0, 2, 2, 1]
    assert [r.text for r in P.redact(df, None).collect()] == [None, "", "to <email>, <ip>", "to <email>, <ip>", "x" * 40000 + " <phone>"]
    assert P.train_tagger(df.where("text = ''").select("doc_id", "text")) is None
    assert P.find_spans(df.limit(0), None).count() == 0


def test_query(spark):
    got = P.op2_pii_bilstm_crf(spark, "/root/testdata/sf0.001").toPandas()
    import hashlib
    import duckdb
    docs = dict(duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall())
    assert len(got) == len(docs)
    for r in got.itertuples():
        base = plain(docs[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in P.KINDS)
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(filter(None, r.spans.split(",")))


def test_octets_of_any_length():
    from cardlake.llm.pii import _plausible, base_spans
    zeros = "0" * 5000
    assert base_spans(f"{zeros}.1.2.3") == [("ip", 0, 5006)]
    assert base_spans(f"{zeros}256.1.2.3") == [] and base_spans("9" * 5000 + ".1.2.3") == []
    assert _plausible("ip", f"1.2.3.{zeros}9") and not _plausible("ip", "1.2.3." + "9" * 5000)


def test_best_paths_are_found_without_a_table_of_all_steps_back():
    """The same tags as with every step back kept, ties included, in less time."""
    import time

    def plain(emit, trans):
        back, best = np.empty(emit.shape, np.int8), emit[0]
        for t in range(1, len(emit)):
            all_ = best[:, :, None] + trans[None]
            back[t], best = all_.argmax(1), all_.max(1) + emit[t]
        tags = np.empty(emit.shape[:2], np.int8)
        tags[-1] = best.argmax(1)
        for t in range(len(emit) - 1, 0, -1):
            tags[t - 1] = back[t][np.arange(emit.shape[1]), tags[t]]
        return tags

    def seconds(f):
        spent = []
        for _ in range(3):
            at = time.process_time()
            f()
            spent.append(time.process_time() - at)
        return min(spent)

    rng = np.random.default_rng(9)
    trans = rng.integers(-2, 3, (P.TAGS, P.TAGS)).astype(np.float32)
    emit = rng.integers(-3, 4, (300, 256, P.TAGS)).astype(np.float32)  # whole numbers: many ties
    before = emit.copy()
    assert (P.viterbi(emit, trans) == plain(emit, trans)).all() and (emit == before).all()
    assert seconds(lambda: P.viterbi(emit, trans)) < seconds(lambda: plain(emit, trans))


def test_tagging_holds_a_bounded_block():
    import tracemalloc

    model = P.new_model()
    data = ["some words and 12 of them, " * 1500] * 40  # 1.6 million characters
    tracemalloc.start()
    try:
        P.tag_texts(model, data)
        assert tracemalloc.get_traced_memory()[1] < 64e6
    finally:
        tracemalloc.stop()
