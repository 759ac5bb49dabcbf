"""Source divergence audit over a minimal acyclic transducer vocabulary.

Which sources of a language word things alike, and which terms set a source
apart from its language?  A language keeps the terms found in at least
LEAST_DOCS of its documents.  Its kept terms, sorted by their UTF-8 bytes, are
built into minimal acyclic transducers whose paths add up to a term's
lexicographic ordinal.  All texts then stream through them once more for the
counts of each (lang, source), and ordinals stand for terms until the end:
they are what is shuffled, and they break ties.

A transducer holds at most BLOCK_TERMS terms, neighbours in order; a token is
led to its block by its first eight bytes.  Blocks are broadcast PASS_BYTES
at a time, and each such pass reads only the texts of the languages in it, so
a vocabulary of any size is counted in bounded memory.  Occurrences are added
up within a task before the shuffle.  The sums over pairs of sources are made
in slabs of neighbouring ordinals, at most SLAB counts each, so a language
with a third of all text is many slabs; their work is V x (sources squared),
the size that the pairs themselves ask for.

Defined cases: null text, lang or source counts as ''; a document is a row, so
repeated rows are several documents; texts without a term count nothing, but
their (lang, source) is a group; a language without kept terms gives value 0
for its pairs and no terms; other columns of the input, whatever their names,
are not read; an empty table gives no rows.  Very long texts are read whole,
in pieces cut between terms.
"""

from __future__ import annotations

import io
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlake.llm.common import Scratch, prepare, table

LEAST_DOCS = 10
#: Scale of p, and what is added to each count.
SCALE, PRIOR = 1_000_000_000, 2
#: Ranks of part `term`.
TERMS = 10
BLOCK_TERMS, PASS_BYTES = 200_000, 64 << 20
#: Counts (sources x terms) of a slab; terms or counts a task holds; bytes of text that stream at a time.
SLAB, HELD, STREAM = 1 << 18, 400_000, 1 << 21

_SPACE = 0x20
#: A-Z lower-cased, every other ASCII character that is no letter a space.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else _SPACE for b in range(256))


def plain(text: str | None) -> bytes:
    """The text's bytes with terms in lower case and spaces between them."""
    return text.encode("utf-8", "replace").translate(_LETTERS) if text else b""


class Transducer:
    """Minimal acyclic transducer from sorted terms to their ordinals.

    An edge (state, byte) lies at place base[state] + byte of one array;
    owner says whose it is.  Its `skip` is the number of terms of the state
    that sort before all terms of the edge, so skips add up to the ordinal.
    """

    FIELDS = ("base", "final", "owner", "target", "skip")

    def __init__(self, **arrays: np.ndarray):
        for f in self.FIELDS:
            setattr(self, f, arrays[f])

    @classmethod
    def build(cls, terms) -> "Transducer":
        """`terms`: distinct bytes in ascending order."""
        known: dict[tuple, int] = {}
        finals, edges, sizes = [], [], []

        def settle(node) -> int:
            """The one state that has this finality and these edges."""
            key = (node[0], tuple(node[1]))
            state = known.get(key)
            if state is None:
                state = known[key] = len(finals)
                finals.append(node[0])
                edges.append(key[1])
                sizes.append(node[0] + sum(sizes[t] for _, t in key[1]))
            return state

        path, last = [(False, [])], b""
        for term in [*terms, b""]:  # the last one settles what is left
            same = 0
            while same < len(term) and same < len(last) and term[same] == last[same]:
                same += 1
            while len(path) - 1 > same:
                state = settle(path.pop())
                path[-1][1].append((last[len(path) - 1], state))
            path += [(False, []) for _ in term[same:]]
            if term:
                path[-1] = (True, path[-1][1])
            last = term
        root = settle(path[0])
        # the root is numbered 0 (it is settled last)
        order = [root, *[s for s in range(len(finals)) if s != root]]
        number = {s: i for i, s in enumerate(order)}
        return cls._place([finals[s] for s in order], [[(b, number[t], sizes[t]) for b, t in edges[s]] for s in order])

    @classmethod
    def _place(cls, finals, edges) -> "Transducer":
        total = sum(map(len, edges))
        size = 2 * total + 1024
        free = np.ones(size, bool)
        free[:256] = False
        base = np.zeros(len(edges), np.int32)
        wide = sorted((s for s, e in enumerate(edges) if len(e) > 1), key=lambda s: -len(edges[s]))
        start = 0
        for s in wide:
            marks, at = [b for b, _, _ in edges[s]], start
            while True:
                while at + 4096 + 256 > len(free):
                    free = np.r_[free, np.ones(len(free), bool)]
                fits = free[at + marks[0]:at + marks[0] + 4096].copy()
                for b in marks[1:]:
                    fits &= free[at + b:at + b + 4096]
                hit = int(fits.argmax())
                if fits[hit]:
                    break
                at += 4096
            if at - start > 16384:  # what lies further back is nearly full
                start = at
            base[s] = at + hit
            free[[at + hit + b for b in marks]] = False
        single = [s for s, e in enumerate(edges) if len(e) == 1]
        places = np.flatnonzero(free)
        if len(places) < len(single):
            places = np.r_[places, len(free) + np.arange(len(single))]
        for s, p in zip(single, places.tolist()):
            base[s] = p - edges[s][0][0]
        size = int(base.max(initial=0)) + 256
        owner, target, skip = np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size, np.int32)
        for s, e in enumerate(edges):
            before = int(finals[s])
            for b, t, n in e:
                p = base[s] + b
                owner[p], target[p], skip[p] = s, t, before
                before += n
        return cls(base=base, final=np.array(finals, bool), owner=owner, target=target, skip=skip)

    def ordinals(self, stream: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ordinal of each token stream[start:end] (not empty), -1 if it is no kept term: all tokens go on by one byte at a time."""
        out = np.full(len(starts), -1, np.int64)
        who, at, end = np.arange(len(starts)), starts, ends
        state, sums = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int64)
        while len(who):
            place = self.base[state] + stream[at]
            on = np.flatnonzero(self.owner[place] == state)
            who, place, end, at = who[on], place[on], end[on], at[on] + 1
            state, sums = self.target[place], sums[on] + self.skip[place]
            over = at == end
            done = over & self.final[state]
            out[who[done]] = sums[done]
            on = np.flatnonzero(~over)
            who, at, end, state, sums = who[on], at[on], end[on], state[on], sums[on]
        return out

    def terms(self) -> Iterator[bytes]:
        """All terms in the order of their ordinals."""
        places = np.flatnonzero(self.owner >= 0)
        owners = self.owner[places]
        edges: dict[int, list[tuple[int, int]]] = {}
        for p, s, b in zip(places.tolist(), owners.tolist(), (places - self.base[owners]).tolist()):
            edges.setdefault(s, []).append((b, int(self.target[p])))
        final, waiting = self.final.tolist(), [(0, b"")]
        while waiting:
            state, term = waiting.pop()
            if final[state]:
                yield term
            waiting += [(t, term + bytes((b,))) for b, t in reversed(edges.get(state, ()))]

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> "Transducer":
        return cls(**np.load(io.BytesIO(raw)))


def _key(term: bytes) -> int:
    return int.from_bytes(term[:8].ljust(8, b"\0"), "big")


class Vocabulary:
    """Some blocks of the languages' kept terms."""

    def __init__(self, blocks):
        """blocks: (lang, first term, ordinal of the first term, transducer), in order."""
        self.of: dict[str, list[tuple[int, Transducer]]] = {}
        self.keys: dict[str, list[int]] = {}
        for lang, first, ordinal, transducer in blocks:
            self.of.setdefault(lang, []).append((ordinal, transducer))
            self.keys.setdefault(lang, []).append(_key(first))

    def ordinals(self, lang: str, stream: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        blocks = self.of.get(lang, [])
        if len(blocks) == 1:
            out = blocks[0][1].ordinals(stream, starts, ends)
            return np.where(out < 0, out, out + blocks[0][0])
        out = np.full(len(starts), -1, np.int64)
        if not blocks:
            return out
        padded = np.r_[stream, np.zeros(8, np.uint8)]
        mark = np.zeros(len(starts), np.uint64)
        for i in range(8):
            byte = np.where(starts + i < ends, padded[starts + i], 0).astype(np.uint64)
            mark = (mark << np.uint64(8)) | byte
        keys = np.array(self.keys[lang], np.uint64)
        low = np.searchsorted(keys, mark, "left") - 1  # equal beginnings may lie in several blocks
        high = np.searchsorted(keys, mark, "right") - 1
        for k, (ordinal, transducer) in enumerate(blocks):
            here = np.flatnonzero((low <= k) & (k <= high))
            found = transducer.ordinals(stream, starts[here], ends[here])
            out[here[found >= 0]] = found[found >= 0] + ordinal
        return out


def _document_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, term, number of documents), added up within the task."""
    found: dict[str, Counter] = {}

    def flush():
        for lang, counts in found.items():
            if counts:
                yield pd.DataFrame({"lang": lang, "term": list(counts), "docs": list(counts.values())})
        found.clear()

    for pdf in batches:
        for lang, text in zip(pdf["lang"], pdf["text"]):
            counts = found.get(lang)
            if counts is None:
                counts = found[lang] = Counter()
            counts.update(set(plain(text).split()))
            if len(counts) > HELD:
                yield from flush()
        if sum(map(len, found.values())) > HELD:
            yield from flush()
    yield from flush()


def kept_terms(documents: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term: binary) of documents' (lang, text)."""
    counted = documents.select("lang", "text").mapInPandas(_document_terms, "lang string, term binary, docs long")
    return counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).select("lang", "term")


def _blocks(most: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lang, terms = None, []

        def block():
            raw = Transducer.build(terms).dump()
            return pd.DataFrame({"lang": [lang], "first": [terms[0]], "terms": [len(terms)], "size": [len(raw)], "transducer": [raw]})

        for pdf in batches:
            for of, term in zip(pdf["lang"], pdf["term"]):
                if terms and (of != lang or len(terms) >= most):
                    yield block()
                    terms = []
                lang = of
                terms.append(bytes(term))
        if terms:
            yield block()

    return run


def transducers(kept: DataFrame, most: int = BLOCK_TERMS) -> DataFrame:
    """(lang, first, terms, size, transducer): the kept terms in sorted blocks."""
    ordered = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    return ordered.mapInPandas(_blocks(most), "lang string, first binary, terms long, size long, transducer binary")


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces that end between terms."""
    at = 0
    while len(text) - at > STREAM:
        cut = text.find(b" ", at + STREAM)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def _recount(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary([(lang, first, ordinal, Transducer.load(raw)) for lang, first, ordinal, raw in shared.value])
        held: dict[tuple[str, str], tuple[np.ndarray, np.ndarray]] = {}

        def flush():
            for (lang, source), (ordinals, counts) in held.items():
                for a in range(0, len(ordinals), 50_000):
                    yield pd.DataFrame({"lang": [lang], "source": [source], "ordinals": [ordinals[a:a + 50_000]], "counts": [counts[a:a + 50_000]]})
            held.clear()

        def add(group, ordinals):
            new, counts = np.unique(ordinals, return_counts=True)
            old = held.get(group)
            if old is not None:
                both, where = np.unique(np.r_[old[0], new], return_inverse=True)
                sums = np.zeros(len(both), np.int64)
                sums[where[:len(old[0])]] = old[1]
                sums[where[len(old[0]):]] += counts
                new, counts = both, sums
            held[group] = new, counts

        def stream(lang, parts):
            """parts: (source, bytes); their tokens go through the language's transducers together."""
            ends_at = np.cumsum([len(p) + 1 for _, p in parts])
            sources = sorted({s for s, _ in parts})
            number = {s: i for i, s in enumerate(sources)}
            of_part = np.array([number[s] for s, _ in parts])
            raw = np.frombuffer(b" ".join(p for _, p in parts) + b" ", np.uint8)
            inside = np.r_[False, raw != _SPACE]
            turns = np.flatnonzero(inside[1:] != inside[:-1])
            starts, ends = turns[::2], turns[1::2]  # the last byte is a space
            ordinals = vocabulary.ordinals(lang, raw, starts, ends)
            kept = np.flatnonzero(ordinals >= 0)
            if not len(kept):
                return
            groups = of_part[np.searchsorted(ends_at, starts[kept], "right")]
            order = np.argsort(groups, kind="stable")
            groups, kept = groups[order], kept[order]
            edges = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1], True])
            for a, b in zip(edges[:-1], edges[1:]):
                add((lang, sources[groups[a]]), ordinals[kept[a:b]])

        waiting: dict[str, list] = {}
        for pdf in batches:
            for lang, source, text in zip(pdf["lang"], pdf["source"], pdf["text"]):
                for piece in _pieces(plain(text)):
                    waiting.setdefault(lang, []).append((source, piece))
            # texts gather until a stream is worth its while
            for lang, parts in waiting.items():
                run_of, size = [], 0
                for part in parts:
                    run_of.append(part)
                    size += len(part[1])
                    if size > STREAM:
                        stream(lang, run_of)
                        run_of, size = [], 0
                if run_of and (size > STREAM // 8 or len(run_of) > 4096):
                    stream(lang, run_of)
                    run_of = []
                waiting[lang] = run_of
            if sum(len(o) for o, _ in held.values()) > 4 * HELD:
                yield from flush()
        for lang, parts in waiting.items():
            if parts:
                stream(lang, parts)
        yield from flush()

    return run


def recount(documents: DataFrame, blocks: DataFrame, sc: Scratch, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(lang, source, ordinal, count) of all kept terms that occur; blocks: a written table of `transducers`."""
    spark = documents.sparkSession
    # one row for up to BLOCK_TERMS terms: without the transducers the list is short
    listed = [tuple(r) for r in blocks.select("lang", "first", "terms", "size").collect()]
    listed = sorted((lang, bytes(first), terms, size) for lang, first, terms, size in listed)
    passes, size, ordinal = [[]], 0, {}
    for lang, first, terms, bytes_ in listed:
        if passes[-1] and size + bytes_ > pass_bytes:
            passes.append([])
            size = 0
        passes[-1].append((lang, first, ordinal.get(lang, 0)))
        ordinal[lang] = ordinal.get(lang, 0) + terms
        size += bytes_
    texts = documents.select("lang", "source", "text")
    out = None
    for number, wanted in enumerate(p for p in passes if p):
        langs = sorted({lang for lang, _, _ in wanted})
        low, high = min((w[0], w[1]) for w in wanted), max((w[0], w[1]) for w in wanted)
        inside = ((F.col("lang") > low[0]) | ((F.col("lang") == low[0]) & (F.col("first") >= F.lit(low[1])))) & (
            (F.col("lang") < high[0]) | ((F.col("lang") == high[0]) & (F.col("first") <= F.lit(high[1]))))
        raw = {(r["lang"], bytes(r["first"])): bytes(r["transducer"]) for r in blocks.where(inside).select("lang", "first", "transducer").collect()}
        shared = spark.sparkContext.broadcast([(lang, first, at, raw[lang, first]) for lang, first, at in wanted])
        counted = (texts.where(F.col("lang").between(langs[0], langs[-1]))
                   .mapInPandas(_recount(shared), "lang string, source string, ordinals array<long>, counts array<long>")
                   .select("lang", "source", F.explode(F.arrays_zip("ordinals", "counts")).alias("x"))
                   .groupBy("lang", "source", F.col("x.ordinals").alias("ordinal")).agg(F.sum("x.counts").alias("count")))
        counted = sc.write(counted, f"counts-{number}")
        shared.unpersist()
        out = counted if out is None else out.unionByName(counted)
    return out if out is not None else spark.createDataFrame([], "lang string, source string, ordinal long, count long")


def probabilities(counts: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """p = 1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)) in whole
    numbers: three digits of the quotient at a time, exact below 9e15."""
    rest, divisor, out = counts + PRIOR, total + PRIOR * terms, 0
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, divisor)
        out = out * 1000 + digits
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


_SLABS = "lang string, source string, part string, item string, ordinal long, value long"


def _slab(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pair sums and the best terms of each source within one slab of a language."""
    lang, start, width, terms = (pdf[c].iloc[0] for c in ("lang", "start", "width", "terms"))
    groups = pdf[pdf["ordinal"] < 0].sort_values("source")
    sources, total = groups["source"].tolist(), groups["total"].to_numpy(np.int64)
    number = {s: i for i, s in enumerate(sources)}
    counts = np.zeros((len(sources), int(min(width, terms - start))), np.int64)
    found = pdf[pdf["ordinal"] >= 0]
    counts[found["source"].map(number).to_numpy(np.int64), found["ordinal"].to_numpy(np.int64) - start] = found["count"].to_numpy(np.int64)
    rows = []
    if not counts.size:
        rows = [(lang, a, "pair", b, -1, 0) for a in sources for b in sources if a != b]
        return pd.DataFrame(rows, columns=["lang", "source", "part", "item", "ordinal", "value"])
    p = probabilities(counts, total[:, None], int(terms))
    for i, a in enumerate(sources):
        sums = divergence(p[i], p[i + 1:]).sum(axis=1)
        for b, v in zip(sources[i + 1:], sums.tolist()):
            rows += [(lang, a, "pair", b, -1, v), (lang, b, "pair", a, -1, v)]
    q = probabilities(counts.sum(axis=0), total.sum(), int(terms))
    for i, a in enumerate(sources):
        over = np.flatnonzero((counts[i] > 0) & (p[i] > q))
        value = divergence(p[i][over], q[over])
        best = np.lexsort((over, -value))[:TERMS]
        rows += [(lang, a, "term", None, int(start + over[k]), int(value[k])) for k in best]
    return pd.DataFrame(rows, columns=["lang", "source", "part", "item", "ordinal", "value"])


def audit(documents: DataFrame, least_docs: int = LEAST_DOCS, block_terms: int = BLOCK_TERMS, pass_bytes: int = PASS_BYTES,
          slab: int = SLAB) -> DataFrame:
    """(lang, source, part, item, value, rank) of documents' (text, lang, source)."""
    spark = prepare(documents.sparkSession)
    sc = Scratch(spark)
    docs = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    kept = sc.write(kept_terms(docs, least_docs), "kept")
    blocks = sc.write(transducers(kept, block_terms), "blocks")
    counts = recount(docs, blocks, sc, pass_bytes)

    vocabulary = blocks.groupBy("lang").agg(F.sum("terms").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = (docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left")
              .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms")))
    sizes = groups.groupBy("lang").agg(F.greatest(F.lit(1), F.floor(F.lit(slab) / F.count("*"))).cast("long").alias("width"))
    groups = sc.write(groups.join(sizes, "lang"), "groups")
    # every slab of a language lists all its sources, with ordinal -1
    listed = groups.withColumn("slab", F.explode(F.expr("sequence(0L, greatest(0L, (terms - 1) div width))")))
    listed = listed.withColumn("ordinal", F.lit(-1).cast("long")).withColumn("count", F.lit(0).cast("long"))
    rows = counts.join(groups, ["lang", "source"]).withColumn("slab", F.expr("ordinal div width"))
    rows = rows.unionByName(listed.select(*rows.columns)).withColumn("start", F.expr("slab * width"))
    parts = sc.write(rows.groupBy("lang", "slab").applyInPandas(lambda pdf: _slab(pdf), _SLABS), "parts")

    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    by_item = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(by_item))
    by_ordinal = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = parts.where("part = 'term'").withColumn("rank", F.row_number().over(by_ordinal)).where(F.col("rank") <= TERMS)
    named = best.drop("item").join(_numbered(kept, blocks, block_terms, sc), ["lang", "ordinal"])
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(named.select(*columns))


def _numbered(kept: DataFrame, blocks: DataFrame, block_terms: int, sc: Scratch) -> DataFrame:
    """(lang, ordinal, item): the terms read back from the transducers, block by block."""
    spark = kept.sparkSession
    at, rows = {}, []
    for lang, first, terms in sorted((r["lang"], bytes(r["first"]), r["terms"]) for r in blocks.select("lang", "first", "terms").collect()):
        rows.append((lang, first, at.get(lang, 0)))
        at[lang] = at.get(lang, 0) + terms
    offsets = spark.createDataFrame(rows, "lang string, first binary, offset long")

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, offset, terms, raw in zip(pdf["lang"], pdf["offset"], pdf["terms"], pdf["transducer"]):
                t = Transducer.load(raw)
                yield pd.DataFrame({"lang": lang, "ordinal": np.arange(offset, offset + terms), "item": [term.decode() for term in t.terms()]})

    return blocks.join(offsets, ["lang", "first"]).select("lang", "offset", "terms", "transducer").mapInPandas(spell, "lang string, ordinal long, item string")


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of sources and the leading terms of every (lang, source)."""
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
w AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT w.lang, source, w.term, count(*) AS n FROM w JOIN kept ON kept.lang = w.lang AND kept.term = w.term GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
total AS (
  SELECT g.lang, g.source, CAST(coalesce(sum(c.n), 0) AS BIGINT) AS n
  FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
p AS (
  SELECT total.lang, total.source, kept.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (total.n + 2 * v.v) AS p
  FROM total JOIN v ON v.lang = total.lang JOIN kept ON kept.lang = total.lang
  LEFT JOIN c ON c.lang = total.lang AND c.source = total.source AND c.term = kept.term),
whole AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM total GROUP BY lang),
q AS (
  SELECT c.lang, c.term, 1 + (1000000000 * (CAST(sum(c.n) AS BIGINT) + 2)) // (any_value(whole.n) + 2 * any_value(v.v)) AS p
  FROM c JOIN v ON v.lang = c.lang JOIN whole ON whole.lang = c.lang GROUP BY c.lang, c.term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
every_pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(pair.value, 0) AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
term AS (
  SELECT p.lang, p.source, p.term AS item, ((p.p - q.p) * (p.p - q.p)) // (p.p + q.p) AS value
  FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.p),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM every_pair
  UNION ALL
  SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM term)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
