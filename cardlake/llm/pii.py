"""Personal data: base patterns, and a character BiLSTM with CRF transitions that adds spans.

The tagger is trained in numpy on a bounded sample of windows labelled by the
base patterns (`PER_KIND` for each kind, `NEGATIVE` without any).  Whole texts
are cut into overlapping windows; each window is decoded with its neighbours'
context, each position takes its tag from the window where it lies furthest
from an edge, and spans are read off the joined tags of the document.  Gates
use the hard sigmoid, so a step is one small matrix product and a few clips.

A window needs no Viterbi decoding if at every position the score of `O`
leads by twice the most that a transition can add over `O` -> `O`: a path
that leaves `O` at m positions gains at most 2 m such differences, so all-`O`
is then its best path.

Defined cases: a null or empty text has no spans; a document table without
any base span trains no tagger and gives the base spans only; a span of the
tagger that overlaps a base span, or whose digits fail the check of its kind (card
checksum, ip parts, phone length, an email's @), is dropped; repeated rows are tagged alike.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import Scratch, prepare, table

KINDS = ("email", "ip", "card", "phone")
PER_KIND = 500
NEGATIVE = 1000
#: Training window, decoding window and its context on either side, in characters.
TRAIN_WINDOW, WINDOW, CONTEXT = 96, 768, 32
#: Characters of the windows that are decoded together (some 150 bytes each).
CELLS = 512 * 512
#: A span that the tagger adds has at least so many characters (base spans may be shorter).
SHORTEST = 6

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """`[A-Za-z0-9._%+-]+@domain`, leftmost and without overlap: a match can
    only begin at the first character of the run before an @."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _octet(digits: str) -> bool:
    """At most 255, however many zeros lead."""
    least = digits.lstrip("0")
    return len(least) <= 3 and int(least or "0") <= 255


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns in a whole text, by start, then kind as listed."""
    if not text:
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# --- characters and tags -------------------------------------------------

PAD, CLASSES = 0, 101
TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind


def _class_table() -> np.ndarray:
    """Code point (up to 255, larger ones count as 255) -> class: printable ASCII each, line ends, other letters, the rest."""
    t = np.full(256, 98, np.uint8)
    t[32:127] = np.arange(1, 96)
    t[[9, 10, 11, 12, 13]] = 96
    t[192:256] = 97
    return t


_TABLE = _class_table()


def char_classes(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _TABLE[np.minimum(cp, 255)]


def gold_tags(length: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    tags = np.zeros(length, np.uint8)
    for kind, a, b in sorted(spans, key=lambda s: KINDS.index(s[0])):
        if not tags[a:b].any():
            tags[a] = 1 + 2 * KINDS.index(kind)
            tags[a + 1:b] = 2 + 2 * KINDS.index(kind)
    return tags


# --- the network ---------------------------------------------------------

DIM, HIDDEN = 8, 8
ROWS = DIM + HIDDEN + 1


def new_model(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = rng.normal(0, 0.3, (2, 4 * HIDDEN, ROWS)).astype(np.float32)
    w[:, :, -1] = np.r_[np.full(HIDDEN, 0.5), np.full(HIDDEN, 0.8), np.full(HIDDEN, 0.5), np.zeros(HIDDEN)]
    return {"emb": rng.normal(0, 0.7, (CLASSES, DIM)).astype(np.float32), "w": w,
            "out": rng.normal(0, 0.5, (TAGS, 2 * HIDDEN + 1)).astype(np.float32),
            "trans": np.zeros((TAGS, TAGS), np.float32)}


def states(model: dict, chars: np.ndarray, keep: list | None = None) -> np.ndarray:
    """chars (steps, batch) -> hidden states (steps, 2 * HIDDEN + 1, batch), the last row being 1.
    `keep` receives what the backward pass needs."""
    steps, batch = chars.shape
    x = np.ascontiguousarray(model["emb"][chars].transpose(0, 2, 1))
    z = np.zeros((2, ROWS, batch), np.float32)
    z[:, -1] = 1
    g = np.empty((2, 4 * HIDDEN, batch), np.float32)
    c = np.zeros((2, HIDDEN, batch), np.float32)
    tmp = np.empty_like(c)
    out = np.empty((steps, 2 * HIDDEN + 1, batch), np.float32)
    out[:, -1] = 1
    gate, cand = g[:, :3 * HIDDEN], g[:, 3 * HIDDEN:]
    i, f, o = g[:, :HIDDEN], g[:, HIDDEN:2 * HIDDEN], g[:, 2 * HIDDEN:3 * HIDDEN]
    h = z[:, DIM:DIM + HIDDEN]
    for t in range(steps):
        z[0, :DIM] = x[t]
        z[1, :DIM] = x[steps - 1 - t]
        np.matmul(model["w"], z, out=g)
        if keep is not None:
            before = (z.copy(), g.copy(), c.copy())
        gate.clip(0, 1, out=gate)
        cand.clip(-1, 1, out=cand)
        c *= f
        np.multiply(i, cand, out=tmp)
        c += tmp
        if keep is not None:
            keep.append((*before, c.copy()))
        c.clip(-1, 1, out=c)
        np.multiply(o, c, out=h)
        out[t, :HIDDEN] = h[0]
        out[steps - 1 - t, HIDDEN:2 * HIDDEN] = h[1]
    return out


def _states_backward(model: dict, chars: np.ndarray, keep: list, d_out: np.ndarray, grad: dict) -> None:
    steps, batch = chars.shape
    dh = np.zeros((2, HIDDEN, batch), np.float32)
    dc = np.zeros_like(dh)
    d_x = np.zeros((steps, DIM, batch), np.float32)
    for t in range(steps - 1, -1, -1):
        z, raw, c_old, c_raw = keep[t]
        a = np.clip(raw, 0, 1)
        i, f, o = a[:, :HIDDEN], a[:, HIDDEN:2 * HIDDEN], a[:, 2 * HIDDEN:3 * HIDDEN]
        cand = np.clip(raw[:, 3 * HIDDEN:], -1, 1)
        dh[0] += d_out[t, :HIDDEN]
        dh[1] += d_out[steps - 1 - t, HIDDEN:2 * HIDDEN]
        c_new = np.clip(c_raw, -1, 1)
        dc = (dc + dh * o) * (np.abs(c_raw) < 1)
        d = np.concatenate([dc * cand, dc * c_old, dh * c_new, dc * i], 1)
        live = np.ones_like(raw, bool)
        live[:, :3 * HIDDEN] = (raw[:, :3 * HIDDEN] > 0) & (raw[:, :3 * HIDDEN] < 1)
        live[:, 3 * HIDDEN:] = np.abs(raw[:, 3 * HIDDEN:]) < 1
        d *= live
        grad["w"] += np.matmul(d, z.transpose(0, 2, 1))
        dz = np.matmul(model["w"].transpose(0, 2, 1), d)
        d_x[t] += dz[0, :DIM]
        d_x[steps - 1 - t] += dz[1, :DIM]
        dh = dz[:, DIM:DIM + HIDDEN]
        dc = dc * f
    np.add.at(grad["emb"], chars, d_x.transpose(0, 2, 1))


def loss_and_gradient(model: dict, chars: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
    """Mean CRF loss of a batch (steps, batch) and its gradient."""
    steps, batch = chars.shape
    keep: list = []
    hidden = states(model, chars, keep)
    emit = np.matmul(model["out"], hidden).transpose(0, 2, 1)  # steps, batch, tags
    top = emit.max(2, keepdims=True)
    e, m = np.exp(emit - top), np.exp(model["trans"])
    alpha, scale = np.empty_like(e), np.empty((steps, batch, 1), np.float32)
    for t in range(steps):
        a = e[t] if t == 0 else (alpha[t - 1] @ m) * e[t]
        scale[t] = a.sum(1, keepdims=True)
        alpha[t] = a / scale[t]
    beta = np.ones_like(e)
    for t in range(steps - 2, -1, -1):
        beta[t] = ((beta[t + 1] * e[t + 1]) @ m.T) / scale[t + 1]
    near = alpha * beta
    d_emit = near / near.sum(2, keepdims=True)
    pair = np.einsum("tbi,tbj->ij", alpha[:-1], beta[1:] * e[1:] / scale[1:]) * m
    rows, cols = np.arange(steps)[:, None], np.arange(batch)[None, :]
    score = emit[rows, cols, tags].sum() + model["trans"][tags[:-1], tags[1:]].sum()
    loss = float(np.log(scale).sum() + top.sum() - score) / batch
    d_emit[rows, cols, tags] -= 1
    np.subtract.at(pair, (tags[:-1], tags[1:]), 1)
    d_emit = d_emit.transpose(0, 2, 1) / batch
    grad = {k: np.zeros_like(v) for k, v in model.items()}
    grad["trans"] = (pair / batch).astype(np.float32)
    grad["out"] = np.einsum("tkb,thb->kh", d_emit, hidden, optimize=True).astype(np.float32)
    d_hidden = np.matmul(model["out"].T, d_emit.astype(np.float32))
    _states_backward(model, chars, keep, d_hidden, grad)
    return loss, grad


def fit(chars: np.ndarray, tags: np.ndarray, epochs: int = 18, batch: int = 128, rate: float = 0.02, seed: int = 5) -> dict:
    """Adam on windows (rows, steps)."""
    rng, model = np.random.default_rng(seed), new_model(seed)
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    step = 0
    for epoch in range(epochs):
        lr = rate * (0.1 + 0.9 * (1 - epoch / epochs))
        order = rng.permutation(len(chars))
        for k in range(0, len(order), batch):
            pick = order[k:k + batch]
            _, grad = loss_and_gradient(model, chars[pick].T.copy(), tags[pick].T.astype(np.int64))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            step += 1
            for name, g in grad.items():
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                model[name] -= (lr * (first[name] / (1 - 0.9 ** step))
                                / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return model


def viterbi(emit: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags of emissions (steps, batch, tags)."""
    return _best_tags(np.array(emit.transpose(0, 2, 1), order="C"), trans)


def _best_tags(emit: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags of emissions (steps, tags, batch), which become the scores of the
    best paths to each tag: the way back asks them for the tags on it only."""
    steps, k, batch = emit.shape
    all_, step = np.empty((k, k, batch), emit.dtype), trans[:, :, None]
    for t in range(1, steps):
        np.add(emit[t - 1][:, None], step, out=all_)
        emit[t] += all_.max(0)
    tags = np.empty((steps, batch), np.int8)
    tags[-1] = emit[-1].argmax(0)
    for t in range(steps - 1, 0, -1):
        tags[t - 1] = (emit[t - 1] + trans[:, tags[t]]).argmax(0)
    return tags


def decode(model: dict, chars: np.ndarray) -> np.ndarray:
    """Tags (steps, batch) of windows; all-O windows are proved so by their margins."""
    hidden = states(model, chars)
    emit = np.matmul(model["out"], hidden)  # steps, tags, batch
    margin = (emit[:, 0] - emit[:, 1:].max(1)).min(0)
    trans = model["trans"]
    doubt = np.flatnonzero(margin < 2 * max(0.0, float(trans.max() - trans[0, 0])))
    tags = np.zeros(chars.shape, np.int8)
    if len(doubt):
        tags[:, doubt] = _best_tags(emit[:, :, doubt], trans)
    return tags


def windows_of(length: int) -> list[tuple[int, int, int, int]]:
    """(start, end, first and last position that takes its tag from it) of a text's
    windows: of equal length, as few as there can be, just long enough for the text."""
    if length <= WINDOW:
        return [(0, length, 0, length)]
    count = -(-(length - 2 * CONTEXT) // (WINDOW - 2 * CONTEXT))
    size = -(-(length + (count - 1) * 2 * CONTEXT) // count)
    starts = [min(k * (size - 2 * CONTEXT), length - size) for k in range(count)]
    cuts = [0] + [(a + size + b) // 2 for a, b in zip(starts, starts[1:])] + [length]
    return [(s, s + size, cuts[k], cuts[k + 1]) for k, s in enumerate(starts)]


def spans_of(tags: np.ndarray) -> list[tuple[str, int, int]]:
    """Spans of a document's joined tags: a kind's run, broken by a new B of it."""
    on = np.flatnonzero(tags)
    if not len(on):
        return []
    kind, begins = (tags[on] - 1) // 2, (tags[on] % 2) == 1
    new = np.r_[True, (np.diff(on) > 1) | (np.diff(kind) != 0) | begins[1:]]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(on)] - 1
    return [(KINDS[kind[a]], int(on[a]), int(on[b]) + 1) for a, b in zip(first, last)]


def _plausible(kind: str, found: str) -> bool:
    """Exact check of an added span: what the base patterns ask of a kind's digits."""
    digits = [c for c in found if "0" <= c <= "9"]
    if kind == "card":
        return 12 <= len(digits) <= 19 and _luhn("".join(digits))
    if kind == "ip":
        return all(map(_octet, re.findall("[0-9]+", found)))
    return 9 <= len(digits) <= 15 if kind == "phone" else "@" in found


def tag_texts(model: dict | None, texts: list[str | None], base: list | None = None, cells: int = CELLS) -> list[list[tuple[str, int, int]]]:
    """All spans (base and added) of each text; `base`: its base spans, if known."""
    base = [base_spans(t) for t in texts] if base is None else base
    if model is None:
        return base
    chars = [char_classes(t) if t else np.empty(0, np.uint8) for t in texts]
    jobs = [(b - a, d, a, b, x, y) for d, c in enumerate(chars) if len(c) for a, b, x, y in windows_of(len(c))]
    jobs.sort(key=lambda j: j[0])
    found: dict[int, np.ndarray] = {}
    done = len(jobs)
    while done:  # longest first
        steps = jobs[done - 1][0]
        first = max(0, done - min(1024, max(1, cells // steps)))
        part, done = jobs[first:done], first
        block = np.full((len(part), steps), PAD, np.uint8)
        for r, (n, d, a, b, _, _) in enumerate(part):
            block[r, :n] = chars[d][a:b]
        tags = decode(model, np.ascontiguousarray(block.T))
        for r in np.flatnonzero(tags.any(0)):
            n, d, a, b, x, y = part[r]
            if d not in found:
                found[d] = np.zeros(len(chars[d]), np.int8)
            found[d][x:y] = tags[x - a:y - a, r]
    out = []
    for d, spans in enumerate(base):
        if d in found:
            for s in spans_of(found[d]):
                if s[2] - s[1] >= SHORTEST and _plausible(s[0], texts[d][s[1]:s[2]]) and all(s[2] <= a or b <= s[1] for _, a, b in base[d]):
                    spans = spans + [s]
        out.append(sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))
    return out


# --- Spark ---------------------------------------------------------------

def _labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Training windows of a text: one around each base span, and one without, at a place that its id chooses."""
    cols = ["kind", "at", "chars", "tags"]
    for pdf in batches:
        rows = []
        for i, t in zip(pdf["doc_id"], pdf["text"]):
            if not t:
                continue
            spans = base_spans(t)
            low = np.random.default_rng([abs(hash(int(i) if pd.notna(i) else 0)) & 0xFFFFFFFF, len(t)])
            spots = [(kind, a - int(low.integers(0, 40))) for kind, a, b in spans]
            spots.append(("none", int(low.integers(0, max(1, len(t) - TRAIN_WINDOW)))))
            for kind, a in spots:
                a = max(0, a)
                b = min(len(t), a + TRAIN_WINDOW)
                cut = [(k, max(x, a) - a, min(y, b) - a) for k, x, y in spans if x < b and y > a]
                if (kind == "none") != (not cut):
                    continue
                chars = np.full(TRAIN_WINDOW, PAD, np.uint8)
                tags = np.zeros(TRAIN_WINDOW, np.uint8)
                chars[:b - a] = char_classes(t[a:b])
                tags[:b - a] = gold_tags(b - a, cut)
                rows.append((kind, int(i) if pd.notna(i) else 0, chars.tobytes(), tags.tobytes()))
        yield pd.DataFrame(rows, columns=cols)


def _fit_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pickle

    got = [b for b in batches if len(b)]
    if not got:
        return
    rows = pd.concat(got).sort_values(["kind", "at", "chars", "tags"], kind="stable")
    if not (rows["kind"] != "none").any():
        return
    chars = np.stack([np.frombuffer(b, np.uint8) for b in rows["chars"]])
    tags = np.stack([np.frombuffer(b, np.uint8) for b in rows["tags"]])
    yield pd.DataFrame({"model": [pickle.dumps(fit(chars, tags))]})


def train_tagger(documents: DataFrame) -> dict | None:
    """The tagger of a bounded sample of windows; None without any base span."""
    import pickle

    spark = prepare(documents.sparkSession)
    sc = Scratch(spark)
    found = sc.write(documents.select("doc_id", "text").mapInPandas(_labelled, "kind string, at long, chars binary, tags binary"), "pii")
    order = [F.xxhash64("at", "chars"), F.col("at"), F.col("chars")]
    picks = [found.where(F.col("kind") == k).orderBy(*order).limit(NEGATIVE if k == "none" else PER_KIND) for k in (*KINDS, "none")]
    sample = picks[0]
    for p in picks[1:]:
        sample = sample.unionByName(p)
    got = sample.repartition(1).mapInPandas(_fit_task, "model binary").collect()  # one small model
    sc.drop("pii")
    return pickle.loads(bytes(got[0]["model"])) if got else None


def find_spans(documents: DataFrame, model: dict | None) -> DataFrame:
    """documents with `pii_base` and `pii_spans`: arrays of (kind, start, end)."""
    prepare(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # some thousand numbers
    kind = "array<struct<kind:string,start:int,end:int>>"

    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            texts = [t if isinstance(t, str) else None for t in texts]
            base = [base_spans(t) for t in texts]
            row = lambda spans: [dict(zip(("kind", "start", "end"), s)) for s in spans]
            yield pd.DataFrame({"pii_base": list(map(row, base)), "pii_spans": list(map(row, tag_texts(shared.value, texts, base)))})

    tag.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    udf = F.pandas_udf(tag, f"pii_base {kind}, pii_spans {kind}")
    cols = [c for c in documents.columns if c not in ("pii_base", "pii_spans")]
    return documents.withColumn("__pii", udf(F.col("text"))).select(*cols, "__pii.*")


def redact(documents: DataFrame, model: dict | None) -> DataFrame:
    """documents with every span of `text` replaced by its kind in angle brackets (overlaps: one replacement)."""
    prepare(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = [t if isinstance(t, str) else None for t in texts]
            out = []
            for t, spans in zip(texts, tag_texts(shared.value, texts)):
                parts, at = [], 0
                for kind, a, b in spans:
                    if a >= at:
                        parts += [t[at:a], f"<{kind}>"]
                    at = max(at, b)
                out.append(t if not spans else "".join(parts) + t[at:])
            yield pd.Series(out, dtype=object)

    clean.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return documents.withColumn("text", F.pandas_udf(clean, "string")(F.col("text")))



def op2_pii_bilstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_spans(docs, train_tagger(docs)).drop("text")
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("pii_base", lambda s: s["kind"] == F.lit(k))).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(text("pii_base").cast("binary"), 256).alias("base_sha256"), text("pii_spans").alias("spans"))
