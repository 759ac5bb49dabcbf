"""Language identification by multilingual mixture inference.

Every document is a mixture of languages: its character trigrams are drawn
from the languages' trigram distributions with unknown proportions, which
expectation-maximisation estimates from the trigram likelihoods.  Languages
leave the set, smallest proportion first, while the likelihood penalised for
the number of languages rises; the document's language is the one with the
largest proportion of the set that stays, and that proportion is the score.

Distributions are learnt from a bounded sample of documents with a language
(`PER_LANGUAGE` each, in the order of a hash of the id).  They are hashed to
`BINS` trigrams, so what is broadcast is bounded by languages x BINS.

Defined cases: a null text, or one without a letter, is `und` with score 0;
so is every text when nothing was learnt; a null lang teaches nothing;
repeated rows are predicted alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import hash_order, id_crc, prepare, table

BINS = 1 << 16
PER_LANGUAGE = 1500
#: Most languages that a model learns (those with the most documents).
MOST_LANGUAGES = 200
SMOOTHING = 0.05
ROUNDS = 25
#: Trigrams that one free proportion must explain, in log-likelihood per log of the length.
PENALTY = 4.0


def trigram_bins(text: str) -> np.ndarray:
    """Hashed character trigrams of a whole lower-cased text; runs of non-letters are one space."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = (cp >= 97) & (cp <= 122) | (cp >= 170)
    cp = np.where(letter, cp, 32)
    keep = np.r_[True, (cp[1:] != 32) | (cp[:-1] != 32)] if len(cp) else np.empty(0, bool)
    cp = np.r_[np.uint32(32), cp[keep], np.uint32(32)].astype(np.uint32)
    h = cp[:-2] * np.uint32(0x9E3779B1) ^ cp[1:-1] * np.uint32(0x85EBCA6B) ^ cp[2:] * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(15)
    return (h * np.uint32(0x2C1B3C6D)) >> np.uint32(16)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def mixture(p: np.ndarray, count: np.ndarray, start: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """EM: proportions of the columns of p (trigram likelihoods), and the log-likelihood."""
    share, total = start / start.sum(), count.sum()
    for _ in range(rounds):
        mix = p @ share
        new = share * ((count / mix) @ p) / total
        if np.abs(new - share).max() < 1e-4:
            share = new
            break
        share = new
    return share, float(count @ np.log(p @ share))


def infer(logp: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(languages of the chosen set, their proportions) of one document; logp: languages x BINS."""
    grams, count = np.unique(bins, return_counts=True)
    part = logp[:, grams]
    p = np.exp(part - part.max(0)).T  # a factor common to all languages does not change the proportions
    chosen = np.arange(len(logp))
    share, fit = mixture(p, count, np.ones(len(chosen)))
    price = PENALTY * np.log(count.sum() + 1.0)
    while len(chosen) > 1:
        stay = np.ones(len(chosen), bool)
        stay[share.argmin()] = False
        new_share, new_fit = mixture(p[:, chosen[stay]], count, share[stay] + 1e-6)
        if new_fit + price < fit:
            break
        chosen, share, fit = chosen[stay], new_share, new_fit
    return chosen, share


def train(documents: DataFrame, learn: Column) -> dict:
    """{"languages", "logp"} from the bounded sample."""
    spark = prepare(documents.sparkSession)
    rows = documents.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    names = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()]
    if not names:
        return {"languages": [], "logp": np.zeros((0, BINS))}
    ids = None
    for lang in names:
        pick = rows.where(F.col("lang") == lang).select("doc_id").orderBy(*hash_order()).limit(PER_LANGUAGE)
        ids = pick if ids is None else ids.unionByName(pick)
    sample = rows.join(F.broadcast(ids.distinct()), "doc_id", "left_semi")  # bounded by MOST_LANGUAGES * PER_LANGUAGE

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                if lang in names and has_letter(text):
                    counts.setdefault(lang, np.zeros(BINS, np.int64))
                    counts[lang] += np.bincount(trigram_bins(text), minlength=BINS)
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "bin": at.astype(np.int32), "n": c[at]})

    got = sample.mapInPandas(tally, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(set(got["lang"]))
    logp = np.empty((len(names), BINS))
    for k, lang in enumerate(names):
        own = got[got["lang"] == lang]
        c = np.full(BINS, SMOOTHING)
        c[own["bin"].to_numpy()] += own["n"].to_numpy()
        logp[k] = np.log(c / c.sum())
    return {"languages": names, "logp": logp}


def predict(documents: DataFrame, model: dict) -> DataFrame:
    """documents with `lang_pred`, `lang_score` and `lang_set` (the chosen languages and their proportions)."""
    prepare(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = "lang_pred string, lang_score double, lang_set map<string,double>"

    def one(text, model):
        if not len(model["languages"]) or not has_letter(text):
            return "und", 0.0, {}
        chosen, share = infer(model["logp"], trigram_bins(text))
        best = int(share.argmax())
        found = {model["languages"][c]: float(s) for c, s in zip(chosen, share)}
        return model["languages"][chosen[best]], float(min(1.0, share[best])), found

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([one(t, shared.value) for t in texts], columns=["lang_pred", "lang_score", "lang_set"])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    cols = [c for c in documents.columns if c not in ("lang_pred", "lang_score", "lang_set")]
    return documents.withColumn("__lang", F.pandas_udf(run, kind)(F.col("text"))).select(*cols, "__lang.*")


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    docs = table(spark, sf_dir, "documents")
    held = id_crc() % 4 == 2
    model = train(docs, ~held)
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
