"""Fuzzy canonicalisation (closest label by Ratcliff-Obershelp ratio).

Spark has no built-in for this similarity, so only the *distinct* values that
no exact rule resolved are scored, in Arrow batches on the executors
(`mapInPandas`); the result is a small (value -> label) table that is joined
back.  Cost grows with the number of distinct spellings, not with rows.
"""

from __future__ import annotations

import difflib
import sys
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The scoring code runs in executor Python workers, which need not have this
# package installed: ship this module's functions with the task (by value)
# instead of importing them there by name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def closest_label(value: str | None, labels: Sequence[str], cutoff: float) -> str | None:
    """The label most similar to `value`, case ignored, if its ratio is at least `cutoff`.

    Every label is scored; of equal ratios the label whose lower-case text
    sorts last wins."""
    if value is None:
        return None
    scorer = difflib.SequenceMatcher()
    scorer.set_seq2(value.lower())
    best: tuple[float, str] | None = None
    label_of: dict[str, str] = {}
    for label in labels:
        key = label.lower()
        label_of.setdefault(key, label)
        scorer.set_seq1(key)
        ratio = scorer.ratio()
        if ratio >= cutoff and (best is None or (ratio, key) > best):
            best = (ratio, key)
    return label_of[best[1]] if best else None


def fuzzy_table_by_field(values: DataFrame, field_col: str, value_col: str,
                         labels_by_field: Mapping[str, Sequence[str]], cutoff: float,
                         label_col: str = "fuzzy_label") -> DataFrame:
    """distinct (field, value) -> (field, value, label) for matched values,
    each field scored against its own label list, all in one Python stage."""
    labels_by_field = {k: list(v) for k, v in labels_by_field.items()}

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[[field_col, value_col]].copy()
            out[label_col] = [closest_label(v, labels_by_field[f], cutoff)
                              for f, v in zip(out[field_col], out[value_col])]
            yield out[out[label_col].notna()]

    distinct = values.select(field_col, value_col).where(F.col(value_col).isNotNull()).distinct()
    return distinct.mapInPandas(score, schema=f"{field_col} string, {value_col} string, {label_col} string")
