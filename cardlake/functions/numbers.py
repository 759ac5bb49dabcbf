"""Numeric parsing and exact rounding expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardlake.functions import fixed_values as V
from cardlake.functions.text import col_, lookup, strip_chars, strip_ws

# A plain decimal number, optionally signed / with exponent, in trimmed text
# (surrounding whitespace is allowed).  Guards every text->number cast: Spark
# alone would accept e.g. '33d' as 33.0.
NUMBER_RE = r"^([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)$"
INTEGER_RE = r"^([+-]?\d+)$"

MONEY_PARSE = "decimal(38,6)"


def try_number(c: Column | str, to: str = "double") -> Column:
    """Text -> number when the whole text is a plain number, else NULL
    (no match extracts '' which casts to NULL)."""
    return F.regexp_extract(strip_ws(c), NUMBER_RE, 1).try_cast(to)


def try_integer_text(c: Column | str, to: str = "int") -> Column:
    return F.regexp_extract(strip_ws(c), INTEGER_RE, 1).try_cast(to)


def trunc_to_long(x: Column) -> Column:
    """int(x) of a double: truncate toward zero (NULL when out of range)."""
    return x.try_cast("long")


def in_range(x: Column, lo, hi) -> Column:
    return F.when((x >= lo) & (x <= hi), x)


def round_to_long(x: Column) -> Column:
    """Round half away from zero to a whole number, as BIGINT (x is decimal; NULL when out of range)."""
    return F.round(x, 0).try_cast("bigint")


def div_round(num: Column, den: Column, digits: int) -> Column:
    """round(num / den, digits), half away from zero, NULL when den is 0/NULL.

    The numerator is widened to decimal(38,18) and the denominator (a count
    or a money amount) is held as decimal(38,2), never rounded, so the
    quotient keeps 16 fraction digits before the final rounding (no double
    rounding for any realistic group size); an average is
    `div_round(sum, count, 2)`.
    """
    q = num.cast("decimal(38,18)") / F.when(den != 0, den).cast("decimal(38,2)")
    return F.round(q, digits)


# ------------------------------------------------------------------ money
# Each parser takes text already normalised by its `*_text` helper and held
# in a column, so the (regex) normalisation runs once per row instead of once
# per reference inside the CASE chain.

def user_money_text(c: Column | str) -> Column:
    """trim, strip double quotes, trim."""
    return strip_ws(strip_chars(strip_ws(col_(c)), '"'))


def user_money(s: Column) -> Column:
    """Users' income / debt (normalised text) -> non-negative decimal, else NULL.

    text number; placeholders -> NULL; drop `$` and `,`; `k` suffix x1000;
    absolute value.
    """
    low = F.lower(s)
    value = _user_money_number(s, MONEY_PARSE)
    text_value = lookup(low, {k: str(v) for k, v in V.USER_TEXT_MONEY.items()}).cast(MONEY_PARSE)
    return (
        F.when(s.isNull() | (s == ""), F.lit(None))
        .when(text_value.isNotNull(), text_value)
        .when(low.isin(V.MONEY_TEXT_ERRORS), F.lit(None))
        .otherwise(F.abs(value))
        .try_cast(MONEY_PARSE)
    )


def _user_money_number(s: Column, to: str) -> Column:
    """The signed number of a money text without `$` and `,`, `k` suffix x1000."""
    bare = strip_ws(F.regexp_replace(s, r"[$,]", ""))
    k_head = F.regexp_extract(bare, r"^(.*)[kK]$", 1)
    return F.when(F.lower(bare).endswith("k"), F.try_multiply(try_number(k_head, to), F.lit(1000))).otherwise(try_number(bare, to))


def user_money_overflows(s: Column) -> Column:
    """Is the (normalised) text a number that no BIGINT holds?"""
    huge = F.abs(_user_money_number(s, "double")) > F.lit(1e18)
    return F.coalesce(huge, F.lit(False)) & round_to_long(user_money(s)).isNull()


def card_money_text(c: Column | str) -> Column:
    """lower + trim (NULL stays NULL)."""
    return strip_ws(F.lower(col_(c)))


def card_money_number_text(s: Column) -> Column:
    """`(x)` -> `-x`, drop `$` and `,`, trim."""
    return strip_ws(F.regexp_replace(F.translate(s, "()", "-"), r"[$,]", ""))


def card_money(s: Column, t: Column) -> Column:
    """Cards' credit limit -> double in [0, 1e6], else NULL.

    `s` is card_money_text(raw), `t` is card_money_number_text(s).
    Text numbers; placeholders; `k` suffix x1000; absolute value; above
    1,000,000 -> NULL.
    """
    text_value = lookup(s, {k: str(v) for k, v in V.CARD_TEXT_MONEY.items()}).cast("double")
    k_head = F.regexp_extract(t, r"^(.*)k$", 1)
    value = F.abs(F.when(t.endswith("k"), try_number(k_head) * F.lit(1000.0)).otherwise(try_number(t)))
    return (
        F.when(s.isNull() | (s == ""), F.lit(None))
        .when(text_value.isNotNull(), text_value)
        .when(s.isin(V.MONEY_TEXT_ERRORS), F.lit(None))
        .when(value > V.CARD_MONEY_MAX, F.lit(None))
        .otherwise(value)
        .cast("double")
    )


# 18 fraction digits: the smallest amount is told apart before any rounding
TX_AMOUNT_PARSE = "decimal(38,18)"


def tx_amount_text(c: Column | str) -> Column:
    """Transaction amount text without `$` and `,`."""
    return F.translate(col_(c), "$,", "")


def whole_number_text(x: Column) -> Column:
    """str(int(x)) of a double of up to 2^95, exact above 2^63 too (NULL beyond)."""
    high = F.floor(x / F.lit(4294967296.0))
    low = (x - high.cast("double") * F.lit(4294967296.0)).try_cast("long")
    wide = high.cast("decimal(20,0)") * F.lit(4294967296).cast("decimal(10,0)") + low.cast("decimal(20,0)")
    return F.coalesce(F.when(F.abs(x) < F.lit(2.0 ** 63), trunc_to_long(x).cast("string")), F.when((x > 0) & (x < F.lit(2.0 ** 95)), wide.cast("decimal(38,0)").cast("string")))
