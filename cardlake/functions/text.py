"""String expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's strip and `\s` take as whitespace: Unicode White_Space and U+001C to U+001F.
WS = r"[\s\x0B\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
#: The same characters, for `trim`, which looks at the ends of a text only.
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_MAX_LEN = 2147483647


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Trim every leading/trailing whitespace char (Spark `trim` only drops spaces)."""
    return F.trim(col_(c), F.lit(WS_CHARS))


def collapse_ws(c: Column | str) -> Column:
    """Trim, then turn each inner whitespace run into one space."""
    return squeeze_ws(strip_ws(c))


def squeeze_ws(c: Column | str) -> Column:
    """Turn each whitespace run into one space."""
    return F.regexp_replace(col_(c), f"{WS}+", " ")


def strip_chars(c: Column | str, chars: str) -> Column:
    """Remove any of `chars` from both ends (str.strip(chars))."""
    return F.trim(col_(c), F.lit(chars))


def py_title(c: Column | str) -> Column:
    """Title case with word starts after *any* non-letter.

    `o'neil ave` -> `O'Neil Ave`, `men's` -> `Men'S`, `3rd` -> `3Rd`.  Split
    into letter / non-letter runs, upper-case the first char of each run and
    lower-case the rest (non-letters are unaffected by either).
    """
    runs = F.regexp_extract_all(col_(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(
        F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)),
                                             F.lower(F.substring(x, 2, _MAX_LEN)))),
        "",
    )


def capitalize_first(c: Column | str) -> Column:
    """First character upper, the rest lower."""
    c = col_(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, _MAX_LEN)))


def nullif_in(c: Column | str, values: Iterable[str]) -> Column:
    c = col_(c)
    return F.when(c.isin(list(values)), F.lit(None).cast("string")).otherwise(c)


def nullif_blank(c: Column | str) -> Column:
    c = col_(c)
    return F.when(c == "", F.lit(None).cast("string")).otherwise(c)


def as_text(c: Column | str, null_text: str = "None") -> Column:
    """Text form of a value where a missing value becomes `null_text`."""
    return F.coalesce(col_(c).cast("string"), F.lit(null_text))


def lookup(key: Column, mapping: Mapping[str, str]) -> Column:
    """Map lookup against a literal map; a miss or NULL key gives NULL.  The
    map is one parsed expression: a literal column per entry would cost the
    driver a call each."""
    def text(s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    entries = ", ".join(f"{text(k)}, {text(v)}" for k, v in mapping.items())
    return F.try_element_at(F.expr(f"map({entries})"), key)
