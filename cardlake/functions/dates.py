"""Date / timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardlake.functions import fixed_values as V
from cardlake.functions.text import col_, lookup

# Accepted timestamp text for transactions, first match wins.
TX_TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")

# text of the first format in every place (`\\z`: no line end after it)
_FULL_TIMESTAMP = r"^[1-9]\d{3}-\d\d-\d\d \d\d:\d\d:\d\d\z"

# years that a 64-bit nanosecond timestamp holds in full
FIRST_YEAR, LAST_YEAR = 1678, 2261

_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun",
           "jul", "aug", "sep", "oct", "nov", "dec"]
_MONTH_NAMES = ["january", "february", "march", "april", "may", "june",
                "july", "august", "september", "october", "november", "december"]
_DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# month name (full, 3-letter or "sept", any case) -> month number
_MONTH_BY_NAME = {**{m: str(i + 1) for i, m in enumerate(_MONTHS)},
                  **{m: str(i + 1) for i, m in enumerate(_MONTH_NAMES)}, "sept": "9"}

# General month-year forms after the `Mon-yy` rule, first match wins.  Each
# is (regex, year group, month group, day group or None).  Month-first
# numeric dates (`M/d/yyyy`, `M-d-yyyy`, `M.d.yyyy`) read day-first when the
# first number cannot be a month.
_GENERAL_FORMATS = [
    (r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?:[ Tt]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:[Zz]|[+-]\d{2}:?\d{2})?)?$", 1, 3, 4),
    (r"^(\d{4})[-/](\d{1,2})$", 1, 2, None),
    (r"^(\d{1,2})[-/](\d{4})$", 2, 1, None),
    (r"^(\d{4})(\d{2})(\d{2})$", 1, 2, 3),
    (r"^(\d{4})$", 1, None, None),
]
_MDY = r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4})$"
# named-month forms: (regex, year group, month-name group, day group or None)
_NAMED_FORMATS = [
    (r"^([A-Za-z]+)[ ,]+(\d{4})$", 2, 1, None),                       # Sep 2024, September, 2024
    (r"^(\d{4})[ ,]+([A-Za-z]+)$", 1, 2, None),                       # 2024 Mar
    (r"^([A-Za-z]+)[ -](\d{1,2}),?[ -](\d{4})$", 3, 1, 2),            # March 15, 2024 / Mar-24-2024
    (r"^(\d{1,2})[ -]([A-Za-z]+),?[ -](\d{4})$", 3, 2, 1),            # 15 March 2024 / 15-Mar-2024
]


def parse_timestamp(c: Column | str, formats=TX_TIMESTAMP_FORMATS) -> Column:
    """Text -> TIMESTAMP_NTZ using the first format that parses, else NULL.
    Text written out in full is cast: the cast reads it alike, and without a formatter's work."""
    c = col_(c)
    full = [F.when(c.rlike(_FULL_TIMESTAMP), c.try_cast("timestamp_ntz"))] if TX_TIMESTAMP_FORMATS[0] in formats else []
    parsed = [F.try_to_timestamp(c, F.lit(fmt)) for fmt in formats]
    return F.coalesce(*full, F.coalesce(*parsed).cast("timestamp_ntz"))


def _valid_date(y: Column, m: Column, d: Column) -> Column:
    text = F.format_string("%04d-%02d-%02d", y, m, d)
    return F.try_to_date(text, "yyyy-MM-dd")


def month_year(s: Column) -> Column:
    """Card dates (trimmed text, see strip_ws) -> 'YYYY-MM'.

    `Mon-yy` / `Mon-yyyy` first (3-letter month, any case; a year under 100,
    however it is written, is 20yy), then the general numeric and named-month forms above;
    placeholders and anything else -> NULL.  Two-digit years are accepted
    only by the first rule.  Years outside FIRST_YEAR to LAST_YEAR are NULL.
    """
    mon_re = r"^([A-Za-z]{3})-(\d{2,4})$"
    mon = F.lower(F.regexp_extract(s, mon_re, 1))
    ytxt = F.regexp_extract(s, mon_re, 2)
    number = ytxt.try_cast("int")
    month_no = lookup(mon, {m: str(i + 1) for i, m in enumerate(_MONTHS)}).cast("int")
    year = F.when(number < 100, F.lit(2000) + number).when(F.length(ytxt) == 4, number)
    candidates = [F.when(s.rlike(mon_re), _valid_date(year, month_no, F.lit(1)))]

    def part(rx: str, group: int | None) -> Column:
        return F.regexp_extract(s, rx, group).try_cast("int") if group else F.lit(1)

    for rx, yi, mi, di in _GENERAL_FORMATS:
        candidates.append(F.when(s.rlike(rx), _valid_date(part(rx, yi), part(rx, mi), part(rx, di))))
    first, second = part(_MDY, 1), part(_MDY, 3)
    candidates.append(F.when(s.rlike(_MDY), F.when(first <= 12, _valid_date(part(_MDY, 4), first, second))
                                                .otherwise(_valid_date(part(_MDY, 4), second, first))))
    for rx, yi, ni, di in _NAMED_FORMATS:
        name_no = lookup(F.lower(F.regexp_extract(s, rx, ni)), _MONTH_BY_NAME).cast("int")
        candidates.append(F.when(s.rlike(rx), _valid_date(part(rx, yi), name_no, part(rx, di))))
    parsed = F.coalesce(*[F.when(F.year(c).between(FIRST_YEAR, LAST_YEAR), c) for c in candidates])
    return (
        F.when(s.isNull() | F.lower(s).isin(V.MONTH_YEAR_NULLS), F.lit(None).cast("string"))
        .otherwise(F.date_format(parsed, "yyyy-MM"))
    )


def day_name(c: Column | str) -> Column:
    return F.get(F.array(*map(F.lit, _DAY_NAMES)), F.dayofweek(col_(c)) - 1)


def month_name(c: Column | str) -> Column:
    return F.date_format(col_(c), "MMMM")


def is_weekend(c: Column | str) -> Column:
    return F.dayofweek(col_(c)).isin(1, 7)
