"""Property tests: the JVM-side text expressions against the Python string
methods whose behaviour they reproduce, on random text."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

# ASCII letters, digits, punctuation and whitespace, accented Latin letters, and Unicode's other spaces
ALPHABET = st.sampled_from(list("abcxyzABCXYZ019 '-./&_()\"\t\n\r\x0b\x0céèÉàüÖçñ\x1c\x1f\x85\xa0\u1680\u2003\u2028\u202f\u3000"))
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=24), min_size=1, max_size=40)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(fn("s")).collect()]


@SETTINGS
@given(TEXTS)
def test_py_title_matches_str_title(spark, values):
    from cardlake.functions.text import py_title
    assert _apply(spark, values, py_title) == [v.title() for v in values]


@SETTINGS
@given(TEXTS)
def test_collapse_ws_matches_split_join(spark, values):
    from cardlake.functions.text import collapse_ws
    assert _apply(spark, values, collapse_ws) == [" ".join(v.split()) for v in values]


@SETTINGS
@given(TEXTS)
def test_strip_ws_matches_str_strip(spark, values):
    from cardlake.functions.text import strip_ws
    assert _apply(spark, values, strip_ws) == [v.strip() for v in values]


NUMERIC = st.lists(st.text(alphabet=st.sampled_from(list("0123456789.+-eE ")), max_size=10), min_size=1, max_size=40)


def _python_number(s: str):
    """float(s) for plain decimal text; NULL otherwise (no '_', inf or nan)."""
    try:
        return float(s)
    except ValueError:
        return None


@SETTINGS
@given(NUMERIC)
def test_number_guard_matches_python_float(spark, values):
    from cardlake.functions.numbers import try_number
    got = _apply(spark, values, try_number)
    assert got == [_python_number(v) for v in values]


# ------------------------------------------------------------------ month-year vs pandas
DATE_FORMATS = ["%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M", "%Y/%m/%d", "%Y.%m.%d", "%Y-%m", "%Y/%m",
                "%m/%Y", "%m-%Y", "%m/%d/%Y", "%m-%d-%Y", "%m.%d.%Y", "%d/%m/%Y", "%d-%m-%Y", "%Y%m%d", "%Y",
                "%b %Y", "%B %Y", "%B, %Y", "%Y %b", "%B %d, %Y", "%b %d %Y", "%d %B %Y", "%d-%b-%Y", "%b-%d-%Y",
                "%b-%Y", "%b-%y"]


DATES = st.lists(st.tuples(st.dates(min_value=__import__("datetime").date(1950, 1, 1),
                                    max_value=__import__("datetime").date(2060, 12, 31)),
                           st.sampled_from(DATE_FORMATS), st.sampled_from(["as is", "lower", "upper"])),
                 min_size=1, max_size=40)


@SETTINGS
@given(DATES)
def test_month_year_reads_every_written_form(spark, items):
    """The month that was written is the month that is read."""
    import datetime

    from pyspark.sql import functions as F

    from cardlake.functions.dates import month_year
    values, want = [], []
    for d, fmt, case in items:
        if fmt in ("%d/%m/%Y", "%d-%m-%Y") and d.day <= 12:
            d = d.replace(month=d.day)  # read month first: only equal numbers are unambiguous
        if fmt == "%b-%y":
            d = d.replace(year=2000 + d.year % 100, day=1)
        if fmt == "%Y":
            d = d.replace(month=1, day=1)
        text = datetime.datetime(d.year, d.month, d.day, 13, 5, 9).strftime(fmt)
        values.append(text.lower() if case == "lower" else text.upper() if case == "upper" else text)
        want.append(f"{d.year}-{d.month:02d}")
    assert _apply(spark, values, lambda c: month_year(F.col(c))) == want


MONTH_YEAR_CELLS = {
    "2024/03": "2024-03", "03-2024": "2024-03", "3-2024": "2024-03", "2024-03-15 10:30:00": "2024-03", "2024-03-15T10:30:00": "2024-03",
    "2024-09-15T10:00:00Z": "2024-09", "2024-09-15T10:00:00+02:00": "2024-09", "20240315": "2024-03", "03-15-2024": "2024-03",
    "2024.03.15": "2024-03", "03.15.2024": "2024-03", "Sep 2024": "2024-09", "September 2024": "2024-09", "sep 2024": "2024-09",
    "March 15, 2024": "2024-03", "Mar 15 2024": "2024-03", "15 March 2024": "2024-03", "15-Mar-2024": "2024-03", "Sep-2024": "2024-09",
    "2024-3": "2024-03", "3/2024": "2024-03", "03/15/2024": "2024-03", "2024/3/5": "2024-03", "Sept 2024": "2024-09", "2024 Mar": "2024-03",
    "Mar-24-2024": "2024-03", "13/2024": None, "2024-13": None, "15/03/2024": "2024-03", "2024": "2024-01", "24-03-2024": "2024-03",
    "2024-02-30": None, "02/30/2024": None, "Sep-24": "2024-09", "dec-98": "2098-12", "Jan-2010": "2010-01", "2027-03-15": "2027-03",
    "09/2026": "2026-09", "Sep-202": None, "Sep-0024": "2024-09", "Sep-024": "2024-09", "Jan-1500": None, "Jan-1677": None,
    "Jan-1678": "1678-01", "Jan-2262": None, "1500-01-01": None, "n/a": None, "": None,
}


def test_month_year_cells(spark):
    from pyspark.sql import functions as F

    from cardlake.functions.dates import month_year
    got = _apply(spark, list(MONTH_YEAR_CELLS), lambda c: month_year(F.col(c)))
    assert dict(zip(MONTH_YEAR_CELLS, got)) == MONTH_YEAR_CELLS


def test_card_number_above_a_long(spark):
    from pyspark.sql import functions as F

    from cardlake.functions.numbers import whole_number_text
    values = [9300000000000000001.0, 1e20, 12345678901234567890.0, 4344676511951234.0, 2.0 ** 63, 7.9, 0.0, 1e300]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(whole_number_text(F.col("x"))).collect()]
    assert got == [str(int(v)) for v in values[:-1]] + [None]


def test_closest_label_cells():
    """Ratios worked out by hand: 2 * matching letters / letters of both."""
    from cardlake.functions.fuzzy import closest_label
    labels = ["Employed", "Student", "Retired", "Unemployed"]
    assert closest_label("studentt", labels, 0.8) == "Student"          # 14 / 15
    assert closest_label("UNEMPLOYEDD", labels, 0.8) == "Unemployed"    # 20 / 21, Employed 16 / 19
    assert closest_label("employed", labels, 1.0) == "Employed"
    assert closest_label("stud", labels, 0.8) is None                   # 8 / 11
    assert closest_label("stud", labels, 8 / 11) == "Student"
    assert closest_label(None, labels, 0.8) is None and closest_label("x", [], 0.0) is None
    assert closest_label("ab", ["AC", "AD"], 0.5) == "AD"               # equal ratios: the last in text order


# ------------------------------------------------------------------ idempotence
@SETTINGS
@given(TEXTS)
def test_text_cleaning_is_idempotent(spark, values):
    from pyspark.sql import functions as F

    from cardlake.functions.text import collapse_ws, py_title
    df = spark.createDataFrame([(v,) for v in values], "s string")
    once = df.select(py_title(collapse_ws("s")).alias("s"))
    twice = once.select(py_title(collapse_ws("s")).alias("s2"), F.col("s"))
    assert all(r["s"] == r["s2"] for r in twice.collect())


@SETTINGS
@given(DATES)
def test_month_year_is_idempotent(spark, items):
    from pyspark.sql import functions as F

    from cardlake.functions.dates import month_year
    values = [__import__("datetime").datetime(d.year, d.month, d.day).strftime(fmt) for d, fmt, _ in items]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    once = df.select(month_year(F.col("s")).alias("m"))
    twice = once.select("m", month_year(F.col("m")).alias("m2"))
    assert all(r["m"] == r["m2"] for r in twice.collect())


def test_card_money_is_idempotent(spark):
    from pyspark.sql import functions as F

    from cardlake.functions.numbers import card_money, card_money_number_text, card_money_text
    raw = ["$24,295", "(500)", "12 k", "five thousand", "1000000", "2000000", "n/a", '"$5"', " 7.5K ", None]

    def parse(c):
        s = card_money_text(c)
        return card_money(s, card_money_number_text(s))
    df = spark.createDataFrame([(v,) for v in raw], "s string")
    once = df.select(parse(F.col("s")).alias("v"))
    twice = once.select("v", parse(F.col("v").cast("string")).alias("v2"))
    assert all(r["v"] == r["v2"] for r in twice.collect())
