"""Cell tables for the cleaners (FIXTURES.md §3): each case is one raw row run
through the whole-table cleaning job, then looked up by id."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import raw_frame

AS_OF = "2025-06-15"


def _by_id(df, col):
    return {r["id"]: r[col] for r in df.select("id", col).collect()}


def _users(spark, column, values, **fixed):
    from cardlake.plans.transform import clean_users
    rows = [dict(fixed, id=i + 1, **{column: v}) for i, v in enumerate(values)]
    return _by_id(clean_users(raw_frame(spark, "users_data", rows), AS_OF), column)


def _cards(spark, column, values, out=None):
    from cardlake.plans.transform import clean_cards
    rows = [{"id": i + 1, column: v} for i, v in enumerate(values)]
    return _by_id(clean_cards(raw_frame(spark, "cards_data", rows)), out or column)


def _check(got, expected):
    assert [got[i + 1] for i in range(len(expected))] == expected


# ------------------------------------------------------------------ users
def test_user_money(spark):
    cases = [("$59,696", 59696), ("12.5k", 12500), ("Ten Thousand", 10000), ('"$5,000"', 5000),
             ("-500", 500), ("(500)", None), ("five thousand", None), ("ERROR_VALUE", None),
             ("33d", None), ("", None), (None, None)]
    _check(_users(spark, "per_capita_income", [c for c, _ in cases]), [e for _, e in cases])


def test_yearly_income_floor(spark):
    cases = [("50", 0), ("99.99", 0), ("100", 100), (None, None), ("$1,000.50", 1001)]
    _check(_users(spark, "yearly_income", [c for c, _ in cases]), [e for _, e in cases])


def test_gender(spark):
    cases = [("M", "Male"), (" male ", "Male"), ("f", "Female"), ("unknown", None),
             ("non  BINARY", "Non binary"), ("", None), (None, None)]
    _check(_users(spark, "gender", [c for c, _ in cases]), [e for _, e in cases])


def test_employment(spark):
    cases = [("empl0yed", "Employed"), (" RET. ", "Retired"), ("self  employd", "Self-Employed"),
             ("unemployedd", "Unemployed"), ("studentt", "Student"), ("gig worker", "Gig Worker"),
             ("", None), ("retird", "Retired"), ("unemployd", "Unemployed")]
    _check(_users(spark, "employment_status", [c for c, _ in cases]), [e for _, e in cases])


def test_education(spark):
    cases = [("BA/BS", "Bachelor Degree"), ("hs", "High School"), ("master's  degree", "Masters"),
             ("doctorat", "Doctorate"), ("High  Schol", "High School"), ("phd's", "Phd'S")]
    _check(_users(spark, "education_level", [c for c, _ in cases]), [e for _, e in cases])


def test_title_case_address(spark):
    got = _users(spark, "address", ["men's 3rd-AVE o'NEIL", "  12   main\tst ", "   "])
    assert [got[1], got[2], got[3]] == ["Men'S 3Rd-Ave O'Neil", "12 Main St", None]


@pytest.mark.parametrize("column,cases", [
    ("birth_month", [(0, None), (12, 12), (13, None)]),
    ("birth_year", [(1899, None), (1900, 1900), (2025, 2025), (2026, None)]),
    ("credit_score", [(299, None), (850, 850)]),
    ("num_credit_cards", [(-1, None), (0, 0)]),
    ("latitude", [(90.0, 90.0), (90.1, None)]),
    ("longitude", [(-180.0, -180.0), (-180.5, None)]),
])
def test_ranges(spark, column, cases):
    _check(_users(spark, column, [c for c, _ in cases]), [e for _, e in cases])


def test_age_from_birth(spark):
    from cardlake.plans.transform import clean_users
    rows = [dict(id=1, birth_year=1980, birth_month=6), dict(id=2, birth_year=1980, birth_month=7),
            dict(id=3, birth_year=1980), dict(id=4, birth_year=1900, birth_month=1),
            dict(id=5, birth_year=1980, birth_month=6, current_age=3)]
    got = _by_id(clean_users(raw_frame(spark, "users_data", rows), AS_OF), "current_age")
    assert got == {1: 45, 2: 44, 3: None, 4: None, 5: 45}


def test_users_keep_first(spark):
    from cardlake.plans.transform import clean_users
    rows = [dict(id=7, gender="f"), dict(id=7, gender="m"), dict(id=8, gender="m")]
    got = _by_id(clean_users(raw_frame(spark, "users_data", rows), AS_OF), "gender")
    assert got == {7: "Female", 8: "Male"}


# ------------------------------------------------------------------ cards
def test_card_money(spark):
    cases = [("$24,295", 24295.0), ("(500)", 500.0), ("12 k", 12000.0), ("five thousand", 5000.0),
             ("1000000", 1000000.0), ("2000000", None), ("n/a", None), ('"$5"', None)]
    _check(_cards(spark, "credit_limit", [c for c, _ in cases]), [e for _, e in cases])


def test_month_year(spark):
    cases = [("Sep-24", "2024-09"), ("dec-98", "2098-12"), ("Jan-2010", "2010-01"), ("2027-03-15", "2027-03"),
             ("09/2026", "2026-09"), ("Sep-202", None), ("not available", None), (None, None),
             ("March 15, 2009", "2009-03"), ("15/03/2011", "2011-03"), ("2012-06-01 08:30:00", "2012-06"),
             ("Sept 2013", "2013-09"), ("20140105", "2014-01"), ("02/30/2024", None)]
    _check(_cards(spark, "expires", [c for c, _ in cases]), [e for _, e in cases])


def test_cvv(spark):
    cases = [(99, None), (100, 100), (999, 999), (1000, None)]
    _check(_cards(spark, "cvv", [c for c, _ in cases]), [e for _, e in cases])


def test_yes_no(spark):
    cases = [("YES", "Yes"), ("n", "No"), ("1", "Yes"), ("False", "No"), ("maybe", None), (None, None)]
    _check(_cards(spark, "has_chip", [c for c, _ in cases]), [e for _, e in cases])


def test_brand_and_type(spark):
    brands = [(" v!sa", "Visa"), ("Master  Card", "Mastercard"), ("JCB", "Other"), (None, "Other")]
    _check(_cards(spark, "card_brand", [c for c, _ in brands]), [e for _, e in brands])
    types = [("debti", "Debit"), ("Debit (Prepaid)", "Prepaid"), (" CC ", "Credit"), ("charge", "Other")]
    _check(_cards(spark, "card_type", [c for c, _ in types]), [e for _, e in types])


def test_risk_rating(spark):
    cases = [("LOW risk", "Low"), ("med", "Medium"), ("??", "Medium"), (None, "Medium")]
    _check(_cards(spark, "issuer_risk_rating", [c for c, _ in cases]), [e for _, e in cases])


def test_bank_name(spark):
    cases = [("chase bk", "Chase Bank"), ("U.S. Bk", "U.S. Bank"), ("first o'hare BANK", "First O'Hare Bank"),
             (None, "None")]
    _check(_cards(spark, "issuer_bank_name", [c for c, _ in cases]), [e for _, e in cases])


def test_bank_state(spark):
    cases = [("California", "CA"), ("ny", "NY"), ("Nevada", "NE"), ("N.Y.", None), ("", None)]
    _check(_cards(spark, "issuer_bank_state", [c for c, _ in cases]), [e for _, e in cases])


def test_card_number(spark):
    cases = [("4344676511951000.0", "4344676511951000"), ("4344 6765 1195 0444", "4344 6765 1195 0444"),
             ("4.34467651195044E+15", "4344676511950440")]
    _check(_cards(spark, "card_number", [c for c, _ in cases]), [e for _, e in cases])


def test_mask_card_number(spark):
    from cardlake.plans.curated import build_dim_cards
    from cardlake.plans.transform import clean_cards
    rows = [{"id": 1, "card_number": "4344 6765 1195 0444"}, {"id": 2, "card_number": "12"}]
    dim = build_dim_cards(clean_cards(raw_frame(spark, "cards_data", rows)))
    got = {r["card_id"]: r["masked_card_number"] for r in dim.collect()}
    assert got == {1: "**** **** **** 0444", 2: None}
    assert "card_number" not in dim.columns and "cvv" not in dim.columns


def test_cards_keep_first_before_cleaning(spark):
    from cardlake.plans.transform import clean_cards
    rows = [{"id": 5, "has_chip": "maybe"}, {"id": 5, "has_chip": "yes"}]
    assert _by_id(clean_cards(raw_frame(spark, "cards_data", rows)), "has_chip") == {5: None}


# ------------------------------------------------------------------ mcc
def test_mcc(spark):
    from cardlake.plans.transform import clean_mcc
    rows = [{"code": "MCC 5011", "notes": "LEGACY", "updated_by": "data_team", "description": " men's  3rd-AVE "},
            {"code": '"5012"', "notes": "check", "updated_by": "ops-admin"},
            {"code": "5013.0", "notes": "free text"},
            {"code": "note"}, {"code": "-5014"}, {"code": "\\N"}, {"code": "5011", "notes": "check"}]
    got = {r["code"]: r.asDict() for r in clean_mcc(raw_frame(spark, "mcc_data", rows)).collect()}
    assert sorted(got) == [5011, 5012, 5013]
    assert got[5011]["notes"] == "Legacy Data" and got[5011]["updated_by"] == "Data Team"
    assert got[5011]["description"] == "Men'S 3Rd-Ave"
    assert got[5012]["notes"] == "Needs Check" and got[5012]["updated_by"] == "Ops Admin"
    assert got[5013]["notes"] == "free text" and got[5013]["updated_by"] is None


# ------------------------------------------------------------------ transactions
def _tx(spark, rows):
    from cardlake.plans.transform import clean_transactions
    base = {"date": "2020-01-02 10:00:00", "amount": "$10.00"}
    rows = [dict(base, id=str(i + 1), **r) for i, r in enumerate(rows)]
    return {r["id"]: r for r in clean_transactions(raw_frame(spark, "transactions_data", rows)).collect()}


def test_amount_and_refund(spark):
    got = _tx(spark, [{"amount": "$-77.00"}, {"amount": "$1,234.50"}, {"amount": "(5)"},
                      {"amount": "$0.00"}, {"amount": "oops"}])
    assert sorted(got) == [1, 2]
    assert (got[1]["amount"], got[1]["refund_amount"], got[1]["is_refund"]) == (Decimal("77.00"), Decimal("77.00"), True)
    assert (got[2]["amount"], got[2]["refund_amount"], got[2]["is_refund"]) == (Decimal("1234.50"), None, False)


def test_channel_and_online(spark):
    got = _tx(spark, [{"use_chip": "Swipe Transaction", "merchant_city": "Boston ", "merchant_state": "ny", "zip": "02139"},
                      {"merchant_city": "ONLINE", "merchant_state": "CA", "zip": "90001.0"},
                      {}, {"use_chip": "online"}])
    assert (got[1]["use_chip"], got[1]["merchant_city"], got[1]["is_online"]) == ("Swipe", "Boston", False)
    assert (got[2]["merchant_city"], got[2]["merchant_state"], got[2]["zip"], got[2]["is_online"]) == \
        ("Online", None, None, True)
    assert got[3]["is_online"] is False and got[3]["merchant_city"] is None
    assert got[4]["is_online"] is True and got[4]["merchant_city"] == "Online"


def test_state_zip_errors(spark):
    states = [("ny", "NY"), ("Texas", "TX"), ("pr", "PR"), ("Ontario", None), ("Nevada", None)]
    got = _tx(spark, [{"merchant_state": s} for s, _ in states])
    assert [got[i + 1]["merchant_state"] for i in range(len(states))] == [e for _, e in states]
    zips = [("90001.0", "90001"), ("10.05", "105"), ("", None), ("02139", "02139")]
    got = _tx(spark, [{"zip": z} for z, _ in zips])
    assert [got[i + 1]["zip"] for i in range(len(zips))] == [e for _, e in zips]
    errs = [("NaN", None), ("", ""), (" Bad PIN,", " Bad PIN,"), (None, None)]
    got = _tx(spark, [{"errors": e} for e, _ in errs])
    assert [got[i + 1]["errors"] for i in range(len(errs))] == [e for _, e in errs]


def test_date_parts(spark):
    got = _tx(spark, [{"date": "2021-07-04 13:45:00"}, {"date": "bad date"}])
    r = got[1]
    assert r["date"] == dt.datetime(2021, 7, 4, 13, 45)
    assert (r["transaction_year"], r["transaction_month"], r["transaction_quarter"], r["transaction_hour"],
            r["day_of_week"]) == (2021, 7, 3, 13, "Sunday")
    assert got[2]["date"] is None and got[2]["day_of_week"] is None


def test_tx_dedup_before_amount_filter(spark):
    # the first arrival of id 1 has a bad amount: the id is dropped, not replaced by the second
    from cardlake.plans.transform import clean_transactions
    rows = [{"id": "1", "amount": "oops"}, {"id": "1", "amount": "$5.00"}, {"id": "2", "amount": "$6.00"}]
    out = clean_transactions(raw_frame(spark, "transactions_data", rows))
    assert sorted(r["id"] for r in out.collect()) == [2]


def test_trimming_looks_at_the_ends_only(spark):
    """Every whitespace character, by `trim` and not by a pattern tried at each place."""
    from cardlake.functions.dates import day_name, parse_timestamp
    from cardlake.functions.numbers import try_integer_text, try_number
    from cardlake.functions.text import WS, WS_CHARS, strip_ws

    white = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and re.match(WS.replace(r"\s", " \t\n\f\r"), chr(c))]
    assert sorted(white) == sorted(WS_CHARS)
    rows = [f"{w}+7{v}" for w in white for v in ("", w, "\n")] + [" 7 7 ", "\x007", "7\x00", "+", "", None, "7.5", " 7"]
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    got = df.select("s", strip_ws("s").alias("t"), try_integer_text("s").alias("i"), try_number("s").alias("d")).collect()
    for r in got:
        assert r.t == (None if r.s is None else r.s.strip(WS_CHARS)), repr(r.s)
        assert r.i == {"+7": 7, "7": 7}.get(r.t) and r.d == {"+7": 7.0, "7": 7.0, "7.5": 7.5}.get(r.t), repr(r.s)
    assert "regexp" not in df.select(strip_ws("s"))._jdf.queryExecution().optimizedPlan().toString()
    times = ["2020-02-29 23:59:59", "2021-02-29 00:00:00", "2020-01-01 24:00:00", "2020-01-01 10:00:60", "0001-01-01 00:00:00", "9999-12-31 23:00:00",
             "2020-01-05", "2020-1-5 1:1:1", "2020-01-01 00:00:00\n", " 2020-01-01 00:00:00", "2020-01-01T00:00:00", "bad date", None]
    stamps = spark.createDataFrame([(t,) for t in times], "s string")
    c = F.col("s")
    old = F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd"))).cast("timestamp_ntz")
    for r in stamps.select(parse_timestamp("s").alias("new"), old.alias("old"), day_name(parse_timestamp("s")).alias("day"),
                           F.date_format(old, "EEEE").alias("name")).collect():
        assert (r.new, r.day) == (r.old, r.name)
