"""Transformation layer: raw tables -> cleaned tables.

Every cleaner is one projection of native Column expressions over the whole
table (plus a keep-first aggregation); nothing runs per row in Python except
the fuzzy scoring of distinct unmatched spellings.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.functions import fixed_values as V
from cardlake.functions.dates import day_name, month_year, parse_timestamp
from cardlake.functions.fuzzy import fuzzy_table_by_field
from cardlake.functions.numbers import (TX_AMOUNT_PARSE, card_money, card_money_number_text, card_money_text,
                                        in_range, round_to_long, trunc_to_long, try_integer_text, try_number,
                                        tx_amount_text, user_money, user_money_overflows, user_money_text, whole_number_text)
from cardlake.functions.text import (WS, as_text, capitalize_first, collapse_ws, lookup, nullif_blank,
                                     nullif_in, py_title, squeeze_ws, strip_chars, strip_ws)
from cardlake.operators.dedup import keep_first
from cardlake.operators.joins import broadcast_if_bounded
from cardlake.session import write_scratch

SEQ = "_seq"

USERS_COLUMNS = [
    "id", "current_age", "retirement_age", "birth_year", "birth_month",
    "gender", "address", "latitude", "longitude",
    "per_capita_income", "yearly_income", "total_debt",
    "credit_score", "num_credit_cards",
    "employment_status", "education_level",
]

CARDS_COLUMNS = [
    "id", "client_id", "card_brand", "card_type", "card_number", "expires", "cvv",
    "has_chip", "num_cards_issued", "credit_limit", "acct_open_date",
    "year_pin_last_changed", "card_on_dark_web", "issuer_bank_name",
    "issuer_bank_state", "issuer_bank_type", "issuer_risk_rating",
]

MCC_COLUMNS = ["code", "description", "notes", "updated_by"]

TRANSACTIONS_COLUMNS = [
    "id", "date", "client_id", "card_id", "amount", "refund_amount",
    "use_chip", "merchant_id", "merchant_city", "merchant_state", "zip",
    "mcc", "errors", "is_refund", "is_online",
    "transaction_year", "transaction_month", "transaction_quarter",
    "transaction_hour", "day_of_week",
]


def _seq_or_default(df: DataFrame) -> DataFrame:
    """Inputs without an arrival sequence get one (file order per partition)."""
    return df if SEQ in df.columns else df.withColumn(SEQ, F.monotonically_increasing_id())


def _null(t: str = "string") -> Column:
    return F.lit(None).cast(t)


def stored_rows(staged: DataFrame) -> DataFrame:
    """The rows of a staged table that its cleaned table holds."""
    return staged.where("_reason is null").drop("_reason", "_raw_id")


def reject_rows(staged: DataFrame, table: str) -> DataFrame:
    """(table_name, reason, id) of a staged table's rejected rows; id is the raw text."""
    return staged.where("_reason is not null").select(F.lit(table).alias("table_name"), F.col("_reason").alias("reason"),
                                                      F.col("_raw_id").alias("id"))


def _carried(carry) -> list[Column]:
    """Raw input columns passed through unchanged as `raw_<name>` (for
    raw -> cleaned value reports; empty in the pipeline)."""
    return [F.col(c).alias(f"raw_{c}") for c in carry]


def _carried_names(carry) -> list[str]:
    return [f"raw_{c}" for c in carry]


# ====================================================================== users
def _direct_label(key: Column, aliases: dict, canonical: list) -> Column:
    return F.coalesce(lookup(key, aliases), lookup(key, {c.lower(): c for c in canonical}))


def _label_columns(df: DataFrame, name: str, aliases: dict, canonical: list) -> DataFrame:
    cleaned = collapse_ws(F.col(name))
    return (df.withColumn(f"_{name}_clean", F.when(cleaned != "", cleaned))
              .withColumn(f"_{name}_direct", _direct_label(F.lower(F.col(f"_{name}_clean")), aliases, canonical)))


LABEL_FIELDS = (
    ("employment_status", V.EMPLOYMENT_ALIASES, V.EMPLOYMENT_CANONICAL),
    ("education_level", V.EDUCATION_ALIASES, V.EDUCATION_CANONICAL),
)


def _unmatched_spellings(df: DataFrame) -> DataFrame:
    """(field, value) for every label field whose spelling no alias or
    canonical label resolved - both fields in one pass over `df`."""
    pairs = F.array(*[F.struct(F.lit(name).alias("field"),
                               F.when(F.col(f"_{name}_direct").isNull(), F.col(f"_{name}_clean")).alias("value"))
                      for name, _, _ in LABEL_FIELDS])
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull())


def _fuzzy_labels(df: DataFrame) -> DataFrame:
    """(field, value, fuzzy_label) for the unmatched spellings of `df`."""
    return fuzzy_table_by_field(_unmatched_spellings(df), "field", "value",
                                {name: canonical for name, _, canonical in LABEL_FIELDS}, V.FUZZY_CUTOFF)


def _resolve_labels(df: DataFrame) -> DataFrame:
    """alias / canonical hit, else closest canonical label, else title case.

    The fuzzy table (distinct unmatched spellings only) is built once for all
    label fields and written, so the size check sees its own size and not an
    estimate from its input.  Only unresolved spellings are join keys: resolved
    rows have a NULL key, which a left join never matches, and which AQE
    splits beyond the broadcast bound.
    """
    table = broadcast_if_bounded(write_scratch(_fuzzy_labels(df), "fuzzy"))
    for name, _, _ in LABEL_FIELDS:
        clean, direct, fuzzy, key = f"_{name}_clean", f"_{name}_direct", f"_{name}_fuzzy", f"_{name}_key"
        side = table.where(F.col("field") == name).select(F.col("value").alias(key), F.col("fuzzy_label").alias(fuzzy))
        df = df.withColumn(key, F.when(F.col(direct).isNull(), F.col(clean)))
        df = df.join(side, key, "left")
        label = F.coalesce(F.col(direct), F.col(fuzzy), py_title(F.col(clean)))
        df = df.withColumn(name, label).drop(clean, direct, fuzzy, key)
    return df


def fuzzy_matches(raw_users: DataFrame) -> DataFrame:
    """(field, value, fuzzy_label): each distinct employment / education
    spelling that no alias or canonical label resolved, with the closest
    canonical label (only spellings at or above the cut-off)."""
    df = raw_users.select(*[name for name, _, _ in LABEL_FIELDS])
    for name, aliases, canonical in LABEL_FIELDS:
        df = _label_columns(df, name, aliases, canonical)
    return _fuzzy_labels(df)


def clean_users(raw: DataFrame, as_of: _dt.date | str, carry: Sequence[str] = ()) -> DataFrame:
    """Cleaned users (one row per id, first arrival wins) without the rejected ones."""
    return stored_rows(stage_users(raw, as_of, carry))


def stage_users(raw: DataFrame, as_of: _dt.date | str, carry: Sequence[str] = ()) -> DataFrame:
    """Cleaned users with `_reason` (why a row cannot be stored: an amount of
    money that no BIGINT holds) and `_raw_id`.  Keep-first by the id as a number
    comes before cleaning, which then runs on the shuffled partitions and not on
    the few that a small file is read in."""
    as_of = _dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    df = _seq_or_default(raw).withColumn("_raw_id", F.col("id").cast("string"))
    if carry:
        df = df.withColumns({f"raw_{c}": F.col(c) for c in carry})
    df = keep_first(df.withColumn("id", trunc_to_long(F.col("id").cast("double"))), ["id"], [SEQ])

    gender_clean = F.lower(collapse_ws(F.col("gender")))
    gender = (F.when(gender_clean.isNull() | (gender_clean == "") | gender_clean.isin(V.GENDER_NULLS), _null())
              .otherwise(F.coalesce(lookup(gender_clean, V.GENDER_MAP), capitalize_first(gender_clean))))
    address = collapse_ws(F.col("address"))

    def bounded(c: str) -> Column:
        lo, hi = V.RANGES[c]
        return in_range(trunc_to_long(F.col(c).cast("double")), lo, hi).cast("int")

    # stage the normalised money text, then the parsed yearly income (used twice)
    df = df.withColumns({f"_{c}": user_money_text(c) for c in ("per_capita_income", "yearly_income", "total_debt")})
    df = df.withColumn("_yearly", user_money(F.col("_yearly_income")))
    yearly = F.col("_yearly")
    overflow = (user_money_overflows(F.col("_per_capita_income")) | user_money_overflows(F.col("_yearly_income"))
                | user_money_overflows(F.col("_total_debt")))
    df = df.select(
        F.col("id"),
        bounded("retirement_age").alias("retirement_age"),
        bounded("birth_year").alias("birth_year"),
        bounded("birth_month").alias("birth_month"),
        gender.alias("gender"),
        F.when(address != "", py_title(address)).alias("address"),
        in_range(F.col("latitude").cast("double"), *V.RANGES["latitude"]).alias("latitude"),
        in_range(F.col("longitude").cast("double"), *V.RANGES["longitude"]).alias("longitude"),
        round_to_long(user_money(F.col("_per_capita_income"))).alias("per_capita_income"),
        round_to_long(F.when(yearly < V.YEARLY_INCOME_FLOOR, F.lit(0)).otherwise(yearly)).alias("yearly_income"),
        round_to_long(user_money(F.col("_total_debt"))).alias("total_debt"),
        bounded("credit_score").alias("credit_score"),
        F.when(F.col("num_credit_cards") >= V.NUM_CREDIT_CARDS_MIN,
               trunc_to_long(F.col("num_credit_cards").cast("double"))).cast("int").alias("num_credit_cards"),
        F.col("employment_status"),
        F.col("education_level"),
        F.when(overflow, "money_overflow").alias("_reason"),
        F.col("_raw_id"),
        *_carried_names(carry),
    )
    # age from cleaned birth year / month at the as-of date, then bounded
    age = (F.lit(as_of.year) - F.col("birth_year")
           - F.when(F.lit(as_of.month) < F.col("birth_month"), 1).otherwise(0))
    age = F.when(F.col("birth_year").isNotNull() & F.col("birth_month").isNotNull(), age)
    df = df.withColumn("current_age", in_range(age, *V.RANGES["current_age"]).cast("int"))

    for name, aliases, canonical in LABEL_FIELDS:
        df = _label_columns(df, name, aliases, canonical)
    df = _resolve_labels(df)
    return df.select(*USERS_COLUMNS, "_reason", "_raw_id", *_carried_names(carry))


# ====================================================================== cards
def _mapped(c: str, mapping: dict, default: str, collapse: bool = False) -> Column:
    key = F.lower(strip_ws(as_text(F.col(c), V.NULL_TEXT)))
    if collapse:
        key = squeeze_ws(key)
    return F.coalesce(lookup(key, mapping), F.lit(default))


def _yes_no(c: str) -> Column:
    return lookup(F.lower(strip_ws(as_text(F.col(c), V.NULL_TEXT))), V.YES_NO_MAP)


def _card_number(c: str) -> Column:
    raw = F.col(c)
    as_int = whole_number_text(try_number(raw))
    return F.when(raw.isNull(), _null()).otherwise(F.coalesce(as_int, strip_ws(raw)))


def _bank_state(s: Column) -> Column:
    """`s` is the trimmed text."""
    abbr = F.substring(F.upper(s), 1, 2)
    return (F.when(s.isNull(), _null())
            .otherwise(F.coalesce(lookup(F.lower(s), V.BANK_STATE_MAP),
                                  F.when(abbr.rlike(r"^\p{L}+$"), abbr))))


def clean_cards(raw: DataFrame, null_text: str = V.NULL_TEXT, carry: Sequence[str] = ()) -> DataFrame:
    """Cleaned cards without the rejected ones."""
    return stored_rows(stage_cards(raw, null_text, carry))


#: Whole-number columns of cards and their stored types.
CARD_NUMBERS = {"id": "long", "client_id": "long", "num_cards_issued": "int", "year_pin_last_changed": "int"}


def stage_cards(raw: DataFrame, null_text: str = V.NULL_TEXT, carry: Sequence[str] = ()) -> DataFrame:
    """Cleaned cards with `_reason` (the first number that its column cannot
    hold) and `_raw_id`; keep-first by id happens before cleaning."""
    df = keep_first(_seq_or_default(raw), ["id"], [SEQ])
    df = df.withColumns({
        "_limit_s": card_money_text("credit_limit"),
        "_expires_s": strip_ws(F.col("expires")),
        "_open_s": strip_ws(F.col("acct_open_date")),
        "_bank_s": strip_ws(as_text(F.col("issuer_bank_name"), null_text)),
        "_state_s": strip_ws(F.col("issuer_bank_state")),
    }).withColumn("_limit_t", card_money_number_text(F.col("_limit_s")))
    bank_text = F.col("_bank_s")
    cvv = trunc_to_long(F.col("cvv").cast("double"))
    reason = F.coalesce(*[F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), f"bad_{c}") for c, t in CARD_NUMBERS.items()])
    return df.select(
        F.col("id").try_cast("long").alias("id"),
        F.col("client_id").try_cast("long").alias("client_id"),
        _mapped("card_brand", V.BRAND_MAPPING, V.OTHER, collapse=True).alias("card_brand"),
        _mapped("card_type", V.TYPE_MAPPING, V.OTHER, collapse=True).alias("card_type"),
        _card_number("card_number").alias("card_number"),
        month_year(F.col("_expires_s")).alias("expires"),
        in_range(cvv, *V.CVV_RANGE).cast("int").alias("cvv"),
        _yes_no("has_chip").alias("has_chip"),
        F.col("num_cards_issued").try_cast("int").alias("num_cards_issued"),
        card_money(F.col("_limit_s"), F.col("_limit_t")).alias("credit_limit"),
        month_year(F.col("_open_s")).alias("acct_open_date"),
        F.col("year_pin_last_changed").try_cast("int").alias("year_pin_last_changed"),
        _yes_no("card_on_dark_web").alias("card_on_dark_web"),
        F.coalesce(lookup(F.lower(bank_text), V.BANK_NAME_MAPPING), py_title(bank_text)).alias("issuer_bank_name"),
        _bank_state(F.col("_state_s")).alias("issuer_bank_state"),
        _mapped("issuer_bank_type", V.BANK_TYPE_MAPPING, V.OTHER).alias("issuer_bank_type"),
        _mapped("issuer_risk_rating", V.RISK_RATING_MAPPING, V.RISK_DEFAULT).alias("issuer_risk_rating"),
        reason.alias("_reason"),
        F.col("id").cast("string").alias("_raw_id"),
        *_carried(carry),
    )


# ====================================================================== mcc
def _mcc_code_text(s: Column) -> Column:
    """`s` trimmed code text -> without `MCC` prefix and surrounding quotes."""
    no_prefix = F.regexp_replace(s, f"^(?i:mcc){WS}*", "")
    return strip_chars(strip_chars(no_prefix, '"'), "'")


def _mcc_code(s: Column, unquoted: Column) -> Column:
    number = trunc_to_long(try_number(unquoted))
    return (F.when(s.isNull() | s.isin(V.MCC_BLANKS), _null("int"))
            .when(F.upper(unquoted).isin(V.MCC_CODE_NULLS), _null("int"))
            .when(number >= 0, number.try_cast("int")))


def mcc_code(c: Column) -> Column:
    """Raw MCC code text -> code (INT) or NULL."""
    s = strip_ws(c)
    return _mcc_code(s, _mcc_code_text(s))


def _mcc_text(c: str) -> Column:
    s = strip_ws(F.col(c))
    return F.when(~s.isin(V.MCC_BLANKS), s)


def rejected_mcc(raw: DataFrame) -> DataFrame:
    """(reason, id) of MCC rows whose code is a number that no INT column holds."""
    s = strip_ws(F.col("code"))
    number = try_number(_mcc_code_text(s))
    return raw.where((number >= F.lit(2.0 ** 31)) & _mcc_code(s, _mcc_code_text(s)).isNull()) \
              .select(F.lit("code_overflow").alias("reason"), F.col("code").alias("id"))


def clean_mcc(raw: DataFrame) -> DataFrame:
    """Cleaned MCC codes; rows without a valid code dropped (a number above the
    INT range goes to `rejected_mcc`); keep-first per code, texts cleaned after it."""
    df = _seq_or_default(raw).withColumn("_code_s", strip_ws(F.col("code")))
    df = df.withColumn("_code_u", _mcc_code_text(F.col("_code_s")))
    desc = _mcc_text("description")
    notes = _mcc_text("notes")
    upd = _mcc_text("updated_by")
    df = df.select(
        _mcc_code(F.col("_code_s"), F.col("_code_u")).alias("code"),
        F.col(SEQ), "description", "notes", "updated_by",
    ).where(F.col("code").isNotNull())
    df = keep_first(df, ["code"], [SEQ]).select(
        "code",
        py_title(squeeze_ws(desc)).alias("description"),
        F.coalesce(lookup(F.lower(notes), V.NOTES_MAP), notes).alias("notes"),
        py_title(F.translate(upd, "_-", "  ")).alias("updated_by"),
    )
    # the layer is loaded from CSV with empty = NULL
    return df.select("code", *[nullif_blank(c).alias(c) for c in ("description", "notes", "updated_by")])


# ====================================================================== transactions
def _tx_state(c: Column) -> Column:
    s = strip_ws(c)
    up = F.upper(s)
    return F.when(up.isin(V.VALID_US_STATES), up).otherwise(lookup(F.lower(s), V.STATE_NAME_MAP))


# amounts of this size do not fit DECIMAL(10,2)
AMOUNT_LIMIT = 10 ** 8


def _staged_transactions(raw: DataFrame, dedup: bool, without_id: bool = False) -> DataFrame:
    """Raw transactions with their id as a number (rows without one left out,
    unless `without_id`: then each stays, a group of its own), keep-first by
    that id over the whole input (one infinite chunk), then the
    amount filter, as in the source where de-duplication precedes filtering.
    `_reason` says why a row cannot be stored as it is, `_raw_id` is the id's
    raw text where it is not the number's plain text (the shuffle carries no
    other).  The filter compares the amount before any rounding."""
    df = _seq_or_default(raw).withColumn("_raw_id", F.col("id")).withColumn("id", try_integer_text(F.col("id"), "bigint"))
    df = df.withColumn("_raw_id", F.when(~F.col("_raw_id").eqNullSafe(F.col("id").cast("string")), F.col("_raw_id")))
    if not without_id:
        df = df.where(F.col("id").isNotNull())
    if dedup and without_id:
        alone = F.when(F.col("id").isNull(), F.monotonically_increasing_id())
        df = keep_first(df.withColumn("_alone", alone), ["id", "_alone"], [SEQ]).drop("_alone")
    elif dedup:
        df = keep_first(df, ["id"], [SEQ])
    df = df.withColumn("_amount_text", tx_amount_text("amount"))
    df = df.withColumns({"_value": F.abs(try_number(F.col("_amount_text"))),
                         "_amount": try_number(F.col("_amount_text"), TX_AMOUNT_PARSE)})
    enough = F.col("_value") >= F.lit(float(V.MIN_AMOUNT))
    df = df.where(F.col("id").isNull() | enough if without_id else enough)
    bad = lambda c, t: F.col(c).isNotNull() & try_integer_text(F.col(c), t).isNull()
    reason = (F.when(F.col("id").isNull(), "bad_id").when(F.col("_amount").isNull() | (F.round(F.abs(F.col("_amount")), 2) >= AMOUNT_LIMIT), "amount_overflow")
              .when(bad("merchant_id", "bigint"), "bad_merchant_id").when(bad("mcc", "int"), "bad_mcc"))
    return df.withColumn("_reason", reason)


def transaction_amounts(raw: DataFrame) -> DataFrame:
    """(id, amount): absolute amounts of the rows that pass the amount filter, before their cast."""
    needed = raw.select(*[c for c in (SEQ, "id", "amount", "merchant_id", "mcc") if c in raw.columns])
    return _staged_transactions(needed, True).select("id", F.round(F.abs(F.col("_amount")), 2).alias("amount"))


def rejected_transactions(raw: DataFrame) -> DataFrame:
    """(reason, id) of raw transactions that cannot be stored: no number as id,
    an amount beyond DECIMAL(10,2), a merchant or category code that is no
    whole number.  `id` is the raw text."""
    return reject_rows(stage_transactions(raw), "transactions_data").drop("table_name")


def clean_transactions(raw: DataFrame, dedup: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """Cleaned transactions, ids unique and never NULL; rows that cannot be
    stored are in `rejected_transactions`."""
    return stored_rows(_cleaned_transactions(_staged_transactions(raw, dedup).where("_reason is null"), carry))


def stage_transactions(raw: DataFrame, dedup: bool = True) -> DataFrame:
    """Cleaned transactions with `_reason` and (of rejected rows) `_raw_id`, rejected rows (also
    those without a number as id, whose other columns are NULL) included: written
    once, it yields the cleaned table and its rejects from one pass over the feed."""
    staged = _cleaned_transactions(_staged_transactions(raw, dedup, without_id=True), ())
    with_id = F.col("id").isNotNull()
    raw_id = F.when(F.col("_reason").isNotNull(), F.coalesce(F.col("_raw_id"), F.col("id").cast("string")))
    return staged.select("id", *[F.when(with_id, F.col(c)).alias(c) for c in TRANSACTIONS_COLUMNS if c != "id"], "_reason", raw_id.alias("_raw_id"))


def _cleaned_transactions(df: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Cleaned columns of `_staged_transactions` rows, with `_reason` and `_raw_id`."""

    df = df.withColumns({
        "_ts": parse_timestamp(F.col("date")),
        "_use_chip": strip_ws(F.replace(F.col("use_chip"), F.lit(V.CHANNEL_SUFFIX), F.lit(""))),
        "_city": strip_ws(nullif_in(F.col("merchant_city"), V.CITY_NULLS)),
    })
    ts, use_chip, city = F.col("_ts"), F.col("_use_chip"), F.col("_city")
    df = df.withColumn("_online", F.coalesce(F.lower(use_chip) == V.ONLINE_TEXT, F.lit(False))
                       | F.coalesce(F.lower(city) == V.ONLINE_TEXT, F.lit(False)))
    online = F.col("_online")
    zip_code = strip_ws(F.replace(nullif_in(F.col("zip"), V.ZIP_NULLS), F.lit(".0"), F.lit("")))
    errors = F.when(F.lower(F.col("errors")) != "nan", F.col("errors"))

    df = df.select(
        F.col("id"),
        ts.alias("date"),
        F.col("client_id").cast("long").alias("client_id"),
        F.col("card_id").cast("long").alias("card_id"),
        F.round(F.abs(F.col("_amount")), 2).try_cast("decimal(10,2)").alias("amount"),
        F.when(F.col("_amount") < 0, F.round(-F.col("_amount"), 2)).try_cast("decimal(10,2)").alias("refund_amount"),
        use_chip.alias("use_chip"),
        try_integer_text(F.col("merchant_id"), "bigint").alias("merchant_id"),
        F.when(online, F.lit(V.ONLINE_CITY)).otherwise(city).alias("merchant_city"),
        F.when(online, _null()).otherwise(_tx_state(F.col("merchant_state"))).alias("merchant_state"),
        F.when(online, _null()).otherwise(zip_code).alias("zip"),
        try_integer_text(F.col("mcc")).alias("mcc"),
        errors.alias("errors"),
        (F.col("_amount") < 0).alias("is_refund"),
        online.alias("is_online"),
        F.year(ts).alias("transaction_year"),
        F.month(ts).alias("transaction_month"),
        F.quarter(ts).alias("transaction_quarter"),
        F.hour(ts).alias("transaction_hour"),
        day_name(ts).alias("day_of_week"),
        "_reason", "_raw_id",
        *_carried(carry),
    )
    return df.select(*TRANSACTIONS_COLUMNS, "_reason", "_raw_id", *_carried_names(carry))
