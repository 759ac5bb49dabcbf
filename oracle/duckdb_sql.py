"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly in DuckDB SQL over the driver's views, by a different route
than the Spark code where one exists: windows (ROW_NUMBER) instead of
aggregate keep-first, a global ROW_NUMBER for surrogate keys, integer-cent
arithmetic for every rounded average or percentage, and for fuzzy spelling
fixes the labels the test fixture was built to mean.

Output convention shared with `comparable()` on the Spark side: integers as
BIGINT, exact and approximate numbers as DOUBLE, dates as 'YYYY-MM-DD' text,
timestamps as 'YYYY-MM-DD HH:MM:SS' text.
"""

from __future__ import annotations

from cardlake.functions import fixed_values as V
from cardlake.sources.fixtures import oracle_raw_sql

AS_OF_YEAR, AS_OF_MONTH = 2025, 6  # matches the registered as-of date 2025-06-15


# ------------------------------------------------------------------ expression helpers
def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# whitespace as code points, the way Python's isspace lists them
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(x: str) -> str:
    return f"trim({x}, {q(SPACES)})"


def squeeze(x: str) -> str:
    return f"regexp_replace({x}, '[{SPACES}]+', ' ', 'g')"


def collapse(x: str) -> str:
    return squeeze(strip(x))


def title(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform("
            f"regexp_extract_all({x}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), "
            f"lambda w: upper(left(w, 1)) || lower(substr(w, 2))), '') END")


NUM_RX = "[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?"
INT_RX = "[+-]?\\d+"


def num(x: str, t: str = "DOUBLE") -> str:
    return f"CASE WHEN regexp_full_match({strip(x)}, '{NUM_RX}') THEN TRY_CAST({strip(x)} AS {t}) END"


def int_text(x: str) -> str:
    return f"CASE WHEN regexp_full_match({strip(x)}, '{INT_RX}') THEN TRY_CAST({strip(x)} AS BIGINT) END"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def case_map(key: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {key} = {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def rhu(num_int: str, den_int: str) -> str:
    """round(num/den) half away from zero, integers (HUGEINT), NULL if den = 0."""
    n, d = f"CAST({num_int} AS HUGEINT)", f"CAST({den_int} AS HUGEINT)"
    return (f"CASE WHEN {d} = 0 OR {d} IS NULL THEN NULL "
            f"ELSE sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})) END")


def cents(x: str) -> str:
    return f"CAST(round(({x}) * 100) AS HUGEINT)"


def avg2(sum_expr: str, count_expr: str) -> str:
    """2-decimal average from a decimal sum and a count, as DOUBLE."""
    return f"CAST({rhu(cents(sum_expr), count_expr)} AS DOUBLE) / 100"


def pct2(num_expr: str, den_expr: str) -> str:
    """round(100 * num / den, 2) for exact (cent) amounts or counts."""
    return f"CAST({rhu(f'10000 * {num_expr}', den_expr)} AS DOUBLE) / 100"


def d2s(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


# ------------------------------------------------------------------ layers (CTEs)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTES[name] = (deps, sql)


for _raw, _name in (("users_data", "raw_users"), ("cards_data", "raw_cards"),
                    ("mcc_data", "raw_mcc"), ("transactions_data", "raw_tx")):
    cte(_name, (), oracle_raw_sql(_raw))

# fuzzy spelling fixes: what the fixture's misspellings mean
FIXTURE_FUZZY = {
    "unemployedd": "Unemployed",
    "studentt": "Student",
    "doctorat": "Doctorate",
    "high schol": "High School",
}


def _label(col: str, aliases: dict, canonical: list) -> str:
    e = collapse(col)
    k = f"lower({e})"
    canon = {c.lower(): c for c in canonical}
    fuzzy = {k2: v for k2, v in FIXTURE_FUZZY.items() if v in canonical}
    return (f"CASE WHEN {col} IS NULL OR {e} = '' THEN NULL "
            f"ELSE coalesce({case_map(k, aliases)}, {case_map(k, canon)}, {case_map(k, fuzzy)}, {title(e)}) END")


def _user_money(col: str) -> str:
    s = strip(f"regexp_replace({strip(col)}, '^\"+|\"+$', '', 'g')")
    b = strip(f"replace(replace({s}, '$', ''), ',', '')")
    return (f"CASE WHEN {s} IS NULL OR {s} = '' THEN NULL "
            f"WHEN lower({s}) = 'ten thousand' THEN 10000.0 "
            f"WHEN lower({s}) IN {in_list(V.MONEY_TEXT_ERRORS)} THEN NULL "
            f"WHEN lower({b}) LIKE '%k' THEN abs({num(f'left({b}, length({b}) - 1)')} * 1000) "
            f"ELSE abs({num(b)}) END")


def _bounded(col: str, lo, hi) -> str:
    return f"CASE WHEN {col} BETWEEN {lo} AND {hi} THEN {col} END"


cte("users_staged", ("raw_users",), f"""
SELECT id, current_age, retirement_age, birth_year, birth_month, gender, address, latitude, longitude,
       per_capita_income,
       CASE WHEN yearly_income_raw < 100 THEN 0 ELSE TRY_CAST(round(yearly_income_raw) AS BIGINT) END AS yearly_income,
       total_debt, credit_score, num_credit_cards, employment_status, education_level, overflow
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY _seq) AS rn FROM (
    SELECT _seq, CAST(id AS BIGINT) AS id,
      CASE WHEN b_year IS NOT NULL AND b_month IS NOT NULL
                AND {AS_OF_YEAR} - b_year - CASE WHEN {AS_OF_MONTH} < b_month THEN 1 ELSE 0 END BETWEEN 0 AND 120
           THEN {AS_OF_YEAR} - b_year - CASE WHEN {AS_OF_MONTH} < b_month THEN 1 ELSE 0 END END AS current_age,
      {_bounded('retirement_age', 0, 120)} AS retirement_age,
      b_year AS birth_year, b_month AS birth_month,
      CASE WHEN g IS NULL OR g = '' OR g IN {in_list(V.GENDER_NULLS)} THEN NULL
           WHEN g IN ('m', 'male') THEN 'Male' WHEN g IN ('f', 'female') THEN 'Female'
           ELSE upper(left(g, 1)) || lower(substr(g, 2)) END AS gender,
      CASE WHEN {collapse('address')} = '' THEN NULL ELSE {title(collapse('address'))} END AS address,
      {_bounded('latitude', -90, 90)} AS latitude,
      {_bounded('longitude', -180, 180)} AS longitude,
      TRY_CAST(round({_user_money('per_capita_income')}) AS BIGINT) AS per_capita_income,
      coalesce(greatest({_user_money('per_capita_income')}, {_user_money('yearly_income')}, {_user_money('total_debt')}) >= 9223372036854775808, false) AS overflow,
      {_user_money('yearly_income')} AS yearly_income_raw,
      TRY_CAST(round({_user_money('total_debt')}) AS BIGINT) AS total_debt,
      {_bounded('credit_score', 300, 850)} AS credit_score,
      CASE WHEN num_credit_cards >= 0 THEN num_credit_cards END AS num_credit_cards,
      {_label('employment_status', V.EMPLOYMENT_ALIASES, V.EMPLOYMENT_CANONICAL)} AS employment_status,
      {_label('education_level', V.EDUCATION_ALIASES, V.EDUCATION_CANONICAL)} AS education_level
    FROM (SELECT *, {_bounded('birth_year', 1900, 2025)} AS b_year, {_bounded('birth_month', 1, 12)} AS b_month,
                 lower({collapse('gender')}) AS g FROM raw_users)
  )
) WHERE rn = 1
""")

cte("t_users", ("users_staged",), "SELECT * EXCLUDE (overflow) FROM users_staged WHERE NOT overflow")


def _month_year(col: str) -> str:
    s = strip(col)
    months = "['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec']"
    mon_rx = "[A-Za-z]{3}-\\d{2,4}"
    ytxt = f"regexp_extract({s}, '-(\\d+)$', 1)"
    year = f"CASE WHEN TRY_CAST({ytxt} AS INT) < 100 THEN 2000 + CAST({ytxt} AS INT) WHEN length({ytxt}) = 4 THEN CAST({ytxt} AS INT) END"
    mno = f"list_position({months}, lower(left({s}, 3)))"
    named = (f"CASE WHEN regexp_full_match({s}, '{mon_rx}') AND {mno} IS NOT NULL AND {year} IS NOT NULL "
             f"THEN make_date({year}, {mno}, 1) END")
    sep = f"regexp_replace({s}, '^(?i)sept ', 'Sep ')"
    general = ", ".join(f"CAST(try_strptime({sep}, '{f}') AS DATE)"
                        for f in ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m", "%m/%Y", "%m/%d/%Y", "%d/%m/%Y",
                                  "%Y/%m/%d", "%Y%m%d", "%B %d, %Y", "%b %Y", "%B %Y"))
    return (f"CASE WHEN {col} IS NULL OR lower({s}) IN {in_list(V.MONTH_YEAR_NULLS)} THEN NULL "
            f"WHEN year(coalesce({named}, {general})) NOT BETWEEN 1678 AND 2261 THEN NULL "
            f"ELSE strftime(coalesce({named}, {general}), '%Y-%m') END")


def _txt(col: str) -> str:
    return f"coalesce(CAST({col} AS VARCHAR), 'None')"


def _card_money(col: str) -> str:
    s = strip(f"lower({col})")
    t = strip(f"replace(replace(replace(replace({s}, '(', '-'), ')', ''), '$', ''), ',', '')")
    v = (f"abs(CASE WHEN {t} LIKE '%k' THEN {num(strip(f'left({t}, length({t}) - 1)'))} * 1000.0 "
         f"ELSE {num(t)} END)")
    return (f"CASE WHEN {col} IS NULL OR {strip(col)} = '' THEN NULL "
            f"WHEN {s} IN {in_list(V.CARD_TEXT_MONEY)} THEN {case_map(s, {k: str(v) for k, v in V.CARD_TEXT_MONEY.items()})}::DOUBLE "
            f"WHEN {s} IN {in_list(V.MONEY_TEXT_ERRORS)} THEN NULL "
            f"WHEN {v} > {V.CARD_MONEY_MAX} THEN NULL ELSE {v} END")


def _ws_key(col: str) -> str:
    return squeeze(f"lower({strip(_txt(col))})")


def _key(col: str) -> str:
    return f"lower({strip(_txt(col))})"


cte("t_cards", ("raw_cards",), f"""
SELECT id, CAST(client_id AS BIGINT) AS client_id,
  coalesce({case_map(_ws_key('card_brand'), V.BRAND_MAPPING)}, 'Other') AS card_brand,
  coalesce({case_map(_ws_key('card_type'), V.TYPE_MAPPING)}, 'Other') AS card_type,
  CASE WHEN card_number IS NULL THEN NULL
       WHEN {num('card_number')} IS NOT NULL THEN CAST(CAST(trunc({num('card_number')}) AS HUGEINT) AS VARCHAR)
       ELSE {strip('card_number')} END AS card_number,
  {_month_year('expires')} AS expires,
  {_bounded('cvv', 100, 999)} AS cvv,
  {case_map(_key('has_chip'), V.YES_NO_MAP)} AS has_chip,
  num_cards_issued,
  {_card_money('credit_limit')} AS credit_limit,
  {_month_year('acct_open_date')} AS acct_open_date,
  year_pin_last_changed,
  {case_map(_key('card_on_dark_web'), V.YES_NO_MAP)} AS card_on_dark_web,
  coalesce({case_map(f"lower({strip(_txt('issuer_bank_name'))})", V.BANK_NAME_MAPPING)}, {title(strip(_txt('issuer_bank_name')))}) AS issuer_bank_name,
  CASE WHEN issuer_bank_state IS NULL THEN NULL
       ELSE coalesce({case_map(f"lower({strip('issuer_bank_state')})", V.BANK_STATE_MAP)},
                     CASE WHEN regexp_full_match(upper(left({strip('issuer_bank_state')}, 2)), '\\p{{L}}+')
                          THEN upper(left({strip('issuer_bank_state')}, 2)) END) END AS issuer_bank_state,
  coalesce({case_map(_key('issuer_bank_type'), V.BANK_TYPE_MAPPING)}, 'Other') AS issuer_bank_type,
  coalesce({case_map(_key('issuer_risk_rating'), V.RISK_RATING_MAPPING)}, 'Medium') AS issuer_risk_rating
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY _seq) AS rn FROM raw_cards) WHERE rn = 1
""")


def _mcc_code() -> str:
    s = strip("code")
    p = f"CASE WHEN upper({s}) LIKE 'MCC%' THEN {strip(f'substr({s}, 4)')} ELSE {s} END"
    u = f"regexp_replace(regexp_replace({p}, '^\"+|\"+$', '', 'g'), '^''+|''+$', '', 'g')"
    return (f"CASE WHEN code IS NULL OR {s} IN ('', '\\N') THEN NULL "
            f"WHEN upper({u}) IN ('NOTE', 'COMMENT', 'NAN', '\\N') THEN NULL "
            f"WHEN trunc({num(u)}) < 0 OR trunc({num(u)}) > 2147483647 THEN NULL ELSE CAST(trunc({num(u)}) AS BIGINT) END")


def _mcc_txt(col: str) -> str:
    return f"CASE WHEN {col} IS NULL OR {strip(col)} IN ('', '\\N') THEN NULL ELSE {strip(col)} END"


cte("t_mcc", ("raw_mcc",), f"""
SELECT code, nullif(description, '') AS description, nullif(notes, '') AS notes, nullif(updated_by, '') AS updated_by
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY code ORDER BY _seq) AS rn FROM (
    SELECT _seq, {_mcc_code()} AS code,
      {title(squeeze(_mcc_txt('description')))} AS description,
      coalesce({case_map(f"lower({_mcc_txt('notes')})", V.NOTES_MAP)}, {_mcc_txt('notes')}) AS notes,
      {title(f"replace(replace({_mcc_txt('updated_by')}, '_', ' '), '-', ' ')")} AS updated_by
    FROM raw_mcc)
  WHERE code IS NOT NULL
) WHERE rn = 1
""")

cte("tx_staged", ("raw_tx",), f"""
SELECT *, CASE WHEN a IS NULL OR round(abs(a), 2) >= 100000000 THEN 'amount_overflow'
               WHEN merchant_text IS NOT NULL AND merchant_id IS NULL THEN 'bad_merchant_id'
               WHEN mcc_text IS NOT NULL AND mcc IS NULL THEN 'bad_mcc' END AS reason
FROM (
  SELECT *, coalesce(lower(uc) = 'online', false) OR coalesce(lower(city) = 'online', false) AS online
  FROM (
    SELECT raw_id, id_n AS id, client_id, card_id, amount AS raw_amount, date AS raw_date, use_chip AS raw_use_chip,
      merchant_city AS raw_merchant_city, merchant_state AS raw_merchant_state, zip AS raw_zip,
      {num("replace(replace(amount, '$', ''), ',', '')")} AS v,
      {num("replace(replace(amount, '$', ''), ',', '')", 'DECIMAL(38,18)')} AS a,
      try_strptime(date, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d']) AS ts,
      {strip("replace(use_chip, ' Transaction', '')")} AS uc,
      {strip(f"CASE WHEN merchant_city IN {in_list(V.CITY_NULLS)} THEN NULL ELSE merchant_city END")} AS city,
      merchant_id AS merchant_text, {int_text('merchant_id')} AS merchant_id, merchant_state, zip,
      mcc AS mcc_text, CASE WHEN {int_text('mcc')} BETWEEN -2147483648 AND 2147483647 THEN {int_text('mcc')} END AS mcc, errors
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_n ORDER BY _seq) AS rn
          FROM (SELECT *, id AS raw_id, {int_text('id')} AS id_n FROM raw_tx) WHERE id_n IS NOT NULL) WHERE rn = 1
  ) WHERE abs(v) >= 0.01
)
""")

cte("t_tx", ("tx_staged",), f"""
SELECT id, ts AS date, client_id, card_id,
  CAST(round(abs(a), 2) AS DECIMAL(10,2)) AS amount,
  CASE WHEN a < 0 THEN CAST(round(-a, 2) AS DECIMAL(10,2)) END AS refund_amount,
  uc AS use_chip, merchant_id,
  CASE WHEN online THEN 'Online' ELSE city END AS merchant_city,
  CASE WHEN online THEN NULL
       WHEN upper({strip('merchant_state')}) IN {in_list(V.VALID_US_STATES)} THEN upper({strip('merchant_state')})
       ELSE {case_map(f"lower({strip('merchant_state')})", V.STATE_NAME_MAP)} END AS merchant_state,
  CASE WHEN online OR zip IS NULL OR zip IN {in_list(V.ZIP_NULLS)} THEN NULL ELSE {strip("replace(zip, '.0', '')")} END AS zip,
  mcc, CASE WHEN lower(errors) = 'nan' THEN NULL ELSE errors END AS errors,
  a < 0 AS is_refund, online AS is_online,
  year(ts) AS transaction_year, month(ts) AS transaction_month, quarter(ts) AS transaction_quarter,
  hour(ts) AS transaction_hour, dayname(ts) AS day_of_week
FROM tx_staged WHERE reason IS NULL
""")

cte("rejects", ("raw_tx", "tx_staged", "raw_mcc", "users_staged"), f"""
SELECT 'users_data' AS table_name, 'money_overflow' AS reason, CAST(id AS VARCHAR) AS id FROM users_staged WHERE overflow
UNION ALL
SELECT 'transactions_data' AS table_name, 'bad_id' AS reason, id FROM raw_tx WHERE id IS NULL OR {int_text('id')} IS NULL
UNION ALL
SELECT 'transactions_data', reason, raw_id FROM tx_staged WHERE reason IS NOT NULL
UNION ALL
SELECT 'mcc_data', 'code_overflow', code FROM raw_mcc WHERE regexp_full_match({strip('code')}, '(?i)(mcc)? *"?[0-9]{{10,}}"?')
""")

cte("dim_customers", ("t_users",), f"""
SELECT ROW_NUMBER() OVER (ORDER BY id) AS customer_key, id AS customer_id, {strip('gender')} AS gender,
  birth_year, birth_month, current_age, retirement_age, {strip('address')} AS address, latitude, longitude,
  per_capita_income, yearly_income, total_debt, credit_score, num_credit_cards,
  {strip('employment_status')} AS employment_status, {strip('education_level')} AS education_level
FROM t_users WHERE id IS NOT NULL
""")

cte("dim_cards", ("t_cards",), f"""
SELECT ROW_NUMBER() OVER (ORDER BY id) AS card_key, id AS card_id, client_id, card_brand, card_type,
  CASE WHEN length({strip("replace(card_number, ' ', '')")}) >= 4
       THEN '{V.CARD_MASK_PREFIX}' || right({strip("replace(card_number, ' ', '')")}, 4) END AS masked_card_number,
  expires, has_chip, num_cards_issued, credit_limit, acct_open_date, year_pin_last_changed, card_on_dark_web,
  issuer_bank_name, issuer_bank_state, issuer_bank_type, issuer_risk_rating
FROM t_cards WHERE id IS NOT NULL
""")

cte("dim_mcc", ("t_mcc",), """
SELECT ROW_NUMBER() OVER (ORDER BY code) AS mcc_key, code AS mcc_code, description, notes, updated_by FROM t_mcc
""")

cte("dim_merchants", ("t_tx",), f"""
SELECT ROW_NUMBER() OVER (ORDER BY merchant_id) AS merchant_key, merchant_id, merchant_city, merchant_state, zip
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY merchant_id ORDER BY cnt DESC, merchant_city ASC NULLS LAST,
                                 merchant_state ASC NULLS LAST, zip ASC NULLS LAST) AS rn
  FROM (SELECT merchant_id, {strip('merchant_city')} AS merchant_city, {strip('merchant_state')} AS merchant_state,
               {strip('zip')} AS zip, COUNT(*) AS cnt
        FROM t_tx WHERE merchant_id IS NOT NULL GROUP BY ALL)
) WHERE rn = 1
""")

cte("dim_date", ("t_tx",), """
SELECT ROW_NUMBER() OVER (ORDER BY d) AS date_key, d AS date, year(d) AS year, month(d) AS month, day(d) AS day,
  monthname(d) AS month_name, dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT DISTINCT CAST(date AS DATE) AS d FROM t_tx WHERE date IS NOT NULL)
""")

cte("fact", ("t_tx", "dim_customers", "dim_cards", "dim_merchants", "dim_mcc", "dim_date"), f"""
SELECT t.id AS transaction_id, dd.date_key, dc.customer_key, dk.card_key, dm.merchant_key, mc.mcc_key,
  CAST(t.amount AS DECIMAL(12,2)) AS amount, {strip('t.use_chip')} AS use_chip, {strip('t.errors')} AS errors,
  CASE WHEN t.is_refund THEN 'Yes' ELSE 'No' END AS is_refund,
  CASE WHEN t.errors IS NOT NULL THEN 'Yes' ELSE 'No' END AS has_error,
  CASE WHEN t.is_online THEN 'Yes' ELSE 'No' END AS is_online
FROM t_tx t
LEFT JOIN dim_customers dc ON t.client_id = dc.customer_id
LEFT JOIN dim_cards dk ON t.card_id = dk.card_id
LEFT JOIN dim_merchants dm ON t.merchant_id = dm.merchant_id
LEFT JOIN dim_mcc mc ON t.mcc = mc.mcc_code
LEFT JOIN dim_date dd ON CAST(t.date AS DATE) = dd.date
WHERE t.id IS NOT NULL
""")


def _channel(name: str, online_sources) -> None:
    cte(name, ("fact",), f"""
SELECT ROW_NUMBER() OVER (ORDER BY src) AS channel_key, src AS source_use_chip,
  CASE WHEN src IN {in_list(online_sources)} THEN 'Online' WHEN src = '{V.UNKNOWN_CHANNEL}' THEN 'Unknown'
       ELSE 'In-Store' END AS channel_group
FROM (SELECT DISTINCT coalesce(use_chip, '{V.UNKNOWN_CHANNEL}') AS src FROM fact)
""")


_channel("dim_channel", V.ONLINE_CHANNEL_SOURCES)
_channel("dim_channel_online", ("Online",))


def _ff(name: str, channel: str, amount: str) -> None:
    cte(name, ("fact", channel), f"""
SELECT f.transaction_id, f.date_key, f.merchant_key, f.mcc_key, ch.channel_key,
  CASE WHEN {amount} > 0 THEN {amount} ELSE 0 END AS gross_revenue,
  CASE WHEN {amount} < 0 THEN -{amount} ELSE 0 END AS refund_amount,
  {amount} AS net_amount, 1 AS transaction_count,
  CASE WHEN {amount} < 0 THEN 1 ELSE 0 END AS refund_flag,
  CASE WHEN f.errors IS NOT NULL AND f.errors <> '' AND f.errors <> '{V.NO_ERROR_TEXT}' THEN 1 ELSE 0 END AS error_flag
FROM fact f JOIN {channel} ch ON coalesce(f.use_chip, '{V.UNKNOWN_CHANNEL}') = ch.source_use_chip
""")


_ff("ff", "dim_channel", "f.amount")
_ff("ff_signed", "dim_channel", "CASE WHEN f.is_refund = 'Yes' THEN -f.amount ELSE f.amount END")


def _fct(name: str, channel: str) -> None:
    cte(name, ("fact", channel), f"""
SELECT f.transaction_id, f.customer_key, f.date_key, f.card_key, ch.channel_key, f.amount,
  CASE WHEN f.amount > 0 THEN 1 ELSE 0 END AS positive_transaction_flag,
  CASE WHEN f.errors IS NOT NULL THEN 1 ELSE 0 END AS error_transaction_flag, f.errors
FROM fact f JOIN {channel} ch ON coalesce(f.use_chip, '{V.UNKNOWN_CHANNEL}') = ch.source_use_chip
""")


_fct("fct", "dim_channel")
_fct("fct_online", "dim_channel_online")

cte("cust_stats", ("fct",), """
SELECT customer_key, SUM(amount) AS s, COUNT(*) AS n, stddev_samp(amount) AS sd
FROM fct WHERE amount > 0 GROUP BY customer_key
""")

cte("suspicious", ("fct", "cust_stats", "dim_customers", "dim_date", "dim_channel"), f"""
SELECT f.transaction_id, dc.customer_key, dc.customer_id, dd.date AS transaction_date, ch.channel_group, f.amount,
  cs.s, cs.n, cs.sd, f.errors,
  CASE WHEN f.errors IS NOT NULL THEN '{V.REASON_ERROR}'
       WHEN cs.n >= 2 AND cs.sd IS NOT NULL AND f.amount > cs.s / cs.n + 3 * cs.sd THEN '{V.REASON_OUTLIER}'
       ELSE '{V.REASON_NONE}' END AS suspicion_reason
FROM fct f
JOIN cust_stats cs ON f.customer_key = cs.customer_key
JOIN dim_customers dc ON f.customer_key = dc.customer_key
JOIN dim_date dd ON f.date_key = dd.date_key
JOIN dim_channel ch ON f.channel_key = ch.channel_key
WHERE f.errors IS NOT NULL OR (cs.n >= 2 AND cs.sd IS NOT NULL AND f.amount > cs.s / cs.n + 3 * cs.sd)
""")


# two overlapping raw chunks, each cleaned on its own (insert-if-absent)
cte("raw_tx_a", ("raw_tx",), "SELECT * FROM raw_tx WHERE date < '1999-01-01'")
cte("raw_tx_b", ("raw_tx",), "SELECT * FROM raw_tx WHERE date >= '1998-07-01' OR date IS NULL")
for _c in ("a", "b"):
    assert CTES["tx_staged"][1].count("FROM raw_tx)") == 1
    cte(f"tx_staged_{_c}", (f"raw_tx_{_c}",), CTES["tx_staged"][1].replace("FROM raw_tx)", f"FROM raw_tx_{_c})"))
    cte(f"t_tx_{_c}", (f"tx_staged_{_c}",), CTES["t_tx"][1].replace("FROM tx_staged", f"FROM tx_staged_{_c}"))


def with_ctes(body: str, *needed: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    parts = ",\n".join(f"{n} AS (\n{CTES[n][1].strip()}\n)" for n in order)
    return f"WITH {parts}\n{body.strip()}"


# ------------------------------------------------------------------ queries
def _revenue_cols(amount_src: str = "f") -> str:
    return f"""
  CAST(SUM({amount_src}.gross_revenue) AS DOUBLE) AS gross_revenue,
  CAST(SUM({amount_src}.refund_amount) AS DOUBLE) AS refund_amount,
  CAST(SUM({amount_src}.net_amount) AS DOUBLE) AS net_revenue,
  CAST(SUM({amount_src}.transaction_count) AS BIGINT) AS transaction_count,
  {avg2(f'SUM(CASE WHEN {amount_src}.gross_revenue > 0 THEN {amount_src}.gross_revenue END)',
        f'COUNT(CASE WHEN {amount_src}.gross_revenue > 0 THEN 1 END)')} AS avg_transaction"""


def _refund_summary(ff: str) -> str:
    return with_ctes(f"""
SELECT CAST(d.year AS BIGINT) AS year, CAST(d.month AS BIGINT) AS month, d.month_name,
  CAST(SUM(f.transaction_count) AS BIGINT) AS total_transactions,
  CAST(SUM(f.refund_flag) AS BIGINT) AS refund_count,
  CAST(SUM(f.refund_amount) AS DOUBLE) AS refund_amount,
  {pct2('SUM(f.refund_flag)', 'SUM(f.transaction_count)')} AS refund_pct_by_count,
  {pct2(cents('SUM(f.refund_amount)'), cents('SUM(f.gross_revenue)'))} AS refund_pct_by_amount
FROM {ff} f JOIN dim_date d ON f.date_key = d.date_key
GROUP BY d.year, d.month, d.month_name
""", ff, "dim_date")


def _channel_behavior(fct: str, channel: str) -> str:
    on = "ch.channel_group = 'Online' AND f.amount > 0"
    st = "ch.channel_group = 'In-Store' AND f.amount > 0"
    return with_ctes(f"""
SELECT CAST(dc.customer_key AS BIGINT) AS customer_key, CAST(dc.customer_id AS BIGINT) AS customer_id,
  CAST(SUM(CASE WHEN {on} THEN f.amount ELSE 0 END) AS DOUBLE) AS online_spend,
  CAST(COUNT(*) FILTER (WHERE {on}) AS BIGINT) AS online_transaction_count,
  CAST(SUM(CASE WHEN {st} THEN f.amount ELSE 0 END) AS DOUBLE) AS instore_spend,
  CAST(COUNT(*) FILTER (WHERE {st}) AS BIGINT) AS instore_transaction_count,
  CASE WHEN COUNT(*) FILTER (WHERE {on}) > COUNT(*) FILTER (WHERE {st}) THEN 'Online'
       WHEN COUNT(*) FILTER (WHERE {on}) < COUNT(*) FILTER (WHERE {st}) THEN 'In-Store'
       ELSE 'Balanced' END AS preferred_channel
FROM {fct} f JOIN dim_customers dc ON f.customer_key = dc.customer_key
JOIN {channel} ch ON f.channel_key = ch.channel_key
GROUP BY dc.customer_key, dc.customer_id
""", fct, channel, "dim_customers")


TX_OUT = """
SELECT CAST(id AS BIGINT) AS id, strftime(date, '%Y-%m-%d %H:%M:%S') AS date,
  CAST(client_id AS BIGINT) AS client_id, CAST(card_id AS BIGINT) AS card_id,
  CAST(amount AS DOUBLE) AS amount, CAST(refund_amount AS DOUBLE) AS refund_amount, use_chip,
  CAST(merchant_id AS BIGINT) AS merchant_id, merchant_city, merchant_state, zip, CAST(mcc AS BIGINT) AS mcc,
  errors, is_refund, is_online,
  CAST(transaction_year AS BIGINT) AS transaction_year, CAST(transaction_month AS BIGINT) AS transaction_month,
  CAST(transaction_quarter AS BIGINT) AS transaction_quarter, CAST(transaction_hour AS BIGINT) AS transaction_hour,
  day_of_week
FROM {src}"""

RAW_CTE = {"users_data": "raw_users", "cards_data": "raw_cards", "mcc_data": "raw_mcc",
           "transactions_data": "raw_tx"}
CLEAN_CTE = {"users_data": "t_users", "cards_data": "t_cards", "transactions_data": "t_tx"}

# output types of cleaned columns (output convention); absent = text as is
CLEAN_TYPES = {
    "per_capita_income": "BIGINT", "yearly_income": "BIGINT", "total_debt": "BIGINT", "current_age": "BIGINT",
    "birth_month": "BIGINT", "birth_year": "BIGINT", "retirement_age": "BIGINT", "credit_score": "BIGINT",
    "num_credit_cards": "BIGINT", "latitude": "DOUBLE", "longitude": "DOUBLE",
    "credit_limit": "DOUBLE", "cvv": "BIGINT",
    "amount": "DOUBLE", "refund_amount": "DOUBLE", "transaction_year": "BIGINT", "transaction_month": "BIGINT",
    "transaction_quarter": "BIGINT", "transaction_hour": "BIGINT",
}


def _typed(alias: str, col: str, sql_type: str | None, out: str) -> str:
    if sql_type is None:
        return f"{alias}.{col} AS {out}"
    return f"CAST({alias}.{col} AS {sql_type}) AS {out}"


def _raw_type(table: str, col: str) -> str | None:
    from pyspark.sql import types as T

    from cardlake.sources.csv_io import RAW_SCHEMAS
    t = RAW_SCHEMAS[table][col].dataType
    if isinstance(t, (T.IntegerType, T.LongType)):
        return "BIGINT"
    if isinstance(t, T.DoubleType):
        return "DOUBLE"
    return None


def raw_columns(table: str, alias: str = "r") -> str:
    from cardlake.sources.csv_io import RAW_SCHEMAS
    cols = ["CAST(_seq AS BIGINT) AS _seq"]
    cols += [_typed(alias, f.name, _raw_type(table, f.name), f.name) for f in RAW_SCHEMAS[table].fields]
    return ", ".join(c.replace("CAST(_seq", f"CAST({alias}._seq") for c in cols)


def keep_first_raw(table: str) -> str:
    return f"(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY _seq) AS rn FROM {RAW_CTE[table]}) WHERE rn = 1)"


def clean_map(table: str, raw_cols: tuple, clean_cols: tuple) -> str:
    """Raw spelling -> cleaned value(s), rows: first raw arrival per id joined
    to the cleaned row with that id."""
    if table == "transactions_data":
        first = (f"(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {int_text('id')} ORDER BY _seq) AS rn "
                 f"FROM raw_tx WHERE {int_text('id')} IS NOT NULL) WHERE rn = 1)")
        raw_id = int_text("r.id")
    else:
        first, raw_id = keep_first_raw(table), "r.id"
    sel = [_typed("r", c, _raw_type(table, c), f"raw_{c}") for c in raw_cols]
    for c in clean_cols:
        if c == "date":
            sel.append("strftime(t.date, '%Y-%m-%d %H:%M:%S') AS date")
        else:
            sel.append(_typed("t", c, CLEAN_TYPES.get(c), c))
    return with_ctes(f"""
SELECT {", ".join(sel)}, CAST(COUNT(*) AS BIGINT) AS rows
FROM {first} r JOIN {CLEAN_CTE[table]} t ON CAST({raw_id} AS BIGINT) = t.id
GROUP BY ALL""", RAW_CTE[table], CLEAN_CTE[table])


def queries() -> dict[str, str]:
    out: dict[str, str] = {}

    out["clean_users"] = with_ctes("""
SELECT CAST(id AS BIGINT) AS id, CAST(current_age AS BIGINT) AS current_age, CAST(retirement_age AS BIGINT) AS retirement_age,
  CAST(birth_year AS BIGINT) AS birth_year, CAST(birth_month AS BIGINT) AS birth_month, gender, address,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
  CAST(per_capita_income AS BIGINT) AS per_capita_income, CAST(yearly_income AS BIGINT) AS yearly_income,
  CAST(total_debt AS BIGINT) AS total_debt, CAST(credit_score AS BIGINT) AS credit_score,
  CAST(num_credit_cards AS BIGINT) AS num_credit_cards, employment_status, education_level
FROM t_users""", "t_users")

    out["clean_cards"] = with_ctes("""
SELECT CAST(id AS BIGINT) AS id, CAST(client_id AS BIGINT) AS client_id, card_brand, card_type, card_number, expires,
  CAST(cvv AS BIGINT) AS cvv, has_chip, CAST(num_cards_issued AS BIGINT) AS num_cards_issued,
  CAST(credit_limit AS DOUBLE) AS credit_limit, acct_open_date,
  CAST(year_pin_last_changed AS BIGINT) AS year_pin_last_changed, card_on_dark_web, issuer_bank_name,
  issuer_bank_state, issuer_bank_type, issuer_risk_rating
FROM t_cards""", "t_cards")

    out["clean_mcc"] = with_ctes("""
SELECT CAST(code AS BIGINT) AS code, description, notes, updated_by FROM t_mcc""", "t_mcc")

    out["clean_transactions"] = with_ctes(TX_OUT.format(src="t_tx"), "t_tx")

    out["dim_customers"] = with_ctes("""
SELECT CAST(customer_key AS BIGINT) AS customer_key, CAST(customer_id AS BIGINT) AS customer_id, gender,
  CAST(birth_year AS BIGINT) AS birth_year, CAST(birth_month AS BIGINT) AS birth_month,
  CAST(current_age AS BIGINT) AS current_age, CAST(retirement_age AS BIGINT) AS retirement_age, address,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
  CAST(per_capita_income AS BIGINT) AS per_capita_income, CAST(yearly_income AS BIGINT) AS yearly_income,
  CAST(total_debt AS BIGINT) AS total_debt, CAST(credit_score AS BIGINT) AS credit_score,
  CAST(num_credit_cards AS BIGINT) AS num_credit_cards, employment_status, education_level
FROM dim_customers""", "dim_customers")

    out["dim_cards"] = with_ctes("""
SELECT CAST(card_key AS BIGINT) AS card_key, CAST(card_id AS BIGINT) AS card_id, CAST(client_id AS BIGINT) AS client_id,
  card_brand, card_type, masked_card_number, expires, has_chip, CAST(num_cards_issued AS BIGINT) AS num_cards_issued,
  CAST(credit_limit AS DOUBLE) AS credit_limit, acct_open_date, CAST(year_pin_last_changed AS BIGINT) AS year_pin_last_changed,
  card_on_dark_web, issuer_bank_name, issuer_bank_state, issuer_bank_type, issuer_risk_rating
FROM dim_cards""", "dim_cards")

    out["dim_mcc"] = with_ctes("""
SELECT CAST(mcc_key AS BIGINT) AS mcc_key, CAST(mcc_code AS BIGINT) AS mcc_code, description, notes, updated_by
FROM dim_mcc""", "dim_mcc")

    out["dim_merchants"] = with_ctes("""
SELECT CAST(merchant_key AS BIGINT) AS merchant_key, CAST(merchant_id AS BIGINT) AS merchant_id,
  merchant_city, merchant_state, zip FROM dim_merchants""", "dim_merchants")

    out["dim_date"] = with_ctes(f"""
SELECT CAST(date_key AS BIGINT) AS date_key, {d2s('date')} AS date, CAST(year AS BIGINT) AS year,
  CAST(month AS BIGINT) AS month, CAST(day AS BIGINT) AS day, month_name, day_name, is_weekend
FROM dim_date""", "dim_date")

    out["fact_transactions"] = with_ctes("""
SELECT CAST(transaction_id AS BIGINT) AS transaction_id, CAST(date_key AS BIGINT) AS date_key,
  CAST(customer_key AS BIGINT) AS customer_key, CAST(card_key AS BIGINT) AS card_key,
  CAST(merchant_key AS BIGINT) AS merchant_key, CAST(mcc_key AS BIGINT) AS mcc_key,
  CAST(amount AS DOUBLE) AS amount, use_chip, errors, is_refund, has_error, is_online
FROM fact""", "fact")

    out["fact_missing_keys"] = with_ctes("""
SELECT CAST(COUNT(*) AS BIGINT) AS fact_rows,
  CAST(COUNT(*) FILTER (WHERE customer_key IS NULL) AS BIGINT) AS missing_customer_key,
  CAST(COUNT(*) FILTER (WHERE card_key IS NULL) AS BIGINT) AS missing_card_key,
  CAST(COUNT(*) FILTER (WHERE merchant_key IS NULL) AS BIGINT) AS missing_merchant_key,
  CAST(COUNT(*) FILTER (WHERE mcc_key IS NULL) AS BIGINT) AS missing_mcc_key,
  CAST(COUNT(*) FILTER (WHERE date_key IS NULL) AS BIGINT) AS missing_date_key
FROM fact""", "fact")

    out["dim_channel"] = with_ctes("""
SELECT CAST(channel_key AS BIGINT) AS channel_key, source_use_chip, channel_group FROM dim_channel""", "dim_channel")

    out["fact_finance_transactions"] = with_ctes("""
SELECT CAST(transaction_id AS BIGINT) AS transaction_id, CAST(date_key AS BIGINT) AS date_key,
  CAST(merchant_key AS BIGINT) AS merchant_key, CAST(mcc_key AS BIGINT) AS mcc_key,
  CAST(channel_key AS BIGINT) AS channel_key, CAST(gross_revenue AS DOUBLE) AS gross_revenue,
  CAST(refund_amount AS DOUBLE) AS refund_amount, CAST(net_amount AS DOUBLE) AS net_amount,
  CAST(transaction_count AS BIGINT) AS transaction_count, CAST(refund_flag AS BIGINT) AS refund_flag,
  CAST(error_flag AS BIGINT) AS error_flag
FROM ff""", "ff")

    out["fact_customer_transactions"] = with_ctes("""
SELECT CAST(transaction_id AS BIGINT) AS transaction_id, CAST(customer_key AS BIGINT) AS customer_key,
  CAST(date_key AS BIGINT) AS date_key, CAST(card_key AS BIGINT) AS card_key,
  CAST(channel_key AS BIGINT) AS channel_key, CAST(amount AS DOUBLE) AS amount,
  CAST(1 AS BIGINT) AS transaction_count, CAST(positive_transaction_flag AS BIGINT) AS positive_transaction_flag,
  CAST(error_transaction_flag AS BIGINT) AS error_transaction_flag, errors
FROM fct""", "fct")

    gross_avg = avg2("SUM(CASE WHEN f.gross_revenue > 0 THEN f.gross_revenue END)",
                     "COUNT(CASE WHEN f.gross_revenue > 0 THEN 1 END)")
    out["finance_monthly_revenue"] = with_ctes(f"""
SELECT CAST(d.year AS BIGINT) AS year, CAST(d.month AS BIGINT) AS month, d.month_name,
  CAST(SUM(f.gross_revenue) AS DOUBLE) AS total_revenue,
  CAST(SUM(f.transaction_count) AS BIGINT) AS transaction_count,
  {gross_avg} AS avg_transaction
FROM ff f JOIN dim_date d ON f.date_key = d.date_key
GROUP BY d.year, d.month, d.month_name""", "ff", "dim_date")

    out["finance_refund_summary"] = _refund_summary("ff")
    out["finance_refund_summary_signed"] = _refund_summary("ff_signed")

    out["finance_revenue_by_state"] = with_ctes(f"""
SELECT coalesce(m.merchant_state, 'Unknown') AS merchant_state, {_revenue_cols()}
FROM ff f JOIN dim_merchants m ON f.merchant_key = m.merchant_key
GROUP BY coalesce(m.merchant_state, 'Unknown')""", "ff", "dim_merchants")

    out["finance_revenue_by_mcc"] = with_ctes(f"""
SELECT CAST(mc.mcc_code AS BIGINT) AS mcc_code, coalesce(mc.description, 'Unknown') AS description, {_revenue_cols()}
FROM ff f JOIN dim_mcc mc ON f.mcc_key = mc.mcc_key
GROUP BY mc.mcc_code, coalesce(mc.description, 'Unknown')""", "ff", "dim_mcc")

    out["finance_by_channel"] = with_ctes("""
SELECT ch.channel_group, ch.source_use_chip,
  CAST(SUM(f.gross_revenue) AS DOUBLE) AS gross_revenue, CAST(SUM(f.refund_amount) AS DOUBLE) AS refund_amount,
  CAST(SUM(f.net_amount) AS DOUBLE) AS net_revenue, CAST(SUM(f.transaction_count) AS BIGINT) AS transaction_count,
  CAST(SUM(f.error_flag) AS BIGINT) AS error_count
FROM ff f JOIN dim_channel ch ON f.channel_key = ch.channel_key
GROUP BY ch.channel_group, ch.source_use_chip""", "ff", "dim_channel")

    out["customer_ltv"] = with_ctes(f"""
SELECT CAST(dc.customer_key AS BIGINT) AS customer_key, CAST(dc.customer_id AS BIGINT) AS customer_id,
  CAST(SUM(CASE WHEN f.amount > 0 THEN f.amount ELSE 0 END) AS DOUBLE) AS total_spend,
  CAST(COUNT(*) FILTER (WHERE f.amount > 0) AS BIGINT) AS positive_transaction_count,
  {avg2('SUM(f.amount) FILTER (WHERE f.amount > 0)', 'COUNT(*) FILTER (WHERE f.amount > 0)')} AS avg_transaction_amount,
  {d2s('MIN(dd.date) FILTER (WHERE f.amount > 0)')} AS first_transaction_date,
  {d2s('MAX(dd.date) FILTER (WHERE f.amount > 0)')} AS last_transaction_date,
  CAST(date_diff('day', MIN(dd.date) FILTER (WHERE f.amount > 0), MAX(dd.date) FILTER (WHERE f.amount > 0)) AS BIGINT) AS lifespan_days
FROM fct f JOIN dim_customers dc ON f.customer_key = dc.customer_key
JOIN dim_date dd ON f.date_key = dd.date_key
GROUP BY dc.customer_key, dc.customer_id""", "fct", "dim_customers", "dim_date")

    out["customer_channel_behavior"] = _channel_behavior("fct", "dim_channel")
    out["customer_channel_behavior_online"] = _channel_behavior("fct_online", "dim_channel_online")

    out["customer_active_cards"] = with_ctes("""
SELECT CAST(dc.customer_key AS BIGINT) AS customer_key, CAST(dc.customer_id AS BIGINT) AS customer_id,
  CAST(COUNT(ac.card_key) AS BIGINT) AS active_card_count,
  CAST(SUM(k.credit_limit) AS DOUBLE) AS total_credit_limit,
  CAST(round(AVG(k.credit_limit), 2) AS DOUBLE) AS avg_credit_limit
FROM (SELECT DISTINCT customer_key, card_key FROM fct WHERE amount > 0) ac
JOIN dim_customers dc ON ac.customer_key = dc.customer_key
JOIN dim_cards k ON ac.card_key = k.card_key
GROUP BY dc.customer_key, dc.customer_id""", "fct", "dim_customers", "dim_cards")

    out["customer_spend_stats"] = with_ctes(f"""
SELECT CAST(customer_key AS BIGINT) AS customer_key,
  CAST({rhu(f"{cents('s')} * 100", 'n')} AS DOUBLE) / 10000 AS avg_spend,
  round(sd, 4) AS stddev_spend, CAST(n AS BIGINT) AS txn_count
FROM cust_stats WHERE customer_key IS NOT NULL""", "cust_stats")

    out["suspicious_transactions"] = with_ctes(f"""
SELECT CAST(transaction_id AS BIGINT) AS transaction_id, CAST(customer_key AS BIGINT) AS customer_key,
  CAST(customer_id AS BIGINT) AS customer_id, {d2s('transaction_date')} AS transaction_date, channel_group,
  CAST(amount AS DOUBLE) AS amount,
  CAST({rhu(f"{cents('s')} * 100", 'n')} AS DOUBLE) / 10000 AS customer_avg_spend,
  round(sd, 4) AS customer_stddev, errors, suspicion_reason
FROM suspicious""", "suspicious")

    out["customer_suspicion_profile"] = with_ctes(f"""
SELECT CAST(customer_key AS BIGINT) AS customer_key, CAST(customer_id AS BIGINT) AS customer_id,
  CAST(COUNT(*) AS BIGINT) AS suspicious_transaction_count,
  CAST(SUM(CASE WHEN suspicion_reason = '{V.REASON_ERROR}' THEN 1 ELSE 0 END) AS BIGINT) AS error_flag_count,
  CAST(SUM(CASE WHEN suspicion_reason = '{V.REASON_OUTLIER}' THEN 1 ELSE 0 END) AS BIGINT) AS amount_outlier_count,
  {d2s('MAX(transaction_date)')} AS last_suspicious_transaction_date
FROM suspicious GROUP BY customer_key, customer_id""", "suspicious")

    out["merchant_volume"] = with_ctes(f"""
SELECT CAST(dm.merchant_key AS BIGINT) AS merchant_key, CAST(dm.merchant_id AS BIGINT) AS merchant_id,
  dm.merchant_city, dm.merchant_state,
  CAST(SUM(f.amount) AS DOUBLE) AS total_revenue, CAST(COUNT(*) AS BIGINT) AS transaction_count,
  {avg2('SUM(f.amount)', 'COUNT(*)')} AS avg_transaction
FROM fact f JOIN dim_merchants dm ON f.merchant_key = dm.merchant_key
WHERE f.is_refund = 'No' AND f.amount > 0
GROUP BY dm.merchant_key, dm.merchant_id, dm.merchant_city, dm.merchant_state""", "fact", "dim_merchants")

    out["industry_growth_yoy"] = with_ctes(f"""
SELECT CAST(year AS BIGINT) AS year, CAST(mcc_code AS BIGINT) AS mcc_code, mcc_description,
  CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(prev AS DOUBLE) AS prev_year_revenue,
  CASE WHEN prev IS NOT NULL AND prev <> 0
       THEN CAST({rhu(f"{cents('total_revenue - prev')} * 10000", cents('prev'))} AS DOUBLE) / 100 END AS yoy_growth_pct
FROM (
  SELECT *, LAG(total_revenue) OVER (PARTITION BY mcc_code ORDER BY year) AS prev
  FROM (SELECT dd.year, m.mcc_code, m.description AS mcc_description, SUM(f.amount) AS total_revenue
        FROM fact f JOIN dim_date dd ON f.date_key = dd.date_key JOIN dim_mcc m ON f.mcc_key = m.mcc_key
        WHERE f.is_refund = 'No' AND f.amount > 0
        GROUP BY dd.year, m.mcc_code, m.description)
)""", "fact", "dim_date", "dim_mcc")

    out["merchant_error_rates"] = with_ctes(f"""
SELECT CAST(dm.merchant_key AS BIGINT) AS merchant_key, CAST(dm.merchant_id AS BIGINT) AS merchant_id,
  dm.merchant_city, dm.merchant_state, CAST(COUNT(*) AS BIGINT) AS total_transactions,
  CAST(SUM(CASE WHEN f.errors IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS error_transaction_count,
  {pct2('SUM(CASE WHEN f.errors IS NOT NULL THEN 1 ELSE 0 END)', 'COUNT(*)')} AS error_rate_pct
FROM fact f JOIN dim_merchants dm ON f.merchant_key = dm.merchant_key
GROUP BY dm.merchant_key, dm.merchant_id, dm.merchant_city, dm.merchant_state
HAVING COUNT(*) >= {V.ERROR_RATE_MIN_TRANSACTIONS}""", "fact", "dim_merchants")

    out["merchant_geo_revenue"] = with_ctes(f"""
SELECT coalesce(dm.merchant_state, 'Unknown') AS merchant_state,
  CAST(SUM(f.amount) AS DOUBLE) AS total_revenue, CAST(COUNT(*) AS BIGINT) AS transaction_count,
  CAST(COUNT(DISTINCT dm.merchant_id) AS BIGINT) AS merchant_count,
  {avg2('SUM(f.amount)', 'COUNT(DISTINCT dm.merchant_id)')} AS avg_revenue_per_merchant
FROM fact f JOIN dim_merchants dm ON f.merchant_key = dm.merchant_key
WHERE f.is_refund = 'No' AND f.amount > 0
GROUP BY coalesce(dm.merchant_state, 'Unknown')""", "fact", "dim_merchants")

    # ---------------------------------------------------------- sources / sinks / stream
    out["ingest_csv_roundtrip_users"] = with_ctes("""
SELECT CAST(_seq AS BIGINT) AS _seq, CAST(id AS BIGINT) AS id, CAST(current_age AS BIGINT) AS current_age,
  CAST(retirement_age AS BIGINT) AS retirement_age, CAST(birth_year AS BIGINT) AS birth_year,
  CAST(birth_month AS BIGINT) AS birth_month, gender, address, CAST(latitude AS DOUBLE) AS latitude,
  CAST(longitude AS DOUBLE) AS longitude, per_capita_income, yearly_income, total_debt,
  CAST(credit_score AS BIGINT) AS credit_score, CAST(num_credit_cards AS BIGINT) AS num_credit_cards,
  employment_status, education_level
FROM raw_users""", "raw_users")
    out["ingest_csv_roundtrip_transactions"] = with_ctes("""
SELECT CAST(_seq AS BIGINT) AS _seq, id, date, CAST(client_id AS BIGINT) AS client_id,
  CAST(card_id AS BIGINT) AS card_id, amount, use_chip, merchant_id, merchant_city, merchant_state, zip, mcc, errors
FROM raw_tx""", "raw_tx")
    for t, key in (("cards_data", "cards"), ("mcc_data", "mcc")):
        out[f"ingest_csv_roundtrip_{key}"] = with_ctes(f"SELECT {raw_columns(t)} FROM {RAW_CTE[t]} r", RAW_CTE[t])
    out["csv_null_marker_roundtrip"] = out["fact_transactions"]
    out["stream_tx_load"] = out["clean_transactions"]
    out["csv_empty_null_roundtrip"] = with_ctes(TX_OUT.format(src="""(
  SELECT * REPLACE (nullif(use_chip, '') AS use_chip, nullif(merchant_city, '') AS merchant_city,
                    nullif(merchant_state, '') AS merchant_state, nullif(zip, '') AS zip,
                    nullif(errors, '') AS errors, nullif(day_of_week, '') AS day_of_week)
  FROM t_tx)"""), "t_tx")

    # ---------------------------------------------------------- quality
    out["dedup_report"] = with_ctes(" UNION ALL ".join(f"""
SELECT '{name}' AS stage, CAST(COUNT(*) AS BIGINT) AS rows_before,
  CAST(COUNT(DISTINCT id) + MAX(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_after,
  CAST(COUNT(*) - COUNT(DISTINCT id) - MAX(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS duplicates_removed
FROM {cte_name}""" for name, cte_name in (("users_data", "raw_users"), ("cards_data", "raw_cards"),
                                            ("transactions_data", "raw_tx"))),
        "raw_users", "raw_cards", "raw_tx")

    def pk(table: str, src: str, key: str) -> str:
        return f"""
SELECT '{table}' AS table_name, '{key}' AS key_columns, CAST(COUNT(*) AS BIGINT) AS total_rows,
  CAST(COUNT(*) FILTER (WHERE {key} IS NULL) AS BIGINT) AS null_key_rows,
  CAST((SELECT COUNT(*) FROM (SELECT {key} FROM {src} WHERE {key} IS NOT NULL GROUP BY {key} HAVING COUNT(*) > 1)) AS BIGINT) AS duplicate_keys,
  CAST(COUNT({key}) - COUNT(DISTINCT {key}) AS BIGINT) AS duplicate_rows
FROM {src}"""
    src = {"raw.users_data": "raw_users", "raw.cards_data": "raw_cards", "raw.mcc_data": "raw_mcc",
           "raw.transactions_data": "raw_tx", "transformation.users_data": "t_users", "transformation.cards_data": "t_cards",
           "transformation.mcc_data": "t_mcc", "transformation.transactions_data": "t_tx", "transformation.rejects": "rejects",
           "curated.dim_customers": "dim_customers", "curated.dim_cards": "dim_cards", "curated.dim_mcc": "dim_mcc",
           "curated.dim_merchants": "dim_merchants", "curated.dim_date": "dim_date", "curated.fact_transactions": "fact",
           "marts.dim_channel": "dim_channel", "marts.dim_customer": "dim_customers", "marts.dim_card": "dim_cards",
           "marts.fact_finance_transactions": "ff", "marts.fact_customer_transactions": "fct"}
    keys = {"raw.users_data": ("id",), "raw.cards_data": ("id",), "raw.mcc_data": ("code",), "raw.transactions_data": ("id",),
            "transformation.users_data": ("id",), "transformation.cards_data": ("id",), "transformation.mcc_data": ("code",),
            "transformation.transactions_data": ("id",), "curated.dim_customers": ("customer_key", "customer_id"),
            "curated.dim_cards": ("card_key", "card_id"), "curated.dim_mcc": ("mcc_key", "mcc_code"),
            "curated.dim_merchants": ("merchant_key", "merchant_id"), "curated.dim_date": ("date_key", "date"),
            "curated.fact_transactions": ("transaction_id",), "marts.dim_channel": ("channel_key", "source_use_chip"),
            "marts.dim_customer": ("customer_key",), "marts.dim_card": ("card_key",),
            "marts.fact_finance_transactions": ("transaction_id",), "marts.fact_customer_transactions": ("transaction_id",)}
    out["check_primary_key"] = with_ctes(" UNION ALL ".join(pk(t, src[t], k) for t, ks in keys.items() for k in ks),
                                         *[src[t] for t in keys])

    def fk(name: str, child: str, col: str, parent: str, pcol: str) -> str:
        return f"""
SELECT '{name}' AS constraint_name, CAST(COUNT(*) AS BIGINT) AS violating_rows,
  CAST(COUNT(DISTINCT c.{col}) AS BIGINT) AS violating_keys
FROM {child} c WHERE c.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})"""
    fks = [("marts.fact_customer_transactions", "customer_key", "dim_customers", "customer_key"),
           ("marts.fact_customer_transactions", "card_key", "dim_cards", "card_key"),
           ("marts.fact_customer_transactions", "channel_key", "dim_channel", "channel_key"),
           ("marts.fact_finance_transactions", "channel_key", "dim_channel", "channel_key"),
           ("marts.fact_finance_transactions", "date_key", "dim_date", "date_key"),
           ("marts.fact_finance_transactions", "merchant_key", "dim_merchants", "merchant_key"),
           ("marts.fact_finance_transactions", "mcc_key", "dim_mcc", "mcc_key"),
           ("curated.fact_transactions", "date_key", "dim_date", "date_key"),
           ("transformation.transactions_data", "client_id", "t_users", "id"),
           ("transformation.transactions_data", "card_id", "t_cards", "id"),
           ("transformation.transactions_data", "mcc", "t_mcc", "code")]
    out["check_foreign_key"] = with_ctes(" UNION ALL ".join(fk(f"{t}.{c}", src[t], c, p, pc) for t, c, p, pc in fks),
                                         *[src[f[0]] for f in fks], *[f[2] for f in fks])

    card_limits = {"card_brand": 50, "card_type": 50, "card_number": 20, "expires": 7, "has_chip": 10,
                   "acct_open_date": 7, "card_on_dark_web": 10, "issuer_bank_name": 100, "issuer_bank_state": 2,
                   "issuer_bank_type": 50, "issuer_risk_rating": 20}
    tx_limits = {"use_chip": 50, "merchant_city": 255, "merchant_state": 10, "zip": 20, "errors": 255,
                 "day_of_week": 10}
    people = {"gender": 20, "employment_status": 100, "education_level": 100}
    mcc_limits = {"description": 255, "notes": 100, "updated_by": 100}
    lengths = {"transformation.users_data": ("id", people), "transformation.cards_data": ("id", card_limits),
               "transformation.mcc_data": ("code", mcc_limits), "transformation.transactions_data": ("id", tx_limits),
               "curated.dim_customers": ("customer_id", people),
               "curated.dim_cards": ("card_id", {"card_brand": 50, "card_type": 50, "masked_card_number": 25, "expires": 20,
                                                 "has_chip": 10, "acct_open_date": 20, "card_on_dark_web": 10, "issuer_bank_name": 100,
                                                 "issuer_bank_state": 20, "issuer_bank_type": 50, "issuer_risk_rating": 20}),
               "curated.dim_mcc": ("mcc_code", mcc_limits),
               "curated.dim_merchants": ("merchant_id", {"merchant_city": 100, "merchant_state": 20, "zip": 20}),
               "curated.dim_date": ("date_key", {"month_name": 20, "day_name": 20}),
               "curated.fact_transactions": ("transaction_id", {"use_chip": 50, "errors": 255, "is_refund": 5, "has_error": 5, "is_online": 5})}
    limit_rows = [f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'over_length' AS check_name, "
                  f"CAST(COUNT(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS violating_rows FROM {src[t]}"
                  for t, (_, cols) in lengths.items() for c, n in cols.items()]
    limit_rows.append("SELECT 'transformation.transactions_data', 'amount', 'overflow', "
                      "CAST(COUNT(*) FILTER (WHERE round(abs(a), 2) >= 100000000) AS BIGINT) FROM tx_staged")
    out["check_schema_limits"] = with_ctes(" UNION ALL ".join(limit_rows), "tx_staged", *[src[t] for t in lengths])

    def too_long(table: str) -> str:
        key, cols = lengths[table]
        cond = " OR ".join(f"coalesce(length({c}) > {n}, false)" for c, n in cols.items())
        return f"SELECT '{table}' AS table_name, CAST({key} AS BIGINT) AS id FROM {src[table]} WHERE {cond}"
    out["schema_limit_rejects"] = with_ctes(" UNION ALL ".join(map(too_long, lengths)), *[src[t] for t in lengths])

    out["stage_row_counts"] = with_ctes(" UNION ALL ".join(
        f"SELECT '{n}' AS stage, CAST(COUNT(*) AS BIGINT) AS rows FROM {c}" for n, c in src.items()), *src.values())
    out["rejected_rows"] = with_ctes("SELECT table_name, reason, id FROM rejects", "rejects")
    raw_tx = "date, CAST(client_id AS BIGINT) AS client_id, CAST(card_id AS BIGINT) AS card_id"
    out["ingest_arrival_order"] = with_ctes(f"""
SELECT id, {raw_tx}, CASE WHEN merchant_id LIKE '%7' THEN '$1.00' ELSE amount END AS amount, use_chip, merchant_id, merchant_city,
  merchant_state, zip, mcc, CASE WHEN merchant_id LIKE '%7' THEN 'first' || chr(10) || 'line' ELSE errors END AS errors
FROM {keep_first_raw('transactions_data')}""", "raw_tx")

    # ---------------------------------------------------------- whole-table operators
    for t, key in (("users_data", "users"), ("cards_data", "cards"), ("transactions_data", "transactions")):
        out[f"dedup_keep_first_{key}"] = with_ctes(
            f"SELECT {raw_columns(t)} FROM {keep_first_raw(t)} r", RAW_CTE[t])
    out["surrogate_key"] = with_ctes("""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY id) AS BIGINT) AS tx_key, CAST(id AS BIGINT) AS id FROM t_tx""", "t_tx")
    out["ingest_file_manifest"] = with_ctes(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows, "
        f"CAST(COUNT(DISTINCT {'code' if t == 'mcc_data' else 'id'}) AS BIGINT) AS distinct_keys FROM {c}"
        for t, c in RAW_CTE.items()), *RAW_CTE.values())
    out["full_refresh_roundtrip"] = out["clean_users"]
    out["sanitize_missing"] = out["dim_customers"]
    out["insert_if_absent"] = with_ctes(TX_OUT.format(src="""(
  SELECT * FROM t_tx_a
  UNION ALL
  SELECT * FROM t_tx_b b WHERE NOT EXISTS (SELECT 1 FROM t_tx_a a WHERE a.id = b.id))"""), "t_tx_a", "t_tx_b")

    # ---------------------------------------------------------- cleaning maps
    out["clean_users_money"] = clean_map("users_data", ("per_capita_income", "yearly_income", "total_debt"),
                                         ("per_capita_income", "yearly_income", "total_debt"))
    out["clean_users_gender"] = clean_map("users_data", ("gender",), ("gender",))
    out["clean_users_employment"] = clean_map("users_data", ("employment_status",), ("employment_status",))
    out["clean_users_education"] = clean_map("users_data", ("education_level",), ("education_level",))
    out["title_case"] = clean_map("users_data", ("address",), ("address",))
    rng = ("birth_month", "birth_year", "retirement_age", "credit_score", "num_credit_cards", "latitude", "longitude")
    out["clean_users_ranges"] = clean_map("users_data", rng, rng)
    out["customer_age"] = clean_map("users_data", ("birth_year", "birth_month", "current_age"), ("current_age",))
    out["clean_cards_money"] = clean_map("cards_data", ("credit_limit",), ("credit_limit",))
    out["clean_cards_dates"] = clean_map("cards_data", ("expires", "acct_open_date"), ("expires", "acct_open_date"))
    out["clean_cards_flags"] = clean_map("cards_data", ("has_chip", "card_on_dark_web"),
                                         ("has_chip", "card_on_dark_web"))
    cat = ("card_brand", "card_type", "issuer_bank_type", "issuer_risk_rating")
    out["clean_cards_categories"] = clean_map("cards_data", cat, cat)
    out["clean_cards_bank"] = clean_map("cards_data", ("issuer_bank_name", "issuer_bank_state"),
                                        ("issuer_bank_name", "issuer_bank_state"))
    out["clean_cards_number"] = clean_map("cards_data", ("card_number", "cvv"), ("card_number", "cvv"))
    out["tx_refund_split"] = clean_map("transactions_data", ("amount",), ("amount", "refund_amount", "is_refund"))
    out["tx_date_parts"] = clean_map("transactions_data", ("date",),
                                     ("date", "transaction_year", "transaction_month", "transaction_quarter",
                                      "transaction_hour", "day_of_week"))
    out["tx_online_rules"] = clean_map("transactions_data", ("use_chip", "merchant_city"),
                                       ("use_chip", "merchant_city", "is_online"))
    out["tx_state_zip"] = clean_map("transactions_data", ("merchant_state", "zip", "merchant_city"),
                                    ("merchant_state", "zip"))
    mask = strip("replace(card_number, ' ', '')")
    out["mask_card_number"] = with_ctes(f"""
SELECT card_number, CASE WHEN length({mask}) >= 4 THEN '{V.CARD_MASK_PREFIX}' || right({mask}, 4) END AS masked_card_number,
  CAST(COUNT(*) AS BIGINT) AS rows
FROM t_cards GROUP BY ALL""", "t_cards")
    out["clean_mcc_code"] = with_ctes(f"""
SELECT code AS raw_code, {_mcc_code()} AS code, CAST(COUNT(*) AS BIGINT) AS rows
FROM raw_mcc GROUP BY ALL""", "raw_mcc")
    fuzzy_rows = []
    for field, aliases, canonical in (("employment_status", V.EMPLOYMENT_ALIASES, V.EMPLOYMENT_CANONICAL),
                                      ("education_level", V.EDUCATION_ALIASES, V.EDUCATION_CANONICAL)):
        fuzzy = {k: v for k, v in FIXTURE_FUZZY.items() if v in canonical}
        e = collapse(field)
        fuzzy_rows.append(f"""
SELECT DISTINCT '{field}' AS field, {e} AS value, {case_map(f"lower({e})", fuzzy)} AS fuzzy_label
FROM raw_users WHERE lower({e}) IN {in_list(fuzzy)}""")
    out["fuzzy_canonicalize"] = with_ctes(" UNION ALL ".join(fuzzy_rows), "raw_users")
    return out
