"""Raw test tables derived from the driver's TPC-H-style tables.

The reference ships no data, so the four raw inputs (users, cards, mcc codes,
transactions) are derived by SQL from `customer`, `part`, `orders` and
`lineitem`.  The text runs unchanged in Spark SQL and DuckDB; table names are
`{placeholders}` so Spark binds DataFrames (no global temp views) and the
oracle binds its own views.  `_seq` is the arrival order that "keep first"
uses.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

USERS_SQL = """
SELECT c_custkey AS _seq, c_custkey AS id,
  CAST(c_custkey % 100 AS INT) AS current_age, CAST(40 + c_custkey % 100 AS INT) AS retirement_age,
  CAST(1890 + c_custkey % 150 AS INT) AS birth_year, CAST(c_custkey % 15 AS INT) AS birth_month,
  CASE c_custkey % 7 WHEN 0 THEN 'M' WHEN 1 THEN ' male ' WHEN 2 THEN 'f' WHEN 3 THEN 'FEMALE' WHEN 4 THEN 'unknown' WHEN 5 THEN 'non  BINARY' END AS gender,
  CASE WHEN c_custkey % 11 = 0 THEN '   ' ELSE concat(' ', CAST(c_custkey AS STRING), '  o''neil   AVE ') END AS address,
  CAST(c_custkey % 200 - 100 AS DOUBLE) AS latitude, CAST((c_custkey * 7) % 400 - 200 AS DOUBLE) AS longitude,
  CASE c_custkey % 6 WHEN 0 THEN concat('$', CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING)) WHEN 1 THEN '"$5,000"' WHEN 2 THEN '12.5k' WHEN 3 THEN 'Ten Thousand' WHEN 4 THEN 'ERROR_VALUE' END AS per_capita_income,
  CASE c_custkey % 5 WHEN 0 THEN '$50' WHEN 1 THEN '' WHEN 2 THEN '33d' ELSE concat('$', CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING)) END AS yearly_income,
  CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) AS total_debt,
  CAST(250 + c_custkey % 700 AS INT) AS credit_score, CAST(c_custkey % 9 - 1 AS INT) AS num_credit_cards,
  CASE c_custkey % 9 WHEN 0 THEN 'Employed' WHEN 1 THEN 'empl0yed' WHEN 2 THEN ' RET. ' WHEN 3 THEN 'self  employd' WHEN 4 THEN 'unemployedd' WHEN 5 THEN 'studentt' WHEN 6 THEN 'gig worker' WHEN 7 THEN '' END AS employment_status,
  CASE c_custkey % 8 WHEN 0 THEN 'BA/BS' WHEN 1 THEN 'hs' WHEN 2 THEN 'master''s  degree' WHEN 3 THEN 'doctorat' WHEN 4 THEN 'assoc degree' WHEN 5 THEN 'phd''s' WHEN 6 THEN 'High  Schol' END AS education_level
FROM {customer}
UNION ALL
-- extra rows, not a subset: late re-deliveries of every 50th customer id, which keep-first must drop
SELECT 1000000000 + c_custkey, c_custkey, 1, 1, 1980, 6, 'M', 'dup', 0.0, 0.0, '1', '1', '1', 700, 1, 'Student', 'hs' FROM {customer} WHERE c_custkey % 50 = 0
UNION ALL
-- extra rows, not a subset: an amount of money that no BIGINT holds, to be rejected
SELECT 2000000000 + c_custkey, 500000000 + c_custkey, 1, 1, 1980, 6, 'F', 'huge', 0.0, 0.0,
  CASE c_custkey % 3 WHEN 0 THEN '1e25' ELSE '$5' END, CASE c_custkey % 3 WHEN 1 THEN '$9,300,000,000,000,000,000' ELSE '5' END,
  CASE c_custkey % 3 WHEN 2 THEN '1e30k' ELSE '5' END, 700, 1, 'Student', 'hs' FROM {customer} WHERE c_custkey % 61 = 0
"""

CARDS_SQL = """
SELECT c_custkey * 2 + k AS _seq, c_custkey * 2 + k AS id, c_custkey AS client_id,
  CASE (c_custkey + k) % 8 WHEN 0 THEN 'Visa ' WHEN 1 THEN ' v!sa' WHEN 2 THEN 'Master  Card' WHEN 3 THEN 'AMEX' WHEN 4 THEN 'dis cover' WHEN 5 THEN 'JCB' WHEN 6 THEN 'vvisa' END AS card_brand,
  CASE (c_custkey + k) % 7 WHEN 0 THEN 'Credit' WHEN 1 THEN 'debti' WHEN 2 THEN 'Debit (Prepaid)' WHEN 3 THEN 'ppd' WHEN 4 THEN 'charge' WHEN 5 THEN ' CC ' END AS card_type,
  CASE WHEN c_custkey % 23 = 0 THEN '9300000000000000001' WHEN c_custkey % 4 = 0 THEN concat('4344 6765 1195 ', CAST(1000 + c_custkey % 9000 AS STRING)) WHEN c_custkey % 4 = 1 THEN concat('434467651195', CAST(1000 + c_custkey % 9000 AS STRING), '.0') WHEN c_custkey % 4 = 2 THEN '12' ELSE CAST(4344676511950000 + c_custkey AS STRING) END AS card_number,
  CASE c_custkey % 6 WHEN 0 THEN CASE c_custkey % 4 WHEN 0 THEN 'Sep-24' ELSE 'Sep-0024' END WHEN 1 THEN 'dec-98' WHEN 2 THEN '2027-03-15' WHEN 3 THEN '09/2026' WHEN 4 THEN 'not available' END AS expires,
  CAST(c_custkey % 1100 AS INT) AS cvv,
  CASE c_custkey % 6 WHEN 0 THEN 'YES' WHEN 1 THEN 'n' WHEN 2 THEN '1' WHEN 3 THEN 'False' WHEN 4 THEN 'maybe' END AS has_chip,
  CAST(1 + k AS INT) AS num_cards_issued,
  CASE c_custkey % 7 WHEN 0 THEN '$24,295' WHEN 1 THEN '(500)' WHEN 2 THEN '12 k' WHEN 3 THEN 'five thousand' WHEN 4 THEN '2000000' WHEN 5 THEN 'n/a' END AS credit_limit,
  CASE c_custkey % 9 WHEN 0 THEN CASE c_custkey % 4 WHEN 0 THEN 'Jan-2010' WHEN 1 THEN 'Jan-1500' ELSE '2024-09-15T10:00:00Z' END WHEN 1 THEN 'Feb-07' WHEN 3 THEN 'March 15, 2009' WHEN 4 THEN '15/03/2011' WHEN 5 THEN '2012-06-01 08:30:00' WHEN 6 THEN 'Sept 2013' WHEN 7 THEN '20140105' END AS acct_open_date,
  CAST(2000 + c_custkey % 25 AS INT) AS year_pin_last_changed,
  CASE c_custkey % 3 WHEN 0 THEN 'No' WHEN 1 THEN ' yes' END AS card_on_dark_web,
  CASE c_custkey % 5 WHEN 0 THEN 'chase bk' WHEN 1 THEN 'U.S. Bk' WHEN 2 THEN 'first o''hare BANK' WHEN 3 THEN CASE c_custkey % 7 WHEN 0 THEN repeat('long bank name ', 8) ELSE 'Citi ' END END AS issuer_bank_name,
  CASE c_custkey % 6 WHEN 0 THEN 'California' WHEN 1 THEN 'ny' WHEN 2 THEN 'Nevada' WHEN 3 THEN 'N.Y.' WHEN 4 THEN '' END AS issuer_bank_state,
  CASE c_custkey % 4 WHEN 0 THEN 'National Bank' WHEN 1 THEN 'online only' WHEN 2 THEN 'co-op' END AS issuer_bank_type,
  CASE c_custkey % 5 WHEN 0 THEN 'LOW risk' WHEN 1 THEN 'med' WHEN 2 THEN 'High' WHEN 3 THEN '??' END AS issuer_risk_rating
FROM (SELECT *, 0 AS k FROM {customer} UNION ALL SELECT *, 1 AS k FROM {customer}
      UNION ALL SELECT *, 1 AS k FROM {customer}) t
"""

MCC_SQL = """
SELECT p_partkey AS _seq,
  CASE p_partkey % 6 WHEN 0 THEN concat('MCC ', CAST(5000 + p_size AS STRING)) WHEN 1 THEN concat('"', CAST(5000 + p_size AS STRING), '"') WHEN 2 THEN concat(CAST(5000 + p_size AS STRING), '.0') WHEN 3 THEN CASE p_partkey % 7 WHEN 0 THEN 'MCC 99999999999' ELSE 'note' END WHEN 4 THEN concat('-', CAST(5000 + p_size AS STRING)) ELSE CAST(5000 + p_size AS STRING) END AS code,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE concat(' ', p_name, '  men''s ', CAST(p_size AS STRING)) END AS description,
  CASE p_partkey % 4 WHEN 0 THEN 'LEGACY' WHEN 1 THEN 'check' WHEN 2 THEN 'free text' END AS notes,
  CASE p_partkey % 3 WHEN 0 THEN 'data_team' WHEN 1 THEN 'ops-admin' END AS updated_by
FROM {part}
"""

_TRANSACTIONS = """
SELECT row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS _seq,
  CAST(l_orderkey * 10 + l_linenumber AS STRING) AS id,
  CASE WHEN l_partkey % 211 = 0 THEN 'bad date' ELSE CAST(l_shipdate + l_linenumber * INTERVAL '3' HOUR AS STRING) END AS date,
  CAST(o_custkey AS INT) AS client_id,
  CAST(CASE WHEN l_orderkey % 97 = 0 THEN 999999999 ELSE o_custkey * 2 + l_orderkey % 2 END AS INT) AS card_id,
  CASE WHEN l_partkey % 251 = 0 THEN '$123,456,789.00' WHEN l_partkey % 257 = 0 THEN '0.009999999' WHEN l_partkey % 101 = 0 THEN 'oops' WHEN l_partkey % 103 = 0 THEN '$0.00'
       ELSE concat(CASE WHEN l_returnflag = 'R' THEN '$-' ELSE '$' END, CAST(CAST(CASE WHEN l_orderkey % 53 = 0 THEN l_extendedprice * 50 ELSE l_extendedprice END AS DECIMAL(12,2)) AS STRING)) END AS amount,
  CASE l_linenumber % 4 WHEN 0 THEN 'Swipe Transaction' WHEN 1 THEN ' Chip Transaction' WHEN 2 THEN 'Online Transaction' END AS use_chip,
  CASE WHEN l_partkey % 263 = 0 THEN concat('M-', CAST(l_partkey AS STRING)) ELSE CAST(l_partkey AS STRING) END AS merchant_id,
  CASE WHEN l_suppkey % 17 = 0 THEN 'ONLINE' WHEN l_suppkey % 19 = 0 THEN 'nan' ELSE concat('City', CAST(l_suppkey % 3 AS STRING), ' ') END AS merchant_city,
  CASE l_suppkey % 6 WHEN 0 THEN 'CA' WHEN 1 THEN 'ny' WHEN 2 THEN 'Texas' WHEN 3 THEN 'Ontario' WHEN 4 THEN 'pr' END AS merchant_state,
  CASE l_suppkey % 4 WHEN 0 THEN '90001.0' WHEN 1 THEN '10.05' WHEN 2 THEN '' ELSE '02139' END AS zip,
  CASE WHEN l_partkey % 269 = 0 THEN '5411.0' ELSE CAST(5001 + l_partkey % 52 AS STRING) END AS mcc,
  CASE l_quantity WHEN 1 THEN 'Insufficient Balance' WHEN 2 THEN ' Bad PIN,Insufficient Balance,' WHEN 3 THEN 'NaN' END AS errors
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

# the same rows without the arrival window, numbered far behind all others by what tells them apart
_LATE = re.sub(r"row_number\(\) OVER \(.*?\) AS _seq",
               "1000000000 + (l_orderkey * 10 + l_linenumber) * 1000000000 + (l_partkey % 100000) * 10000 + (l_suppkey % 100) * 100"
               " + CAST(l_quantity AS BIGINT) AS _seq", _TRANSACTIONS)

# extra rows, not a subset: late re-deliveries of some transactions under other
# spellings of the same id, which keep-first must drop, and ids that are no number
TRANSACTIONS_SQL = f"""{_TRANSACTIONS}
UNION ALL
SELECT _seq, concat('0', id), date, client_id, card_id, '$1.25', use_chip, merchant_id, merchant_city, merchant_state, zip, mcc, errors FROM ({_LATE} WHERE o_custkey % 5 = 0) v5
UNION ALL
SELECT _seq, concat(' +', id, ' '), date, client_id, card_id, '$2.25', use_chip, merchant_id, merchant_city, merchant_state, zip, mcc, errors FROM ({_LATE} WHERE o_custkey % 7 = 0) v7
UNION ALL
SELECT _seq, CASE WHEN client_id % 2 = 0 THEN concat('tx-', id) END, date, client_id, card_id, '$3.25', use_chip, merchant_id, merchant_city, merchant_state, zip, mcc, errors FROM ({_LATE} WHERE o_custkey % 91 = 0) v91
"""

# The same rows for Spark from one join: each joined row stands for itself and for its re-deliveries (5, 7, 91),
# where TRANSACTIONS_SQL joins and shuffles the two tables once for each.  Rows are numbered before their texts
# are made, so that the shuffle and the sort carry the tables' own columns.
_LATE_SEQ = re.search(r"SELECT (1000000000 \+ .*?) AS _seq", _LATE).group(1)
_ARRIVAL = re.search(r"row_number\(\) OVER \(.*?\) AS _seq", _TRANSACTIONS).group(0)
_JOINED = re.search(r"FROM ({lineitem} JOIN {orders} ON .*)\n", _TRANSACTIONS).group(1)
_COLUMNS = ", ".join(sorted(set(re.findall(r"\b[lo]_[a-z]+", _TRANSACTIONS)) - {"o_orderkey"}))
_NUMBERED = (_TRANSACTIONS.replace(_ARRIVAL, f"_seq, {_LATE_SEQ} AS _late, o_custkey AS _who")
             .replace(_JOINED, f"(SELECT *, {_ARRIVAL} FROM (SELECT {_COLUMNS} FROM {_JOINED}) r) n"))
_SINGLE_JOIN = f"""SELECT CASE k WHEN 0 THEN _seq ELSE _late END AS _seq,
  CASE k WHEN 0 THEN id WHEN 5 THEN concat('0', id) WHEN 7 THEN concat(' +', id, ' ') ELSE CASE WHEN client_id % 2 = 0 THEN concat('tx-', id) END END AS id,
  date, client_id, card_id, CASE k WHEN 0 THEN amount WHEN 5 THEN '$1.25' WHEN 7 THEN '$2.25' ELSE '$3.25' END AS amount,
  use_chip, merchant_id, merchant_city, merchant_state, zip, mcc, errors
FROM (SELECT *, explode(array_compact(array(0, CASE WHEN _who % 5 = 0 THEN 5 END, CASE WHEN _who % 7 = 0 THEN 7 END, CASE WHEN _who % 91 = 0 THEN 91 END))) AS k
      FROM ({_NUMBERED}) j) t
"""

RAW_SQL = {
    "users_data": USERS_SQL,
    "cards_data": CARDS_SQL,
    "mcc_data": MCC_SQL,
    "transactions_data": TRANSACTIONS_SQL,
}

# where Spark takes another text for the same rows
SPARK_SQL = {"transactions_data": _SINGLE_JOIN}

# driver tables each raw table reads
RAW_INPUTS = {
    "users_data": ("customer",),
    "cards_data": ("customer",),
    "mcc_data": ("part",),
    "transactions_data": ("lineitem", "orders"),
}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw input table as a lazy DataFrame over the driver parquet."""
    inputs = {t: driver_table(spark, sf_dir, t) for t in RAW_INPUTS[name]}
    return spark.sql(SPARK_SQL.get(name, RAW_SQL[name]), **inputs)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: raw_table(spark, sf_dir, name) for name in RAW_SQL}


def oracle_raw_sql(name: str) -> str:
    """The same text with plain table names, for DuckDB."""
    sql = RAW_SQL[name]
    for t in RAW_INPUTS[name]:
        sql = sql.replace("{%s}" % t, t)
    return sql
