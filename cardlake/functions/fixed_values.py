"""Fixed values.

FIXED VALUES — these word lists and lookup tables must equal the source
pipeline's so that cleaning gives the same labels.  They are stated as data,
in their natural order, and are used only through the expression builders in
`cardlake.functions`.  Keys are matched after the normalisation noted above
each table (keys that normalisation can never produce are kept as data; they
simply never match).
"""

# ---------------------------------------------------------------- users
# key: lower(collapse_ws(trim(value)))
EMPLOYMENT_CANONICAL = ["Employed", "Student", "Retired", "Unemployed", "Self-Employed"]

EMPLOYMENT_ALIASES = {
    "employed": "Employed",
    "empl0yed": "Employed",
    "student": "Student",
    "studnt": "Student",
    "ret.": "Retired",
    "retired": "Retired",
    "retird": "Retired",
    "un-employed": "Unemployed",
    "unemployed": "Unemployed",
    "unemployd": "Unemployed",
    "self employed": "Self-Employed",
    "self-employed": "Self-Employed",
    "self employd": "Self-Employed",
    "self-employd": "Self-Employed",
}

EDUCATION_CANONICAL = ["Bachelor Degree", "High School", "Masters", "Associate Degree", "Doctorate"]

EDUCATION_ALIASES = {
    "bachelor degree": "Bachelor Degree",
    "bachelor's degree": "Bachelor Degree",
    "bachelors": "Bachelor Degree",
    "ba/bs": "Bachelor Degree",
    "bachelor  degree": "Bachelor Degree",
    "high school": "High School",
    "highschool": "High School",
    "hs": "High School",
    "high  school": "High School",
    "master degree": "Masters",
    "master's degree": "Masters",
    "masters": "Masters",
    "ms/ma": "Masters",
    "master  degree": "Masters",
    "associate degree": "Associate Degree",
    "assoc degree": "Associate Degree",
    "associate deg.": "Associate Degree",
    "associate": "Associate Degree",
    "associate  degree": "Associate Degree",
    "doctorate": "Doctorate",
}

# fuzzy matching cut-off (Ratcliff-Obershelp ratio), best single match
FUZZY_CUTOFF = 0.80

# users money: text numbers and placeholders (key: lower(trimmed))
USER_TEXT_MONEY = {"ten thousand": 10000}
MONEY_TEXT_ERRORS = ["error_value", "not available", "nan", "unknown", "n/a"]

# gender (key: lower(collapse_ws(trim)))
GENDER_MAP = {"m": "Male", "male": "Male", "f": "Female", "female": "Female"}
GENDER_NULLS = ["nan", "n/a", "unknown"]

# bounded integer / float ranges, inclusive
RANGES = {
    "birth_month": (1, 12),
    "birth_year": (1900, 2025),
    "current_age": (0, 120),
    "retirement_age": (0, 120),
    "credit_score": (300, 850),
    "latitude": (-90, 90),
    "longitude": (-180, 180),
}
NUM_CREDIT_CARDS_MIN = 0
YEARLY_INCOME_FLOOR = 100  # yearly income below this becomes 0

# ---------------------------------------------------------------- cards
CARD_TEXT_MONEY = {"ten thousand": 10000, "five thousand": 5000, "twenty thousand": 20000}
CARD_MONEY_MAX = 1_000_000

MONTH_YEAR_NULLS = ["", "nan", "not available", "n/a"]
CVV_RANGE = (100, 999)

YES_NO_MAP = {
    "yes": "Yes", "y": "Yes", "true": "Yes", "1": "Yes",
    "no": "No", "n": "No", "false": "No", "0": "No",
}

# key: collapse_ws(lower(trim(text(value))))
BRAND_MAPPING = {
    "v": "Visa",
    "vis": "Visa",
    "visa": "Visa",
    "vissa": "Visa",
    "v!sa": "Visa",
    "vvisa": "Visa",
    "visa-card": "Visa",
    "mastercard": "Mastercard",
    "master card": "Mastercard",
    "master  card": "Mastercard",
    "amex": "American Express",
    "ame x": "American Express",
    "ame  x": "American Express",
    "discover": "Discover",
    "dis cover": "Discover",
    "dis  cover": "Discover",
}

# key: collapse_ws(lower(trim(text(value))))
TYPE_MAPPING = {
    "credit": "Credit",
    "cred": "Credit",
    "credt": "Credit",
    "cedit": "Credit",
    "crdeit": "Credit",
    "cr": "Credit",
    "cc": "Credit",
    "credit card": "Credit",
    "card - credit": "Credit",
    "cre dit": "Credit",
    "debit": "Debit",
    "debiit": "Debit",
    "db": "Debit",
    "d": "Debit",
    "debti": "Debit",
    "deibt": "Debit",
    "de bit": "Debit",
    "debit card": "Debit",
    "bank debit": "Debit",
    "deb": "Debit",
    "debit (prepaid)": "Prepaid",
    "debit (prepaid) card": "Prepaid",
    "debit (pre payed)": "Prepaid",
    "prepaid": "Prepaid",
    "prepaid debit": "Prepaid",
    "ppd": "Prepaid",
    "dp": "Prepaid",
    "dpp": "Prepaid",
    "db-pp": "Prepaid",
    "debit prepaid": "Prepaid",
    "debit(prepaid)": "Prepaid",
    "debit (prepiad)": "Prepaid",
    "debti (prepaid)": "Prepaid",
    "debit (prepaid) ": "Prepaid",
    "debit (pre paid)": "Prepaid",
    "debit prepaid card": "Prepaid",
}

# key: lower(trim(text(value)))
BANK_NAME_MAPPING = {
    "wells fargo": "Wells Fargo",
    "citi": "Citi",
    "chase bank": "Chase Bank",
    "chase bk": "Chase Bank",
    "bank of america": "Bank of America",
    "bk of america": "Bank of America",
    "capital one": "Capital One",
    "jpmorgan chase": "JPMorgan Chase",
    "jp morgan chase": "JPMorgan Chase",
    "u.s. bank": "U.S. Bank",
    "u.s. bk": "U.S. Bank",
    "pnc bank": "PNC Bank",
    "pnc bk": "PNC Bank",
    "truist": "Truist",
    "ally bank": "Ally Bank",
    "ally bk": "Ally Bank",
    "discover bank": "Discover Bank",
    "discover bk": "Discover Bank",
}

# key: lower(trim(value))
BANK_STATE_MAP = {
    "california": "CA",
    "illinois": "IL",
    "new york": "NY",
    "michigan": "MI",
    "minnesota": "MN",
    "north carolina": "NC",
    "pennsylvania": "PA",
    "virginia": "VA",
}

# key: lower(trim(text(value)))
BANK_TYPE_MAPPING = {
    "national": "National",
    "national bank": "National",
    "online": "Online",
    "online bank": "Online",
    "online only": "Online",
    "regional": "Regional",
    "regional bank": "Regional",
}

# key: lower(trim(text(value)))
RISK_RATING_MAPPING = {
    "low": "Low",
    "low risk": "Low",
    "med": "Medium",
    "medium": "Medium",
    "high": "High",
    "high risk": "High",
}

# defaults when a mapping misses
OTHER = "Other"
RISK_DEFAULT = "Medium"
# text form of a missing value when the source turns it into a string
NULL_TEXT = "None"

# ---------------------------------------------------------------- mcc
MCC_PREFIX = "MCC"
MCC_CODE_NULLS = ["NOTE", "COMMENT", "NAN", "\\N"]
MCC_BLANKS = ["", "\\N"]
NOTES_MAP = {"legacy": "Legacy Data", "check": "Needs Check", "old_code": "Old Code"}

# ---------------------------------------------------------------- transactions
VALID_US_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
    "DC", "PR", "GU", "VI", "AS", "MP",
]

STATE_NAME_MAP = {
    "california": "CA", "new york": "NY", "texas": "TX",
    "florida": "FL", "illinois": "IL", "pennsylvania": "PA",
    "ohio": "OH",
}

CHANNEL_SUFFIX = " Transaction"
CITY_NULLS = ["", "NaN", "nan", "None"]
ZIP_NULLS = ["", "NaN", "nan"]
ONLINE_TEXT = "online"
ONLINE_CITY = "Online"
MIN_AMOUNT = "0.01"

# ---------------------------------------------------------------- marts
UNKNOWN_CHANNEL = "__UNKNOWN__"
UNKNOWN_LABEL = "Unknown"
ONLINE_CHANNEL_SOURCES = ("Online Transaction",)
NO_ERROR_TEXT = "No Error"
REASON_ERROR = "Transaction error recorded"
REASON_OUTLIER = "Amount > 3 std dev above customer average"
REASON_NONE = "Not flagged"
OUTLIER_SIGMAS = 3
OUTLIER_MIN_COUNT = 2
ERROR_RATE_MIN_TRANSACTIONS = 10
CARD_MASK_PREFIX = "**** **** **** "
