"""Names, labels, ranks and patterns the results depend on."""

# State spellings that differ between sources -> the conformed name.
STATE_ALIASES = {
    "Andaman & Nicobar Islands": "Andaman & Nicobar Islands",
    "Andaman And Nicobar Islands": "Andaman & Nicobar Islands",
    "Nct Of Delhi": "Delhi",
    "Delhi Nct": "Delhi",
    "National Capital Territory Of Delhi": "Delhi",
    "Nct": "Delhi",
    "Dadra & Nagar Haveli": "Dadra & Nagar Haveli and Daman & Diu",
    "Daman & Diu": "Dadra & Nagar Haveli and Daman & Diu",
    "Dadra & Nagar Haveli & Daman & Diu": "Dadra & Nagar Haveli and Daman & Diu",
    "Delhi (Nct)": "Delhi",
    "Orissa": "Odisha",
    "Pondicherry": "Puducherry",
    "Uttaranchal": "Uttarakhand",
    "Chattisgarh": "Chhattisgarh",
    "Jammu & Kashmir": "Jammu & Kashmir",
}

# Upper-case state spellings of the funds source -> the conformed name.
FUND_STATE_ALIASES = {
    "ORISSA": "Odisha",
    "PONDICHERRY": "Puducherry",
    "UTTARANCHAL": "Uttarakhand",
    "NCT OF DELHI": "Delhi",
    "DADRA AND NAGAR HAVELI": "Dadra & Nagar Haveli and Daman & Diu",
    "DAMAN AND DIU": "Dadra & Nagar Haveli and Daman & Diu",
    "DADRA AND NAGAR HAVELI AND DAMAN AND DIU": "Dadra & Nagar Haveli and Daman & Diu",
}

# Education labels (lower case) -> ordinal rank.
EDUCATION_RANKS = {
    "illiterate": 0,
    "literate": 1,
    "5th pass": 2,
    "8th pass": 3,
    "10th pass": 4,
    "12th pass": 5,
    "graduate": 6,
    "diploma": 6,
    "graduate professional": 7,
    "post graduate": 8,
    "doctorate": 9,
}

# Distribution labels in display order.
EDUCATION_GROUPS = ["Illiterate / Literate", "Class 5-12", "Graduate or above", "Not disclosed"]
AGE_BANDS = ["Under 40", "40-54", "55-69", "70+", "Unknown"]
AGE_EDGES = [40, 55, 70]

# Cohort and board labels, thresholds.
ALL_CANDIDATES = "All candidates"
WINNERS = "Winners (MPs)"
RICHEST = "Richest candidates"
MOST_CASES = "Most declared cases"
CRORE = 10_000_000
MAJOR_PARTY_WINS = 5
SAME_PERSON = 0.82

# HTML entities, applied in this order.
ENTITIES = [
    ("&nbsp;", " "),
    ("&nbsp", " "),
    ("&amp;", "&"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&nabla;", ""),
]

# Words dropped from person names before they are compared.
HONORIFICS = [
    "SHRI", "SHRIMATI", "SMT", "SRI", "DR", "ADV", "ADVOCATE", "PROF", "MR", "MRS", "MS",
    "KUMARI", "SARDAR", "COL", "CAPT", "CAPTAIN", "MAJ", "GEN", "JUSTICE",
]

# Patterns of text cleaning.
SPACES = r"[\s\p{Z}\x{85}]+"
HTML_TAG = "<[^>]+>"
NUMERIC_ENTITY = r"&#\d+;"
AMPERSAND = r"\s*&\s*"
FULL_STOP = r"\s*\.\s*"
WORD_AND = r"\bAnd\b"
SEAT_IS_SC = r"(?i)\(\s*SC\s*\)"
SEAT_IS_ST = r"(?i)\(\s*ST\s*\)"
SEAT_TAG_AT_END = r"(?i)\s*\((sc|st)\)\s*$"
SEAT_TAG_IN_KEY = r"\(\s*(SC|ST)\s*\)"
WINNER_MARK = r"(?i)\s*Winner\s*$"

# Patterns of money, labels and person names.
RUPEES = r"(?i)Rs\.?\s*([\d,]+)"
PLAIN_FIGURE = r"([\d,]{2,})"
NIL = r"(?i)^nil$"
NO_FIGURE = r"(?i)^(none|n/?a|-+|not given)?$"
NO_EDUCATION = r"(?i)^(-+|n/?a)?$"
PATRONYMIC = r"\bS\s*/\s*O\b.*$"
OTHER_NAME = r"\b(ALIAS|URF|@)\b"

# Published columns of winners and boards, in order.
WINNER_COLUMNS = [
    "election_year", "state", "constituency", "seat_category", "name", "party", "party_group",
    "criminal_cases", "education", "education_group", "age", "assets", "liabilities", "net_worth",
    "is_crorepati", "candidate_id",
]
BOARD_COLUMNS = [
    "board", "rank", "election_year", "name", "party", "state", "constituency", "assets",
    "liabilities", "criminal_cases", "education", "age", "is_winner", "candidate_id",
]

# Patterns of the page layout.
HEADER = r"(?i)List of Candidates\s+in\s+(.+?)\s*:\s*(.+?)\s+Lok\s*Sabha\s*(\d{4})"
HEADER_ALTERNATE = r"(?i)List of Candidates\s*[-in]*\s*([^:<]+?)\s*:\s*([^(<]+)"
HEADER_TAIL = r"(?i)\s*Lok\s*Sabha.*$"
BYE_ELECTION = r"(?i)^BYE[\s-]*ELECTION"
TABLE = r"(?is)<table.*?</table>"
TABLE_ROW = r"(?is)<tr[^>]*>(.*?)</tr>"
TABLE_CELL = r"(?is)<td[^>]*>(.*?)</td>"
CANDIDATE_LINK = r"candidate_id=(\d+)"
SEAT_LINK = r"constituency_id=(\d+)"
PAGE_NAME = r"c_(\d+)_(\d+)\.html$"

# Fund tile captions -> (first figure, second figure).
FUND_TILES = {
    "Allocated Limit for Hon'ble MPs": ("allocated", None),
    "Expenditure on Completed and On-going Works as on Date": ("expenditure", None),
    "Works Recommended": ("works_recommended", "works_recommended_amt"),
    "Works Sanctioned": ("works_sanctioned", "works_sanctioned_amt"),
    "Works Completed": ("works_completed", "works_completed_amt"),
}
