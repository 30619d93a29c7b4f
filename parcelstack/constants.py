"""Fixed values.

Everything in this module is a FIXED VALUE: the lists, maps and numbers
below must equal the ones the linked records were scored with, or the
results differ. They are stated plainly, in their natural order, and are
not derived from anything. Order matters where noted (first match wins).
"""

# ---------------------------------------------------------------- fixed values
# The six distress patterns, in signal-attachment order.
PATTERNS = ["jfc", "tax", "estate", "code", "lien", "transfer"]

# Tiers come only from the number of distinct patterns.
TIER_HOT, TIER_WARM, TIER_ACTIVE = "hot", "warm", "active"
# The texts that a run summary carries.
TIER_RULES = {"hot": "stack_count >= 3", "warm": "stack_count == 2", "active": "stack_count == 1"}
PATTERNS_LEGEND = {
    "jfc": "Judicial Foreclosure (Power of Sale)",
    "tax": "Tax Distress (delinquency / In Rem / mortgage-style)",
    "estate": "Probate / Estate Opened",
    "code": "Code Violation / Demolition Order",
    "lien": "Recorded Lien / Civil Judgment",
    "transfer": "Distressed Conveyance (not yet wired)",
}

# Code-case statuses that count as open (case-sensitive) and the case type
# that raises the housing flag.
CODE_OPEN_STATUSES = ["Open", "New", "Active", "Pending"]
CODE_HIGH_SIGNAL_TYPES = ["Housing"]

# Street suffix words and their canonical form (address key).
STREET_SUFFIX = {
    "ST": "ST", "STREET": "ST",
    "AV": "AVE", "AVE": "AVE", "AVENUE": "AVE",
    "RD": "RD", "ROAD": "RD",
    "DR": "DR", "DRIVE": "DR",
    "LN": "LN", "LANE": "LN",
    "CT": "CT", "COURT": "CT",
    "CR": "CIR", "CIR": "CIR", "CIRCLE": "CIR",
    "PL": "PL", "PLACE": "PL",
    "BLVD": "BLVD", "BOULEVARD": "BLVD",
    "PKWY": "PKWY", "PARKWAY": "PKWY",
    "TER": "TER", "TERRACE": "TER",
    "WAY": "WAY", "WY": "WAY",
    "HWY": "HWY", "HIGHWAY": "HWY",
    "TRL": "TRL", "TRAIL": "TRL",
    "SQ": "SQ", "SQUARE": "SQ",
}

# Owner-name noise tokens dropped before building name keys. Multi-word
# entries can never equal a single token; they are kept as stated.
NAME_NOISE = [
    "INC", "INCORPORATED", "LLC", "L L C", "LP", "L P", "PLLC",
    "CORP", "CORPORATION", "CO",
    "TRUST", "TRUSTEE", "REVOCABLE", "LIVING",
    "ETAL", "ET AL", "ET UX",
    "JR", "SR", "II", "III", "IV",
    "ESTATE", "DECEASED",
    "FAMILY", "IRREVOCABLE",
    "FOUNDATION",
]

# Most common surnames: a two-word decedent key is not built on these.
COMMON_SURNAMES = [
    "SMITH", "JOHNSON", "WILLIAMS", "BROWN", "JONES", "GARCIA", "MILLER",
    "DAVIS", "RODRIGUEZ", "MARTINEZ", "HERNANDEZ", "LOPEZ", "GONZALEZ",
    "WILSON", "ANDERSON", "THOMAS", "TAYLOR", "MOORE", "JACKSON", "MARTIN",
    "LEE", "PEREZ", "THOMPSON", "WHITE", "HARRIS", "SANCHEZ", "CLARK",
    "RAMIREZ", "LEWIS", "ROBINSON", "WALKER", "YOUNG", "ALLEN", "KING",
    "WRIGHT", "SCOTT", "TORRES", "NGUYEN", "HILL", "FLORES", "GREEN",
    "ADAMS", "NELSON", "BAKER", "HALL", "RIVERA", "CAMPBELL", "MITCHELL",
    "CARTER", "ROBERTS",
]

# An owner is an entity when one of these appears as " tok " or " tok."
ENTITY_TOKENS = [
    "LLC", "L.L.C", "L L C", "INC", "INCORPORATED", "CORP", "CORPORATION",
    "CO.", "COMPANY", "TRUST", "TRUSTEE", "LP", "LLP", "L.P", "L.L.P",
    "PLLC", "PA", "P.A", "ASSOCIATES", "ASSOCIATION", "ASSOC", "FOUNDATION",
    "LIMITED", "PARTNERS", "PARTNERSHIP", "ESTATE OF",
]

# An entity owner is a likely landlord when one of these is a substring.
LANDLORD_TOKENS = [
    "RENTAL", "RENTALS", "PROPERTIES", "PROPERTY", "HOLDINGS", "INVESTMENTS",
    "REALTY", "REAL ESTATE", "HOMES", "RE LLC", "REI", "GROUP",
]

NAME_SUFFIXES = ["JR", "SR", "II", "III", "IV", "V"]

# Recorded-instrument type text -> code. Exact lookup first; otherwise the
# FIRST key in this order that is contained in the text wins.
DOCTYPE_CODES = [
    ("dot", "dot"), ("deed of trust", "dot"), ("deed_of_trust", "dot"),
    ("asgn", "asgn"), ("assignment", "asgn"), ("assignment of dot", "asgn"),
    ("assignment of deed of trust", "asgn"), ("assn", "asgn"),
    ("sub_trustee", "sub_trustee"), ("substitute trustee", "sub_trustee"),
    ("notice of substitute trustee sale", "sub_trustee"),
    ("judgment", "judgment"), ("abstract of judgment", "judgment"),
    ("memo of judgment", "judgment"), ("memorandum of judgment", "judgment"),
    ("mechanics_lien", "mechanics_lien"), ("mechanics lien", "mechanics_lien"),
    ("claim of lien", "mechanics_lien"),
    ("qcd", "quitclaim"), ("quitclaim", "quitclaim"), ("quitclaim deed", "quitclaim"),
    ("quit claim deed", "quitclaim"),
    ("lis_pendens", "lis_pendens"), ("lis pendens", "lis_pendens"),
    ("notice of lis pendens", "lis_pendens"),
    ("satisfaction", "satisfaction"), ("release of lien", "satisfaction"),
    ("lien release", "satisfaction"),
]

# CSV header aliases for instrument import; first alias present wins.
INSTRUMENT_ALIASES = [
    ("recorded_date", ["recorded_date", "date", "record_date", "filing_date"]),
    ("instrument_id", ["instrument_id", "doc_id", "instrument", "document"]),
    ("book", ["book", "deed_book", "bk"]),
    ("page", ["page", "deed_page", "pg"]),
    ("doc_type", ["doc_type", "type", "instrument_type", "document_type"]),
    ("grantor", ["grantor", "from", "from_party"]),
    ("grantee", ["grantee", "to", "to_party"]),
    ("legal_description", ["legal_description", "legal", "description"]),
    ("pid", ["parcel_id", "pid", "parcel", "tax_id"]),
    ("amount", ["amount", "consideration", "value"]),
]

# Pattern weights of raw_score and the sub-flag points.
PATTERN_WEIGHTS = {"jfc": 25, "tax": 20, "estate": 20, "code": 12, "lien": 12, "transfer": 10}
ABSENTEE_POINTS = 5
VALUE_OVER_500K_POINTS = 4
DEMOLITION_POINTS = 8
VACANT_POINTS = 4
HEIRS_POINTS = 6
HEIRS_OWNER_TYPES = ["INDIVIDUAL", "I", ""]
HIGH_VALUE = 500000.0

# distress_score parts.
DISTRESS_PER_PATTERN = 10
DISTRESS_FLAG_CAP = 20
DISTRESS_ABSENTEE = 5
DISTRESS_SENIOR = 5
DISTRESS_EQUITY = 5
DISTRESS_EQUITY_MIN = 50.0
DISTRESS_YEARS = 3
DISTRESS_YEARS_MIN = 20.0

# Transfer rules: recent sale window, nominal price, share of value,
# estate-then-sale window (days).
TRANSFER_RECENT_DAYS = 730
TRANSFER_NOMINAL_PRICE = 1000.0
TRANSFER_VALUE_SHARE = 0.05
TRANSFER_ESTATE_DAYS = 548

# Signals kept per pattern in a lead record.
SIGNAL_CAP_PER_PATTERN = 3

# Valid epoch-millisecond range for sale dates (exclusive bounds).
MAX_EPOCH_MS = 4102444800000

# Estate posted-date formats, tried in order (Spark datetime patterns).
POSTED_DATE_FORMATS = ["yyyy-M-d", "MMM d, yyyy", "M/d/yyyy", "MMMM d, yyyy"]

# Signal recency key: first non-empty of these payload fields, as text.
RECENCY_FIELDS = ["posted", "auction", "saledate", "created", "closed"]

# Parcel link prefix.
PARCEL_URL_PREFIX = "https://polaris3g.mecklenburgcountync.gov/?taxid="

# County kept by the notice feeds (lower case).
DEFAULT_COUNTY = "mecklenburg"

# Notice classifier phrases (first rule that matches wins).
TAX_PHRASE = "TAX FORECLOSURE"
COUNTY_PLAINTIFF = ("MECKLENBURG COUNTY", "PLAINTIFF")
COUNTY_VERSUS = ["MECKLENBURG COUNTY V", "MECKLENBURG COUNTY VS"]
HOA_PHRASES = ["HOA", "HOMEOWNERS ASSOC", "HOMEOWNER'S ASSOC"]

# Instrument feeds: code -> (pattern it feeds or None, signal source, flag,
# default doc_type label, whether the pattern fires).
INSTRUMENT_RULES = {
    "judgment": ("lien", "judgment", None, "judgment", True),
    "mechanics_lien": ("lien", "mechanics_lien", None, "mechanics_lien", True),
    "lis_pendens": ("lien", "lis_pendens", None, "lis_pendens", True),
    "quitclaim": ("transfer", "rod_quitclaim", None, "QUITCLAIM", True),
    "dot": ("jfc", "rod_dot", "rod_dot_present", "DOT", False),
    "asgn": ("jfc", "rod_asgn", "rod_servicer_change", "ASGN", False),
    "sub_trustee": ("jfc", "rod_sub_trustee", "rod_substitute_trustee", "SUB_TRUSTEE", True),
    "satisfaction": (None, None, "rod_satisfaction_filed", None, False),
}
# Instrument feeds in attachment order (drives the signal sequence).
INSTRUMENT_ORDER = ["judgment", "mechanics_lien", "lis_pendens", "quitclaim",
                    "dot", "asgn", "sub_trustee", "satisfaction"]
