"""Fixed values that must equal the source pipeline's for identical results.

FIXED VALUES — stated plainly, in natural order, kept together here.
"""

# FIXED VALUES: US state code -> state name (51 entries).
US_STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas",
    "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware",
    "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho",
    "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas",
    "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi",
    "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada",
    "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma",
    "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island",
    "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee",
    "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia",
    "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin",
    "WY": "Wyoming", "DC": "District of Columbia",
}

# FIXED VALUES: bank names kept fully upper case.
BANK_ACRONYMS = [
    "BDO", "BPI", "PNB", "DBP", "RCBC", "UCPB",
    "CHINABANK", "METROBANK", "MAYABANK",
    "ROBINSONSBANK", "SECURITYBANK", "EASTWEST",
]

# FIXED VALUES: text tokens that mean "no value" for product type.
NULL_TOKENS = ["", "nan", "none", "null", "n/a", "<na>"]

# FIXED VALUES: columns never loaded into the raw layer.
SENSITIVE_COLUMNS = ["credit_card_number", "cvv", "password", "social_security_number"]

# FIXED VALUES: fixed-date holidays (month, day, name).
FIXED_HOLIDAYS = [
    (1, 1, "New Year's Day"),
    (5, 1, "International Workers' Day"),
    (12, 25, "Christmas Day"),
]

# FIXED VALUES: calendar range of the date dimension.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"

# FIXED VALUES: default country for a missing one.
DEFAULT_COUNTRY = "United States"

# FIXED VALUES: data-quality thresholds.
MAX_MISSING_RATIO = 0.30
MAX_FAILED_LOOKUP_RATIO = 0.10
MAX_UNPARSED_DATE_RATIO = 0.05
