"""Fixed values that must equal the source pipeline's for identical results.

FIXED VALUES — do not edit, reorder or re-encode.  They are business facts of
the sales pipeline this library reproduces (spellings of country names seen in
the exports, segment aliases, accepted category values and quarantine rule
names), stated here plainly and together.
"""

from __future__ import annotations

# --- FIXED VALUES: country spellings (upper-cased, dots removed) -> ISO alpha-2
# Names that have no alpha-2 code (Somaliland, South Ossetia, Abkhazia,
# Northern Cyprus) are not listed: they pass through unchanged, as does any
# other unknown spelling.
COUNTRY_SPELLINGS = {
    "CA": "CA",
    "CANADA": "CA",
    "DE": "DE",
    "DEUTSCHLAND": "DE",
    "GERMANY": "DE",
    "ES": "ES",
    "ESPAÑA": "ES",
    "SPAIN": "ES",
    "FR": "FR",
    "FRANCE": "FR",
    "GB": "GB",
    "UK": "GB",
    "UNITED KINGDOM": "GB",
    "JP": "JP",
    "JAPAN": "JP",
    "US": "US",
    "USA": "US",
    "UNITED STATES": "US",
    "UNITED STATES OF AMERICA": "US",
}

# --- FIXED VALUES: customer segment aliases (after clean_text)
SEGMENT_ALIASES = {
    "corp": "corporate",
    "homeoffice": "home office",
}

# --- FIXED VALUES: accepted values of the cleaned categorical columns
ACCEPTED_SEGMENTS = ["consumer", "home office", "unknown", "corporate"]
ACCEPTED_CATEGORIES = ["furniture", "office supplies", "technology", "unknown"]
ACCEPTED_CHANNELS = ["online", "partner", "retail", "unknown"]

# --- FIXED VALUES: defaults of the loading and incremental logic
FX_INITIAL_DATE = "2024-01-01"       # first FX date requested on an empty target
INCREMENTAL_LOOKBACK_DAYS = 3        # lookback of the incremental upsert
WATERMARK_FLOOR = "1900-01-01 00:00:00"  # watermark of an empty target
UNKNOWN_ID = -1
UNKNOWN_KEY = "-1-unknown"
UNKNOWN_VALID_FROM = "1900-01-01"
CALENDAR_HORIZON_YEARS = 5           # calendar runs to max(order_date) + 5 years
EXCEL_EPOCH = "1899-12-30"           # day 0 of spreadsheet serial dates

# --- FIXED VALUES: freshness thresholds in hours (warn, error)
FRESHNESS_SALES = (6, 12)
FRESHNESS_FX = (24, 36)
