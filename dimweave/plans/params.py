"""Parameters of the registered queries (periods, days, thresholds).

They play the role of the constants a person edits in the reference's
scripts before each load; FIXTURES.md fixes them for the test tables.
"""

# Date lists (events cover 2024-01-01 .. 2024-01-30 at every scale factor).
ASOF = "2024-01-30"
ASOF_PREV = "2024-01-29"
SERIES_START = "2024-01-01"

# Monthly metric arrays.
MONTH_START = "2024-01-01"
METRIC_DAY = "2024-01-30"
METRIC_DAY_PREV = "2024-01-29"

# Cumulative table and type-2 history (orders run 1995 .. 2001).
FIRST_PERIOD = 1995
LAST_PERIOD = 2001
SCD_BASE = 2000          # full history up to this period ...
SCD_NEXT = 2001          # ... then one incremental step
AS_OF_PERIOD = 1998
LOOKUP_PLAYER = "1016"

# Fact table: one game day for the feature query, markers in comments.
FACT_DAY = "1997-08-23"
MARKERS = {  # fixed values: stand-ins for DNP / DND / NWT in the comment text
    "dim_did_not_play": "anvil",
    "dim_did_not_dress": "bolt",
    "dim_not_with_team": "plate",
}

# Matches: one completion date.
MATCH_DAY = "1997-08-23"

# Audits: film-permit boroughs expected after dropping 'error'.
EXPECTED_BOROUGHS = ["click", "purchase", "signup", "view"]
DROPPED_BOROUGH = "error"

# Collected lists are dealt into this many buckets.
LIST_BUCKETS = 4
