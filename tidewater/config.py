"""Fixed scenario values.

The driver tables are a single snapshot, so the two pipeline runs that the
warehouse is built from are fixed here (see README, "Scenario").  Queries take
these as constants because ``CURRENT_DATE`` cannot be checked against an
oracle.
"""

from __future__ import annotations

import datetime as dt

# --- fixed values -----------------------------------------------------------
# Start of time for a table without a mark (the reference's seed value).
EPOCH_MARK = "1900-01-01 00:00:00"
# Open end of a current dimension version.
OPEN_END = "9999-12-31"
# Orders placed before this instant exist in the source at run 1.
RUN1_CUT = "1999-01-01 00:00:00"
# "Today" and batch timestamp of the two runs.
RUN1_DAY = dt.date(1999, 1, 1)
RUN1_TS = "1999-01-01 06:00:00"
RUN2_DAY = dt.date(2001, 11, 5)
RUN2_TS = "2001-11-05 06:00:00"
# As-of date for metrics that use CURRENT_DATE (velocity, recency, freshness).
AS_OF_DAY = RUN2_DAY
AS_OF_TS = RUN2_TS
# Sales report period (both ends included).
REPORT_START = dt.date(1998, 1, 1)
REPORT_END = dt.date(1998, 12, 31)
# Snapshot rules: customers with id % 13 = 0 appear only at run 2; at run 2
# customers with id % 7 = 0 move to the next nation.  Products with
# id % 17 = 0 appear only at run 2; at run 2 products with id % 11 = 0 get a
# revised name.
NEW_CUSTOMER_MOD = 13
MOVED_CUSTOMER_MOD = 7
NEW_PRODUCT_MOD = 17
RENAMED_PRODUCT_MOD = 11
RENAMED_SUFFIX = " (rev 2)"
NATION_COUNT = 25
# Default customer / product created_at when nothing else is known.
DEFAULT_CREATED = "1995-01-01 00:00:00"
# Velocity window and top-n defaults of the reference functions.
VELOCITY_DAYS = 30
TOP_N = 10
TOP_GROUPS = 5
RECENT_RUNS = 100
# Calendar window around "today": 2 years back, 1 year ahead.
CALENDAR_YEARS_BACK = 2
CALENDAR_YEARS_AHEAD = 1
# Run-log mapping of the events table.
RUN_LOG_JOBS = 10
RUNNING_EVERY = 10
RUN_LOG_PREFIX = "job_"
LIKE_PATTERN = "job_1%"
