"""Fixed schemas, attribute names and parameter defaults."""

from __future__ import annotations

from pyspark.sql import types as T

REPORTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("current_resolution", T.StringType(), True),
    T.StructField("current_status", T.StringType(), True),
    T.StructField("opening", T.LongType(), True),
    T.StructField("reporter", T.LongType(), True),
])

# One attribute change log.  ``ts`` is the column called "when" in the raw
# files (epoch seconds); "when" is a SQL keyword.
HISTORY = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("what", T.StringType(), True),
    T.StructField("ts", T.LongType(), True),
    T.StructField("who", T.LongType(), True),
])

# The long history: all change logs in one table, partitioned by ``attr``.
LONG_HISTORY = T.StructType([T.StructField("attr", T.StringType(), False)] + HISTORY.fields)

# --- fixed values: attribute names and the source sets of the features ----
ATTRS = (
    "assigned_to", "status", "cc", "component", "op_sys", "priority",
    "product", "resolution", "severity", "short_desc", "version",
)
# actors of a bug: reporter + these (no cc)
PEOPLE_ATTRS = (
    "assigned_to", "priority", "component", "op_sys", "product", "severity",
    "status", "resolution", "short_desc", "version",
)
# event times for the "first day" / "one week" flags: opening + these (no status)
TIME_ATTRS = (
    "assigned_to", "cc", "component", "op_sys", "priority", "product",
    "severity", "short_desc", "version", "resolution",
)
# attribute updates: opening + these
UPDATE_ATTRS = ("priority", "component", "op_sys", "product", "severity", "short_desc", "version")

# --- fixed values: parameter defaults -------------------------------------
DEFAULT_CUTOFF = 1304813581          # 2011-05-08 00:13:01 UTC, newest entry of the original data
DEFAULT_MAX_DAYS = 100               # "recent" NEW bugs: (cutoff - ts) div 86400 <= 100
DEFAULT_HI_MINUTES = 1401            # first day: 0 < minutes < 1401
DEFAULT_WEEK_MINUTES = 9801          # one week: minutes > 9801
DEFAULT_FIRST_K = 7                  # software birthday: max of the 7 earliest
DEFAULT_COMPONENT_MIN_CASES = 1000   # rarer components -> 'Other'

# Parameters on the driver's test data (FIXTURES.md section 2).
TESTDATA_MAX_DAYS = 1000
TESTDATA_HI_MINUTES = 4321
