"""Hand-made tables for edge cases (FIXTURES.md section 3)."""

from histlens.schema import ATTRS, HISTORY, REPORTS
from histlens.sources.tables import Tables


def make_tables(spark, reports, logs):
    """reports: list of (id, resolution, status, opening, reporter);
    logs: {attr: [(id, what, ts, who), ...]} (missing attrs empty)."""
    r = spark.createDataFrame(reports, REPORTS)
    hs = {a: spark.createDataFrame(logs.get(a, []), HISTORY) for a in ATTRS}
    return Tables(r, hs)


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
