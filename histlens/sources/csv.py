"""IO1/D2: load the raw CSV files (header line, all columns text) into typed frames.

Fields may be quoted, hold doubled quotes, commas and line breaks; a quote inside an
unquoted field is a character.  ``quotes.records`` finds the records: a quote automaton is composed over
the splits of a file, so that a big file stays splittable (the reader's multi-line mode would
read it in one task) and records of one line never leave their split.  A field that nothing closes makes
its own line a reject; the lines after it are read as rows again, at any distance.

Columns are taken by the names of the header line; a missing one is an error.  Ids and
epoch seconds are cast on purpose (bad text -> NULL, never an error), empty text
fields are kept as ``''`` (an open bug's resolution is the empty string, not NULL, and
must pass ``<> 'DUPLICATE'``).  Rows without a numeric id, with a field count that
differs from the header's or with an unclosed quote go to the rejects.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlens.schema import ATTRS
from histlens.sources.quotes import records
from histlens.sources.repair import load_repaired
from histlens.sources.tables import Tables

HISTORY_COLUMNS = ["id", "what", "when", "who"]
REPORTS_COLUMNS = ["id", "current_resolution", "current_status", "opening", "reporter"]
CORRUPT = "_corrupt_record"

# --- fixed values: file name of each attribute log --------------------------
DEFAULT_FILES = {
    "assigned_to": "assigned_to.csv", "status": "bug_status.csv", "cc": "cc_changed.csv",
    "component": "component.csv", "op_sys": "op_sys.csv", "priority": "priority.csv",
    "product": "product.csv", "resolution": "resolution.csv", "severity": "severity.csv",
    "short_desc": "short_desc_changed.csv", "version": "version.csv",
}
REPORTS_FILE = "reports.csv"
# raw files that need the repair job first (their repaired copies are the *_changed files above)
REPAIR_FILES = {"cc": "cc.csv", "short_desc": "short_desc.csv"}


def header_names(spark: SparkSession, path: str) -> list[str]:
    """The column names in the header line of the first file under ``path``."""
    line = spark.read.text(path).first()
    return [] if line is None else [c.strip() for c in next(csv.reader([line[0].lstrip("\ufeff")]))]


def _read(spark: SparkSession, path: str, columns: list[str], folder: str | None) -> tuple[DataFrame, DataFrame]:
    """The named columns as text, and the rejects (file, position, text, reason)."""
    names = header_names(spark, path)
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {names}")
    schema = ", ".join(f"`_c{i}` STRING" for i in range(len(names))) + f", `{CORRUPT}` STRING"
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "unescapedQuoteHandling": "STOP_AT_CLOSING_QUOTE"}
    rec = records(spark, path, folder).filter("NOT first AND trim(record) <> ''")
    parsed = rec.withColumn("_r", F.from_csv("record", schema, options))
    reason = (F.when(F.col("unclosed"), "unclosed quote").when(F.col(f"_r.{CORRUPT}").isNotNull(), "wrong number of fields")
              .when(F.col(f"_r._c{names.index('id')}").try_cast("bigint").isNull(), "id is not a number"))
    parsed = parsed.withColumn("reason", reason)
    rows = parsed.filter("reason IS NULL").select(*[F.col(f"_r._c{names.index(c)}").alias(c) for c in columns])
    return rows, parsed.filter("reason IS NOT NULL").select("file", "position", F.col("record").alias("text"), "reason")


def load_history(spark: SparkSession, path: str, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One attribute log as ``(id, what, ts, who)``, and its rejects; both read the lines stored under ``folder``."""
    h, bad = _read(spark, path, HISTORY_COLUMNS, folder)
    return h.select(F.col("id").try_cast("bigint").alias("id"),
                    F.coalesce(F.col("what"), F.lit("")).alias("what"),
                    F.col("when").try_cast("bigint").alias("ts"),
                    F.col("who").try_cast("bigint").alias("who")), bad


def load_reports(spark: SparkSession, path: str, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    r, bad = _read(spark, path, REPORTS_COLUMNS, folder)
    return r.select(F.col("id").try_cast("bigint").alias("id"),
                    F.coalesce(F.col("current_resolution"), F.lit("")).alias("current_resolution"),
                    F.coalesce(F.col("current_status"), F.lit("")).alias("current_status"),
                    F.col("opening").try_cast("bigint").alias("opening"),
                    F.col("reporter").try_cast("bigint").alias("reporter")), bad


def load_csv_tables(spark: SparkSession, folder: str, files: dict[str, str] | None = None,
                    reports_file: str = REPORTS_FILE, repair: dict[str, str] | None = None,
                    stages: str | None = None) -> tuple[Tables, DataFrame]:
    """D2: the 12 raw files as Tables (then ``store.ingest`` writes Parquet), and all
    rejects as (log, file, position, text, reason).  Every file is read once, into lines
    stored under ``stages`` (the session's shared folder if None).

    ``repair`` maps attributes to raw files that go through the D1 repair job
    instead of the CSV reader (e.g. ``REPAIR_FILES``)."""
    files = files or DEFAULT_FILES
    repair = repair or {}
    logs, rejects = {}, None
    for a in [*ATTRS, "reports"]:
        if a == "reports":
            got, bad = load_reports(spark, f"{folder}/{reports_file}", stages and f"{stages}/reports")
        elif a in repair:
            got, bad = load_repaired(spark, f"{folder}/{repair[a]}", stages and f"{stages}/{a}")
        else:
            got, bad = load_history(spark, f"{folder}/{files[a]}", stages and f"{stages}/{a}")
        logs[a] = got
        bad = bad.select(F.lit(a).alias("log"), "file", "position", "text", "reason")
        rejects = bad if rejects is None else rejects.unionByName(bad)
    reports = logs.pop("reports")
    return Tables(reports, logs), rejects


def write_csv(df: DataFrame, path: str) -> None:
    """Write a frame as one folder of CSV parts with a header (overwrite); quotes are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
