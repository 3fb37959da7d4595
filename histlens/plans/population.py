"""D3: the study population (base sample)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlens.functions import int_div
from histlens.operators import drop_with, keep_with, latest_by
from histlens.schema import DEFAULT_CUTOFF, DEFAULT_MAX_DAYS


def latest_status_cutoff(status: DataFrame) -> Column:
    """Newest status time as a lazy scalar subquery (the test-data cutoff)."""
    return status.agg(F.max("ts")).scalar()


def base_sample(reports: DataFrame, status: DataFrame, severity: DataFrame,
                cutoff: int | Column = DEFAULT_CUTOFF, max_days: int = DEFAULT_MAX_DAYS,
                products: list[str] | None = None, product: DataFrame | None = None) -> DataFrame:
    """Reports that are not duplicates, not recently opened ``NEW`` bugs, and
    whose latest severity exists and is not an enhancement.

    ``products`` (off by default, as in the original run) keeps only bugs whose
    latest product is in the list.
    """
    cut = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    last_status = latest_by(status, cols=["what", "ts"])
    recent_new = last_status.filter(
        (F.col("what") == "NEW") & (int_div(cut - F.col("ts"), 86400) <= max_days))
    last_sev = latest_by(severity, cols=["what"]).filter(F.col("what") != "enhancement")
    b = reports.filter(F.col("current_resolution") != "DUPLICATE")
    b = drop_with(b, recent_new)
    b = keep_with(b, last_sev)
    if products is not None and product is not None:
        b = keep_with(b, latest_by(product, cols=["what"]).filter(F.col("what").isin(products)))
    return b.select("id", "current_resolution", "current_status", "opening", "reporter")
