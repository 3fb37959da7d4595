"""Column-level helpers (all JVM-side built-ins, no Python UDF)."""

from histlens.functions.scalar import (  # noqa: F401
    int_div, leading_number, ordered_buckets, epoch_year, epoch_month, minutes_since,
)
