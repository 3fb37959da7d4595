"""Sources and sinks: raw CSV load, CSV repair, Parquet tables, test-data adapters."""

from histlens.sources.tables import Tables  # noqa: F401
