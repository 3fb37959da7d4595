"""histlens: entity-history analytics on Spark DataFrames.

Snapshot table + attribute change logs -> population, category dimensions,
per-entity features, one wide feature table, Naive Bayes model search.
"""

from histlens.session import get_spark  # noqa: F401
