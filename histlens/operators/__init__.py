"""Generic DataFrame operators over entity histories (column names are parameters)."""

from histlens.operators.core import (  # noqa: F401
    latest_by, first_by, value_as_of, keep_with, drop_with, count_per, ever,
    any_in_range, sum_length, distinct_events, distinct_count, value_frequency,
    distinct_pairs, dense_group_id, dense_group_ids, first_k_max, actors_per_entity,
    team_rate, top_n_by,
)
from histlens.operators.prefix import prior_rate  # noqa: F401
