
import __spark_entry__ as E
from histlens.plans.features import FEATURES

SURVEY_QUERIES = [
    "repair_records", "base_sample", "latest_by", "first_by", "value_as_of", "os_category",
    "component_category", "priority_category", "severity_category", "version_category", "master_table",
    "value_frequency", "distinct_pairs", "holdout_split", "nb_fit", "nb_predict", "nb_final_auc",
    "nb_subset_search", "top_models", "roc_curve",
] + [f"feat_{n}" for n in FEATURES]


def test_survey_queries_registered_with_oracles():
    q, o = E.queries(), E.oracle_sql()
    missing = [n for n in SURVEY_QUERIES if n not in q or n not in o]
    assert not missing, missing
    assert len(FEATURES) == 30
