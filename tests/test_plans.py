"""Plan checks on the wide table and the model search."""

import re

import pytest

from histlens.plans.master import MASTER_COLUMNS, bug_stats, modified_early
from histlens.plans.registry import setup
from histlens.plans.registry import queries

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_master_shape_and_unique_ids(spark):
    m = queries()["master_table"](spark, SF)
    assert m.columns == MASTER_COLUMNS and len(MASTER_COLUMNS) == 45
    assert m.count() == m.select("id").distinct().count()


def test_no_cartesian_no_python_in_features(spark):
    t, b = setup(spark, SF)
    p = _plan(bug_stats(t)) + _plan(modified_early(t, b, 4321))
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin"):
        assert bad not in p


def test_partition_pruning_on_ingested_history(spark):
    t, _ = setup(spark, SF)
    p = t.h("status")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(attr" in p and "status" in p


def test_ingest_reads_lineitem_once(spark):
    from histlens.plans.registry import raw_tables
    t = raw_tables(spark, SF)
    assert _plan(t.history).count("FileScan") == 1
    for a in ("status", "short_desc"):
        assert t.hs([a]).drop("attr").exceptAll(t.h(a)).isEmpty() and t.h(a).exceptAll(t.hs([a]).drop("attr")).isEmpty()


def test_subset_search_repeats_no_row(spark):
    p = _plan(queries()["nb_subset_search"](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "Generate" not in p and p.count("MapInArrow") == 1


def test_team_rate_has_no_window(spark):
    assert "Window" not in _plan(queries()["feat_team_work"](spark, SF))


def test_team_rate_reads_the_pairs_through_one_exchange(spark):
    """The pairs are never joined back to their bugs, and both counts share their exchange."""
    df = queries()["feat_team_work"](spark, SF)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in p
    assert p.count("Join") == 1                                  # base and its reporter's rate


def test_team_rate_equals_the_definition(spark):
    """Shared and lone entities, an unknown actor, an actor of nothing but lone entities."""
    from histlens.operators import actors_per_entity, team_rate
    pairs = [(1, 10), (1, 11), (2, 10), (3, 10), (3, None), (4, None), (5, 12), (6, 13), (6, 10), (None, 10), (None, 14), (7, 14)]
    df = spark.createDataFrame(pairs, "id long, who long")
    size = {}
    for i, _ in pairs:
        size[i] = size.get(i, 0) + 1
    want = {w: sum(size[i] > 1 for i, x in pairs if x == w) / sum(x == w for _, x in pairs) for _, w in pairs}
    assert {r.who: r.teamWorkRate for r in team_rate(df).collect()} == want
    assert {r.who: r.teamWorkRate for r in team_rate(df, actors=actors_per_entity(df)).collect()} == want
    assert team_rate(df.limit(0)).collect() == []


def test_master_invariant_under_repartitioned_inputs(spark):
    """Metamorphic: shuffled input partitioning gives the same wide table."""
    from helpers import rows
    from pyspark.sql import functions as F

    from histlens.plans.master import master_table
    from histlens.sources.tables import Tables
    t, b = setup(spark, SF)
    shuffled = Tables(t.reports.repartition(5, F.rand(1)),
                      {a: h.repartition(7, F.rand(2)) for a, h in t.logs.items()})
    assert rows(master_table(t, b, hi_minutes=4321)) == rows(master_table(shuffled, b.repartition(3), hi_minutes=4321))


STRICT = ["master_table", "version_category", "feat_version", "roc_curve_rate", "auc", "holdout_split_exact", "nb_fit", "nb_predict",
          "nb_subset_search", "feat_team_work", "feat_success_rate_reporter", "repair_records"]


@pytest.mark.parametrize("name", STRICT)
def test_single_partition_only_under_a_global_aggregate(spark, name):
    """A one-task exchange carries partial aggregates of a global aggregate and nothing else."""
    from histlens.plans.master import master_table
    df = queries()[name](spark, SF)
    if name == "master_table":
        df = master_table(*setup(spark, SF), hi_minutes=4321)
    lines = [re.sub(r"^[\s:+\-]*", "", x) for x in _plan(df).split("\n")]
    for i, line in enumerate(lines):
        if line.startswith("Exchange SinglePartition"):
            below = lines[i + 1]
            assert "Aggregate" in below and "keys=[]" in below and "partial_" in below, (line, below)


def test_recommended_conf_scales_with_input():
    from histlens.session import recommended_conf
    small = recommended_conf(10 * 2**30, executor_cores=4, executors=10)
    big = recommended_conf(100 * 2**40, executor_cores=4, executors=1000)
    assert int(small["spark.sql.shuffle.partitions"]) == 80          # never fewer than 2x cores
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 * 2**20) + 1   # ~256 MB each
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"


def test_history_is_written_without_a_sort(spark, tmp_path):
    """A file is open per log while the history is written, and the session's setting is as before."""
    from types import SimpleNamespace

    from histlens.schema import ATTRS
    from histlens.sources.tables import WRITERS, write_tables
    seen = []

    class Writer:
        def __getattr__(self, name):
            return lambda *a: self

        def parquet(self, path):
            seen.append(int(spark.conf.get(WRITERS)))
    before, frame = spark.conf.get(WRITERS, None), SimpleNamespace(write=Writer())
    write_tables(SimpleNamespace(spark=spark, reports=frame, history=frame), str(tmp_path))
    assert seen[-1] > len(ATTRS) and spark.conf.get(WRITERS, None) == before


def test_stored_frames_are_not_underestimated(spark, tmp_path):
    """A narrow stored frame counts at least its rows' size in memory, so that it is not broadcast by its file's."""
    spark.range(200_000).coalesce(1).write.parquet(f"{tmp_path}/ids")
    plan = spark.read.parquet(f"{tmp_path}/ids")._jdf.queryExecution().optimizedPlan()
    assert int(str(plan.stats().sizeInBytes())) >= 200_000 * 16


def test_many_logs_are_read_from_the_mixed_table(spark):
    """The same rows as the logs' own folders, and what the logs say of one bug meets before the shuffle:
    far fewer partial rows than a bug has logs."""
    from pyspark.sql import functions as F

    from histlens.schema import ATTRS
    t, _ = setup(spark, SF)
    own = t.long.select("attr", "id", "what", "ts", "who")
    assert t.history.exceptAll(own).isEmpty() and own.exceptAll(t.history).isEmpty()
    assert "PartitionFilters: []" in _plan(t.history) and "mixed" in t.history.inputFiles()[0]
    assert all("history" in f for f in t.hs(ATTRS[:2]).inputFiles())
    met = t.history.withColumn("file", F.input_file_name()).groupBy("id").agg(F.countDistinct("file").alias("n"))
    assert met.agg(F.avg("n")).first()[0] < 2
