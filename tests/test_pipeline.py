"""End to end from CSV files: the same wide table as the registry's plan."""

import os

import pytest
from helpers import rows
from pyspark.sql import functions as F

from histlens.plans.pipeline import run
from histlens.plans.registry import master_materialised, raw_tables
from histlens.sources.csv import write_csv

SF = "/root/testdata/sf0.001"


def test_pipeline_from_csv_files(spark, tmp_path):
    raw = raw_tables(spark, SF)
    csv = tmp_path / "csv"
    files = {}
    for a, h in raw.logs.items():
        files[a] = f"{a}.csv"
        write_csv(h.select("id", "what", F.col("ts").alias("when"), "who"), str(csv / files[a]))
    write_csv(raw.reports, str(csv / "reports.csv"))
    res = run(spark, str(csv), str(tmp_path / "out"), repair={}, files=files,
              cutoff=None, max_days=1000, hi_minutes=4321, feature_tables=True)
    assert rows(res["master_table"]) == rows(master_materialised(spark, SF))
    assert res["model_search"].count() == 200
    assert 0.0 <= res["final_auc"].first()["auc"] <= 1.0
    assert os.path.isdir(tmp_path / "out" / "master_table")
    assert len([k for k in res if k.startswith("features/")]) == 30
    from histlens.plans.registry import queries
    assert rows(res["features/team_work"]) == rows(queries()["feat_team_work"](spark, SF))
    for name in ("os", "component", "version", "priority", "severity"):
        assert rows(res[f"categories/{name}"]) == rows(queries()[f"{name}_category"](spark, SF)), name
        assert os.path.isdir(tmp_path / "out" / "categories" / name)
    left = [d for d, _, _ in os.walk(tmp_path / "out") if ".new-" in d or ".old-" in d]
    assert not left


def test_a_table_is_replaced_whole_or_not_at_all(spark, tmp_path):
    from histlens.sources.store import materialise
    path = str(tmp_path / "t")
    first = materialise(spark.range(5), "t", path)
    assert sorted(r.id for r in materialise(first.selectExpr("id + 10 AS id"), "t", path).collect()) == [10, 11, 12, 13, 14]
    bad = spark.range(5).select(F.raise_error(F.lit("broken row")).alias("id"))
    with pytest.raises(Exception, match="broken row"):
        materialise(bad, "t", path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [10, 11, 12, 13, 14]
    assert os.listdir(tmp_path) == ["t"]
