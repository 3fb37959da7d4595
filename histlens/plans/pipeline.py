"""The whole job, raw CSV files to feature table and model search.

``run(spark, csv_folder, out)``: repair the broken logs and load the others
(D1, IO1), ingest to Parquet (D2), base sample (D3), category tables (D4-D8), wide
table (F1-F31), then the Naive Bayes stage (ML1-ML9).  Every result is written under
``out`` (Parquet, replacing the table of an earlier run once complete) and returned as
read-back DataFrames.

    python -m histlens.plans.pipeline CSV_FOLDER OUT_FOLDER [--cutoff N] [--max-days N]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from histlens.plans import categories as C
from histlens.plans import features as FT
from histlens.plans.master import master_table
from histlens.plans.model import (
    SEARCH_FEATURES, final_auc, nb_fit, nb_subset_search, random_subsets, top_models,
    train_test,
)
from histlens.plans.population import base_sample, latest_status_cutoff
from histlens.schema import DEFAULT_CUTOFF, DEFAULT_HI_MINUTES, DEFAULT_MAX_DAYS, DEFAULT_WEEK_MINUTES
from histlens.session import configure
from histlens.sources.csv import load_csv_tables
from histlens.sources.store import drop_folder, ingest, materialise, write_feature
from histlens.sources.tables import Tables


def category_tables(t: Tables) -> dict[str, DataFrame]:
    """D4-D8: the five tables from raw values to categories."""
    return {"os": C.os_category(t.h("op_sys")), "component": C.component_category(t.h("component")),
            "version": C.version_category(t.h("version"), t.h("product")),
            "priority": C.priority_category(t.h("priority")), "severity": C.severity_category(t.h("severity"))}


def run_tables(t: Tables, out: str, cutoff: int | None = DEFAULT_CUTOFF, max_days: int = DEFAULT_MAX_DAYS,
               hi_minutes: int = DEFAULT_HI_MINUTES, week_minutes: int = DEFAULT_WEEK_MINUTES,
               search: bool = True, feature_tables: bool = False) -> dict[str, DataFrame]:
    """Base sample, category tables (``out/categories/<name>``), wide table and model
    stage over already ingested tables.
    ``cutoff=None`` takes the newest status time; ``feature_tables`` also
    stores each of the 30 feature tables under ``out/features/<name>``."""
    cut = latest_status_cutoff(t.h("status")) if cutoff is None else cutoff
    res: dict[str, DataFrame] = {}
    base = materialise(base_sample(t.reports, t.h("status"), t.h("severity"), cutoff=cut, max_days=max_days),
                       "base", f"{out}/base_sample")
    res["base_sample"] = base
    for name, df in category_tables(t).items():
        res[f"categories/{name}"] = write_feature(df, name, f"{out}/categories")
    if feature_tables:
        for name, fn in FT.FEATURES.items():
            kw = {"hi_minutes": hi_minutes} if name == "is_mod_within_first_day" else (
                {"week_minutes": week_minutes} if name == "is_open_for_one_week_or_more" else {})
            res[f"features/{name}"] = write_feature(fn(t, base, **kw), name, f"{out}/features")
    master = materialise(master_table(t, base, hi_minutes=hi_minutes, week_minutes=week_minutes, folder=f"{out}/_stages"),
                         "master", f"{out}/master_table")
    drop_folder(master.sparkSession, f"{out}/_stages")
    res["master_table"] = master
    if search:
        train, test = train_test(master)
        model = materialise(nb_fit(train, SEARCH_FEATURES), "model", f"{out}/model")
        trials = materialise(nb_subset_search(train, test, random_subsets(), model=model),
                             "trials", f"{out}/model_search")
        res["model_search"] = trials
        res["top_models"] = top_models(trials, 10)
        res["final_auc"] = materialise(final_auc(train, test), "final", f"{out}/final_auc")
    return res


def run(spark: SparkSession, csv_folder: str, out: str, repair: dict[str, str] | None = None,
        files: dict[str, str] | None = None, **kw) -> dict[str, DataFrame]:
    """Raw CSV files -> written tables and results under ``out``."""
    configure(spark)
    from histlens.sources.csv import REPAIR_FILES

    raw, rejects = load_csv_tables(spark, csv_folder, files, repair=REPAIR_FILES if repair is None else repair,
                                   stages=f"{out}/_repair")
    rejects = materialise(rejects, "rejects", f"{out}/rejects")
    t = ingest(raw, f"{out}/tables")
    drop_folder(spark, f"{out}/_repair")
    return {"rejects": rejects, **run_tables(t, out, **kw)}


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("csv_folder")
    ap.add_argument("out")
    ap.add_argument("--cutoff", type=int, default=DEFAULT_CUTOFF, help="epoch seconds; -1 = newest status time")
    ap.add_argument("--max-days", type=int, default=DEFAULT_MAX_DAYS)
    ap.add_argument("--hi-minutes", type=int, default=DEFAULT_HI_MINUTES)
    a = ap.parse_args()
    spark = SparkSession.builder.appName("histlens").getOrCreate()
    res = run(spark, a.csv_folder, a.out, cutoff=None if a.cutoff < 0 else a.cutoff, max_days=a.max_days,
              hi_minutes=a.hi_minutes)
    res["top_models"].show(truncate=False)
    res["final_auc"].show()


if __name__ == "__main__":
    main()
