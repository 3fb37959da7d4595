"""Named queries over the driver's test tables (used by __spark_entry__, tests, bench)."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlens.operators import (
    distinct_pairs, first_by, latest_by, value_as_of, value_frequency,
)
from histlens.plans import categories as C
from histlens.plans import features as FT
from histlens.plans.master import master_table
from histlens.plans.population import base_sample, latest_status_cutoff
from histlens.schema import TESTDATA_HI_MINUTES, TESTDATA_MAX_DAYS
from histlens.session import app_id, configure
from histlens.sources.store import ingest, materialise, stage_root
from histlens.sources.testdata import testdata_tables

Query = Callable[[SparkSession, str], DataFrame]


_STAGES: dict = {}


def _prepare(spark: SparkSession) -> None:
    """The session's settings; a local session without a checkpoint folder gets one here."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if spark.sparkContext.master.split("[")[0] == "local":
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="histlens-ckpt-"))
    configure(spark)


def _input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, size and time of every input file: stored stages serve only these."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    path = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs, out, todo = path.getFileSystem(jsc.hadoopConfiguration()), [], [path]
    while todo:
        for f in fs.listStatus(todo.pop()):
            if f.isDirectory():
                todo.append(f.getPath())
            else:
                out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def raw_tables(spark: SparkSession, sf_dir: str):
    _prepare(spark)
    return testdata_tables(spark, sf_dir)


def compute_base(t):
    return base_sample(t.reports, t.h("status"), t.h("severity"),
                       cutoff=latest_status_cutoff(t.h("status")), max_days=TESTDATA_MAX_DAYS)


def setup(spark: SparkSession, sf_dir: str):
    """Ingested tables + stored base sample, once per session and state of the input files
    (the pipeline's first two stages; later stages read the written files)."""
    _prepare(spark)
    key = (app_id(spark), sf_dir, _input_state(spark, sf_dir))
    if key not in _STAGES:
        t = ingest(raw_tables(spark, sf_dir))
        b = materialise(compute_base(t), "base_sample")
        _STAGES[key] = (t, b)
    return _STAGES[key]


def _feature(name: str) -> Query:
    fn = FT.FEATURES[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        t, b = setup(spark, sf_dir)
        kw = {"hi_minutes": TESTDATA_HI_MINUTES} if name == "is_mod_within_first_day" else {}
        return fn(t, b, **kw)
    q.__name__ = f"feat_{name}"
    return q


def q_base_sample(spark, sf_dir):
    """D3 from the raw logs (not the stored copy)."""
    return compute_base(raw_tables(spark, sf_dir))


def q_latest_by(spark, sf_dir):
    t, _ = setup(spark, sf_dir)
    return latest_by(t.h("status"))


def q_first_by(spark, sf_dir):
    t, _ = setup(spark, sf_dir)
    return first_by(t.h("priority"))


def q_value_as_of(spark, sf_dir):
    t, _ = setup(spark, sf_dir)
    return value_as_of(t.reports.select("id", "opening"), t.h("assigned_to"))


def q_os_category(spark, sf_dir):
    t, _ = setup(spark, sf_dir)
    return C.os_category(t.h("op_sys"))


def q_component_category(spark, sf_dir):
    t, _ = setup(spark, sf_dir)
    return C.component_category(t.h("component"))


def q_priority_category(spark, sf_dir):
    t, _ = setup(spark, sf_dir)
    return C.priority_category(t.h("priority"))


def q_severity_category(spark, sf_dir):
    t, _ = setup(spark, sf_dir)
    return C.severity_category(t.h("severity"))


def q_version_category(spark, sf_dir):
    t, _ = setup(spark, sf_dir)
    return C.version_category(t.h("version"), t.h("product"))


def q_version_category_ranged(spark, sf_dir):
    """D6 with another number of ranges: the same ids."""
    t, _ = setup(spark, sf_dir)
    pairs = C.version_pairs(C.latest_version_product(t.h("version"), t.h("product")))
    return C.version_category_from_pairs(pairs, partitions=4)


def q_version_category_rule(spark, sf_dir):
    t, _ = setup(spark, sf_dir)
    return C.version_category(t.h("version"), t.h("product"), segment_mode="rule")


def q_value_frequency(spark, sf_dir):
    t, _ = setup(spark, sf_dir)
    return value_frequency(t.h("component"), "what")


def q_distinct_pairs(spark, sf_dir):
    t, _ = setup(spark, sf_dir)
    return distinct_pairs(C.latest_version_product(t.h("version"), t.h("product")), "Version", "Product")


def q_scan_status(spark, sf_dir):
    """IO3: whole log scan (``SELECT * FROM Status``)."""
    t, _ = setup(spark, sf_dir)
    return t.h("status")


def q_count_assigned_to(spark, sf_dir):
    """AG2: ``COUNT(*)`` without grouping."""
    t, _ = setup(spark, sf_dir)
    return t.h("assigned_to").agg(F.count(F.lit(1)).alias("n"))


def q_reports_os(spark, sf_dir):
    """JN11: reports joined to their OS changes."""
    t, _ = setup(spark, sf_dir)
    return t.reports.join(t.h("op_sys"), "id").select("id", "current_resolution", "what")


def q_software_birthday_rows(spark, sf_dir):
    """WN4-WN6: first-7 rows per (product, version), top time with ties."""
    t, _ = setup(spark, sf_dir)
    lv = latest_by(t.h("version"), cols=["what", "ts"]).withColumnRenamed("what", "Version")
    lp = latest_by(t.h("product"), cols=["what"]).withColumnRenamed("what", "Product")
    return FT.software_birthday_rows(lv.join(lp, "id"))


def q_master_table(spark, sf_dir):
    """F31, stored like every other stage (the model stage reads the file)."""
    return master_materialised(spark, sf_dir)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "base_sample": q_base_sample,
        "latest_by": q_latest_by,
        "first_by": q_first_by,
        "value_as_of": q_value_as_of,
        "os_category": q_os_category,
        "component_category": q_component_category,
        "priority_category": q_priority_category,
        "severity_category": q_severity_category,
        "version_category": q_version_category,
        "version_category_rule": q_version_category_rule,
        "version_category_ranged": q_version_category_ranged,
        "value_frequency": q_value_frequency,
        "distinct_pairs": q_distinct_pairs,
        "scan_status": q_scan_status,
        "count_assigned_to": q_count_assigned_to,
        "reports_os": q_reports_os,
        "software_birthday_rows": q_software_birthday_rows,
    }
    for name in FT.FEATURES:
        q[f"feat_{name}"] = _feature(name)
    q["master_table"] = q_master_table
    q.update(ML_QUERIES)
    q["repair_records"] = q_repair_records
    q["csv_load"] = q_csv_load
    q["repaired_load"] = q_repaired_load
    return q


# --- model stage ------------------------------------------------------------
ML_ROUND = 6  # doubles of the model queries are compared at 6 decimals


def master_materialised(spark, sf_dir) -> DataFrame:
    """The wide table written once per session and data folder (the model
    stage reads it several times; the file cuts the lineage)."""
    _prepare(spark)
    key = ("master", app_id(spark), sf_dir, _input_state(spark, sf_dir))
    if key not in _STAGES:
        t, b = setup(spark, sf_dir)
        _STAGES[key] = materialise(master_table(t, b, hi_minutes=TESTDATA_HI_MINUTES), "master_table")
    return _STAGES[key]


def _split(spark, sf_dir):
    from histlens.plans.model import train_test
    return train_test(master_materialised(spark, sf_dir))


def q_nested_split(spark, sf_dir):
    """ML1+ML2: every row's part (train, test, holdout)."""
    from histlens.plans.model import nested_split
    return nested_split(master_materialised(spark, sf_dir).select("id", "target"))


def q_random_subsets(spark, sf_dir):
    """ML3 and PF13: the drawn subsets, restricted to the wide table's own features, and the
    rows of the wide table that hold all features of each."""
    from histlens.plans.model import all_features, random_subsets, subset_support
    m = master_materialised(spark, sf_dir)
    have = set(all_features(m))
    subs = subset_support(m, [[f for f in s if f in have] for s in random_subsets()])
    return subs.select("subset_id", F.array_join("features", "+").alias("features"), "n_rows")


def q_holdout_split(spark, sf_dir):
    from histlens.plans.model import holdout_split
    m = master_materialised(spark, sf_dir).select("id", "target")
    return holdout_split(m)


def q_holdout_split_exact(spark, sf_dir):
    from histlens.plans.model import holdout_split_exact
    m = master_materialised(spark, sf_dir).select("id", "target")
    return holdout_split_exact(m)


def q_nb_fit(spark, sf_dir):
    from histlens.plans.model import SEARCH_FEATURES, nb_fit
    train, _ = _split(spark, sf_dir)
    f = nb_fit(train, SEARCH_FEATURES)
    return f.select("feature", "class", "value", "n", F.round("mean", ML_ROUND).alias("mean"),
                    F.round("sd", ML_ROUND).alias("sd"), F.round("p", ML_ROUND).alias("p"))


def q_nb_predict(spark, sf_dir):
    from histlens.plans.model import FINAL_FEATURES, nb_fit, nb_predict
    train, test = _split(spark, sf_dir)
    return nb_predict(test, nb_fit(train, FINAL_FEATURES), FINAL_FEATURES).select("id", "target", "pred")


def q_nb_final_auc(spark, sf_dir):
    from histlens.plans.model import final_auc
    train, test = _split(spark, sf_dir)
    return final_auc(train, test).select(F.round("auc", ML_ROUND).alias("auc"))


def q_roc_curve(spark, sf_dir):
    from histlens.plans.model import roc_curve
    p = q_nb_predict(spark, sf_dir)
    r = roc_curve(p, "pred", "target")
    return r.select("threshold", F.round("fpr", ML_ROUND).alias("fpr"), F.round("tpr", ML_ROUND).alias("tpr"))


def q_roc_curve_rate(spark, sf_dir):
    """ML6 over a continuous score: the reporter's success rate."""
    from histlens.plans.model import roc_curve
    _, test = _split(spark, sf_dir)
    r = roc_curve(test, "rateReporter", "target")
    return r.select(F.round("threshold", ML_ROUND).alias("threshold"), F.round("fpr", ML_ROUND).alias("fpr"), F.round("tpr", ML_ROUND).alias("tpr"))


def q_auc(spark, sf_dir):
    from histlens.plans.model import auc
    return auc(q_nb_predict(spark, sf_dir), "pred", "target").select(F.round("auc", ML_ROUND).alias("auc"))


def q_nb_subset_search(spark, sf_dir):
    from histlens.plans.model import SEARCH_FEATURES, nb_fit, nb_subset_search, random_subsets
    train, test = _split(spark, sf_dir)
    model = materialise(nb_fit(train, SEARCH_FEATURES), "model")
    s = nb_subset_search(train, test, random_subsets(), model=model)
    return s.select("subset_id", "n_features", "features", F.round("auc", ML_ROUND).alias("auc"))


def q_top_models(spark, sf_dir):
    from histlens.plans.model import top_models
    return top_models(q_nb_subset_search(spark, sf_dir), 10)


def q_repair_records(spark, sf_dir):
    """D1 over whole documents turned into one broken CSV stream."""
    from histlens.sources.repair import repair_documents
    _prepare(spark)
    return repair_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _csv_fixture(df: DataFrame, name: str) -> str:
    """A log written as raw CSV text, its columns in another order, texts quoted by hand (some that need no
    quotes not), in files of the log's own partitions, each with its header."""
    path = stage_root(df.sparkSession, f"csv-{name}")
    plain = (F.col("id") % 4 == 3) & ~F.col("what").rlike('[,\\n]|^"')
    text = F.when(plain, F.col("what")).otherwise(F.concat(F.lit('"'), F.replace("what", F.lit('"'), F.lit('""')), F.lit('"')))
    lines = df.select(F.explode(F.split(F.concat_ws(",", "who", text, "ts", "id"), "\n")).alias("who,what,when,id"))
    raw = {"header": True, "sep": "\x01", "quote": "\x02", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.write.mode("overwrite").options(**raw).csv(path)
    return path


def _texts_with_breaks(t) -> DataFrame:
    """The description log with quotes, commas and line breaks put into its texts."""
    w = F.col("what")
    odd = (F.when(F.col("id") % 4 == 0, F.concat(w, F.lit(' says "x, y" now')))
           .when(F.col("id") % 4 == 1, F.concat(w, F.lit("\nsecond, line\n"), w))
           .when(F.col("id") % 4 == 2, F.lit("")).otherwise(F.concat(w, F.lit(' 5" disk'))))
    return t.h("short_desc").withColumn("what", odd)


def q_csv_load(spark, sf_dir):
    """IO1/D2: quoted CSV with line breaks in its texts and its columns in another order, read back."""
    from histlens.sources.csv import load_history
    t, _ = setup(spark, sf_dir)
    rows, _ = load_history(spark, _csv_fixture(_texts_with_breaks(t), "load"))
    return rows


def q_repaired_load(spark, sf_dir):
    """D1 to IO1: a broken file repaired, unquoted and typed."""
    from histlens.sources.repair import load_repaired
    t, _ = setup(spark, sf_dir)
    path = stage_root(spark, "csv-broken")
    text = (F.when(F.col("id") % 3 == 0, F.concat(F.lit('"fix a, b of ""'), F.col("what"), F.lit('"""')))
            .when(F.col("id") % 3 == 1, F.concat(F.col("what"), F.lit("\nand more"))).otherwise(F.col("what")))
    (t.h("short_desc").select(F.concat_ws(",", "id", text, "ts", "who").alias("value"))
     .write.mode("overwrite").text(path))
    rows, _ = load_repaired(spark, path)
    return rows


ML_QUERIES = {
    "nested_split": q_nested_split, "random_subsets": q_random_subsets, "roc_curve_rate": q_roc_curve_rate,
    "holdout_split": q_holdout_split, "holdout_split_exact": q_holdout_split_exact, "nb_fit": q_nb_fit, "nb_predict": q_nb_predict,
    "nb_final_auc": q_nb_final_auc, "roc_curve": q_roc_curve, "auc": q_auc,
    "nb_subset_search": q_nb_subset_search, "top_models": q_top_models,
}
