"""The corpus pipeline stage by stage against plain versions of each stage's rule."""

import brute
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from histlens.llm import quality_bt, zstd_lang

SF = "/root/testdata/sf0.001"


def rows_of(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_stages_follow_their_rules(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = docs.columns
    kept = []
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        kept.append((name, before.collect(), docs.collect(), docs.columns))
    assert [n for n, *_ in kept] == ["language_id", "quality_classifier", "exact_dedup", "ngram_jaccard_join", "packing"]
    assert all(c == cols for _, _, _, c in kept[:-1])

    lang, quality, exact, near, pack = kept
    judge = zstd_lang.Classifier(zstd_lang.fit(spark.read.parquet(f"{SF}/documents.parquet")))
    want = [r for r in lang[1] if judge((r.text or "").encode())[0] != "und" and judge(r.text.encode())[2] >= zstd_lang.MARGIN]
    assert sorted(r.doc_id for r in lang[2]) == sorted(r.doc_id for r in want)

    model = quality_bt.fit(spark.createDataFrame(quality[1], lang_schema(spark)), spark.read.parquet(f"{SF}/labels.parquet"))
    s = quality_bt.to_score(model, quality_bt.strength(model, np.array([quality_bt.features((r.text or "").encode()) for r in quality[1]])))
    assert sorted(r.doc_id for r in quality[2]) == sorted(r.doc_id for r, v in zip(quality[1], s) if v >= 0.3)

    top = {}
    for r in exact[1]:
        key = brute.ascii_lower(r.text or "")
        top[key] = max(top.get(key, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in exact[2]) == sorted(top.values())

    comp = brute.near_components([(r.doc_id, r.text) for r in near[1]])
    assert sorted(r.doc_id for r in near[2]) == sorted(d for d, (_, c) in comp.items() if c == d)

    from tokenizers import Tokenizer

    from test_tokens import check_pieces

    check_pieces(pack[2], [(r.doc_id, r.text) for r in pack[1]], Tokenizer.from_file(brute.path(brute.TOKENIZER)))


def lang_schema(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").schema


def test_run_is_the_stages_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("histlens.llm.common.shared_folder", lambda spark: str(tmp_path))
    got = P.run(spark, SF).collect()
    assert [x.name for d in tmp_path.iterdir() for x in d.iterdir() if not x.name.endswith(".crc")] == ["4_packing"]
    assert len({r.doc_id for r in got}) < spark.read.parquet(f"{SF}/documents.parquet").count()
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(got[0].asDict()) and P.ORACLE_SQL is None


def test_stages_on_odd_documents(spark, tmp_path):
    """Nulls in any column, repeated rows, extra columns with names used inside."""
    odd = [(None, None, None, None, None, 1, "a"), (1, "", "en", "s", 0, 2, "b"), (2, "the text of a document " * 10, None, None, None, None, None)] * 2
    base = spark.read.parquet(f"{SF}/documents.parquet").select("*", F.lit(1).alias("rid"), F.lit("x").alias("score"))
    extra = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long, rid int, score string")
    base.unionByName(extra).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    cols = docs.columns
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.count() > 0 and (name == "packing" or docs.columns == cols)


def test_stages_on_nothing(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    docs.write.parquet(str(tmp_path / "docs"))
    for _, stage in P.STAGES:
        assert stage(spark, spark.read.parquet(str(tmp_path / "docs")), SF).collect() == []


def test_registered_queries():
    import __spark_entry__ as E

    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert "op9_exact_dedup" in E.oracle_sql() and "pipeline" not in E.oracle_sql()


def test_rows_kept_whole_go_to_the_workers_once(spark, tmp_path):
    """The learned stages read a row's text inside the row: no second copy of it in their batches."""
    docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(["Some words.", "", None, "More words here."])], "doc_id long, lang string, text string")
    spark.createDataFrame([(1, 0), (3, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for stage in (P.language, P.quality):
        assert "_text" not in stage(spark, docs, str(tmp_path))._jdf.queryExecution().analyzed().toString()
    whole = docs.select(F.struct("*").alias("doc"))
    model = quality_bt.Model(*(np.ones(quality_bt._SIZE) for _ in range(3)), 0.0)
    once = quality_bt.score(whole, model, "doc.text", keep=("doc",)).select("doc.doc_id", "score", "predicted").collect()
    assert once == quality_bt.score(docs, model, keep=("doc_id",)).collect()
