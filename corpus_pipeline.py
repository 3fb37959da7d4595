"""A corpus pipeline over ``documents``: language, quality, exact and near duplicates, packing.

Every stage takes (spark, docs, sf_dir), docs being a table read from files, and
returns a DataFrame that is stored and read again as the next one's docs; what the stage's operators and
the stage before have written is then deleted.  All but
the last return rows of ``docs`` with all its columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histlens.llm import block_dedup, ngram_join, quality_bt, vector_pack, zstd_lang
from histlens.llm.common import Stages, ascii_lower, dropping_stages
from histlens.llm.queries import tokenizer_path


def _whole() -> Column:
    return F.struct("*").alias("doc")


def _rows(docs: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """The rows of docs with the (id, key) of a row of kept; of several rows with one (id, key), which
    are copies, the one with the smallest hash of all columns.  No row numbers: a second scan
    of docs may be split in another way than the first."""
    hashed = F.xxhash64(*[F.col(f"doc.`{c}`") for c, t in docs.dtypes if "map<" not in t])
    rows = docs.select(_whole(), F.col("doc_id").alias("_id"), key.alias("_key"))
    keys = kept.toDF("id", "key")
    found = rows.join(keys, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("key")), "left_semi")
    return found.groupBy("_id", "_key").agg(F.min_by("doc", hashed).alias("doc")).select("doc.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose two best languages compress alike."""
    found = zstd_lang.identify(docs.select(_whole()), zstd_lang.fit(docs), "doc.text", keep=("doc",))
    return found.filter("NOT rejected").select("doc.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose quality score is below the decision value."""
    model = quality_bt.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_bt.score(docs.select(_whole()), model, "doc.text", keep=("doc",)).filter("predicted = 1").select("doc.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, the one with the largest doc_id."""
    groups = block_dedup.exact_groups(block_dedup.with_rid(docs, "doc_id", "text"))
    key = F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256)
    return _rows(docs, key, groups.filter("kept").select("doc_id", "text_sha256"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the one with the smallest doc_id."""
    groups = ngram_join.near_duplicates(block_dedup.with_rid(docs, "doc_id", "text"))
    return _rows(docs, F.xxhash64("text"), groups.filter("kept").select("doc_id", "text_id"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of all documents left, in sequences of 2048."""
    return vector_pack.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", language),
    ("quality_classifier", quality),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", near_dedup),
    ("packing", packing),
]

ORACLE_SQL = None       # language and quality are learned models; tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = Stages(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        with dropping_stages():
            docs = st.write(stage(spark, docs, sf_dir), f"{k}_{name}")
        if k:
            st.drop(f"{k - 1}_{STAGES[k - 1][0]}")
    return docs
