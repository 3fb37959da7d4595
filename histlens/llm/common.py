"""Helpers shared by the llm operators: stage tables in the shared folder, text batches."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histlens.session import freeing_shuffles

BATCH_ROWS = 256


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a ``local[...]`` session without that setting (tests) gets a fresh
    temporary folder; any other session without it is refused.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        d = "file://" + tempfile.mkdtemp(prefix="histlens-llm-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


class Stages:
    """Intermediate tables of one operator call, written to the shared folder.

    A written table cuts the lineage, so a lost executor repeats at most the
    step that was running.  ``drop`` removes tables that nothing reads any
    more; the ones the returned frame still reads stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
        for held in _open:
            held.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def uri(self, name: str) -> str:
        """The path with its file system, as Spark resolves it (for tasks that write files themselves)."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()

    def read(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def write(self, df: DataFrame, name: str) -> DataFrame:
        with freeing_shuffles(self.spark):
            df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name, df.schema)

    def drop(self, *names: str) -> None:
        """Delete the named tables; without a name, the whole folder."""
        jvm, jsc = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc
        for at in [self.path(n) for n in names] or [self.root]:
            p = jvm.org.apache.hadoop.fs.Path(at)
            p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)


_open: list[list[Stages]] = []


@contextmanager
def dropping_stages():
    """Store an operator's result inside this block: at its end the stage tables that operators
    called in it have written are deleted."""
    held: list[Stages] = []
    _open.append(held)
    try:
        yield
    finally:
        _open.remove(held)
        for st in held:
            st.drop()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col):
    """Lower-case A-Z and nothing else."""
    plain = F.length(col) == F.octet_length(col)
    return F.when(plain, F.lower(col)).otherwise(
        F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def kept_in_process(key: tuple, make: Callable[[], object]) -> object:
    """The object that this Python worker keeps under key, made at its first use.

    A worker serves many tasks; what a coder has learned from one serves the next.  The memory of
    each coder is bounded, nothing that it remembers changes a result, and a worker keeps
    one at a time.
    """
    held = sys.__dict__.setdefault("_histlens_llm_kept", {})
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


def forget_kept() -> None:
    """Free what this worker keeps, at the start of a task that needs its memory otherwise, and
    give back what the tasks before have freed: a worker serves all stages of a job, and its allocators hold
    on to the memory of the largest."""
    sys.__dict__.pop("_histlens_llm_kept", None)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of glibc alone
    if trim is not None:
        trim(0)


def hash_sample(rows: DataFrame, keys: list[str], hashed: str, n: int) -> DataFrame:
    """Of each key about 2 n rows, those of the smallest hashes: counts per key (few keys: labels,
    languages) set a bound on the hash, so that a big table is thinned before any shuffle."""
    u = F.pmod(F.col(hashed), F.lit(1 << 31)) / float(1 << 31)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return rows.join(F.broadcast(counts), keys).filter(u < 2.0 * n / F.col("_n")).drop("_n")


def slices(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into short ones, so that few texts are Python objects at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def with_text(docs: DataFrame, keep: tuple[str | Column, ...], text_col: str) -> tuple[DataFrame, str]:
    """The ``keep`` columns and after them the text, and the text's name.  A text that is a field of a
    kept struct (``doc.text``) is read there: rows that are kept whole go to the workers once."""
    cols = [F.col(c) if isinstance(c, str) else c for c in keep]
    if "." in text_col and text_col.split(".")[0] in keep:
        return docs.select(*cols), text_col
    return docs.select(*cols, F.col(text_col).alias("_text")), "_text"


def byte_texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column, or a field of a struct column that has no nulls, as UTF-8 bytes; null is empty."""
    at = batch.schema.get_field_index(name)
    if at >= 0:
        col = batch.column(at)
    else:
        outer, field = name.split(".")
        col = batch.column(batch.schema.get_field_index(outer)).field(field)
    return [x or b"" for x in col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()]


def train_rows(id_col):
    """Rows whose labels may be learned from: crc32(id as text) mod 5 is not 0."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 != 0
