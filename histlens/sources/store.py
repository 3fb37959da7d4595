"""Materialised stages in the session's shared checkpoint folder.

Stages that many later plans read (the ingested logs, the base sample, the
wide table) are written once and read back, which cuts their lineage: plans
stay small, recomputation after a lost executor starts from the written
files, and the folder is the cluster's ``spark.checkpoint.dir`` (shared
storage), never a machine-local path.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from histlens.session import ensure_checkpoint_dir, freeing_shuffles
from histlens.sources.tables import Tables, load_tables, write_tables


def stage_root(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/histlens-{name}-{uuid.uuid4().hex[:12]}"


def ingest(t: Tables, root: str | None = None) -> Tables:
    """D2: write reports + long history (partitioned by attr) and read them back.  With a
    ``root`` of the caller's, the tables that are there are replaced as one."""
    with freeing_shuffles(t.spark):
        if root is None:
            root = stage_root(t.spark, "tables")
            write_tables(t, root)
        else:
            replace_table(t.spark, root, lambda new: write_tables(t, new))
    return load_tables(t.spark, root)


def materialise(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """IO4: store a result as Parquet and return the read-back frame.  A table that is
    already at ``root`` is replaced by ``replace_table``."""
    with freeing_shuffles(df.sparkSession):
        if root is None:
            root = stage_root(df.sparkSession, name)
            df.write.parquet(root)
        else:
            replace_table(df.sparkSession, root, df.write.parquet)
    return df.sparkSession.read.parquet(root)


def replace_table(spark: SparkSession, root: str, write: Callable[[str], None]) -> None:
    """Write a table beside ``root``, then put it in the old one's place by two renames.

    Until the new table is complete the old one stays whole and readable (``df`` may even read
    it); a failed write leaves it as it was and removes the half-written folder.  A
    job that dies between the renames leaves the old table under ``<root>.old-*``."""
    root, mark = root.rstrip("/"), uuid.uuid4().hex[:12]
    new, old = f"{root}.new-{mark}", f"{root}.old-{mark}"
    try:
        write(new)
    except BaseException:
        drop_folder(spark, new)
        raise
    fs, path = _fs(spark, root)
    had = fs.exists(path(root))
    if had:
        _rename(fs, path, root, old)
    _rename(fs, path, new, root)
    spark.catalog.refreshByPath(root)
    if had:
        drop_folder(spark, old)


def _fs(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _rename(fs, path, a: str, b: str) -> None:
    if not fs.rename(path(a), path(b)):
        raise OSError(f"cannot rename {a} to {b}")


def write_feature(df: DataFrame, name: str, root: str) -> DataFrame:
    """IO4 by name: replace the table ``root/name`` (Parquet) and read it back."""
    return materialise(df, name, f"{root.rstrip('/')}/{name}")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of stages that nothing reads any more."""
    fs, of = _fs(spark, path)
    fs.delete(of(path), True)
