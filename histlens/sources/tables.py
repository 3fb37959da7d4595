"""The input bundle: entity snapshot + attribute change logs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlens.schema import ATTRS


@dataclass(frozen=True)
class Tables:
    """``reports(id, current_resolution, current_status, opening, reporter)`` and
    one change log ``(id, what, ts, who)`` per attribute.

    ``hs(attrs)`` gives the long form ``(attr, id, what, ts, who)`` of some
    logs.  With ``long`` set (Parquet partitioned by ``attr``) that is one scan
    with partition pruning; otherwise a union of the per-attribute frames.
    Features never read logs they do not use.  ``mixed`` has the same rows in the order of
    the input, all logs in one file: where most logs are read, a task then holds what the logs
    say of one entity side by side, and partial aggregation joins it before the shuffle.
    """

    reports: DataFrame
    logs: Mapping[str, DataFrame]
    long: DataFrame | None = field(default=None)
    mixed: DataFrame | None = field(default=None)

    def h(self, attr: str) -> DataFrame:
        return self.logs[attr]

    def hs(self, attrs: Iterable[str]) -> DataFrame:
        attrs = list(attrs)
        long = self.mixed if self.mixed is not None and 2 * len(attrs) > len(ATTRS) else self.long
        if long is not None:
            return long.filter(F.col("attr").isin(attrs)).select("attr", "id", "what", "ts", "who")
        parts = [self.logs[a].select(F.lit(a).alias("attr"), "id", "what", "ts", "who") for a in attrs]
        return reduce(DataFrame.unionByName, parts)

    @property
    def history(self) -> DataFrame:
        return self.hs(ATTRS)

    @property
    def spark(self) -> SparkSession:
        return self.reports.sparkSession


def from_long(reports: DataFrame, history: DataFrame, mixed: DataFrame | None = None) -> Tables:
    """Tables over a long history ``(attr, id, what, ts, who)``, and the same rows mixed."""
    logs = {a: history.filter(F.col("attr") == a).select("id", "what", "ts", "who") for a in ATTRS}
    return Tables(reports, logs, history.select("attr", "id", "what", "ts", "who"), mixed)


def load_tables(spark: SparkSession, root: str) -> Tables:
    """Tables written by ``write_tables`` (Parquet; history partitioned by attr)."""
    return from_long(spark.read.parquet(f"{root}/reports"), spark.read.parquet(f"{root}/history"), spark.read.parquet(f"{root}/mixed"))


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
ROW_GROUP = 16 << 20        # bytes of a stored log's row groups: what one scan task has to sort stays small


def write_tables(t: Tables, root: str, mode: str = "overwrite") -> None:
    """IO4 for the inputs: replace both tables; history partitioned by attr so
    that a feature reading one attribute lists one folder, and once more with its logs mixed
    for the readers of most of them.

    A task keeps one file open per log, so the history is not sorted by attr before it is
    written (a sort of every log row, spilled as data grows)."""
    conf = t.spark.conf
    t.reports.write.mode(mode).parquet(f"{root}/reports")
    before = conf.get(WRITERS, None)
    conf.set(WRITERS, str(len(ATTRS) + 1))          # and one for rows without a log
    try:
        t.history.write.mode(mode).option("parquet.block.size", ROW_GROUP).partitionBy("attr").parquet(f"{root}/history")
        t.history.write.mode(mode).option("parquet.block.size", ROW_GROUP).parquet(f"{root}/mixed")
    finally:
        conf.unset(WRITERS) if before is None else conf.set(WRITERS, before)
