"""Running totals in a total order that stay parallel when one entity is huge.

``prior_rate`` (WN1-WN3): for each row, successes of the same entity strictly
before it divided by its position (the row itself counted).  A plain window
``partitionBy(entity)`` puts an entity in one task; an actor or an assignee
value can own a third of all rows.  So all rows are range-partitioned on
(entity, order columns) - ties and NULL entities are cut like any other rows -
and stored once; every range is its own window partition, and the totals of the
ranges before are added to an entity that began in an earlier range.  One
plan for every entity size.

The offsets have at most one row per range (only a range's first entity can
have begun earlier), a proven bound for their broadcast.  The number of ranges is
the session's number of shuffle partitions, so ranges stay small as data grows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def stored_in_order(df: DataFrame, order_cols, name: str, partitions: int | None = None, folder: str | None = None) -> DataFrame:
    """Rows range-partitioned in ``order_cols`` order and stored once, with their
    range ``_pid`` and their place ``_loc`` in it (both fixed from then on)."""
    from histlens.sources.store import materialise

    x = (df.repartitionByRange(partitions or shuffle_partitions(df), *order_cols).sortWithinPartitions(*order_cols)
         .withColumn("_mid", F.monotonically_increasing_id()))
    x = materialise(x, name, folder and f"{folder}/{name}")
    return (x.withColumn("_pid", F.shiftright("_mid", 33))
            .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))).drop("_mid"))


def prior_rate(df: DataFrame, entity: str | Sequence[str], order_cols: Sequence[str], flag: str, name: str,
               partitions: int | None = None, folder: str | None = None) -> DataFrame:
    """Add ``name`` = (sum of ``flag`` before the row) / (row number) within ``entity``
    (a column or several) in ``order_cols`` order; NULL entities are one entity."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    x = stored_in_order(df, [*keys, *order_cols], f"ranged_{name}", partitions, folder)
    w = Window.partitionBy("_pid", *keys).orderBy("_loc")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    y = (x.withColumn("_rn", F.row_number().over(w))
         .withColumn("_fx", F.coalesce(F.sum(flag).over(before), F.lit(0))))
    tot = x.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_tn"), F.sum(flag).alias("_tf"))
    wo = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)    # an entity's ranges
    off = tot.select(F.col("_pid").alias("_op"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                     F.sum("_tn").over(wo).alias("_on"), F.sum("_tf").over(wo).alias("_of")).filter("_on > 0")
    same = F.col("_pid") == F.col("_op")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    y = y.join(F.broadcast(off), same, "left")
    rate = ((F.col("_fx") + F.coalesce("_of", F.lit(0))).cast("double")
            / (F.col("_rn") + F.coalesce("_on", F.lit(0))).cast("double"))
    return y.withColumn(name, rate).select(*df.columns, name)


def ranged_running_sum(df: DataFrame, order_cols, sum_cols: Sequence[str], partitions: int | None = None,
                       inclusive: bool = True, prefix: str = "cum_", folder: str | None = None) -> DataFrame:
    """Global running sums in ``order_cols`` order (Columns or names) without a
    one-task window: per-range windows plus per-range offsets (one row per range,
    broadcast).  ``inclusive=False`` sums the rows strictly before."""
    x = stored_in_order(df, order_cols, "ranged", partitions, folder)
    frame = (Window.unboundedPreceding, 0) if inclusive else (Window.unboundedPreceding, -1)
    w = Window.partitionBy("_pid").orderBy("_loc").rowsBetween(*frame)
    off = range_offsets(x, sum_cols, partitions)
    y = x.join(F.broadcast(off), "_pid")
    for c in sum_cols:
        y = y.withColumn(f"{prefix}{c}", F.coalesce(F.sum(c).over(w), F.lit(0)) + F.col(f"_o_{c}"))
    return y.drop("_pid", "_loc", *[f"_o_{c}" for c in sum_cols])


def range_offsets(x: DataFrame, sum_cols: Sequence[str], ranges: int | None = None) -> DataFrame:
    """(_pid, _o_<col> ...): totals of all ranges before, one row per range.

    A scan in two levels, so that its work is linear in the number of ranges R: windows over groups of about sqrt(R)
    ranges, and the groups' totals, about sqrt(R) of them, in one array in which each group adds up
    those before it."""
    size = max(1, math.isqrt(ranges or shuffle_partitions(x)))
    tot = (x.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
           .withColumn("_g", F.floor(F.col("_pid") / size)))
    w = Window.partitionBy("_g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    inner = tot.select("_pid", "_g", *[F.sum(f"_t_{c}").over(w).alias(f"_i_{c}") for c in sum_cols])
    groups = tot.groupBy("_g").agg(*[F.sum(f"_t_{c}").alias(f"_t_{c}") for c in sum_cols])
    every = groups.agg(F.collect_list(F.struct("_g", *[f"_t_{c}" for c in sum_cols])).alias("_all"))
    one = every.select("_all", F.explode("_all").alias("_one"))

    def before(c: str):
        zero = F.col(f"_one._t_{c}") * 0
        return F.aggregate(F.filter("_all", lambda r: r["_g"] < F.col("_one._g")), F.coalesce(zero, F.lit(0).cast("long")),
                           lambda a, r: a + F.coalesce(r[f"_t_{c}"], a * 0))
    outer = one.select("_one._g", *[before(c).alias(f"_b_{c}") for c in sum_cols])
    return inner.join(F.broadcast(outer), "_g").select(
        "_pid", *[(F.col(f"_b_{c}") + F.coalesce(f"_i_{c}", F.col(f"_b_{c}") * 0)).alias(f"_o_{c}") for c in sum_cols])
