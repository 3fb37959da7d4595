"""Entity-history primitives as plain DataFrame transformations.

All per-key reductions are aggregates (partial aggregation before the
shuffle), never a window that needs a whole key in one task, except where the
result itself is an order statistic (``first_k_max``: Catalyst's
WindowGroupLimit cuts every key to k rows per map task before the shuffle).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _extreme_by(df: DataFrame, key, order_col: str, ties: Sequence[str], latest: bool,
                cols: Sequence[str] | None) -> DataFrame:
    keys = _list(key)
    cols = [c for c in (cols or df.columns) if c not in keys]
    o = F.col(order_col)
    # Ascending struct order; the newest row first by negating the time.  The
    # order and tie columns are stored once (they are also payload), so the
    # partial-aggregation buffer that is shuffled stays narrow.
    ties = list(ties)
    payload = [c for c in cols if c != order_col and c not in ties]
    packed = F.struct((-o if latest else o).alias("_o"), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(ties)],
                      *[F.col(c).alias(c) for c in payload])
    # a row without a valid time never wins (the original drops non-integer times)
    packed = F.when(o.isNotNull(), packed)

    def field(c: str):
        if c == order_col:
            return -F.col("_m._o") if latest else F.col("_m._o")
        if c in ties:
            return F.col(f"_m._t{ties.index(c)}")
        return F.col(f"_m.{c}")
    return (df.groupBy(*keys).agg(F.min(packed).alias("_m")).filter(F.col("_m").isNotNull())
            .select(*keys, *[field(c).alias(c) for c in cols]))


def latest_by(df: DataFrame, key="id", order_col: str = "ts", ties: Sequence[str] = ("what", "who"),
              cols: Sequence[str] | None = None) -> DataFrame:
    """AG9/JN3: the newest row per key; ties broken by ``ties`` ascending.

    One aggregation (``min`` of a struct): map-side partial aggregation
    keeps a hot key from landing whole in one task.
    """
    return _extreme_by(df, key, order_col, ties, True, cols)


def first_by(df: DataFrame, key="id", order_col: str = "ts", ties: Sequence[str] = ("what", "who"),
             cols: Sequence[str] | None = None) -> DataFrame:
    """AG9/AG11: the oldest row per key (ties ascending)."""
    return _extreme_by(df, key, order_col, ties, False, cols)


def value_as_of(entities: DataFrame, history: DataFrame, key: str = "id", at_col: str = "opening",
                ts_col: str = "ts") -> DataFrame:
    """JN2: history rows whose time equals the entity's time (composite equi join)."""
    e = entities.select(F.col(key).alias("_k"), F.col(at_col).alias("_at"),
                        *[F.col(c) for c in entities.columns if c not in (key, at_col)])
    j = history.join(e, (history[key] == e["_k"]) & (history[ts_col] == e["_at"]), "inner")
    return j.drop("_k").withColumnRenamed("_at", at_col)


def keep_with(df: DataFrame, other: DataFrame, key: str = "id") -> DataFrame:
    """JN7/JN9: semi join (``key IN (subquery)``)."""
    return df.join(other.select(key), key, "left_semi")


def drop_with(df: DataFrame, other: DataFrame, key: str = "id") -> DataFrame:
    """JN8: anti join on a non-null key (``NOT IN`` without null-aware planning)."""
    return df.join(other.select(key), key, "left_anti")


def count_per(df: DataFrame, key: str, col: str, name: str) -> DataFrame:
    """AG1: ``COUNT(col) GROUP BY key``."""
    return df.groupBy(key).agg(F.count(col).alias(name))


def ever(df: DataFrame, key: str, predicate: Column, name: str) -> DataFrame:
    """AG3: 1 if the predicate held on any row of the key, else 0."""
    return df.groupBy(key).agg(F.max(F.when(predicate, 1).otherwise(0)).alias(name))


def any_in_range(df: DataFrame, key: str, expr: Column, lo, hi, name: str) -> DataFrame:
    """AG4: 1 if ``lo < expr < hi`` on any row (``None`` bound = open)."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (expr > lo)
    if hi is not None:
        cond = cond & (expr < hi)
    return df.groupBy(key).agg(F.max(F.when(cond, 1).otherwise(0)).alias(name))


def sum_length(df: DataFrame, key: str, col: str, name: str) -> DataFrame:
    """AG5: total text length (code points) per key."""
    return df.groupBy(key).agg(F.sum(F.length(col)).alias(name))


def distinct_events(history: DataFrame, attrs: Iterable[str], col: str,
                    entities: DataFrame | None = None, entity_col: str | None = None,
                    key: str = "id") -> DataFrame:
    """SO1-SO4 / AG7: distinct ``(key, col)`` over some attribute logs, plus the
    entity's own value (reporter as an actor, opening as a time)."""
    parts = history.filter(F.col("attr").isin(list(attrs))).select(key, col)
    if entities is not None:
        parts = parts.unionByName(entities.select(key, F.col(entity_col).alias(col)))
    return parts.distinct()


def distinct_count(df: DataFrame, key: str, name: str) -> DataFrame:
    """AG7: rows per key of an already distinct frame."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def value_frequency(df: DataFrame, col: str = "what", name: str = "NumberOfCases") -> DataFrame:
    """AG12: ``COUNT(col) GROUP BY col``."""
    return df.groupBy(col).agg(F.count(col).alias(name))


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """AG13: distinct ``(a, b)``."""
    return df.select(a, b).distinct()


def dense_group_id(df: DataFrame, key_cols: Sequence[str], name: str, partitions: int | None = None,
                   folder: str | None = None) -> DataFrame:
    """WN7: distinct keys + dense id (1..) in ascending binary key order, without
    a one-task window: the keys are range-partitioned, stored once, numbered
    inside each range by read order, plus the number of keys in all earlier ranges
    (one row per range, broadcast)."""
    from histlens.operators.prefix import range_offsets, stored_in_order

    d = stored_in_order(df.select(*key_cols).distinct().withColumn("_one", F.lit(1)), list(key_cols), f"ids_{name}", partitions, folder)
    off = range_offsets(d, ["_one"])
    return (d.join(F.broadcast(off), "_pid")
            .select(*key_cols, (F.col("_o__one") + F.col("_loc") + 1).cast("int").alias(name)))


def dense_group_ids(df: DataFrame, keys: dict[str, tuple[Column, Column]], partitions: int | None = None,
                    folder: str | None = None) -> DataFrame:
    """WN7 for several keys of two text columns each, in one stored pass: (kind, k1, k2, gid)
    where ``kind`` is the name in ``keys`` and gid counts from 1 in each kind."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), a.cast("string").alias("k1"), b.cast("string").alias("k2"))
                                for n, (a, b) in keys.items()]))
    d = dense_group_id(df.select(pairs.alias("_p")).select("_p.*"), ["kind", "k1", "k2"], "_g", partitions, folder)
    first = d.groupBy("kind").agg(F.min("_g").alias("_first"))           # a row a kind
    return d.join(F.broadcast(first), "kind").select("kind", "k1", "k2", (F.col("_g") - F.col("_first") + 1).alias("gid"))


def first_k_max(df: DataFrame, group_cols: Sequence[str], ts_col: str, k: int, name: str) -> DataFrame:
    """WN4-WN6: per group, the largest of its k earliest times (the k-th
    smallest, or the max if the group is smaller).

    ``row_number() <= k`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so a hot group sends at most k rows per map task.
    """
    w = Window.partitionBy(*group_cols).orderBy(F.col(ts_col))
    return (df.select(*group_cols, ts_col)
            .withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= k)
            .groupBy(*group_cols).agg(F.max(ts_col).alias(name)))


def top_n_by(df: DataFrame, group_cols: Sequence[str], order_col: str, n: int = 1) -> DataFrame:
    """WN6: rows whose ``order_col`` is among the top ``n`` of their group,
    ties included (``rank() <= n``; Catalyst pushes a partial group limit
    below the shuffle)."""
    w = Window.partitionBy(*group_cols).orderBy(F.desc(order_col))
    return df.withColumn("_rk", F.rank().over(w)).filter(F.col("_rk") <= n).drop("_rk")


def actors_per_entity(involvement: DataFrame, key: str = "id", actor: str = "who",
                      name: str = "numPeopleInvolved") -> DataFrame:
    """AG7 of distinct ``(key, actor)`` rows: their number per entity, and the ``only`` actor of
    those that have one (fixed-width buffers for numeric actors)."""
    n = F.count(F.lit(1))
    return involvement.groupBy(key).agg(n.alias(name), F.when(n == 1, F.min(actor)).alias("only"))


def team_rate(involvement: DataFrame, key: str = "id", actor: str = "who",
              name: str = "teamWorkRate", actors: DataFrame | None = None) -> DataFrame:
    """AG6/F10: per actor, share of its entities that have more than one actor.

    ``involvement`` must be distinct ``(key, actor)``; ``actors`` is its ``actors_per_entity``
    where that is stored already.  An entity with one actor is a row of that actor alone, so the
    share is 1 - (entities the actor has alone) / (its entities): two counts by actor, and the
    pairs are never joined back to their entities.
    """
    if actors is None:
        actors = actors_per_entity(involvement, key, actor, "_n")
    size = next(c for c in actors.columns if c not in (key, "only"))
    alone = actors.filter(F.col(size) == 1).select(F.col("only").alias(actor), F.lit(0).alias("_rows"), F.lit(1).alias("_alone"))
    rows = involvement.select(actor, F.lit(1).alias("_rows"), F.lit(0).alias("_alone")).unionByName(alone)
    n = F.sum("_rows")
    return rows.groupBy(actor).agg(((n - F.sum("_alone")).cast("double") / n.cast("double")).alias(name))
