"""Adapters: the driver's TPC-H-like tables seen as bug reports + change logs.

Every history is ``SELECT l_orderkey AS id, <what>, epoch(l_shipdate) AS ts,
l_suppkey AS who FROM lineitem WHERE <pred>``; reports come from orders.  The
mapping is fixed by FIXTURES.md section 2 and mirrored in ``histlens.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histlens.schema import ATTRS
from histlens.sources.tables import Tables


def _s(c: Column) -> Column:
    return c.cast("string")


def _case(col: Column, pairs, default: Column) -> Column:
    e = None
    for k, v in pairs:
        e = (F.when(col == k, F.lit(v)) if e is None else e.when(col == k, F.lit(v)))
    return e.otherwise(default)


# --- fixed values: the view definitions of FIXTURES.md section 2 -----------
def _view(attr: str) -> tuple[Column, Column]:
    """(what, predicate) of one history view."""
    pk, sk, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    views = {
        "assigned_to": lambda: (
            F.when(pk % 10 == 0, "None").when(pk % 10 == 1, "team-inbox").when(pk % 10 == 2, "")
            .otherwise(F.concat(F.lit("dev"), _s(pk % 50))),
            ln <= 3,
        ),
        "status": lambda: (
            _case(F.col("l_returnflag"), [("R", "REOPENED"), ("A", "NEW")], F.lit("RESOLVED")),
            ln >= 2,
        ),
        "resolution": lambda: (
            _case(F.col("l_linestatus"), [("F", "FIXED")], F.lit("")),
            ln >= 6,
        ),
        "severity": lambda: (
            _case(ln, [(1, "blocker"), (2, "critical"), (3, "major"), (4, "normal"),
                       (5, "minor"), (6, "trivial")], F.lit("enhancement")),
            sk % 2 == 0,
        ),
        "priority": lambda: (
            _case(ln, [(1, "P1"), (2, "P2"), (3, "P3"), (4, "P4"), (5, "P5")], F.lit("None")),
            sk % 2 == 1,
        ),
        "product": lambda: (
            _case(sk % 4, [(0, "JDT"), (1, "CDT"), (2, "PDE")], F.lit("Platform")),
            ln.isin(1, 4, 7),
        ),
        "version": lambda: (
            _case(pk % 6, [(0, "3.0"), (1, "3.1"), (2, "3.1.2"), (3, "2.0"), (4, "0 DD 1.1")],
                  F.lit("DD 1.1")),
            ln.isin(1, 2, 5),
        ),
        "component": lambda: (
            _case(sk % 7, [(0, "UI"), (1, "Core"), (2, "Update Site"), (3, "IDE"),
                           (4, "User Doc"), (5, "Text")],
                  F.concat(F.lit("c"), _s(pk % 9))),
            ln.isin(2, 3, 6),
        ),
        "op_sys": lambda: (
            _case(sk % 8, [(0, "Windows XP"), (1, "Windows Vista"), (2, "Mac OS X"), (3, "Linux-GTK"),
                           (4, "Solaris"), (5, "All"), (6, "Unix All")], F.lit("")),
            ln.isin(3, 4, 5),
        ),
        "cc": lambda: (F.concat(F.lit("u"), _s(pk)), ln >= 5),
        "short_desc": lambda: (F.concat(F.lit("desc "), _s(pk * ln)), ln.isin(1, 5)),
    }
    return views[attr]()


def history_view(lineitem: DataFrame, attr: str) -> DataFrame:
    what, pred = _view(attr)
    return lineitem.filter(pred).select(
        F.col("l_orderkey").alias("id"),
        what.alias("what"),
        F.unix_timestamp("l_shipdate").alias("ts"),
        F.col("l_suppkey").alias("who"),
    )


def reports_view(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    o, li = orders, lineitem
    first_ship = (li.filter(F.col("l_linenumber") <= 3)
                  .groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship")))
    j = o.join(first_ship, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("o_orderkey") % 2 == 0), "left")
    res = (F.when(F.col("o_orderstatus") == "F", "FIXED")
           .when(F.col("o_orderstatus") == "P",
                 F.when(F.col("o_orderkey") % 3 == 0, "DUPLICATE").otherwise("WONTFIX"))
           .otherwise(""))
    return j.select(
        F.col("o_orderkey").alias("id"),
        res.alias("current_resolution"),
        F.col("o_orderstatus").alias("current_status"),
        F.unix_timestamp(F.coalesce("first_ship", "o_orderdate")).alias("opening"),
        (F.col("o_custkey") % 100).alias("reporter"),
    )


def long_history(lineitem: DataFrame) -> DataFrame:
    """All logs as ``(attr, id, what, ts, who)`` from one lineitem scan: every row is
    exploded into the logs whose predicate it fits."""
    entries = []
    for attr in ATTRS:
        what, pred = _view(attr)
        entries.append(F.when(pred, F.struct(F.lit(attr).alias("attr"), what.alias("what"))))
    e = F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("_e")
    x = lineitem.select(F.col("l_orderkey").alias("id"), F.unix_timestamp("l_shipdate").alias("ts"), F.col("l_suppkey").alias("who"), e)
    return x.select("_e.attr", "id", "_e.what", "ts", "who")


def testdata_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Tables over the driver's parquet files.  One log alone is a filtered, projected
    lineitem scan; the long history (the ingest) reads lineitem once for all logs."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return Tables(reports_view(orders, li), {a: history_view(li, a) for a in ATTRS}, long_history(li))
