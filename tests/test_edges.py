"""Edge cases with expected results from FIXTURES.md section 3."""

import pytest
from helpers import make_tables, rows
from pyspark.sql import functions as F

from histlens.functions import int_div
from histlens.operators import latest_by
from histlens.plans import categories as C
from histlens.plans import features as FT
from histlens.plans.model import auc, hard_label_auc
from histlens.plans.population import base_sample


def test_v1_empty_resolution_stays(spark):
    t = make_tables(spark, [(1, "", "NEW", 100, 7)], {"severity": [(1, "major", 50, 1)], "status": [(1, "NEW", 50, 1)]})
    b = base_sample(t.reports, t.h("status"), t.h("severity"), cutoff=100 + 200 * 86400, max_days=100)
    assert rows(b, "id") == [(1,)]


def test_v2_numeric_order_and_v3_ties(spark):
    t = make_tables(spark, [], {"status": [(2, "NEW", 999, 1), (2, "OLD", 1000, 1), (3, "B", 5, 1), (3, "A", 5, 1)]})
    got = dict(rows(latest_by(t.h("status")), "id", "what"))
    assert got == {2: "OLD", 3: "A"}


def test_v5_division(spark):
    cut = 1_000_000
    ts = cut - (100 * 86400 + 86399)
    t = make_tables(spark, [(1, "", "NEW", ts, 1)], {"status": [(1, "NEW", ts, 1)], "severity": [(1, "major", ts, 1)]})
    b = base_sample(t.reports, t.h("status"), t.h("severity"), cutoff=cut, max_days=100)
    assert b.count() == 0  # 100 <= 100: still recent, dropped
    v = spark.range(1).select(int_div(F.lit(100 - 259), F.lit(60)).alias("d")).first()["d"]
    assert v == -2


def _one(spark, logs, opening=0, fn=None, **kw):
    t = make_tables(spark, [(1, "FIXED", "RESOLVED", opening, 9)], logs)
    b = t.reports
    return rows(fn(t, b, **kw))


def test_f11_bounds(spark):
    for m, want in [(0, 0), (1, 1), (1400, 1), (1401, 0)]:
        got = _one(spark, {"cc": [(1, "u", m * 60, 2)]}, fn=FT.is_mod_within_first_day)
        assert got == [(1, want)], m


def test_f20_bounds(spark):
    for m, want in [(9801, 0), (9802, 1)]:
        got = _one(spark, {"cc": [(1, "u", m * 60, 2)]}, fn=FT.is_open_for_one_week_or_more)
        assert got == [(1, want)], m


def test_f7_cases(spark):
    assert _one(spark, {"assigned_to": [(1, "None", 100, 2)]}, 100, FT.is_assigned) == [(1, 0)]
    assert _one(spark, {"assigned_to": [(1, "p", 200, 2)]}, 100, FT.is_assigned) == []
    assert _one(spark, {}, 100, FT.is_assigned) == []
    assert _one(spark, {"assigned_to": [(1, "None", 100, 2), (1, "q", 300, 2)]}, 100, FT.is_assigned) == [(1, 1)]


@pytest.mark.parametrize("first,last,up,down", [("None", "P3", 0, 1), ("P1", "P2", 0, 0), ("P3", "P1", 1, 0), ("P4", "P5", 0, 0)])
def test_f24(spark, first, last, up, down):
    got = _one(spark, {"priority": [(1, first, 1, 2), (1, last, 2, 2)]}, fn=FT.update_priority)
    assert got == [(1, up, down)]


@pytest.mark.parametrize("first,last,down,up", [("enhancement", "normal", 0, 1), ("major", "minor", 1, 0), ("blocker", "critical", 0, 0)])
def test_f25(spark, first, last, down, up):
    got = _one(spark, {"severity": [(1, first, 1, 2), (1, last, 2, 2)]}, fn=FT.update_severity)
    assert got == [(1, down, up)]


def test_wn3_prior_rate(spark):
    reps = [(i, "FIXED" if f else "WONTFIX", "RESOLVED", 10 * i, 5) for i, f in [(1, 1), (2, 0), (3, 1)]]
    t = make_tables(spark, reps, {})
    got = rows(FT.success_rate_reporter(t, t.reports), "id", "rateReporter")
    assert got == [(1, 0.0), (2, 0.5), (3, 1 / 3)]


def test_f22_birthday_and_rounding(spark):
    day = 86400
    # nine bugs on one (product, version): birthday = 7th earliest latest-version time
    ver = [(i, "3.0", i * day, 1) for i in range(1, 10)]
    prod = [(i, "JDT", 0, 1) for i in range(1, 10)]
    reps = [(i, "", "NEW", 0, 1) for i in range(1, 10)] + [(10, "", "NEW", int(9.5 * day), 1), (11, "", "NEW", int(10.5 * day), 1)]
    ver += [(10, "3.0", 100 * day, 1), (11, "3.0", 100 * day, 1)]
    prod += [(10, "JDT", 0, 1), (11, "JDT", 0, 1)]
    t = make_tables(spark, reps, {"version": ver, "product": prod})
    got = dict(rows(FT.age_software(t, t.reports), "id", "ageSoftwareVersionInDays"))
    assert got[1] == 0.0          # opening before the birthday -> clamped to 0
    assert got[10] == 2.0         # 2.5 days -> 2 (half to even)
    assert got[11] == 4.0         # 3.5 days -> 4


def test_d6_segments(spark):
    pairs = spark.createDataFrame([("3.0", "P"), ("3.1", "P"), ("3.1.2", "P")], "Version STRING, Product STRING")
    got = {r["Version"]: r["Segment"] for r in C.version_category_from_pairs(pairs).collect()}
    assert got == {"3.0": "Major", "3.1": "Minor", "3.1.2": "Service"}
    pairs2 = pairs.union(spark.createDataFrame([("unspecified", "P")], "Version STRING, Product STRING"))
    got2 = {r["Version"]: r["Segment"] for r in C.version_category_from_pairs(pairs2).collect()}
    assert got2["3.0"] is None   # rank mode shifts: the data-dependent mapping
    got3 = {r["Version"]: r["Segment"] for r in C.version_category_from_pairs(pairs2, "rule").collect()}
    assert got3["3.0"] == "Major" and got3["3.1"] == "Minor" and got3["3.1.2"] == "Service"


def test_f23_flags(spark):
    vals = ["a-inbox", "A-Inbox", "INBOX", "", "None"]
    got = spark.createDataFrame([(v,) for v in vals], "w STRING").select(
        "w", FT.inbox_flag("w").alias("i"), FT.nobody_flag("w").alias("n")).collect()
    m = {r["w"]: (r["i"], r["n"]) for r in got}
    assert [m[v][0] for v in vals] == [1, 1, 0, 0, 0]
    assert [m[v][1] for v in vals] == [0, 0, 0, 1, 1]


def test_d4_empty_os(spark):
    df = spark.createDataFrame([("",)], "w STRING").select(C.broad_os("w").alias("b"), C.detailed_os("w").alias("d"))
    r = df.first()
    assert (r["b"], r["d"]) == ("Other", "Windows Other")


def test_ml7_auc(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "label INT, pred INT")
    assert auc(df, "pred", "label").first()["auc"] == pytest.approx(0.75)
    c = df.agg(hard_label_auc(F.sum(F.col("pred") * F.col("label")), F.sum((1 - F.col("pred")) * F.col("label")),
                              F.sum((1 - F.col("pred")) * (1 - F.col("label"))),
                              F.sum(F.col("pred") * (1 - F.col("label")))).alias("a")).first()["a"]
    assert c == pytest.approx(0.75)


def test_null_time_never_latest(spark):
    t = make_tables(spark, [], {"status": [(1, "A", 5, 1), (1, "Z", None, 1), (2, "Q", None, 1)]})
    assert rows(latest_by(t.h("status")), "id", "what") == [(1, "A")]


def test_top_n_by_keeps_ties(spark):
    from histlens.operators import top_n_by
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 3), (2, 1)], "g INT, t INT")
    assert rows(top_n_by(df, ["g"], "t", 1), "g", "t") == [(1, 5), (1, 5), (2, 1)]
