"""The skew-proof paths give the same answers as the simple ones."""

import random

from helpers import rows
from pyspark.sql import functions as F

from histlens.operators import first_k_max, latest_by
from histlens.operators.prefix import prior_rate


def prior_rate_plain(df, entity, order_cols, flag, name):
    """One window per entity."""
    from pyspark.sql import Window
    w = Window.partitionBy(entity).orderBy(*order_cols)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(flag).over(before), F.lit(0)).cast("double") / F.row_number().over(w).cast("double"))


def _skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        who = 1 if rnd.random() < 0.6 else rnd.randint(2, 40)     # one actor owns most rows
        data.append((i, who, rnd.randint(0, 500), rnd.randint(0, 1), rnd.choice("abc")))
    return spark.createDataFrame(data, "id LONG, who LONG, ts LONG, fixed INT, what STRING")


def test_ranged_prior_rate_equals_plain(spark):
    df = _skewed(spark)
    plain = rows(prior_rate_plain(df, "who", ["ts", "id"], "fixed", "r"), "id", "r")
    split = rows(prior_rate(df, "who", ["ts", "id"], "fixed", "r", partitions=16), "id", "r")
    assert len(plain) == len(split) == 3000
    for a, b in zip(plain, split):
        assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-12


def test_latest_by_matches_window(spark):
    from pyspark.sql import Window
    df = _skewed(spark).select(F.col("who").alias("id"), "what", "ts", F.col("id").alias("who"))
    w = Window.partitionBy("id").orderBy(F.desc("ts"), "what", "who")
    ref = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert rows(latest_by(df), "id", "what", "ts", "who") == rows(ref, "id", "what", "ts", "who")


def test_first_k_max_is_kth_smallest(spark):
    df = _skewed(spark)
    got = dict(rows(first_k_max(df, ["who"], "ts", 7, "b"), "who", "b"))
    pdf = df.toPandas()
    for who, g in pdf.groupby("who"):
        s = sorted(g["ts"])
        assert got[who] == s[min(7, len(s)) - 1]


def test_repartition_invariance(spark):
    df = _skewed(spark)
    a = rows(prior_rate(df, "who", ["ts", "id"], "fixed", "r"), "id", "r")
    b = rows(prior_rate(df.repartition(13, "ts"), "who", ["ts", "id"], "fixed", "r"), "id", "r")
    assert a == b


def test_prior_rate_cuts_ties_and_nulls(spark):
    """One entity (or a NULL one) with one time: the rows are still spread over the ranges."""
    df = spark.range(4000).select("id", F.lit(5).cast("long").alias("ts"), (F.col("id") % 3 == 0).cast("int").alias("fixed"),
                                  F.when(F.col("id") < 2000, F.lit(1)).cast("long").alias("who"))
    got = prior_rate(df, "who", ["ts", "id"], "fixed", "r", partitions=8)
    assert rows(got, "id", "r") == rows(prior_rate_plain(df, "who", ["ts", "id"], "fixed", "r"), "id", "r")
    from histlens.operators.prefix import stored_in_order
    sizes = stored_in_order(df, ["who", "ts", "id"], "t", 8).groupBy("_pid").count().toPandas()["count"]
    assert len(sizes) == 8 and sizes.max() < 1000


def test_dense_ids_equal_window_dense_rank(spark):
    from pyspark.sql import Window

    from histlens.operators import dense_group_id
    rnd = random.Random(5)
    data = [(rnd.choice(["JDT", "CDT", "PDE", "Platform", "X"]), rnd.choice("0123456789ab") * rnd.randint(1, 3))
            for _ in range(2000)]
    df = spark.createDataFrame(data, "p STRING, v STRING")
    a = rows(df.distinct().withColumn("g", F.dense_rank().over(Window.orderBy("p", "v"))), "p", "v", "g")
    b = rows(dense_group_id(df, ["p", "v"], "g", 7), "p", "v", "g")
    assert a == b and len(a) > 20


def test_roc_and_auc_equal_pairwise_definition(spark):
    import numpy as np

    from histlens.plans.model import auc, roc_curve
    rnd = random.Random(11)
    df = spark.createDataFrame([(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(3000)], "y INT, s DOUBLE")
    pdf = df.toPandas()
    pos, neg = pdf[pdf.y == 1].s.to_numpy(), pdf[pdf.y == 0].s.to_numpy()
    got = {r.threshold: (r.fpr, r.tpr) for r in roc_curve(df, "s", "y", partitions=6).collect()}
    assert got.pop(None) == (0.0, 0.0) and set(got) == set(pdf.s)
    for t, (fpr, tpr) in got.items():
        assert abs(fpr - (neg >= t).mean()) < 1e-12 and abs(tpr - (pos >= t).mean()) < 1e-12
    p, n = pos[:, None], neg[None, :]
    want = ((p > n).sum() + 0.5 * (p == n).sum()) / (len(pos) * len(neg))
    assert abs(auc(df, "s", "y", partitions=6).first()["auc"] - want) < 1e-9


def test_bug_stats_reduce_before_the_shuffle(spark):
    """One aggregation of the history, partial below its only exchange, no join: texts stay where they are."""
    from histlens.plans.master import bug_stats
    from histlens.plans.registry import setup
    t, _ = setup(spark, "/root/testdata/sf0.001")
    lines = bug_stats(t)._jdf.queryExecution().executedPlan().toString().split("\n")
    assert not any("Join" in x for x in lines)
    at = [i for i, x in enumerate(lines) if "Exchange" in x]
    assert len(at) == 1 and any("Aggregate" in x and "partial_" in x for x in lines[at[0]:])


def test_naive_bayes_with_many_text_values(spark):
    """A text feature of 200,000 values is fitted and scored by joins."""
    from histlens.plans.model import nb_fit, nb_predict
    df = spark.range(400_000).select("id", (F.col("id") % 2).cast("int").alias("target"),
                                     F.concat(F.lit("v"), (F.col("id") % 200_000).cast("string")).alias("who"))
    model = nb_fit(df, ["who"])
    assert model.filter("value IS NOT NULL").count() == 200_000
    pred = nb_predict(df.filter("id < 1000"), model, ["who"])
    # by the contract an unseen value counts 0.001, more than these rare shares of 0.00001: the other class wins
    assert pred.filter("pred = target").count() == 0 and pred.columns == ["id", "target", "who", "pred"]
    common = df.withColumn("who", F.concat(F.lit("v"), (F.col("id") % 100).cast("string")))
    assert nb_predict(common.filter("id < 1000"), nb_fit(common, ["who"]), ["who"]).filter("pred <> target").count() == 0


def test_test_rows_never_touch_the_outer_holdout(spark):
    from histlens.plans.model import SPLIT_P, SPLIT_SEEDS, hash_unit, nested_split, train_test
    df = spark.range(20_000)
    train, test = train_test(df)
    outside = hash_unit(F.col("id"), SPLIT_SEEDS[0]) >= SPLIT_P
    assert train.filter(outside).count() == test.filter(outside).count() == 0
    parts = {r.part: r["count"] for r in nested_split(df).groupBy("part").count().collect()}
    assert parts["train"] == train.count() and parts["test"] == test.count()
    for part, share in (("train", 0.49), ("test", 0.21), ("holdout", 0.3)):
        assert abs(parts[part] / 20_000 - share) < 0.02


def test_first_k_has_partial_group_limit_before_shuffle(spark):
    from histlens.operators import first_k_max
    df = _skewed(spark)
    plan = first_k_max(df, ["who"], "ts", 7, "b")._jdf.queryExecution().executedPlan().toString()
    lines = [x.strip() for x in plan.split("\n")]
    limits = [i for i, x in enumerate(lines) if "WindowGroupLimit" in x]
    exchange = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x)
    assert len(limits) == 2 and limits[0] < exchange < limits[1]   # final above, partial below the shuffle


def test_exact_split_equals_sorting_everything(spark):
    import math

    from histlens.plans.model import hash_unit, holdout_split_exact
    df = spark.range(20_000).select(F.col("id"), (F.col("id") % 2).alias("target"))
    ranked = df.select("id", hash_unit(F.col("id"), 7).alias("u")).toPandas().sort_values(["u", "id"])
    for p in (0.05, 0.5, 0.7, 0.999):
        k = math.ceil(p * len(ranked))
        want = set(ranked["id"].iloc[:k])
        for bits, band in ((16, 100_000), (2, 5)):       # one pass, and 4 buckets a pass until 5 rows are left
            got = holdout_split_exact(df, p=p, seed=7, bits=bits, max_band=band)
            train = {r["id"] for r in got.filter("is_train").select("id").collect()}
            assert got.count() == 20_000 and train == want, (p, bits)


def test_exact_split_band_is_bounded_at_any_size(spark):
    from histlens.plans.model import _hash_int, _split_band
    for n in (2_000, 50_000):
        h = spark.range(n).select(_hash_int(F.col("id"), 7).alias("_h"))
        low, high, rest = _split_band(h, 0.7, 4, 20)
        inside = h.filter(F.col("_h").between(low, high - 1)).count()
        below = h.filter(F.col("_h") < low).count()
        assert inside <= 20 and 0 < rest <= inside and below + rest == -(-n * 7 // 10)


def test_exact_split_of_few_rows_and_of_one_key(spark):
    from histlens.plans.model import holdout_split_exact
    assert holdout_split_exact(spark.range(0)).count() == 0
    assert [r.is_train for r in holdout_split_exact(spark.range(1)).collect()] == [True]
    assert holdout_split_exact(spark.range(30), p=0.0).filter("is_train").count() == 0
    assert holdout_split_exact(spark.range(30), p=1.0).filter("is_train").count() == 30
    same = spark.range(50).select(F.lit(4).alias("id"))
    assert holdout_split_exact(same, p=0.3, bits=3, max_band=5).filter("is_train").count() == 15


def test_subset_search_equals_plain_sums(spark):
    """Subsets that share prefixes, one feature, all features and none, with NULL features and a NULL label."""
    import math

    from histlens.plans.model import model_params, nb_fit, nb_subset_search
    data = [(i, i % 2 if i != 5 else None, None if i % 7 == 0 else float(i % 2) + (i * 37 % 11) / 4, float(i * 13 % 9),
             None if i % 5 == 0 else float(i % 2) * 2 + i * 7 % 5) for i in range(120)]
    df = spark.createDataFrame(data, "id long, target int, a double, b double, c double")
    train, test = df.filter("id % 3 > 0 AND target IS NOT NULL"), df.filter("id % 3 = 0 OR target IS NULL")
    subsets = [["a"], ["b", "a"], ["c", "b", "a"], ["c"], ["a", "c"], ["b"], []]
    par = model_params(nb_fit(train, ["a", "b", "c"]))

    def ll(v, f, c):
        if v is None:
            return 0.0
        m, sd = par["gauss"][(f, c)]
        d = math.exp(-0.5 * ((v - m) / sd) ** 2) / (sd * math.sqrt(2 * math.pi))
        return math.log(d if d > 0 else 0.001)
    base = math.log(par["prior"][1]) - math.log(par["prior"][0])
    rows = [r for r in test.collect() if r.target is not None]
    for got in nb_subset_search(train, test, subsets).collect():
        s = subsets[got.subset_id - 1]
        pred = [base + sum(ll(r[f], f, 1) - ll(r[f], f, 0) for f in s) > 0 for r in rows]
        tpr = sum(p for p, r in zip(pred, rows) if r.target) / sum(r.target for r in rows)
        tnr = sum(not p for p, r in zip(pred, rows) if not r.target) / sum(1 - r.target for r in rows)
        assert got.n_features == len(s) and abs(got.auc - (tpr + tnr) / 2) < 1e-9, s


def test_subset_support_counts_whole_rows(spark):
    from histlens.plans.model import subset_support
    df = spark.createDataFrame([(1, None, "x"), (2, 3.0, None), (None, 4.0, "y"), (5, 6.0, "z")], "a int, b double, c string")
    subs = [["a"], ["b", "c"], ["a", "b", "c"], []]
    assert [r.n_rows for r in subset_support(df, subs).orderBy("subset_id").collect()] == [3, 2, 1, 4]
    assert [r.n_rows for r in subset_support(df.limit(0), subs).collect()] == [0, 0, 0, 0]


def test_offsets_of_many_ranges(spark):
    """The two-level scan over 5,000 ranges, with gaps, NULL totals and doubles."""
    from histlens.operators.prefix import range_offsets

    rows = [(p, None if p % 11 == 0 else p % 13, 0.5 * (p % 3)) for p in range(5000) if p % 7]
    x = spark.createDataFrame(rows, "_pid long, a long, b double")
    a = b = 0
    want = {}
    for p, u, v in rows:
        want[p] = (a, b)
        a, b = a + (u or 0), b + v
    for ranges in (5000, 3, None):
        assert {r._pid: (r._o_a, r._o_b) for r in range_offsets(x, ["a", "b"], ranges).collect()} == want
