"""ML1-ML9: split, Naive Bayes fit / predict, ROC, AUC, random feature-subset search.

Naive Bayes factorises by feature, so the 200-model search needs one fit,
one scoring pass and one aggregation: every test row gets a per-feature
log-likelihood difference, every subset's prediction is a sum over its
features, the positive predictions are exploded and counted by subset and label, and
the negatives follow from the totals (no loop over models).

The fitted model is a DataFrame.  Its numeric part (one row per feature and
class) is small by construction and comes to the driver as constants; the
frequencies of text values grow with the data and are joined.

Model contract (numeric -> Gaussian, text -> frequency table, laplace 0):
prior = class count; sample standard deviation, sd <= 0 or undefined ->
0.001; density <= 0 -> 0.001; a NULL feature contributes nothing; ties go to
class 0.  AUC of hard class labels = (TPR + TNR) / 2.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histlens.operators.prefix import ranged_running_sum

# --- fixed values: the feature lists of the model search --------------------
SEARCH_FEATURES = [
    "numStatusUpdates", "rateLastAssignee", "rateFirstAssignee", "rateLastAssigner", "rateFirstAssigner",
    "rateReporter", "month", "length", "ageSoftwareVersionInDays", "teamWorkRate", "year", "numCC",
]
FINAL_FEATURES = [
    "numStatusUpdates", "rateLastAssignee", "rateFirstAssignee", "rateLastAssigner", "rateFirstAssigner",
    "rateReporter", "length", "ageSoftwareVersionInDays", "teamWorkRate", "numCC",
]
TRIES = 200
THRESHOLD = 0.001          # replaces zero densities and zero standard deviations
SPLIT_P = 0.7
SPLIT_SEEDS = (162534, 162535)
SEARCH_SEED = 162534
HASH_BITS = 32             # of the split hash
SPLIT_BITS = 16            # bits of a digit of the exact split's radix selection
SPLIT_BAND = 100_000       # rows that the exact split may rank at once
LOG_SQRT_2PI = 0.5 * math.log(2 * math.pi)


def all_features(df: DataFrame, exclude: Sequence[str] = ("id", "target")) -> list[str]:
    """PF13: every column but the key and the label."""
    return [c for c in df.columns if c not in exclude]


def hash_unit(key: Column, seed: int) -> Column:
    """Deterministic uniform [0, 1) from md5(seed ':' key) — stable under any
    partitioning and reproducible in plain SQL."""
    return _hash_int(key, seed).cast("double") / F.lit(float(1 << HASH_BITS))


def _hash_int(key: Column, seed: int) -> Column:
    h = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, HASH_BITS // 4)
    return F.conv(h, 16, 10).cast("long")


def holdout_split(df: DataFrame, key: str = "id", p: float = SPLIT_P, seed: int = SPLIT_SEEDS[0],
                  name: str = "is_train") -> DataFrame:
    """ML1: add ``is_train`` (share ``p``), decided per key by hash."""
    return df.withColumn(name, hash_unit(F.col(key), seed) < F.lit(p))


def _split_band(hashes: DataFrame, p: float, bits: int, max_band: int) -> tuple[int, int, int]:
    """``(low, high, rest)`` of the hash values in column ``_h``: of the ``ceil(p * n)``
    smallest, all below ``low`` and ``rest`` in ``[low, high)``.

    Radix selection: one counting pass per digit of ``bits`` bits, over the rows of the
    band only, until the band has at most ``max_band`` rows or is one hash value.  A
    pass returns one row, whatever the number of rows."""
    low, width, rest, band = 0, 1 << HASH_BITS, None, None
    while width > 1 and (band is None or band > max_band):
        step = max(width >> bits, 1)
        inside = hashes.filter(F.col("_h").between(low, low + width - 1))
        counts = inside.groupBy(F.floor((F.col("_h") - low) / step).cast("long").alias("_b")).agg(F.count(F.lit(1)).alias("c"))
        want = F.ceil(F.lit(p) * F.sum("c")).cast("long") if rest is None else F.lit(rest).cast("long")
        every = counts.agg(F.sort_array(F.collect_list(F.struct("_b", "c"))).alias("a"), want.alias("k"))
        zero = F.lit(0).cast("long")
        found = F.aggregate("a", F.struct(F.lit(-1).cast("long").alias("b"), zero.alias("before"), zero.alias("seen")),
                            lambda s, r: F.when(s["seen"] >= F.col("k"), s).otherwise(
                                F.struct(r["_b"].alias("b"), s["seen"].alias("before"), (s["seen"] + r["c"]).alias("seen"))))
        cut = every.select(found.alias("s"), "k").select("s.b", "s.before", "s.seen", "k").first()
        if cut["b"] is None or cut["b"] < 0:        # no rows, or none to take
            return 0, 0, 0
        low, width, rest, band = low + cut["b"] * step, step, cut["k"] - cut["before"], cut["seen"] - cut["before"]
    return low, low + width, rest


def holdout_split_exact(df: DataFrame, key: str = "id", p: float = SPLIT_P, seed: int = SPLIT_SEEDS[0],
                        name: str = "is_train", bits: int = SPLIT_BITS, max_band: int = SPLIT_BAND) -> DataFrame:
    """ML1, exact mode: exactly ``ceil(p * n)`` training rows, those with the
    smallest hash (ties by key), without a global sort.

    A radix selection finds the hash band of the last training row.  Rows below are
    training rows, rows above are not, and only the band is ranked: at most
    ``max_band`` rows, or the rows of one hash value, at any size of ``df``.  The
    counting passes run when this function is called; ``df`` is read again by each, so
    it should be a stored table."""
    x = df.withColumn("_h", _hash_int(F.col(key), seed))
    low, high, rest = _split_band(x.select("_h"), p, bits, max_band)
    outside = x.filter((F.col("_h") < low) | (F.col("_h") >= high)).withColumn(name, F.col("_h") < low)
    band = x.filter((F.col("_h") >= low) & (F.col("_h") < high)).withColumn("_b", F.floor((F.col("_h") - low) / (high - low or 1)))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key))
    return outside.unionByName(band.withColumn(name, rank <= rest).drop("_b")).drop("_h")


def nested_split(df: DataFrame, key: str = "id", p: float = SPLIT_P, seeds=SPLIT_SEEDS, name: str = "part") -> DataFrame:
    """ML1+ML2: ``train`` = in the training part of both splits, ``test`` = in the
    outer training part but not the inner one, ``holdout`` = not in the outer
    training part (never used by the search or the final model)."""
    outer, inner = hash_unit(F.col(key), seeds[0]) < p, hash_unit(F.col(key), seeds[1]) < p
    return df.withColumn(name, F.when(~outer, "holdout").when(inner, "train").otherwise("test"))


def train_test(df: DataFrame, key: str = "id", p: float = SPLIT_P, seeds=SPLIT_SEEDS) -> tuple[DataFrame, DataFrame]:
    """The training and the test rows of the nested split; the holdout is left out."""
    s = nested_split(df, key, p, seeds, "_part")
    return s.filter(F.col("_part") == "train").drop("_part"), s.filter(F.col("_part") == "test").drop("_part")


def random_subsets(features: Sequence[str] = SEARCH_FEATURES, tries: int = TRIES,
                   seed: int = SEARCH_SEED) -> list[list[str]]:
    """ML3: ``tries`` subsets, size uniform in 1..len, drawn without replacement."""
    rng = random.Random(seed)
    feats = list(features)
    return [rng.sample(feats, rng.randint(1, len(feats))) for _ in range(tries)]


def subsets_frame(spark, subsets: list[list[str]]) -> DataFrame:
    rows = [(i + 1, s) for i, s in enumerate(subsets)]
    return spark.createDataFrame(rows, "subset_id INT, features ARRAY<STRING>")


def subset_support(df: DataFrame, subsets: list[list[str]], name: str = "n_rows") -> DataFrame:
    """``(subset_id, features, n_rows)``: the rows of ``df`` in which no feature of the
    subset is NULL.  Rows are counted by the set of features they hold (a bit mask, so
    at most 2^features groups leave the partial aggregation), and each subset
    adds up the masks that contain its own: no row is repeated per subset."""
    feats = sorted({f for s in subsets for f in s})
    if len(feats) > 62:
        raise ValueError(f"{len(feats)} features do not fit a mask of 62 bits")
    bit = {f: 1 << i for i, f in enumerate(feats)}
    mask = sum((F.when(F.col(f).isNotNull(), F.lit(b)).otherwise(0) for f, b in bit.items()), F.lit(0)).cast("long")
    held = df.groupBy(mask.alias("_m")).agg(F.count(F.lit(1)).alias("_c"))
    need = [sum(bit[f] for f in s) for s in subsets]
    sums = [F.coalesce(F.sum(F.when(F.col("_m").bitwiseAND(F.lit(n)) == n, F.col("_c"))), F.lit(0)) for n in need]
    counts = held.agg(F.array(*sums).alias("_n"))
    return (subsets_frame(df.sparkSession, subsets).withColumn("_n", counts.scalar())
            .select("subset_id", "features", F.element_at("_n", F.col("subset_id")).cast("long").alias(name)))


def _is_text(df: DataFrame, f: str) -> bool:
    return dict(df.dtypes)[f] == "string"


def nb_fit(train: DataFrame, features: Sequence[str], target: str = "target") -> DataFrame:
    """ML4/AG14: ``(feature, class, value, n, mean, sd, p)``; one aggregation for
    all numeric features, one for the text ones; prior rows have feature ''."""
    y = F.col(target).cast("int")
    num = [f for f in features if not _is_text(train, f)]
    txt = [f for f in features if _is_text(train, f)]
    parts = []
    stats = train.groupBy(y.alias("class")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(f).alias(f"n__{f}") for f in num],
        *[F.avg(f).alias(f"m__{f}") for f in num],
        *[F.stddev_samp(f).alias(f"s__{f}") for f in num])
    prior = stats.select(F.lit("").alias("feature"), "class", F.lit(None).cast("string").alias("value"),
                         F.col("_n").alias("n"), F.lit(None).cast("double").alias("mean"),
                         F.lit(None).cast("double").alias("sd"), F.lit(None).cast("double").alias("p"))
    parts.append(prior)
    if num:
        stacked = ", ".join(f"'{f}', `n__{f}`, CAST(`m__{f}` AS DOUBLE), CAST(`s__{f}` AS DOUBLE)" for f in num)
        parts.append(stats.selectExpr(
            "class", f"stack({len(num)}, {stacked}) AS (feature, n, mean, sd)").select(
            "feature", "class", F.lit(None).cast("string").alias("value"), "n", "mean", "sd",
            F.lit(None).cast("double").alias("p")))
    if txt:
        stacked = ", ".join(f"'{f}', CAST(`{f}` AS STRING)" for f in txt)
        long = train.selectExpr(f"CAST({target} AS INT) AS class", f"stack({len(txt)}, {stacked}) AS (feature, value)")
        long = long.filter(F.col("value").isNotNull())
        cnt = long.groupBy("feature", "class", "value").agg(F.count(F.lit(1)).alias("n"))
        tot = long.groupBy("feature", "class").agg(F.count(F.lit(1)).alias("_t"))     # a row per feature and class
        parts.append(cnt.join(F.broadcast(tot), ["feature", "class"]).select(
            "feature", "class", "value", "n", F.lit(None).cast("double").alias("mean"),
            F.lit(None).cast("double").alias("sd"), (F.col("n") / F.col("_t")).alias("p")))
    return reduce(DataFrame.unionByName, parts)


def model_params(model: DataFrame) -> dict:
    """Priors and Gaussian statistics as constants: at most (1 + features) x classes rows."""
    prior, gauss = {}, {}
    for r in model.filter(F.col("value").isNull()).collect():
        if r["feature"] == "":
            prior[r["class"]] = r["n"]
        else:
            gauss[(r["feature"], r["class"])] = (r["mean"], r["sd"])
    return {"prior": prior, "gauss": gauss, "classes": sorted(prior)}


def _with_text_probs(df: DataFrame, model: DataFrame, features: Sequence[str], classes: Sequence[int]) -> DataFrame:
    """Add ``_p_<feature>_<class>``, the share of the row's text value in each class
    (NULL if it never occurs), by a join on the value."""
    for f in features:
        if _is_text(df, f):
            of = (model.filter((F.col("feature") == f) & F.col("value").isNotNull()).groupBy(F.col("value").alias("_v"))
                  .agg(*[F.max(F.when(F.col("class") == c, F.col("p"))).alias(f"_p_{f}_{c}") for c in classes]))
            df = df.join(of, F.col(f) == F.col("_v"), "left").drop("_v")
    return df


def _log_lik(df: DataFrame, params: dict, f: str, c: int) -> Column:
    x = F.col(f)
    if _is_text(df, f):
        prob = F.coalesce(F.col(f"_p_{f}_{c}"), F.lit(0.0))
    else:
        mean, sd = params["gauss"].get((f, c), (None, None))
        if mean is None:
            return F.when(x.isNull(), F.lit(0.0)).otherwise(F.lit(math.log(THRESHOLD)))
        sd = sd if (sd is not None and sd > 0) else THRESHOLD
        z = (x.cast("double") - F.lit(mean)) / F.lit(sd)
        prob = F.exp(-0.5 * z * z) / F.lit(sd * math.sqrt(2 * math.pi))
    prob = F.when(prob > 0, prob).otherwise(F.lit(THRESHOLD))
    return F.when(x.isNull(), F.lit(0.0)).otherwise(F.log(prob))


def nb_scores(df: DataFrame, params: dict, features: Sequence[str]) -> dict[str, dict[int, Column]]:
    """Log likelihood columns per feature and class, of a frame with its text shares."""
    return {f: {c: _log_lik(df, params, f, c) for c in params["classes"]} for f in features}


def nb_predict(df: DataFrame, model: DataFrame, features: Sequence[str], name: str = "pred") -> DataFrame:
    """ML5: class with the largest log prior + sum of log likelihoods (first class on ties)."""
    params = model_params(model)
    classes = params["classes"]
    x = _with_text_probs(df, model, features, classes)
    ll = nb_scores(x, params, features)
    tot = {c: F.lit(math.log(params["prior"][c])) + sum((ll[f][c] for f in features), F.lit(0.0)) for c in classes}
    best = F.lit(classes[0])
    best_v = tot[classes[0]]
    for c in classes[1:]:
        best = F.when(tot[c] > best_v, F.lit(c)).otherwise(best)
        best_v = F.greatest(best_v, tot[c])
    return x.withColumn(name, best).select(*df.columns, name)


def roc_curve(df: DataFrame, score: str, label: str, partitions: int | None = None, folder: str | None = None) -> DataFrame:
    """ML6: ``(threshold, fpr, tpr)`` for every distinct score (rows: score >= threshold
    are positive), and the origin (NULL, 0, 0), above every score.  The per-score
    counts are summed in ranges (no one-task window)."""
    per = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("_pos"), F.sum(1 - F.col(label).cast("long")).alias("_neg"))
    c = ranged_running_sum(per, [F.desc("threshold")], ["_pos", "_neg"], partitions, folder=folder)
    tot_pos, tot_neg = c.agg(F.sum("_pos")).scalar(), c.agg(F.sum("_neg")).scalar()
    points = c.select(
        "threshold",
        F.try_divide(F.col("cum__neg").cast("double"), tot_neg.cast("double")).alias("fpr"),
        F.try_divide(F.col("cum__pos").cast("double"), tot_pos.cast("double")).alias("tpr"))
    origin = df.sparkSession.range(1).select(F.lit(None).cast(dict(points.dtypes)["threshold"]).alias("threshold"),
                                             F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(points)


def auc(df: DataFrame, score: str, label: str, partitions: int | None = None, folder: str | None = None) -> DataFrame:
    """ML7: area under the ROC curve (trapezoids = rank sum with mid-ranks), one row."""
    per = df.groupBy(F.col(score).alias("_s")).agg(
        F.sum(F.col(label).cast("long")).alias("_pos"), F.sum(1 - F.col(label).cast("long")).alias("_neg"))
    c = ranged_running_sum(per, ["_s"], ["_neg"], partitions, inclusive=False, folder=folder)
    contrib = c.select((F.col("_pos") * (F.col("cum__neg") + F.col("_neg") / 2.0)).alias("_a"), "_pos", "_neg")
    return contrib.agg(F.try_divide(F.sum("_a"), (F.sum("_pos") * F.sum("_neg")).cast("double")).alias("auc"))


def _confusion_auc(pred: Column, y: Column) -> list[Column]:
    tp = F.sum(pred * y)
    fn = F.sum((1 - pred) * y)
    tn = F.sum((1 - pred) * (1 - y))
    fp = F.sum(pred * (1 - y))
    return [tp, fn, tn, fp]


def hard_label_auc(tp: Column, fn: Column, tn: Column, fp: Column) -> Column:
    return 0.5 * (F.try_divide(tp.cast("double"), (tp + fn).cast("double"))
                  + F.try_divide(tn.cast("double"), (tn + fp).cast("double")))


def subset_trie(subsets: list[list[str]]) -> tuple[list[list[tuple[int, str]]], list[tuple[int, int]]]:
    """``(levels, ends)``: the subsets as a trie.  A node is (place of its parent in the level
    above, feature); ``ends[i]`` is the (level, place) at which subset i ends, (-1, 0) for an empty
    one.  Features that many subsets hold stand near the root, so that prefixes are shared."""
    use: dict[str, int] = {}
    for s in subsets:
        for f in set(s):
            use[f] = use.get(f, 0) + 1
    levels: list[list[tuple[int, str]]] = []
    place: dict[tuple[str, ...], int] = {(): 0}
    ends = []
    for s in subsets:
        path = tuple(sorted(set(s), key=lambda f: (-use[f], f)))
        for d in range(len(path)):
            if path[:d + 1] not in place:
                if d == len(levels):
                    levels.append([])
                place[path[:d + 1]] = len(levels[d])
                levels[d].append((place[path[:d]], path[d]))
        ends.append((len(path) - 1, place[path]))
    return levels, ends


def _count_hits(levels: list, ends: list, feats: Sequence[str], base: float):
    """Per task: true and false positives of every subset.  One level of the trie is held
    at a time for a batch; a node's sum is its parent's plus one feature's column."""
    steps = [[(at, feats.index(f)) for at, f in nodes] for nodes in levels]
    stop: dict[int, list[tuple[int, int]]] = {}
    for pos, (d, at) in enumerate(ends):
        stop.setdefault(d, []).append((pos, at))

    def count(batches):
        import numpy as np
        import pyarrow as pa
        hits = np.zeros((2, len(ends)), dtype=np.int64)
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            col = [b.column(i + 1).to_numpy(zero_copy_only=False) for i in range(len(feats))]
            pos_rows, neg_rows = y == 1, y == 0         # a row without a label is in neither
            sums = [np.full(b.num_rows, base)]
            for d in range(-1, len(steps)):
                if d >= 0:
                    sums = [sums[at] + col[f] for at, f in steps[d]]
                for pos, at in stop.get(d, ()):
                    hit = sums[at] > 0
                    hits[0, pos] += np.count_nonzero(hit & pos_rows)
                    hits[1, pos] += np.count_nonzero(hit & neg_rows)
        if hits.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(len(ends)), pa.int32()), pa.array(hits[0]), pa.array(hits[1])],
                                             names=["pos", "tp", "fp"])
    return count


def nb_subset_search(train: DataFrame, test: DataFrame, subsets: list[list[str]], target: str = "target",
                     model: DataFrame | None = None) -> DataFrame:
    """ML8: ``(subset_id, n_features, features, auc)`` of a Naive Bayes model per
    subset (``features`` = the subset's names joined by '+', in draw order).

    Fit once over the union of the subsets' features and score each test row once
    per feature.  The sums run down the trie of the subsets in Arrow batches, so a prefix
    that several subsets share is added once; a task keeps one counter per subset and
    class and sends #subsets rows at its end.  No row is exploded.  The negatives follow
    from the two class totals.  Built-in functions can say this too, but only as hundreds of
    counters that no longer compile to one method (measured: about as slow as exploding)."""
    feats = sorted({f for s in subsets for f in s}, key=lambda f: SEARCH_FEATURES.index(f) if f in SEARCH_FEATURES else 99)
    model = nb_fit(train, feats, target) if model is None else model
    params = model_params(model)
    c0, c1 = params["classes"][0], params["classes"][-1]
    x = _with_text_probs(test, model, feats, params["classes"])
    ll = nb_scores(x, params, feats)
    base = math.log(params["prior"][c1]) - math.log(params["prior"][c0])
    y = F.col(target).cast("long")
    x = x.select(y.alias("_y"), *[(ll[f][c1] - ll[f][c0]).alias(f"_d{i}") for i, f in enumerate(feats)])
    counted = x.mapInArrow(_count_hits(*subset_trie(subsets), feats, base), "pos INT, tp LONG, fp LONG")
    found = counted.groupBy("pos").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))
    total = test.agg(F.struct(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")))
    names = [(i, len(s), "+".join(s)) for i, s in enumerate(subsets)]
    trials = test.sparkSession.createDataFrame(names, "pos INT, n_features INT, features STRING")
    res = trials.join(F.broadcast(found), "pos", "left").withColumn("_t", total.scalar())      # at most #subsets rows
    tp, fp = F.coalesce("tp", F.lit(0)), F.coalesce("fp", F.lit(0))
    return res.select((F.col("pos") + 1).alias("subset_id"), "n_features", "features",
                      hard_label_auc(tp, F.col("_t.pos") - tp, F.col("_t.neg") - fp, fp).alias("auc"))


def top_models(search: DataFrame, k: int = 10) -> DataFrame:
    """SL3: best subsets by AUC (ties: smaller subset id)."""
    return search.orderBy(F.desc("auc"), F.asc("subset_id")).limit(k)


def final_auc(train: DataFrame, test: DataFrame, features: Sequence[str] = FINAL_FEATURES,
              target: str = "target") -> DataFrame:
    """ML9: AUC of the fixed final model on the test rows (one row)."""
    p = nb_predict(test, nb_fit(train, features, target), features, "pred")
    tp, fn, tn, fp = _confusion_auc(F.col("pred").cast("int"), F.col(target).cast("int"))
    return p.agg(hard_label_auc(tp, fn, tn, fp).alias("auc"))
