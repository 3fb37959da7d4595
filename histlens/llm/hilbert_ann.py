"""Approximate nearest neighbours by shifted Hilbert curves.

Vectors are projected to a few dimensions, ``CURVES`` times by different rotations and
shifts, and each projection is laid on a Hilbert curve.  Every curve is range-partitioned
and sorted by Spark; the order is cut into blocks and a query is compared with its
own block and those beside it on every curve.  The findings of all curves merge and
are ranked by the exact inner product in double precision.

How wide the windows must be depends on the table: ``TRIED`` queries are compared
with every row, and the windows are the narrowest that find ``RECALL`` of those true
neighbours.  Vectors in clusters keep narrow windows; on vectors without any structure
the windows grow with the table, and so does the work of each query.

Equal vectors are one point of the curves with the ids of its copies (the smallest
ones that a result can hold), so that a very common vector fills no window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histlens.llm.common import Stages, partitions, slices

CURVES = 16
DIMS, BITS = 8, 8               # a curve's key has DIMS * BITS = 64 bits
BLOCK = 1536                    # vectors of the smallest block
BLOCK_VALUES = 1 << 21          # components of the largest one; wider windows take more blocks
TRIED, RECALL = 256, 0.95       # queries that set the windows, and the share of their neighbours to be found
SAMPLE = 4096                   # vectors that set the range of each projection
TOP = 20


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index (uint64) of integer cells, n x d, each below 2**bits (Skilling's transform)."""
    x = cells.T.astype(np.uint64)
    d, one = len(x), np.uint64(1)
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        low = q - one
        for i in range(d):
            up = (x[i] & q) != 0
            t = (x[0] ^ x[i]) & low
            x[0] = np.where(up, x[0] ^ low, x[0] ^ t)
            if i:
                x[i] = np.where(up, x[i], x[i] ^ t)
        q >>= one
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), np.uint64(1 << (bits - 1))
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - one), t)
        q >>= one
    x ^= t
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def make_curves(dim: int, sample: np.ndarray, curves: int = CURVES) -> list[tuple[np.ndarray, ...]]:
    """Per curve its rotation and shift (by a fixed seed) and the range of its projection (from a sample)."""
    rng = np.random.default_rng(11)
    dims = min(DIMS, dim)
    flat = _unit(sample) if len(sample) else np.zeros((1, dim))
    out = []
    for _ in range(curves):
        turn, shift = np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, :dims], rng.uniform(0, 0.25, dims)
        out.append((turn, shift, np.quantile(flat @ turn, 0.002, axis=0), np.quantile(flat @ turn, 0.998, axis=0)))
    return out


def curve_keys(curves: list[tuple[np.ndarray, ...]], x: np.ndarray) -> list[np.ndarray]:
    """Per curve the keys of the vectors, as int64 in the order of the curve."""
    x, out = _unit(x), []
    for turn, shift, lo, hi in curves:
        y = ((x @ turn - lo) / np.maximum(hi - lo, 1e-12)).clip(0, 1)
        cells = ((y + shift) / 1.25 * (1 << BITS)).astype(np.uint64).clip(0, (1 << BITS) - 1)
        out.append((hilbert_key(cells) ^ np.uint64(1 << 63)).view(np.int64))
    return out


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _keyed(curves) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                for m, key in enumerate(curve_keys(curves.value, _matrix(b.column(1)))):
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(b.num_rows, m, np.int32)), pa.array(key)], ["vid", "curve", "key"])
    return run


def _search(top: int):
    def run(table: pa.Table) -> pa.Table:
        """The nearest vectors of one block for the queries that look into it."""
        ask = table.column("ask").to_numpy(zero_copy_only=False)
        ids = table.column("vid").to_numpy()
        x = _matrix(table.column("embedding").combine_chunks())
        q, c = np.flatnonzero(ask), np.flatnonzero(~ask)
        c = c[np.unique(ids[c], return_index=True)[1]]         # a block of a short curve's end holds some twice
        got: tuple[list, list, list] = ([], [], [])
        step = max(1, min(512, (1 << 22) // max(len(c), 1)))
        for i in range(0, len(q) if len(c) else 0, step):
            part = q[i : i + step]
            s = x[part] @ x[c].T
            s[ids[part][:, None] == ids[c][None, :]] = -np.inf
            k = min(top, len(c))
            # k best, ties to the smaller id: everything above the k-th score and enough of the equal ones
            best = np.argpartition(-s, k - 1, axis=1)[:, :k]
            least = np.take_along_axis(s, best, 1).min(1)
            for r in range(len(part)):
                at = np.flatnonzero(s[r] >= least[r])
                at = at[np.lexsort((ids[c][at], -s[r][at]))][:k]
                at = at[s[r][at] > -np.inf]
                got[0].append(np.full(len(at), ids[part[r]]))
                got[1].append(ids[c][at])
                got[2].append(s[r][at])
        cat = [np.concatenate(g) if g else np.zeros(0) for g in got]
        return pa.table({"q": cat[0].astype(np.int64), "c": cat[1].astype(np.int64), "score": cat[2].astype(np.float64)})
    return run


def _scan(tried, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nearest vectors of one partition for each tried query."""
        qid, q = tried.value
        ids, score = np.zeros((len(qid), 0), np.int64), np.zeros((len(qid), 0))
        for b in slices(batches, 2048):
            if b.num_rows:
                vid = b.column(0).to_numpy()
                s = q @ _matrix(b.column(1)).T
                s[qid[:, None] == vid[None, :]] = -np.inf
                score = np.concatenate([score, s], 1)
                ids = np.concatenate([ids, np.broadcast_to(vid, s.shape)], 1)
                best = np.lexsort((ids, -score), axis=1)[:, :top]
                ids, score = np.take_along_axis(ids, best, 1), np.take_along_axis(score, best, 1)
        r, k = np.nonzero(score > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(qid[r]), pa.array(ids[r, k]), pa.array(score[r, k])], ["q", "c", "score"])
    return run


def windows(block: int, largest: int, rows: int) -> Iterator[tuple[int, int]]:
    """(block, reach) from narrow to all rows: blocks grow up to the largest, then more of them are looked into."""
    while block < min(largest, rows):
        yield block, 1
        block = min(largest, block + max(1, block // 4))
    reach = 1
    while reach * block < rows:
        yield block, reach
        reach += max(1, reach // 4)
    yield block, reach


def _window(points: DataFrame, place: DataFrame, dim: int, top: int, block: int, rows: int) -> tuple[int, int]:
    """The narrowest window that finds RECALL of the true neighbours of TRIED queries."""
    spark = points.sparkSession
    got = points.filter("ask").select("vid", "embedding", F.xxhash64("vid").alias("h")).orderBy("h").limit(TRIED).toArrow()
    largest = max(block, BLOCK_VALUES // dim)
    if rows <= block or not got.num_rows:
        return block, 1
    tried = spark.sparkContext.broadcast((got.column("vid").to_numpy(), _matrix(got.column("embedding").combine_chunks())))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    true = (points.select("vid", "embedding").mapInArrow(_scan(tried, top), "q long, c long, score double")
            .withColumn("k", F.row_number().over(best)).filter(F.col("k") <= top).select("q", "c").toArrow())
    q, c = true.column("q").to_numpy(), true.column("c").to_numpy()
    need = np.unique(np.concatenate([q, c]))
    at = place.join(F.broadcast(spark.createDataFrame(pa.table({"vid": need}))), "vid").select("vid", "pos").toArrow()
    vid, pos = at.column("vid").to_numpy(), at.column("pos").to_numpy()
    pos = pos[np.lexsort((pos, vid))].reshape(len(need), -1)          # a column a curve
    a, b = pos[np.searchsorted(need, q)], pos[np.searchsorted(need, c)]
    for size, reach in windows(block, largest, rows):
        if (np.abs(a // size - b // size) <= reach).any(1).mean() >= RECALL:
            break
    return size, reach


def nearest(vectors: DataFrame, is_query, top: int = TOP, id_col: str = "vec_id", vec_col: str = "embedding",
            curves: int = CURVES, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that fits ``is_query`` (a Column) its
    nearest other rows by inner product, at most ``top``, ties to the smaller id.
    ``block`` is the smallest size of a block.

    Rows with a null id, and vectors that are null, empty, zero or hold null or non-finite components take no part;
    nor do vectors of another length than most.  Directions place a vector on the
    curves, so vectors of very different lengths are found less surely.  Of fewer than
    ``top`` other rows all are returned; an empty table gives an empty result.  Repeated rows
    with one id count as one.
    """
    spark = vectors.sparkSession
    st = Stages(spark, "ann")
    fine = F.forall(vec_col, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf"))) & F.exists(vec_col, lambda v: v != 0)
    valid = (vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & fine)
             .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<float>").alias("embedding"),
                     is_query.alias("ask"), F.size(vec_col).alias("dim")))
    common = valid.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    dim = common["dim"] if common else 1
    valid = valid.filter(F.col("dim") == dim).drop("dim")
    few = F.row_number().over(Window.partitionBy("embedding").orderBy("id"))
    ids = (valid.select("embedding", "id").distinct().withColumn("k", few).filter(F.col("k") <= top + 1)       # bounded lists
           .groupBy("embedding").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    points = valid.groupBy("embedding").agg(F.min("id").alias("vid"), F.max("ask").alias("ask"))
    points = st.write(points.join(ids, "embedding"), "points")

    sample = points.select("embedding", F.xxhash64("vid").alias("h")).orderBy("h").limit(SAMPLE).toArrow().column("embedding").combine_chunks()
    made = spark.sparkContext.broadcast(make_curves(dim, _matrix(sample) if len(sample) else np.zeros((0, dim)), curves))
    keys = points.select("vid", "embedding").mapInArrow(_keyed(made), "vid long, curve int, key long")
    ordered = (keys.repartitionByRange(partitions(spark), "curve", "key", "vid").sortWithinPartitions("curve", "key", "vid")
               .withColumn("at", F.monotonically_increasing_id()).select("vid", "at"))
    ordered = st.write(ordered, "ordered")
    low = (1 << 33) - 1
    sizes = ordered.groupBy(F.shiftright("at", 33).alias("part")).agg((F.max(F.col("at").bitwiseAND(low)) + 1).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)       # a row a partition
    base = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    place = (ordered.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(base), "part")
             .select("vid", (F.col("base") + F.col("at").bitwiseAND(low)).alias("pos")))
    size, reach = _window(points, place, dim, top, block, points.count())
    place = place.select("vid", F.floor(F.col("pos") / size).alias("block"))
    homes = place.groupBy("vid").agg(F.collect_list("block").alias("blocks"))        # one entry a curve
    rows = st.write(points.select("vid", "embedding", "ask").join(homes, "vid"), "rows")
    here = rows.select(F.explode("blocks").alias("block"), "vid", "embedding", F.lit(False).alias("ask"))
    near = (rows.filter("ask").select(F.explode(F.array_distinct(F.flatten(F.transform("blocks", lambda b: F.sequence(b - reach, b + reach))))).alias("block"),
                                      "vid", "embedding", "ask"))
    hits = here.unionByName(near).groupBy("block").applyInArrow(_search(top), "q long, c long, score double")
    hits = hits.groupBy("q", "c").agg(F.max("score").alias("score"))

    best = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    hits = st.write(hits.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= top).drop("k"), "hits")
    own = points.filter("ask").select(F.col("vid").alias("q"), F.col("vid").alias("c"),
                                      F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")).alias("score"))
    each = (hits.unionByName(own).join(points.select(F.col("vid").alias("c"), "ids"), "c")
            .select("q", "score", F.explode("ids").alias("vec_id")))
    first = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    each = each.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= top + 1)
    tops = st.write(each.groupBy("q").agg(F.collect_list(F.struct("vec_id", "score")).alias("found")), "tops")
    askers = st.write(valid.filter("ask").select("id", "embedding").distinct(), "askers")
    askers = st.write(askers.join(points.select("embedding", F.col("vid").alias("q")), "embedding").select("id", "q"), "asker_points")
    out = askers.join(tops, "q").select(F.col("id").alias("query_id"), F.inline("found")).filter("query_id <> vec_id")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (out.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))
