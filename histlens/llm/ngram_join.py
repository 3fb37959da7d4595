"""N-gram Jaccard self-join of documents by a grouped prefix join.

Sets are the distinct word shingles of whole texts.  In one global order of
shingles (common ones last) two sets of similarity t or more share a shingle
within their first |x| - ceil(t|x|) + 1 ones, their prefixes.  Sets of one size
with identical prefixes form one group; groups that share a prefix shingle and
pass the length and position bounds are candidates; candidates are expanded to
their member sets and verified exactly.

Large families of near copies would make all pairs of a shingle's list.  So
every list is first joined to one pivot (a star, linear in its length) and the
verified links are contracted to components; only pairs of lists that still
hold several components are then enumerated, and only across components.  These
lists are joined by token and size band: the smaller set of a pair looks only into the
sizes that its place in the list admits, and sets for which no size is left send nothing.
The pairs of short lists are named with their stars, where the list is put together.
No link between components is lost: every pair that the prefix bound leaves is
either verified or already inside one component.

Scale: shingle counts and prefix postings travel as sorted, packed number ranges, and of
the postings only those of shared shingles leave the task that puts a range together; the list of
common shingles that is broadcast has at most ``MAX_COMMON`` entries, because a
shingle counts as common from (all shingles / MAX_COMMON) occurrences; joins on
hot keys have a plain exchange on both sides, so that AQE can split them.  Whole sets
travel only for pairs that a parity sketch in proportion to their size leaves.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histlens.llm.common import Stages, byte_texts, forget_kept, partitions, slices
from histlens.llm.shingles import Shingler, set_id

PERCENT = 80
COMMON_FROM = 64                # a shingle with fewer occurrences is never common
MAX_COMMON = 1 << 21            # bound of the broadcast list of common shingles
COUNT_BITS = 28                 # shingles are counted by their first bits: 128 slots for each of MAX_COMMON, at any size of the data
FLUSH = 2_000_000               # shingles counted at a time in a task
TOKEN_BITS = 44                 # first bits of a shingle in a posting; shingles that agree in them only make more candidates
POST_FLUSH = 1_000_000          # postings packed at a time in a task
SHORT = 8                       # lists of up to so many groups name their pairs at once
SKETCH_BITS = 1024              # parity sketch of a set
WIDE_FROM = SKETCH_BITS // 2    # larger sets have a second sketch of 2 to 4 bits a shingle
BANDS = 4                       # size bands up to the largest admissible partner (a size ratio of 100 / PERCENT)
FILTER_BITS = 25                # bits (as a power of 2) of the filter of texts to read again


# --- shingle counts -----------------------------------------------------------
def _pack(tokens: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted numbers as differences by byte planes, counts as bytes (255: wide counts follow)."""
    gaps = np.diff(tokens, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    wide = counts[counts >= 255].astype(np.uint32)
    body = gaps.tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes() + wide.tobytes()
    return len(tokens).to_bytes(4, "little") + zlib.compress(body, 1)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    body = np.frombuffer(zlib.decompress(blob[4:]), np.uint8)
    gaps = np.ascontiguousarray(body[: 8 * n].reshape(8, n).T).view(np.uint64).ravel()
    counts = body[8 * n : 9 * n].astype(np.int64)
    counts[counts == 255] = body[9 * n :].view(np.uint32)
    return np.cumsum(gaps, dtype=np.uint64), counts


def _count_parts(text_col: str, ranges: int):
    """Count shingles by their first COUNT_BITS bits: (range, blob) rows of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        shingler, held, size = Shingler(), [], 0
        edges = (np.arange(1, ranges, dtype=np.float64) * (2.0**COUNT_BITS / ranges)).astype(np.uint64)

        def flush():
            t, c = np.unique(np.concatenate(held) >> np.uint64(64 - COUNT_BITS), return_counts=True)
            cuts = [0, *np.searchsorted(t, edges), len(t)]
            rows = [(r, _pack(t[a:b], c[a:b])) for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            return pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["range", "blob"])

        for b in slices(batches):
            for t in byte_texts(b, text_col):
                s = shingler(t)
                if len(s):
                    held.append(s)
                    size += len(s)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
    return run


def _merge_parts(table):
    """Sum the counts of one range; shingles below COMMON_FROM only enter the total (token -1)."""
    got = [_unpack(blob.as_py()) for blob in table.column("blob")]
    t, inv = np.unique(np.concatenate([x for x, _ in got]), return_inverse=True)
    c = np.bincount(inv, np.concatenate([n for _, n in got]).astype(np.float64), len(t)).astype(np.int64)
    much = c >= COMMON_FROM
    return pa.table({"token": np.append(t[much].astype(np.int64), -1), "n": np.append(c[much], c.sum())})


def common_shingles(docs: DataFrame, st: Stages, text_col: str) -> np.ndarray:
    """Sorted first bits of the shingles that many documents hold (at most MAX_COMMON)."""
    ranges = 2 * partitions(st.spark)
    counts = (docs.select(text_col).mapInArrow(_count_parts(text_col, ranges), "range int, blob binary")
              .groupBy("range").applyInArrow(_merge_parts, "token long, n long"))
    counts = st.write(counts, "counts")
    total = counts.filter("token = -1").agg(F.sum("n")).first()[0] or 0
    least = max(COMMON_FROM, -(-total // MAX_COMMON))
    found = counts.filter((F.col("token") >= 0) & (F.col("n") >= least)).select("token").toArrow()
    st.drop("counts")
    return np.sort(found.column(0).to_numpy().astype(np.uint64))


# --- sets, prefixes, groups ----------------------------------------------------
_SETS = ("doc long, rid long, text_id long, size int, light int, cid long, gid long, heavy array<long>, sketch binary, wide binary, "
         "range int, blob binary")


def _sketch(tokens: np.ndarray, bits: int = SKETCH_BITS) -> bytes:
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _wide_bits(size: int) -> int:
    """Bits of the second sketch: the power of 2 in [2 size, 4 size)."""
    return 1 << (2 * size - 1).bit_length()


def _planes(numbers: np.ndarray, kind) -> bytes:
    return numbers.astype(kind).view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _read_planes(body: np.ndarray, at: int, n: int, kind) -> tuple[np.ndarray, int]:
    end = at + n * np.dtype(kind).itemsize
    return np.ascontiguousarray(body[at:end].reshape(-1, n).T).view(kind).ravel(), end


def _pack_posts(tokens, gids, sizes, pos, counts) -> bytes:
    """Postings of sets one after another: of each its group, size, first position and number of
    tokens; the tokens, which rise within a set, as differences by byte planes."""
    gaps = np.diff(tokens, prepend=np.uint64(0))
    starts = np.cumsum(counts) - counts
    gaps[starts] = tokens[starts]
    body = b"".join([_planes(gids, np.int64), _planes(sizes, np.uint32), _planes(pos, np.uint32), _planes(counts, np.uint32), _planes(gaps, np.uint64)])
    return len(gids).to_bytes(4, "little") + len(tokens).to_bytes(4, "little") + zlib.compress(body, 1)


def _unpack_posts(blob: bytes) -> tuple[np.ndarray, ...]:
    """(token, group, size, position) of every posting."""
    k, n = int.from_bytes(blob[:4], "little"), int.from_bytes(blob[4:8], "little")
    body = np.frombuffer(zlib.decompress(blob[8:]), np.uint8)
    gids, at = _read_planes(body, 0, k, np.int64)
    sizes, at = _read_planes(body, at, k, np.uint32)
    pos, at = _read_planes(body, at, k, np.uint32)
    counts, at = _read_planes(body, at, k, np.uint32)
    gaps, _ = _read_planes(body, at, n, np.uint64)
    counts = counts.astype(np.int64)
    starts = np.cumsum(counts) - counts
    run = np.cumsum(gaps, dtype=np.uint64)
    tokens = run - np.repeat(run[starts] - gaps[starts], counts)
    place = np.arange(n) - np.repeat(starts, counts)
    return tokens, np.repeat(gids, counts), np.repeat(sizes.astype(np.int64), counts), np.repeat(pos.astype(np.int64), counts) + place


def _sets(text_col: str, common, ranges: int) -> object:
    """A row a document; the postings of its prefix without common shingles are packed by ranges of
    shingles, several documents at a time (rows that have only a range and a blob)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        shingler, heavy = Shingler(), common.value
        edges = (np.arange(1, ranges, dtype=np.float64) * (2.0**TOKEN_BITS / ranges)).astype(np.uint64)
        held, seen, size = [], set(), 0

        def batch(cols: dict, n: int) -> pa.RecordBatch:
            arrays = [pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in _SETS_ARROW]
            return pa.RecordBatch.from_arrays(arrays, schema=_SETS_ARROW)

        def flush() -> pa.RecordBatch:
            tokens = np.concatenate([t for t, _, _ in held])
            lens = np.array([len(t) for t, _, _ in held])
            at = np.searchsorted(edges, tokens, "right")
            order = np.argsort(at, kind="stable")
            of = np.repeat(np.arange(len(held)), lens)[order]
            pos = (np.arange(len(tokens)) - np.repeat(np.cumsum(lens) - lens, lens))[order]
            tokens, at = tokens[order], at[order]
            gids, sizes = np.array([g for _, g, _ in held], np.int64), np.array([n for _, _, n in held], np.int64)
            cuts = np.searchsorted(at, np.arange(ranges + 1))
            rows = []
            for r in range(ranges):
                a, b = cuts[r], cuts[r + 1]
                if b > a:
                    first = np.flatnonzero(np.diff(of[a:b], prepend=-1))
                    own = of[a:b][first]
                    rows.append((r, _pack_posts(tokens[a:b], gids[own], sizes[own], pos[a:b][first], np.diff(first, append=b - a))))
            return batch({"range": [r for r, _ in rows], "blob": [x for _, x in rows]}, len(rows))

        for b in slices(batches):
            out = []
            for t in byte_texts(b, text_col):
                s = shingler(t)
                if not len(s):
                    out.append((0, 0, *[None] * 5))
                    continue
                at = np.searchsorted(heavy, s >> np.uint64(64 - COUNT_BITS))
                is_common = (heavy[np.minimum(at, len(heavy) - 1)] == s >> np.uint64(64 - COUNT_BITS)) if len(heavy) else np.zeros(len(s), bool)
                keep = len(s) - -(-PERCENT * len(s) // 100) + 1
                light = s[~is_common][:keep]
                last = s[is_common][: keep - len(light)]
                gid = set_id(np.concatenate([light, last, np.array([len(s)], np.uint64)]))
                if len(light) and gid not in seen:
                    seen.add(gid)
                    held.append((light >> np.uint64(64 - TOKEN_BITS), gid, len(s)))
                    size += len(light)
                wide = _sketch(s, _wide_bits(len(s))) if len(s) > WIDE_FROM else None
                out.append((len(s), len(light), set_id(s), gid, last.view(np.int64), _sketch(s), wide))
            cols = dict(zip(("size", "light", "cid", "gid", "heavy", "sketch", "wide"), zip(*out)))
            yield batch({"doc": b.column(0).to_pylist(), "rid": b.column(1).to_pylist(), "text_id": b.column(2).to_pylist(), **cols}, b.num_rows)
            if size >= POST_FLUSH:
                yield flush()
                held, seen, size = [], set(), 0
        if held:
            yield flush()
    return run


_SETS_ARROW = pa.schema([("doc", pa.int64()), ("rid", pa.int64()), ("text_id", pa.int64()), ("size", pa.int32()), ("light", pa.int32()),
                         ("cid", pa.int64()), ("gid", pa.int64()), ("heavy", pa.list_(pa.int64())), ("sketch", pa.binary()), ("wide", pa.binary()),
                         ("range", pa.int32()), ("blob", pa.binary())])


def _admits(n, p, m, q) -> np.ndarray:
    """``_bounds`` over arrays: sizes n, m and positions p, q of a shared shingle."""
    need = (PERCENT * (n + m) + 99 + PERCENT) // (100 + PERCENT)
    return (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)) & (np.minimum(n - p, m - q) >= need)


def _merge_posts(table):
    """The lists of one range of shingles: stars (g, h, star) to a list's pivot, the other pairs (g, h) of
    short lists, and the postings (token, gid, size, pos) of longer ones but for their pivots.

    The pivot of a list is its smallest group; a pair with it needs no second look, so it stands in no posting."""
    tokens, gids, sizes, pos = (np.concatenate(x) for x in zip(*[_unpack_posts(blob.as_py()) for blob in table.column("blob")]))
    order = np.lexsort((pos, gids, tokens))
    tokens, gids, sizes, pos = tokens[order], gids[order], sizes[order], pos[order]
    new = np.ones(len(tokens), bool)                        # one row of a group in a list, the earliest
    new[1:] = (tokens[1:] != tokens[:-1]) | (gids[1:] != gids[:-1])
    tokens, gids, sizes, pos = tokens[new], gids[new], sizes[new], pos[new]
    first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
    lens = np.diff(first, append=len(tokens))
    place = np.arange(len(tokens)) - np.repeat(first, lens)
    k = np.repeat(lens, lens)

    def pairs(at, by) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of groups at two rows of one list that pass the bounds, smaller group first."""
        ok = _admits(sizes[by], pos[by], sizes[at], pos[at])
        g, h = gids[by[ok]], gids[at[ok]]
        order = np.lexsort((h, g))
        g, h = g[order], h[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (h[1:] != h[:-1])
        return g[new], h[new]
    at = np.flatnonzero(place > 0)
    star = pairs(at, at - place[at])
    short = [np.flatnonzero((k <= SHORT) & (place > back)) for back in range(1, SHORT - 1)]     # the row so many places before, but for the pivot
    more = pairs(np.concatenate(short), np.concatenate([at - back for back, at in enumerate(short, 1)]))
    long = (k > SHORT) & (place > 0)
    parts = [{"kind": np.full(len(star[0]), 0), "g": star[0], "h": star[1]}, {"kind": np.full(len(more[0]), 1), "g": more[0], "h": more[1]},
             {"kind": np.full(int(long.sum()), 2), "g": gids[long], "token": tokens[long], "size": sizes[long], "pos": pos[long]}]
    return pa.concat_tables([pa.table([pa.array(p[f.name]).cast(f.type) if f.name in p else pa.nulls(len(p["g"]), f.type) for f in _LISTS_ARROW],
                                      schema=_LISTS_ARROW) for p in parts])


_LISTS = "kind int, g long, h long, token long, size int, pos int"
_LISTS_ARROW = pa.schema([("kind", pa.int32()), ("g", pa.int64()), ("h", pa.int64()), ("token", pa.int64()), ("size", pa.int32()), ("pos", pa.int32())])


def _whole_sets(text_col: str, wanted) -> object:
    """(cid, tokens) of the rows that pass the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        shingler, bits = Shingler(), wanted.value
        for b in slices(batches):
            ids = b.column(0).to_numpy() & ((1 << FILTER_BITS) - 1)
            b = b.filter(pa.array((bits[ids >> 6] >> (ids & 63)) & 1 == 1))
            sets = [s for s in map(shingler, byte_texts(b, text_col)) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_id(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["cid", "tokens"])
    return run


# --- candidates and verification -------------------------------------------------
def _bounds(a: str, b: str):
    """Length and position bounds for a shared shingle at positions a.pos and b.pos."""
    na, nb = F.col(f"{a}.size"), F.col(f"{b}.size")
    need = F.floor((PERCENT * (na + nb) + 99 + PERCENT) / (100 + PERCENT))      # least overlap of a link
    left = F.least(na - F.col(f"{a}.pos"), nb - F.col(f"{b}.pos"))                # most overlap from here on
    return (100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)) & (left >= need)


def open_pairs(posts: DataFrame) -> DataFrame:
    """Distinct pairs (g, h), g < h, of groups that share a token within the bounds and are not inside
    one component.  ``posts``: (token, gid, size, pos, lo, hi, main), lo and hi being the smallest and
    largest component of the group and main one component of the token's list (or null).

    Of sizes s <= t a shared shingle at position p of the smaller set admits
    t <= (100 + PERCENT) (s - p) / PERCENT - s, so a set whose shingle stands too far back looks
    for no partner at all: sets of a family just under the threshold are dropped here, before any pairing.
    Two groups of the main component never meet: groups of it look only for others.
    """
    s = F.col("size")
    inside = F.coalesce((F.col("lo") == F.col("hi")) & (F.col("lo") == F.col("main")), F.lit(False))
    most = F.floor(F.least(100 * s, (100 + PERCENT) * (s - F.col("pos")) - PERCENT * s) / PERCENT)

    def band(size):
        return F.floor(F.log(size.cast("double")) * (BANDS / math.log(100 / PERCENT))).cast("int")
    posts = posts.select("token", "gid", "size", "pos", "lo", "hi", inside.alias("inside"), most.alias("most"))
    small = (posts.filter(F.col("most") >= s)
             .withColumn("side", F.col("inside").cast("int")).withColumn("band", F.explode(F.sequence(band(s), band(F.col("most"))))))
    large = posts.withColumn("band", band(s)).withColumn("side", F.explode(F.when(F.col("inside"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
    a, b = small.alias("a"), large.alias("b")
    same = (F.col("a.lo") == F.col("a.hi")) & (F.col("a.lo") == F.col("b.lo")) & (F.col("b.lo") == F.col("b.hi"))
    first = (F.col("a.size") < F.col("b.size")) | ((F.col("a.size") == F.col("b.size")) & (F.col("a.gid") < F.col("b.gid")))
    return (a.join(b, ["token", "side", "band"]).filter(first & _bounds("a", "b") & ~same)
            .select(F.least("a.gid", "b.gid").alias("g"), F.greatest("a.gid", "b.gid").alias("h")).distinct())


def _near_wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose second sketches do not stand too far apart (the longer one folded to the other's length)."""
    for b in batches:
        n = b.column("size_x").to_numpy().astype(np.int64) + b.column("size_y").to_numpy()
        most = n - 2 * ((PERCENT * n + 99 + PERCENT) // (100 + PERCENT))
        keep = np.zeros(b.num_rows, bool)
        for i, (x, y) in enumerate(zip(b.column("wide_x"), b.column("wide_y"))):
            x, y = (np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y))
            while len(x) != len(y):
                if len(x) < len(y):
                    x, y = y, x
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            keep[i] = np.bitwise_count(x ^ y).sum() <= most[i]
        yield b.select(["x", "y", "size_x", "size_y"]).filter(pa.array(keep))


def _verify(st: Stages, docs: DataFrame, sets: DataFrame, members: DataFrame, pairs: DataFrame, text_col: str, id_col: str, tag: str) -> DataFrame:
    """The pairs (x, y) of set ids whose Jaccard similarity reaches the bound."""
    m = members.select("cid", "size", "sketch")
    near = (pairs.join(m.toDF("x", "size_x", "sketch_x"), "x").join(m.toDF("y", "size_y", "sketch_y"), "y"))
    need = F.floor((PERCENT * (F.col("size_x") + F.col("size_y")) + 99 + PERCENT) / (100 + PERCENT))
    apart = _parity_distance(F.col("sketch_x"), F.col("sketch_y"))
    near = st.write(near.filter((100 * F.least("size_x", "size_y") >= PERCENT * F.greatest("size_x", "size_y"))
                                & (apart <= F.col("size_x") + F.col("size_y") - 2 * need))
                    .select("x", "y", "size_x", "size_y"), f"first_{tag}")
    # 1024 bits say nothing of large sets: of those the second sketches are compared
    large = near.filter(F.least("size_x", "size_y") > WIDE_FROM)
    ids = st.write(large.select(F.col("x").alias("cid")).union(large.select("y")).distinct(), f"large_{tag}")
    wide = (sets.filter("wide IS NOT NULL").select("cid", "wide").join(ids, "cid", "left_semi").groupBy("cid").agg(F.first("wide").alias("wide")))
    large = (large.join(wide.toDF("x", "wide_x"), "x").join(wide.toDF("y", "wide_y"), "y")
             .mapInArrow(_near_wide, "x long, y long, size_x int, size_y int"))
    near = st.write(near.filter(F.least("size_x", "size_y") <= WIDE_FROM).unionByName(large), f"near_{tag}")
    ids = st.write(near.select(F.col("x").alias("cid")).union(near.select(F.col("y"))).distinct(), f"ids_{tag}")
    # of the rows of a set one is read again; a bitmap of fixed size says which, rows that pass it by chance are joined away
    picks = sets.select("cid", F.xxhash64("text_id", "doc").alias("pick")).join(ids, "cid").groupBy("cid").agg(F.min("pick").alias("pick"))
    at = F.col("pick").bitwiseAND((1 << FILTER_BITS) - 1)
    words = (picks.groupBy(F.shiftright(at, 6).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(pick & 63 AS INT))")).alias("m")).toArrow())
    bits = np.zeros(1 << FILTER_BITS >> 6, np.int64)
    bits[words.column("w").to_numpy()] = words.column("m").to_numpy()
    wanted = st.spark.sparkContext.broadcast(bits)
    whole = (docs.select(F.xxhash64(F.xxhash64(text_col), F.col(id_col).cast("long")).alias("pick"), text_col)
             .mapInArrow(_whole_sets(text_col, wanted), "cid long, tokens array<long>"))
    whole = st.write(whole, f"whole_{tag}").join(ids, "cid", "left_semi").groupBy("cid").agg(F.first("tokens").alias("tokens"))
    both = near.join(whole.toDF("x", "tokens_x"), "x").join(whole.toDF("y", "tokens_y"), "y")
    common = F.size(F.array_intersect("tokens_x", "tokens_y"))
    links = st.write(both.withColumn("common", common)
                     .filter(100 * F.col("common") >= PERCENT * (F.col("size_x") + F.col("size_y") - F.col("common")))
                     .select("x", "y"), f"links_{tag}")
    st.drop(f"first_{tag}", f"large_{tag}", f"near_{tag}", f"ids_{tag}", f"whole_{tag}")
    return links


def _parity_distance(a, b):
    """Bits in which two sketches differ (a lower bound of the symmetric difference)."""
    words = [F.conv(F.hex(F.substring(c, i, 8)), 16, -10).cast("long") for i in range(1, SKETCH_BITS // 8 + 1, 8) for c in (a, b)]
    return sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(words[::2], words[1::2])), F.lit(0))


# --- components --------------------------------------------------------------------
def components(st: Stages, edges: DataFrame, tag: str) -> DataFrame:
    """(node, root): root is the smallest node of a component of (x, y) edges; written.

    Every round each node takes its smallest neighbour's smallest neighbour and
    the edges between different roots are kept; their number falls quickly.
    """
    cur = st.write(edges.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).filter("x <> y").distinct(), f"edges_{tag}0")
    roots = st.write(cur.select(F.col("x").alias("node")).union(cur.select("y")).distinct().withColumn("root", F.col("node")), f"roots_{tag}0")
    step = 0
    while not cur.isEmpty():
        step += 1
        hook = (cur.union(cur.select("y", "x")).toDF("v", "u").groupBy("v").agg(F.min("u").alias("u"))
                .select("v", F.least("u", "v").alias("p")))
        hook = st.write(hook, f"hook_{tag}{step}")
        jump = st.write(hook.join(hook.toDF("p", "pp"), "p").select("v", "pp"), f"jump_{tag}{step}")
        moved = (cur.join(jump.toDF("x", "a"), "x").join(jump.toDF("y", "b"), "y")
                 .select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).filter("x <> y").distinct())
        cur = st.write(moved, f"edges_{tag}{step}")
        roots = st.write(roots.join(jump.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), f"roots_{tag}{step}")
        st.drop(f"edges_{tag}{step - 1}", f"roots_{tag}{step - 1}", f"hook_{tag}{step}", f"jump_{tag}{step}")
    return roots


# --- the join ------------------------------------------------------------------------
def near_duplicates(rows: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Connected components of documents whose 5-word shingle sets have Jaccard similarity 0.8 or more.

    ``rows``: a table with a unique ``rid`` (long, which only needs to hold within one scan), an
    integer id and a text.  One row per input row: (<id_col>, rid, text_id, n_shingles,
    component_id, kept); text_id is the 64-bit hash of its text.  component_id is the smallest id in the row's component;
    of each component the row with the smallest (id, rid) is ``kept``.  A null, empty or
    blank text has the empty set, links with nothing and is kept.  Repeated rows
    are rows of one set and so linked.  Null ids count as the largest; a component of
    null ids has a null component_id.  Other columns are ignored; an empty table
    gives an empty result.
    """
    spark = rows.sparkSession
    st = Stages(spark, "join")
    common = spark.sparkContext.broadcast(common_shingles(rows, st, text_col))
    written = (rows.select(F.col(id_col).cast("long").alias("doc"), "rid", F.xxhash64(text_col).alias("text_id"), text_col)
               .mapInArrow(_sets(text_col, common, 2 * partitions(spark)), _SETS))
    written = st.write(written, "sets")
    sets = written.filter("range IS NULL").drop("range", "blob")
    full = sets.filter("size > 0")
    members = st.write(full.groupBy("cid").agg(F.first("gid").alias("gid"), F.first("size").alias("size"), F.first("sketch").alias("sketch"),
                                               F.min(F.struct(F.col("doc").isNull(), "doc", "rid")).alias("first")), "members")
    groups = st.write(members.groupBy("gid").agg(F.min("cid").alias("rep"), F.count(F.lit(1)).alias("n")), "groups")
    # shingles below COMMON_FROM have short lists, put together by ranges; those of common ones are joined
    light = (written.filter("range IS NOT NULL").select("range", "blob").groupBy("range")
             .applyInArrow(_merge_posts, _LISTS))
    light = st.write(light, "light")
    postings = full.filter("size(heavy) > 0").select("gid", "size", "light", F.posexplode("heavy").alias("at", "token"))
    shared = st.write(postings.select("token", "gid", "size", (F.col("light") + F.col("at")).alias("pos")).distinct(), "shared")
    pivots = st.write(shared.groupBy("token").agg(F.min(F.struct("gid", "size", "pos")).alias("p"), F.count(F.lit(1)).alias("k"))
                      .filter("k > 1").select("token", "p.*"), "pivots")
    stars = (shared.alias("s").join(pivots.alias("p"), "token")
             .filter((F.col("s.gid") != F.col("p.gid")) & _bounds("s", "p"))
             .select(F.col("p.gid").alias("g"), F.col("s.gid").alias("h")))
    stars = st.write(stars.unionByName(light.filter("kind = 0").select("g", "h")).distinct(), "stars")
    rep = groups.select("gid", "rep", "n")
    star = (stars.join(rep.toDF("g", "x", "n"), "g").join(rep.toDF("h", "y", "m"), "h"))
    inside = (members.select("gid", "cid").join(groups.filter("n > 1").select("gid", "rep"), "gid").filter("cid <> rep")
              .select(F.col("rep").alias("x"), F.col("cid").alias("y")))
    links = _verify(st, rows, full, members, st.write(star.select("x", "y").unionByName(inside).distinct(), "star"), text_col, id_col, "star")
    found = components(st, links, "star")

    # lists that still hold several components: all pairs across components, expanded to members
    units = members.select("cid", "gid").join(found.toDF("cid", "root"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    units = st.write(units, "units")
    spread = (units.groupBy("gid").agg(F.min("root").alias("lo"), F.max("root").alias("hi")))
    spread = st.write(spread, "spread")
    many = spread.filter("lo <> hi").select("gid")
    lists = shared.unionByName(light.filter("kind = 2").select("token", F.col("g").alias("gid"), "size", "pos"))
    lists = st.write(lists.join(spread, "gid"), "lists")
    # a component drawn by hash from the list: the more groups of a list are in one, the likelier it is the one
    one = F.when(F.col("lo") == F.col("hi"), F.xxhash64("token", "gid"))
    open_lists = lists.groupBy("token").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min_by("lo", one).alias("main"))
    open_lists = st.write(open_lists.filter("lo <> hi").select("token", "main"), "open")
    group_pairs = open_pairs(st.write(lists.join(open_lists, "token"), "posts"))
    # the pairs of short lists, and of a pivot those in which a group has several sets: only the smallest two have met
    named = light.filter("kind = 1").select("g", "h").unionByName(star.filter("n > 1 OR m > 1").select("g", "h"))
    group_pairs = group_pairs.unionByName(named).unionByName(many.select(F.col("gid").alias("g"), F.col("gid").alias("h")))
    group_pairs = st.write(group_pairs.distinct(), "group_pairs")
    left, right = units.toDF("x", "g", "rx"), units.toDF("y", "h", "ry")
    pairs = (group_pairs.join(left, "g").join(right, "h").filter("rx <> ry AND (g <> h OR x < y)")
             .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
    met = st.read("star", "x long, y long").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    pairs = st.write(pairs.join(met, ["x", "y"], "left_anti"), "pairs")
    if not pairs.isEmpty():
        more = _verify(st, rows, full, members, pairs, text_col, id_col, "rest")
        found = components(st, links.unionByName(more), "all")
    st.drop("light", "shared", "pivots", "stars", "lists", "open", "posts", "group_pairs", "spread")

    # the smallest id of every component, then of every set, then of every row
    of_set = members.select("cid", "first").join(found.toDF("cid", "root"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    of_set = st.write(of_set, "of_set")
    least = st.write(of_set.groupBy("root").agg(F.min("first").alias("least")), "least")
    by_set = st.write(of_set.join(least, "root").select("cid", "least"), "by_set")
    linked = (full.select("doc", "rid", "text_id", "size", "cid").join(by_set, "cid")
              .select(F.col("doc").alias(id_col), "rid", "text_id", F.col("size").cast("long").alias("n_shingles"),
                      F.col("least.doc").alias("component_id"), (F.col("rid") == F.col("least.rid")).alias("kept")))
    alone = sets.filter("size = 0").select(F.col("doc").alias(id_col), "rid", "text_id", F.lit(0).cast("long").alias("n_shingles"),
                                           F.col("doc").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)
