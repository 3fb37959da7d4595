"""Exact duplicates by deterministic block naming, in DataFrame operations only.

Every text is cut into blocks of a fixed number of characters.  Equal blocks
are brought together by sorting and get one integer name; names of adjacent
blocks are then named in pairs, level by level, until each document has one
name.  (number of blocks, name) is equal for two documents exactly when their
normalised texts are equal: names compare contents, never hashes.

A block or pair that holds more than 1/P of all rows (P shuffle partitions;
so fewer than P of them exist) is hot.  Hot blocks are salted and their few
representatives unified afterwards; hot pairs and groups are aggregated before
the shuffle and looked up in a broadcast table of fewer than P short rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from histlens.llm.common import Stages, ascii_lower, partitions

BLOCK_CHARS = 4096


def _blocks(rows: DataFrame, text_col: str, id_col: str, block_chars: int) -> DataFrame:
    """(rid, n, pos, block, sha, id, bid): sha and id on the first block only, bid numbers the blocks."""
    norm = rows.select("rid", F.col(id_col).alias("id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    cut = F.when(F.length("norm") <= block_chars, F.array("norm")).otherwise(
        F.regexp_extract_all("norm", F.lit("(?s).{1,%d}" % block_chars), F.lit(0)))
    parts = norm.select("rid", "id", F.unhex(F.sha2("norm", 256)).alias("sha"), cut.alias("cut"))
    parts = parts.select("rid", "id", "sha", F.size("cut").alias("n"), F.posexplode("cut").alias("pos", "block"))
    return parts.select("rid", "n", "pos", "block", *[F.when(F.col("pos") == 0, F.col(c)).alias(c) for c in ("sha", "id")],
                        F.monotonically_increasing_id().alias("bid"))


def _name_blocks(st: Stages, blocks: DataFrame, parts: int) -> DataFrame:
    """(rid, n, pos, sha, id, name), written: one integer name per distinct block content.

    Row and block numbers come from the one scan whose result is written; the scan that counts uses neither.
    """
    total = Observation()
    counts = (blocks.select(F.xxhash64("block").alias("fp")).groupBy("fp").count()
              .observe(total, F.sum("count").alias("rows")).filter("count > 1"))
    counts = st.write(counts, "counts")
    share = max(1.0, (total.get["rows"] or 0) / parts)      # rows a key may have before it is hot
    hot = counts.filter(F.col("count") > share).select("fp", F.ceil(F.col("count") / share).cast("int").alias("salts"))
    salted = (blocks.withColumn("fp", F.xxhash64("block")).join(F.broadcast(hot), "fp", "left")
              .withColumn("salt", F.when(F.col("salts") > 1, F.pmod(F.xxhash64("bid"), F.col("salts"))).otherwise(F.lit(0))))
    run = Window.partitionBy("block", "salt")
    named = salted.withColumn("name", F.min("bid").over(run))
    named = st.write(named.select(
        "rid", "n", "pos", "sha", "id", "name",
        F.when(F.col("salts").isNotNull() & (F.col("name") == F.col("bid")), F.col("block")).alias("rep")), "names0")
    # the representatives of one hot block (one per salt, fewer than 2P in all) get their smallest name
    reps = named.filter(F.col("rep").isNotNull()).select("rep", F.col("name").alias("old"))
    same = reps.groupBy("rep").agg(F.min("old").alias("first"))
    moves = reps.join(same, "rep").filter("old <> first").select(F.col("old").alias("name"), "first")
    return (named.drop("rep").join(F.broadcast(moves), "name", "left")
            .withColumn("name", F.coalesce("first", "name")).drop("first"))


def _name_pairs(st: Stages, cur: DataFrame, level: int, parts: int) -> DataFrame:
    """One level: (rid, m, pos, name) to the same over half as many names."""
    total = Observation()
    pairs = (cur.groupBy("rid", F.ceil(F.col("m") / 2).cast("int").alias("m"), F.floor(F.col("pos") / 2).cast("int").alias("pos"))
             .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                  F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
             .withColumn("bid", F.monotonically_increasing_id())
             .observe(total, F.count(F.lit(1)).alias("rows")))
    pairs = st.write(pairs, f"pairs{level}")
    share = max(1.0, total.get["rows"] / parts)
    hot = F.broadcast(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("k"), F.min("bid").alias("name"))
                      .filter(F.col("k") > share).drop("k"))
    cold = pairs.join(hot.select("a", "b"), ["a", "b"], "left_anti").withColumn(
        "name", F.min("bid").over(Window.partitionBy("a", "b")))
    out = (pairs.join(hot, ["a", "b"]).select("rid", "m", "pos", "name")
           .unionByName(cold.select("rid", "m", "pos", "name")))
    return st.write(out, f"names{level}")


def name_documents(rows: DataFrame, st: Stages, text_col: str = "text", id_col: str = "doc_id",
                   block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(rid, id, sha, n, name): rows with equal normalised text, and only they, share (n, name).

    ``rows`` has a unique ``rid``, evaluated once.  Null text is empty; an empty text is one empty block.
    """
    parts = partitions(st.spark)
    first = _name_blocks(st, _blocks(rows, text_col, id_col, block_chars), parts)
    longest = first.agg(F.max("n")).first()[0] or 1
    if longest == 1:
        return first.select("rid", "id", "sha", "n", "name")
    heads = first.filter("pos = 0")
    done = []
    cur = first.filter("n > 1").select("rid", F.col("n").alias("m"), "pos", "name")
    for level in range(1, (longest - 1).bit_length() + 1):
        named = _name_pairs(st, cur, level, parts)
        done.append(named.filter("m = 1").select("rid", F.col("name").alias("last")))
        cur = named.filter("m > 1")
    ends = done[0]
    for d in done[1:]:
        ends = ends.unionByName(d)
    return heads.filter("n = 1").select("rid", "id", "sha", "n", "name").unionByName(
        heads.filter("n > 1").drop("name").join(ends, "rid").select("rid", "id", "sha", "n", F.col("last").alias("name")))


def exact_groups(rows: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Groups of rows with identical text after lower-casing A-Z: one row per input row,
    (rid, <id_col>, keep_id, group_size, kept, text_sha256).

    ``rows`` has a unique ``rid`` (long), which only needs to hold within one scan.  The row with the largest id stays; of
    repeated rows with one id the largest rid, and null ids count as the smallest.  Null
    text counts as empty, and empty texts form a group.  An empty table gives an
    empty result; columns beside rid, id and text are ignored.
    """
    st = Stages(rows.sparkSession, "dedup")
    parts = partitions(st.spark)
    total = Observation()
    named = name_documents(rows, st, text_col, id_col, block_chars)
    named = st.write(named.observe(total, F.count(F.lit(1)).alias("rows")), "identity")
    share = max(1.0, total.get["rows"] / parts)
    top, size = F.max(F.struct("id", "rid")), F.count(F.lit(1))
    hot = F.broadcast(named.groupBy("n", "name").agg(top.alias("top"), size.alias("group_size"))
                      .filter(F.col("group_size") > share))
    run = Window.partitionBy("n", "name")
    cold = (named.join(hot.select("n", "name"), ["n", "name"], "left_anti")
            .withColumn("top", top.over(run)).withColumn("group_size", size.over(run)))
    out = named.join(hot, ["n", "name"]).select(*cold.columns).unionByName(cold)
    return out.select("rid", F.col("id").alias(id_col), F.col("top.id").alias("keep_id"), "group_size",
                      (F.col("top.rid") == F.col("rid")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def with_rid(docs: DataFrame, *cols: str) -> DataFrame:
    """``cols`` of a table with a row number.  Scans of files may be split anew when the number of cores
    changes, so it holds within one scan only: never join two scans on it."""
    return docs.select(*[F.col(c) for c in cols]).withColumn("rid", F.monotonically_increasing_id())
