"""Which lines of CSV files belong to one record: a quote automaton composed over file splits.

A quote opens a field only at the field's start; elsewhere it is a character.  An
open field ends at a quote followed by a separator or the line's end; a doubled quote is one quote, and any other quote in it
is a character.  At the end of a line a field is open or not, so a line is a map of two states:
where it ends if no field is open before it, and if one is.  A quote that could only open a field (a separator or the line's
start before it, text after it) while one is open shows that the open one was never closed
(``BROKEN``), as does the end of the file: then the line that opened it is a record by itself and the next line
starts anew, whatever the distance.

One pass over the text files reads every split in order and writes its lines with the line's state under each
of the four assumptions that the split cannot check itself: whether a field is open at its start, and how a field open at
its end turns out.  A row a split then settles both by window functions, and only lines of records over several
lines are ever moved.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histlens.sources.store import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need not have the package

CLOSED, OPEN, BROKEN = 0, 1, 2
LINES = "file string, block long, sid long, ln long, line string, ends byte, states int, split_ends int, outcome byte"


def line_end(parts: list[str], opened: bool) -> int:
    """State after a line, given as its parts between quotes, when a field is ``opened`` before it or not."""
    state, opener = "quoted" if opened else "start", False
    for i, seg in enumerate(parts[:-1]):            # then a quote follows
        if state == "start":
            state = "quoted" if not seg or seg[-1] == "," else "plain"
        elif state == "plain":
            state = "quoted" if seg[-1:] == "," else "plain"
        elif state == "quoted":
            state, opener = "quote", seg[-1:] == "," or (i == 0 and not seg)
        elif not seg:                               # a doubled quote
            state = "quoted"
        elif seg[0] == ",":                         # the field has ended
            state = "quoted" if seg[-1] == "," else "plain"
        elif opener:
            return BROKEN
        else:
            opener = seg[-1] == ","
    if state == "quote":
        last = parts[-1]
        return CLOSED if not last or last[0] == "," else BROKEN if opener else OPEN
    return OPEN if state == "quoted" else CLOSED


def split_states(ends: np.ndarray, opened_ends: np.ndarray) -> tuple[np.ndarray, int, int]:
    """(states, split_ends, outcome) of a split's lines from their two line ends.

    states, bit 2 s + e: a field is open before the line if one is open at the split's start (s) and a field open at its end is closed
    later (e); bit 4 + 2 s + e: one is open after it.  split_ends: those last four bits after the last line, from bit 0.  outcome: CLOSED,
    BROKEN or OPEN (not settled here) for a field open at the start."""
    n = len(ends)
    settled = np.flatnonzero(opened_ends != OPEN).astype(np.int32)
    outcome = int(opened_ends[settled[0]]) if len(settled) else OPEN
    upcoming = np.searchsorted(settled, np.arange(1, n + 1, dtype=np.int32)).astype(np.int32)        # the first settling line after each line
    stays = opened_ends == OPEN                                     # from an open field
    states = np.zeros(n, np.uint8)
    split_ends = 0
    for e in (0, 1):
        after = (ends == OPEN) & np.append(opened_ends[settled] == CLOSED, e == 1)[upcoming]        # from no open field
        # a line sets the state, keeps it, or turns it: the last line that set it, and the turns since
        last = np.maximum.accumulate(np.where(after == stays, np.arange(n, dtype=np.int32), np.int32(-1)))
        turns = np.cumsum(after & ~stays, dtype=np.int32)
        base = np.where(last < 0, 0, turns[last]) if n else turns
        for s in (0, 1):
            state = (np.where(last < 0, s, after[last]) if n else turns) ^ ((turns - base) & 1)
            before = np.concatenate([[s], state]).astype(np.uint8)
            states |= (before[:-1] << (2 * s + e)) | (before[1:] << (4 + 2 * s + e))
            split_ends |= int(before[-1]) << (2 * s + e)
    return states, split_ends, outcome


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (file, block, line) in file order to LINES; a split's lines are held until it ends."""
    from pyspark import TaskContext

    base, splits, held, key = TaskContext.get().partitionId() << 24, 0, [], None

    def ends_of(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ends, opened = np.zeros(len(lines), np.int8), np.full(len(lines), OPEN, np.int8)
        quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
        for i, line in zip(quoted.tolist(), lines.take(pa.array(quoted)).to_pylist()):
            parts = line.split('"')
            ends[i], opened[i] = line_end(parts, False), line_end(parts, True)
        return ends, opened

    def emit() -> Iterator[pa.RecordBatch]:
        ends, opened = (np.concatenate([h[k] for h in held]) for k in (1, 2))
        states, split_ends, outcome = split_states(ends, opened)
        at = 0
        for chunk, _, _ in held:
            m = len(chunk)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * m, pa.string()), pa.array(np.full(m, key[1], np.int64)), pa.array(np.full(m, base + splits, np.int64)), pa.array(np.arange(at, at + m)), chunk,
                 pa.array(ends[at : at + m]), pa.array(states[at : at + m].astype(np.int32)), pa.array(np.full(m, split_ends, np.int32)), pa.array(np.full(m, outcome, np.int8))],
                ["file", "block", "sid", "ln", "line", "ends", "states", "split_ends", "outcome"])
            at += m

    for b in batches:
        if not b.num_rows:
            continue
        runs = pc.run_end_encode(b.column(0))
        cuts = set(np.asarray(runs.run_ends).tolist()) | {b.num_rows}
        blocks = b.column(1).to_numpy(zero_copy_only=False)
        cuts |= set((np.flatnonzero(np.diff(blocks)) + 1).tolist())
        i = 0
        for j in sorted(cuts):
            k = (b.column(0)[i].as_py(), int(blocks[i]))
            if key is not None and k != key:
                yield from emit()
                splits, held = splits + 1, []
            key = k
            part = b.column(2).slice(i, j - i).cast(pa.string())
            # a copy: a slice keeps its whole batch, with the file's name in every row
            held.append((pa.concat_arrays([part, part[:0]]), *ends_of(part)))
            i = j
    if key is not None:
        yield from emit()


def _bit(value: Column, place: Column) -> Column:
    return F.call_function("getbit", value, place) == 1


def records(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """The CSV records of the files under ``path``: (file, position, record, first, unclosed).

    position is the number of the record's first line in its file, from 1; ``first`` marks each file's first line, which is never
    part of a longer record; ``unclosed`` a line that opens a field which nothing closes."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    x = materialise(lines.mapInArrow(_measured, LINES), "csv_lines", folder and f"{folder}/csv_lines")

    # a row a split: how a field open at its end turns out, and whether one is open at its start
    splits = x.groupBy("sid").agg(F.first("file").alias("file"), F.first("block").alias("block"), F.first("split_ends").alias("ends"), F.first("outcome").alias("outcome"),
                                  (F.max("ln") + 1).alias("n"))
    in_file = Window.partitionBy("file").orderBy("block")
    unb = Window.unboundedPreceding
    later = in_file.rowsBetween(1, Window.unboundedFollowing)
    closes = F.coalesce(F.first(F.when(F.col("outcome") != OPEN, F.col("outcome") == CLOSED), ignorenulls=True).over(later), F.lit(False)).cast("int")
    splits = splits.withColumn("e", closes).withColumn("line0", F.coalesce(F.sum("n").over(in_file.rowsBetween(unb, -1)), F.lit(0)))
    splits = splits.withColumn("f", _bit(F.col("ends"), F.col("e"))).withColumn("q", _bit(F.col("ends"), F.col("e") + 2))
    splits = splits.withColumn("turns", F.sum((F.col("f") & ~F.col("q")).cast("int")).over(in_file.rowsBetween(unb, 0)))
    known = F.last(F.when(F.col("f") == F.col("q"), F.struct(F.col("f").cast("int").alias("v"), "turns")), ignorenulls=True).over(in_file.rowsBetween(unb, -1))
    splits = splits.withColumn("known", known).withColumn("before", F.coalesce(F.lag("turns").over(in_file), F.lit(0)))
    opened = F.pmod(F.coalesce("known.v", F.lit(0)) + F.col("before") - F.coalesce("known.turns", F.lit(0)), F.lit(2))
    # some 30 bytes for each file split, whatever its lines
    x = x.join(F.broadcast(splits.select("sid", (2 * opened + F.col("e")).alias("c"), "line0")), "sid")
    x = (x.withColumn("_from", _bit(F.col("states"), F.col("c"))).withColumn("_to", _bit(F.col("states"), F.col("c") + 4))
         .withColumn("position", F.col("line0") + F.col("ln") + 1))
    first = F.col("position") == 1
    alone = x.filter("NOT _from AND NOT _to").select("file", "position", F.col("line").alias("record"), first.alias("first"), (F.col("ends") == OPEN).alias("unclosed"))

    # records over several lines: each line takes the line that began its record, in its split or the last one before
    many = x.filter("_from OR _to").select("file", "block", "sid", "position", "line", F.when(~F.col("_from"), F.col("position")).alias("_began"))
    many = many.withColumn("_here", F.last("_began", ignorenulls=True).over(Window.partitionBy("sid").orderBy("position").rowsBetween(unb, 0)))
    carried = (many.groupBy("file", "block", "sid").agg(F.max("_began").alias("_b"))
               .withColumn("_before", F.last("_b", ignorenulls=True).over(in_file.rowsBetween(unb, -1))).select("sid", "_before"))
    many = many.join(F.broadcast(carried), "sid").withColumn("_key", F.coalesce("_here", "_before"))
    parts = many.groupBy("file", "_key").agg(F.array_sort(F.collect_list(F.struct("position", "line"))).alias("_ls"))
    long = parts.select("file", F.col("_key").alias("position"), F.array_join(F.transform("_ls", lambda p: p["line"]), "\n").alias("record"),
                        (F.col("_key") == 1).alias("first"), F.lit(False).alias("unclosed"))
    return alone.unionByName(long)
