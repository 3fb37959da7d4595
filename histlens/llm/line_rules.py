"""Quality rules on documents, among them the frequency of lines across the documents of a host.

Every text is measured once (words, symbols, repeated lines and passages) and its normalised
lines (words in lower-case A-Z, one space between them) are hashed to 128 bits.  For every
(host, line) the distinct documents that hold it are counted; copies of one text are one
document, so that a line is boilerplate only if different texts share it.  Lines above the
host's limit are removed; a document that loses too much by that is depleted and rejected.

Lines are aggregated before every shuffle, so that a line that all documents of a host share is one
row a task; only the lines above a limit travel back to the documents that hold them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlens.llm.common import Stages, byte_texts, slices

MIN_WORDS = 20                  # fewer words fail
MAX_REPEAT_PERCENT = 30         # a larger share of words in repeated windows fails
WINDOW = 8                      # words of a window
MIN_DOCS = 20                   # a line of so many documents of its host, or fewer, is never removed,
MAX_DOCS_PERCENT = 1            # nor one that no more than this share of the host's documents hold
MAX_LOST_PERCENT = 50           # a document that loses more of its words is depleted

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UNCOUNTED = _SPACE + bytes(range(0x80, 0xC0))      # white space, and all bytes of a character but its first
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(27))


def repeated_words(ids: np.ndarray, doc: np.ndarray, docs: int, window: int = WINDOW) -> np.ndarray:
    """For each document the words in windows that its text holds twice or more.

    ids: word numbers of all texts on end, doc: the text of each.  Windows are first compared by a
    hash; those that may repeat are then compared word by word.
    """
    n = len(ids) - window + 1
    if n < 2:
        return np.zeros(docs, np.int64)
    x = _mix(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    h = doc[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(window):
        h = (h ^ x[j : n + j]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(2 * j + 1)
    inside = np.flatnonzero(doc[:n] == doc[window - 1 :])
    h = h[inside]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    again = np.zeros(len(h), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    at = inside[again]
    if not len(at):
        return np.zeros(docs, np.int64)
    rows = np.column_stack([doc[at], *[ids[at + j] for j in range(window)]])
    _, which, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    at = at[times[which.ravel()] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=docs)


def line_hash(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words).lower())


def measure(texts: list[bytes]) -> tuple[list[tuple], list[tuple[bytes, list[bytes], list[int]]]]:
    """The base measures of each text, and (text id, distinct line hashes, words that each takes)."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    rows, lines, held, sizes = [], [], [], []
    for t in texts:
        words, seen, found, dup = 0, set(), {}, 0
        whole = xxhash.xxh3_128()
        for line in t.split(b"\n"):
            ws = line.split()
            if not ws:
                continue
            if line in seen:
                dup += 1
            seen.add(line)
            held.append(np.fromiter(map(number.__getitem__, ws), np.int64, len(ws)))
            words += len(ws)
            h = line_hash(ws)
            whole.update(h)
            found[h] = found.get(h, 0) + len(ws)
        sizes.append(words)
        rows.append((words, len(t.translate(None, _UNCOUNTED)), len(t) - len(t.translate(None, _SYMBOLS)), dup))
        lines.append((whole.digest(), list(found), list(found.values())))
    doc = np.repeat(np.arange(len(texts)), sizes)
    repeat = repeated_words(np.concatenate(held) if held else np.zeros(0, np.int64), doc, len(texts))
    return [(*r, int(n)) for r, n in zip(rows, repeat)], lines


def _measured(docs: DataFrame, text_col: str, host_col: str, keep: tuple) -> DataFrame:
    src = docs.select(F.struct(*keep).alias("_keep"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("_host"), F.col(text_col).alias("_text"))
    schema = (f"_keep {src.schema['_keep'].dataType.simpleString()}, _host string, _id binary, "
              + "".join(f"{m} long, " for m in MEASURES) + "_lines array<binary>, _sizes array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            if not b.num_rows:
                continue
            rows, lines = measure(byte_texts(b, "_text"))
            ids, hashes, sizes = zip(*lines)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(ids, pa.binary()), *[pa.array(c, pa.int64()) for c in zip(*rows)],
                 pa.array(hashes, pa.list_(pa.binary())), pa.array(sizes, pa.list_(pa.int32()))],
                ["_keep", "_host", "_id", *MEASURES, "_lines", "_sizes"])
    return src.mapInArrow(run, schema).withColumn("_rid", F.monotonically_increasing_id())


def frequent_lines(measured: DataFrame, min_docs: int = MIN_DOCS, max_docs_percent: int = MAX_DOCS_PERCENT) -> DataFrame:
    """(_host, _line): lines of more than min_docs distinct documents of their host and more than that share of them."""
    texts = measured.groupBy("_host", "_id").agg(F.first("_lines").alias("_lines"))
    held = texts.select("_host", F.explode(F.concat("_lines", F.array(F.lit(b"")))).alias("_line"))      # the empty line counts the documents
    counts = held.groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > min_docs)
    hosts = counts.filter(F.length("_line") == 0).select("_host", F.col("n").alias("docs"))
    return (counts.filter(F.length("_line") > 0).join(hosts, "_host")
            .filter(100 * F.col("n") > max_docs_percent * F.col("docs")).select("_host", "_line"))


def judge(docs: DataFrame, text_col: str = "text", host_col: str = "source", keep: tuple = ("doc_id",), with_text: bool = False,
          min_docs: int = MIN_DOCS, max_docs_percent: int = MAX_DOCS_PERCENT, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """One row per row of docs: the columns ``keep``, the base measures, n_lost_words (words of removed lines), base_failed, kept;
    with_text adds clean_text, the text without its removed lines.

    A text fails the base rules with fewer than MIN_WORDS words or more than MAX_REPEAT_PERCENT of
    them in windows of WINDOW words that it holds twice or more.  kept is false for those and for depleted documents: lines above the limit
    take more than max_lost_percent of their words, or leave fewer than MIN_WORDS.  A null text has no
    words (its clean_text is null); a null host is the host ''; repeated rows get a row each; an empty table gives an empty
    result.  Columns of ``keep`` may have any names but those of the result.
    """
    clash = {*MEASURES, "n_lost_words", "base_failed", "kept", "clean_text"} & set(docs.select(*keep).columns)
    if clash:
        raise ValueError(f"keep has names of result columns: {sorted(clash)}")
    st = Stages(docs.sparkSession, "lines")
    carried = (*keep, F.col(text_col).alias("_whole_text")) if with_text else keep
    rows = st.write(_measured(docs, text_col, host_col, carried), "measured")
    often = st.write(frequent_lines(rows, min_docs, max_docs_percent), "frequent")
    pairs = rows.select("_rid", "_host", F.explode(F.arrays_zip("_lines", "_sizes")).alias("_l"))
    pairs = pairs.select("_rid", "_host", F.col("_l._lines").alias("_line"), F.col("_l._sizes").alias("_size"))
    lost = (pairs.join(often, ["_host", "_line"]).groupBy("_rid")
            .agg(F.sum("_size").alias("n_lost_words"), *([F.collect_list("_line").alias("_gone")] if with_text else [])))
    out = rows.drop("_lines", "_sizes").join(lost, "_rid", "left").withColumn("n_lost_words", F.coalesce("n_lost_words", F.lit(0)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = (F.col("n_lost_words") > 0) & ((100 * F.col("n_lost_words") > max_lost_percent * F.col("n_words"))
                                              | (F.col("n_words") - F.col("n_lost_words") < MIN_WORDS))
    cols = [F.col("_keep")[c].alias(c) for c in docs.select(*keep).columns]
    cols += [*MEASURES, "n_lost_words", failed.alias("base_failed"), (~failed & ~depleted).alias("kept")]
    if not with_text:
        return out.select(*cols)
    return _without_lines(out.select(*cols, F.col("_keep._whole_text").alias("clean_text"), F.coalesce("_gone", F.array().cast("array<binary>")).alias("_gone")))


def _without_lines(rows: DataFrame) -> DataFrame:
    """clean_text without the lines whose hashes are in _gone."""
    schema = rows.drop("_gone").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = []
            for t, gone in zip(b.column(b.num_columns - 2).cast(pa.binary()).to_pylist(), map(set, b.column(b.num_columns - 1).to_pylist())):
                if gone and t is not None:
                    t = b"\n".join([x for x in t.split(b"\n") if line_hash(x.split()) not in gone])
                texts.append(t)
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(texts, pa.binary()).cast(pa.string())], b.schema.names[:-1])
    return rows.mapInArrow(run, schema)
