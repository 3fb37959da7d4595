"""Packing of training examples into sequences by vector bin packing.

Every example is a vector (tokens, segments, loss-bearing tokens).  A sequence has a
limit for each.  Sequences are filled one at a time: of the examples that still
fit, the one whose vector has the largest dot product with the remaining
capacity is placed next (both measured in shares of the limits, weighted by how scarce each
dimension is).  Long documents are cut into full sequences and one rest.

The rests are dealt by a hash into groups of about ``GROUP`` and each group is packed
by one task, so that no task grows with the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from histlens.llm.common import Stages, byte_texts, kept_in_process, slices
from histlens.llm.word_ids import END_ID, WordIds

MAX_TOKENS = 2048
MAX_SEGMENTS = 128
GROUP = 8192


def pack_vectors(sizes: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and place in the bin for each row of sizes (n x d, each within limits).

    Dot-product heuristic, bin by bin; equal products go to the larger first
    size, then to the earlier row.
    """
    n = len(sizes)
    order = np.lexsort((np.arange(n), -sizes[:, 0]))
    left = (sizes / limits)[order]
    weight = left.sum(0) / max(1e-9, left.sum())
    weighted = left * weight
    alive = np.arange(n)
    bins, places = np.empty(n, np.int64), np.empty(n, np.int64)
    b = 0
    while len(alive):
        room, k = np.ones(sizes.shape[1]), 0
        mine = np.ones(len(alive), bool)                  # not yet placed in this round
        lo = left[alive]
        we = weighted[alive]
        while True:
            fits = mine & (lo <= room + 1e-9).all(1)
            if not fits.any():
                break
            i = int(np.argmax(np.where(fits, we @ room, -1.0)))
            mine[i] = False
            room = room - lo[i]
            at = order[alive[i]]
            bins[at], places[at] = b, k
            k += 1
        alive = alive[mine]
        b += 1
    return bins, places


def pack_examples(rows: DataFrame, limits: tuple[int, ...], size_cols: tuple[str, ...]) -> DataFrame:
    """Add sequence_id, seq_place and offset to rows whose size columns respect the limits.

    ``rows`` is a stored table with a unique long ``rid``.  offset is the sum of the first size
    of the rows placed before.  sequence ids are unique but not gapless; an
    example above a limit raises an error; an empty table gives an empty result.
    """
    total = Observation()
    n = rows.observe(total, F.count(F.lit(1)).alias("n"))
    n.write.format("noop").mode("overwrite").save()
    groups = max(1, -(-(total.get["n"] or 0) // GROUP))
    bound = np.array(limits, np.float64)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rid")
        sizes = np.column_stack([table.column(c).to_numpy().astype(np.float64) for c in size_cols])
        if (sizes > bound).any():
            raise ValueError("an example is above a limit")
        bins, places = pack_vectors(sizes, bound)
        order = np.lexsort((places, bins))
        run_sum = np.cumsum(sizes[order, 0]) - sizes[order, 0]
        first = np.flatnonzero(np.diff(bins[order], prepend=-1))
        offset = np.empty(len(bins), np.int64)
        offset[order] = run_sum - np.repeat(run_sum[first], np.diff(np.append(first, len(bins))))
        base = table.column("grp")[0].as_py() << 32
        for name, x in (("sequence_id", base + bins), ("seq_place", places), ("offset", offset)):
            table = table.append_column(name, pa.array(x))
        return table.drop_columns(["grp"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields) + "sequence_id long, seq_place long, offset long"
    return (rows.withColumn("grp", F.pmod(F.xxhash64("rid"), F.lit(groups)))
            .groupBy("grp").applyInArrow(run, schema))


def document_pieces(docs: DataFrame, tokenizer_path: str, text_col: str = "text", id_col: str = "doc_id", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): full sequences and the rest of each document."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept_in_process(("word ids", tokenizer_path), lambda: WordIds(tokenizer_path))
        end = np.array([END_ID], "<u4").tobytes()
        for b in slices(batches):
            out = []
            for doc, ids in zip(b.column(0).to_pylist(), encode(byte_texts(b, "t"))):
                ids = memoryview(ids + end)
                n = len(ids) // 4
                for s in range(0, n, max_tokens):
                    e = min(n, s + max_tokens)
                    out.append((doc, s, e - s, zlib.crc32(ids[4 * s : 4 * e]), n))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return src.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack_documents(docs: DataFrame, tokenizer_path: str, text_col: str = "text", id_col: str = "doc_id",
                   max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS) -> DataFrame:
    """Every document's ids (END_ID appended) in pieces, each with its sequence_id and offset.

    Sequences hold at most max_tokens tokens, max_segments pieces and max_tokens
    loss-bearing tokens (in plain documents every token bears loss).  A null or empty text is END_ID
    alone; repeated rows are packed each; null ids stay null; extra columns are ignored.
    """
    st = Stages(docs.sparkSession, "pack")
    pieces = document_pieces(docs, tokenizer_path, text_col, id_col, max_tokens).withColumn("rid", F.monotonically_increasing_id())
    pieces = st.write(pieces, "pieces")
    full = (pieces.filter(F.col("length") == max_tokens)
            .select("*", (-F.col("rid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("seq_place"), F.lit(0).cast("long").alias("offset")))
    rest = pieces.filter(F.col("length") < max_tokens).withColumn("segments", F.lit(1)).withColumn("loss_tokens", F.col("length"))
    packed = pack_examples(rest, (max_tokens, max_segments, max_tokens), ("length", "segments", "loss_tokens"))
    return full.unionByName(packed.drop("segments", "loss_tokens")).drop("rid", "seq_place")
