"""Token ids in files of fixed-width packed blocks, and back.

A file holds the documents of one id range in ascending order:

    magic "HLTOK1\\n\\0"
    blocks: BLOCK_IDS ids each (the last one fewer), every id in ``width`` bits
            (the fewest that hold the vocabulary), first bit first, padded to a byte
    index:  doc ids (int64), null flags (uint8), first id of each document and the
            total (uint64), byte offset of each block and the end (uint64)
    tail:   width, ids per block, documents, blocks (4 x uint64), index offset
            (uint64), magic

Block offsets give random access: the ids of a document are unpacked with numpy from
the blocks that hold them.  Files are written by tasks through pyarrow's
filesystems (local, HDFS, S3 ...) under a name of the attempt; the manifest, a
Spark table of the successful tasks' rows, names the valid ones, so that lost or
repeated tasks leave at most unused files.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histlens.llm.common import Stages, byte_texts, kept_in_process, partitions, slices
from histlens.llm.word_ids import END_ID, WordIds

MAGIC = b"HLTOK1\n\0"
BLOCK_IDS = 65_536
TAIL = 5 * 8 + len(MAGIC)


def bit_width(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as ``width`` bits each, first bit first."""
    if width == 16:
        return ids.astype(">u2").tobytes()
    bits = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width :]
    return np.packbits(bits.ravel()).tobytes()


def unpack(data: bytes, width: int, n: int) -> np.ndarray:
    if width == 16:
        return np.frombuffer(data, ">u2", n).astype("<u4")
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width).reshape(n, width)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - width :] = bits
    return np.packbits(wide, axis=1).view(">u4").ravel().astype("<u4")


class Writer:
    def __init__(self, stream, width: int, block_ids: int = BLOCK_IDS):
        self.out, self.width, self.block_ids = stream, width, block_ids
        self.at = len(MAGIC)
        self.docs: list[int | None] = []
        self.starts, self.offsets, self.held, self.size, self.n = [0], [], [], 0, 0
        stream.write(MAGIC)

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.width)
        self.offsets.append(self.at)
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.n += len(ids)
        self.starts.append(self.n)
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= self.block_ids:
            ids = np.concatenate(self.held)
            whole = len(ids) // self.block_ids * self.block_ids
            for i in range(0, whole, self.block_ids):
                self._block(ids[i : i + self.block_ids])
            self.held, self.size = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        if self.size:
            self._block(np.concatenate(self.held))
        self.offsets.append(self.at)
        index = (np.array([d or 0 for d in self.docs], "<i8").tobytes() + np.array([d is None for d in self.docs], np.uint8).tobytes()
                 + np.array(self.starts, "<u8").tobytes() + np.array(self.offsets, "<u8").tobytes())
        self.out.write(index)
        self.out.write(np.array([self.width, self.block_ids, len(self.docs), len(self.offsets) - 1, self.at], "<u8").tobytes() + MAGIC)


class Reader:
    """Random access to a file's documents; ``source`` is a seekable binary stream."""

    def __init__(self, source):
        self.src = source
        source.seek(0, 2)
        end = source.tell()
        source.seek(end - TAIL)
        tail = source.read(TAIL)
        if tail[-len(MAGIC):] != MAGIC:
            raise ValueError("not a token file")
        self.width, self.block_ids, n, blocks, at = (int(x) for x in np.frombuffer(tail, "<u8", 5))
        source.seek(at)
        index = source.read(end - TAIL - at)
        self.docs = np.frombuffer(index, "<i8", n)
        self.null = np.frombuffer(index, np.uint8, n, 8 * n).astype(bool)
        self.starts = np.frombuffer(index, "<u8", n + 1, 9 * n).astype(np.int64)
        self.offsets = np.frombuffer(index, "<u8", blocks + 1, 9 * n + 8 * (n + 1)).astype(np.int64)
        self.cached = (-1, np.zeros(0, "<u4"))

    def block(self, k: int) -> np.ndarray:
        if self.cached[0] != k:
            n = min(self.block_ids, int(self.starts[-1]) - k * self.block_ids)
            self.src.seek(int(self.offsets[k]))
            self.cached = (k, unpack(self.src.read(int(self.offsets[k + 1] - self.offsets[k])), self.width, n))
        return self.cached[1]

    def ids(self, i: int) -> np.ndarray:
        """The ids of the file's i-th document."""
        a, b = int(self.starts[i]), int(self.starts[i + 1])
        if a == b:
            return np.zeros(0, "<u4")
        s = self.block_ids
        return np.concatenate([self.block(k)[max(0, a - k * s) : b - k * s] for k in range(a // s, (b - 1) // s + 1)])


def _filesystem(path: str):
    """(file system, path in it) of a path, local if it names no file system."""
    if path.startswith("s3a://"):
        path = "s3://" + path[6:]
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Encode every whole text, append END_ID and write the documents in ascending id order.

    Returns the manifest, (file_no, path, n_docs, n_ids, bytes), files in id order; lazily: each
    evaluation writes the files again, so store it.  Null texts are empty (END_ID alone);
    null ids come first; rows with one id follow the hash and the bytes of their text.
    An empty table gives no file.
    """
    spark = docs.sparkSession
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
            .withColumn("h", F.xxhash64("t")))
    ranged = rows.repartitionByRange(partitions(spark), "id", "h").sortWithinPartitions("id", "h", "t").select("id", "t", F.spark_partition_id().alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sink = None, None
        for b in slices(batches):
            if not b.num_rows:
                continue
            if encode is None:
                encode = kept_in_process(("word ids", tokenizer_path), lambda: WordIds(tokenizer_path))
                width = bit_width(max(encode.vocabulary(), END_ID + 1))
                path = f"{folder}/ids-{b.column(2)[0].as_py():06d}-{uuid.uuid4().hex[:12]}.tok"
                system, at = _filesystem(path)
                system.create_dir(at.rpartition("/")[0], recursive=True)
                no, sink = b.column(2)[0].as_py(), system.open_output_stream(at)
                w = Writer(sink, width)
            end = np.array([END_ID], "<u4").tobytes()
            for doc, ids in zip(b.column(0).to_pylist(), encode(byte_texts(b, "t"))):
                w.add(doc, np.frombuffer(ids + end, "<u4"))
        if sink is not None:
            w.close()
            size = sink.tell()
            sink.close()
            yield pa.RecordBatch.from_pydict({"file_no": pa.array([no], pa.int32()), "path": [path], "n_docs": [len(w.docs)], "n_ids": [w.n], "bytes": [size]})
    return ranged.mapInArrow(run, "file_no int, path string, n_docs long, n_ids long, bytes long")


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Every document of the manifest's files: (doc_id, start, n_tokens, ids_crc32, pos).

    start counts the ids of all documents before it; pos is its place in its file.
    Any row's ids can be had alone through ``Reader``.
    """
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)       # a row a file
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).select("path", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                system, at = _filesystem(path)
                with system.open_input_file(at) as src:
                    r = Reader(src)
                    for i in range(0, len(r.docs), 10_000):
                        j = min(len(r.docs), i + 10_000)
                        crc = [zlib.crc32(r.ids(k).astype("<u4").tobytes()) for k in range(i, j)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(r.docs[i:j], mask=r.null[i:j]), pa.array(r.starts[i:j] + base), pa.array(np.diff(r.starts[i : j + 1])),
                             pa.array(crc, pa.int64()), pa.array(np.arange(i, j))], ["doc_id", "start", "n_tokens", "ids_crc32", "pos"])
    return (files.repartition(partitions(spark), "path")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, pos long"))


def token_table(docs: DataFrame, tokenizer_path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Write token files to the shared folder and read them back."""
    st = Stages(docs.sparkSession, "tokens")
    manifest = st.write(write_token_files(docs, st.uri("files"), tokenizer_path, text_col, id_col), "manifest")
    return read_token_files(docs.sparkSession, manifest)
