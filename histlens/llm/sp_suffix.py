"""SentencePiece (BPE) encoding by suffix-array matching, and decoding.

The words of a batch that are not remembered are concatenated and indexed by a
suffix array (prefix doubling, as deep as the longest piece).  Every piece of the
vocabulary is binary-searched in it; its range of suffixes gives its occurrences, the
edges (position, length, piece).  Sorted by position they form a table in which
the words are relaxed: in every step each word merges its best-scored pair of
neighbours that is an edge, the leftmost of equals, until none is left, which is
the segmentation that the model defines.  Characters without a piece become
byte pieces, or the unknown piece where the model has none.

Words are cut before a space mark that follows another character and between a letter
and a sign, where no piece holds such a pair: no merge can cross the cut.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlens.llm.common import byte_texts, kept_in_process

MARK = "▁"
SHORT = 64                      # longer words are relaxed one by one with a heap
INDEX_CHARS = 400_000           # characters of one suffix array
SLICE_BYTES = 8 << 20


def merges_by_rank(scores: np.ndarray) -> bool:
    """Whether scores are those of a BPE model: the negated ranks of its merges, not logarithms of probabilities."""
    return bool(len(scores)) and bool((scores <= 0).all()) and bool((scores == np.round(scores)).all())


class Vocabulary:
    """What the model file says: pieces, scores, kinds."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.sp.get_piece_size()
        self.pieces = [self.sp.id_to_piece(i) for i in range(n)]
        self.scores = np.array([self.sp.get_score(i) for i in range(n)])
        if not merges_by_rank(self.scores[[i for i in range(n) if not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_unused(i))]]):
            raise ValueError(f"{path}: not a BPE model; pieces of a unigram model are chosen by their probabilities, which this operator does not do")
        self.byte = {int(self.pieces[i][1:-1], 16): i for i in range(n) if self.sp.is_byte(i)}
        self.unknown = self.sp.unk_id()
        self.normal = [i for i in range(n) if not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_unused(i))]
        self.longest = max(len(self.pieces[i]) for i in self.normal)
        # cuts: before a space mark after another character, and between a letter and a sign, where no piece has such a pair
        pairs = {self.pieces[i][k : k + 2] for i in self.normal for k in range(len(self.pieces[i]) - 1)}
        signs = "".join(re.escape(c) for c in ".,!?;:|" if not any(p[1] == c and p[0].isalpha() for p in pairs))
        m = MARK
        if any(p[1] == m and p[0] != m for p in pairs):
            self.words = re.compile("(?s).+").findall
        elif signs:
            self.words = re.compile(f"{m}*[^{m}{signs}]+(?![^{m}])|{m}*[^{m}{signs}]*[^\\W\\d_](?=[{signs}])|{m}*[^{m}]+|{m}+").findall
        else:
            self.words = re.compile(f"{m}*[^{m}]+|{m}+").findall
        # letters of the pieces get dense numbers from 2; 1 is any other character, 0 a word's end
        letters = sorted({c for i in self.normal for c in self.pieces[i]})
        self.letter = np.ones(0x110000, np.uint16)
        self.letter[[ord(c) for c in letters]] = np.arange(2, len(letters) + 2)
        self.bound = len(letters) + 2
        self.lengths = np.array([len(self.pieces[i]) for i in self.normal])
        self.ids = np.array(self.normal)
        self.low = self._keys([self.pieces[i] for i in self.normal], 0)
        self.high = self._keys([self.pieces[i] for i in self.normal], 0xFFFF)
        # decoding
        raw = [p.replace(MARK, " ").encode() for p in self.pieces]
        for b, i in self.byte.items():
            raw[i] = bytes([b])
        for i in range(n):
            if self.sp.is_control(i):
                raw[i] = b""
            elif self.sp.is_unknown(i):
                raw[i] = " ⁇ ".encode()
        self.raw = raw
        self.prefixed = self.sp.normalize("a").startswith(MARK)

    def _keys(self, pieces: list[str], pad: int) -> np.ndarray:
        out = np.full((len(pieces), self.longest + 1), pad, ">u2")
        out[:, -1] = pad
        for k, p in enumerate(pieces):
            out[k, : len(p)] = self.letter[[ord(c) for c in p]]
        return np.ascontiguousarray(out).view(f"S{2 * (self.longest + 1)}").ravel()


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by their next ``depth`` symbols (prefix doubling)."""
    rank, k = text.astype(np.uint64), 1
    while k < depth:
        after = np.zeros_like(rank)
        after[:-k] = rank[k:] + np.uint64(1) if k < len(rank) else 0
        _, rank = np.unique(rank * np.uint64(len(text) + 0x10001) + after, return_inverse=True)
        rank, k = rank.astype(np.uint64), 2 * k
    return np.argsort(rank, kind="stable")


class Encoder:
    LIMIT = 300_000                 # words remembered before the older half goes

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    # --- edges
    def _edges(self, text: np.ndarray) -> np.ndarray:
        """table[position, length]: piece whose occurrence starts there, or -1."""
        v = self.v
        depth = v.longest + 1
        sa = suffix_array(text, depth)
        padded = np.concatenate([text, np.zeros(depth, text.dtype)]).astype(">u2")
        rows = np.lib.stride_tricks.sliding_window_view(padded, depth)[sa]
        keys = np.ascontiguousarray(rows).view(f"S{2 * depth}").ravel()
        lo, hi = np.searchsorted(keys, v.low), np.searchsorted(keys, v.high)
        n = hi - lo
        which = np.repeat(np.arange(len(n)), n)
        at = sa[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
        order = np.argsort(at, kind="stable")
        table = np.full((len(text), depth), -1, np.int32)
        table[at[order], v.lengths[which[order]]] = v.ids[which[order]]
        return table

    # --- relaxation
    def _relax(self, table: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols (word, start, end) of all short words after their merges."""
        scores, longest = self.v.scores, self.v.longest
        word = np.repeat(np.arange(len(starts)), lens)
        s = np.arange(len(word)) - np.repeat(np.cumsum(lens) - lens, lens) + np.repeat(starts, lens)
        e = s + 1
        done = []
        while len(s):
            inside = word[:-1] == word[1:]
            span = np.where(inside, e[1:] - s[:-1], 0)
            piece = np.where((span > 0) & (span <= longest), table[s[:-1], np.minimum(span, longest)], -1)
            sc = np.append(np.where(piece >= 0, scores[piece], -np.inf), -np.inf)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.maximum.reduceat(sc, first)
            live = best > -np.inf
            size = np.diff(np.append(first, len(word)))
            if not live.all():                          # words without a pair left
                over = np.repeat(~live, size)
                done.append((word[over], s[over], e[over]))
                word, s, e, sc, best, size = word[~over], s[~over], e[~over], sc[~over], best[live], size[live]
                if not len(s):
                    break
            hit = np.flatnonzero(sc == np.repeat(best, size))
            hit = hit[np.diff(word[hit], prepend=-1) != 0]      # the leftmost of each word
            e[hit] = e[hit + 1]
            stay = np.ones(len(s), bool)
            stay[hit + 1] = False
            word, s, e = word[stay], s[stay], e[stay]
        w, s, e = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64),) * 3
        order = np.argsort(s, kind="stable")
        return w[order], s[order], e[order]

    def _relax_long(self, table: np.ndarray, start: int, length: int) -> list[tuple[int, int]]:
        """One long word: the same merges in the same order, from a heap."""
        longest, scores = self.v.longest, self.v.scores
        nxt, prev = list(range(1, length + 1)), list(range(-1, length - 1))
        heap: list = []

        def offer(i: int) -> None:
            j = nxt[i]
            if i >= 0 and j < length:
                n = nxt[j] - i
                p = table[start + i, n] if n <= longest else -1
                if p >= 0:
                    heapq.heappush(heap, (-scores[p], i, n))
        for i in range(length - 1):
            offer(i)
        alive = [True] * length
        while heap:
            _, i, n = heapq.heappop(heap)
            if not alive[i]:
                continue
            j = nxt[i]
            if j >= length or nxt[j] - i != n:
                continue
            alive[j] = False
            nxt[i] = nxt[j]
            if nxt[i] < length:
                prev[nxt[i]] = i
                offer(i)
            if prev[i] >= 0:
                offer(prev[i])
        out, i = [], 0
        while i < length:
            out.append((start + i, start + nxt[i]))
            i = nxt[i]
        return out

    def _fallback(self, char: str) -> list[int]:
        return [self.v.byte[b] for b in char.encode()] if self.v.byte else [self.v.unknown]

    def _learn(self, words: list[str]) -> None:
        part, size = [], 0
        for w in words:
            part.append(w)
            size += len(w) + 1
            if size >= INDEX_CHARS:
                self._index(part)
                part, size = [], 0
        if part:
            self._index(part)

    def _index(self, words: list[str]) -> None:
        v = self.v
        joined = "\0".join(words) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lens + 1) - lens - 1
        text = v.letter[codes]
        text[starts + lens] = 0
        table = self._edges(text)
        short = np.flatnonzero(lens <= SHORT)
        w, s, e = self._relax(table, starts[short], lens[short])
        w = short[w]
        for k in np.flatnonzero(lens > SHORT):
            more = np.array(self._relax_long(table, int(starts[k]), int(lens[k])))
            w, s, e = np.append(w, np.full(len(more), k)), np.append(s, more[:, 0]), np.append(e, more[:, 1])
        order = np.lexsort((s, w))
        w, s, e = w[order], s[order], e[order]
        ids = table[s, e - s].astype(np.int64)
        odd = set(w[ids < 0].tolist())
        cuts = np.searchsorted(w, np.arange(len(words) + 1))
        packed = ids.astype("<u4").tobytes()
        if len(self.now) + len(words) > self.LIMIT:
            self.old, self.now = self.now, {}
        for k, word in enumerate(words):
            a, b = int(cuts[k]), int(cuts[k + 1])
            if k in odd:
                got: list[int] = []
                for i in range(a, b):
                    new = [int(ids[i])] if ids[i] >= 0 else self._fallback(joined[s[i]])
                    if not (new == [v.unknown] and got[-1:] == new):         # unknown runs are one piece
                        got += new
                self.now[word] = np.array(got, "<u4").tobytes()
            else:
                self.now[word] = packed[4 * a : 4 * b]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        cut = [self.v.words(self.v.sp.normalize(t)) for t in texts]
        need, new = set().union(*cut) if cut else set(), []
        have = self.now
        for w in need:
            if w not in have:
                got = self.old.get(w)
                if got is None:
                    new.append(w)
                else:
                    have[w] = got
        mine = {w: have[w] for w in need if w in have}      # _learn may forget some of them
        for i in range(0, len(new), 100_000):
            self._learn(sorted(new[i : i + 100_000]))
            mine.update((w, self.now[w] if w in self.now else self.old[w]) for w in new[i : i + 100_000])
        return [b"".join(map(mine.__getitem__, ws)) for ws in cut]

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces joined, space marks turned into spaces, byte pieces into characters."""
        raw = b"".join(map(self.v.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        out = raw.decode("utf-8", "replace")
        return out[1:] if self.v.prefixed and out.startswith(" ") else out


def byte_slices(batches: Iterator[pa.RecordBatch], name: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice's texts have about ``limit`` bytes, or one row."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(name))), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < b.num_rows:
            base = size[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(size, base + limit)))
            yield b.slice(i, j - i)
            i = j


def encode_table(docs: DataFrame, model_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """``keep`` columns, n_pieces, ids_crc32 (of the ids as little-endian unsigned 32-bit
    numbers), decoded_crc32 (of the decoded text in UTF-8), round_trip (it equals the text), and
    the ids themselves if asked for: one row per document.

    A null text is empty and has no pieces.  Other columns are ignored; an empty table gives an empty result.
    """
    src = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("_text"))
    out = ("".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:-1])
           + "n_pieces long, ids_crc32 long, decoded_crc32 long, round_trip boolean" + (", ids array<int>" if with_ids else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept_in_process(("pieces", model_path), lambda: Encoder(model_path))
        for b in byte_slices(batches, "_text"):
            texts = [t.decode("utf-8", "replace") for t in byte_texts(b, "_text")]
            ids = coder(texts)
            n, crc, back, same = [], [], [], []
            for t, x in zip(texts, ids):
                d = coder.decode(x)
                n.append(len(x) // 4)
                crc.append(zlib.crc32(x))
                back.append(zlib.crc32(d.encode()))
                same.append(d == t)
            cols = [pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(back, pa.int64()), pa.array(same, pa.bool_())]
            if with_ids:
                cols.append(pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols], [*b.schema.names[:-1], "n_pieces", "ids_crc32", "decoded_crc32", "round_trip", "ids"][: b.num_columns - 1 + len(cols)])
    return src.mapInArrow(run, out)
