"""Alignment of two tokenizers on a corpus: byte-level BPE (A) and a SentencePiece model (B).

Both tokenizers cut the same bytes, a space and the text.  Places where both end a token cut them into
groups.  Nearly all groups hold one token of each, and those tokens have the same bytes: a
table made beforehand gives the B id with the bytes of every A id, and such groups are counted in a vector
as long as A's vocabulary.  Only irregular groups give (A id, B id) pairs that are shuffled.

The two tokens that end together in a group end in the same bytes, so one's bytes are a proper ending of the other's (or the
same, under a second id).  The pairs that can occur are therefore known from the
vocabularies, a few hundred thousand whatever the corpus (``Pairs``): counts of all pairs have a fixed
size, links are stored as one small number each, and the counts can be sent to every task.

Texts are cut into units where both tokenizers always cut: before white space that follows another character,
and after a lone line break.  A unit's alignment is remembered.  Where a tokenizer's file does not
promise those cuts, the whole text is one unit.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlens.llm.common import Stages, byte_texts, forget_kept, kept_in_process, slices

MARK = "▁"
# white space of byte-level pre-tokenizers (inside a character class)
_WS = "\t-\r \x85\xa0" + "".join(map(chr, (0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + f"{chr(0x2000)}-{chr(0x200A)}"


def _unit_cutter(glued: str):
    """Cuts texts before white space that follows another character, unless it starts with one of ``glued``, and after a lone line break."""
    more = f"[{re.escape(glued)}][{_WS}]*" if glued else "(?!)"
    return re.compile(f"\n(?=[^{_WS}])|[{_WS}]*[^{_WS}]+(?:{more}[^{_WS}]+)*(?:{more})?|[{_WS}]+").findall


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 itself, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokens:
    """Both tokenizers and the bytes of their tokens (None: a token that stands for no bytes)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        letters, special = _byte_of_letter(), {t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_a: list[bytes | None] = [None] * self.a.get_vocab_size(with_added_tokens=True)
        for piece, i in self.a.get_vocab(with_added_tokens=True).items():
            if i not in special and all(c in letters for c in piece):
                self.bytes_a[i] = bytes([letters[c] for c in piece])
        sp, n = self.b, self.b.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        self.bytes_b: list[bytes | None] = [
            bytes([int(p[1:-1], 16)]) if sp.is_byte(i) else None if sp.is_control(i) or sp.is_unknown(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)]
        # may texts be cut into units?
        pre = spec.get("pre_tokenizer") or {}
        plain_a = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                   and spec.get("model", {}).get("type") == "BPE")
        space = re.compile(f"[{_WS}{MARK}]").fullmatch
        normal = [p for i, p in enumerate(pieces) if self.bytes_b[i] and not sp.is_byte(i)]
        glued = {y for p in normal for x, y in zip(p, p[1:]) if space(y) and not space(x)}       # white space that pieces have after another character
        plain_b = not glued & {MARK, " "} and not any("\n" in p for p in normal) and sp.encode("a\n") == [*sp.encode("a"), *sp.encode("\n")[1:]]
        self.cuts = plain_a and plain_b
        self.units = _unit_cutter("".join(sorted(glued))) if self.cuts else lambda text: [text]
        self.space = re.compile(f"[{_WS}]").fullmatch

    def encode_b(self, unit: str) -> list[int]:
        """B's ids of a unit.  B itself puts a space before what it encodes; a unit without one follows a line break, and so it does here."""
        if unit[:1] == " " != unit:
            return self.b.encode(unit[1:])
        return self.b.encode("\n" + unit)[self.lead :]

    @property
    def lead(self) -> int:
        if not hasattr(self, "_lead"):
            self._lead = len(self.b.encode("\n"))
        return self._lead


class Pairs:
    """All (A id, B id) pairs whose tokens can end together, numbered: number a is A's id a with the B id of the same
    bytes (``same``), the numbers from len(A) on are the other pairs, in ascending order."""

    def __init__(self, bytes_a: list[bytes | None], bytes_b: list[bytes | None]):
        by_a: dict[bytes, list[int]] = {}
        by_b: dict[bytes, list[int]] = {}
        for tokens, by in ((bytes_a, by_a), (bytes_b, by_b)):
            for i, t in enumerate(tokens):
                if t:
                    by.setdefault(t, []).append(i)
        self.n_a, self.n_b = len(bytes_a), len(bytes_b)
        self.same = np.full(self.n_a, -1, np.int64)
        other = set()
        for t, ids in by_a.items():
            for i in ids:
                if t in by_b:
                    self.same[i] = max(by_b[t])         # of a piece and a byte with equal bytes the piece, which encoding prefers
                other.update(i * self.n_b + j for k in range(len(t)) for j in by_b.get(t[k:], ()) if k or j != self.same[i])
        for t, ids in by_b.items():
            other.update(i * self.n_b + j for k in range(1, len(t)) for i in by_a.get(t[k:], ()) for j in ids)
        self.other = np.array(sorted(other), np.int64)
        self.size = self.n_a + len(self.other)
        self.a = np.concatenate([np.arange(self.n_a), self.other // self.n_b])
        self.b = np.concatenate([self.same, self.other % self.n_b])

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        regular = self.same[a] == b
        return np.where(regular, a, self.n_a + np.searchsorted(self.other, a * self.n_b + b))


class Aligner:
    """Callable: texts to (n_a, n_b, links as int32 pair numbers, groups) each; None where the tokens do not spell the text."""

    LIMIT = 150_000                 # units remembered before the older half goes
    LONG = 256                      # longer units are not remembered

    def __init__(self, path_a: str, path_b: str):
        self.t = Tokens(path_a, path_b)
        self.pairs = Pairs(self.t.bytes_a, self.t.bytes_b)
        self.size_a = np.array([len(x or b"") for x in self.t.bytes_a])
        self.size_b = np.array([len(x or b"") for x in self.t.bytes_b])
        self.written = [b"%d%s" % (i, mark) for i in range(max(self.pairs.n_a, self.pairs.n_b)) for mark in (b",", b"|", b";", b"")]
        self.now: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def _align(self, a: list[int], b: list[int], raw: bytes) -> tuple | None:
        pa_, pb = [self.t.bytes_a[i] for i in a], [self.t.bytes_b[i] for i in b]
        if None in pa_ or None in pb or b"".join(pa_) != raw or b"".join(pb) != raw:
            return None
        ia, ib = np.array(a, np.int64), np.array(b, np.int64)
        ea, eb = np.cumsum(self.size_a[ia]), np.cumsum(self.size_b[ib])
        _, ka, kb = np.intersect1d(ea, eb, assume_unique=True, return_indices=True)
        links = self.pairs.number(ia[ka], ib[kb]).astype("<i4").tobytes()
        out, i, j = [], 0, 0
        for x, y in zip(ka.tolist(), kb.tolist()):
            out.append(",".join(map(str, a[i : x + 1])) + "|" + ",".join(map(str, b[j : y + 1])))
            i, j = x + 1, y + 1
        return len(a), len(b), links, ";".join(out).encode()

    def _one(self, unit: str) -> tuple | None:
        return self._align(self.t.a.encode(unit, add_special_tokens=False).ids, self.t.encode_b(unit), unit.encode())

    def _learn(self, units: list[str]) -> dict[str, tuple | None]:
        """Alignments of units.  Those that may follow each other in a text (a space first, or nothing before a line break is put there; no white
        space last) are encoded as one text: both tokenizers cut between them, so that each token is in one unit."""
        got, chain = {}, []
        for u in units:
            if self.t.cuts and not self.t.space(u[-1]) and (u[0] == " " or not self.t.space(u[0])):
                chain.append(u)
            else:
                got[u] = self._one(u)
        for i in range(0, len(chain), 20_000):
            part = [" a"]
            for u in chain[i : i + 20_000]:
                part += [u] if u[0] == " " else ["\n", u]
            found = self._aligned_chain(part)
            got.update(zip(part, found) if found is not None else ((u, self._one(u)) for u in part))
        return got

    def _aligned_chain(self, units: list[str]) -> list[tuple] | None:
        """The units' alignments from one encoding of them on end; None if the tokens do not spell it unit by unit."""
        text = "".join(units)
        ia = np.array(self.t.a.encode(text, add_special_tokens=False).ids, np.int64)
        ib = np.array(self.t.b.encode(text[1:]), np.int64)
        raw = text.encode()
        for ids, tokens in ((ia, self.t.bytes_a), (ib, self.t.bytes_b)):
            spelt = [tokens[i] for i in ids.tolist()]
            if None in spelt or b"".join(spelt) != raw:
                return None
        ea, eb = np.cumsum(self.size_a[ia]), np.cumsum(self.size_b[ib])
        ends, ka, kb = np.intersect1d(ea, eb, assume_unique=True, return_indices=True)
        stop = np.cumsum(np.fromiter((len(u.encode()) for u in units), np.int64, len(units)))
        last = np.searchsorted(ends, stop)
        if not np.array_equal(ends[np.minimum(last, len(ends) - 1)], stop):
            return None
        links = self.pairs.number(ia[ka], ib[kb]).astype("<i4").tobytes()
        # the ids as written: A's of a group, then B's; a mark after each
        g_a = np.searchsorted(ka, np.arange(len(ia)))
        g_b = np.searchsorted(kb, np.arange(len(ib)))
        at_a = np.arange(len(ia)) + np.concatenate([[0], kb[:-1] + 1])[g_a]
        at_b = np.arange(len(ib)) + (ka + 1)[g_b]
        end_a, end_b = np.zeros(len(ia), np.int64), np.zeros(len(ib), np.int64)
        end_a[ka] = end_b[kb] = 1
        codes = np.empty(len(ia) + len(ib), np.int64)
        codes[at_a], codes[at_b] = 4 * ia + end_a, 4 * ib + 2 * end_b
        written = list(map(self.written.__getitem__, codes.tolist()))
        n_a, n_b = np.diff(ka[last] + 1, prepend=0).tolist(), np.diff(kb[last] + 1, prepend=0).tolist()
        out, i, j = [], 0, 0
        for x, y, k in zip(n_a, n_b, (last + 1).tolist()):
            out.append((x, y, links[4 * j : 4 * k], b"".join(written[i : i + x + y])[:-1]))
            i, j = i + x + y, k
        return out

    def __call__(self, texts: list[str]) -> list[tuple | None]:
        b, cut = self.t.b, []
        for t in texts:
            # B may rewrite a text (white space, compatibility forms); its tokens then do not spell it
            same = bool(t) and b.normalize(t).replace(MARK, " ") == " " + t
            cut.append(self.t.units(" " + t) if same else None)
        need = set().union(*[c for c in cut if c]) if any(cut) else set()
        have, new = {}, []
        for u in need:
            x = self.now.get(u) or self.old.get(u)
            if x is None:
                new.append(u)
            else:
                have[u] = self.now[u] = x
        learnt = self._learn(new)
        have.update(learnt)
        self.now.update((u, x) for u, x in learnt.items() if x and len(u) <= self.LONG)
        if len(self.now) > self.LIMIT:
            self.old, self.now = self.now, {}
        out = []
        for c in cut:
            got = [have[u] for u in c] if c else [None]
            if None in got:
                out.append(None)
                continue
            na, nb, links, groups = zip(*got)
            out.append((sum(na), sum(nb), b"".join(links), b";".join(groups)))
        return out


def _kept(path_a: str, path_b: str) -> Aligner:
    return kept_in_process(("align", path_a, path_b), lambda: Aligner(path_a, path_b))


def _links(docs: DataFrame, path_a: str, path_b: str, text_col: str, keep: tuple, with_groups: bool) -> DataFrame:
    """(_keep, n_a, n_b, n_groups, groups_sha256, _links[, groups]) of each document."""
    src = docs.select(F.struct(*keep).alias("_keep"), F.col(text_col).alias("_text"))
    names = ["_keep", "n_a", "n_b", "n_groups", "groups_sha256", "_links", *["groups"] * with_groups]
    schema = (f"_keep {src.schema['_keep'].dataType.simpleString()}, n_a long, n_b long, n_groups long, groups_sha256 string, _links array<int>"
              + ", groups string" * with_groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _kept(path_a, path_b)
        for b in slices(batches):
            rows = [x or (0, 0, b"", b"") for x in aligner([t.decode() for t in byte_texts(b, "_text")])]
            cols = [pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64()), pa.array([len(x[2]) // 4 for x in rows], pa.int64()),
                    pa.array([hashlib.sha256(x[3]).hexdigest() if x[3] else "" for x in rows], pa.string()),
                    pa.array([np.frombuffer(x[2], "<i4") for x in rows], pa.list_(pa.int32()))]
            if with_groups:
                cols.append(pa.array([x[3].decode() for x in rows], pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names)
    return src.mapInArrow(run, schema)


def pair_counts(links: DataFrame, pairs) -> DataFrame:
    """(a, b, n): links of each pair, over all rows of ``_links``.

    One-to-one groups are counted in a vector as long as A's vocabulary, one a task; irregular pairs are counted beside it and summed by a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()                   # the aligner, which the stage before has needed
        p = pairs.value
        regular, irregular = np.zeros(p.n_a, np.int64), np.zeros(len(p.other), np.int64)
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False)
            plain = x < p.n_a
            regular += np.bincount(x[plain], minlength=p.n_a)
            irregular += np.bincount(x[~plain] - p.n_a, minlength=len(p.other))
        for first, n in ((0, regular), (p.n_a, irregular)):
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(p.a[at + first]), pa.array(p.b[at + first]), pa.array(n[at])], ["a", "b", "n"])
    return links.select("_links").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", keep: tuple = ("doc_id",), with_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs), from stored stages.

    documents, one row per row of docs: the columns ``keep``, n_a and n_b (tokens), n_groups, n_links, n_best (links whose pair is linked as often as
    any pair of its B id in the corpus), count_sum (of its links' pair counts), groups_sha256, and the groups themselves if asked for.
    pairs: (a, b, n), how many links of the corpus hold A's id a and B's id b.

    A text without tokens (null, empty, or one whose tokens' bytes do not spell it) has zeros and ''.
    Repeated rows all count; an empty table gives empty results; columns of ``keep`` may have any names but those of the result.
    """
    names = docs.select(*keep).columns
    result = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *["groups"] * with_groups]
    if set(names) & set(result):
        raise ValueError(f"keep has names of result columns: {sorted(set(names) & set(result))}")
    spark = docs.sparkSession
    st = Stages(spark, "align")
    pairs = spark.sparkContext.broadcast(Aligner(path_a, path_b).pairs)     # its size comes from the vocabularies
    rows = st.write(_links(docs, path_a, path_b, text_col, keep, with_groups), "links")
    counts = st.write(pair_counts(rows, pairs), "pairs")
    p = pairs.value
    n = np.zeros(p.size, np.int64)
    got = counts.toArrow()                          # at most p.size rows
    a, b = got.column("a").to_numpy(), got.column("b").to_numpy()
    n[p.number(a, b)] = got.column("n").to_numpy()
    most = np.zeros(p.n_b, np.int64)
    np.maximum.at(most, b, got.column("n").to_numpy())
    known = spark.sparkContext.broadcast((n, (n > 0) & (n == most[p.b])))

    kept = [f.name for f in rows.schema.fields if f.name not in ("_links",)]
    out = rows.select(*kept, "_links")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema.fields[:-1]) + ", n_links long, n_best long, count_sum long"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        count, best = known.value
        for b in batches:
            x = b.column(b.num_columns - 1)
            size = x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = x.flatten().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(b.num_rows), size)
            n_best = np.bincount(doc[best[flat]], minlength=b.num_rows)
            ends = np.concatenate([[0], np.cumsum(count[flat])])
            at = np.concatenate([[0], np.cumsum(size)])
            cols = [pa.array(size, pa.int64()), pa.array(n_best, pa.int64()), pa.array(ends[at[1:]] - ends[at[:-1]], pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols], [*b.schema.names[:-1], "n_links", "n_best", "count_sum"])
    scored = out.mapInArrow(score, schema)
    return scored.select(*[F.col("_keep")[c].alias(c) for c in names], *result), counts
