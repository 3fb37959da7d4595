"""Collocations of a corpus by SON partitioning: phrases that occur often, and how much more often than chance.

Per language, over words within pieces (no phrase crosses a punctuation mark or a line end):

1. Words are counted exactly; a phrase can be frequent only if its words are.
2. Every shard (the words of one language that a task holds at a time) is mined completely, level by
   level, at the local support ceil(min_count * words of the shard / words of the language): a phrase
   below it in every shard is below min_count in all.  Pairs of words are first counted in hashed buckets, and only
   those in buckets that reach the support one by one.  Only hashes of locally frequent phrases leave the shard.
3. Their union is a bitmap of fixed size that every task gets.  A second pass counts all phrases whose
   hashes it holds, by their words and in all shards, so that their counts are exact; those that the
   bitmap lets through by chance are counted as well and fall to min_count like any other.

With more than min_count shards of a language the local support is 1 and step 2 prunes by
frequent words and by level alone; results do not change.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histlens.llm.common import Stages, byte_texts, slices

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
SHARD_WORDS = 32_000_000        # words that a task holds at a time, four bytes each and 24 more while mined: the larger the shards, the fewer candidates
CHUNK_WORDS = 2_000_000         # words in which a task counts candidates at a time
HELD_PHRASES = 1_000_000        # phrases whose counts a task sums
COUNTED_WORDS = 400_000         # different words that a task counts at a time
BLOCK = 1 << 20                 # words looked at in one step
BUCKETS = 1 << 22               # counters of hashed pairs of a shard
FILTER_BITS = 26                # bits (as a power of 2) of the broadcast filters

_END = 0xFF                     # stands for the marks between pieces; no UTF-8 text holds it
_TABLE = bytearray(range(256))
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = _END
_TABLE[0x09] = 0x20
_TABLE = bytes(_TABLE)


def words_of(texts: list[bytes]) -> list[bytes]:
    """The words of all texts, lower-cased A-Z; pieces and texts are parted by b'\\xff'."""
    return b"\xff".join(texts).lower().translate(_TABLE).replace(b"\xff", b" \xff ").split()


class Numbers(dict):
    """Words to numbers from 1, in order of appearance; b'\\xff' and words that ``known`` refuses are 0."""

    ROOM = 100_000                  # refused words that are remembered

    def __init__(self, lang: str, known=None):
        super().__init__({b"\xff": 0})
        self.lang, self.known, self.refused = lang.encode() + b"\0", known, 0
        self.words: list[bytes] = [b""]
        self.hashes: list[int] = [0]

    def __missing__(self, w: bytes) -> int:
        h = xxhash.xxh64_intdigest(self.lang + w)
        if self.known is not None:
            at = h & ((1 << FILTER_BITS) - 1)
            if not int(self.known[at >> 6]) >> (at & 63) & 1:
                if self.refused < self.ROOM:
                    self[w] = 0
                    self.refused += 1
                return 0
        self[w] = n = len(self.words)
        self.words.append(w)
        self.hashes.append(h)
        return n

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, int]:
        """The numbers of all words with 0 between pieces and at the end, and how many words there are."""
        ws = words_of(texts)
        ids = np.zeros(len(ws) + 1, np.int32)
        ids[:-1] = np.fromiter(map(self.__getitem__, ws), np.int32, len(ws))
        return ids, len(ws) - ws.count(b"\xff")


class Counts:
    """Counts of the words of one language."""

    def __init__(self, lang: str, _filter=None):
        self.number, self.n, self.words = Numbers(lang), np.zeros(1, np.int64), 0

    def add(self, texts: list[bytes]) -> None:
        ids, words = self.number(texts)
        more = np.bincount(ids, minlength=len(self.number.words))
        more[: len(self.n)] += self.n
        self.n, self.words = more, self.words + words

    def size(self) -> int:
        return len(self.n)


class Shard:
    """The words of one language as numbers, 0 between pieces and for words that are not frequent."""

    def __init__(self, number: Numbers):
        self.number, self.parts, self.words = number, [], 0

    def add(self, texts: list[bytes]) -> None:
        ids, words = self.number(texts)
        self.parts.append(ids)
        self.words += words

    def size(self) -> int:
        return self.words

    def text(self) -> np.ndarray:
        ids, self.parts = np.concatenate(self.parts), []
        return ids


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _in_filter(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


def _neighbours(ids: np.ndarray, word_hash: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, hashes) of all pairs of neighbouring words, block by block."""
    for i in range(0, len(ids) - 1, BLOCK):
        x, y = ids[i : i + BLOCK], ids[i + 1 : i + BLOCK + 1]
        at = np.flatnonzero((x[: len(y)] > 0) & (y > 0))
        if len(at):
            yield at + i, _mix(word_hash[x[at]] + np.uint64(2) + _mix(word_hash[y[at]]))


def _often(ids: np.ndarray, word_hash: np.ndarray, support: int):
    """Which hashes of neighbours may belong to pairs with ``support`` occurrences: those in buckets with so many."""
    if support < 2:
        return lambda hk: np.ones(len(hk), bool)
    buckets, last = np.zeros(BUCKETS, np.int32), np.uint64(BUCKETS - 1)
    for _, hk in _neighbours(ids, word_hash):
        buckets += np.bincount((hk & last).astype(np.int64), minlength=BUCKETS).astype(np.int32)
    return lambda hk: buckets[(hk & last).astype(np.int64)] >= support


def _hashes(ids: np.ndarray, word_hash: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the phrases of k words at these places."""
    h = word_hash[ids[at + (k - 1)]]
    for j in range(k - 2, -1, -1):
        h = _mix(word_hash[ids[at + j]] + np.uint64(k - j) + _mix(h))
    return h


def _blocks(n: int) -> Iterator[slice]:
    return (slice(i, i + BLOCK) for i in range(0, n, BLOCK))


def levels(ids: np.ndarray, word_hash: np.ndarray, max_words: int, pairs, longer, keep) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(k, places, counts, hashes) of the phrases of k = 2 .. max_words words that are kept, each with a place where it stands.

    A phrase of k words is looked at where both its parts of k - 1 words were kept.  pairs(hashes) and longer(hashes) say which
    occurrences to count (longer None: all), keep(counts) which counted phrases to keep.  Phrases are told apart by their parts' numbers,
    never by hashes.  Places and numbers are held in four bytes, keys are sorted in place, and all else is made block by block.
    """
    found = [at[pairs(hk)].astype(np.int32) for at, hk in _neighbours(ids, word_hash)]
    if not found:
        return
    at = np.concatenate(found)
    del found
    left, right = ids[at], ids[at + 1]
    for k in range(2, max_words + 1):
        if not len(at):
            return
        keys = left.astype(np.int64)
        keys <<= 32
        keys |= right
        keys.sort()
        starts = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1)
        n, keys = np.diff(np.append(starts, len(keys))), keys[starts]
        good = keep(n)
        numbers = (np.cumsum(good) * good).astype(np.int32)
        place, number = np.zeros(len(keys), np.int32), np.zeros(len(at), np.int32)
        for b in _blocks(len(at)):
            which = np.searchsorted(keys, left[b].astype(np.int64) << 32 | right[b])
            place[which], number[b] = at[b], numbers[which]
        place, n = place[good], n[good]
        del left, right, keys, starts, numbers, good
        for b in _blocks(len(place)):
            yield k, place[b], n[b], _hashes(ids, word_hash, place[b], k)
        del place, n
        there = number > 0
        at, number = at[there], number[there]
        follows = np.flatnonzero(np.diff(at) == 1)
        if k < max_words and longer is not None and len(follows):
            follows = np.concatenate([x[longer(_hashes(ids, word_hash, at[x], k + 1))] for b in _blocks(len(follows)) for x in (follows[b],)])
        at, left, right = at[follows], number[follows], number[follows + 1]
        del there, follows, number


def _shards(batches: Iterator[pa.RecordBatch], make, emit, limit: int) -> Iterator[pa.RecordBatch]:
    """Gather (lang, text) rows by language and emit what is gathered: as soon as it reaches the limit, the rest at the end."""
    held: dict = {}
    for b in slices(batches):
        langs = np.array(b.column(0).to_pylist(), object)
        texts = byte_texts(b, "_text")
        for lang in dict.fromkeys(langs):
            if lang not in held:
                held[lang] = make(lang)
            held[lang].add([texts[i] for i in np.flatnonzero(langs == lang)])
        while sum(s.size() for s in held.values()) >= limit:
            lang = max(held, key=lambda x: held[x].size())
            yield from emit(lang, held.pop(lang))
    for lang in list(held):
        yield from emit(lang, held.pop(lang))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(lang: str, s: Counts) -> Iterator[pa.RecordBatch]:
        words = s.number.words
        for i in range(1, len(words), 100_000):
            j = min(len(words), i + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (j - i)), pa.array(words[i:j], pa.binary()).cast(pa.string()), pa.array(np.array(s.number.hashes[i:j], np.uint64).view(np.int64)),
                 pa.array(s.n[i:j], pa.int64())], ["lang", "phrase", "h", "f"])
    return _shards(batches, Counts, emit, COUNTED_WORDS)


def _mine(frequent, totals, min_count: int, max_words: int, shard_words: int):
    """Hashes of the locally frequent phrases of each shard."""
    def emit(lang: str, s: Shard) -> Iterator[pa.RecordBatch]:
        support = max(1, -(-min_count * s.words // max(1, totals.value.get(lang, 1))))
        ids, h = s.text(), np.array(s.number.hashes, np.uint64)
        rare = sum(np.bincount(ids[b], minlength=len(h)) for b in _blocks(len(ids))) < support
        for b in _blocks(len(ids)):
            ids[b][rare[ids[b]]] = 0
        for _, _, _, hk in levels(ids, h, max_words, _often(ids, h, support), None, lambda c: c >= support):
            yield pa.RecordBatch.from_arrays([pa.array(hk.view(np.int64))], ["h"])
    return lambda batches: _shards(batches, lambda lang: Shard(Numbers(lang, frequent.value)), emit, shard_words)


def _count(frequent, candidates, max_words: int, shard_words: int):
    """(lang, phrase, words, f): a task's counts of all phrases whose hashes the candidates hold.

    Words are held in chunks, smaller than shards as counts add up, and the chunks' counts are summed in
    the task until it holds HELD_PHRASES of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, Numbers] = {}
        sums: dict[str, dict[bytes, int]] = {}

        def make(lang: str) -> Shard:
            if lang not in numbers:
                if len(numbers) >= 8:
                    numbers.clear()
                numbers[lang] = Numbers(lang, frequent.value)
            return Shard(numbers[lang])

        def emit(lang: str, s: Shard) -> Iterator[pa.RecordBatch]:
            ids, h, words, held = s.text(), np.array(s.number.hashes, np.uint64), s.number.words, sums.setdefault(lang, {})
            known = lambda hk: _in_filter(candidates.value, hk)
            for k, at, n, _ in levels(ids, h, max_words, known, known, lambda c: c > 0):
                for i in range(0, len(at), 20_000):
                    for row, c in zip(ids[at[i : i + 20_000, None] + np.arange(k)].tolist(), n[i : i + 20_000].tolist()):
                        phrase = b" ".join(map(words.__getitem__, row))
                        held[phrase] = held.get(phrase, 0) + c
            if sum(map(len, sums.values())) >= HELD_PHRASES:
                yield from flush()

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, held in sums.items():
                phrases = list(held)
                for i in range(0, len(phrases), 100_000):
                    part = phrases[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array([p.count(b" ") + 1 for p in part], pa.int32()),
                         pa.array([held[p] for p in part], pa.int64())], ["lang", "phrase", "words", "f"])
            sums.clear()

        yield from _shards(batches, make, emit, min(shard_words, CHUNK_WORDS))
        yield from flush()
    return run


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """A filter of 2^FILTER_BITS bits, built by Spark: one 64-bit word a row, whatever the number of hashes."""
    at = F.col("h").bitwiseAND((1 << FILTER_BITS) - 1)
    words = hashes.groupBy(F.shiftright(at, 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(h & 63 AS INT))")).alias("m")).toArrow()
    bits = np.zeros(1 << FILTER_BITS >> 6, np.int64)
    bits[words.column("w").to_numpy()] = words.column("m").to_numpy()
    return bits


def phrase_counts(docs: DataFrame, st: Stages, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                  shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f): all phrases of 1 .. max_words words with f >= min_count; (lang, n): all words), both written."""
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("_lang"), F.col(text_col).alias("_text"))
    cores = max(1, spark.sparkContext.defaultParallelism)
    words = st.write(src.coalesce(4 * cores).mapInArrow(_word_counts, "lang string, phrase string, h long, f long")
                     .groupBy("lang", "phrase").agg(F.first("h").alias("h"), F.sum("f").alias("f")), "words")
    totals = st.write(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    often = words.filter(F.col("f") >= min_count)
    n_of = spark.sparkContext.broadcast(dict(totals.toArrow().to_pandas().itertuples(index=False)))
    # as few shards as memory allows: many small files do not make small shards with low supports
    src = src.coalesce(max(cores, -(-sum(n_of.value.values()) // shard_words)))
    frequent = spark.sparkContext.broadcast(_bitmap(often))
    mined = st.write(src.mapInArrow(_mine(frequent, n_of, min_count, max_words, shard_words), "h long").distinct(), "mined")
    candidates = spark.sparkContext.broadcast(_bitmap(mined))
    found = (src.mapInArrow(_count(frequent, candidates, max_words, shard_words), "lang string, phrase string, words int, f long")
             .groupBy("lang", "phrase").agg(F.first("words").alias("words"), F.sum("f").alias("f")).filter(F.col("f") >= min_count))
    found = st.write(found.unionByName(often.select("lang", "phrase", F.lit(1).alias("words"), "f")), "phrases")
    st.drop("words", "mined")
    return found, totals


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (left right)), in decimals: products may pass 64 bits."""
    wide = lambda c: c.cast("decimal(19,0)")
    up = (wide(a) * wide(n)).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", up, wide(left) * wide(right))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 .. max_words words with a >= min_count occurrences.

    n counts the language's words, l and r the occurrences of a cut's two parts; score is floor(1000 a n / (l r)) of
    the cut where it is lowest (ties: the shortest first part).  A phrase inside a longer one that occurs as often is
    dropped.  Rank follows score and a descending, then the phrase in byte order.  A null text is
    empty, a null language is ``und``; repeated rows all count; an empty table gives an empty result; other columns are ignored.
    """
    st = Stages(docs.sparkSession, "phrases")
    f, totals = phrase_counts(docs, st, text_col, lang_col, min_count, max_words, shard_words)
    longer = f.filter("words > 1")
    parts = F.split("phrase", " ")
    # a phrase occurs at least as often as any that holds it; if one holds it as often, so does one that is a word longer
    inside = longer.filter("words > 2").select("lang", F.explode(F.array(
        F.array_join(F.slice(parts, F.lit(1), F.col("words") - 1), " "), F.array_join(F.slice(parts, F.lit(2), F.col("words") - 1), " "))).alias("phrase"), F.col("f").alias("most"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    own = longer.join(inside, ["lang", "phrase"], "left").filter("most IS NULL OR most < f").drop("most")
    own = st.write(own.join(totals, "lang"), "own")
    cut = own.select("lang", "phrase", F.col("f").alias("a"), "n", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(F.array_join(F.slice(parts, F.lit(1), k), " ").alias("left"), F.array_join(F.slice(parts, k + 1, F.col("words") - k), " ").alias("right")))).alias("k", "c"))
    cut = cut.select("lang", "phrase", "a", "n", "k", "c.left", "c.right")
    cut = (cut.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
           .join(f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]))
    cut = cut.withColumn("score", score(*map(F.col, "anlr")))
    best = cut.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"), F.first("a").alias("a"), F.first("n").alias("n"))
    scored = st.write(best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score"), "scored")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first the best of hashed parts of a language, then of the language: no task sorts all its phrases
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    near = scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
