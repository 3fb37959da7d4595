"""Token files, packing and SentencePiece against the tokenizer libraries."""

import io
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from histlens.llm import bitpack, sp_suffix, vector_pack
from histlens.llm.word_ids import WordIds

TEXTS = [None, "", " ", "Hello, World.", "a.b,c 's 'LL don't U.S.A. x.. y,,", "Ünïcödé É É — “q” Σς ΑΣ", "日本語 テキスト😀",
         "<|endoftext|> x <|ENDOFTEXT|>", "tab\tand\r\nline\x0bx\x1cy z w", "a" * 3000, "word " * 3000, "Á é. K",
         "123 4,5.6", "\x00nul", "ends. ", ".,", "x.\n\ny,", "İstanbul İ."]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(brute.path(brute.TOKENIZER))


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdeE .,\n'sÉ日<|>5") for _ in range(rng.randint(0, 200))) for _ in range(n)]


def test_word_ids_equal_whole_text(tokenizer, monkeypatch):
    texts = [t or "" for t in TEXTS] + random_texts(300)
    for limit in (300_000, 50):                 # also with a memory that forgets
        monkeypatch.setattr(WordIds, "LIMIT", limit)
        w = WordIds(brute.path(brute.TOKENIZER))
        for t, got in zip(texts, w([t.encode() for t in texts])):
            assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("vocabulary", [2, 3, 256, 257, 49408, 65536, 65537, 1 << 20])
def test_pack_round_trip(vocabulary):
    rng = np.random.default_rng(0)
    width = bitpack.bit_width(vocabulary)
    assert 2**width >= vocabulary > 2 ** (width - 1) or vocabulary == 2
    for n in (0, 1, 7, 1000):
        ids = rng.integers(0, vocabulary, n)
        data = bitpack.pack(ids.astype("<u4"), width)
        assert len(data) == -(-n * width // 8)
        assert bitpack.unpack(data, width, n).tolist() == ids.tolist()


@pytest.mark.parametrize("width,block", [(16, 8), (17, 8), (5, 64)])
def test_file_random_access(width, block):
    rng = np.random.default_rng(1)
    docs = [(None if i == 0 else i, rng.integers(0, 2 ** min(width, 16), int(n)).astype("<u4")) for i, n in enumerate([0, 1, 8, 30, 0, 100, 7])]
    out = io.BytesIO()
    w = bitpack.Writer(out, width, block)
    for d, ids in docs:
        w.add(d, ids)
    w.close()
    r = bitpack.Reader(io.BytesIO(out.getvalue()))
    assert r.null.tolist() == [d is None for d, _ in docs]
    for i in random.Random(2).sample(range(len(docs)), len(docs)):
        assert r.ids(i).tolist() == docs[i][1].tolist()
    with pytest.raises(ValueError):
        bitpack.Reader(io.BytesIO(b"x" * 100))


def test_token_table(spark, tokenizer):
    rows = [(10 * i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (30, "same id"), (30, "same id")]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x"))
    got = sorted(bitpack.token_table(df, brute.path(brute.TOKENIZER)).collect(), key=lambda r: r.start)
    want = sorted((-1 if d is None else d, len(x := brute.token_ids(t, tokenizer)), zlib.crc32(np.array(x, "<u4").tobytes())) for d, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert bitpack.token_table(spark.createDataFrame([], "doc_id long, text string"), brute.path(brute.TOKENIZER)).collect() == []


def check_pieces(rows, docs, tokenizer, limit=2048):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for d, t in docs:
        ids = brute.token_ids(t, tokenizer)
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limit
    return by_seq


def test_pack_documents(spark, tokenizer):
    rng = random.Random(5)
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "word " * rng.randint(1, 5000)) for i in range(150)]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, rid int, offset int")
    rows = vector_pack.pack_documents(df, brute.path(brute.TOKENIZER)).collect()
    seqs = check_pieces(rows, docs, tokenizer)
    total = sum(r.length for r in rows)
    assert len(seqs) * 2048 < 1.03 * total + 2 * 2048
    assert vector_pack.pack_documents(spark.createDataFrame([], "doc_id long, text string"), brute.path(brute.TOKENIZER)).collect() == []
    few = vector_pack.pack_documents(spark.createDataFrame([(i, "x") for i in range(50)], "doc_id long, text string"),
                                     brute.path(brute.TOKENIZER), max_segments=4).collect()
    sizes = {}
    for r in few:
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + 1
    assert max(sizes.values()) <= 4 and len(few) == 50
    twice = vector_pack.pack_documents(spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "z")], "doc_id long, text string"), brute.path(brute.TOKENIZER)).collect()
    assert len(twice) == 3


def test_vector_limits_hold_together(spark):
    rng = np.random.default_rng(6)
    sizes = np.column_stack([rng.integers(1, 1000, 400), np.ones(400, int), rng.integers(0, 600, 400)])
    limits = np.array([2000, 9, 1000])
    bins, places = vector_pack.pack_vectors(sizes.astype(float), limits.astype(float))
    for b in set(bins.tolist()):
        assert (sizes[bins == b].sum(0) <= limits).all()
        assert sorted(places[bins == b].tolist()) == list(range((bins == b).sum()))
    lower = max(-(-sizes[:, k].sum() // limits[k]) for k in range(3))
    assert len(set(bins.tolist())) <= 1.15 * lower + 1
    # instruction examples through Spark, with an example that is too large
    rows = spark.createDataFrame([(i, *map(int, s)) for i, s in enumerate(sizes)], "rid long, tokens long, segments long, loss long")
    got = vector_pack.pack_examples(rows, (2000, 9, 1000), ("tokens", "segments", "loss")).collect()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    assert len(got) == 400 and all(sum(x.loss for x in v) <= 1000 and len(v) <= 9 for v in by.values())
    with pytest.raises(Exception, match="above a limit"):
        vector_pack.pack_examples(rows, (10, 9, 1000), ("tokens", "segments", "loss")).collect()


def sp_texts():
    return [t or "" for t in TEXTS] + ["  lead", "trail  ", "▁x ▁", "aaaa" * 100, "x" * 3000 + " y", "ab" * 2000] + random_texts(300, 7) + [
        "".join(random.Random(i).choice("abcdefgh .▁!") for _ in range(400)) for i in range(50)]


def test_sentencepiece_equals_library(monkeypatch):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=brute.path(brute.PIECES))
    coder = sp_suffix.Encoder(brute.path(brute.PIECES))
    texts = sp_texts()
    for t, ids in zip(texts, coder(texts)):
        want = sp.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == want, t
        assert coder.decode(ids) == sp.decode(want)
    monkeypatch.setattr(sp_suffix.Encoder, "LIMIT", 40)
    small = sp_suffix.Encoder(brute.path(brute.PIECES))
    for i in range(0, 100, 10):
        for t, ids in zip(texts[i : i + 10], small(texts[i : i + 10])):
            assert np.frombuffer(ids, "<u4").tolist() == sp.encode(t)


def test_suffix_array_is_sorted():
    text = np.array([5, 2, 3, 2, 3, 2, 0, 5, 2], np.uint16)
    sa = sp_suffix.suffix_array(text, 16).tolist()
    assert sa == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_sentencepiece_table(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=brute.path(brute.PIECES))
    rows = list(enumerate(TEXTS)) + [(None, "x"), (0, "x")]
    df = spark.createDataFrame([(d, t, "c") for d, t in rows], "doc_id long, text string, ids string")
    got = sp_suffix.encode_table(df, brute.path(brute.PIECES), with_ids=True).collect()
    want = sorted((-1 if d is None else d, sp.encode(t or "")) for d, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, list(r.ids)) for r in got) == want
    assert all(r.round_trip for r in got)
    assert sp_suffix.encode_table(spark.createDataFrame([], "doc_id long, text string"), brute.path(brute.PIECES)).collect() == []


def test_other_tokenizer_files_are_encoded_whole():
    """A file that promises no words gives the library's ids; the word file is recognised."""
    from tokenizers import Tokenizer

    from histlens.llm.word_ids import WordIds

    path = brute.path("byte_bpe_50k.json")
    plain, ours = Tokenizer.from_file(path), WordIds(path)
    assert not ours.by_words and WordIds(brute.path(brute.TOKENIZER)).by_words
    texts = ["", "Two  Words, and\nlines.", "Ärger <|endoftext|> 12", *[t or "" for t in TEXTS]]
    assert [np.frombuffer(x, "<u4").tolist() for x in ours([t.encode() for t in texts])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_unigram_scores_are_refused():
    from histlens.llm.sp_suffix import merges_by_rank

    assert merges_by_rank(np.array([0.0, -1.0, -31000.0])) and not merges_by_rank(np.array([0.0, -2.71, -9.13])) and not merges_by_rank(np.array([]))
