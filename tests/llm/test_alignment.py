"""Cross-tokenizer alignment against whole-text encoding with the libraries."""

import hashlib
import random
from collections import Counter

import brute
import pytest

from histlens.llm import token_align

A, B = "byte_bpe_50k.json", brute.PIECES
ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "a\nb", "a \n b", "a\n\nb", "\n", "\n\n", "\na", "a\n", "a\tb\t\tc", "a\r\nb", "x;\r\n}\r\r y\r", "a\r", "a \rb\n\rc","\x0b\x0c", "x\x00y", "\x1c \x1d!\x1e a",
       "it's we'll 'tis", "don't\nstop's", "<|endoftext|> <s> </s> <unk> <0x41>", "▁a", "a▁b", "100,000.50 $#!", "Straße ÄÖÜ", "日本語　テキスト", "مرحبا بالعالم", "😀 😀😀\n😀",
       "é é ﬁ Ａ", "a b c   d　e", "word " * 50, "\u0085next", "tab\t\nline \t x", "a" * 700, "ab " * 300 + "\n" * 5, "​zero﻿", "end.\nStart", "end.\n Start", "  two\n  lines  "]


def library():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(brute.path(A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=brute.path(B))


def letters():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {chr(b): b for b in own}, 0
    for b in range(256):
        if b not in own:
            out[chr(256 + n)] = b
            n += 1
    return out


def groups(text, a, b, letter):
    """[(A ids, B ids)] of a text by whole encodings and byte offsets."""
    if not text:
        return []
    want = (" " + text).encode()
    ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    ba = [bytes(letter[c] for c in a.id_to_token(i)) for i in ia]
    bb = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
    if b"".join(ba) != want or b"".join(bb) != want:
        return []
    out, x, y, i, j = [], 0, 0, 0, 0
    while i < len(ia):
        p, q = [], []
        while not p or x != y:
            if x <= y:
                x, p, i = x + len(ba[i]), [*p, ia[i]], i + 1
            else:
                y, q, j = y + len(bb[j]), [*q, ib[j]], j + 1
        out.append((p, q))
    return out


def plain(rows):
    a, b, letter = *library(), letters()
    cut = [groups(t, a, b, letter) for _, t in rows]
    n = Counter((p[-1], q[-1]) for g in cut for p, q in g)
    most = Counter()
    for (_, y), k in n.items():
        most[y] = max(most[y], k)
    out = []
    for (d, _), g in zip(rows, cut):
        s = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)
        links = [(p[-1], q[-1]) for p, q in g]
        out.append((d, sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g), len(g), sum(n[x] == most[x[1]] for x in links), sum(n[x] for x in links),
                    hashlib.sha256(s.encode()).hexdigest() if s else ""))
    return out, n


COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
key = lambda r: tuple((x is None, x) for x in r)


def aligned(df, **kw):
    return token_align.align(df, brute.path(A), brute.path(B), **kw)


def random_texts(n, seed):
    rng = random.Random(seed)
    alphabet = "aeiou tTnN'’.,!?-_ \n\t\r    \x1c▁é日😀0129#<|>\x00"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_alignment_equals_whole_encodings(spark):
    rows = list(enumerate(ODD)) + list(enumerate(random_texts(400, 4), 1000)) + [(None, "the end"), (7, "the end"), (7, "the end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got, pairs = aligned(docs)
    want, n = plain(rows)
    assert sorted([tuple(r[c] for c in COLS) for r in got.collect()], key=key) == sorted(want, key=key)
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(n)


def test_query_equals_whole_encodings(spark):
    from histlens.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.queries()["op12_alignment"](spark, sf)
    assert got.columns == COLS
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain(rows)[0])


def test_a_unit_is_forgotten_and_whole_texts_are_units(monkeypatch):
    """Small memories, and tokenizers that promise no cuts, give the same."""
    texts = [t for t in ODD if t] + random_texts(150, 9)
    first = token_align.Aligner(brute.path(A), brute.path(B))
    assert first.t.cuts and first.t.units(" a b\nc\r\nd  e\n f ") == [" a", " b", "\n", "c\r\nd", "  e", "\n f", " "]
    want = first(texts)
    monkeypatch.setattr(token_align.Aligner, "LIMIT", 10)
    small = token_align.Aligner(brute.path(A), brute.path(B))
    assert [small([t])[0] for t in texts] == want
    small.t.units, small.t.cuts = lambda text: [text], False
    small.now, small.old = {}, {}
    assert small(texts) == want


def test_pair_numbers_hold_all_endings():
    p = token_align.Pairs([b"a", b"ba", b"c", None, b"xc"], [b"a", b"a", b"cba", None, b"c"])
    got = set(zip(p.a.tolist(), p.b.tolist()))
    assert {(0, 0), (0, 1), (1, 0), (1, 1), (1, 2), (0, 2), (2, 4), (4, 4)} <= got
    assert [p.number(p.a[[k]], p.b[[k]])[0] for k in range(p.size) if p.b[k] >= 0] == [k for k in range(p.size) if p.b[k] >= 0]


def test_nothing_extra_columns_and_groups(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    got, pairs = aligned(empty)
    assert got.collect() == [] and pairs.collect() == []
    docs = spark.createDataFrame([(1, "one two", 5, "x"), (2, None, None, None)], "doc_id long, text string, a int, _links string")
    out = {r.doc_id: r for r in aligned(docs, keep=("doc_id", "a", "_links"), with_groups=True)[0].collect()}
    assert out[1].a == 5 and out[1]["_links"] == "x" and hashlib.sha256(out[1].groups.encode()).hexdigest() == out[1].groups_sha256
    assert (out[2].n_a, out[2].groups, out[2].groups_sha256) == (0, "", "")
    with pytest.raises(ValueError, match="n_a"):
        aligned(docs.withColumnRenamed("a", "n_a"), keep=("n_a",))


def test_later_stages_free_the_aligner():
    """A worker that counts links no longer holds what it has learned to align."""
    import sys
    from types import SimpleNamespace

    from histlens.llm import token_align

    class Links:
        def __getattr__(self, name):
            return lambda *a: self

        def mapInArrow(self, run, schema):
            self.run = run
            return self
    links = Links()
    token_align.pair_counts(links, SimpleNamespace(value=token_align.Pairs([b"a"], [b"a"])))
    sys._histlens_llm_kept = {"align": 1}
    assert all(b.num_rows == 0 for b in links.run([]))
    assert not hasattr(sys, "_histlens_llm_kept")
