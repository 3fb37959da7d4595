"""Collocations and quality rules against plain versions and SQL."""

import random
import re
from collections import Counter

import brute
import numpy as np
import pytest

from histlens.llm import collocations, line_rules


def plain_counts(rows, max_words=5):
    f, n = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.ascii_lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    return f, n


def plain_collocations(rows, min_count, top, max_words=5):
    f, n = plain_counts(rows, max_words)
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    out = {}
    for (lang, w), a in cand.items():
        if any(lang == x and len(v) > len(w) and b >= a and any(v[i : i + len(w)] == w for i in range(len(v))) for (x, v), b in cand.items()):
            continue
        s, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-s, -a, " ".join(w).encode(), a, left, right, n[lang], s))
    return sorted((lang, r, p.decode(), a, x, y, m, s) for lang, c in out.items() for r, (_, _, p, a, x, y, m, s) in enumerate(sorted(c)[:top], 1))


def prose(seed, docs=300):
    rng = random.Random(seed)
    phrases = [" ".join(rng.choice("ab cd ef gh ij kl Mn Öp".split()) for _ in range(rng.randint(2, 7))) for _ in range(12)]
    words = ["w%d" % i for i in range(40)] + ["É", "x\x1cy", " ", "a-b"]
    rows = []
    for i in range(docs):
        t = []
        for _ in range(rng.randint(0, 40)):
            t.append(rng.choice(phrases) if rng.random() < 0.3 else rng.choice(words))
            t.append(rng.choice([" ", "  ", "\t", ". ", ", ", "\n", "\r\n", "; ", " "]))
        rows.append((i, rng.choice(["en", "en", "de", None, ""]), "".join(t)))
    return rows + [(9, "en", None), (9, None, ""), (None, "en", "ab cd ef " * 200), (None, "en", "ab cd ef " * 200), (1, "xx", "?!.,"), (2, "yy", "only")]


@pytest.mark.parametrize("shard_words", [32_000_000, 150])
def test_collocations_equal_plain_counts(spark, monkeypatch, shard_words):
    rows = prose(3)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(6)
    got = collocations.collocations(docs, min_count=25, top=30, shard_words=shard_words).collect()
    assert sorted(tuple(r) for r in got) == plain_collocations(rows, 25, 30)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """With a filter so small that every phrase passes it, counts are still exact."""
    monkeypatch.setattr(collocations, "FILTER_BITS", 6)
    monkeypatch.setattr(collocations, "BLOCK", 17)
    monkeypatch.setattr(collocations, "BUCKETS", 8)
    monkeypatch.setattr(collocations, "COUNTED_WORDS", 10)
    monkeypatch.setattr(collocations.Numbers, "ROOM", 3)
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 200)
    monkeypatch.setattr(collocations, "HELD_PHRASES", 50)
    rows = prose(8, 120)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert sorted(tuple(r) for r in collocations.collocations(docs, min_count=12).collect()) == plain_collocations(rows, 12, 2000)


def test_mining_keeps_what_is_frequent_in_all(spark):
    """Whatever the shards, each globally frequent phrase is locally frequent in one of them."""
    f, n = plain_counts(prose(5))
    rows = prose(5)
    rng = random.Random(1)
    for _ in range(5):
        rng.shuffle(rows)
        found = set()
        for i in range(0, len(rows), 60):
            part_f, part_n = plain_counts(rows[i : i + 60])
            found |= {p for p, a in part_f.items() if a >= max(1, -(-30 * part_n[p[0]] // n[p[0]]))}
        assert {p for p, a in f.items() if a >= 30} <= found


def test_collocations_of_nothing_and_with_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert collocations.collocations(empty).collect() == []
    docs = spark.createDataFrame([(7, "ab cd", 1, 2, "k")] * 3, "f int, text string, a int, n int, phrase string").withColumn("lang", collocations.F.lit("en"))
    assert [tuple(r) for r in collocations.collocations(docs, min_count=3).collect()] == [("en", 1, "ab cd", 3, 3, 3, 6, 2000)]


def test_scores_beyond_64_bits(spark):
    """1000 a n of a large corpus: the same expression on numbers that no small table reaches."""
    a, n, x, y = 3 * 10**12, 9 * 10**14, 3 * 10**12 + 7, 4 * 10**12 + 1
    df = spark.createDataFrame([(a, n, x, y)], "a long, n long, l long, r long")
    assert df.select(collocations.score(*map(collocations.F.col, "anlr")).alias("s")).first().s == 1000 * a * n // (x * y)


# --- quality rules ---------------------------------------------------------------
def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def norm_lines(text):
    return [x for x in (tuple(re.findall(r"[^\x20\x09-\x0D]+", brute.ascii_lower(line))) for line in (text or "").split("\n")) if x]


def plain_judge(rows, min_docs, percent):
    hosts = {}
    for _, h, t in rows:
        hosts.setdefault(h or "", set()).add(tuple(norm_lines(t)))
    often = {h: {x for x, k in Counter(x for d in ds for x in set(d)).items() if k > min_docs and 100 * k > percent * len(ds)} for h, ds in hosts.items()}
    out = []
    for d, h, t in rows:
        b = plain_base(t)
        lost = sum(len(x) for x in norm_lines(t) if x in often[h or ""])
        failed = b[0] < 20 or 100 * b[4] > 30 * b[0]
        out.append((d, *b, lost, failed, not failed and not (lost and (100 * lost > 50 * b[0] or b[0] - lost < 20))))
    return out


def pages(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Alpha", "beta", "Γδ", "#x", "1%", "é", "the", "of", "x\x00y"]) + str(rng.randint(0, 30))
    shared = [" ".join(word() for _ in range(rng.randint(1, 12))) for _ in range(6)]
    rows = []
    for i in range(300):
        lines = [" ".join(word() for _ in range(rng.randint(0, 15))) for _ in range(rng.randint(1, 8))]
        lines += [rng.choice([s, s.upper(), "  " + s.replace(" ", "\t")]) for s in shared if rng.random() < 0.25]
        if rng.random() < 0.2:
            lines += [lines[0]] * rng.randint(1, 4)
        rng.shuffle(lines)
        rows.append((i, rng.choice(["a", "a", "a", "b", None, ""]), rng.choice(["\n", "\n\n", "\r\n"]).join(lines)))
    copy = "a line of its own that copies share\n" * 2 + " ".join(str(i) for i in range(30))
    return rows + [(1000 + i, "a", copy) for i in range(60)] + [(None, None, None), (5, "b", ""), (5, "b", ""), (6, "c", " \n\t\n"), (7, "c", "w " * 5000), (8, "c", "one two " * 9)]


COLS = ["doc_id", *line_rules.MEASURES, "n_lost_words", "base_failed", "kept"]
key = lambda r: tuple((x is None, x) for x in r)


def test_rules_equal_plain_version(spark):
    rows = pages(2)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    got = line_rules.judge(docs, min_docs=10, max_docs_percent=8)
    assert got.columns == COLS
    want = plain_judge(rows, 10, 8)
    assert sorted([tuple(r) for r in got.collect()], key=key) == sorted(want, key=key)
    assert any(not k and not f for *_, f, k in want) and sum(k for *_, k in want) > 100


def test_copies_are_one_document(spark):
    """A line of one text is no boilerplate, however many copies the text has."""
    docs = spark.createDataFrame([(i, "h", "copied line " * 15) for i in range(500)] + [(1000, "h", "other words here " * 3)], "doc_id long, source string, text string")
    assert line_rules.judge(docs).agg({"n_lost_words": "sum"}).first()[0] == 0


def test_clean_text(spark):
    rows = [(i, f"Cookie  NOTICE here\nown words {i} of the page\n\ncookie notice here\nend {i}") for i in range(40)] + [(99, None)]
    docs = spark.createDataFrame(rows, "kept_id long, text string").withColumn("source", line_rules.F.lit("h"))
    got = {r.kept_id: r for r in line_rules.judge(docs, keep=("kept_id",), with_text=True).collect()}
    assert got[3].clean_text == "own words 3 of the page\n\nend 3" and got[3].n_lost_words == 6 and got[99].clean_text is None


def test_rules_on_nothing_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert line_rules.judge(empty).collect() == [] and line_rules.judge(empty, with_text=True).collect() == []
    docs = spark.createDataFrame([(1, "s", "x y", 3, "l")], "doc_id long, source string, text string, _rid int, _lines string")
    assert line_rules.judge(docs, keep=("doc_id", "_rid", "_lines")).first()["_lines"] == "l"
    with pytest.raises(ValueError, match="kept"):
        line_rules.judge(docs.withColumnRenamed("_rid", "kept"), keep=("kept",))


def test_repeated_words_by_windows():
    rng = np.random.default_rng(0)
    for _ in range(30):
        sizes = rng.integers(0, 40, 6)
        doc = np.repeat(np.arange(6), sizes)
        ids = rng.integers(0, 2, len(doc))
        got = line_rules.repeated_words(ids, doc, 6, window=5)
        for d in range(6):
            w = ids[doc == d].tolist()
            c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
            assert got[d] == len({i + j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(5)})


def test_mining_holds_few_bytes_a_word(monkeypatch):
    """The phrases of a shard are found with about 28 bytes a word, not with the index arrays of a whole-shard np.unique."""
    import tracemalloc

    import numpy as np
    monkeypatch.setattr(collocations, "BLOCK", 1 << 14)
    rng = np.random.default_rng(2)
    ids = np.minimum(rng.zipf(1.4, 400_000), 3000).astype(np.int32)
    hashes = rng.integers(0, 2**63, 3001).astype(np.uint64)
    every = lambda hk: np.ones(len(hk), bool)
    tracemalloc.start()
    try:
        n = sum(int(c.sum()) for k, _, c, _ in collocations.levels(ids, hashes, 3, every, None, lambda c: c > 0) if k == 2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == len(ids) - 1 and peak < 50 * len(ids)
