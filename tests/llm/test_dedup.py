"""Exact dedup and the n-gram join against plain versions, and their edge cases."""

import hashlib
import random
import time

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from histlens.llm import block_dedup, ngram_join
from histlens.llm.queries import op1_ngram_join
from histlens.llm.shingles import Shingler

LONG = " ".join(f"Word{i}" for i in range(9000))
TEXTS = [
    (1, "The Same text"), (2, "the same TEXT"), (3, "the same text "), (4, None), (5, ""), (6, " "), (7, LONG), (8, LONG.lower()),
    (9, LONG + "x"), (10, "Ärger É"), (11, "ärger é"), (12, "Ärger É"), (13, "a" * 4096), (14, "a" * 4096 + "b"), (15, "a" * 8192),
    (16, "A" * 8192), (17, "a" * 12288), (18, "😀" * 5000), (19, "😀" * 5000), (20, "one"), (None, "one"), (20, "one"), (21, "line\nbreak\x00"),
]
SCHEMA = "doc_id long, text string"


def numbered(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema + ", rid long")


def groups(rows):
    """{rid: (keep_id, size, kept, sha)} by plain grouping."""
    by = {}
    for rid, (d, t) in enumerate(rows):
        by.setdefault(brute.ascii_lower(t or ""), []).append((-1 if d is None else d, rid, d))
    out = {}
    for t, g in by.items():
        top = max(g)
        for _, rid, _ in g:
            out[rid] = (top[2], len(g), rid == top[1], hashlib.sha256(t.encode()).hexdigest())
    return out


@pytest.mark.parametrize("block", [4096, 7])
def test_exact_groups_equal_plain_grouping(spark, block):
    got = block_dedup.exact_groups(numbered(spark, TEXTS), block_chars=block).collect()
    assert {r.rid: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == groups(TEXTS)
    assert len(got) == len(TEXTS)


def test_hot_blocks_and_pairs(spark):
    """Half of all rows are one text of several blocks; others share only some blocks or their order."""
    rng = random.Random(3)
    base = "".join(rng.choice("abcd") for _ in range(50))
    rows = [(i, base) for i in range(200)] + [(200 + i, base[:30] + "".join(rng.choice("abcd") for _ in range(rng.randint(0, 30)))) for i in range(200)]
    rows += [(400, base[10:20] + base[:10] + base[20:]), (401, base + "a"), (402, base[:-1])]
    got = block_dedup.exact_groups(numbered(spark, rows).repartition(9), block_chars=10).collect()
    assert {r.rid: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == groups(rows)


def test_exact_groups_of_nothing_and_with_other_columns(spark):
    assert block_dedup.exact_groups(spark.createDataFrame([], SCHEMA + ", rid long")).collect() == []
    rows = spark.createDataFrame([(1, "x", 0, "n", "p", 7), (2, "X", 1, "n", "p", 8)], SCHEMA + ", rid long, name string, block string, pos int")
    assert sorted(r.kept for r in block_dedup.exact_groups(rows).collect()) == [False, True]


def corpus(seed, families=12, copies=8):
    """Families of edited copies, a passage that unrelated texts share, and odd rows."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randint(0, 4000)
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(families):
        base = [word() for _ in range(rng.randint(30, 300))]
        for _ in range(rng.randint(1, copies)):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                t[rng.randrange(len(t))] = word()
            rows.append(" ".join(t))
    rows += [" ".join([word() for _ in range(30)] + passage + [word() for _ in range(20)]) for _ in range(25)]
    rows += [None, "", " \t\n", "one two", "ONE  two", "one two three four five", "one two three four five six", "x", "X ", LONG, LONG + " more"]
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("seed,common_from", [(1, 64), (2, 4), (3, 2)])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, seed, common_from):
    """Also with low bounds for common shingles, so that stars and open lists are used."""
    monkeypatch.setattr(ngram_join, "COMMON_FROM", common_from)
    rows = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(numbered(spark, rows)).collect()}
    assert got == brute.near_components(rows)


def test_chain_of_links_is_one_component(spark):
    """Neighbours link, ends do not: the component is the whole chain."""
    words = [f"v{i}" for i in range(400)]
    rows = [(50 - k, " ".join(words[6 * k : 6 * k + 100])) for k in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(numbered(spark, rows)).collect()}
    assert got == brute.near_components(rows) and {c for _, c in got.values()} == {21}


def brute_open_pairs(posts):
    out = set()
    for t, g, n, p, lo, hi, _ in posts:
        for u, h, m, q, lo2, hi2, _ in posts:
            if t == u and g < h and not lo == hi == lo2 == hi2 and 100 * min(n, m) >= 80 * max(n, m) and 180 * min(n - p, m - q) >= 80 * (n + m):
                out.add((g, h))
    return out


POSTS = "token long, gid long, size int, pos int, lo long, hi long, main long"


def test_open_pairs_equal_all_pairs(spark):
    rng = random.Random(4)
    posts = []
    for g in range(400):
        n, lo = rng.choice([1, 2, 5, 9, 10, 40, 50, 77, 100, 101, 124, 125, 5000]), rng.choice([1, 1, 1, 2, 3, g])
        hi = max(lo, rng.choice([lo, lo, lo, 9]))
        posts += [(t, g, n, rng.randrange(n - -(-80 * n // 100) + 1), lo, hi, [1, 2, None][t]) for t in range(3) if rng.random() < 0.7]
    got = [(r.g, r.h) for r in ngram_join.open_pairs(spark.createDataFrame(posts, POSTS)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_open_pairs(posts)


def test_family_just_under_the_threshold_is_not_paired(spark):
    """20,000 sets of similarity 0.7 share a shingle behind their own ones: none looks for a partner.  As many
    copies in one component beside one other group: only pairs with that group."""
    far = spark.range(20_000).selectExpr("0L AS token", "id AS gid", "1000 AS size", "176 AS pos", "id AS lo", "id AS hi", "7L AS main")
    assert ngram_join.open_pairs(far).count() == 0
    near = spark.range(20_000).selectExpr("0L AS token", "id AS gid", "1000 AS size", "0 AS pos", "IF(id = 5, 5L, 0L) AS lo", "IF(id = 5, 5L, 0L) AS hi", "0L AS main")
    assert ngram_join.open_pairs(near).count() == 19_999


def test_near_duplicates_edge_rows(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "A B C D E F"), (None, None), (7, "")]
    got = ngram_join.near_duplicates(numbered(spark, rows)).collect()
    by = {r.rid: (r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got}
    assert by == {0: (5, 2, 5, True), 1: (5, 2, 5, False), 2: (None, 2, 5, False), 3: (None, 0, None, True), 4: (7, 0, 7, True)}
    assert ngram_join.near_duplicates(spark.createDataFrame([], SCHEMA + ", rid long")).collect() == []
    extra = numbered(spark, [(1, "a b", "q", 1), (2, "a b", "r", 2)], SCHEMA + ", token string, size int")
    assert [r.component_id for r in ngram_join.near_duplicates(extra).collect()] == [1, 1]


def test_shingle_words(spark):
    s = Shingler()
    same = lambda a, b: s(a.encode()).tolist() == s(b.encode()).tolist()
    assert same("A\tb\x0bc\x0cd\re", "a b c d e") and not same("a b c d\xa0e", "a b c d e") and not same("É", "é")
    for t in (LONG, "a b", "a b c d e f g a b c d e f g"):
        assert len(s(t.encode())) == len(brute.shingle_set(t))


def test_op1_on_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op1_ngram_join(spark, sf).collect()}
    assert got == brute.near_components(rows)


@pytest.mark.parametrize("name", ["op1_ngram_join", "op9_exact_dedup", "op11_collocations", "op13_quality_rules"])
def test_queries_equal_their_sql(spark, name):
    from compare import compare, duck

    from histlens.llm import queries

    sf = "/root/testdata/sf0.001"
    ok, msg = compare(queries.queries()[name](spark, sf), duck(sf), queries.oracle_sql()[name])
    assert ok, msg


def test_dedup_is_native(spark):
    df = block_dedup.exact_groups(numbered(spark, TEXTS[:5]))
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.fixture
def shifting_cores(spark, monkeypatch, tmp_path):
    """A table in many files, and splits that differ from one scan to the next."""
    from histlens.llm.common import Stages

    rows = [(i, f"text {i % 700} of a document with more words in it {i % 700}") for i in range(2000)] + [(5, "again"), (5, "again"), (None, "again")]
    spark.createDataFrame(rows, SCHEMA).repartition(24).write.parquet(str(tmp_path / "docs"))
    write, turn = Stages.write, iter(range(10**6))

    def shifted(self, df, name):
        out = write(self, df, name)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", [2, 7, 1, 13][next(turn) % 4])
        return out
    monkeypatch.setattr(Stages, "write", shifted)
    yield spark.read.parquet(str(tmp_path / "docs")), rows
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_results_do_not_depend_on_file_splits(spark, shifting_cores):
    import corpus_pipeline as P

    docs, rows = shifting_cores
    got = block_dedup.exact_groups(block_dedup.with_rid(docs, "doc_id", "text"), block_chars=16).collect()
    want = groups(rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.group_size, r.text_sha256) for r in got) == sorted(
        (-1 if d is None else d, *want[i][1:2], want[i][3]) for i, (d, _) in enumerate(rows))
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", 8)
    kept = P.exact_dedup(spark, docs, "")
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", 3)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({k for k, *_ in want.values()})
    near = P.near_dedup(spark, docs, "")
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", 5)
    comp = brute.near_components([(i, t) for i, (_, t) in enumerate(rows[:700])])
    assert len(near.collect()) == len({c for _, c in comp.values()}) + 1


def test_lists_of_a_range_equal_all_pairs():
    """Stars, pairs of short lists and postings of long ones name every pair within the bounds, packed and unpacked again."""
    rng = random.Random(8)
    sets = {}
    for g in range(300):
        tokens = sorted(rng.sample(range(60), rng.randint(1, 3)) + rng.sample(range(100, 600), 5))
        sets[rng.getrandbits(60)] = (rng.choice([50, 52, 60, 100, 120]), rng.randint(0, 3), tokens)
    blobs, ids = [], list(sets)
    for a in range(0, len(ids), 70):
        own = ids[max(0, a - 5) : a + 70]                   # some groups are in two blobs
        blobs.append(ngram_join._pack_posts(np.array([t for g in own for t in sets[g][2]], np.uint64), np.array(own), np.array([sets[g][0] for g in own]),
                                            np.array([sets[g][1] for g in own]), np.array([len(sets[g][2]) for g in own])))
    got = ngram_join._merge_posts(pa.table({"blob": blobs})).to_pylist()
    lists = {}
    for g in ids:
        for i, t in enumerate(sets[g][2]):
            lists.setdefault(t, []).append((g, sets[g][0], sets[g][1] + i))
    star, more, posts = set(), set(), set()
    for t, rows in lists.items():
        rows.sort()
        for j, (h, m, q) in enumerate(rows):
            for i, (g, n, p) in enumerate(rows[:j]):
                if 100 * min(n, m) >= 80 * max(n, m) and 180 * min(n - p, m - q) >= 80 * (n + m) and (i == 0 or len(rows) <= ngram_join.SHORT):
                    (more if i else star).add((g, h))
        if len(rows) > ngram_join.SHORT:
            posts |= {(t, g, n, p) for g, n, p in rows[1:]}
    assert posts and star and more
    assert sorted((r["g"], r["h"]) for r in got if r["kind"] == 0) == sorted(star)
    assert sorted((r["g"], r["h"]) for r in got if r["kind"] == 1) == sorted(more)
    assert sorted((r["token"], r["g"], r["size"], r["pos"]) for r in got if r["kind"] == 2) == sorted(posts)


def test_whole_sets_travel_only_for_likely_pairs(spark, monkeypatch):
    """Of large sets that share a shingle but little more nothing is read again; a large near copy is found."""
    rng = random.Random(9)
    texts = [" ".join(["same opening of five words", *("w%d" % rng.randrange(10**6) for _ in range(3000))]) for _ in range(12)]
    words = texts[0].split()
    texts.append(" ".join(words[:2900] + ["other"] * 20))
    seen, write = {}, ngram_join.Stages.write

    def counted(self, df, name):
        out = write(self, df, name)
        seen[name] = out.count()
        return out
    monkeypatch.setattr(ngram_join.Stages, "write", counted)
    rows = list(enumerate(texts, 1))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(numbered(spark, rows)).collect()}
    assert got == brute.near_components(rows) and got[13][1] == 1
    assert max(seen.get("near_star", 0), seen.get("near_rest", 0)) <= 1


def test_stage_tables_leave_no_shuffle_files(spark):
    """What a stored stage has shuffled is deleted when it is written, and the setting is as before."""
    from histlens.llm.common import Stages
    from histlens.session import FREE_SHUFFLES

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}
    before, had = spark.conf.get(FREE_SHUFFLES, None), shuffles()
    Stages(spark, "test").write(spark.range(1000).groupBy((F.col("id") % 5).alias("k")).count(), "kept")
    until = time.time() + 10
    while shuffles() - had and time.time() < until:         # they are deleted in the background
        time.sleep(0.1)
    assert not shuffles() - had and spark.conf.get(FREE_SHUFFLES, None) == before
