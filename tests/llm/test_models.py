"""Quality, language and url models: held-out accuracy, plain versions, edge cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from histlens.llm import quality_bt, url_filter, zstd_lang
from histlens.llm.queries import URL_RULES, op5_url_filter, op7_quality, op10_language

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n"), (4, "12 34 !!"), (5, "a"), (6, "word " * 50_000), (7, "é"), (None, "the text"), (7, "é")]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_language_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op10_language(spark, SF).collect()
    assert len(got) == len(docs) and all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)
    test = [r for r in got if r.held_out and docs[r.doc_id].lang is not None]
    assert len(test) > 100 and np.mean([r.lang_pred == docs[r.doc_id].lang for r in test]) > 0.95
    assert {r.lang_pred for r in got} <= {d.lang for d in docs.values()} | {"und"}


def test_language_learns_only_from_training_rows(spark):
    """The labels of held-out rows do not matter."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spoiled = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit("xx")).otherwise(F.col("lang")))
    assert zstd_lang.fit(docs) == zstd_lang.fit(spoiled)


def test_language_smallest_size_wins():
    """The classifier is the plain rule: the smallest sum of compressed pieces."""
    import zstandard

    model = [("aa", b"lorem ipsum dolor sit amet " * 20), ("bb", b"the quick brown fox jumps over " * 20)]
    c = zstd_lang.Classifier(model)
    for text in (b"the quick brown fox", b"LOREM ipsum dolor " * 200, b"zzz"):
        sizes = {}
        for lang, content in model:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            z = zstandard.ZstdCompressor(level=zstd_lang.LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)
            low = text.lower()
            sizes[lang] = sum(len(z.compress(low[i : i + zstd_lang.PIECE])) for i in range(0, len(low), zstd_lang.PIECE))
        assert c(text)[0] == min(sizes, key=lambda k: (sizes[k], k))
    assert c(b"")[0] == c(b"123 \xe2\x80\x93")[0] == "und" and zstd_lang.Classifier([])(b"abc")[0] == "und"


def test_language_edge_rows(spark):
    df = spark.createDataFrame([(d, t, "n") for d, t in ODD], "doc_id long, text string, score string")
    model = [("aa", b"lorem ipsum " * 50), ("bb", b"word other " * 50)]
    got = zstd_lang.identify(df, model, keep=("doc_id",)).collect()
    assert len(got) == len(ODD)
    assert [r.lang_pred for r in got[:4]] == ["und"] * 4 and all(r.rejected and r.score == 0 for r in got[:4])
    assert got[5].lang_pred == "bb" and not got[5].rejected
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert zstd_lang.fit(empty) == [] and zstd_lang.identify(empty, []).collect() == []
    nulls = spark.createDataFrame([(1, "x", None), (2, None, "aa")], "doc_id long, text string, lang string")
    assert zstd_lang.fit(nulls) == []


def test_quality_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = op7_quality(spark, SF).collect()
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    test = [r for r in got if r.held_out and r.doc_id in labels]
    assert len(test) > 40 and np.mean([r.predicted == labels[r.doc_id] for r in test]) > 0.93


def test_quality_ignores_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    spoiled = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality_bt.fit(docs, labels), quality_bt.fit(docs, spoiled)
    assert np.allclose(a.weights, b.weights) and a.cut == b.cut


def test_pairwise_ranking_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, quality_bt._SIZE))
    good = x[:, 3] + 0.1 * rng.normal(size=400) > 0.5
    m = quality_bt.fit_pairs(x[good], x[~good], (~good).mean())
    s = quality_bt.to_score(m, quality_bt.strength(m, x))
    assert np.mean((s >= quality_bt.DECISION) == good) > 0.9
    # the decision value is the quantile that splits as the labels do
    assert abs((s < quality_bt.DECISION).mean() - (~good).mean()) < 0.02
    for none in (quality_bt.fit_pairs(x, x[:0], 0.0), quality_bt.fit_pairs(x[:0], x[:0], 0.0)):
        assert np.allclose(quality_bt.to_score(none, quality_bt.strength(none, x)), 0.5)


def test_quality_edge_rows(spark):
    df = spark.createDataFrame([(d, t, "n") for d, t in ODD], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 0), (5, 1), (6, 1), (2, 0), (None, 1), (3, None), (5, 1)], "doc_id long, quality int")
    got = quality_bt.score(df, quality_bt.fit(df, labels), keep=("doc_id",)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert got[0].score == got[1].score and got[6].score == got[8].score
    empty = spark.createDataFrame([], "doc_id long, text string")
    none = quality_bt.fit(empty, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality_bt.score(empty, none).collect() == []


URLS = [
    "http://a.example.org/es/5", "http://example.org/es", "https://Example.ORG/en/16", "http://example.org/en/2?x=/en/1", "http://b.com/fr/1#t",
    "http://com/de/", "http://xcom/de/", "http://b.com/de", "http://b.net/en/", "http://b.org", "http://b.org?x/y", "b.org/x", None, "", "://", "http://",
    "http://b.com/de/x://y/z", "HTTP://B.COM/de/É", "http://ÀB.org/\nx", "http://u:p@b.org:80/x", "http://b.org/x", "http://b.org/x",
]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0] or [len(rest)])
    tail = rest[cut:]
    end = min([i for i in (tail.find(c) for c in "?#") if i >= 0] or [len(tail)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, tail[:end]


def plain_rule(host, path, rules):
    fits = [(len(text), text, v) for v, text in rules
            if (host == text.split("/", 1)[0] or host.endswith("." + text.split("/", 1)[0])) and path.startswith("/" + text.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


def check_urls(rows, urls, rules):
    """Parts, rules and verdicts by plain Python; the model again from its sample."""
    decided = {(*plain_parts(u), plain_rule(*plain_parts(u), rules)[1]) for u in urls.values()}
    known = sorted((k for k in decided if k[2]), key=lambda k: (k[2], k))
    model = url_filter.fit(known)
    for r in rows:
        u = urls[r.page_id]
        host, path = plain_parts(u)
        rule, verdict = plain_rule(host, path, rules)
        assert (r.host, r.path, r.rule) == (host, path, rule), u
        if rule:
            assert r.verdict == verdict
        else:
            p = model.probability(host, path)
            assert abs(p - 0.5) < 1e-6 or r.verdict == ("block" if p >= 0.5 else "allow")


def test_url_edge_rows(spark):
    df = spark.createDataFrame([(i, u, "n", "m") for i, u in enumerate(URLS)], "page_id long, url string, host string, verdict string")
    rows = url_filter.judge(df, URL_RULES).collect()
    assert len(rows) == len(URLS)
    check_urls(rows, dict(enumerate(URLS)), URL_RULES)
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string"), URL_RULES).collect() == []


def test_op5_on_given_table(spark):
    sf = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    rows = op5_url_filter(spark, sf).collect()
    assert len(rows) == len(urls)
    check_urls(rows, urls, URL_RULES)


def test_url_model_learns():
    """Held-out urls of a labelled table."""
    rng = np.random.default_rng(1)
    rows = []
    for k in range(600):
        bad = rng.random() < 0.4
        host = ("casino" if bad else "library") + str(rng.integers(100)) + rng.choice([".com", ".net"])
        rows.append((host, f"/{'win' if bad else 'read'}/{rng.integers(1000)}", "block" if bad else "allow"))
    m = url_filter.fit(rows[:400])
    assert np.mean([(m.probability(h, p) >= 0.5) == (v == "block") for h, p, v in rows[400:]]) > 0.97
    assert url_filter.fit([]).probability("x", "/") < 0.5 and url_filter.fit([("a", "/", "block")]).probability("x", "/") > 0.5


def test_quality_learns_from_every_pair():
    """The weights are the optimum over all pairs of a better and a worse document: the slope of their whole loss is nothing there."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, quality_bt._SIZE))
    good = x[:, 1] - x[:, 2] + rng.normal(size=900) > 0
    m = quality_bt.fit_pairs(x[good], x[~good], (~good).mean())
    z = np.clip((x - m.mean) / m.scale, -6, 6)
    lost = 1 / (1 + np.exp((z[good] @ m.weights)[:, None] - z[~good] @ m.weights))
    slope = lost.sum(0) @ z[~good] - lost.sum(1) @ z[good]
    assert np.abs(slope / lost.size + quality_bt.L2 * m.weights).max() < 2e-4
