"""D1 against a line-by-line implementation of the contract."""

import pytest
from pyspark.sql import functions as F

from histlens.sources.repair import document_lines, repair_documents, repair_records


def brute(lines):
    """Sequential reference: (start index, text, status, reason, id, what, when, who)."""
    out, buf, start = [], "", None
    for i, raw in enumerate(lines):
        line = raw.replace("\r", "").replace("\t", "")
        if line.rstrip().endswith(";"):
            line = line.replace(",", ";")
        text = buf + line
        s0 = start if buf else i
        n = text.count(",")
        if n == 1:
            buf, start = text, s0
            continue
        buf, start = "", None
        if n >= 3:
            rid, rest = text.split(",", 1)
            rest2, who = rest.rsplit(",", 1)
            rest3, when = rest2.rsplit(",", 1)
            out.append((s0, text, "ok", None, rid, rest3.replace(",", ";"), when, who))
        else:
            out.append((s0, text, "reject", {0: "no comma", 2: "two commas"}[n], None, None, None, None))
    if buf:
        out.append((start, buf, "reject", "unfinished", None, None, None, None))
    return out


def run(spark, lines, block=2):
    df = spark.createDataFrame([(0, i // block, i, l) for i, l in enumerate(lines)], "s INT, b INT, ln INT, line STRING")
    res = repair_records(df, ["s"], "b", ["ln"]).collect()
    return sorted((r["start"]["o0"], r["text"], r["status"], r["reason"], r["id"], r["what"], r["when"], r["who"]) for r in res)


CASES = [
    (["7,a,b,c,100,9"], [("7", "a;b;c", "100", "9")]),
    (["7,start", "more,100,9"], [("7", "startmore", "100", "9")]),
    (["7,x = 1,y;", " end,100,9"], []),
    (["7,head", "f(a,b);", " tail,100,9"], [("7", "headf(a;b); tail", "100", "9")]),
    (["abc"], []),
    (["1,2,3"], []),
    (["7,open"], []),
]


@pytest.mark.parametrize("lines,want", CASES)
def test_fixture_cases(spark, lines, want):
    got = run(spark, lines)
    assert [(r[4], r[5], r[6], r[7]) for r in got if r[2] == "ok"] == want
    assert got == sorted(brute(lines))


@pytest.mark.parametrize("block", [1, 2, 3, 50])
def test_random_streams_all_block_sizes(spark, block):
    import random
    rnd = random.Random(block)
    pieces = ["a", "b,c", ",", "x;", "y,z;", "", "1,2,3,4", "q,", "\tt,u"]
    lines = [rnd.choice(pieces) + rnd.choice(pieces) for _ in range(300)]
    assert run(spark, lines, block) == sorted(brute(lines))


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lines = [r["line"] for r in document_lines(docs, 16).orderBy("doc_id", "ln").collect()]
    want = brute(lines)
    got = repair_documents(docs, 16).collect()
    assert len(got) == len(want)
    assert sorted((r["text"], r["status"], r["id"], r["what"], r["when"], r["who"]) for r in got) == \
        sorted((w[1], w[2], w[4], w[5], w[6], w[7]) for w in want)


def test_files_split_into_many_blocks(spark, tmp_path):
    """Line order across file splits: _metadata.file_block_start + read order."""
    import random

    from histlens.sources.repair import repair_files
    rnd = random.Random(3)
    pieces = ["a", "b,c", ",", "x;", "y,z;", "1,2,3,4", "q,", "word " * 5]
    files = {}
    for k in range(2):
        lines = [rnd.choice(pieces) + rnd.choice(pieces) for _ in range(4000)]
        p = tmp_path / f"log{k}.csv"
        p.write_text("id,what,when,who\n" + "\n".join(lines) + "\n")
        files[str(p)] = ["id,what,when,who"] + lines
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        out = repair_files(spark, str(tmp_path))
        got = out.collect()
        n_blocks = out.select("start.b").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert n_blocks > 10
    want = []
    for path, lines in files.items():
        want += [(w[1], w[2], w[4], w[5], w[6], w[7]) for w in brute(lines)]
    assert sorted((r["text"], r["status"], r["id"], r["what"], r["when"], r["who"]) for r in got) == sorted(want)


def test_repair_then_load_typed_log(spark, tmp_path):
    from histlens.sources.repair import load_repaired
    p = tmp_path / "cc.csv"
    p.write_text("id,what,when,who\n7,a,b,c,100,9\n8,start\nmore,200,10\nabc\n9,x,300,11\n")
    got = sorted(tuple(r) for r in load_repaired(spark, str(tmp_path))[0].collect())
    assert got == [(7, "a;b;c", 100, 9), (8, "startmore", 200, 10), (9, "x", 300, 11)]


def test_records_of_any_length(spark):
    """A record over many blocks has its line-by-line result; one beyond a value's room keeps id, when and who, and its pieces."""
    from histlens.sources.repair import record_pieces

    lines = ["0,x,1,2", "1,open " + "y" * 400, *["z, " + "x" * 500 + ";"] * 4, "no commas here" * 90, "end, with more,2,3", "5,a,b,c", "8,tail"]
    df = spark.createDataFrame([(0, i // 2, i, t) for i, t in enumerate(lines)], "s INT, b INT, ln INT, line STRING")
    key = lambda r: (r["start"]["o0"], r["text"], r["status"], r["reason"], r["id"], r["what"], r["when"], r["who"])
    assert sorted(map(key, repair_records(df, ["s"], "b", ["ln"]).collect())) == sorted(brute(lines))
    short = {r.start.o0: r for r in repair_records(df, ["s"], "b", ["ln"], max_value=1000).collect()}
    want = {w[0]: w for w in brute(lines)}
    long = short[1]
    assert (long.status, long.id, long.when, long.who, long.text, long.what, long.n_lines) == ("ok", "1", "2", "3", None, None, 7)
    assert all(key(short[k]) == want[k] for k in want if k != 1)
    pieces = record_pieces(df, ["s"], "b", ["ln"]).filter("start.o0 = 1").orderBy("piece").collect()
    assert len(pieces) == 4 and "".join(r.text for r in pieces) == want[1][1]


def test_blocks_of_a_split_are_short(spark, tmp_path, monkeypatch):
    """One file in one split is many blocks, and its records are those of the whole file."""
    import random

    from histlens.sources import repair
    monkeypatch.setattr(repair, "BLOCK_LINES", 64)
    rnd = random.Random(8)
    lines = [rnd.choice(["a", "b,c", ",", "x;", "1,2,3,4", "q,"]) + rnd.choice(["", "z,", "w"]) for _ in range(1500)]
    (tmp_path / "one.csv").write_text("\n".join(lines) + "\n")
    out = repair.repair_files(spark, str(tmp_path))
    got = out.collect()
    assert sorted((r["text"], r["status"], r["id"], r["what"], r["when"], r["who"]) for r in got) == sorted((w[1], w[2], w[4], w[5], w[6], w[7]) for w in brute(lines))
    assert out.select("start.b").distinct().count() > 10
