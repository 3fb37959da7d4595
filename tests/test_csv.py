"""IO1/D2: CSV round trip of the logs; empty fields stay ''."""

import os
import tempfile

import pytest
from helpers import rows
from pyspark.sql import functions as F

from histlens.plans.registry import raw_tables
from histlens.sources.csv import load_csv_tables, load_history, load_reports, write_csv
from histlens.sources.repair import load_repaired
from histlens.sources.store import ingest

SF = "/root/testdata/sf0.001"


def test_csv_roundtrip_and_ingest(spark):
    raw = raw_tables(spark, SF)
    d = tempfile.mkdtemp(prefix="histlens-csv-")
    files = {}
    for a, h in raw.logs.items():
        files[a] = f"{a}.csv"
        write_csv(h.select("id", "what", F.col("ts").alias("when"), "who"), os.path.join(d, files[a]))
    write_csv(raw.reports, os.path.join(d, "reports.csv"))
    t, rejects = load_csv_tables(spark, d, files)
    assert rejects.count() == 0
    assert rows(t.h("assigned_to")) == rows(raw.h("assigned_to"))
    assert rows(t.reports) == rows(raw.reports)
    assert t.reports.filter("current_resolution = ''").count() == raw.reports.filter("current_resolution = ''").count() > 0
    # ingest twice: overwrite, not append
    t2 = ingest(t, os.path.join(d, "parquet"))
    t2 = ingest(t, os.path.join(d, "parquet"))
    assert t2.h("status").count() == raw.h("status").count()


def test_unquoted_empty_field_is_empty_text(spark):
    d = tempfile.mkdtemp(prefix="histlens-csv-")
    p = os.path.join(d, "r.csv")
    with open(p, "w") as f:
        f.write("id,current_resolution,current_status,opening,reporter\n1,,NEW,100,7\n2,FIXED,RESOLVED,x,8\n")
    r = {x["id"]: x for x in load_reports(spark, p)[0].collect()}
    assert r[1]["current_resolution"] == "" and r[2]["opening"] is None


def test_load_with_repair_for_broken_files(spark, tmp_path):
    from histlens.sources.csv import load_csv_tables
    raw = raw_tables(spark, SF)
    files = {}
    for a, h in raw.logs.items():
        files[a] = f"{a}.csv"
        write_csv(h.select("id", "what", F.col("ts").alias("when"), "who"), str(tmp_path / files[a]))
    write_csv(raw.reports, str(tmp_path / "reports.csv"))
    # a broken short_desc file: descriptions with commas and line breaks
    (tmp_path / "sd_raw").mkdir()
    (tmp_path / "sd_raw" / "short_desc.csv").write_text(
        "id,what,when,who\n1,fix a, b and c,100,7\n2,first line\nsecond line,200,8\n")
    t, rejects = load_csv_tables(spark, str(tmp_path), files, repair={"short_desc": "sd_raw"})
    assert rows(t.h("short_desc")) == [(1, "fix a; b and c", 100, 7), (2, "first linesecond line", 200, 8)]
    assert rejects.count() == 0
    assert rows(t.h("cc")) == rows(raw.h("cc"))


def test_quotes_line_breaks_and_header_names(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        'who,when,id,what\n7,100,1,"say ""x, y"" now"\n8,101,2,"a ""b"" c"\n9,102,3,"line\nbreak, ""q""\n"\n1,103,4,\n2,104,5,"",\n3,105,x,bad\n4,106,6\n')
    got, bad = load_history(spark, str(tmp_path / "h.csv"))
    assert rows(got) == [(1, 'say "x, y" now', 100, 7), (2, 'a "b" c', 101, 8), (3, 'line\nbreak, "q"\n', 102, 9), (4, "", 103, 1)]
    assert sorted((r.text, r.reason) for r in bad.collect()) == [
        ('2,104,5,"",', "wrong number of fields"), ("3,105,x,bad", "id is not a number"), ("4,106,6", "wrong number of fields")]
    with pytest.raises(ValueError, match="no column current_resolution"):
        load_reports(spark, str(tmp_path / "h.csv"))


def test_reports_columns_by_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text("id,opening,reporter,current_status,current_resolution\n1,5,100,NEW,FIXED\n")
    got, _ = load_reports(spark, str(tmp_path / "r.csv"))
    assert rows(got) == [(1, "FIXED", "NEW", 5, 100)]


def test_record_over_many_splits(spark, tmp_path):
    """A quoted text longer than a file split is one record; an unclosed quote is a reject."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
        long = "\n".join(f"line {i}, more" for i in range(200))
        (tmp_path / "h.csv").write_text("id,what,when,who\n" + "".join(f'{i},"{long} {i}",{i},1\n' for i in range(5)) + '9,"open,5,1\n10,x,5,1\n')
        assert spark.read.text(str(tmp_path / "h.csv")).rdd.getNumPartitions() > 10
        got, bad = load_history(spark, str(tmp_path / "h.csv"))
        assert rows(got) == [(i, f"{long} {i}", i, 1) for i in range(5)] + [(10, "x", 5, 1)]
        assert [r.reason for r in bad.collect()] == ["unclosed quote"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_repaired_text_is_unquoted_and_rejects_are_kept(spark, tmp_path):
    (tmp_path / "s.csv").write_text('id,what,when,who\n1,"fix a, b",100,7\nx,bad id,5,6\nno comma\n')
    got, bad = load_repaired(spark, str(tmp_path / "s.csv"))
    assert rows(got) == [(1, "fix a; b", 100, 7)]
    assert sorted((r.text, r.reason) for r in bad.collect()) == [("no comma", "no comma"), ("x,bad id,5,6", "id is not a number")]
    # F5 over it counts the text without its quotes
    from helpers import make_tables
    from histlens.plans.features import description_length
    t = make_tables(spark, [(1, "", "NEW", 100, 7)], {"short_desc": [tuple(r) for r in got.collect()]})
    assert rows(description_length(t, t.reports)) == [(1, len("fix a; b"))]


def small_splits(spark, size):
    import contextlib

    @contextlib.contextmanager
    def held():
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        try:
            yield
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    return held()


@pytest.mark.parametrize("size", [512, 64 << 20])
def test_unclosed_quotes_spoil_their_own_lines(spark, tmp_path, size):
    """At any distance and split size; quoted line breaks between and after them stay whole, and a quote inside a field is a character."""
    plain = lambda a, b: "".join(f"{i},t{i},{i},1\n" for i in range(a, b))
    pair = '900,"two\nlines",1,1\n'
    (tmp_path / "a.csv").write_text("id,what,when,who\n" + plain(0, 50) + pair + '901,"open,5,1\n' + plain(100, 300) + pair
                                    + plain(300, 310) + '902,op"en,5,1\n' + plain(400, 600) + pair + "903,last,1,1\n")
    (tmp_path / "b.csv").write_text("id,what,when,who\n" + plain(700, 710) + '904,"open,5,1\n' + plain(710, 890))
    with small_splits(spark, size):
        got, bad = load_history(spark, str(tmp_path))
        ids = [*range(50), *range(100, 310), *range(400, 600), *range(700, 890)]
        want = [(i, f"t{i}", i, 1) for i in ids] + [(900, "two\nlines", 1, 1)] * 3 + [(902, 'op"en', 5, 1), (903, "last", 1, 1)]
        assert sorted(rows(got)) == sorted(want)
        assert sorted((r.text, r.reason, r.position) for r in bad.collect()) == [('901,"open,5,1', "unclosed quote", 54), ('904,"open,5,1', "unclosed quote", 12)]


def test_one_literal_quote_loses_nothing(spark, tmp_path):
    text = 'id,what,when,who\n1,bad 5" disk,100,7\n' + "".join(f'{i},"text\nof two lines {i}",{i},1\n' if i % 50 == 0 else f"{i},t{i},{i},1\n" for i in range(2, 1002))
    (tmp_path / "h.csv").write_text(text)
    with small_splits(spark, 4096):
        got, bad = load_history(spark, str(tmp_path / "h.csv"))
        assert bad.count() == 0
        assert sorted(r.id for r in got.collect()) == list(range(1, 1002))
        assert got.filter("id = 1").first().what == 'bad 5" disk' and got.filter("id = 100").first().what == "text\nof two lines 100"


def test_splits_may_change_between_actions(spark, tmp_path):
    text = "id,what,when,who\n" + "".join(f'{i},"a\nb {i}",{i},1\n' if i % 7 == 0 else f'{i},"t ""{i}""",{i},1\n' for i in range(5000))
    (tmp_path / "h.csv").write_text(text)
    with small_splits(spark, 16384):
        got, bad = load_history(spark, str(tmp_path / "h.csv"))
        try:
            for n in (2, 9, 1):
                spark.conf.set("spark.sql.leafNodeDefaultParallelism", str(n))
                spark.conf.set("spark.sql.files.maxPartitionBytes", str(3000 * n))
                assert bad.count() == 0 and rows(got) == [(i, f"a\nb {i}" if i % 7 == 0 else f't "{i}"', i, 1) for i in range(5000)]
        finally:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def plain_records(lines):
    """Records of a file's lines, one after the other: (lines of the record, unclosed)."""
    from histlens.sources.quotes import BROKEN, CLOSED, OPEN, line_end

    out, i = [], 0
    while i < len(lines):
        j = i + 1
        if line_end(lines[i].split('"'), False) == OPEN:
            while j < len(lines) and line_end(lines[j].split('"'), True) == OPEN:
                j += 1
            if j < len(lines) and line_end(lines[j].split('"'), True) == CLOSED:
                out.append(("\n".join(lines[i : j + 1]), False))
                i = j + 1
                continue
            out.append((lines[i], True))
        else:
            out.append((lines[i], False))
        i += 1
    return out


@pytest.mark.parametrize("size", [100, 5000])
def test_records_equal_a_plain_reader(spark, tmp_path, size):
    import random

    from histlens.sources.quotes import records
    rnd = random.Random(size)
    pieces = ["a", ",", '"', '""', ',"', '",', "b c", "1,2", '"x', 'y"']
    want = []
    for k in range(3):
        lines = ["id,what"] + ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 5))) for _ in range(150)]
        (tmp_path / f"f{k}.csv").write_text("\n".join(lines) + "\n")
        want += plain_records(lines)
    with small_splits(spark, size):
        got = [(r.record, r.unclosed) for r in records(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("line,closed,opened", [
    ("a,b", 0, 1), ('1,"a",2', 0, 2), ('1,"a', 1, 2), ('b",2', 0, 0), ('b"",2', 0, 1), ('b""",2', 0, 0), ('1,5" x,2', 0, 1), ('"', 1, 0), ('""', 0, 1), ('",', 1, 0),
    ('1,"",2', 0, 1), ('end",5,"next', 1, 1), ('1,"a "b" c",2', 0, 2), ("", 0, 1)])
def test_line_ends(line, closed, opened):
    from histlens.sources.quotes import line_end
    assert (line_end(line.split('"'), False), line_end(line.split('"'), True)) == (closed, opened)


def test_split_states_take_a_byte_a_line():
    """Against a plain walk over the lines; a byte of state a line, whatever turns."""
    import random

    import numpy as np

    from histlens.sources.quotes import CLOSED, OPEN, split_states
    rnd = random.Random(5)
    for n in (0, 1, 7, 60):
        ends, opened = (np.array([rnd.choice([0, 1, 2]) for _ in range(n)], np.int8) for _ in range(2))
        states, split_ends, _ = split_states(ends, opened)
        assert states.dtype == np.uint8
        for s in (0, 1):
            for e in (0, 1):
                state = s
                for i in range(n):
                    assert states[i] >> (2 * s + e) & 1 == state
                    later = next((opened[j] for j in range(i + 1, n) if opened[j] != OPEN), None)
                    closes = e == 1 if later is None else later == CLOSED
                    state = int(opened[i] == OPEN) if state else int(ends[i] == OPEN and closes)
                    assert states[i] >> (4 + 2 * s + e) & 1 == state
                assert split_ends >> (2 * s + e) & 1 == state
