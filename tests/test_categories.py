"""D4-D8 and the rank texts: expected labels as literals, at least one pair per rule."""

import pytest
from pyspark.sql import functions as F

from histlens.plans import categories as C
from histlens.plans import features as FT

OS = [  # value, broad, detailed
    ("Windows 2003 Server", "Windows", "Windows Other"), ("Windows 95", "Windows", "Windows Other"), ("Windows 98", "Windows", "Windows Other"),
    ("Windows All", "Windows", "Windows Other"), ("Windows CE", "Windows", "Windows Other"), ("Windows ME", "Windows", "Windows Other"),
    ("Windows Mobile 2003", "Windows", "Windows Other"), ("Windows Server 2008", "Windows", "Windows Other"), ("", "Other", "Windows Other"),
    ("Windows Vista", "Windows", "Windows Vista"), ("Windows Vista Beta 2", "Windows", "Windows Vista"), ("Windows Vista-WPF", "Windows", "Windows Vista"),
    ("Windows 2000", "Windows", "Windows 2000"), ("Windows 7", "Windows", "Windows 7"), ("Windows NT", "Windows", "Windows NT"),
    ("Windows XP", "Windows", "Windows XP"), ("Mac OS X", "Mac", "Mac OS X"), ("MacOS X", "Mac", "Mac OS X"), ("Mac OS X - Carbon", "Mac", "Other"),
    ("Solaris", "Other", "Other"), ("Solaris-GTK", "Other", "Other"), ("Linux", "Linux", "Linux"), ("Linux-Motif", "Linux", "Linux"),
    ("Linux Qt", "Linux", "Linux"), ("Unix All", "Other", "Other"), ("All", "All", "All"), ("QNX-Photon", "Other", "Other"), ("windows", "Other", "Other"),
]
COMPONENT = [  # value, cases, label
    ("Update Manager", 5000, "Update"), ("Update (deprecated - use RT>Equinox>p2)", 5000, "Update"), ("Updater", 1, "Update"), ("Update Site", 1, "Update"),
    ("Runtime", 1, "Runtime"), ("Runtime Common", 1, "Runtime"), ("UI", 1, "UI"), ("ui", 1, "UI"), ("Platform.UI", 1, "UI"), ("Debug-UI", 1, "UI"),
    ("Core", 1, "Core"), ("core", 1, "Core"), ("cdt-core", 1, "Core"), ("releng", 1, "Releng"), ("deprecated5", 1, "deprecated"),
    ("documentation", 1, "Doc"), ("UML2", 1, "Doc"), ("User Doc", 1, "Doc"), ("Build", 1, "Build"), ("cdt-build-managed", 1, "Build"),
    ("Debug", 1, "Debug"), ("cdt-debug-dsf-gdb", 1, "Debug"), ("IDE", 1, "Debug"), ("Editor", 1, "Debug"), ("Text", 999, "Other"), ("Text", 1000, "Text"), ("SWT", 20000, "SWT"),
]
PRIORITY = [("P1", "high"), ("P2", "high"), ("P3", "medium"), ("P4", "low"), ("P5", "low"), ("None", "None"), ("", "None"), ("p1", "None")]
SEVERITY = [("blocker", "critical"), ("critical", "critical"), ("major", "major"), ("normal", "normal"), ("minor", "minor"),
            ("trivial", "minor"), ("enhancement", "enhancement"), ("other", "enhancement")]
PRIORITY_RANK = [("P1", 2), ("P2", 2), ("P3", 3), ("P4", 3), ("P5", 3), ("None", 0), ("NONE", 1), ("", 0)]
SEVERITY_RANK = [("trivial", 1), ("minor", 1), ("normal", 2), ("major", 3), ("critical", 3), ("blocker", 3), ("enhancement", 0)]
VERSION_KEY = [("3.0", "30"), ("3.1.2", "312"), ("2.0 M1", "20 M1"), ("0 DD 1.1", "D11"), ("DD 1.1", "D11"), ("unspecified", "unspecified")]


@pytest.mark.parametrize("rows,expr", [
    ([(v, b) for v, b, _ in OS], C.broad_os), ([(v, d) for v, _, d in OS], C.detailed_os), (PRIORITY, C.compressed_priority),
    (SEVERITY, C.compressed_severity), (VERSION_KEY, C.clean_version_key)])
def test_labels(spark, rows, expr):
    df = spark.createDataFrame([(v, str(w)) for v, w in rows], "v STRING, want STRING")
    assert [r.v for r in df.withColumn("got", expr("v")).filter("NOT got <=> want").collect()] == []


def test_component_labels(spark):
    df = spark.createDataFrame(COMPONENT, "v STRING, n LONG, want STRING")
    assert [tuple(r) for r in df.withColumn("got", C.big_component("v", "n")).filter("NOT got <=> want").collect()] == []


@pytest.mark.parametrize("rows,expr", [(PRIORITY_RANK, FT.priority_rank), (SEVERITY_RANK, FT.severity_rank)])
def test_ranks(spark, rows, expr):
    df = spark.createDataFrame(rows, "v STRING, want INT")
    assert [r.v for r in df.withColumn("got", expr(F.col("v")).cast("int")).filter("NOT got <=> want").collect()] == []


def test_segments(spark):
    pairs = spark.createDataFrame([(v, "JDT") for v in ("3.0", "3.1", "3.1.2")], "Version STRING, Product STRING")
    want = {"3.0": "Major", "3.1": "Minor", "3.1.2": "Service"}
    for mode in ("rank", "rule"):
        assert {r.Version: r.Segment for r in C.version_category_from_pairs(pairs, mode).collect()} == want
    more = pairs.unionByName(spark.createDataFrame([("unspecified", "JDT")], "Version STRING, Product STRING"))
    assert {r.Version: r.Segment for r in C.version_category_from_pairs(more, "rank").collect()}["3.0"] is None
