"""D4-D8: category dimensions over attribute values.

D4, D7 and D8 depend on the value alone, so features apply the same
expressions inline (no join).  D5 needs value frequencies and D6 dense ids
over distinct (product, version) pairs; both are dimension-sized tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlens.functions import ordered_buckets
from histlens.operators import dense_group_ids, latest_by, value_frequency
from histlens.schema import DEFAULT_COMPONENT_MIN_CASES

# --- fixed values: category rules (first match wins) -------------------------
BROAD_OS_RULES = [  # substring -> BroadOS
    ("Windows", "Windows"), ("Mac", "Mac"), ("Solaris", "Other"), ("Linux", "Linux"),
    ("Unix", "Other"), ("All", "All"),
]
DETAILED_OS_RULES = [  # value list -> DetailedOS
    (["Windows 2003 Server", "Windows 95", "Windows 98", "Windows All", "Windows CE", "Windows ME",
      "Windows Mobile 2003", "Windows Me", "Windows Mobile 5.0", "Windows Server 2003",
      "Windows Server 2008", ""], "Windows Other"),
    (["Windows Vista", "Windows Vista Beta 2", "Windows Vista-WPF"], "Windows Vista"),
    (["Windows 2000"], "Windows 2000"),
    (["Windows 7"], "Windows 7"),
    (["Windows NT"], "Windows NT"),
    (["Windows XP"], "Windows XP"),
    (["Mac OS", "Mac OS X", "Mac OS X - Cocoa", "MacOS X"], "Mac OS X"),
    (["Linux", "Linux-GTK", "Linux Qt", "Linux-Motif"], "Linux"),
    (["All"], "All"),
]
COMPONENT_RULES = [  # ("contains", text) or ("in", list) -> BigComponent
    (("contains", "Update"), "Update"),
    (("in", ["Update Site", "Updater"]), "Update"),
    (("in", ["Runtime Common", "Runtime", "Runtime Diagram"]), "Runtime"),
    (("in", ["ui", "UI", "Monitor.UI", "Monitor.UI.SDBEditor", "ATL-UI", "Monitor.UI.GLARules",
             "UI Guidelines", "Platform.UI.ProfilingPerspective", "Test.UI", "Platform.UI.SequenceDiagram",
             "Platform.UI", "Trace.UI", "Test.UI.Reporting", "General UI", "Platform.UI.StatsPerfViewers",
             "Test.UI.JUnit", "Debug-UI"]), "UI"),
    (("in", ["core", "Java Core", "Core", "alf-core", "cdt-core", "ecf.core"]), "Core"),
    (("in", ["releng"]), "Releng"),
    (("in", ["deprecated2", "deprecated3", "deprecated4", "deprecated5", "deprecated6", "deprecated7",
             "Update (deprecated - use RT>Equinox>p2)"]), "deprecated"),
    (("in", ["documentation", "UML", "UML2", "DOC"]), "Doc"),
    (("contains", "Doc"), "Doc"),
    (("in", ["Build", "Build/Web", "cdt-build", "cdt-build-managed"]), "Build"),
    (("in", ["DSF", "Debug", "Debug-MI", "Debugger", "cdt-debug", "cdt-debug-cdi-gdb", "cdt-debug-dsf",
             "cdt-debug-dsf-gdb", "cdt-debug-edc"]), "Debug"),
    (("in", ["IDE", "Edit", "Editor"]), "Debug"),
]
PRIORITY_RULES = [(["P1", "P2"], "high"), (["P3"], "medium"), (["P4", "P5"], "low")]
PRIORITY_DEFAULT = "None"
SEVERITY_RULES = [(["blocker", "critical"], "critical"), (["major"], "major"), (["normal"], "normal"),
                  (["minor", "trivial"], "minor")]
SEVERITY_DEFAULT = "enhancement"
# version text cleaning for the segments: drop dots, then these replacements in order
VERSION_CLEAN = [(".", ""), ("0 DD ", "D"), ("DD ", "D")]
# dense segment id -> label (the 'rank' mode)
SEGMENT_LABELS = {3: "Major", 1: "Minor", 2: "Service"}


def _contains(text):
    return lambda c: c.contains(text)


def _isin(values):
    return lambda c: c.isin(values)


def broad_os(col) -> Column:
    return ordered_buckets(col, [(_contains(s), lab) for s, lab in BROAD_OS_RULES], "Other")


def detailed_os(col) -> Column:
    return ordered_buckets(col, [(_isin(v), lab) for v, lab in DETAILED_OS_RULES], "Other")


def compressed_priority(col) -> Column:
    return ordered_buckets(col, [(_isin(v), lab) for v, lab in PRIORITY_RULES], PRIORITY_DEFAULT)


def compressed_severity(col) -> Column:
    return ordered_buckets(col, [(_isin(v), lab) for v, lab in SEVERITY_RULES], SEVERITY_DEFAULT)


def big_component(col, cases_col, min_cases: int = DEFAULT_COMPONENT_MIN_CASES) -> Column:
    rules = [(_contains(arg) if kind == "contains" else _isin(arg), lab) for (kind, arg), lab in COMPONENT_RULES]
    c = F.col(col) if isinstance(col, str) else col
    n = F.col(cases_col) if isinstance(cases_col, str) else cases_col
    return ordered_buckets(c, rules, F.when(n < min_cases, F.lit("Other")).otherwise(c))


def os_category(os_hist: DataFrame) -> DataFrame:
    """D4: distinct OS value -> BroadOS, DetailedOS."""
    f = value_frequency(os_hist, "what")
    return f.select("what", broad_os("what").alias("BroadOS"), detailed_os("what").alias("DetailedOS"))


def component_category(comp_hist: DataFrame, min_cases: int = DEFAULT_COMPONENT_MIN_CASES) -> DataFrame:
    """D5: distinct component -> BigComponent (rare ones -> 'Other'); counts over the whole log."""
    f = value_frequency(comp_hist, "what")
    return f.select("what", big_component("what", "NumberOfCases", min_cases).alias("BigComponent"))


def priority_category(prio_hist: DataFrame) -> DataFrame:
    """D7: distinct priority -> compressedPriority."""
    return value_frequency(prio_hist, "what").select("what", compressed_priority("what").alias("compressedPriority"))


def severity_category(sev_hist: DataFrame) -> DataFrame:
    """D8: distinct severity -> compressedSeverity."""
    return value_frequency(sev_hist, "what").select("what", compressed_severity("what").alias("compressedSeverity"))


def clean_version_key(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    for a, b in VERSION_CLEAN:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def version_pairs(latest_vp: DataFrame) -> DataFrame:
    """Distinct (Version, Product) of every entity's latest version and product."""
    return latest_vp.select("Version", "Product").distinct()


def version_category_from_pairs(pairs: DataFrame, segment_mode: str = "rank", partitions: int | None = None,
                                folder: str | None = None) -> DataFrame:
    """D6 on distinct (Version, Product) pairs.

    The four dense ids come from one range-partitioned, stored pass over their
    distinct keys (no one-task step)."""
    p = (pairs.withColumn("_temp", clean_version_key("Version"))
         .withColumn("_major", F.substring("_temp", 1, 1))
         .withColumn("_minor", F.substring("_temp", 1, 2))
         .withColumn("_len", F.length("_temp"))
         .withColumn("_tt", (F.substring("_temp", 2, 1) == "0") & (F.col("_len") == 2)))
    # text keys in the order of the values: false before true, lengths as numbers
    tt, length = F.col("_tt").cast("int"), F.lpad(F.col("_len").cast("string"), 10, "0")
    keys = {"MajorVersionProduct": (F.col("Product"), F.col("_major")), "MinorVersionProduct": (F.col("Product"), F.col("_minor")),
            "ServiceVersionProduct": (F.col("Product"), F.col("_temp")), "_seg": (tt, length)}
    ids = dense_group_ids(p, keys, partitions, folder)
    out = p
    for name, (a, b) in keys.items():
        of = ids.filter(F.col("kind") == name).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("gid").alias(name))
        out = out.join(of, (a.cast("string") == F.col("_k1")) & (b == F.col("_k2"))).drop("_k1", "_k2")
    if segment_mode == "rank":
        label = F.lit(None).cast("string")
        for k, v in SEGMENT_LABELS.items():
            label = F.when(F.col("_seg") == k, F.lit(v)).otherwise(label)
    elif segment_mode == "rule":
        label = (F.when(F.col("_tt") & (F.col("_len") == 2), "Major")
                 .when(~F.col("_tt") & (F.col("_len") == 2), "Minor")
                 .when(F.col("_len") == 3, "Service"))
    else:
        raise ValueError(f"segment_mode must be 'rank' or 'rule', not {segment_mode!r}")
    return out.select("Version", "Product", "MajorVersionProduct", "MinorVersionProduct",
                      "ServiceVersionProduct", label.alias("Segment"))


def latest_version_product(version: DataFrame, product: DataFrame) -> DataFrame:
    """(id, Version, Product): latest version and latest product of each entity having both."""
    lv = latest_by(version, cols=["what"]).withColumnRenamed("what", "Version")
    lp = latest_by(product, cols=["what"]).withColumnRenamed("what", "Product")
    return lv.join(lp, "id")


def version_category(version: DataFrame, product: DataFrame, segment_mode: str = "rank") -> DataFrame:
    """D6: Version, Product -> MajorVersionProduct, MinorVersionProduct,
    ServiceVersionProduct (dense ids per product) and Segment."""
    return version_category_from_pairs(version_pairs(latest_version_product(version, product)), segment_mode)
