"""the wide feature table, one row per bug of the target set.

Instead of 29 left joins of separately computed feature tables, one aggregation
of the history by ``id`` (before any join) computes counts, flags, time bounds and
latest / first values (``min`` of a struct); one row per bug is then joined to the
base sample.  Only features keyed by something else
need their own shuffle: team rate (actor), software age (product, version),
the five success rates (actor / assignee / reporter) and the two category
tables.  Those arrive as narrow ``(id, value)`` frames joined on ``id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histlens.functions import epoch_month, epoch_year, minutes_since
from histlens.operators import actors_per_entity, prior_rate, team_rate
from histlens.plans import features as FT
from histlens.plans.categories import (
    broad_os, component_category, compressed_priority, compressed_severity, detailed_os,
    version_category_from_pairs,
)
from histlens.schema import (
    DEFAULT_FIRST_K, DEFAULT_HI_MINUTES, DEFAULT_WEEK_MINUTES, TIME_ATTRS, UPDATE_ATTRS,
)
from histlens.sources.store import materialise
from histlens.sources.tables import Tables

# --- fixed values: the column order of the wide table ------------------------
MASTER_COLUMNS = [
    "id", "target", "reporter", "numAssign", "MajorVersionProduct", "MinorVersionProduct", "Segment",
    "component", "bigComponent", "broadOS", "detailedOS", "priority", "comprPriority",
    "product", "severity", "comprSeverity", "ageSoftwareVersionInDays", "prioUPGrade", "prioDownGrade",
    "sevDownGrade", "sevUPGrade", "length", "isReopened", "numCC", "isAssigned", "numReassignments",
    "numPeopleInvolved", "teamWorkRate", "isModWithinFirstDay", "hasUpdateToAttributes", "numStatusUpdates",
    "isOpenForOneWeekOrMore", "year", "month", "isAssignedToInbox", "isAssignedToNobody",
    "firstAssignee", "rateFirstAssignee", "firstAssigner", "rateFirstAssigner",
    "lastAssignee", "rateLastAssignee", "lastAssigner", "rateLastAssigner", "rateReporter",
]

LATEST_ATTRS = ("version", "component", "op_sys", "priority", "product", "severity", "assigned_to")
FIRST_ATTRS = ("priority", "severity")


def _row(order: Column) -> Column:
    """Sort key and payload in one narrow struct: (+/-ts, what, who)."""
    return F.struct(order.alias("_o"), F.col("what").alias("what"), F.col("who").alias("who"))


def bug_stats(t: Tables) -> DataFrame:
    """Every per-bug statistic that needs no opening time, from one aggregation of
    the history by id (partial before the shuffle: raw texts are not moved)."""
    attr, what, ts = F.col("attr"), F.col("what"), F.col("ts")
    at = attr == "assigned_to"
    in_time, in_upd = attr.isin(list(TIME_ATTRS)), attr.isin(list(UPDATE_ATTRS))
    aggs = [
        F.count(F.when(at, what)).alias("_n_at"),
        F.max(F.when(attr == "status", F.when(what == "REOPENED", 1).otherwise(0))).alias("isReopened"),
        F.sum(F.when(attr == "short_desc", F.length(what))).alias("length"),
        F.count(F.when(attr == "cc", what)).alias("_n_cc"),
        F.count(F.when(attr == "status", F.lit(1))).alias("_n_status"),
        F.max(F.when(in_time, ts)).alias("_time_mx"),
        F.min(F.when(in_upd, ts)).alias("_upd_mn"),
        F.max(F.when(in_upd, ts)).alias("_upd_mx"),
        F.min(F.when(at, ts)).alias("_at_mn"),
        F.max(F.when(at, ts)).alias("_at_mx"),
        F.max(F.when(at & (what == "None"), 1)).alias("_at_none"),
    ]
    aggs += [F.min(F.when(attr == a, _row(-ts))).alias(f"_last_{a}") for a in LATEST_ATTRS]
    aggs += [F.min(F.when(attr == a, _row(ts))).alias(f"_first_{a}") for a in FIRST_ATTRS]
    # as latest_by has them (a row without a time never wins), for the tables keyed by version and product
    aggs += [F.min(F.when((attr == a) & ts.isNotNull(), _row(-ts))).alias(f"_newest_{a}") for a in ("version", "product")]
    return t.history.groupBy("id").agg(*aggs)


def modified_early(t: Tables, base: DataFrame, hi_minutes: int) -> DataFrame:
    """Distinct ids with an event within the first minutes, over narrow (id, ts) rows."""
    mins = minutes_since(F.col("ts"), "opening")
    ev = t.hs(TIME_ATTRS).select("id", "ts").join(base.select("id", "opening"), "id")
    return ev.filter((mins > 0) & (mins < hi_minutes)).select("id").distinct()


def prior_rates(parts: dict[str, tuple[DataFrame, str, list[str]]], folder: str | None) -> dict[str, DataFrame]:
    """The running rates of several (frame, entity, order columns) in one ranged pass:
    by name the columns (id, tie, <name>), tie being the text or number that breaks ties."""
    rows = None
    for name, (df, entity, order) in parts.items():
        types = dict(df.dtypes)

        def num(c):
            return F.col(c) if c and types[c] != "string" else F.lit(None)

        def text(c):
            return F.col(c) if c and types[c] == "string" else F.lit(None)
        tie = order[2] if len(order) > 2 else None
        x = df.select(F.lit(name).alias("kind"), num(entity).cast("long").alias("e_num"), text(entity).cast("string").alias("e_text"),
                      F.col(order[0]).alias("ts"), "id", num(tie).cast("long").alias("t_num"), text(tie).cast("string").alias("t_text"), "fixed")
        rows = x if rows is None else rows.unionByName(x)
    rated = prior_rate(rows, ["kind", "e_num", "e_text"], ["ts", "id", "t_num", "t_text"], "fixed", "rate", folder=folder)
    return {name: rated.filter(F.col("kind") == name).withColumnRenamed("rate", name) for name in parts}


def _nn(col: str, e: Column) -> Column:
    return F.when(F.col(col).isNotNull(), e)


def master_table(t: Tables, base: DataFrame, hi_minutes: int = DEFAULT_HI_MINUTES,
                 week_minutes: int = DEFAULT_WEEK_MINUTES, k: int = DEFAULT_FIRST_K,
                 segment_mode: str = "rank", folder: str | None = None) -> DataFrame:
    """``folder``: where the stages that several branches read are stored (else the
    session's checkpoint folder); the result reads them."""
    def stage(df: DataFrame, name: str) -> DataFrame:
        return materialise(df, name, folder and f"{folder}/{name}")

    # assignments at the opening second: the inbox flags and two running rates
    at_open = stage(FT.assignments_at_opening(t, base), "at_open")
    at0 = at_open.groupBy("id").agg(F.min(F.struct("what", "who")).alias("_at0"))
    early = modified_early(t, base, hi_minutes).withColumn("_first_day", F.lit(1))
    fixed = FT.is_fixed()
    # all base bugs with history; the target set (>= 1 product row) is cut
    # after the success rates, which run over every base bug
    # every bug once, base bugs with their report: all joined where the aggregation left its rows, and
    # stored once for the version, age and rate branches and the result
    copies = base.withColumn("_copy", F.row_number().over(Window.partitionBy("id").orderBy("id")))
    bugs = stage(bug_stats(t).join(copies, "id", "left").join(at0, "id", "left").join(early, "id", "left"), "bug_stats")
    m = bugs.filter("_copy IS NOT NULL")
    lw = lambda a, f: F.col(f"_last_{a}.{f}")
    fw = lambda a, f: F.col(f"_first_{a}.{f}")
    op = F.col("opening")
    zero_assigned = (F.col("_at_mn") == op) & (F.col("_at_mx") == op) & (F.col("_at_none") == 1)
    pi, pl = FT.priority_rank(fw("priority", "what")), FT.priority_rank(lw("priority", "what"))
    si, sl = FT.severity_rank(fw("severity", "what")), FT.severity_rank(lw("severity", "what"))
    m = m.select(
        "id", "opening", "reporter", fixed.alias("target"),
        F.when(F.col("_n_at") > 0, F.col("_n_at")).alias("numAssign"),
        lw("component", "what").alias("component"),
        lw("op_sys", "what").alias("_os"),
        lw("priority", "what").alias("priority"),
        lw("product", "what").alias("product"),
        lw("version", "what").alias("_version"),
        lw("severity", "what").alias("severity"),
        _nn("_first_priority", F.when(pi - pl > 0, 1).otherwise(0)).alias("prioUPGrade"),
        _nn("_first_priority", F.when(pl - pi > 0, 1).otherwise(0)).alias("prioDownGrade"),
        _nn("_first_severity", F.when(si - sl > 0, 1).otherwise(0)).alias("sevDownGrade"),
        _nn("_first_severity", F.when(sl - si > 0, 1).otherwise(0)).alias("sevUPGrade"),
        "length", "isReopened",
        F.when(F.col("_n_cc") > 0, F.col("_n_cc")).alias("numCC"),
        F.when(F.col("_at_mn") <= op, F.when(zero_assigned, 0).otherwise(1)).alias("isAssigned"),
        F.coalesce("_first_day", F.lit(0)).alias("isModWithinFirstDay"),
        F.when((F.col("_upd_mn") != op) | (F.col("_upd_mx") != op), 1).otherwise(0).alias("hasUpdateToAttributes"),
        F.when(F.col("_n_status") > 0, F.col("_n_status") - 1).alias("numStatusUpdates"),
        F.when(minutes_since(F.col("_time_mx"), "opening") > week_minutes, 1).otherwise(0).alias("isOpenForOneWeekOrMore"),
        epoch_year("opening").alias("year"), epoch_month("opening").alias("month"),
        _nn("_at0", FT.inbox_flag(F.col("_at0.what"))).alias("isAssignedToInbox"),
        _nn("_at0", FT.nobody_flag(F.col("_at0.what"))).alias("isAssignedToNobody"),
        lw("assigned_to", "what").alias("lastAssignee"),
        lw("assigned_to", "who").alias("lastAssigner"),
        (-F.col("_last_assigned_to._o")).alias("_last_at_ts"),
        fixed.alias("fixed"),
        F.col("_last_product").isNotNull().alias("_is_target"),
    )
    m = m.select(
        "*",
        _nn("_os", broad_os("_os")).alias("broadOS"),
        _nn("_os", detailed_os("_os")).alias("detailedOS"),
        _nn("priority", compressed_priority("priority")).alias("comprPriority"),
        _nn("severity", compressed_severity("severity")).alias("comprSeverity"),
    )

    # --- features keyed by something other than the bug --------------------
    comp_cat = component_category(t.h("component")).select(
        F.col("what").alias("component"), F.col("BigComponent").alias("bigComponent"))
    # version dimension and software birthdays need every bug's latest
    # version and product; the base bugs' own values come from the stats
    newest = bugs.filter("id IS NOT NULL AND coalesce(_copy, 1) = 1 AND _newest_version IS NOT NULL AND _newest_product IS NOT NULL")
    lvp_all = newest.select("id", F.col("_newest_version.what").alias("Version"), (-F.col("_newest_version._o")).alias("ts"),
                            F.col("_newest_product.what").alias("Product"))
    vcat = version_category_from_pairs(lvp_all.select("Version", "Product").distinct(), segment_mode, folder=folder)
    bd = FT.software_birthdays(lvp_all, k)
    vp = m.filter(F.col("_version").isNotNull()).select(
        "id", F.col("_version").alias("Version"), F.col("product").alias("Product"), "opening")
    version = vp.join(vcat, ["Version", "Product"]).select(
        "id", "MajorVersionProduct", "MinorVersionProduct", "Segment")
    days = F.bround((F.col("opening") - F.col("birthday")).cast("double") / 86400.0, 0)
    age = (vp.select("id", "opening", "Product", FT.clean_age_version("Version").alias("Version"))
           .join(bd, ["Product", "Version"])
           .select("id", F.greatest(days, F.lit(0.0)).alias("ageSoftwareVersionInDays")))

    # distinct counts as distinct-then-count (the distinct shuffles on (id, value),
    # so a bug with a huge history is spread); actors over all bugs serve both
    # the people count and the reporters' team rate
    # the distinct pairs and the actor count of each bug are stored once; the count
    # is the people count of a base bug and tells the bugs of one actor behind the team rate
    pairs = stage(FT.involvement(t, base, all_ids=True), "involvement")
    actors = stage(actors_per_entity(pairs), "actors")
    people = actors.drop("only").join(base.select("id"), "id", "left_semi")
    rates = team_rate(pairs, actors=actors)
    team = (base.select("id", "reporter")
            .join(rates, F.col("reporter") == F.col("who"), "left")
            .select("id", "teamWorkRate"))
    reassign = FT.num_reassignments(t, base)

    last_at = m.filter(F.col("lastAssigner").isNotNull()).select(
        "id", F.col("lastAssignee").alias("what"), F.col("lastAssigner").alias("who"),
        F.col("_last_at_ts").alias("ts"), "fixed")
    rep = base.select("id", "reporter", "opening", fixed.alias("fixed"))
    rate = prior_rates({
        "rateFirstAssigner": (at_open, "who", ["ts", "id", "what"]), "rateFirstAssignee": (at_open, "what", ["ts", "id", "who"]),
        "rateLastAssigner": (last_at, "who", ["ts", "id"]), "rateLastAssignee": (last_at, "what", ["ts", "id"]),
        "rateReporter": (rep, "reporter", ["opening", "id"])}, folder)

    def first_of(name: str, entity: str, ties: list[str], alias: str) -> DataFrame:
        """Of several assignments at the opening the first in tie order."""
        r = rate[name].groupBy("id").agg(F.min(F.struct(*dict.fromkeys([*ties, entity]), name)).alias("_f"))
        return r.select("id", F.col(f"_f.{entity}").alias(alias), f"_f.{name}")
    r_first_assigner = first_of("rateFirstAssigner", "e_num", ["t_text", "e_num"], "firstAssigner")
    r_first_assignee = first_of("rateFirstAssignee", "e_text", ["e_text", "t_num"], "firstAssignee")
    r_last_assigner = rate["rateLastAssigner"].select("id", "rateLastAssigner")
    r_last_assignee = rate["rateLastAssignee"].select("id", "rateLastAssignee")
    r_reporter = rate["rateReporter"].select("id", "rateReporter")

    out = (m.filter("_is_target").join(comp_cat, "component", "left")
           .join(version, "id", "left").join(age, "id", "left").join(team, "id", "left")
           .join(people, "id", "left").join(reassign, "id", "left")
           .join(r_first_assigner, "id", "left").join(r_first_assignee, "id", "left")
           .join(r_last_assigner, "id", "left").join(r_last_assignee, "id", "left")
           .join(r_reporter, "id", "left"))
    return out.select(*MASTER_COLUMNS)
