"""F1-F30: per-bug features, one function each (the per-feature plans).

Every function takes the input ``Tables`` and the base sample ``base`` and
returns a DataFrame keyed by ``id``.  The wide table (``plans.master``) does
not join these 30 frames; it computes the same values in one fused
aggregation.  Tests check that both agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlens.functions import epoch_month, epoch_year, leading_number, minutes_since
from histlens.operators import (
    any_in_range, count_per, distinct_count, distinct_events, ever, first_by, first_k_max,
    keep_with, latest_by, prior_rate, sum_length, team_rate, top_n_by, value_as_of,
)
from histlens.plans.categories import (
    broad_os, component_category, compressed_priority, compressed_severity, detailed_os,
    latest_version_product, version_category_from_pairs, version_pairs,
)
from histlens.schema import (
    DEFAULT_FIRST_K, DEFAULT_HI_MINUTES, DEFAULT_WEEK_MINUTES, PEOPLE_ATTRS, TIME_ATTRS, UPDATE_ATTRS,
)
from histlens.sources.tables import Tables

# --- fixed values: text -> rank maps applied as ordered literal replacements,
# the result read as a number by its leading digits (other text -> 0) --------
PRIORITY_RANK_REPLACE = [("P", ""), ("1", "2"), ("4", "3"), ("5", "3"), ("NONE", "1")]
SEVERITY_RANK_REPLACE = [("trivial", "1"), ("minor", "1"), ("normal", "2"), ("major", "3"),
                         ("critical", "3"), ("blocker", "3")]
# assignment targets
INBOX_MARKERS = ["inbox", "Inbox", "webmaster"]
NOBODY_VALUES = ["None", "", "__UNKNOWN__"]
# resolution counted as success
FIXED = "FIXED"
# software version key cleaning for the age feature
AGE_VERSION_REPLACE = ("0 D", "D")


def _replace_chain(col, pairs) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def priority_rank(col) -> Column:
    return leading_number(_replace_chain(col, PRIORITY_RANK_REPLACE))


def severity_rank(col) -> Column:
    return leading_number(_replace_chain(col, SEVERITY_RANK_REPLACE))


def is_fixed(col="current_resolution") -> Column:
    return F.when(F.col(col) == FIXED, 1).otherwise(0)


def inbox_flag(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    cond = None
    for m in INBOX_MARKERS:
        cond = c.contains(m) if cond is None else (cond | c.contains(m))
    return F.when(cond, 1).otherwise(0)


def nobody_flag(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(NOBODY_VALUES), 1).otherwise(0)


def clean_age_version(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.replace(c, F.lit(AGE_VERSION_REPLACE[0]), F.lit(AGE_VERSION_REPLACE[1]))


def _latest_of(t: Tables, base: DataFrame, attr: str) -> DataFrame:
    """Latest value per bug of the base sample: aggregate first (partial, skew-proof), then semi join."""
    return keep_with(latest_by(t.h(attr), cols=["what", "ts", "who"]), base)


# F1 -------------------------------------------------------------------------
def target(t: Tables, base: DataFrame) -> DataFrame:
    return keep_with(base, t.h("product")).select("id", is_fixed().alias("target"))


# F2
def reports(t: Tables, base: DataFrame) -> DataFrame:
    return base.select("id", "current_resolution", "current_status", "opening", "reporter")


# F3
def num_assign(t: Tables, base: DataFrame) -> DataFrame:
    return keep_with(count_per(t.h("assigned_to"), "id", "what", "numAssign"), base)


# F4
def is_reopened(t: Tables, base: DataFrame) -> DataFrame:
    return keep_with(ever(t.h("status"), "id", F.col("what") == "REOPENED", "isReopened"), base)


# F5
def description_length(t: Tables, base: DataFrame) -> DataFrame:
    return keep_with(sum_length(t.h("short_desc"), "id", "what", "length"), base)


# F6
def num_cc(t: Tables, base: DataFrame) -> DataFrame:
    return keep_with(count_per(t.h("cc"), "id", "what", "numCC"), base)


# F7
def is_assigned(t: Tables, base: DataFrame) -> DataFrame:
    """0 only for a bug whose every assignment is at its opening and one of them
    is 'None'; 1 if the first assignment is at or before the opening; no row
    if the first assignment comes after the opening (or there is none)."""
    a = (t.h("assigned_to").groupBy("id")
         .agg(F.min("ts").alias("_mn"), F.max("ts").alias("_mx"),
              F.max(F.when(F.col("what") == "None", 1).otherwise(0)).alias("_none")))
    j = a.join(base.select("id", "opening"), "id").filter(F.col("_mn") <= F.col("opening"))
    zero = (F.col("_mn") == F.col("opening")) & (F.col("_mx") == F.col("opening")) & (F.col("_none") == 1)
    return j.select("id", F.when(zero, 0).otherwise(1).alias("isAssigned"))


# F8
def num_reassignments(t: Tables, base: DataFrame) -> DataFrame:
    ev = distinct_events(keep_with(t.hs(["assigned_to"]), base), ["assigned_to"], "ts",
                         entities=base, entity_col="opening")
    return distinct_count(ev, "id", "_n").select("id", (F.col("_n") - 1).alias("numReassignments"))


def involvement(t: Tables, base: DataFrame, all_ids: bool) -> DataFrame:
    """Distinct (id, who): actors of the 10 logs (no cc) plus the reporter of base bugs."""
    h = t.hs(PEOPLE_ATTRS)
    if not all_ids:
        h = keep_with(h, base)
    return distinct_events(h, PEOPLE_ATTRS, "who", entities=base, entity_col="reporter")


# F9
def num_people_involved(t: Tables, base: DataFrame) -> DataFrame:
    return distinct_count(involvement(t, base, all_ids=False), "id", "numPeopleInvolved")


# F10
def team_work(t: Tables, base: DataFrame) -> DataFrame:
    """Team rate of each bug's reporter: over the involvement of *all* bugs."""
    rates = team_rate(involvement(t, base, all_ids=True))
    # null-safe, so that no filter on the actor comes down to one of the two reads of the pairs
    # and both share one exchange; a bug without a reporter has no rate
    j = base.select("id", "reporter").join(rates, F.col("reporter").eqNullSafe(F.col("who")), "left")
    return j.select("id", F.when(F.col("reporter").isNotNull(), F.col("teamWorkRate")).alias("teamWorkRate"))


def _event_minutes(t: Tables, base: DataFrame, attrs) -> DataFrame:
    ev = t.hs(attrs).select("id", "ts")
    return ev.join(base.select("id", "opening"), "id").withColumn("_min", minutes_since("ts", "opening"))


# F11
def is_mod_within_first_day(t: Tables, base: DataFrame, hi_minutes: int = DEFAULT_HI_MINUTES) -> DataFrame:
    flags = any_in_range(_event_minutes(t, base, TIME_ATTRS), "id", F.col("_min"), 0, hi_minutes, "_f")
    return (base.select("id").join(flags, "id", "left")
            .select("id", F.coalesce("_f", F.lit(0)).alias("isModWithinFirstDay")))


# F12
def has_update_to_attributes(t: Tables, base: DataFrame) -> DataFrame:
    ev = t.hs(UPDATE_ATTRS).select("id", "ts").join(base.select("id", "opening"), "id")
    flags = ever(ev, "id", F.col("ts") != F.col("opening"), "_f")
    return (base.select("id").join(flags, "id", "left")
            .select("id", F.coalesce("_f", F.lit(0)).alias("hasUpdateToAttributes")))


# F13
def num_status_updates(t: Tables, base: DataFrame) -> DataFrame:
    c = keep_with(count_per(t.h("status"), "id", "id", "_n"), base)
    return c.select("id", (F.col("_n") - 1).alias("numStatusUpdates"))


# F14
def version_feature(t: Tables, base: DataFrame, segment_mode: str = "rank") -> DataFrame:
    lvp_all = latest_version_product(t.h("version"), t.h("product"))
    cat = version_category_from_pairs(version_pairs(lvp_all), segment_mode)
    return (keep_with(lvp_all, base).join(cat, ["Version", "Product"], "left")
            .select("id", "Version", "Product", "MajorVersionProduct", "MinorVersionProduct",
                    "ServiceVersionProduct", "Segment"))


# F15
def component_feature(t: Tables, base: DataFrame) -> DataFrame:
    cat = component_category(t.h("component"))
    lc = _latest_of(t, base, "component").select("id", F.col("what").alias("component"))
    return lc.join(cat, lc["component"] == cat["what"]).select("id", "component",
                                                               F.col("BigComponent").alias("bigComponent"))


# F16
def os_feature(t: Tables, base: DataFrame) -> DataFrame:
    lo = _latest_of(t, base, "op_sys")
    return lo.select("id", F.col("what").alias("allOS"), broad_os("what").alias("broadOS"),
                     detailed_os("what").alias("detailedOS"))


# F17
def priority_feature(t: Tables, base: DataFrame) -> DataFrame:
    lp = _latest_of(t, base, "priority")
    return lp.select("id", F.col("what").alias("priority"), compressed_priority("what").alias("comprPriority"))


# F18
def product_feature(t: Tables, base: DataFrame) -> DataFrame:
    return _latest_of(t, base, "product").select("id", F.col("what").alias("product"))


# F19
def severity_feature(t: Tables, base: DataFrame) -> DataFrame:
    ls = _latest_of(t, base, "severity")
    return ls.select("id", F.col("what").alias("severity"), compressed_severity("what").alias("comprSeverity"))


# F20
def is_open_for_one_week_or_more(t: Tables, base: DataFrame, week_minutes: int = DEFAULT_WEEK_MINUTES) -> DataFrame:
    flags = any_in_range(_event_minutes(t, base, TIME_ATTRS), "id", F.col("_min"), week_minutes, None, "_f")
    return (base.select("id").join(flags, "id", "left")
            .select("id", F.coalesce("_f", F.lit(0)).alias("isOpenForOneWeekOrMore")))


# F21
def year_and_month(t: Tables, base: DataFrame) -> DataFrame:
    return base.select("id", epoch_year("opening").alias("year"), epoch_month("opening").alias("month"))


# F22
def software_birthdays(lvp_all: DataFrame, k: int = DEFAULT_FIRST_K) -> DataFrame:
    """(Product, Version, birthday): largest of the k earliest latest-version times."""
    ev = lvp_all.select("Product", clean_age_version("Version").alias("Version"), F.col("ts"))
    return first_k_max(ev, ["Product", "Version"], "ts", k, "birthday")


def software_birthday_rows(lvp_all: DataFrame, k: int = DEFAULT_FIRST_K) -> DataFrame:
    """WN5+WN6 as rows: per (Product, Version) the k earliest latest-version
    times, then the top one with ties kept (``rank() <= 1``)."""
    from pyspark.sql import Window

    ev = lvp_all.select("Product", clean_age_version("Version").alias("Version"), F.col("ts"))
    w = Window.partitionBy("Product", "Version").orderBy("ts")
    first = ev.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")
    return top_n_by(first, ["Product", "Version"], "ts", 1)


def age_software(t: Tables, base: DataFrame, k: int = DEFAULT_FIRST_K) -> DataFrame:
    """Days from the version's birthday to the opening (half-even rounding, >= 0).
    Covers all reports, not only the base sample."""
    lv = latest_by(t.h("version"), cols=["what", "ts"]).withColumnRenamed("what", "Version")
    lp = latest_by(t.h("product"), cols=["what"]).withColumnRenamed("what", "Product")
    lvp_all = lv.join(lp, "id")
    bd = software_birthdays(lvp_all, k)
    vp = (t.reports.select("id", "opening").join(lvp_all, "id")
          .select("id", "opening", "Product", clean_age_version("Version").alias("Version")))
    days = F.bround((F.col("opening") - F.col("birthday")).cast("double") / 86400.0, 0)
    return (vp.join(bd, ["Product", "Version"])
            .select("id", F.greatest(days, F.lit(0.0)).alias("ageSoftwareVersionInDays")))


# F23
def assigned_to_whom(t: Tables, base: DataFrame) -> DataFrame:
    at0 = value_as_of(base.select("id", "opening"), t.h("assigned_to"))
    first = first_by(at0.select("id", "what", "who", F.lit(0).alias("_z")), order_col="_z",
                     cols=["what"])
    return first.select("id", inbox_flag("what").alias("isAssignedToInbox"),
                        nobody_flag("what").alias("isAssignedToNobody"))


# F24
def update_priority(t: Tables, base: DataFrame) -> DataFrame:
    h = t.h("priority")
    f = first_by(h, cols=["what"]).select("id", priority_rank("what").alias("_i"))
    la = latest_by(h, cols=["what"]).select("id", priority_rank("what").alias("_l"))
    j = keep_with(f.join(la, "id"), base)
    return j.select("id", F.when(F.col("_i") - F.col("_l") > 0, 1).otherwise(0).alias("prioUPGrade"),
                    F.when(F.col("_l") - F.col("_i") > 0, 1).otherwise(0).alias("prioDownGrade"))


# F25
def update_severity(t: Tables, base: DataFrame) -> DataFrame:
    h = t.h("severity")
    f = first_by(h, cols=["what"]).select("id", severity_rank("what").alias("_i"))
    la = latest_by(h, cols=["what"]).select("id", severity_rank("what").alias("_l"))
    j = keep_with(f.join(la, "id"), base)
    return j.select("id", F.when(F.col("_i") - F.col("_l") > 0, 1).otherwise(0).alias("sevDownGrade"),
                    F.when(F.col("_l") - F.col("_i") > 0, 1).otherwise(0).alias("sevUPGrade"))


# F26-F29 ----------------------------------------------------------------------
def assignments_at_opening(t: Tables, base: DataFrame) -> DataFrame:
    """Every assignment made at the opening second of a base bug, with the bug's outcome."""
    b = base.select("id", "opening", is_fixed().alias("fixed"))
    return value_as_of(b, t.h("assigned_to")).select("id", "what", "ts", "who", "fixed")


def last_assignments(t: Tables, base: DataFrame) -> DataFrame:
    la = _latest_of(t, base, "assigned_to")
    return la.join(base.select("id", is_fixed().alias("fixed")), "id")


def success_rate_first_assigner(t: Tables, base: DataFrame) -> DataFrame:
    r = prior_rate(assignments_at_opening(t, base), "who", ["ts", "id", "what"], "fixed", "rateFirstAssigner")
    return r.select("id", F.col("who").alias("firstAssigner"), "rateFirstAssigner")


def success_rate_last_assigner(t: Tables, base: DataFrame) -> DataFrame:
    r = prior_rate(last_assignments(t, base), "who", ["ts", "id"], "fixed", "rateLastAssigner")
    return r.select("id", F.col("who").alias("lastAssigner"), "rateLastAssigner")


def success_rate_first_assignee(t: Tables, base: DataFrame) -> DataFrame:
    r = prior_rate(assignments_at_opening(t, base), "what", ["ts", "id", "who"], "fixed", "rateFirstAssignee")
    return r.select("id", F.col("what").alias("firstAssignee"), "rateFirstAssignee")


def success_rate_last_assignee(t: Tables, base: DataFrame) -> DataFrame:
    r = prior_rate(last_assignments(t, base), "what", ["ts", "id"], "fixed", "rateLastAssignee")
    return r.select("id", F.col("what").alias("lastAssignee"), "rateLastAssignee")


# F30
def success_rate_reporter(t: Tables, base: DataFrame) -> DataFrame:
    b = base.select("id", "reporter", "opening", is_fixed().alias("fixed"))
    r = prior_rate(b, "reporter", ["opening", "id"], "fixed", "rateReporter")
    return r.select("id", "reporter", "rateReporter")


FEATURES = {
    "target": target, "reports": reports, "num_assign": num_assign, "is_reopened": is_reopened,
    "description_length": description_length, "num_cc": num_cc, "is_assigned": is_assigned,
    "num_reassignments": num_reassignments, "num_people_involved": num_people_involved,
    "team_work": team_work, "is_mod_within_first_day": is_mod_within_first_day,
    "has_update_to_attributes": has_update_to_attributes, "num_status_updates": num_status_updates,
    "version": version_feature, "component": component_feature, "os": os_feature,
    "priority": priority_feature, "product": product_feature, "severity": severity_feature,
    "is_open_for_one_week_or_more": is_open_for_one_week_or_more, "year_and_month": year_and_month,
    "age_software": age_software, "assigned_to_whom": assigned_to_whom,
    "update_priority": update_priority, "update_severity": update_severity,
    "success_rate_first_assigner": success_rate_first_assigner,
    "success_rate_last_assigner": success_rate_last_assigner,
    "success_rate_first_assignee": success_rate_first_assignee,
    "success_rate_last_assignee": success_rate_last_assignee,
    "success_rate_reporter": success_rate_reporter,
}
