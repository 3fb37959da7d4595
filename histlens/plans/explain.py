"""Plan report: operator counts and scan pruning of the headline queries.

``python -m histlens.plans.explain [sf_dir] > PLANS.md`` prints, per query,
how many exchanges (and of which kind), aggregates, windows and joins its
physical plan has, and what each scan reads (partition filters, pushed
filters, columns).  Stored stages appear as plain scans of their files.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

HEADLINE = ["base_sample", "feat_num_cc", "feat_team_work", "feat_age_software", "feat_success_rate_last_assigner",
            "version_category", "repair_records", "nb_subset_search"]


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def summarise(df) -> tuple[Counter, list[str]]:
    ops, scans = Counter(), []
    for line in plan_text(df).split("\n"):
        body = re.sub(r"^[\s:+\-*()0-9]*", "", line)
        name = body.split(" ")[0].split("[")[0]
        if not name:
            continue
        if name == "Exchange":
            kind = "SinglePartition" if "SinglePartition" in body else (
                "range" if "rangepartitioning" in body else "hash")
            ops[f"Exchange({kind})"] += 1
        elif name in ("HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window", "WindowGroupLimit",
                      "SortMergeJoin", "BroadcastHashJoin", "BroadcastExchange", "Generate", "Expand",
                      "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            ops[name] += 1
        elif name == "FileScan":
            ops["Scan"] += 1
            m = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", body)
            p = re.search(r"PushedFilters: \[([^\]]*)\]", body)
            r = re.search(r"ReadSchema: struct<([^>]*)>", body)
            st = re.search(r"histlens-(\w+)-[0-9a-f]{12}(/\w+)?", body)
            pq = re.search(r"/(\w+\.parquet)", body)
            where = (st.group(1) + (st.group(2) or "")) if st else (pq.group(1) if pq else "?")
            scans.append(f"{where}: partition {m.group(1) if m else '-'}; pushed {p.group(1) if p else '-'}; "
                         f"columns {r.group(1) if r else '-'}")
    return ops, scans


def main(sf_dir: str = "/root/testdata/sf0.01") -> None:
    from histlens.plans.master import master_table
    from histlens.plans.registry import TESTDATA_HI_MINUTES, queries, setup
    from histlens.session import get_spark

    spark = get_spark()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")   # full scan metadata in plan strings
    qs = queries()
    frames = {n: qs[n](spark, sf_dir) for n in HEADLINE}
    t, b = setup(spark, sf_dir)
    frames["master_table (final plan, stored stages read back)"] = master_table(t, b, hi_minutes=TESTDATA_HI_MINUTES)
    print(f"# Physical plans of the headline queries ({sf_dir}, AQE initial plans)\n")
    print("Generated by `python -m histlens.plans.explain`. Counts are operators in the executed plan;\n"
          "a stored stage (ingested logs, base sample, per-bug stats) appears as a scan of its files.\n")
    for name, df in frames.items():
        ops, scans = summarise(df)
        print(f"## {name}\n")
        print("operators: " + ", ".join(f"{k} {v}" for k, v in sorted(ops.items())) + "\n")
        for s in scans:
            print(f"- {s}")
        print()
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
