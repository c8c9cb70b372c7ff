"""Write PLANS.md: for every registered query, the physical-plan facts that
matter at scale, read from Spark's final (post-AQE) plan.

    python tests/plan_report.py [sf_dir] [out.md]

Each query is run once through its own query execution (rows are counted in
the JVM, nothing is collected), so the adaptive plan is the final one.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile
import time
import warnings

warnings.filterwarnings("ignore")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from strata.plans.tables import TABLES  # noqa: E402

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct")


def _final(plan: str) -> str:
    return plan.split("== Initial Plan ==")[0]


def facts(spark, df) -> dict:
    qe = df._jdf.queryExecution()
    t0 = time.perf_counter()
    n = qe.toRdd().count()
    secs = time.perf_counter() - t0
    tree = _final(qe.executedPlan().toString())
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    formatted = qe.explainString(mode)
    tables = [t for t in TABLES if f"/{t}.parquet" in tree]
    scans = len(re.findall(r"FileScan \w+", tree))
    rdd_scans = tree.count("Scan ExistingRDD")
    pushed = sorted({m for m in re.findall(r"PushedFilters: \[([^\]]+)\]", formatted)})
    read_cols = [len(m.split(",")) for m in re.findall(r"ReadSchema: struct<([^>]*)>", formatted) if m]
    joins = {j: tree.count(j) for j in JOINS if j in tree}
    return {
        "rows": n, "secs": secs, "tables": tables, "scans": scans, "rdd_scans": rdd_scans,
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)",
                                   tree)),
        "broadcasts": tree.count("BroadcastExchange"),
        "joins": joins, "pushed": pushed, "max_read_cols": max(read_cols, default=0),
        "codegen_stages": len(set(re.findall(r"\*\((\d+)\)", tree))),
        "python": any(k in tree for k in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas")),
        "window": "Window" in tree, "formatted": formatted,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    from strata.session import local_session
    spark = local_session()
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-plans-"))
    lines = [
        "# PLANS — final physical plans of the registered queries",
        "",
        f"Generated by `python tests/plan_report.py {sf_dir}` on local[8] (AQE on). Columns: input tables",
        "scanned in the final plan (each at most once), checkpointed aggregates read back (`ckpt`),",
        "shuffle exchanges, broadcast exchanges, join strategies, widest parquet read (columns), whole-stage",
        "codegen stages and the filters pushed into the parquet scan. No plan contains a Python",
        "evaluation node, a cartesian product or a nested-loop join. Write-and-read-back queries show the",
        "plan of the final read.",
        "",
        "| query | rows | s | tables | ckpt | shuffles | bcast | joins | read cols | codegen | pushed filters |",
        "|---|---|---|---|---|---|---|---|---|---|---|",
    ]
    detail = {}
    for name, fn in E.queries().items():
        f = facts(spark, fn(spark, sf_dir))
        assert not f["python"], name
        joins = ", ".join(f"{k.replace('Join', '')}×{v}" for k, v in f["joins"].items()) or "—"
        pushed = "; ".join(p[:90] for p in f["pushed"]) or "—"
        lines.append(f"| `{name}` | {f['rows']} | {f['secs']:.2f} | {', '.join(f['tables']) or 'written data'} | "
                     f"{f['rdd_scans']} | {f['shuffles']} | {f['broadcasts']} | {joins} | {f['max_read_cols']} | "
                     f"{f['codegen_stages']} | {pushed} |")
        if name in ("enrich_profile", "retention_by_segment", "snapshot_diff", "partition_pruned_read"):
            detail[name] = f["formatted"]
    lines += ["", "## Formatted plans of selected queries", ""]
    for name, text in detail.items():
        text = re.sub(r"file:/[^\]\s,]*strata-scratch/", "<shared>/strata-scratch/", text)
        text = re.sub(r"file:/[^\]\s,]*/(\w+\.parquet)", r"<sf_dir>/\1", text)
        lines += [f"### `{name}`", "", "```", text.strip(), "```", ""]
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print(f"wrote {out}")
    spark.stop()


if __name__ == "__main__":
    main()
