"""Data-quality rule gate: first-match tagging, good/bad split, breakdown,
idempotent quarantine.

A rule is ``(name, fail_condition)``; the condition is TRUE when the row is
bad.  The reason recorded for a row is the *first* rule (in list order) whose
condition is TRUE; a NULL condition counts as a pass.  The whole rule list
compiles to one ``CASE WHEN`` expression, so tagging is a single projection
inside whole-stage codegen, evaluated in one pass over the input.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.files import delete_path

REASON_COL = "dq_failed_rule"
TIMESTAMP_COL = "dq_timestamp"


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column | str  # Column or SQL predicate text; TRUE = row is bad

    def condition(self) -> Column:
        return F.expr(self.fails) if isinstance(self.fails, str) else self.fails


def reason_expr(rules: Sequence[Rule]) -> Column:
    """``CASE WHEN r1 THEN 'r1' WHEN r2 THEN 'r2' ... END`` (NULL = passed)."""
    if not rules:
        return F.lit(None).cast("string")
    out = None
    for r in rules:
        cond = F.coalesce(r.condition(), F.lit(False))
        out = F.when(cond, F.lit(r.name)) if out is None else out.when(cond, F.lit(r.name))
    return out.otherwise(F.lit(None).cast("string"))


def tag(df: DataFrame, rules: Sequence[Rule], reason_col: str = REASON_COL) -> DataFrame:
    """Add the first-failed-rule column."""
    return df.withColumn(reason_col, reason_expr(rules))


def split(tagged: DataFrame, reason_col: str = REASON_COL) -> tuple[DataFrame, DataFrame]:
    """(good rows without the tag, bad rows with the tag)."""
    good = tagged.filter(F.col(reason_col).isNull()).drop(reason_col)
    bad = tagged.filter(F.col(reason_col).isNotNull())
    return good, bad


@dataclass
class Gate:
    good: DataFrame
    bad: DataFrame
    metrics: Observation  # filled by the first action on the observed path

    def summary(self) -> dict:
        """Totals and per-rule counts, collected as a side effect of the first
        action on the observed path (no extra job).  Blocks until that action
        has run — call it only after the observed path has been consumed."""
        return dict(self.metrics.get)


def gate(df: DataFrame, rules: Sequence[Rule], name: str | None = None,
         reason_col: str = REASON_COL, observe_on: str = "good") -> Gate:
    """Tag, split and attach zero-cost metrics.

    The ``Observation`` sits on the tagged frame *before* the split filter of
    one path (``observe_on``: ``good`` or ``bad``), so it sees every input row
    and computes the total and one ``count_if`` per rule — the complete
    breakdown without a separate aggregation job.  Choose the path that is
    certain to be consumed (e.g. ``bad`` when every run writes the
    quarantine); the other path is derived from the un-observed frame, so
    nothing is counted twice.
    """
    if observe_on not in ("good", "bad"):
        raise ValueError("observe_on must be 'good' or 'bad'")
    tagged = tag(df, rules, reason_col)
    # observation names must be unique within a plan (two gated inputs may be
    # joined later), so the default is a fresh name
    obs = Observation(name or f"dq_{uuid.uuid4().hex[:12]}")
    metric_cols = [F.count(F.lit(1)).alias("total")] + [
        F.count_if(F.col(reason_col) == F.lit(r.name)).alias(r.name) for r in rules]
    observed = tagged.observe(obs, *metric_cols)
    good_src, bad_src = (observed, tagged) if observe_on == "good" else (tagged, observed)
    good = good_src.filter(F.col(reason_col).isNull()).drop(reason_col)
    bad = bad_src.filter(F.col(reason_col).isNotNull())
    return Gate(good, bad, obs)


def summary_line(dataset: str, metrics: dict, rules: Sequence[Rule]) -> str:
    """``dataset=<d> rows=<total> bad=<bad> share=<bad / total>`` followed by the
    non-zero per-rule counts."""
    total = metrics["total"]
    bad = sum(metrics[r.name] for r in rules)
    share = bad / total if total else 0.0
    per_rule = " ".join(f"{r.name}={metrics[r.name]}" for r in rules if metrics[r.name])
    return f"dataset={dataset} rows={total} bad={bad} share={share:.4f}" + (f" {per_rule}" if per_rule else "")


def breakdown(tagged: DataFrame, reason_col: str = REASON_COL,
              passed_label: str = "passed") -> DataFrame:
    """One row per outcome (each failed rule plus ``passed``): row count and
    percentage of all rows.

    The grouping is a partial+final hash aggregate (a hot rule costs one row
    per map task in the shuffle).  The percentage uses a window over the
    aggregated frame, whose size is bounded by the number of rules + 1.
    """
    from pyspark.sql import Window
    counts = (tagged.select(F.coalesce(F.col(reason_col), F.lit(passed_label)).alias("rule"))
                    .groupBy("rule").agg(F.count(F.lit(1)).alias("n_rows")))
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("pct", F.round(F.col("n_rows") * F.lit(100.0) / total, 4))


def count_by_rule(bad: DataFrame, reason_col: str = REASON_COL) -> DataFrame:
    """Quarantined rows per rule, most frequent first (ties by rule name)."""
    return (bad.groupBy(F.col(reason_col).alias("rule"))
               .agg(F.count(F.lit(1)).alias("n_rows"))
               .orderBy(F.desc("n_rows"), F.asc("rule")))


def write_quarantine(bad: DataFrame, path: str, dataset: str, run_id: str,
                     ts: datetime | None = None, batch_col: str | None = None,
                     checked: DataFrame | None = None) -> None:
    """Append-style quarantine that is idempotent.

    By default rows go to ``path/dataset=<d>/run_id=<r>/``; with dynamic
    partition overwrite a re-run of the same ``run_id`` replaces its own
    partition instead of appending the same bad rows again.

    With ``batch_col`` (e.g. bronze's ``ingest_run``) the partition is the
    *source batch* instead: a later run that re-reads the same input replaces
    that batch's bad rows rather than adding another copy, so the quarantine
    holds each bad row once however many runs re-check it (``run_id`` is kept
    as a column).  ``checked`` is then the frame that was checked: batches of
    it that have no bad row any more lose their old quarantine rows, whatever
    run wrote them and whether or not ``run_id`` was used before.  Only
    batch ids (one per ingest run) reach the driver.  ``ts`` defaults to the query's ``current_timestamp()``.
    Schema evolution across runs is handled on read with ``mergeSchema``.
    """
    stamp = F.lit(ts).cast("timestamp") if ts is not None else F.current_timestamp()
    out = bad.withColumns({TIMESTAMP_COL: stamp, "dataset": F.lit(dataset), "run_id": F.lit(run_id)})
    part = batch_col if batch_col is not None else "run_id"
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset", part)
        .parquet(path))
    if batch_col is not None and checked is not None:
        spark = bad.sparkSession
        clean = (checked.select(F.col(batch_col).cast("string").alias("b")).distinct()
                 .join(bad.select(F.col(batch_col).cast("string").alias("c")).distinct(),
                       F.col("b").eqNullSafe(F.col("c")), "left_anti"))
        escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        for r in clean.collect():
            name = "__HIVE_DEFAULT_PARTITION__" if r["b"] is None else escape(r["b"])
            delete_path(spark, f"{path.rstrip('/')}/dataset={escape(dataset)}/{part}={name}")


def read_quarantine(spark, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)
