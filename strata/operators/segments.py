"""Customer/patient segmentation: visit cohorts with N-day retention, RFM
segments, and per-segment retention.

Skew and scan notes: events are first reduced to one row per (entity, day)
— a hash aggregate with a partial (map-side) phase — so an entity holding a
third of all events brings at most one row per calendar day to any later
step.  The first visit per entity is a window minimum over that reduced
frame (partitioned by entity; its size per entity is bounded by the number
of calendar days, not by the number of events), and every per-entity
quantity — first/last visit, frequency, monetary, retention flags — comes
out of one aggregate over it.  The input is therefore scanned once, with two
shuffles, and no self-join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def entity_days(events: DataFrame, entity: str, ts: str, amount: str | None = None) -> DataFrame:
    """One row per (entity, visit day): ``_d``, the visit count ``_n`` and,
    if ``amount`` is given, the day's amount ``_amt``.  Events without an
    entity belong to nobody's history and are left out (the filter reaches
    the scan).  ``ts`` may be a date, a timestamp or date text; unparsable
    text gives a NULL day instead of failing the job."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    if amount is not None:
        aggs.append(F.sum(amount).alias("_amt"))
    return (events.where(F.col(entity).isNotNull())
                  .groupBy(F.col(entity), F.try_to_date(F.col(ts)).alias("_d")).agg(*aggs))


def _with_first_visit(days: DataFrame, entity: str) -> DataFrame:
    return days.withColumn("first_visit", F.min("_d").over(Window.partitionBy(entity)))


def _retention_flags(horizons: Sequence[int]) -> list[Column]:
    gap = F.datediff("_d", "first_visit")
    return [F.max(F.when((gap > 0) & (gap <= n), F.lit(1)).otherwise(F.lit(0))).alias(f"retained_{n}")
            for n in horizons]


def first_visit_flags(events: DataFrame, entity: str, ts: str,
                      horizons: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """Per entity: first visit date, its cohort month and, for each horizon
    ``n``, ``retained_<n>`` = 1 if another visit falls in (first, first+n]
    days, else 0."""
    days = _with_first_visit(entity_days(events, entity, ts), entity)
    # grouping by (entity, first_visit) is satisfied by the window's
    # partitioning by entity: no further shuffle
    flags = days.groupBy(entity, "first_visit").agg(*_retention_flags(horizons))
    return flags.withColumn("cohort_month", F.trunc("first_visit", "month"))


def visit_state(events: DataFrame, entity: str, ts: str) -> DataFrame:
    """(entity, days): the first two different visit days of each entity, ascending.

    All that retention needs, and two states merge into the state of both: a
    visit within ``n`` days of the first exists exactly if the second day is."""
    days = entity_days(events, entity, ts).where(F.col("_d").isNotNull())
    first = Window.partitionBy(entity).orderBy("_d")
    return (days.withColumn("_i", F.row_number().over(first)).where("_i <= 2")
                .groupBy(entity).agg(F.array_sort(F.collect_list("_d")).alias("days")))


def merge_visit_state(state: DataFrame, new: DataFrame, entity: str) -> DataFrame:
    """State after ``new`` (a state of more visits, in any order, late ones included).  Reads no visit again."""
    both = state.unionByName(new).select(entity, F.explode("days").alias("_d"))  # at most four days of an entity
    return both.groupBy(entity).agg(F.slice(F.array_sort(F.collect_set("_d")), 1, 2).alias("days"))


def flags_of_state(state: DataFrame, horizons: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """The rows of :func:`first_visit_flags`, from the state alone."""
    first, gap = F.col("days")[0], F.datediff(F.get("days", F.lit(1)), F.col("days")[0])
    flags = {f"retained_{n}": F.coalesce((gap <= n).cast("int"), F.lit(0)) for n in horizons}
    return state.withColumns({"first_visit": first, **flags, "cohort_month": F.trunc(first, "month")}).drop("days")


def cohort_retention(flags: DataFrame, horizons: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """Per cohort month: size, retained counts and rates (rounded to 4)."""
    aggs = [F.count(F.lit(1)).alias("cohort_size")]
    for n in horizons:
        aggs += [F.sum(f"retained_{n}").cast("long").alias(f"retained_{n}"),
                 F.round(F.avg(f"retained_{n}"), 4).alias(f"retention_rate_{n}")]
    return flags.groupBy("cohort_month").agg(*aggs)


@dataclass(frozen=True)
class RfmConfig:
    """Thresholds of recency, frequency and monetary value, for entities that
    have amounts but no appointments; see :class:`VisitConfig` for the visit
    segments.  Evaluated in this order: New, Champions, Loyal, Lost, At Risk."""
    new_first_within_days: int = 180
    recent_days: int = 90
    lost_after_days: int = 365
    frequent: int = 12
    loyal_frequency: int = 10
    high_value: float = 3_000_000.0


def _with_segment(per: DataFrame, reference_date, cfg: RfmConfig) -> DataFrame:
    """Recency / tenure relative to ``reference_date`` and the segment label,
    from ``last_visit``, ``first_visit``, ``frequency`` and ``monetary``."""
    ref = F.lit(str(reference_date)).cast("date")
    per = per.withColumns({"recency": F.datediff(ref, "last_visit"),
                           "tenure": F.datediff(ref, "first_visit")})
    seg = (F.when(F.col("tenure") <= cfg.new_first_within_days, "New")
            .when((F.col("recency") <= cfg.recent_days) & (F.col("frequency") >= cfg.frequent)
                  & (F.col("monetary") >= cfg.high_value), "Champions")
            .when((F.col("recency") <= cfg.lost_after_days) & (F.col("frequency") >= cfg.loyal_frequency),
                  "Loyal")
            .when(F.col("recency") > cfg.lost_after_days, "Lost")
            .otherwise("At Risk"))
    return per.withColumn("segment", seg)


def rfm(events: DataFrame, entity: str, ts: str, amount: str, reference_date,
        cfg: RfmConfig = RfmConfig()) -> DataFrame:
    """Per entity: recency (days from its last visit to ``reference_date``),
    frequency, monetary, tenure and the segment label (one hash aggregate)."""
    per = events.groupBy(entity).agg(
        F.max(F.try_to_date(ts)).alias("last_visit"), F.min(F.try_to_date(ts)).alias("first_visit"),
        F.count(F.lit(1)).alias("frequency"), F.sum(amount).alias("monetary"))
    return _with_segment(per, reference_date, cfg)


def entity_profile(events: DataFrame, entity: str, ts: str, amount: str, reference_date,
                   cfg: RfmConfig = RfmConfig(), horizons: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """RFM metrics, segment and retention flags per entity from a single scan
    of ``events`` (see the module note)."""
    days = _with_first_visit(entity_days(events, entity, ts, amount), entity)
    per = days.groupBy(entity, "first_visit").agg(
        F.max("_d").alias("last_visit"), F.sum("_n").alias("frequency"),
        F.sum("_amt").alias("monetary"), *_retention_flags(horizons))
    return _with_segment(per, reference_date, cfg)


def segment_summary(per_entity: DataFrame) -> DataFrame:
    return per_entity.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.round(F.avg("recency"), 2).alias("avg_recency"),
        F.round(F.avg("frequency"), 2).alias("avg_frequency"),
        F.round(F.avg("monetary"), 2).alias("avg_monetary"))


def retention_by_segment(profile: DataFrame, horizon: int = 30) -> DataFrame:
    """Retention rate per segment from an :func:`entity_profile` frame (one
    row per entity, so nothing is joined or double counted)."""
    return profile.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.round(F.avg(f"retained_{horizon}"), 4).alias(f"retention_rate_{horizon}"))


@dataclass(frozen=True)
class VisitConfig:
    """Segments by visits, average lead time and no-show rate.  The lead-time
    limits and "New = one visit" are given values; what counts as many visits
    and as a low or high no-show rate is ours."""
    many_visits: int = 3
    few_visits: int = 2
    low_no_show: float = 0.15
    high_no_show: float = 0.5
    champion_lead: int = 30
    loyal_lead: int = 90
    lost_lead: int = 180


def visit_profile(visits: DataFrame, entity: str, day: str, lead: str, missed: str, cfg: VisitConfig = VisitConfig(),
                  horizons: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """Per entity: visits, avg_lead_time, no_show_rate, cohort_month, segment and
    retention flags, from a single scan of ``visits``.  Rows without entity or
    day are left out; ``missed`` NULL counts as kept."""
    d = visits.select(F.col(entity), F.try_to_date(F.col(day)).alias("_d"), F.col(lead).cast("double").alias("_lead"),
                      F.coalesce(F.col(missed), F.lit(False)).alias("_missed")).filter(
        F.col(entity).isNotNull() & F.col("_d").isNotNull())
    days = d.groupBy(entity, "_d").agg(F.count(F.lit(1)).alias("_n"), F.sum("_lead").alias("_lead"), F.count("_lead").alias("_leads"),
                                       F.count_if(F.col("_missed")).alias("_miss"))
    per = _with_first_visit(days, entity).groupBy(entity, "first_visit").agg(
        F.sum("_n").alias("visits"), F.try_divide(F.sum("_lead"), F.sum("_leads")).alias("avg_lead_time"),
        (F.sum("_miss") / F.sum("_n")).alias("no_show_rate"), *_retention_flags(horizons))
    v, lt, ns = F.col("visits"), F.col("avg_lead_time"), F.col("no_show_rate")
    segment = (F.when(v == 1, "New")
               .when((v >= cfg.many_visits) & (lt <= cfg.champion_lead) & (ns <= cfg.low_no_show), "Champions")
               .when((lt > cfg.lost_lead) | ((v <= cfg.few_visits) & (ns >= cfg.high_no_show)), "Lost")
               .when((v >= cfg.many_visits) & (lt <= cfg.loyal_lead) & (ns < cfg.high_no_show), "Loyal")
               .otherwise("At Risk"))
    return per.withColumns({"segment": segment, "cohort_month": F.trunc("first_visit", "month")})


def retention_at(profile: DataFrame, by: str = "segment", horizons: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """Size and retention rate at every horizon per segment (or cohort)."""
    return profile.groupBy(by).agg(F.count(F.lit(1)).alias("n_entities"), *[
        F.round(F.avg(f"retained_{n}"), 4).alias(f"retention_rate_{n}") for n in horizons])
