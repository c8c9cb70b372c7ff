"""Mart-level operators: grouping-set summaries, day-over-day trend with a
drop alert, and the data-quality score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overall_and_by(df: DataFrame, dims: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """One ``GROUPING SETS ((), (d1), (d2), ...)`` aggregate: the overall row
    plus one breakdown per dimension in a single Expand + hash aggregate
    (one scan, one shuffle), tagged with ``grouping_id``."""
    sets = [[]] + [[F.col(d)] for d in dims]
    return df.groupingSets(sets, *[F.col(d) for d in dims]).agg(
        F.grouping_id().alias("gid"), *measures)


def daily_trend(events: DataFrame, ts: str, drop_threshold: float = 0.2) -> DataFrame:
    """Rows per calendar day, the previous calendar day's rows, the relative
    change and an alert when the drop exceeds ``drop_threshold``.

    One scan and no join or global window: each daily count is emitted twice
    — as the count of its own day and as the previous-day count of the next
    day — and the two roles are regrouped by day (a missing previous day
    gives NULL).  Days that only appear as "next day" are dropped.
    """
    daily = events.groupBy(F.try_to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    roles = daily.select(F.explode(F.array(
        F.struct(F.col("day").alias("day"), F.col("n").alias("cur"), F.lit(None).cast("long").alias("prev")),
        # rows without a day have no next day: NULL must not become its own "previous"
        F.struct(F.date_add("day", 1).alias("day"), F.lit(None).cast("long").alias("cur"),
                 F.when(F.col("day").isNotNull(), F.col("n")).alias("prev")))).alias("r")).select("r.*")
    j = (roles.groupBy("day").agg(F.max("cur").alias("n_rows"), F.max("prev").alias("prev_n_rows"))
              .filter(F.col("n_rows").isNotNull()))
    change = F.round(F.try_divide((F.col("n_rows") - F.col("prev_n_rows")).cast("double"),
                                  F.col("prev_n_rows")), 4)
    return j.withColumns({"pct_change": change,
                         "drop_alert": F.coalesce(change < -drop_threshold, F.lit(False))})


def quality_score(tagged: DataFrame, reason_col: str, data_cols: Sequence[str],
                  natural_key: Sequence[str], null_flag_threshold: float = 0.05,
                  weights: tuple[float, float, float, float] = (0.3, 0.3, 0.2, 0.2)) -> DataFrame:
    """Success / quarantine / null / duplicate rates and the weighted score
    ``w1·success + w2·(1−quarantine) + w3·(1−null) + w4·(1−dup)``, one row.

    Everything comes from one aggregate over the tagged rows; the distinct
    natural-key count is planned by Spark as a two-phase distinct aggregate
    (keys de-duplicated map-side first), so a hot key is not a hot task.
    Rows with a NULL key component do not count as a key.
    """
    n_cells = len(data_cols)
    null_cells = sum((F.count_if(F.col(c).isNull()) for c in data_cols), F.lit(0))
    j = tagged.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.count_if(F.col(reason_col).isNull()).alias("n_passed"),
                   null_cells.alias("n_null_cells"),
                   F.count_distinct(*[F.col(k) for k in natural_key]).alias("n_keys"))
    # try_divide: an empty input gives NULL rates instead of failing the job
    n = F.col("n_rows").cast("double")
    success = F.try_divide(F.col("n_passed"), n)
    quarantine = 1 - success
    null_rate = F.try_divide(F.col("n_null_cells"), n * n_cells)
    dup = 1 - F.try_divide(F.col("n_keys"), n)
    w1, w2, w3, w4 = weights
    return j.select(
        "n_rows", "n_passed", "n_keys",
        F.round(success, 4).alias("success_rate"), F.round(quarantine, 4).alias("quarantine_rate"),
        F.round(null_rate, 4).alias("null_rate"), F.round(dup, 4).alias("duplicate_rate"),
        F.round(w1 * success + w2 * (1 - quarantine) + w3 * (1 - null_rate) + w4 * (1 - dup), 4)
         .alias("quality_score"),
        (null_rate > null_flag_threshold).alias("null_rate_flag"))


def next_publish(arrivals: DataFrame, publishes: DataFrame, by: Sequence[str], at: str) -> DataFrame:
    """``arrivals`` with ``published_at`` (the first publish of the same ``by`` at or
    after the arrival, NULL if there is none) and ``lag_hours``.

    An as-of join without a range join.  Within a calendar day both sides are
    one sorted run, in which the last publish seen, going backwards, is the next
    one.  An arrival after its day's last publish takes the first publish of the
    next day that has one, found over one row per day.  Publishes at the same
    moment count once; an arrival without a time has no publish.  Both sides are
    read twice, for their rows and for their days.
    """
    from pyspark.sql import Window as W
    keys = [f"__k{i}" for i in range(len(by))]

    def side(df: DataFrame, publish: bool) -> DataFrame:
        # NULL is a key like any other
        named = dict(zip(keys, [F.struct(F.col(b)) for b in by]))
        rows = df.withColumns({**named, "__at": F.col(at), "__day": F.to_date(at)})
        return rows.withColumn("__pub", F.col("__at") if publish else F.lit(None).cast(df.schema[at].dataType))

    pub = side(publishes.where(F.col(at).isNotNull()), True).select(*keys, "__at", "__day", "__pub").distinct()
    arr = side(arrivals, False)
    both = arr.withColumn("__arrival", F.lit(True)).unionByName(pub.withColumn("__arrival", F.lit(False)), allowMissingColumns=True)
    back = (W.partitionBy(*keys, "__day").orderBy(F.desc("__at"), F.asc("__arrival"))
            .rowsBetween(W.unboundedPreceding, W.currentRow))
    same_day = both.withColumn("__same", F.last("__pub", ignorenulls=True).over(back)).where("__arrival")
    days = pub.groupBy(*keys, "__day").agg(F.min("__pub").alias("__first")).unionByName(
        arr.where("__day is not null").select(*keys, "__day").distinct().withColumn("__first", F.lit(None).cast(arrivals.schema[at].dataType)))
    later = W.partitionBy(*keys).orderBy(F.desc("__day")).rowsBetween(W.unboundedPreceding, -1)
    first = days.groupBy(*keys, "__day").agg(F.max("__first").alias("__first")).withColumn(
        "__later", F.last("__first", ignorenulls=True).over(later)).select(*keys, "__day", "__later")
    joined = same_day.join(first, [*keys, "__day"], "left")
    published = F.coalesce("__same", "__later")
    hours = (published.cast("timestamp").cast("double") - F.col("__at").cast("timestamp").cast("double")) / 3600
    return joined.select(*[F.col(f"`{c}`") for c in arrivals.columns], published.alias("published_at"),
                         F.round(hours, 4).alias("lag_hours"))


def batch_success(followed: DataFrame, by: Sequence[str], within_hours: float = 24.0) -> DataFrame:
    """Per ``by``: n_batches, n_published, success_rate (published within ``within_hours``),
    avg_lag_hours and max_lag_hours of :func:`next_publish`'s rows."""
    in_time = F.coalesce(F.col("lag_hours") <= within_hours, F.lit(False))
    return followed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_batches"), F.count("published_at").alias("n_published"),
        F.round(F.avg(in_time.cast("double")), 4).alias("success_rate"),
        F.round(F.avg("lag_hours"), 4).alias("avg_lag_hours"), F.max("lag_hours").alias("max_lag_hours"))
