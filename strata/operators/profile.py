"""Profiles of arriving batches that add up: rows, duplicates, NULLs and
rejected rows per batch, rolled up over days or datasets without reading the
rows again.

Counts are exact and simply summed.  Whether rows of one batch come again in
another cannot be told from counts; for that a batch carries a sketch of its
rows (HyperLogLog), and sketches of several batches are merged into the sketch of all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: the sketch has 2 ** LOG_K registers: a standard error of about 1.04 / sqrt(2 ** LOG_K), 1.6 %
LOG_K = 12


def batch_profile(df: DataFrame, batch: Sequence[str], columns: Sequence[str], rejected: Column | None = None,
                  log_k: int = LOG_K) -> DataFrame:
    """A row per batch: n_rows, n_different (different rows), n_rejected,
    ``nulls`` (map column -> NULLs) and ``rows_sketch``.

    Equal rows of a batch are counted together first, so one that makes up a
    third of it is one row of the partial aggregate of each task."""
    bad = F.lit(False) if rejected is None else F.coalesce(rejected, F.lit(False))
    rows = df.select(*batch, *columns, bad.cast("long").alias("__bad"))
    same = rows.groupBy(*batch, *columns).agg(F.count(F.lit(1)).alias("__n"), F.sum("__bad").alias("__bad"))
    nulls = [F.sum(F.when(F.col(f"`{c}`").isNull(), F.col("__n")).otherwise(0)).alias(f"__null_{i}") for i, c in enumerate(columns)]
    out = same.groupBy(*batch).agg(
        F.sum("__n").alias("n_rows"), F.count(F.lit(1)).alias("n_different"), F.sum("__bad").alias("n_rejected"),
        F.hll_sketch_agg(F.xxhash64(*columns, *[F.col(f"`{c}`").isNull() for c in columns]), F.lit(log_k)).alias("rows_sketch"), *nulls)
    by_column = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.col(f"__null_{i}"))])
    return out.select(*batch, "n_rows", "n_different", "n_rejected", by_column.alias("nulls"), "rows_sketch")


def rolled_up(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles summed by ``by``: n_batches, n_rows, n_rejected, n_cells, n_null_cells,
    n_repeated (rows that repeat another of their batch, exact) and
    ``different`` (different rows over all batches, by the merged sketches)."""
    cells = F.col("n_rows") * F.size("nulls")
    null_cells = F.aggregate(F.map_values("nulls"), F.lit(0).cast("long"), lambda a, x: a + x)
    return profiles.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_batches"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("n_rejected"), F.lit(0)).alias("n_rejected"),
        F.coalesce(F.sum(cells), F.lit(0)).alias("n_cells"), F.coalesce(F.sum(null_cells), F.lit(0)).alias("n_null_cells"),
        F.coalesce(F.sum(F.col("n_rows") - F.col("n_different")), F.lit(0)).alias("n_repeated"),
        F.hll_sketch_estimate(F.hll_union_agg("rows_sketch")).alias("different"))


def null_rates(profiles: DataFrame, by: Sequence[str] = (), flag_above: float = 0.05) -> DataFrame:
    """(by, column, n_rows, n_nulls, null_rate, flagged) from stored profiles."""
    each = profiles.select(*by, "n_rows", F.explode("nulls").alias("column", "n"))
    out = each.groupBy(*by, "column").agg(F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n_nulls"))
    rate = F.try_divide(F.col("n_nulls").cast("double"), F.col("n_rows"))
    return out.withColumns({"null_rate": F.round(rate, 4), "flagged": F.coalesce(rate > flag_above, F.lit(False))})


def score(rolled: DataFrame, success_rate: Column, weights: tuple[float, float, float, float] = (0.3, 0.3, 0.2, 0.2)) -> DataFrame:
    """``rolled`` with quarantine_rate, null_rate, duplicate_rate and quality_score, the weighted sum of
    ``success_rate`` (share of batches that arrived), 1 - quarantine, 1 - null and 1 - duplicate rate.
    No rows: no rates and no score."""
    quarantine = F.try_divide(F.col("n_rejected").cast("double"), F.col("n_rows"))
    null = F.try_divide(F.col("n_null_cells").cast("double"), F.col("n_cells"))
    repeated = F.try_divide(F.col("n_repeated").cast("double"), F.col("n_rows"))
    w = weights
    total = w[0] * success_rate + w[1] * (1 - quarantine) + w[2] * (1 - null) + w[3] * (1 - repeated)
    return rolled.withColumns({
        "success_rate": F.round(success_rate, 4), "quarantine_rate": F.round(quarantine, 4), "null_rate": F.round(null, 4),
        "duplicate_rate": F.round(repeated, 4), "quality_score": F.round(total, 4)})
