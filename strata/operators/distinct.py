"""Distinct counts by many dimensions from bitmaps that are built once.

``GROUPING SETS`` with a distinct count turns every row into one per grouping
set.  Here rows are first reduced to one bitmap for each finest group and
range of ids; the grouping sets then merge bitmaps.  That pays where the finest groups are few:
their bitmaps take 4 KB for every 32,768 ids they hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dense_ids(df: DataFrame, col: str, out: str = "id", parts: int | None = None) -> DataFrame:
    """(col, out): every different value (NULL left out) and a number from 0 without gaps.

    Numbered in parts by a hash of the value, each from the running sum of the
    parts before, so no task sees all values."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = df.select(col).where(F.col(col).isNotNull()).distinct().withColumn("__part", F.pmod(F.xxhash64(col), F.lit(n)).cast("int"))
    starts = values.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).withColumn("__start", F.coalesce(F.sum("__n").over(
        W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__n")  # a row for each part
    local = values.withColumn("__local", F.row_number().over(W.partitionBy("__part").orderBy(col)))
    return local.join(starts, "__part").select(col, (F.col("__start") + F.col("__local") - 1).alias(out))


def distinct_by(df: DataFrame, dims: Sequence[str], ids: str | Column, sums: dict[str, Column] | None = None,
                out: str = "n_distinct") -> DataFrame:
    """Overall and by each dimension: ``dims``, ``gid`` (as :func:`overall_and_by`), ``n_rows``,
    ``out`` (different non-NULL ``ids``, whole numbers from 0) and the ``sums``.

    One scan; the rows are not expanded, only the bitmaps of the finest groups are."""
    sums = sums or {}
    i = F.col(ids) if isinstance(ids, str) else ids
    finest = df.withColumn("__id", i.cast("long")).groupBy(*dims, F.bitmap_bucket_number("__id").alias("__range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__id")).alias("__bits"), F.count(F.lit(1)).alias("__rows"),
        *[F.sum(c).alias(f"__s_{n}") for n, c in sums.items()])
    sets = [[F.col("__range")]] + [[F.col(d), F.col("__range")] for d in dims]
    merged = finest.groupingSets(sets, *[F.col(d) for d in dims], F.col("__range")).agg(
        F.shiftright(F.grouping_id(), 1).alias("gid"), F.bitmap_or_agg("__bits").alias("__bits"), F.sum("__rows").alias("__rows"),
        *[F.sum(f"__s_{n}").alias(f"__s_{n}") for n in sums])
    found = F.when(F.col("__range").isNull(), 0).otherwise(F.bitmap_count("__bits"))
    return merged.groupBy(*dims, "gid").agg(F.sum("__rows").alias("n_rows"), F.sum(found).alias(out),
                                            *[F.sum(f"__s_{n}").alias(n) for n in sums])
