"""Aggregation operators: KPI groupings, pivot shares, null profiles, top-k.

All are hash aggregates with a partial (map-side) phase, so a hot grouping
key contributes one pre-aggregated row per map task to the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kpi(df: DataFrame, keys: Sequence[str | Column], measures: dict[str, Column],
        load_date: object | None = None) -> DataFrame:
    """``groupBy(keys).agg(measures)``; ``load_date`` (a date/str) adds the
    partition column as a literal so the result is reproducible."""
    out = df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])
    if load_date is not None:
        out = out.withColumn("load_date", F.lit(load_date).cast("date"))
    return out


def pivot_share(df: DataFrame, row: str, col: str, values: Sequence[str],
                count_name: str = "n", share_prefix: str = "share_", other: str = "other") -> DataFrame:
    """Counts of ``row × col`` with one column per value of ``col`` and the
    row-normalised share of each.

    ``values`` is given explicitly, so the pivot is one conditional count per
    value inside a single hash aggregate keyed by ``row`` (one shuffle, with
    map-side partial counts); Spark's generic ``pivot`` would first aggregate
    by ``(row, col)`` and then pivot in a second shuffle.  Values not listed,
    NULL among them, share the column ``<count_name>_<other>``, so the total is
    that of all rows.
    """
    if other in values:
        raise ValueError(f"{other!r} is a value; name the rest otherwise")
    listed = F.coalesce(F.col(col).isin(list(values)), F.lit(False))
    counts = df.groupBy(row).agg(*[F.count_if(F.col(col) == F.lit(v)).alias(f"{count_name}_{v}")
                                   for v in values],
                                 F.count_if(~listed).alias(f"{count_name}_{other}"))
    values = [*values, other]
    total = sum((F.col(f"{count_name}_{v}") for v in values), F.lit(0))
    return counts.select(
        row, *[F.col(f"{count_name}_{v}") for v in values],
        total.alias(f"{count_name}_total"),
        *[F.round(F.try_divide(F.col(f"{count_name}_{v}").cast("double"), total), 4)
          .alias(f"{share_prefix}{v}") for v in values])


def shares(df: DataFrame, by: Sequence[str], count_name: str = "n_rows") -> DataFrame:
    """Rows per group and their share of all rows.  The total is summed over the
    groups, of which there are few: ``by`` is meant for categories."""
    from pyspark.sql import Window
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias(count_name))
    return counts.withColumn("share", F.round(F.col(count_name) / F.sum(count_name).over(Window.partitionBy(F.lit(1))), 4))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, suffix: str = "_nulls") -> DataFrame:
    """Per-column NULL counts plus the row count, in one pass (one global
    aggregate with partial aggregation)."""
    cols = list(cols) if cols is not None else df.columns
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}{suffix}") for c in cols])


def count_desc(df: DataFrame, key: str | Column, count_name: str = "n_rows") -> DataFrame:
    """Group count, most frequent first (ties by key)."""
    key = F.col(key) if isinstance(key, str) else key
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
              .orderBy(F.desc(count_name), key.asc()))


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First ``k`` rows under a total order (``orderBy + limit`` compiles to
    ``TakeOrderedAndProject``: per-partition top-k, then a k-row merge)."""
    return df.orderBy(*order).limit(k)


def weighted_mean_merge(parts: DataFrame, keys: Sequence[str], sum_col: str, cnt_col: str,
                        out_avg: str, out_cnt: str) -> DataFrame:
    """Combine pre-aggregated (sum, count) partials into exact averages."""
    return parts.groupBy(*keys).agg(
        (F.sum(sum_col) / F.sum(cnt_col)).alias(out_avg),
        F.sum(cnt_col).alias(out_cnt))
