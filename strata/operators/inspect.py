"""Layer inspection and DQ evidence reports, returned as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import REASON_COL


def describe_layer(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, n_rows, n_cols) per frame.  Each count is a global aggregate
    (answered from parquet metadata where possible); the union is of one-row
    frames."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
               .select(F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))
             for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def describe_columns(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, position, column, type) for every column of every frame —
    the layers' schemas as a table.  Built from schema metadata only (no data
    is read); its size is bounded by the number of columns."""
    spark = next(iter(frames.values())).sparkSession
    rows = [(name, i, f.name, f.dataType.simpleString())
            for name, df in frames.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "dataset string, position int, column string, type string")


def dq_evidence(dataset: str, tagged: DataFrame, null_cols: Sequence[str],
                reason_col: str = REASON_COL) -> DataFrame:
    """Long-format evidence for one dataset from a single scan of ``tagged``:
    quarantined rows per rule and NULL counts per typed column.

    Rows: (dataset, kind, name, n_rows) with kind ``quarantine`` or ``nulls``.

    One hash aggregate by outcome (partial + final; at most #rules + 1
    groups) carries both the row counts and the per-column NULL counts.  A
    second, global aggregate folds those few rows into one (the per-rule
    list is bounded by the number of rules, not by the data), which is then
    exploded into the report rows.
    """
    by_outcome = tagged.groupBy(F.col(reason_col).alias("name")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__null_{i}") for i, c in enumerate(null_cols)])
    entry = lambda kind, name, n: F.struct(F.lit(kind).alias("kind"), name.alias("name"),
                                           n.cast("long").alias("n_rows"))
    folded = by_outcome.agg(
        F.collect_list(F.when(F.col("name").isNotNull(),
                              entry("quarantine", F.col("name"), F.col("n_rows")))).alias("quarantine"),
        *[F.coalesce(F.sum(f"__null_{i}"), F.lit(0)).alias(f"__null_{i}") for i in range(len(null_cols))])
    nulls = F.array(*[entry("nulls", F.lit(c), F.col(f"__null_{i}")) for i, c in enumerate(null_cols)])
    return (folded.select(F.explode(F.concat("quarantine", nulls)).alias("e"))
                  .select(F.lit(dataset).alias("dataset"), "e.kind", "e.name", "e.n_rows"))
