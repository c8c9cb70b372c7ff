"""Duplicate handling: exact row dedup (file- or table-scoped), all-NULL row
removal on data columns, and deterministic dedup by natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_exact_duplicates(df: DataFrame, scope: str = "file", source_col: str = "source_file") -> DataFrame:
    """Exact duplicate removal.

    ``scope="file"``: duplicates only within one source file (the lineage
    column takes part in the comparison) — the legacy ingest behaviour.
    ``scope="all"``: duplicates across the whole input (lineage column
    ignored; the surviving row keeps the smallest source path, so the result
    is deterministic).
    """
    if scope == "file" or source_col not in df.columns:
        return df.dropDuplicates()
    if scope != "all":
        raise ValueError("scope must be 'file' or 'all'")
    data_cols = [c for c in df.columns if c != source_col]
    return (df.groupBy(*[F.col(f"`{c}`") for c in data_cols])
              .agg(F.min(source_col).alias(source_col))
              .select(*[F.col(f"`{c}`") for c in df.columns]))


def drop_all_null_rows(df: DataFrame, subset: Sequence[str] | None = None,
                       exclude: Sequence[str] = ("source_file", "channel", "load_date")) -> DataFrame:
    """Remove rows whose *data* columns are all NULL (metadata columns such
    as the lineage path are never NULL and would otherwise keep every row)."""
    cols = list(subset) if subset is not None else [c for c in df.columns if c not in exclude]
    if not cols:
        return df
    any_value = F.lit(False)
    for c in cols:
        any_value = any_value | F.col(f"`{c}`").isNotNull()
    return df.filter(any_value)


def dedup_by_key(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column]) -> DataFrame:
    """Keep one row per natural key: the row that is *largest* under
    ``prefer`` (ties broken by every remaining column, so the result is
    deterministic).

    Implemented as ``max(struct(prefer..., rest...))`` per key: a sort
    aggregate (a struct has no fixed width), whose partial phase reduces a key
    that holds a third of all rows on the map side.  It costs one shuffle and
    a sort of the wide rows on either side of it.
    """
    rest = [c for c in df.columns if c not in keys]
    pref_names = [f"__p{i}" for i in range(len(prefer))]
    packed = F.struct(*[p.alias(n) for p, n in zip(prefer, pref_names)],
                      *[F.col(f"`{c}`").alias(c) for c in rest])
    best = df.groupBy(*keys).agg(F.max(packed).alias("__best"))
    return best.select(*keys, *[F.col("__best").getField(c).alias(c) for c in rest]).select(*df.columns)
