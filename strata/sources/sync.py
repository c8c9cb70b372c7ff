"""Serving extracts: full rebuild from the current snapshot and
high-watermark incremental append.  Both targets are snapshot-versioned
tables (each rebuild an overwrite version, each sync an append version), so
a reader (:func:`read_extract`) never sees a half-written extract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import _publish, current_version, publish, read_as_of, surplus


def full_extract(spark: SparkSession, versioned_root: str, out_path: str,
                 where: str | None = None) -> int:
    """Rebuild an extract from the *current* version of a snapshot table
    (not from a raw file glob, which would also pick up superseded files).
    The extract is replaced atomically — published as a new overwrite
    version, so readers (:func:`read_extract`) see either the old or the new
    content, never a half-written one.  Returns the extract's version."""
    df = read_as_of(spark, versioned_root)
    if where:
        df = df.where(where)
    return publish(df, out_path, mode="overwrite", operation="EXTRACT",
                   parameters={"source": versioned_root, "where": where or ""})


def incremental_append(source: DataFrame, target_path: str, key: str) -> int:
    """Append the source rows whose ``key`` exceeds the target's current
    maximum; an absent target receives everything.  Rows with a NULL key have
    no place in the order: of these, later syncs append what the target does not
    hold yet, as a multiset (two equal rows in the source are two in the
    target).  Columns are aligned *by name* to the target's order.  Returns the number of rows appended
    (0 → nothing was written).

    The target is a snapshot-versioned table (:mod:`strata.sources.versions`)
    and each sync is an ``append`` version committed after its data is
    written.  A sync that dies part-way leaves files no version references,
    so the watermark of the retry still comes from committed data only and
    the retry appends exactly the missing rows — nothing is lost or doubled
    (a plain parquet append could expose part of a failed job's files and
    move the watermark past rows that were never written).  The watermark is
    one scalar aggregate over the key column; ``key > hw`` and ``key IS NULL`` are pushed
    into the scans, so files without NULL keys are skipped by their statistics.
    Read the extract with :func:`read_extract`.
    """
    spark, new = source.sparkSession, source
    if current_version(spark, target_path) is not None:
        target = read_as_of(spark, target_path)
        missing = [c for c in target.columns if c not in source.columns]
        if missing:
            raise ValueError(f"source lacks target columns {missing}")
        source = source.select(*target.columns)
        hw = target.agg(F.max(key).alias("hw")).first()["hw"]
        keyed = source.where(F.col(key).isNotNull() if hw is None else F.col(key) > F.lit(hw))
        no_key = F.col(key).isNull()
        new = keyed.unionByName(surplus(target.where(no_key), source.where(no_key)).select(*target.columns))
    if new.isEmpty():
        return 0
    return _publish(new, target_path, mode="append", operation="SYNC", parameters={"key": key})[1]


def read_extract(spark: SparkSession, target_path: str) -> DataFrame:
    """The committed content of an incrementally synced extract."""
    return read_as_of(spark, target_path)
