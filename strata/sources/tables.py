"""Table writers: partitioned append with schema evolution, full overwrite,
idempotent per-run partition overwrite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ("load_date",)) -> None:
    """Append partitioned parquet; columns may grow between runs (read back
    with :func:`read_evolving`)."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite): the
    write is idempotent for a fixed partition value such as a run id."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full replacement.  Never point this at a path the same plan reads;
    publish a new snapshot version instead (``strata.sources.versions``)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read a table whose files carry different column sets (schema merge)."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], n_buckets: int, path: str) -> DataFrame:
    """Lay ``df`` out once as a catalog table hash-bucketed (and sorted) by
    ``keys`` in ``n_buckets`` files per writer, stored at ``path`` (a shared
    folder).  Joins between tables bucketed on the join keys with the same
    bucket count then read co-partitioned files and need no shuffle — worth it
    for inputs that are joined repeatedly, such as lines and their orders.
    The table lives in the session's catalog (persistent with a metastore).
    Returns the table."""
    (df.write.mode("overwrite").bucketBy(n_buckets, *keys).sortBy(*keys)
       .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)
