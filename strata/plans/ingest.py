"""Raw → bronze ingestion job for one dataset."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import normalize_columns
from ..operators.dedup import drop_all_null_rows, drop_exact_duplicates
from ..sources import files as FS
from ..sources import key_index as KI
from ..sources import schema_drift as SD
from ..sources.tables import overwrite_partitions


def ingest_dataset(spark: SparkSession, raw_root: str, patterns: Sequence[str], schema: T.StructType,
                   bronze_path: str, manifest_path: str, channel: str, load_date: date | str,
                   since: date | str | None = None, dedup_scope: str = "file",
                   multiline: bool | None = None, trim_cols: Sequence[str] = (),
                   natural_key: Sequence[Column] = (), inventory_path: str | None = None,
                   schema_path: str | None = None) -> int:
    """Discover new CSV files, read them against ``schema`` (header checked),
    normalise column names, drop duplicates and all-NULL rows, tag channel
    and load date, write bronze, then record the files in the manifest.
    With ``natural_key`` (columns of the bronze table, or expressions over
    them) a row whose key bronze holds already, or that equals another of the same run in it, is
    dropped; which bronze partitions are read for that is told by their key
    filters (:mod:`strata.sources.key_index`) under ``<bronze_path>_keys``.

    ``inventory_path`` gets a row per file of the run (:func:`record_inventory`),
    of a run that failed too; ``schema_path`` a snapshot of the columns written
    (:mod:`strata.sources.schema_drift`).

    Idempotent: a run's rows are one bronze partition ``(load_date,
    ingest_run)``, which appears when its write commits.  A run that died
    between that and the manifest update is completed first
    (:func:`adopt_unrecorded_runs`), so its files are neither read again nor
    lost, whatever ``since`` says and even if the manifest is gone.  Returns
    the number of rows that became part of the table (0 = nothing new), those
    of completed runs included.
    """
    adopted = adopt_unrecorded_runs(spark, bronze_path, manifest_path)
    pending = FS.pending_files(spark, FS.discover(spark, raw_root, patterns, ".csv", since),
                               manifest_path).select("path")
    # The pending *file list* (not data) goes to the driver to build the read.
    paths = sorted(r["path"] for r in pending.collect())
    if not paths:
        return adopted
    run_id = FS.run_id_for(paths)
    try:
        written = _ingest_files(spark, paths, run_id, schema, bronze_path, manifest_path, channel, load_date, dedup_scope,
                                multiline, trim_cols, natural_key, schema_path)
    except Exception:
        if inventory_path:
            record_inventory(spark, paths, None, inventory_path, run_id)
        raise
    if inventory_path:
        record_inventory(spark, paths, bronze_path, inventory_path, run_id)
    return adopted + written


def _ingest_files(spark, paths, run_id, schema, bronze_path, manifest_path, channel, load_date, dedup_scope, multiline,
                  trim_cols, natural_key, schema_path) -> int:
    df = normalize_columns(FS.read_csv_files(spark, paths, schema, multiline, source_col="_source_file"))
    df = drop_all_null_rows(drop_exact_duplicates(df, dedup_scope, "source_file"),
                            exclude=("source_file",))
    if trim_cols:
        df = df.withColumns({c: F.trim(c) for c in trim_cols if c in df.columns})
    if natural_key:
        df = KI.unseen(df, bronze_path, f"{bronze_path.rstrip('/')}_keys", natural_key)
    df = df.withColumns({"channel": F.lit(channel),
                         "load_date": F.lit(str(load_date)).cast("date"),
                         "ingest_run": F.lit(run_id)})
    obs = Observation(f"ingest_{channel}_{run_id}")
    overwrite_partitions(df.observe(obs, F.count(F.lit(1)).alias("n")), bronze_path,
                         ["load_date", "ingest_run"])
    if schema_path:
        SD.record(df, schema_path, channel, run_id, datetime.now(timezone.utc))
    FS.record_ingested(spark, FS.path_frame(spark, paths), manifest_path, run_id)
    return obs.get["n"]


def record_inventory(spark: SparkSession, paths: Sequence[str], bronze_path: str | None, inventory_path: str, run_id: str) -> None:
    """A row per file of a run: file_name, ingest_timestamp, row_count (rows of bronze, 0 for a file whose
    rows were all dropped), file_size_mb, digest, n_ranges and status SUCCESS, or FAILED
    without a row count where ``bronze_path`` is None.  A retried run replaces its own rows."""
    out = FS.inventory(spark, paths)
    if bronze_path is None:
        counted = out.withColumns({"row_count": F.lit(None).cast("long"), "status": F.lit("FAILED")})
    else:
        # only the lineage column of this run's partitions
        rows = (spark.read.parquet(bronze_path).where(F.col("ingest_run") == run_id)
                .groupBy(FS.normalize_path("source_file").alias("path")).agg(F.count(F.lit(1)).alias("n")))
        counted = out.join(rows, "path", "left").withColumns(
            {"row_count": F.coalesce("n", F.lit(0).cast("long")), "status": F.lit("SUCCESS")})
    (counted.select("path", "file_name", F.current_timestamp().alias("ingest_timestamp"), "row_count",
                    F.round(F.col("size_bytes") / 1e6, 6).alias("file_size_mb"), "digest", "n_ranges", "status")
     .write.mode("overwrite").parquet(f"{inventory_path.rstrip('/')}/run={run_id}"))


def adopt_unrecorded_runs(spark: SparkSession, bronze_path: str, manifest_path: str) -> int:
    """Record the files of committed bronze partitions that the manifest does
    not know.  Nothing is deleted: the rows are there, only the note of their
    files is missing, and it is rebuilt from the lineage column of those
    partitions alone.  A file that left no row is simply read again.  Returns
    the number of their rows; a single writer per bronze table is assumed."""
    dirs = FS.glob_dirs(spark, f"{bronze_path.rstrip('/')}/*/ingest_run=*")
    if not dirs:
        return 0
    runs = spark.createDataFrame([(p.rsplit("ingest_run=", 1)[1], p) for p in dirs], "run_id string, dir string")
    unknown = runs.join(FS.read_manifest(spark, manifest_path).select("run_id"), "run_id", "left_anti").collect()
    rows = 0
    for r in unknown:  # as a rule none, or the one run that died
        lineage = spark.read.schema("source_file string").parquet(r["dir"])
        FS.record_ingested(spark, lineage.select(FS.normalize_path("source_file").alias("path")).distinct(),
                           manifest_path, r["run_id"])
        rows += lineage.count()
    return rows
