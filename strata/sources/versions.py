"""Snapshot-versioned tables over plain parquet (user-level time travel).

Layout under ``root``::

    data/version=N/part-*.parquet   files written by version N
    _versions/                      commit log, one parquet row per commit:
        version int, data_versions array<int>, committed_at timestamp_ntz,
        operation string, parameters string, num_rows bigint,
        schema_json string (the version's columns: reads use it instead of
        scanning file footers to infer or merge the schema)

A version's content is the union of the data directories listed in its
``data_versions``: an overwrite lists only its own directory, an append lists
the previous version's directories plus its own, and a restore re-lists an
older version's directories without copying any data.  Writing the log row is
the commit point, so a crashed publish leaves an orphan directory that no
version references (and that the next publish of the same number replaces).
Single writer per table is assumed; a table format such as Delta lifts that.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import _exists, glob_dirs

LOG_SCHEMA = ("version int, data_versions array<int>, committed_at timestamp_ntz, "
              "operation string, parameters string, num_rows bigint, schema_json string")


def _log_path(root: str) -> str:
    return f"{root.rstrip('/')}/_versions"


def _data_path(root: str, v: int) -> str:
    return f"{root.rstrip('/')}/data/version={v}"


def history(spark: SparkSession, root: str) -> DataFrame:
    """Commit log, newest first."""
    if not _exists(spark, _log_path(root)):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(_log_path(root)).orderBy(F.desc("version"))


def _latest(spark: SparkSession, root: str, version: int | None = None, timestamp: datetime | str | None = None):
    """The log row of a version / of the latest commit at or before a time / of the
    current version, or None.  Only that row reaches the driver."""
    if not _exists(spark, _log_path(root)):
        return None
    rows = (spark.read.schema(LOG_SCHEMA).parquet(_log_path(root))
            .select("version", "data_versions", "committed_at", "num_rows", "schema_json"))
    if version is not None:
        rows = rows.where(F.col("version") == version)
    if timestamp is not None:
        t = datetime.fromisoformat(str(timestamp)) if not isinstance(timestamp, datetime) else timestamp
        rows = rows.where(F.col("committed_at") <= F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz"))
    return rows.orderBy(F.desc("version")).limit(1).first()


def _resolve(spark: SparkSession, root: str, version: int | None = None, timestamp: datetime | str | None = None):
    row = _latest(spark, root, version, timestamp)
    if row is None:
        raise ValueError(f"no version of {root} matches version={version} timestamp={timestamp}")
    return row


def current_version(spark: SparkSession, root: str) -> int | None:
    row = _latest(spark, root)
    return None if row is None else row["version"]


def _commit(spark: SparkSession, root: str, version: int, data_versions: list[int], operation: str,
            parameters: dict, num_rows: int, at: datetime | None, schema_json: str | None = None) -> None:
    at = at or datetime.now(timezone.utc).replace(tzinfo=None)
    # the row is built from literals in one single-partition frame: one
    # small file per commit, no Python-side data transfer
    row = spark.range(1, numPartitions=1).select(
        F.lit(version).cast("int").alias("version"),
        F.array(*[F.lit(v).cast("int") for v in data_versions]).alias("data_versions"),
        # UTC as a naive value: independent of zones and of clock changes
        F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz").alias("committed_at"),
        F.lit(operation).alias("operation"),
        F.lit(json.dumps(parameters, sort_keys=True)).alias("parameters"),
        F.lit(num_rows).cast("long").alias("num_rows"),
        F.lit(schema_json).cast("string").alias("schema_json"))
    row.write.mode("append").parquet(_log_path(root))


def _merged_schema(prev: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of an appended version: the previous ones, then new ones.  A
    column may not change its type between the parts of one version."""
    known = {f.name: f for f in prev.fields}
    fields = [T.StructField(f.name, f.dataType, True) for f in prev.fields]
    for f in new.fields:
        if f.name in known:
            if known[f.name].dataType != f.dataType:
                raise ValueError(f"append changes the type of {f.name!r}: "
                                 f"{known[f.name].dataType.simpleString()} -> {f.dataType.simpleString()}")
        else:
            fields.append(T.StructField(f.name, f.dataType, True))
    return T.StructType(fields)


def _schema_of(row) -> T.StructType | None:
    js = row["schema_json"]
    return T.StructType.fromJson(json.loads(js)) if js else None


def _layout(spark: SparkSession, root: str, v: int) -> tuple[str, ...]:
    """Partition columns of a version's files, read off its folder names."""
    names, pattern = [], f"{_data_path(root, v)}/*=*"
    while dirs := glob_dirs(spark, pattern):
        names.append(dirs[0].rstrip("/").rsplit("/", 1)[1].split("=", 1)[0])
        pattern += "/*=*"
    return tuple(names)


def publish(df: DataFrame, root: str, mode: str = "overwrite", operation: str | None = None,
            parameters: dict | None = None, at: datetime | None = None,
            partition_by: tuple[str, ...] = ()) -> int:
    """Write ``df`` as the next version (``overwrite`` replaces the content,
    ``append`` adds to it).  Returns the new version number.  The row count
    in the log is observed during the write itself (no extra job).
    ``partition_by`` lays the version's files out in ``col=value``
    directories, so later equality filters on those columns prune files; an
    append keeps the layout of the version it extends."""
    return _publish(df, root, mode, operation, parameters, at, partition_by)[0]


def _publish(df: DataFrame, root: str, mode: str = "overwrite", operation: str | None = None,
             parameters: dict | None = None, at: datetime | None = None,
             partition_by: tuple[str, ...] = ()) -> tuple[int, int]:
    """:func:`publish`, returning ``(version, rows written)``."""
    spark = df.sparkSession
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    last = _latest(spark, root)
    v = 0 if last is None else last["version"] + 1
    # the version's content and columns are settled before any data is
    # written, so a rejected append writes nothing
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    prev = last if mode == "append" else None
    if prev is not None:
        # the parts of one version share a folder layout, else they can't be read together
        layout = _layout(spark, root, prev["data_versions"][0])
        if partition_by and tuple(partition_by) != layout:
            raise ValueError(f"the table is laid out by {layout}, not by {tuple(partition_by)}")
        partition_by = layout
        prev_schema = _schema_of(prev)
        schema = _merged_schema(prev_schema, schema) if prev_schema is not None else None
    obs = Observation(f"publish_{v}_{uuid.uuid4().hex[:12]}")  # unique within any plan
    w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(_data_path(root, v))
    n = obs.get["n"]
    if prev is not None:
        dvs, total = list(prev["data_versions"]) + [v], prev["num_rows"] + n
    else:
        dvs, total = [v], n
    _commit(spark, root, v, dvs, operation or mode.upper(), parameters or {}, total, at,
            schema.json() if schema is not None else None)
    return v, n


def read_as_of(spark: SparkSession, root: str, version: int | None = None,
               timestamp: datetime | str | None = None) -> DataFrame:
    """Read a version (by number, by time, or the current one).  Only the
    referenced ``version=`` directories are listed and scanned."""
    row = _resolve(spark, root, version, timestamp)
    paths = [_data_path(root, k) for k in row["data_versions"]]
    schema = _schema_of(row)
    if schema is not None:
        # the schema recorded at commit: no footer scan to infer or merge it
        if len(paths) > 1 and _layout(spark, root, row["data_versions"][0]):
            # folders of values under several roots can't be told apart in one read
            return reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(p).select(*schema.names) for p in paths])
        return spark.read.schema(schema).parquet(*paths)
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def _replicate(df: DataFrame, count_col: str, chunk: int = 1024) -> DataFrame:
    """Each row repeated ``count_col`` times.  Copies are generated in two
    levels: chunks of at most ``chunk`` are dealt to all tasks before they are
    unrolled, so a row with millions of copies neither builds one huge array
    nor keeps one task busy."""
    n = F.col(count_col)
    chunks = df.withColumn("__c", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / chunk).cast("long"))))
    size = F.least(F.lit(chunk).cast("long"), n - F.col("__c") * chunk)
    chunks = chunks.repartition("__c", *[F.col(f"`{c}`") for c in df.columns])
    return (chunks.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), size)))
                  .drop("__c", "__i", count_col))


def changes(spark: SparkSession, root: str, old: int, new: int, change_col: str = "change") -> DataFrame:
    """Multiset difference of two versions in one pass: rows of ``new`` not
    in ``old`` (``added``) and rows of ``old`` not in ``new`` (``removed``),
    each repeated by its surplus count — ``exceptAll`` in both directions.

    Both versions are scanned once and shuffled once: a union tagged by side,
    one hash aggregate over all columns (partial phase first, so a row
    repeated a third of the table collapses map-side), then the surplus
    copies are regenerated.
    """
    a, b = read_as_of(spark, root, old), read_as_of(spark, root, new)
    g = _balance(a, b)
    surplus = (g.where(F.col("__n") != 0)
                .withColumns({change_col: F.when(F.col("__n") > 0, F.lit("added")).otherwise(F.lit("removed")),
                              "__n": F.abs("__n")}))
    return _replicate(surplus, "__n")


def _balance(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every different row of the two with ``__n``: how many more of it ``new``
    holds.  Columns present on only one side are NULL on the other."""
    u = (old.withColumn("__n", F.lit(-1)).unionByName(new.withColumn("__n", F.lit(1)), allowMissingColumns=True))
    return u.groupBy(*[F.col(f"`{c}`") for c in u.columns if c != "__n"]).agg(F.sum("__n").alias("__n"))


def surplus(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` beyond those ``old`` holds, as a multiset (NULLs compare equal)."""
    return _replicate(_balance(old, new).where(F.col("__n") > 0), "__n")


def diff(spark: SparkSession, root: str, old: int, new: int) -> tuple[DataFrame, DataFrame]:
    """(rows added in ``new``, rows removed since ``old``) as multisets."""
    ch = changes(spark, root, old, new, "__change")
    return (ch.where(F.col("__change") == "added").drop("__change"),
            ch.where(F.col("__change") == "removed").drop("__change"))


def restore(spark: SparkSession, root: str, version: int | None = None,
            timestamp: datetime | str | None = None, at: datetime | None = None) -> int:
    """Make an older version current again by committing a new version that
    points at the old data directories (metadata only, no copy)."""
    row = _resolve(spark, root, version, timestamp)
    v = current_version(spark, root) + 1
    _commit(spark, root, v, list(row["data_versions"]), "RESTORE",
            {"version": row["version"]}, row["num_rows"], at, row["schema_json"])
    return v
