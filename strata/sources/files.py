"""Raw-zone file discovery, the incremental-ingest manifest and schema-
enforced CSV reads.

Discovery uses Spark's own file listing (``binaryFile`` with the content
column pruned, so only path/size/mtime are read).  The manifest is a parquet
table of ingested paths; the set of files still to ingest is a ``left_anti``
join against it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException


def _binary(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root if isinstance(root, str) else list(root))


def list_files(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """(path, modificationTime, length) of every file under ``root``, or of a list of files."""
    return _binary(spark, root).select("path", "modificationTime", "length")


def discover(spark: SparkSession, root: str, patterns: Sequence[str] = (), suffix: str = ".csv",
             since: date | str | None = None) -> DataFrame:
    """Files under ``root`` whose path below ``root`` ends with ``suffix``
    (case-insensitive), contains any of ``patterns`` (lower-case match; empty
    = all) and was modified on or after the UTC day ``since``.  Folders above
    ``root`` are not matched, whatever their names."""
    files = list_files(spark, root)
    fs, hroot = _fs(spark, root)
    base = fs.makeQualified(hroot).toUri().getPath().rstrip("/") + "/"
    # what follows the scheme and authority, then what follows the root
    below = F.regexp_replace(F.col("path"), "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
    lp = F.lower(F.when(below.startswith(base), F.substring(below, F.lit(len(base) + 1), F.length(below)))
                 .otherwise(below))
    cond = lp.endswith(suffix.lower())
    if patterns:
        any_pat = F.lit(False)
        for p in patterns:
            any_pat = any_pat | lp.contains(p.lower())
        cond = cond & any_pat
    if since is not None:
        # "modified on or after day D" as an instant comparison with D 00:00 UTC,
        # independent of the session time zone (object stores report UTC)
        start = F.lit(f"{since} 00:00:00+00:00").cast("timestamp")
        cond = cond & (F.col("modificationTime") >= start)
    return files.filter(cond)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def glob_dirs(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a Hadoop glob (a listing, no data is read)."""
    fs, hpath = _fs(spark, pattern)
    return [st.getPath().toString() for st in (fs.globStatus(hpath) or [])]


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    schema = "path string, run_id string, ingested_at timestamp"
    if not _exists(spark, manifest_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(manifest_path)


def pending_files(spark: SparkSession, candidates: DataFrame, manifest_path: str) -> DataFrame:
    """Candidates not yet recorded in the manifest."""
    done = read_manifest(spark, manifest_path).select(normalize_path("path").alias("__done")).distinct()
    return candidates.join(done, normalize_path("path") == F.col("__done"), "left_anti")


def run_id_for(paths: Sequence[str]) -> str:
    """Deterministic run id of a set of files: a retried run over the same
    pending set reuses its id, so its bronze partition is overwritten rather
    than appended twice."""
    return hashlib.sha1("\n".join(sorted(paths)).encode()).hexdigest()[:16]


# Above this many paths a literal array costs more to analyse and optimise
# than shipping the list as a local frame.
_LITERAL_PATHS_MAX = 200


def path_frame(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The exact list of paths a run read (a file list, bounded by the files
    of one run) as a one-column frame, written as few files: a literal array
    in one partition for short lists, otherwise a local frame coalesced to
    about one partition per 500 K paths."""
    paths = list(paths)
    if len(paths) <= _LITERAL_PATHS_MAX:
        return (spark.range(1, numPartitions=1)
                .select(F.explode(F.array(*[F.lit(p) for p in paths]).cast("array<string>")).alias("path")))
    return spark.createDataFrame([(p,) for p in paths], "path string").coalesce(len(paths) // 500_000 + 1)


def record_ingested(spark: SparkSession, paths: DataFrame, manifest_path: str, run_id: str,
                    at: datetime | None = None) -> None:
    stamp = F.lit(at).cast("timestamp") if at is not None else F.current_timestamp()
    (paths.select("path").withColumn("run_id", F.lit(run_id)).withColumn("ingested_at", stamp)
          .write.mode("append").parquet(manifest_path))


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
             multiline: bool = False, header: bool = True, enforce_header: bool = True,
             infer_schema: bool = False, source_col: str | None = "source_file") -> DataFrame:
    """CSV read with a declared schema (or inference), ``"``-escaped quotes.

    * PERMISSIVE mode: a malformed cell becomes NULL, the row is kept.
    * ``enforce_header``: the header must name the schema's columns in order
      (Spark's ``enforceSchema=false`` check), so a reordered file is
      rejected instead of silently shifting values.
    * ``multiline`` allows quoted newlines but makes each file one split;
      keep it off for large files that do not need it.
    * ``source_col`` records each row's file via the hidden ``_metadata``
      column.
    """
    reader = (spark.read.option("header", header).option("escape", '"')
              .option("multiLine", multiline).option("mode", "PERMISSIVE"))
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", not enforce_header)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    df = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    if source_col:
        df = df.withColumn(source_col, F.col("_metadata.file_path"))
    return df


def files_with_line_breaks(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of ``paths`` in which a quoted cell goes on over a line's end.

    Quotes inside a quoted cell are doubled, so a line holds an odd number of
    quotes exactly if it ends, or begins, within a cell.  One scan of the
    files' lines; file names reach the driver."""
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), "value")
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    return [r["path"] for r in lines.filter(quotes % 2 == 1).select("path").distinct().collect()]


def read_csv_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType, multiline: bool | None = None,
                   **options) -> DataFrame:
    """:func:`read_csv` of the files at ``paths``.  ``multiline=None`` finds out which
    files hold cells with line breaks and reads those whole, the others in
    splits; ``True`` reads all whole without looking; ``False`` reads all in
    splits, and fails rather than cut a cell."""
    whole = set(paths) if multiline else {_bare(p) for p in files_with_line_breaks(spark, paths)}
    if multiline is False and whole:
        raise ValueError(f"quoted cells hold line breaks in {sorted(whole)[:5]}; read them with multiline")
    if not multiline:
        whole = {p for p in paths if _bare(p) in whole}
    parts = [read_csv(spark, sorted(some), schema, multiline=many, **options)
             for many, some in ((False, set(paths) - whole), (True, whole)) if some]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _bare(path: str) -> str:
    """A path in the one spelling that listings and file metadata share: decoded, ``file:/`` with one slash."""
    from urllib.parse import unquote
    return re.sub("^file:/+", "file:/", unquote(path))


def malformed_cells(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, multiline: bool = False) -> DataFrame:
    """(path, column, n_rows, n_malformed): per file and column of another type than text, the
    cells that hold something but become NULL under ``schema``.

    Every cell is read once, as text, and converted beside it; columns that
    are text anyway are not read."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    rows = read_csv(spark, paths, text, multiline=multiline, source_col="__path")
    bad = {f.name: F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull() for f in typed}
    counts = rows.groupBy("__path").agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(f"__n{i}") for i, c in enumerate(bad.values())])
    each = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"__n{i}").alias("n_malformed")) for i, n in enumerate(bad)])
    return counts.select(normalize_path("__path").alias("path"), "n_rows", F.explode(each).alias("c")).select(
        "path", "c.column", "n_rows", "c.n_malformed")


def safe_read(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
              **options) -> DataFrame | None:
    """Tolerant read for an optional input: a missing path gives ``None``
    (the channel is absent); every other error propagates.  A declared
    ``schema`` spares the footer scan of schema inference/merging."""
    try:
        reader = spark.read.format(fmt).options(**options)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def normalize_path(c):
    """``file:/x`` and ``file:///x`` spell the same file; use one form."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, "^file:/+", "file:///")


RANGE_BYTES = 64 << 20


def _store(path: str):
    """(file system, path) as Python reads them: plain and ``file:`` paths locally, others by their scheme."""
    from pyarrow import fs
    bare = re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in bare else (fs.LocalFileSystem(), bare)


def digests(spark: SparkSession, root: str | Sequence[str], suffix: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, n_ranges, digest) of every file under ``root``, of any size.

    A file is cut into ranges of ``range_bytes``.  The digest is the MD5 of the
    ranges' MD5s (hexadecimal, one after the other), so it depends on the
    content and ``range_bytes`` alone.  Files of one range go through Spark's
    binary reader; of longer ones each range is a row, read in small blocks by whatever task gets
    it, and only its digest goes on.  Spark's file listing leaves empty files out.
    """
    def hashed(batches):
        import hashlib

        import pyarrow as pa
        for batch in batches:
            for row in batch.to_pylist():
                store, path = _store(row["path"])
                md5, left = hashlib.md5(), row["n"]
                with store.open_input_file(path) as f:
                    f.seek(row["start"])
                    while left:
                        block = f.read(min(left, 4 << 20))
                        if not block:
                            raise OSError(f"{row['path']} has become shorter")
                        md5.update(block)
                        left -= len(block)
                yield pa.RecordBatch.from_pydict({"path": [row["path"]], "at": [row["at"]], "md5": [md5.hexdigest()]})

    files = _binary(spark, root)
    if suffix:
        files = files.filter(F.lower("path").endswith(suffix.lower()))
    one = files.filter(F.col("length") <= range_bytes).select("path", F.lit(0).cast("long").alias("at"), F.md5("content").alias("md5"))
    cut = files.filter(F.col("length") > range_bytes).select("path", "length").withColumn(
        "at", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {range_bytes}"))))
    start = F.col("at") * range_bytes
    ranges = cut.select("path", "at", start.alias("start"), F.least(F.lit(range_bytes).cast("long"), F.col("length") - start).alias("n"))
    # a range is as much work as a task should get
    dealt = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "at")
    parts = one.unionByName(dealt.mapInArrow(hashed, "path string, at long, md5 string"))
    # 32 characters a range: a terabyte is half a megabyte here
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "md5"))), lambda r: r["md5"]), "")
    return parts.groupBy(normalize_path("path").alias("path")).agg(
        F.count(F.lit(1)).alias("n_ranges"), F.md5(whole).alias("digest"))


def inventory(spark: SparkSession, root: str | Sequence[str], suffix: str | None = None,
              rows_per_file: DataFrame | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Raw-zone inventory: file name, size, mtime, number of ranges and digest
    of the content (:func:`digests`) and — if ``rows_per_file(path, n_rows)`` is given — the
    ingested row count and a status (``ingested`` / ``pending``)."""
    files = list_files(spark, root)
    if suffix:
        files = files.filter(F.lower("path").endswith(suffix.lower()))
    out = files.select(normalize_path("path").alias("path"),
                       F.element_at(F.split("path", "/"), -1).alias("file_name"),
                       F.col("length").alias("size_bytes"),
                       F.col("modificationTime").alias("modified_at")).join(digests(spark, root, suffix, range_bytes), "path")
    if rows_per_file is not None:
        counts = rows_per_file.select(normalize_path("path").alias("path"), "n_rows")
        out = (out.join(counts, "path", "left")
                  .withColumn("status", F.when(F.col("n_rows").isNull(), "pending").otherwise("ingested")))
    return out
