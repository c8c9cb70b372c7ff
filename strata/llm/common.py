"""What the operators of this subpackage share.

* :func:`materialise` writes an intermediate as Parquet under the shared folder
  (``spark.checkpoint.dir``) and reads it back.  It cuts lineage, survives lost
  executors, gives adaptive execution true sizes and, unlike a checkpoint,
  does not carry a partitioning over, so both sides of a later join get an
  exchange of their own that skew handling can split.
* :func:`map_rows` feeds a Python function Arrow batches cut to a few MB.

Conventions that hold for every operator here unless its docstring says more:
null text counts as empty; columns other than those an operator names are
carried along untouched or ignored, whatever their names; an empty table gives
an empty result with the same schema.
"""

from __future__ import annotations

import threading
import weakref
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# words are runs of digits, letters and non-ASCII characters; anything else separates
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128
                   else 32 for c in range(256))
WORD_PATTERN = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
SLICE_BYTES = 4 << 20
#: equal rows that one task unrolls at a time
CHUNK = 4096

_scratch: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_lock = threading.Lock()


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back from there."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    with _lock:
        _scratch.setdefault(spark.sparkContext, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_mark(spark: SparkSession) -> int:
    """A point to hand to :func:`clear_scratch` later."""
    return len(_scratch.get(spark.sparkContext, []))


def clear_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete intermediates written after ``since``, but for the last ``keep``; call it once
    their results have been written elsewhere."""
    with _lock:
        paths = _scratch.get(spark.sparkContext, [])
        end = max(since, len(paths) - keep)
        gone, paths[since:end] = paths[since:end], []
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in gone:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """A materialised ``df`` marked for broadcast if it has at most ``max_rows`` rows
    (of fixed width: the caller says so by choosing the bound), else as it is."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def number_within(rows: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "slot",
                  buckets: int | None = None) -> DataFrame:
    """``rows`` with ``out``: 0, 1, 2, ... without a gap in every group.

    A group may hold any share of the rows: it is numbered in ``buckets`` parts
    (by default as many as the session's shuffle partitions), each from its own
    start, which is a running sum over the parts' counts.  Rows alike in all of
    ``order`` share a part and get neighbouring numbers in no given order.
    """
    n = buckets or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = rows.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(n)).cast("int"))
    keys = [*group, "__part"]
    starts = (parted.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
              .withColumn("__start", F.coalesce(F.sum("__n").over(
                  W.partitionBy(*group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
              .drop("__n"))
    local = parted.withColumn("__local", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return (local.join(starts, keys)
            .withColumn(out, (F.col("__start") + F.col("__local") - 1).cast("long"))
            .drop("__part", "__start", "__local"))


def unrolled(rows: DataFrame, n: str, out: str = "k") -> DataFrame:
    """Every row ``n`` times, numbered from 0 in ``out``; the copies of a row are dealt to all
    tasks in chunks of :data:`CHUNK`.  ``rows`` is read twice, the second time for rows of many copies only."""
    def numbers(first, last):
        return F.explode(F.sequence(first, last))

    zero = F.lit(0).cast("long")
    few = rows.filter(F.col(n) <= CHUNK).withColumn(out, numbers(zero, F.col(n) - 1))
    many = rows.filter(F.col(n) > CHUNK).withColumn("__chunk", numbers(zero, F.floor((F.col(n) - 1) / CHUNK)))
    dealt = many.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__chunk")
    first = F.col("__chunk") * CHUNK
    return few.unionByName(dealt.withColumn(out, numbers(first, F.least(first + CHUNK, F.col(n)) - 1)).drop("__chunk"))


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def id_crc(col: str = "doc_id") -> Column:
    """CRC-32 of the id's decimal text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def held_out(col: str, folds: int) -> Column:
    return id_crc(col) % folds == 0


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def slices(batch: pa.RecordBatch, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of about ``size`` bytes; a longer row comes alone."""
    step = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: str) -> DataFrame:
    """``fn`` gets the columns of a few MB of rows as lists (text as UTF-8
    bytes) and returns columns of the result; one call never sees more than
    :data:`SLICE_BYTES` unless a single row is longer."""
    binary = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    names = [part.split()[0] for part in _split_schema(schema)]

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                cols = {n: part.column(i).cast(pa.binary()).to_pylist() if n in binary
                        else part.column(i).to_pylist() for i, n in enumerate(df_names)}
                out = fn(cols)
                if out is not None:
                    arrays = [out[n] for n in names]
                    yield pa.RecordBatch.from_arrays(
                        [a if isinstance(a, pa.Array) else pa.array(a, type=t)
                         for a, t in zip(arrays, types)], names=names)

    df_names = df.columns
    types = [_arrow_type(part.split(None, 1)[1]) for part in _split_schema(schema)]
    return df.mapInArrow(run, schema)


def _split_schema(schema: str) -> list[str]:
    return [p.strip() for p in schema.split(",")]


def _arrow_type(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(_arrow_type(name[6:-1]))
    return {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
            "string": pa.string(), "binary": pa.binary()}[name]
