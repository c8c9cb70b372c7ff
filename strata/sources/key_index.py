"""Which stored batches may hold a key: a Bloom filter per batch, kept as a table.

A batch's filter is ``PROBES`` arrays of 64-bit words.  A key sets four bits of one
word in each array; the arrays have as many words as the batch's keys need, a power of two.
Stored sparsely, a filter is a table (size, probe, word, bits), so building one is a
``bit_or`` aggregate and asking is an equi-join: no filter is ever held
whole by a task or the driver, however many keys a batch has.

A key that was stored is always found; one that was not passes with a chance of some 1e-5
per batch.  :func:`unseen` therefore only uses the filters to tell which
batches need to be read, and compares keys with those exactly.

Filters are rebuilt from the batches themselves (:func:`refresh`), so one that is missing after
a crash, or because the index is newer than the table, is added before it is asked.

Rows with a NULL in their key equal no other row: they are never indexed, never dropped.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup_by_key
from .files import glob_dirs

PROBES, BITS_PER_KEY = 3, 12
INDEX_SCHEMA = "size int, probe int, word long, bits long"
_MASK_FROM = 40  # bits of a hash from here on choose bits of the word, those below the word


def _keyed(df: DataFrame, keys: Sequence[Column]) -> tuple[DataFrame, list[str]]:
    names = [f"__k{i}" for i in range(len(keys))]
    return df.withColumns(dict(zip(names, keys))), names


def _complete(names: Sequence[str]) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.col(n).isNotNull()
    return out


def _probes(names: Sequence[str], sizes: Sequence[int]) -> Column:
    """array of (size, probe, word, mask) of a key for filters of ``2 ** size`` words."""
    out = []
    for probe in range(PROBES):
        h = F.xxhash64(F.lit(probe), *names)
        mask = F.lit(0).cast("long")
        for j in range(4):
            at = F.shiftrightunsigned(h, _MASK_FROM + 6 * j).bitwiseAND(F.lit(63)).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
        out += [F.struct(F.lit(s).alias("size"), F.lit(probe).alias("probe"),
                         h.bitwiseAND(F.lit((1 << s) - 1)).alias("word"), mask.alias("mask")) for s in sizes]
    return F.array(*out)


def add(df: DataFrame, index_path: str, batch: str, keys: Sequence[Column]) -> None:
    """Store the filter of a batch; an earlier one of that name is replaced."""
    rows, names = _keyed(df, keys)
    rows = rows.select(*names).filter(_complete(names))
    n = rows.count()
    size = min(_MASK_FROM, max(0, math.ceil(math.log2(max(1, n * BITS_PER_KEY / 64)))))
    words = rows.select(F.explode(_probes(names, [size])).alias("p")).groupBy("p.size", "p.probe", "p.word").agg(
        F.bit_or("p.mask").alias("bits"))
    words.write.mode("overwrite").parquet(f"{index_path.rstrip('/')}/batch={batch}")


def refresh(spark: SparkSession, table_path: str, index_path: str, keys: Sequence[Column], batch_col: str = "ingest_run") -> list[str]:
    """Add the filters that are missing for batches of the table, laid out
    in folders ``.../<batch_col>=<batch>``.  Returns the batches added; only their names reach the driver."""
    there = {p.rsplit(f"{batch_col}=", 1)[1]: p for p in glob_dirs(spark, f"{table_path.rstrip('/')}/*/{batch_col}=*")}
    # a folder without this mark is of a write that never ended
    known = {p.rsplit("/", 2)[1].split("batch=", 1)[1] for p in glob_dirs(spark, f"{index_path.rstrip('/')}/batch=*/_SUCCESS")}
    new = sorted(there.keys() - known)
    for batch in new:  # as a rule none, or the one written last
        add(spark.read.parquet(there[batch]), index_path, batch, keys)
    return new


def candidates(df: DataFrame, index_path: str, keys: Sequence[Column]) -> DataFrame:
    """(batch, key columns ``__k0`` ...): the stored batches that may hold a key of ``df``."""
    spark = df.sparkSession
    rows, names = _keyed(df, keys)
    rows = rows.select(*names).filter(_complete(names)).distinct()
    if not glob_dirs(spark, f"{index_path.rstrip('/')}/batch=*/_SUCCESS"):
        return rows.select(F.lit("").alias("batch"), *names).limit(0)
    index = spark.read.schema(f"{INDEX_SCHEMA}, batch string").parquet(index_path)
    sizes = [r["size"] for r in index.select("size").distinct().collect()]  # at most _MASK_FROM + 1 numbers
    if not sizes:
        return rows.select(F.lit("").alias("batch"), *names).limit(0)
    asked = rows.select(*names, F.explode(_probes(names, sizes)).alias("p")).select(*names, "p.*")
    met = asked.join(index, ["size", "probe", "word"]).filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    return met.groupBy("batch", *names).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == PROBES).drop("n")


def batches_to_read(df: DataFrame, index_path: str, keys: Sequence[Column]) -> list[str]:
    """Names of the stored batches that may hold a key of ``df``."""
    return sorted(r["batch"] for r in candidates(df, index_path, keys).select("batch").distinct().collect())


def unseen(df: DataFrame, table_path: str, index_path: str, keys: Sequence[Column], batch_col: str = "ingest_run",
           stored_schema=None) -> DataFrame:
    """One row per key of ``df``, without keys that the table holds.

    Of equal keys in ``df`` the row that is largest stays (:func:`dedup_by_key`).  Only the
    batches that the filters name are scanned, and of these only the key's columns."""
    spark = df.sparkSession
    refresh(spark, table_path, index_path, keys, batch_col)
    named = batches_to_read(df, index_path, keys)
    rows, names = _keyed(df, keys)
    whole = rows.filter(~_complete(names))
    single = dedup_by_key(rows.filter(_complete(names)), names, [])
    if named:
        reader = spark.read if stored_schema is None else spark.read.schema(stored_schema)
        stored, _ = _keyed(reader.parquet(table_path).filter(F.col(batch_col).isin(named)), keys)
        single = single.join(stored.select(*names).filter(_complete(names)), names, "left_anti")
    return single.unionByName(whole).drop(*names)
