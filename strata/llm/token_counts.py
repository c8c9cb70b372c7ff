"""Token counts from flat token files by separator scan.

A flat file is token ids back to back (unsigned 16 bits, little-endian), every
document followed by an end-of-document id, with no index.  Files are cut into
blocks of fixed size that tasks read by range.  A block is compared
with the separator as one array; what it finds are places within the block.
A prefix scan over the blocks stitches them: the running sum of separators
numbers documents, the running maximum of separator places tells where the
document that crosses a block's start began.  Both scans run in two levels
(within groups of ``GROUP`` blocks, then over the groups), so a file of any
length is spread over tasks.

:func:`write_flat` makes such files from documents.  A task names its files by
chance and only rows of tasks that succeeded name them again, so a lost
executor leaves at worst files that nobody reads.

Defined results: a null or empty text has no tokens; ids after a file's last
separator are a document of their own, marked not ``closed``; an empty file has no documents.
"""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import _lock, _scratch, materialise, slices
from .tokenise import word_ids

BLOCK_TOKENS, FILE_TOKENS, GROUP = 1 << 22, 1 << 28, 1024


def _store(uri: str):
    """(file system, path) of a folder or file; plain paths and file: are the local mount."""
    from pyarrow import fs
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path
    return fs.FileSystem.from_uri(uri)


def write_flat(docs: DataFrame, folder: str, tokenizer: str, end_id: int, file_tokens: int = FILE_TOKENS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes token files under ``folder`` (shared by all executors) and returns what
    they were made of: (file, ordinal, doc_id), evaluated once."""
    if not 0 <= end_id < 1 << 16:
        raise ValueError("token files hold ids of 16 bits")
    end = np.array([end_id], "<u2").tobytes()
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        store, root = _store(folder)
        ids = word_ids(tokenizer, literal=True)
        name = out = None
        ordinal = written = 0
        try:
            for batch in batches:
                for part in slices(batch):
                    rows: dict = {"file": [], "ordinal": [], "doc_id": part.column(0).to_pylist()}
                    for tokens in ids.encode(part.column(1).cast(pa.binary()).to_pylist()):
                        if out is None or written >= file_tokens:
                            if out is not None:
                                out.close()
                            name, ordinal, written = uuid.uuid4().hex + ".tokens", 0, 0
                            out = store.open_output_stream(f"{root}/{name}")
                        own = np.frombuffer(tokens, "<u4")
                        if own.size and (own.max() >= 1 << 16 or (own == end_id).any()):
                            raise ValueError("a text has ids beyond 16 bits, or the end id itself")
                        data = own.astype("<u2").tobytes() + end
                        out.write(data)
                        rows["file"].append(name)
                        rows["ordinal"].append(ordinal)
                        ordinal += 1
                        written += len(data) // 2
                    yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(
                        [("file", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64())]))
        finally:
            if out is not None:
                out.close()

    store, root = _store(folder)
    store.create_dir(root)
    return materialise(slim.mapInArrow(run, "file string, ordinal long, doc_id long"), "token-order")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, file, n_tokens) of the token files in a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file"),
                        (F.col("length") / 2).cast("long").alias("n_tokens"))


def scan_blocks(files: DataFrame, end_id: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, n_tokens, ends): the places of separators in each block of each file."""
    n = F.ceil(F.col("n_tokens") / block_tokens).cast("long")
    cut = (files.filter("n_tokens > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
           .select("path", "file", "block", F.least(F.lit(block_tokens).cast("long"), F.col("n_tokens") - F.col("block") * block_tokens).alias("n_tokens")))
    dealt = cut.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file", "block")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                store, path = _store(row["path"])
                with store.open_input_file(path) as f:
                    data = f.read_at(row["n_tokens"] * 2, row["block"] * block_tokens * 2)
                ends = np.flatnonzero(np.frombuffer(data, "<u2") == end_id)
                yield pa.RecordBatch.from_pydict(
                    {"file": [row["file"]], "block": [row["block"]], "n_tokens": [row["n_tokens"]], "ends": [ends]},
                    schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("n_tokens", pa.int64()),
                                      ("ends", pa.list_(pa.int64()))]))

    return dealt.mapInArrow(run, "file string, block long, n_tokens long, ends array<long>")


def stitch(blocks: DataFrame, block_tokens: int = BLOCK_TOKENS, group: int = GROUP) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed), a row per document of each file.

    ``blocks`` is read several times: write it out first."""
    at = F.col("block") * block_tokens
    each = blocks.select("file", "block", F.floor(F.col("block") / group).alias("group"),
                         F.size("ends").cast("long").alias("n"),
                         (at + F.get("ends", F.size("ends") - 1)).alias("last"), (at + F.col("n_tokens")).alias("size"))
    groups = each.groupBy("file", "group").agg(F.sum("n").alias("n"), F.max("last").alias("last"))

    def before(*keys, order):  # what lies ahead of a row: separators, and the place of the last one
        w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(w), F.lit(0)), F.max("last").over(w)

    n, last = before("file", order="group")
    groups = groups.select("file", "group", n.alias("g_n"), last.alias("g_last"))
    n, last = before("file", "group", order="block")
    stitched = each.select("file", "group", "block", n.alias("b_n"), last.alias("b_last")).join(groups, ["file", "group"])
    carried = stitched.select("file", "block", (F.col("g_n") + F.col("b_n")).alias("ordinal"),
                              (F.coalesce("b_last", "g_last", F.lit(-1)) + 1).alias("open"))
    ends = blocks.select("file", "block", F.expr(
        f"transform(ends, (e, i) -> struct(i as i, block * {block_tokens} + e as stop, "
        f"if(i > 0, block * {block_tokens} + ends[i - 1] + 1, null) as start))").alias("docs"))
    found = ends.join(carried, ["file", "block"]).select("file", "ordinal", "open", F.explode_outer("docs").alias("d")).filter("d is not null")
    closed = found.select("file", (F.col("ordinal") + F.col("d.i")).alias("ordinal"),
                          F.coalesce("d.start", "open").alias("start"), F.col("d.stop").alias("stop"))
    whole = each.groupBy("file").agg(F.sum("n").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"),
                                     F.max("size").alias("stop")).filter("start < stop")
    return closed.withColumn("closed", F.lit(True)).unionByName(whole.withColumn("closed", F.lit(False))).select(
        "file", "ordinal", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "closed")


def count(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_tokens) of every row of ``docs``, by way of flat token files."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "llm-tokens")
    with _lock:
        _scratch.setdefault(spark.sparkContext, []).append(folder)
    order = write_flat(docs, folder, tokenizer, end_id, id_col=id_col, text_col=text_col)
    if order.isEmpty():
        return order.select("doc_id", F.lit(0).cast("long").alias("n_tokens"))
    written = order.select("file").distinct()  # files of tasks that failed are not in it
    blocks = materialise(scan_blocks(list_files(spark, folder).join(written, "file", "left_semi"), end_id, block_tokens),
                         "token-blocks")
    return order.join(stitch(blocks, block_tokens), ["file", "ordinal"]).select("doc_id", "n_tokens")
