"""Stateless event stream: JSON messages → typed rows → idempotent
micro-batch sink.

Source: Kafka in deployment (``kafka_source``); any file source in tests
(no Kafka connector on this machine).  Each micro-batch is written to
``<sink>/batch_id=<epoch>/`` with dynamic partition overwrite, so a batch
replayed after a failure (same epoch id from the checkpoint) replaces its
own output instead of duplicating it: effectively-once delivery.  Sink
errors propagate, so a failed batch is not committed to the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.json import parse_json


def kafka_source(spark: SparkSession, bootstrap: str, topic: str, max_offsets_per_trigger: int | None = None,
                 starting_offsets: str = "earliest", fail_on_data_loss: bool = True) -> DataFrame:
    """Kafka subscription (needs the spark-sql-kafka connector on the classpath).

    The defaults lose nothing: the backlog is read, lost offsets are an error,
    a trigger takes what is there.  A deployment that wants a dashboard's
    leniency passes ``starting_offsets="latest"``, ``fail_on_data_loss=False``
    and a cap per trigger."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger is not None:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load()


def file_source(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


# Fixed value: timestamp text format of the messages (microsecond precision)
MESSAGE_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_OPTIONS = {"timestampFormat": MESSAGE_TIMESTAMP_FORMAT,
                "timestampNTZFormat": MESSAGE_TIMESTAMP_FORMAT}


def to_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Rows → one JSON text message per row (the producer-side encoding)."""
    return df.select(F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias(value_col))


def parse_messages(raw: DataFrame, schema: T.StructType | str, key: str,
                   value_col: str = "value") -> DataFrame:
    """``from_json(value)`` → flatten ``data.*`` → drop rows without ``key``.
    Bad fields become NULL; rows are dropped only when the key is missing."""
    return (raw.select(parse_json(F.col(value_col), schema, JSON_OPTIONS).alias("data"))
               .select("data.*")
               .filter(F.col(key).isNotNull()))


def idempotent_batch_writer(sink_path: str, batch_col: str = "batch_id"):
    """foreachBatch function writing each micro-batch to its own partition.
    An empty micro-batch writes no partition: a dynamic overwrite only
    touches partitions that it has rows for."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        (batch.withColumn(batch_col, F.lit(epoch_id).cast("long"))
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(batch_col).parquet(sink_path))
    return write


def start(parsed: DataFrame, sink_path: str, checkpoint: str, processing_time: str | None = "5 seconds",
          available_now: bool = False, name: str | None = None, sink: str = "batches") -> StreamingQuery:
    """Start the append stream.  ``available_now`` drains what is there and
    stops (tests, back-fills); otherwise a processing-time trigger.

    ``sink="batches"``: ``foreachBatch`` with :func:`idempotent_batch_writer`
    (one partition per epoch, replaced on replay) — the shape of a sink into
    an external store.  ``sink="files"``: Spark's parquet file sink, whose
    own compacted ``_spark_metadata`` log makes the output exactly-once —
    readers of the directory see only files of committed batches, even
    while a failed batch waits for its replay."""
    w = parsed.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if sink == "files":
        w = w.format("parquet").option("path", sink_path)
    elif sink == "batches":
        w = w.foreachBatch(idempotent_batch_writer(sink_path))
    else:
        raise ValueError("sink must be 'batches' or 'files'")
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def split_messages(raw: DataFrame, schema: T.StructType | str, key: str, value_col: str = "value") -> DataFrame:
    """Every message once: ``data`` (parsed) and ``value``, with ``reason`` NULL for a row with a
    key, else why it is a dead letter: ``empty`` (no message), ``unparsable`` (no JSON object) or ``no_key``."""
    data = parse_json(F.col(value_col), schema, JSON_OPTIONS)
    # an object parses as a map whatever its fields; anything else does not
    is_object = F.get_json_object(F.col(value_col), "$").startswith("{")
    reason = (F.when(F.col(value_col).isNull() | (F.trim(value_col) == ""), "empty")
               .when(~F.coalesce(is_object, F.lit(False)), "unparsable")
               .when(data.getField(key).isNull(), "no_key"))
    return raw.select(F.col(value_col).alias("value"), data.alias("data"), reason.alias("reason"))


def start_with_dead_letters(split: DataFrame, sink_path: str, checkpoint: str, processing_time: str | None = "5 seconds",
                            available_now: bool = False) -> StreamingQuery:
    """Start the stream of :func:`split_messages` into two tables under ``sink_path``: rows and dead letters.

    A micro-batch is written by one job into the partitions (kind, batch_id), and the
    partitions of an epoch are replaced together when that job commits.  A replay after a kill at
    any moment therefore leaves each message in exactly one of the two, once."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        kind = F.when(F.col("reason").isNull(), "rows").otherwise("dead")
        (batch.withColumns({"value": F.when(F.col("reason").isNotNull(), F.col("value")), "kind": kind,
                            "batch_id": F.lit(epoch_id).cast("long")})
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("kind", "batch_id").parquet(sink_path))

    w = split.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def read_rows(spark: SparkSession, sink_path: str) -> DataFrame:
    return spark.read.parquet(sink_path).where("kind = 'rows'").select("data.*")


def read_dead_letters(spark: SparkSession, sink_path: str) -> DataFrame:
    return spark.read.parquet(sink_path).where("kind = 'dead'").select("value", "reason", "batch_id")


def read_sink(spark: SparkSession, sink_path: str, batch_col: str = "batch_id") -> DataFrame:
    return spark.read.parquet(sink_path).drop(batch_col)
