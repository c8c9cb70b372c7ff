"""Join helpers: a broadcast that is only taken behind a measured size."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_root

# Default ceilings for a broadcast side.  A broadcast table is collected on
# the driver and copied to every executor, so it is bounded both in rows and
# in measured bytes (the in-memory hash relation is roughly twice the raw
# bytes counted here).
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
                T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
                T.TimestampNTZType: 8, T.DecimalType: 16}


def _value_bytes(name: str, dt: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
    width = _FIXED_WIDTH.get(type(dt))
    if width is not None:
        return F.lit(width).cast("long")
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        # nested values: their JSON text length is a close upper estimate
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)).cast("long")
    return F.lit(16).cast("long")  # other scalars (intervals, time): at most 16 bytes


def row_bytes(df: DataFrame) -> Column:
    """Per-row byte size: fixed widths for primitive types, actual lengths
    for strings/binary (8 bytes of row header included)."""
    total = F.lit(8).cast("long")
    for f in df.schema.fields:
        total = total + _value_bytes(f.name, f.dataType)
    return total


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Materialise ``df`` once (reliable checkpoint in the shared folder, which
    also cuts its lineage) while observing its row count and byte size in the
    same job, and mark it for broadcast only if both are within bounds.
    Above a bound the checkpointed frame is returned unhinted, so the join
    falls back to a shuffle join (see ``enrich`` for its hot-key split).

    Returns ``(frame, broadcasted)``.
    """
    shared_root(df.sparkSession)  # ensure a checkpoint dir exists (shared on a cluster)
    obs = Observation(f"broadcast_check_{uuid.uuid4().hex[:8]}")
    measured = df.observe(obs, F.count(F.lit(1)).alias("n"),
                          F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"))
    materialised = measured.checkpoint(eager=True)
    m = obs.get
    if m["n"] <= max_rows and m["bytes"] <= max_bytes:
        return F.broadcast(materialised), True
    return materialised, False
