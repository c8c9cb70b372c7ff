"""Sharding by weighted rendezvous hashing, in DataFrame functions only.

Every record draws one number per shard from a hash of its key and the shard
number, and goes to the shard with the best draw.  A shard that is added only
competes for records: a record either stays or moves to the new shard.  With
weights ``w`` the draw is ``w / -ln(u)``, which gives shard ``i`` a share of
``w[i] / sum(w)`` of the keys.

Records with equal keys share a shard.  A null key is replaced by a hash of
the text, so rows without an id still spread out.  Shares are of keys, so one
key with a third of all rows puts that third on its shard: that is what
placement by key means.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

_U = float(1 << 53)


def draw(key: Column, shard: int, weight: float = 1.0) -> Column:
    """The draw of ``key`` for ``shard``: exponential race with rate ``weight``."""
    h = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
    return F.lit(float(weight)) / -F.log((h + F.lit(0.5)) / F.lit(_U))


def rendezvous(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    """struct(draw, shard) of the winning shard among ``first`` .. ``first + len(weights) - 1``;
    equal draws go to the larger shard number."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    each = [F.struct(draw(key, first + i, w).alias("draw"), F.lit(first + i).alias("shard"))
            for i, w in enumerate(weights)]
    return F.greatest(*each) if len(each) > 1 else each[0]


def record_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id where there is one, else a hash of the text."""
    return F.coalesce(F.xxhash64(F.col(id_col)) + F.when(F.col(id_col).isNull(), F.lit(None)).otherwise(0),
                      F.xxhash64(F.lit("text"), text_of(text_col)))


def assign(docs: DataFrame, weights: Sequence[float], grown_weight: float | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``shard`` and, if ``grown_weight`` is given, ``grown_shard``:
    the shard once one more of that weight is added.  A narrow projection: no shuffle."""
    won = docs.withColumn("__won", rendezvous(record_key(id_col, text_col), weights))
    out = won.withColumn("shard", F.col("__won.shard"))
    if grown_weight is not None:
        more = rendezvous(record_key(id_col, text_col), [grown_weight], first=len(weights))
        out = out.withColumn("grown_shard", F.greatest(F.col("__won"), more)["shard"])
    return out.drop("__won")
