"""Group-level enrichment across optional channels.

Each secondary channel is aggregated to one row per join key *before* the
join (eager aggregation), then left-joined to the primary.  The primary's
row count is therefore preserved exactly, unmatched keys get NULLs, and no
join can fan out.  A channel that is absent (``df is None``) or lacks one of
its key columns is skipped — optional-channel semantics.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_root
from .join import DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_MAX_BROADCAST_ROWS, checked_broadcast


@dataclass
class Channel:
    name: str
    df: DataFrame | None
    keys: Sequence[str]
    aggs: Sequence[Column]                  # each aliased to its output name
    prepare: object = None                  # optional DataFrame -> DataFrame applied first
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
    broadcast: bool | None = None           # None = decide from measured size
    split_hot_keys: bool = True             # shuffle path: route hot primary keys around the shuffle
    hot_key_share: float = 0.001            # a key holding >= this share of sampled rows is hot
    hot_key_sample: float = 0.05            # fraction of primary rows sampled to find hot keys
    hot_key_salt: int | None = None         # partitions a hot key's rows spread over (None: all shuffle partitions)
    notes: dict = field(default_factory=dict)

    def available(self) -> bool:
        if self.df is None:
            return False
        df = self.prepared()
        return all(k in df.columns for k in self.keys)

    def prepared(self) -> DataFrame:
        return self.prepare(self.df) if self.prepare is not None else self.df

    def aggregate(self) -> DataFrame:
        return self.prepared().groupBy(*self.keys).agg(*self.aggs)


def _materialise_checked(channels: Sequence[Channel], parallel: bool) -> dict[int, DataFrame]:
    """Aggregate and size-check every channel that needs a measured
    broadcast decision.  The jobs are independent, so they are submitted
    concurrently from driver threads (each is an ordinary Spark job; the
    scheduler interleaves their tasks)."""
    todo = [(i, ch) for i, ch in enumerate(channels) if ch.broadcast is None]
    if todo:
        # resolve the shared checkpoint folder once, before any thread needs it
        shared_root(todo[0][1].prepared().sparkSession)

    def run(item):
        i, ch = item
        agg, ch.notes["broadcast"] = checked_broadcast(ch.aggregate(), ch.max_broadcast_rows,
                                                        ch.max_broadcast_bytes)
        return i, agg

    if parallel and len(todo) > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=len(todo)) as pool:
            return dict(pool.map(run, todo))
    return dict(map(run, todo))


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.001, sample: float = 0.05,
             seed: int = 17) -> list[tuple]:
    """Candidate hot key values of ``df``: keys holding at least ``share`` of
    a row sample (Spark's one-pass frequent-items sketch over the key
    columns only).  At most ``1 / share`` candidates are returned — a proven
    bound — and a false positive only costs a broadcast row."""
    k = F.struct(*[F.col(f"`{c}`") for c in keys]).alias("__k")
    row = df.select(k).sample(fraction=sample, seed=seed).stat.freqItems(["__k"], support=share).first()
    return [tuple(r) for r in (row[0] if row is not None else [])]


def _join_splitting_hot_keys(primary: DataFrame, agg: DataFrame, keys: Sequence[str],
                             ch: Channel, detect_on: DataFrame | None = None) -> DataFrame:
    """Left join of ``primary`` with the per-key aggregate ``agg`` when
    ``agg`` is too large to broadcast, safe for primary keys that hold a large
    share of the rows.

    AQE's skew-join splitting does not apply here (the aggregate side is
    already hash-partitioned by its aggregation, so it has no exchange of its
    own), so hot keys are split explicitly: their aggregate rows (at most
    ``1 / hot_key_share`` of them) are broadcast and joined where the primary
    rows are, and the primary rows of hot keys — and of NULL keys, which can
    match nothing — get a salt that spreads them over ``hot_key_salt``
    (default: all shuffle) partitions of the shuffle join while matching
    nothing there.  One scan of
    the primary, one shuffle join, exact results.
    """
    # detection samples the key columns of the original primary (``detect_on``),
    # not the result of earlier channel joins
    hot = hot_keys(detect_on if detect_on is not None else primary, keys, ch.hot_key_share,
                   ch.hot_key_sample)
    ch.notes["hot_keys"] = len(hot)
    spark = primary.sparkSession
    key_cols = [F.col(f"`{c}`") for c in keys]
    agg_cols = [c for c in agg.columns if c not in keys]
    any_null = reduce(or_, [c.isNull() for c in key_cols])
    if hot:
        hot_df = spark.createDataFrame(hot, primary.select(*key_cols).schema).withColumn("__hot", F.lit(True))
        hot_agg = (agg.join(F.broadcast(hot_df.drop("__hot")), list(keys), "left_semi")
                      .select(*keys, *[F.col(f"`{c}`").alias(f"__hot_{c}") for c in agg_cols]))
        flagged = primary.join(F.broadcast(hot_df), list(keys), "left")
        is_hot = F.coalesce(F.col("__hot"), F.lit(False))
    else:
        flagged, is_hot = primary, F.lit(False)
    # by default hot rows spread over every shuffle partition, as evenly as ordinary rows
    n_salt = ch.hot_key_salt or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # numbered by position, so that identical rows spread as well
    row_hash = F.xxhash64(F.monotonically_increasing_id())
    salted = flagged.withColumn("__salt", F.when(is_hot | any_null,
                                                 F.pmod(row_hash, F.lit(n_salt)) + 1)
                                          .otherwise(F.lit(0).cast("long")))
    if hot:
        salted = salted.join(F.broadcast(hot_agg), list(keys), "left")
    # always 0, but not a literal: that would be folded into a join condition
    # and leave the keys alone to partition by
    zero = F.pmod(F.xxhash64(*key_cols), F.lit(1)).cast("long")
    j = salted.join(agg.withColumn("__salt", zero), [*keys, "__salt"], "left")
    rest = [c for c in primary.columns if c not in keys]
    vals = [(F.coalesce(F.col(f"__hot_{c}"), F.col(f"`{c}`")) if hot else F.col(f"`{c}`")).alias(c)
            for c in agg_cols]
    return j.select(*keys, *rest, *vals)


def enrich(primary: DataFrame, channels: Sequence[Channel], parallel: bool = True) -> DataFrame:
    """Chain of left joins of ``primary`` with each available channel's
    per-key aggregate.

    Join strategy per channel: the aggregate is materialised while its rows
    and bytes are observed (:func:`checked_broadcast`); within
    ``max_broadcast_rows`` and ``max_broadcast_bytes`` → broadcast hash join
    (no shuffle of the primary); above → shuffle join in which hot primary
    keys are split off (:func:`_join_splitting_hot_keys`).  ``broadcast=False``
    forces the shuffle join without materialising; ``broadcast=True`` is only for aggregates
    whose key domain is bounded by construction.
    """
    present = []
    for ch in channels:
        if not ch.available():
            ch.notes["skipped"] = True
            continue
        missing = [k for k in ch.keys if k not in primary.columns]
        if missing:
            raise ValueError(f"primary lacks join keys {missing} for channel {ch.name}")
        present.append(ch)
    checked = _materialise_checked(present, parallel)
    out = primary
    for i, ch in enumerate(present):
        if i in checked:
            agg = checked[i]
        elif ch.broadcast:
            agg, ch.notes["broadcast"] = F.broadcast(ch.aggregate()), True
        else:
            agg, ch.notes["broadcast"] = ch.aggregate(), False
        if ch.notes["broadcast"] or not ch.split_hot_keys:
            out = out.join(agg, list(ch.keys), "left")
        else:
            out = _join_splitting_hot_keys(out, agg, ch.keys, ch, detect_on=primary)
    return out
