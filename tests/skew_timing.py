"""Time per-key operators on the driver tables as they are and with a third
of the rows remapped to one hot key (the README's hot-key figures).

    python tests/skew_timing.py [sf_dir]
"""

from __future__ import annotations

import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strata.operators import dedup as D  # noqa: E402
from strata.operators import segments as SG  # noqa: E402
from strata.operators.enrich import Channel, enrich  # noqa: E402


def hot(df, key):
    """A third of the rows (chosen by a row hash) get key 0."""
    return df.withColumn(key, F.when(F.xxhash64(*df.columns) % 3 == 0, F.lit(0).cast(df.schema[key].dataType))
                         .otherwise(F.col(key)))


def timed(make, reps=5):
    ts = []
    for _ in range(reps):
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        ts.append(time.perf_counter() - t0)
    return round(statistics.median(ts[1:]), 3)


def main(sf_dir: str) -> None:
    from strata.session import local_session
    spark = local_session()
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-skew-"))
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    cases = {
        "dedup_by_key(lineitem)": (li, "l_orderkey", lambda df: D.dedup_by_key(
            df, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate")])),
        "entity_profile(orders)": (o, "o_custkey", lambda df: SG.entity_profile(
            df, "o_custkey", "o_orderdate", "o_totalprice", "1998-08-02")),
        "enrich, shuffle join, hot primary": (li, "l_orderkey", lambda df: enrich(
            df.select(F.col("l_orderkey").alias("k"), "l_quantity"),
            [Channel("o", o.select(F.col("o_orderkey").alias("k"), "o_totalprice"), ["k"],
                     [F.avg("o_totalprice").alias("p")], broadcast=False)])),
    }
    for name, (df, key, op) in cases.items():
        print(f"{name}: uniform {timed(lambda: op(df))} s, hot {timed(lambda: op(hot(df, key)))} s")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
