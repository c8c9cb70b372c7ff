"""Schema snapshots, drift between two of them, and the drift of a whole history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SNAPSHOT_SCHEMA = "table string, run string, position int, column string, type string"

# every value of the first type is exactly a value of each that follows it
_WIDER = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


def schema_rows(spark: SparkSession, df: DataFrame, table: str, run: str) -> DataFrame:
    """One row per column: (table, run, position, column, type).  Built from
    the schema only (no data is read)."""
    rows = [(table, run, i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, SNAPSHOT_SCHEMA)


def record(df: DataFrame, path: str, table: str, run: str, at) -> None:
    """Store a frame's schema as a snapshot of ``table``, taken ``at``; a retried run replaces its own."""
    rows = schema_rows(df.sparkSession, df, table, run).withColumn("at", F.lit(at).cast("timestamp"))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/snapshot={table}-{run}")


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{SNAPSHOT_SCHEMA}, at timestamp").parquet(path)


def retyping(old: Column, new: Column) -> Column:
    """``widened`` if every value of the old type is exactly one of the new,
    ``narrowed`` if that holds the other way round, else ``retyped``."""
    def holds(a: Column, b: Column) -> Column:
        fits = F.lit(False)
        for narrow, wider in _WIDER.items():
            fits = fits | ((a == narrow) & b.isin(*wider))
        digits = [F.regexp_extract(c, r"^decimal\((\d+),(\d+)\)$", i).try_cast("int") for c in (a, b) for i in (1, 2)]
        p, s, q, t = digits
        whole = F.when(a == "tinyint", 3).when(a == "smallint", 5).when(a == "int", 10).when(a == "bigint", 19)
        decimal = (t >= s) & (q - t >= p - s)
        return fits | F.coalesce(decimal, F.lit(False)) | F.coalesce(q - t >= whole, F.lit(False))

    return F.when(holds(old, new), "widened").when(holds(new, old), "narrowed").otherwise("retyped")


def drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns added, removed or retyped between two schema snapshots."""
    o = old.select("table", "column", F.col("type").alias("old_type"))
    n = new.select("table", "column", F.col("type").alias("new_type"))
    j = o.join(n, ["table", "column"], "full")
    change = (F.when(F.col("old_type").isNull(), "added")
               .when(F.col("new_type").isNull(), "removed")
               .when(F.col("old_type") != F.col("new_type"), "retyped"))
    return j.withColumn("change", change).filter(F.col("change").isNotNull())


def history(rows: DataFrame) -> DataFrame:
    """Drift of every snapshot against the one before it, per table: (table, run, at,
    column, change, old_type, new_type), ``change`` being added, removed, widened,
    narrowed or retyped.  The first snapshot of a table is no change.

    Snapshots are numbered by one window over (table, run, at), a row per
    snapshot.  Each column is then handed on twice, as new to its own number
    and as old to the next, and the two meet in one aggregate."""
    order = W.partitionBy("table").orderBy("at", "run")
    runs = rows.select("table", "run", "at").distinct().withColumns(
        {"nth": F.row_number().over(order), "next_run": F.lead("run").over(order), "next_at": F.lead("at").over(order)})
    met = rows.join(runs, ["table", "run", "at"])
    roles = met.select("table", "column", F.explode(F.array(
        F.struct("nth", "run", "at", F.col("type").alias("new"), F.lit(None).cast("string").alias("old")),
        F.struct((F.col("nth") + 1).alias("nth"), F.col("next_run").alias("run"), F.col("next_at").alias("at"),
                 F.lit(None).cast("string").alias("new"), F.col("type").alias("old")))).alias("r")).select("table", "column", "r.*")
    pairs = (roles.filter((F.col("nth") > 1) & F.col("run").isNotNull())
             .groupBy("table", "nth", "run", "at", "column").agg(F.max("old").alias("old_type"), F.max("new").alias("new_type")))
    change = (F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed")
               .when(F.col("old_type") != F.col("new_type"), retyping(F.col("old_type"), F.col("new_type"))))
    return pairs.withColumn("change", change).filter("change is not null").select(
        "table", "run", "at", "column", "change", "old_type", "new_type")
