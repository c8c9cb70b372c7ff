import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import write_text
from strata.plans.ingest import ingest_dataset
from strata.sources import files as FS
from strata.sources import sync as S
from strata.sources import versions as V

SCHEMA = T.StructType([T.StructField("Name", T.StringType()), T.StructField("Age", T.IntegerType())])
HDR = "Name,Age\n"


def _ingest(spark, tmp, **kw):
    args = dict(patterns=["people"], schema=SCHEMA, bronze_path=f"{tmp}/bronze",
                 manifest_path=f"{tmp}/_manifest", channel="c", load_date="2024-01-01")
    args.update(kw)
    return ingest_dataset(spark, f"{tmp}/raw", **args)


def test_ingest_dedup_scopes_manifest_and_rerun(spark, tmp):
    write_text(f"{tmp}/raw/people_1.csv", HDR + "Ann,30\nAnn,30\nBo,\n,\n")
    write_text(f"{tmp}/raw/sub/PEOPLE_2.CSV", HDR + "Ann,30\n\"Cy, Jr\",x\n")
    write_text(f"{tmp}/raw/other.csv", HDR + "Zed,1\n")
    write_text(f"{tmp}/raw/people_notes.txt", "ignored")
    n = _ingest(spark, tmp)
    rows = sorted((r.name, r.age) for r in spark.read.parquet(f"{tmp}/bronze").collect())
    # within-file duplicate dropped, cross-file duplicate kept, all-empty row dropped,
    # malformed int → NULL with the row kept, quoted comma preserved
    assert rows == [("Ann", 30), ("Ann", 30), ("Bo", None), ("Cy, Jr", None)]
    assert n == 4
    assert _ingest(spark, tmp) == 0  # second run: nothing new
    write_text(f"{tmp}/raw/people_3.csv", HDR + "Di,40\n")
    assert _ingest(spark, tmp) == 1


def test_ingest_dedup_all_scope(spark, tmp):
    write_text(f"{tmp}/raw/people_1.csv", HDR + "Ann,30\n")
    write_text(f"{tmp}/raw/people_2.csv", HDR + "Ann,30\n")
    assert _ingest(spark, tmp, dedup_scope="all") == 1


def test_reordered_header_rejected(spark, tmp):
    write_text(f"{tmp}/raw/people_1.csv", "Age,Name\n4,Z\n")
    with pytest.raises(Exception):
        _ingest(spark, tmp)


def test_since_filter(spark, tmp):
    old = write_text(f"{tmp}/raw/people_old.csv", HDR + "Old,1\n")
    write_text(f"{tmp}/raw/people_new.csv", HDR + "New,2\n")
    past = time.time() - 10 * 86400
    os.utime(old, (past, past))
    since = time.strftime("%Y-%m-%d", time.gmtime(time.time() - 86400))
    paths = [r.path for r in FS.discover(spark, f"{tmp}/raw", ["people"], since=since).collect()]
    assert len(paths) == 1 and paths[0].endswith("people_new.csv")


def test_safe_read_missing(spark, tmp):
    assert FS.safe_read(spark, f"{tmp}/nope") is None


def test_versions_roundtrip(spark, tmp):
    from datetime import datetime
    root = f"{tmp}/t"
    a = spark.createDataFrame([(i,) for i in range(3)], "id int")
    b = spark.createDataFrame([(i,) for i in range(5)], "id int")
    assert V.publish(a, root, at=datetime(2024, 1, 1, 0, 0, 0)) == 0
    assert V.publish(b, root, at=datetime(2024, 1, 1, 0, 0, 10)) == 1
    assert V.read_as_of(spark, root).count() == 5
    assert V.read_as_of(spark, root, timestamp="2024-01-01 00:00:05").count() == 3
    assert V.restore(spark, root, version=0, at=datetime(2024, 1, 1, 0, 0, 20)) == 2
    assert sorted(r.id for r in V.read_as_of(spark, root).collect()) == [0, 1, 2]
    assert V.read_as_of(spark, root, version=1).count() == 5
    added, removed = V.diff(spark, root, 0, 1)
    assert sorted(r.id for r in added.collect()) == [3, 4] and removed.count() == 0
    h = [(r.version, r.operation, r.num_rows) for r in V.history(spark, root).collect()]
    assert h == [(2, "RESTORE", 3), (1, "OVERWRITE", 5), (0, "OVERWRITE", 3)]
    V.publish(a, root, mode="append")
    assert V.read_as_of(spark, root).count() == 6


def test_incremental_sync(spark, tmp):
    target = f"{tmp}/extract"
    src = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert S.incremental_append(src, target, "k") == 2        # empty target → full sync
    assert S.incremental_append(src, target, "k") == 0        # nothing new → no write
    more = spark.createDataFrame([("c", 3), ("x", 1)], "v string, k int")  # other column order
    assert S.incremental_append(more, target, "k") == 1
    assert sorted(tuple(r) for r in S.read_extract(spark, target).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_incremental_sync_retry_after_crash_loses_and_doubles_nothing(spark, tmp, monkeypatch):
    """A sync whose data is written but never committed is invisible; the
    retry computes its watermark from committed data and appends exactly
    the missing rows."""
    target = f"{tmp}/extract"
    src = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    S.incremental_append(src.where("k = 1"), target, "k")

    def crash(*a, **k):
        raise RuntimeError("lost before commit")

    monkeypatch.setattr(V, "_commit", crash)
    with pytest.raises(RuntimeError):
        S.incremental_append(src, target, "k")
    monkeypatch.undo()
    assert [r.k for r in S.read_extract(spark, target).collect()] == [1]
    assert S.incremental_append(src, target, "k") == 1
    assert sorted(r.k for r in S.read_extract(spark, target).collect()) == [1, 2]


def test_inventory(spark, tmp):
    write_text(f"{tmp}/raw/people_1.csv", HDR + "Ann,30\n")
    write_text(f"{tmp}/raw/people_2.csv", HDR + "Bo,3\nCy,4\n")
    counts = (FS.read_csv(spark, f"{tmp}/raw/people_1.csv", SCHEMA, source_col="path")
              .groupBy("path").count().withColumnRenamed("count", "n_rows"))
    inv = {r.file_name: (r.n_rows, r.status, r.n_ranges, r.digest) for r in FS.inventory(spark, f"{tmp}/raw", ".csv", counts).collect()}
    digest = lambda text: hashlib.md5(hashlib.md5(text.encode()).hexdigest().encode()).hexdigest()
    assert inv == {"people_1.csv": (1, "ingested", 1, digest(HDR + "Ann,30\n")),
                   "people_2.csv": (None, "pending", 1, digest(HDR + "Bo,3\nCy,4\n"))}


def test_changes_equal_except_all_both_ways(spark, tmp):
    from datetime import datetime
    root = f"{tmp}/versions"
    # key 0 is a hot duplicate: 3000 copies in v0, 5100 in v1 (crosses chunk boundaries)
    a = spark.range(3000).select(F.lit(0).alias("k"), F.lit("x").alias("v")).unionByName(
        spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string"))
    b = spark.range(5100).select(F.lit(0).alias("k"), F.lit("x").alias("v")).unionByName(
        spark.createDataFrame([(2, "b"), (3, "c"), (3, "c")], "k int, v string"))
    V.publish(a, root, at=datetime(2024, 1, 1, 0, 0, 0))
    V.publish(b, root, at=datetime(2024, 1, 1, 0, 0, 1))
    ch = V.changes(spark, root, 0, 1)
    got = sorted((r.change, r.k, r.v) for r in ch.collect())
    va, vb = V.read_as_of(spark, root, 0), V.read_as_of(spark, root, 1)
    want = sorted([("added", r.k, r.v) for r in vb.exceptAll(va).collect()]
                  + [("removed", r.k, r.v) for r in va.exceptAll(vb).collect()])
    assert got == want
    assert sum(1 for c, k, _ in got if c == "added" and k == 0) == 2100
    added, removed = V.diff(spark, root, 0, 1)
    assert added.count() == 2102 and removed.count() == 2


def test_ingest_retry_after_crash_before_manifest(spark, tmp, monkeypatch):
    """A run that dies after writing bronze but before recording its files
    is retried over the same files: same run id, its partition is replaced,
    so no row is duplicated."""
    write_text(f"{tmp}/raw/people_1.csv", HDR + "Ann,30\nBo,41\n")

    def crash(*a, **k):
        raise RuntimeError("driver lost before manifest update")

    monkeypatch.setattr(FS, "record_ingested", crash)
    with pytest.raises(RuntimeError):
        _ingest(spark, tmp)
    assert spark.read.parquet(f"{tmp}/bronze").count() == 2  # data landed, manifest did not
    monkeypatch.undo()
    assert _ingest(spark, tmp) == 2                            # retry re-reads the same files
    assert spark.read.parquet(f"{tmp}/bronze").count() == 2    # ...and replaces, not appends
    assert _ingest(spark, tmp) == 0


def test_publish_crash_before_commit_leaves_no_visible_version(spark, tmp, monkeypatch):
    """Data written without its commit-log row is invisible; the next publish
    takes the same version number and replaces the orphan files."""
    from datetime import datetime
    root = f"{tmp}/versions"
    V.publish(spark.createDataFrame([(1,)], "id int"), root, at=datetime(2024, 1, 1, 0, 0, 0))

    def crash(*a, **k):
        raise RuntimeError("lost before commit")

    monkeypatch.setattr(V, "_commit", crash)
    with pytest.raises(RuntimeError):
        V.publish(spark.createDataFrame([(7,), (8,)], "id int"), root)
    monkeypatch.undo()
    assert [r.id for r in V.read_as_of(spark, root).collect()] == [1]   # orphan not visible
    assert V.publish(spark.createDataFrame([(2,), (3,)], "id int"), root,
                     at=datetime(2024, 1, 1, 0, 0, 5)) == 1
    assert sorted(r.id for r in V.read_as_of(spark, root).collect()) == [2, 3]


def test_append_evolves_schema_from_the_log(spark, tmp):
    from datetime import datetime
    root = f"{tmp}/versions"
    V.publish(spark.createDataFrame([(1, "a")], "id int, v string"), root, at=datetime(2024, 1, 1))
    V.publish(spark.createDataFrame([(2, 2.5, "b")], "id int, w double, v string"), root, mode="append")
    df = V.read_as_of(spark, root)
    assert df.columns == ["id", "v", "w"]
    assert sorted((r.id, r.v, r.w) for r in df.collect()) == [(1, "a", None), (2, "b", 2.5)]
    with pytest.raises(ValueError, match="changes the type"):
        V.publish(spark.createDataFrame([("x",)], "id string"), root, mode="append")
    assert V.read_as_of(spark, root).count() == 2   # the rejected append left no version
    import os
    assert sorted(os.listdir(f"{root}/data")) == ["version=0", "version=1"]  # and wrote no data


def test_path_frame_small_and_large_lists(spark):
    for n in (0, 3, 5000):
        paths = [f"file:///raw/f_{i:05d}.csv" for i in range(n)]
        df = FS.path_frame(spark, paths)
        assert sorted(r.path for r in df.collect()) == paths
        assert df.rdd.getNumPartitions() == 1   # one manifest file per run


def test_since_is_a_utc_day_whatever_the_session_zone(spark, tmp):
    import calendar
    f = write_text(f"{tmp}/raw/people_edge.csv", HDR + "Ed,3\n")
    t = calendar.timegm((2024, 3, 10, 23, 30, 0))   # 2024-03-10 23:30 UTC = 03-11 08:30 in Tokyo
    os.utime(f, (t, t))
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        n = lambda since: FS.discover(spark, f"{tmp}/raw", ["people"], since=since).count()
        assert n("2024-03-11") == 0 and n("2024-03-10") == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)


def test_ingest_retry_with_new_files_since_the_crash(spark, tmp, monkeypatch):
    """Run 1 writes bronze for file 1 and dies before the manifest update; a
    second file arrives before the retry.  The retry's file set (and run id)
    differs, yet file 1's rows must not be kept twice."""
    write_text(f"{tmp}/raw/people_1.csv", HDR + "Ann,30\nBo,41\n")

    def crash(*a, **k):
        raise RuntimeError("driver lost before manifest update")

    monkeypatch.setattr(FS, "record_ingested", crash)
    with pytest.raises(RuntimeError):
        _ingest(spark, tmp)
    monkeypatch.undo()
    write_text(f"{tmp}/raw/people_2.csv", HDR + "Cy,50\n")
    assert _ingest(spark, tmp) == 3
    rows = sorted((r.name, r.age) for r in spark.read.parquet(f"{tmp}/bronze").collect())
    assert rows == [("Ann", 30), ("Bo", 41), ("Cy", 50)]


def test_full_extract_replaces_atomically_from_current_version(spark, tmp):
    from datetime import datetime
    src, out = f"{tmp}/table", f"{tmp}/extract"
    V.publish(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), src, at=datetime(2024, 1, 1))
    assert S.full_extract(spark, src, out, where="k > 1") == 0
    V.publish(spark.createDataFrame([(3, "c")], "k int, v string"), src, mode="append")
    assert S.full_extract(spark, src, out) == 1            # rebuilt from the current version
    assert sorted(r.k for r in S.read_extract(spark, out).collect()) == [1, 2, 3]
    assert [r.k for r in V.read_as_of(spark, out, version=0).collect()] == [2]   # previous extract kept


def test_partitioned_append_with_evolving_schema_and_overwrite(spark, tmp):
    from strata.sources import tables as TB
    path = f"{tmp}/t"
    TB.append(spark.createDataFrame([(1, "2024-01-01")], "id int, load_date string"), path)
    TB.append(spark.createDataFrame([(2, 7, "2024-01-02")], "id int, extra int, load_date string"), path)
    df = TB.read_evolving(spark, path)
    assert sorted((r.id, r.extra) for r in df.collect()) == [(1, None), (2, 7)]   # column added later
    TB.overwrite(spark.createDataFrame([(9, "2024-01-03")], "id int, load_date string"), path, ["load_date"])
    assert [r.id for r in spark.read.parquet(path).collect()] == [9]
