"""Versioned tables and the incremental gold rollup."""

import datetime as dt
import json
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidepool.sources import bronze as B
from tidepool.sources import versions as V
from tidepool.streaming import bronze_stream, gold_stream
from tidepool.streaming.gold_stream import Rollup

GRID = [(r, a) for r in ("dev", "ops") for a in ("msk", "spb", "remote")]
ROLLUP = Rollup(pivots=(("dev_count", "matched_roles", "dev"), ("msk_count", "matched_areas", "msk")))


def landing(spark, root, name, snapshot, when, cells, vacancies, seed):
    """A landed batch: the snapshot's cells with some vacancies each, random skills."""
    r = random.Random(seed)
    rows = []
    for role, area in cells:
        for v in vacancies:
            skills = r.sample(["k8s", "sql", "go", "", "java"], r.randint(0, 4))
            payload = {"source_mode": "api", "detail_status": "ok", "title": v,
                       "description": "x" * r.randint(0, 5), "skills": skills}
            rows.append((when, snapshot, "test", role, area, 0, v, json.dumps(payload)))
    spark.createDataFrame(rows, B.BRONZE_SCHEMA).write.parquet(f"{root}/landing/{name}")


def run(spark, root):
    bronze_stream.start_incremental(
        spark, f"{root}/landing", f"{root}/bronze", f"{root}/silver", f"{root}/ckpt",
        gold_state=f"{root}/gold", rollup=ROLLUP).awaitTermination()


def check(spark, root):
    got = gold_stream.read_gold(spark, f"{root}/gold", f"{root}/silver", ROLLUP)
    want = ROLLUP.rebuilt(spark.read.parquet(f"{root}/silver"))
    cols = sorted(want.columns)
    got, want = (sorted(map(tuple, x.select(cols).collect())) for x in (got, want))
    assert got == want
    return got


def test_gold_equals_the_rebuild_after_every_batch(spark, monkeypatch):
    monkeypatch.setattr(gold_stream, "COMPACT", 3)
    root = tempfile.mkdtemp(prefix="tp-gold-")
    jan, feb, mar = (dt.datetime(2024, m, 10) for m in (1, 2, 3))
    batches = [("s2", feb, GRID, ("v1", "v2", "v3")),       # first
               ("s3", mar, GRID, ("v2", "v4")),             # newer versions
               ("s1", jan, GRID, ("v1", "v5")),             # late: an older snapshot
               ("s4", mar + dt.timedelta(days=1), GRID[:4], ("v1",)),   # incomplete: no change
               ("s4", mar + dt.timedelta(days=1), GRID[4:], ("v1", "v6")),  # now complete
               ("s3", mar, [("sre", "msk")], ("v2",)),      # over-complete: s3 leaves silver
               ("s2", feb, GRID[:1], ("v1",))]              # replayed rows add nothing
    seen = []
    for k, (snapshot, when, cells, vacancies) in enumerate(batches):
        landing(spark, root, f"b{k}", snapshot, when, cells, vacancies, seed=k)
        run(spark, root)
        seen.append(check(spark, root))
    assert seen[0] != seen[1] and seen[2] == seen[3] and seen[5] != seen[4]
    assert seen[5] == seen[6]
    m = V.manifest(spark, f"{root}/gold")
    assert len(m["log"]) <= 3                               # compacted on the way
    V.retire(spark, f"{root}/gold")
    assert check(spark, root) == seen[6]


def test_a_failed_refresh_is_made_good_by_the_replay(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="tp-goldfail-")
    landing(spark, root, "b0", "s1", dt.datetime(2024, 1, 5), GRID, ("v1", "v2"), 1)
    run(spark, root)
    before = check(spark, root)
    landing(spark, root, "b1", "s2", dt.datetime(2024, 2, 5), GRID, ("v1", "v3"), 2)

    def lost(*_):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(V, "publish", lost)
        with pytest.raises(Exception, match="driver lost"):
            run(spark, root)
    got = gold_stream.read_gold(spark, f"{root}/gold", f"{root}/silver", ROLLUP)
    assert sorted(map(tuple, got.select("dev_count", "msk_count", "skill", "vacancies_count")
                      .collect())) == before                # readers still see the old version
    run(spark, root)
    assert check(spark, root) != before


def test_a_reader_sees_whole_versions_only(spark):
    root = tempfile.mkdtemp(prefix="tp-versions-") + "/t"
    with pytest.raises(FileNotFoundError):
        V.read_table(spark, root)
    assert V.replace_table(spark.range(10).withColumn("g", F.col("id") % 2), root, "g") == 1
    old = V.read_table(spark, root)

    broken = spark.range(1000, numPartitions=4).withColumn("g", F.when(
        F.col("id") < 900, F.col("id") % 2).otherwise(F.raise_error(F.lit("bad row")).cast("long")))
    with pytest.raises(Exception, match="bad row"):
        V.replace_table(broken, root, "g")
    assert V.read_table(spark, root).count() == 10          # the failed rebuild is not seen
    assert V.replace_table(spark.range(3).withColumn("g", F.lit(0)), root) == 2
    assert V.read_table(spark, root).count() == 3
    assert old.count() == 10 and V.read_table(spark, root, 1).count() == 10
    assert V.retire(spark, root, keep=1) == 2               # the first version and the failed one
    assert V.read_table(spark, root).count() == 3 and V.versions(spark, root) == [2]


def test_racing_writers(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="tp-race-") + "/t"
    V.replace_table(spark.range(1), root)
    monkeypatch.setattr(V, "versions", lambda *_: [])       # a writer that saw no version yet
    with pytest.raises(RuntimeError, match="another writer"):
        V.replace_table(spark.range(2), root)
    monkeypatch.undo()
    assert V.read_table(spark, root).count() == 1
