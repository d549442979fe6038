"""S3 with pruning: a retry-safe append reads the files of its own snapshots' months, however
many months are stored, and stays right after a lost append and for older tables."""

import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from tidepool.sources import bronze as B
from tidepool.sources import snapshot_months as S
from tidepool.sources import versions

KEYS = ["snapshot_id", "search_text", "search_area", "vacancy_id"]


def batch(spark, sid, when, n=6):
    rows = [(sid, "dev", "msk", 0, f"v{i}", "{}") for i in range(n)]
    return spark.createDataFrame(rows, "snapshot_id string, search_text string, search_area string, "
                                       "page_num int, vacancy_id string, raw_json string"
                                 ).withColumn("ingested_at", F.lit(when).cast("timestamp"))


def files_read(df) -> int:
    """Files that the scans of a collected frame have opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    total, stack = 0, [plan]
    while stack:
        p = stack.pop()
        if p.nodeName() in ("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage"):
            stack.append(p.plan())
            continue
        if p.metrics().contains("numFiles"):
            total += p.metrics().apply("numFiles").value()
        children = p.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def pairs(spark, path):
    return sorted((r[0], r[1]) for r in S.snapshot_months(spark, path).collect())


def test_files_read_do_not_grow_with_months(spark):
    path = tempfile.mkdtemp(prefix="tp-months-") + "/bronze"
    read = []
    for month in range(1, 7):
        rows = batch(spark, f"s{month}", f"2024-{month:02d}-05 10:00:00")
        B.append_bronze(rows, path, source="test")
        again = B.retry_safe(rows, path, KEYS)
        assert again.count() == 0
        read.append(files_read(again))
    assert set(read) == {1}
    more = batch(spark, "s3", "2024-06-30 10:00:00", 8)     # a snapshot that straddles months
    assert B.retry_safe(more, path, KEYS).count() == 2
    B.append_bronze(B.retry_safe(more, path, KEYS), path, source="test")
    assert S.months_of(spark, path, more) == [202403, 202406]
    assert B.retry_safe(more, path, KEYS).count() == 0
    assert B.read_bronze(spark, path).count() == 38


def test_snapshots_beyond_the_literals_are_joined(spark):
    path = tempfile.mkdtemp(prefix="tp-months-") + "/bronze"
    for month in (1, 2, 3):
        B.append_bronze(batch(spark, f"s{month}", f"2024-{month:02d}-05"), path, source="test")
    new = batch(spark, "s1", "2024-04-01").unionByName(batch(spark, "s3", "2024-04-01", 7))
    stored = B.read_bronze(spark, path, columns=[*KEYS, B.PARTITION_COL])
    for limit in (1, 1000):
        met = S.rows_of_snapshots(stored, path, new, limit)
        assert met.count() == 12 and files_read(met) >= 2
        assert B.anti_append(new, met, KEYS).count() == 1


def test_null_snapshots_and_empty_batches(spark):
    path = tempfile.mkdtemp(prefix="tp-months-") + "/bronze"
    B.append_bronze(batch(spark, "s1", "2024-01-05"), path, source="test")
    none = batch(spark, "s1", "2024-01-05").withColumn("snapshot_id", F.lit(None).cast("string"))
    assert B.retry_safe(none, path, KEYS).count() == 6          # null keys never match
    assert B.retry_safe(none.limit(0), path, KEYS).count() == 0
    B.append_bronze(none.limit(0), path, source="test")
    assert pairs(spark, path) == [("s1", 202401)]


def test_lost_append_is_read_from_the_rows(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="tp-months-") + "/bronze"
    B.append_bronze(batch(spark, "s1", "2024-01-05"), path, source="test")

    def lost(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(S, "close_append", lost)
        with pytest.raises(RuntimeError, match="lost"):
            B.append_bronze(batch(spark, "s2", "2024-02-05"), path, source="test")
    assert pairs(spark, path) == [("s1", 202401), ("s2", 202402)]
    assert B.retry_safe(batch(spark, "s2", "2024-02-05"), path, KEYS).count() == 0
    B.append_bronze(batch(spark, "s3", "2024-03-05"), path, source="test")
    assert not versions.manifest(spark, f"{path}/{S.FOLDER}")["open"]
    assert pairs(spark, path) == [("s1", 202401), ("s2", 202402), ("s3", 202403)]


def test_table_without_index_and_compaction(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="tp-months-") + "/bronze"
    B.append_bronze(batch(spark, "s1", "2024-01-05"), path, source="test")
    old = f"{path}-old"
    shutil.copytree(path, old, ignore=shutil.ignore_patterns(S.FOLDER))
    assert pairs(spark, old) == [("s1", 202401)]
    assert B.retry_safe(batch(spark, "s1", "2024-01-05"), old, KEYS).count() == 0
    monkeypatch.setattr(S, "MAX_FOLDERS", 2)
    for month in range(2, 7):
        B.append_bronze(batch(spark, f"s{month}", f"2024-{month:02d}-05"), old, source="test")
    assert len(versions.manifest(spark, f"{old}/{S.FOLDER}")["folders"]) <= 3
    assert pairs(spark, old) == [(f"s{m}", 202400 + m) for m in range(1, 7)]
