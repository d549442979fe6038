"""The size-checked broadcast: rows and bytes are both measured."""

from pyspark.sql import functions as F

from tidepool.session import bounded_broadcast


def hinted(df) -> bool:
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


def test_broadcast_is_bounded_by_rows_and_bytes(spark):
    ids = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("snapshot_id"), "id")
    assert hinted(bounded_broadcast(ids))
    assert not hinted(bounded_broadcast(ids, 99))
    assert not hinted(bounded_broadcast(ids, 100, 50_000))
    assert hinted(bounded_broadcast(ids, 100, 200_000))
    empty = bounded_broadcast(ids.limit(0))
    assert hinted(empty) and empty.count() == 0
