"""Completeness, gates and checks on snapshots with 5, 6 and 7 slices (FIXTURES §2 row 12)
and ties (row 13)."""

import datetime as dt

import pytest

from tidepool.operators import quality as Q
from tidepool.operators import silver, snapshots

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
ROLES, AREAS = ["dev", "ops"], ["msk", "spb", "remote"]


def bronze_rows(spark):
    rows = []
    grid = [(r, a) for r in ROLES for a in AREAS]
    for sid, n, hour in (("partial", 5, 1), ("complete", 6, 2), ("over", 7, 3)):
        slices = grid[:n] if n <= 6 else grid + [("qa", "msk")]
        for i, (r, a) in enumerate(slices):
            rows.append((T0 + dt.timedelta(hours=hour), sid, r, a, 0, f"v{i % 2}"))
    return spark.createDataFrame(
        rows, "ingested_at timestamp, snapshot_id string, search_text string, "
              "search_area string, page_num int, vacancy_id string")


def test_complete_snapshots_exact(spark):
    b = bronze_rows(spark)
    assert [r[0] for r in snapshots.complete_snapshots(b).collect()] == ["complete"]
    assert snapshots.latest_complete_id(b) == "complete"


def test_bronze_gate(spark):
    b = bronze_rows(spark)
    assert Q.bronze_gate(b).snapshot_id == "complete"
    with pytest.raises(Q.GateError, match="partial"):
        Q.bronze_gate(b, "partial")
    with pytest.raises(Q.GateError, match="not found"):
        Q.bronze_gate(b, "missing")
    assert Q.bronze_gate(b, "over").status == "over_complete"


def test_silver_gate_rejects_over_complete(spark):
    b = bronze_rows(spark)
    s = silver.best_row_fused(snapshots.keep_complete(b, snapshots.complete_snapshots(b)),
                              order=["ingested_at", "search_text", "search_area", "page_num"])
    assert Q.silver_gate(s, "complete", ["snapshot_id", "vacancy_id"], {}).first()["silver_rows"] == 2
    with pytest.raises(Q.GateError, match="not in silver"):
        Q.silver_gate(s, "over", ["snapshot_id", "vacancy_id"], {})
    assert Q.partial_rows(s, snapshots.complete_snapshots(b)).first()[0] == 0


def test_ties_broken_by_slice_and_page(spark):
    b = bronze_rows(spark).filter("snapshot_id = 'complete'")
    order = ["ingested_at", "search_text", "search_area", "page_num"]
    w1 = {r["vacancy_id"]: (r["search_text"], r["search_area"])
          for r in silver.best_row(b, order=order).collect()}
    w2 = {r["vacancy_id"]: (r["search_text"], r["search_area"])
          for r in silver.best_row_fused(b, order=order).collect()}
    assert w1 == w2 == {"v0": ("ops", "spb"), "v1": ("ops", "remote")}


def test_checks_batched(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (4, "z")], "k int, v string")
    row = Q.check_counts(df, ["k", "v"], {"v": ["a", "b"]}).first().asDict()
    assert row == {"not_null__k": 1, "not_null__v": 1, "accepted__v": 1}
    with pytest.raises(Q.GateError):
        Q.assert_no_failures(Q.check_counts(df, ["k"]))
    assert Q.not_null(df, "k").count() == 1
    assert Q.accepted_values(df, "v", ["a", "b"]).count() == 1   # NULL does not fail


def test_orphans_and_uniqueness(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "p int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [r[0] for r in Q.orphans(child, parent, "p", "id").collect()] == [2]
    dup = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert Q.unique_violations(dup, ["k"]).collect()[0]["n_rows"] == 2


def test_where_latest_vacuous_without_complete(spark):
    b = bronze_rows(spark).filter("snapshot_id <> 'complete'")
    assert snapshots.where_latest(b, b).count() == 0


def test_manifest_counts_empty_slice(spark):
    b = bronze_rows(spark)
    manifest = spark.createDataFrame([("partial", "ops", "remote")],
                                     "snapshot_id string, search_text string, search_area string")
    got = sorted(r[0] for r in snapshots.complete_snapshots(b, manifest=manifest).collect())
    assert got == ["complete", "partial"]
