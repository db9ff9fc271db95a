"""SCD2 change classes, one per case of the edge-case table, plus a row-by-row
brute force of the change rules as a check of the single-pass plan."""

import pytest
from pyspark.sql import functions as F

from strata.functions.temporal import OPEN_END
from strata.operators import apply_scd2, classify, materialize, scd2_changes
from strata.operators.merge import MergeConflict
from tests.conftest import SF_SMALL, ts
from tests.frames import customers, empty_dim
from strata.sources import customer_batch

RUN1, RUN2, RUN3 = "2024-01-01-00-00-00", "2024-01-02-00-00-00", "2024-01-03-00-00-00"


def rows(df, *cols):
    cols = cols or ("id", "current", "datetime_updated", "valid_from", "valid_to")
    return sorted(tuple(r) for r in df.select(*cols).collect())


def dim_with(spark, batch_rows, partition=RUN1):
    return materialize(apply_scd2(customers(spark, batch_rows), empty_dim(spark), partition))


def test_new_id_on_empty_dim(spark):
    dim = dim_with(spark, [(1, "CA", ts(2))])
    out = dim.collect()
    assert len(out) == 1
    row = out[0]
    assert row["current"] is True and row["valid_from"] == ts(2)
    assert str(row["valid_to"]) == OPEN_END
    assert row["partition"] == RUN1
    assert row["customer_sur_id"] is not None and len(row["customer_sur_id"]) == 32


def test_newer_version_closes_active_row(spark):
    dim = dim_with(spark, [(1, "CA", ts(1))])
    old_key = dim.first()["customer_sur_id"]
    after = apply_scd2(customers(spark, [(1, "NY", ts(2))]), dim, RUN2)
    got = {r["current"]: r for r in after.collect()}
    assert set(got) == {True, False}
    closed, active = got[False], got[True]
    assert closed["customer_sur_id"] == old_key
    assert closed["valid_to"] == ts(2) and closed["datetime_updated"] == ts(2)
    assert closed["valid_from"] == ts(1) and closed["state_id"] == "CA"
    assert closed["partition"] == RUN2
    assert active["state_id"] == "NY" and active["valid_from"] == ts(2)
    assert active["customer_sur_id"] != old_key


@pytest.mark.parametrize("incoming", [ts(1), None], ids=["older", "null"])
def test_older_or_null_timestamp_changes_nothing(spark, incoming):
    dim = dim_with(spark, [(1, "CA", ts(3))])
    assert scd2_changes(customers(spark, [(1, "NY", incoming)]), dim).count() == 0


def test_equal_timestamp_changes_nothing(spark):
    dim = dim_with(spark, [(1, "CA", ts(2))])
    assert scd2_changes(customers(spark, [(1, "NY", ts(2))]), dim).count() == 0


def test_null_id_is_inserted_every_run(spark):
    dim = dim_with(spark, [(None, "CA", ts(1))])
    assert dim.count() == 1 and dim.first()["customer_sur_id"] is None
    again = apply_scd2(customers(spark, [(None, "CA", ts(1))]), dim, RUN2)
    assert again.count() == 2
    assert again.where(F.col("current")).count() == 2


def test_id_only_closed_in_dim_is_new(spark):
    dim = dim_with(spark, [(1, "CA", ts(1))])
    dim2 = materialize(apply_scd2(customers(spark, [(1, "NY", ts(2))]), dim, RUN2))
    # close the active version by hand: the id then only has closed rows
    closed_only = dim2.withColumn("current", F.lit(False))
    changes = classify(customers(spark, [(1, "TX", ts(3))]), closed_only)
    assert [r["change"] for r in changes.collect()] == ["new"]


def test_new_id_with_null_timestamp_is_never_superseded(spark):
    dim = dim_with(spark, [(1, "CA", None)])
    row = dim.first()
    assert row["current"] and row["customer_sur_id"] is None and row["valid_from"] is None
    assert scd2_changes(customers(spark, [(1, "NY", ts(2))]), dim).count() == 0


def test_two_versions_of_a_new_id_are_both_active(spark):
    dim = dim_with(spark, [(1, "CA", ts(1)), (1, "NY", ts(2))])
    assert dim.where(F.col("current")).count() == 2


def test_two_newer_versions_of_known_id_raise_on_upsert(spark):
    dim = dim_with(spark, [(1, "CA", ts(1))])
    batch = customers(spark, [(1, "NY", ts(2)), (1, "TX", ts(3))])
    changes = scd2_changes(batch, dim)
    assert changes.where(F.col("current")).count() == 2
    assert changes.where(~F.col("current")).count() == 2
    with pytest.raises(MergeConflict):
        apply_scd2(batch, dim, RUN2).count()


def test_id_missing_from_batch_stays_active(spark):
    dim = dim_with(spark, [(1, "CA", ts(1)), (2, "NY", ts(1))])
    after = apply_scd2(customers(spark, [(2, "TX", ts(2))]), dim, RUN2)
    assert after.where((F.col("id") == 1) & F.col("current")).count() == 1


def brute_force_changes(source, dim):
    """The change rules applied row by row in Python (test-sized inputs only)."""
    import hashlib
    from datetime import datetime

    open_end = datetime.fromisoformat(OPEN_END)
    active = [d for d in dim.collect() if d["current"] is True]
    out = []
    for s in source.collect():
        sid, upd = s["id"], s["datetime_updated"]
        key = None if sid is None or upd is None else hashlib.md5(f"{sid}{upd}".encode()).hexdigest()
        attrs = (s["first_name"], s["last_name"], s["state_id"], s["datetime_created"])
        version = (sid, key, *attrs, upd, True, upd, open_end)
        matches = [d for d in active if sid is not None and d["id"] == sid]
        if not matches:
            out.append(version)
        for d in matches:
            if upd is not None and d["datetime_updated"] is not None and upd > d["datetime_updated"]:
                out.append(version)
                out.append((d["id"], d["customer_sur_id"], d["first_name"], d["last_name"], d["state_id"],
                            d["datetime_created"], upd, False, d["valid_from"], upd))
    return out


CHANGE_COLUMNS = [
    "id", "customer_sur_id", "first_name", "last_name", "state_id", "datetime_created",
    "datetime_updated", "current", "valid_from", "valid_to",
]


def _same(changes, expected_rows):
    got = sorted(map(tuple, changes.select(*CHANGE_COLUMNS).collect()), key=str)
    assert got == sorted(expected_rows, key=str)


@pytest.mark.parametrize("prefilter", [32 * 1024 * 1024, 0], ids=["prefiltered", "shuffle"])
def test_single_pass_equals_brute_force_on_edge_cases(spark, prefilter):
    dim = dim_with(spark, [(1, "CA", ts(2)), (2, "NY", ts(2)), (3, "TX", ts(2)), (4, "WA", ts(2)), (4, "OR", ts(2))])
    batch = customers(
        spark,
        [(1, "CA", ts(3)), (2, "NY", ts(2)), (3, "TX", ts(1)), (4, "WA", ts(5)), (5, "NV", ts(1)),
         (5, "NV", ts(2)), (None, "AK", ts(1)), (6, "HI", None), (2, "NY", None)],
    )
    _same(scd2_changes(batch, dim, prefilter_limit=prefilter), brute_force_changes(batch, dim))


@pytest.mark.parametrize("prefilter", [32 * 1024 * 1024, 0], ids=["prefiltered", "shuffle"])
def test_single_pass_equals_brute_force_on_fixture_batches(spark, prefilter):
    b1, b2 = customer_batch(spark, SF_SMALL, 1), customer_batch(spark, SF_SMALL, 2)
    dim1 = materialize(apply_scd2(b1, empty_dim(spark), RUN1))
    _same(scd2_changes(b2, dim1, prefilter_limit=prefilter), brute_force_changes(b2, dim1))
