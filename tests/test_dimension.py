"""The dimension (one store, read through one view) against the pure DataFrame SCD2:
reruns, publishes that stop at any step, key collisions, clean-up and re-creation."""

import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators import apply_scd2, materialize, scd2_changes
from strata.operators.merge import merge_frames
from strata.plans import ddl
from strata.sinks import DimensionTables, active_rows, dimension, history_rows, publish_dimension, remove_old_commits, stamp
from strata.sinks.dimension import colliding_history, current_commit
from tests.conftest import ts
from tests.frames import customers, empty_dim

P1, P2, P3 = "2024-01-01-00-00-00", "2024-01-02-00-00-00", "2024-01-03-00-00-00"


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def new_dim(spark, path):
    db = f"d_{uuid.uuid4().hex[:8]}"
    ddl.create_silver_tables(spark, path, db)
    return DimensionTables.of(db)


def run(spark, tables, batch, partition, **more):
    changes = scd2_changes(batch, active_rows(spark, tables))
    return publish_dimension(spark, tables, stamp(changes, partition), partition, **more)


def test_view_equals_dataframe_scd2_over_runs(spark, scratch_dir):
    tables = new_dim(spark, scratch_dir)
    b1 = customers(spark, [(1, "CA", ts(1)), (2, "NY", ts(1)), (None, "AK", ts(1))])
    b2 = customers(spark, [(1, "TX", ts(2)), (2, "NY", ts(1)), (3, "WA", ts(2)), (None, "AK", ts(1))])
    b3 = customers(spark, [(1, "OR", ts(3)), (3, "WA", ts(3))])
    expected = empty_dim(spark)
    for batch, p in ((b1, P1), (b2, P2), (b3, P3)):
        run(spark, tables, batch, p)
        expected = materialize(apply_scd2(batch, expected, p))
        assert rows(spark.table(tables.view)) == rows(expected)
    assert active_rows(spark, tables).where(~F.col("current")).count() == 0
    assert history_rows(spark, tables).where(F.col("current")).count() == 0


def test_rerun_after_success_changes_nothing(spark, scratch_dir):
    tables = new_dim(spark, scratch_dir)
    run(spark, tables, customers(spark, [(1, "CA", ts(1))]), P1)
    b2 = customers(spark, [(1, "TX", ts(2))])
    assert run(spark, tables, b2, P2) == 2
    before, commit = rows(spark.table(tables.view)), current_commit(spark, tables)
    assert run(spark, tables, b2, P2) == 0
    assert rows(spark.table(tables.view)) == before and current_commit(spark, tables) == commit
    assert spark.table(tables.view).where(~F.col("current")).count() == 1


class Stopped(RuntimeError):
    pass


@pytest.mark.parametrize("step", ["write", "marker", "view"])
def test_publish_stopped_at_any_step_shows_old_rows_and_reruns(spark, scratch_dir, monkeypatch, step):
    tables = new_dim(spark, scratch_dir)
    run(spark, tables, customers(spark, [(1, "CA", ts(1)), (2, "NY", ts(1))]), P1)
    before = rows(spark.table(tables.view))
    b2 = customers(spark, [(1, "TX", ts(2)), (2, "WA", ts(2))])

    def stop(*args, **kwargs):
        raise Stopped

    with monkeypatch.context() as patched:
        if step == "write":  # after some partitions were registered
            write = dimension._write
            patched.setattr(dimension, "_write", lambda *a: (write(*a), stop()))
        elif step == "marker":
            patched.setattr(dimension.files, "write_text", stop)
        else:
            patched.setattr(dimension, "show_commit", stop)
        with pytest.raises(Stopped):
            run(spark, tables, b2, P2)
    assert rows(spark.table(tables.view)) == before
    run(spark, tables, b2, P2)
    view = spark.table(tables.view)
    assert view.count() == 4 and view.where(~F.col("current")).count() == 2


def test_history_key_collision_is_merged_exactly_and_commits_alike(spark, scratch_dir):
    tables = new_dim(spark, scratch_dir)
    run(spark, tables, customers(spark, [(1, "CA", ts(1)), (2, "NY", ts(1))]), P1)
    run(spark, tables, customers(spark, [(1, "TX", ts(2)), (2, "WA", ts(2))]), P2)
    view = spark.table(tables.view)
    closed_key = view.where(~F.col("current") & (F.col("id") == 1)).first()["customer_sur_id"]
    # a source row carrying a closed row's key: MERGE updates that row in place
    source = materialize(view.where(F.col("customer_sur_id") == closed_key).withColumn("state_id", F.lit("ZZ")))
    expected = materialize(merge_frames(view, stamp(source, P3).drop("etl_inserted"), ["customer_sur_id"]))
    publish_dimension(spark, tables, stamp(source, P3), P3)
    assert rows(spark.table(tables.view)) == rows(expected)
    assert spark.table(tables.view).where(F.col("state_id") == "ZZ").count() == 1
    run(spark, tables, customers(spark, [(1, "OR", ts(4))]), P3)  # later publishes go on from there
    assert spark.table(tables.view).where("id = 1").count() == 3


def test_old_commits_can_go_without_touching_history(spark, scratch_dir):
    tables = new_dim(spark, scratch_dir)
    for day, p in ((1, P1), (2, P2), (3, P3)):
        run(spark, tables, customers(spark, [(1, "CA", ts(day)), (2, "NY", ts(day))]), p)
    before = rows(spark.table(tables.view))
    assert remove_old_commits(spark, tables) == 2  # the active rows of two older commits
    assert rows(spark.table(tables.view)) == before
    assert remove_old_commits(spark, tables) == 0
    run(spark, tables, customers(spark, [(1, "TX", ts(4))]), P3)
    assert spark.table(tables.view).count() == 7


def test_dropped_dimension_attaches_again(spark, scratch_dir):
    tables = new_dim(spark, scratch_dir)
    database = tables.view.split(".")[0]
    for day, p in ((1, P1), (2, P2)):
        run(spark, tables, customers(spark, [(1, "CA", ts(day)), (2, "NY", ts(day))]), p)
    before = rows(spark.table(tables.view))
    ddl.create_silver_tables(spark, scratch_dir, database)
    assert rows(spark.table(tables.view)) == before
    ddl.drop_layer(spark, "silver", database)
    ddl.create_silver_tables(spark, scratch_dir, database)
    assert rows(spark.table(tables.view)) == before
    run(spark, tables, customers(spark, [(1, "TX", ts(3))]), P3)
    assert spark.table(tables.view).count() == 5


def test_collision_check_reads_only_the_change_sets_range(spark, scratch_dir):
    tables = new_dim(spark, scratch_dir)
    for day, p in ((1, P1), (2, P2)):
        run(spark, tables, customers(spark, [(1, "CA", ts(day))]), p)
    staged = materialize(stamp(scd2_changes(customers(spark, [(1, "TX", ts(5))]), active_rows(spark, tables)), P3))
    found = colliding_history(history_rows(spark, tables), staged, ["customer_sur_id"], True)
    plan = found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(valid_from,2024-01-02T00:00)" in plan
    assert "LessThanOrEqual(valid_from,2024-01-05T00:00)" in plan
    assert "ReadSchema: struct<customer_sur_id:string,valid_from:timestamp_ntz>" in plan


def test_gate_runs_before_the_commit(spark, scratch_dir):
    tables = new_dim(spark, scratch_dir)
    run(spark, tables, customers(spark, [(1, "CA", ts(1))]), P1)
    before, seen = rows(spark.table(tables.view)), []

    def gate(new_rows):
        seen.append(new_rows.count())
        raise Stopped

    with pytest.raises(Stopped):
        run(spark, tables, customers(spark, [(1, "TX", ts(2))]), P2, gate=gate)
    assert seen == [2] and rows(spark.table(tables.view)) == before
