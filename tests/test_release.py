"""One release for many partitions and tables: moves between partitions, stops at every step,
copy on write by bucket, checks before the release, retention."""

import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators import InvalidDataError, reconciliation_report, scd2_changes
from strata.plans import ddl
from strata.plans.etl import UPSERT, Dataset, SalesMartETL, synthetic_source
from strata.session import scratch_path
from strata.sinks import (
    DimensionTables, active_rows, clear_scratch, files, publish_dimension, release, replace_partition, retain, stage_partition, stamp,
    table_location, tables, upsert_table,
)
from strata.sinks.dimension import current_commit
from tests.conftest import ts
from tests.frames import customers, orders

P1, P2, P3 = "2024-01-01-00-00-00", "2024-01-02-00-00-00", "2024-01-03-00-00-00"
LAYERS = ("dim_customer", "fct_orders", "sales_mart")


class Stopped(RuntimeError):
    pass


def stop(*args, **kwargs):
    raise Stopped


@pytest.fixture()
def db(spark, scratch_dir):
    name = f"r_{uuid.uuid4().hex[:8]}"
    ddl.create_all(spark, scratch_dir, name, f"{name}_bi")
    yield name
    ddl.drop_all(spark, name, f"{name}_bi")


def rows(df):
    return sorted((r["partition"], r["id"], r["state_id"]) for r in df.collect())


def filled(spark, table):
    replace_partition(spark, table, stamp(customers(spark, [(1, "CA", ts(1)), (2, "NY", ts(1))]), P1), P1)
    replace_partition(spark, table, stamp(customers(spark, [(3, "TX", ts(1))]), P2), P2)
    return rows(spark.table(table))


def moving(spark):
    """Ids 1 and 3 move to P3; P2 is left without rows."""
    return stamp(customers(spark, [(1, "WA", ts(2)), (3, "OR", ts(2)), (4, "AK", ts(2))]), P3)


def test_rows_that_change_partition_appear_once(spark, db):
    t = f"{db}.customer"
    filled(spark, t)
    untouched = spark.table(t).where(F.col("partition") == P2).count()
    assert upsert_table(spark, t, moving(spark), ["id"]) == 3 and untouched == 1
    assert rows(spark.table(t)) == [(P1, 2, "NY"), (P3, 1, "WA"), (P3, 3, "OR"), (P3, 4, "AK")]
    assert spark.table(t).where(F.col("partition") == P2).count() == 0
    assert release.current(spark, t).latest == P3
    # a row comes back to the partition that was left empty
    upsert_table(spark, t, stamp(customers(spark, [(3, "ID", ts(3))]), P2), ["id"])
    assert rows(spark.table(t)) == [(P1, 2, "NY"), (P2, 3, "ID"), (P3, 1, "WA"), (P3, 4, "AK")]


def test_an_upsert_leaves_other_partitions_files_alone(spark, db):
    t = f"{db}.customer"
    filled(spark, t)
    upsert_table(spark, t, stamp(customers(spark, [(3, "OR", ts(2))]), P2), ["id", "partition"])
    root = table_location(spark, t)
    assert len(files.listed(spark, f"{root}/partition={P1}/commit=*")) == 1
    assert len(files.listed(spark, f"{root}/partition={P2}/commit=*")) == 2
    plan = spark.table(t).where(F.col("partition") == P2)._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and "Subquery" not in plan


@pytest.mark.parametrize("step", ["merge", "write", "catalog", "marker", "release"])
def test_an_upsert_stopped_at_any_step_shows_the_old_table(spark, db, scratch_dir, monkeypatch, step):
    t = f"{db}.customer"
    before = filled(spark, t)
    with monkeypatch.context() as patched:
        if step == "merge":
            patched.setattr(tables, "merge_frames", stop)
        elif step == "write":  # the rows are written and registered
            write = tables.write_commit
            patched.setattr(tables, "write_commit", lambda *a: (write(*a), stop()))
        elif step == "catalog":
            patched.setattr(tables, "_after", stop)
        elif step == "marker":
            patched.setattr(files, "write_text", stop)
        else:
            patched.setattr(release, "_show", stop)
        with pytest.raises(Stopped):
            upsert_table(spark, t, moving(spark), ["id"])
    assert rows(spark.table(t)) == before
    upsert_table(spark, t, moving(spark), ["id"])
    after = rows(spark.table(t))
    assert after == [(P1, 2, "NY"), (P3, 1, "WA"), (P3, 3, "OR"), (P3, 4, "AK")]
    ddl.drop_all(spark, db, f"{db}_bi")
    ddl.create_all(spark, scratch_dir, db, f"{db}_bi")
    assert rows(spark.table(t)) == after  # also what was left without rows


def test_upsert_needs_a_partition_and_a_released_table(spark, db, scratch_dir):
    t = f"{db}.customer"
    with pytest.raises(ValueError, match="no partition"):
        upsert_table(spark, t, customers(spark, [(1, "CA", ts(1))]), ["id"])
    schema = spark.table(t).schema
    ddl.create_table(spark, f"{db}.loose", schema, f"{scratch_dir}/loose")
    with pytest.raises(ValueError, match="not released"):
        upsert_table(spark, f"{db}.loose", moving(spark), ["id"])
    spark.sql(f"DROP TABLE {db}.loose")


def test_own_tables_and_several_at_once(spark, db, scratch_dir):
    schema = spark.table(f"{db}.customer").schema
    for name in ("mine", "yours"):
        ddl.create_released_table(spark, db, name, schema, scratch_dir)
    batch = stamp(customers(spark, [(1, "CA", ts(1))]), P1)
    commits = {name: stage_partition(spark, f"{db}.{name}", batch, P1)[0] for name in ("mine", "yours")}
    assert spark.table(f"{db}.mine").count() == 0
    release.publish(spark, db, commits)
    assert spark.table(f"{db}.mine").count() == spark.table(f"{db}.yours").count() == 1
    for name in ("mine", "yours"):
        spark.sql(f"DROP VIEW {db}.{name}")
        spark.sql(f"DROP TABLE {db}.{name}_store")


def test_partition_names_are_escaped(spark, db, scratch_dir):
    schema = spark.table(f"{db}.customer").schema
    ddl.create_released_table(spark, db, "odd", schema, scratch_dir)
    for name in ("a/b=c", "it's", "ü %20", "2024-01-01"):
        replace_partition(spark, f"{db}.odd", stamp(customers(spark, [(1, "CA", ts(1))]), name), name)
    replace_partition(spark, f"{db}.odd", stamp(customers(spark, [(2, "NY", ts(1))]), "it's"), "it's")
    assert rows(spark.table(f"{db}.odd")) == sorted([("a/b=c", 1, "CA"), ("it's", 2, "NY"), ("ü %20", 1, "CA"), ("2024-01-01", 1, "CA")])
    spark.sql(f"DROP VIEW {db}.odd")
    spark.sql(f"DROP TABLE {db}.odd_store")


# ---------------------------------------------------------------- a whole run

def source(day, ids=(1, 2, 3)):
    def make(spark, ctx):
        batch = customers(spark, [(i, f"S{day}", ts(day)) for i in ids])
        return batch, orders(spark, [(f"o{day}-{i}", i, ts(day + 1)) for i in ids])

    return make


def shown(spark, db):
    """Every table without its clock column, and the BI view."""
    out = {n: sorted(map(str, spark.table(f"{db}.{n}").drop("etl_inserted").collect())) for n in ("customer", "orders", *LAYERS)}
    return out | {"bi": sorted(map(str, spark.table(f"{db}_bi.sales_mart").collect()))}


def etl(spark, db, day, **more):
    return SalesMartETL(spark, db, bronze_source=source(day), bi_database=f"{db}_bi", **more)


@pytest.mark.parametrize("step", ["silver", "fact", "gold", "marker", "release"])
def test_a_run_stopped_at_any_step_shows_the_run_before_everywhere(spark, db, monkeypatch, step):
    etl(spark, db, 1).run(P1)
    before = shown(spark, db)
    assert len(before["bi"]) == 1 and "S1" in before["bi"][0]
    with monkeypatch.context() as patched:
        if step in ("silver", "fact", "gold"):
            real = getattr(SalesMartETL, step)
            # silver: between bronze and silver; fact: after the dimension was written; gold: after the mart was built
            late = step == "gold"
            patched.setattr(SalesMartETL, step, lambda self, *a: (real(self, *a) if late else None, stop()))
        elif step == "marker":
            patched.setattr(files, "write_text", stop)
        else:
            patched.setattr(release, "_show", stop)
        with pytest.raises(Stopped):
            etl(spark, db, 2).run(P2)
    assert shown(spark, db) == before
    etl(spark, db, 2).run(P2)
    after = shown(spark, db)
    assert len(after["dim_customer"]) == 6 and len(after["fct_orders"]) == 6 and "S2" in after["bi"][0]
    # dimension, fact and mart are of one run: every key of its fact is active
    active = spark.table(f"{db}.dim_customer").where("current")
    fact = spark.table(f"{db}.fct_orders").where(F.col("partition") == P2)
    assert fact.join(active, "customer_sur_id", "left_anti").count() == 0


def test_upsert_mode_in_a_run(spark, db):
    class Moving(SalesMartETL):
        def bronze(self, ctx):
            made = super().bronze(ctx)
            made["customer"].mode, made["customer"].keys = UPSERT, ("id",)
            return made

    for day, p in ((1, P1), (2, P2)):
        Moving(spark, db, bronze_source=source(day)).run(p)
    assert rows(spark.table(f"{db}.customer")) == [(P2, i, "S2") for i in (1, 2, 3)]
    loose = Dataset("customer", source(3)(spark, None)[0], f"{db}.customer", P3, ("id",), UPSERT)
    SalesMartETL(spark, db).publish({"customer": loose})  # outside a run: released at once
    assert rows(spark.table(f"{db}.customer")) == [(P3, i, "S3") for i in (1, 2, 3)]


def test_tables_that_disagree_are_not_released(spark, db):
    class Lossy(SalesMartETL):
        def fact(self, *args):
            made = super().fact(*args)
            made.data = made.data.where("customer_id <> 2")
            return made

    etl(spark, db, 1, quality_gate=True).run(P1)
    before = shown(spark, db)
    with pytest.raises(InvalidDataError, match="lost_orders"):
        Lossy(spark, db, bronze_source=source(2), bi_database=f"{db}_bi", quality_gate=True).run(P2)
    assert shown(spark, db) == before

    def twice(spark, ctx):
        batch, placed = source(2)(spark, ctx)
        return batch, placed.union(placed)

    with pytest.raises(InvalidDataError, match="dup_orders"):
        SalesMartETL(spark, db, bronze_source=twice, quality_gate=True).run(P2)
    assert shown(spark, db) == before
    SalesMartETL(spark, db, bronze_source=twice, quality_gate=True, allow=("dup_orders",)).run(P2)
    assert len(shown(spark, db)["fct_orders"]) == 9


def test_reconciliation_counts(spark):
    fact = spark.createDataFrame([("a", "k1"), ("a", "k1"), ("b", None), (None, "k9")], "order_id string, customer_sur_id string")
    mart = spark.createDataFrame([(3,)], "num_orders long")
    dim = spark.createDataFrame([("k1", True), ("k9", False)], "customer_sur_id string, current boolean")
    found = {r["check"]: r["value"] for r in reconciliation_report(spark.range(5), fact, mart, dim).collect()}
    assert found == {"orders": 5, "fact_rows": 4, "mart_orders": 3, "lost_orders": 1, "mart_gap": 1, "dup_orders": 1, "unknown_keys": 1}
    none = fact.limit(0)
    found = {r["check"]: r["value"] for r in reconciliation_report(spark.range(0), none, mart.limit(0), dim.limit(0)).collect()}
    assert set(found.values()) == {0}


# ---------------------------------------------------------------- copy on write by bucket

def wide(spark, scratch_dir, buckets=32):
    name = f"r_{uuid.uuid4().hex[:8]}"
    ddl.create_silver_tables(spark, scratch_dir, name, buckets=buckets)
    return DimensionTables.of(name)


def publish(spark, found, batch, p):
    return publish_dimension(spark, found, stamp(scd2_changes(batch, active_rows(spark, found)), p), p)


def test_a_change_set_rewrites_only_its_buckets(spark, scratch_dir):
    found = wide(spark, scratch_dir)
    publish(spark, found, customers(spark, [(i, "CA", ts(1)) for i in range(1000)]), P1)
    root = table_location(spark, found.view)
    assert len(files.listed(spark, f"{root}/part=a/bucket=*/commit=1")) == 32
    few = [7, 8, 9]
    publish(spark, found, customers(spark, [(i, "NY", ts(2)) for i in few]), P2)
    live = current_commit(spark, found).live
    written = files.listed(spark, f"{root}/part=a/bucket=*/commit=2")
    assert 1 <= len(written) <= 3 and live.count(2) == len(written) and live.count(1) == 32 - len(written)
    assert spark.read.parquet(*written).count() < 200  # of 1000 active rows
    view = spark.table(found.view)
    assert view.where("current").count() == 1000 and view.count() == 1003
    assert {r.id for r in view.where("current and state_id = 'NY'").collect()} == set(few)
    assert view.where("current").groupBy("id").count().where("count > 1").count() == 0
    plan = active_rows(spark, found, only={3})._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan


def test_rows_without_an_id_spread_over_buckets(spark, scratch_dir):
    found = wide(spark, scratch_dir, 8)
    batch = customers(spark, [(None, f"S{k}", ts(1)) for k in range(200)])
    publish(spark, found, batch, P1)
    root = table_location(spark, found.view)
    assert len(files.listed(spark, f"{root}/part=a/bucket=*/commit=1")) == 8
    assert spark.table(found.view).count() == 200


# ---------------------------------------------------------------- retention

def test_twenty_runs_keep_a_bounded_number_of_folders(spark, scratch_dir, db):
    found = DimensionTables.of(db)
    parts = {}
    for day in range(1, 21):
        publish(spark, found, customers(spark, [(i, f"S{day}", ts(day)) for i in (1, 2)]), P1)
        if day % 5 == 0:
            replace_partition(spark, f"{db}.customer", stamp(customers(spark, [(1, f"S{day}", ts(day))]), P1), P1)
            retain(spark, db, least_age=0)
            parts[day] = (
                len([p for p in tables.stored_parts(spark, found.store) if p["part"] == "a"]),
                len(tables.stored_parts(spark, f"{db}.customer_store")),
                len(files.listed(spark, f"{scratch_dir}/_releases/*")),
            )
    assert len(set(parts.values())) == 1 and max(parts[20]) <= 2
    assert spark.table(found.view).count() == 40 and rows(spark.table(f"{db}.customer")) == [(P1, 1, "S20")]
    replace_partition(spark, f"{db}.customer", stamp(customers(spark, [(1, "ZZ", ts(21))]), P1), P1)
    assert retain(spark, db)["customer"] == 0  # the old rows are younger than a week
    assert retain(spark, db, least_age=0)["customer"] == 1


def test_old_scratch_goes_and_young_scratch_stays(spark):
    path = scratch_path(spark, "retention")
    spark.range(3).write.parquet(path)
    assert clear_scratch(spark, least_age=3600) == 0 and files.exists(spark, path)


def test_runs_with_retention_keep_everything_shown(spark, db, scratch_dir):
    for p in (P1, P2, P3):
        SalesMartETL(spark, db, bronze_source=synthetic_source(60, 300), bi_database=f"{db}_bi").run(p)
    before = shown(spark, db)
    removed = retain(spark, db, least_age=0)
    assert removed["dim_customer"] == 2 and removed["fct_orders"] == 0
    assert shown(spark, db) == before
    ddl.drop_all(spark, db, f"{db}_bi")
    ddl.create_all(spark, scratch_dir, db, f"{db}_bi")
    assert {k: v for k, v in shown(spark, db).items()} == before
