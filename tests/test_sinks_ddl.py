"""Write modes on Parquet catalog tables and the DDL helpers."""

import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators.merge import MergeConflict
from strata.plans import ddl
from strata.sinks import attach, remove_unused, replace_partition, stamp, table_location, upsert_table
from strata.sources import read_path
from strata.schemas import CUSTOMER_TABLE, DIM_CUSTOMER
from tests.conftest import ts
from tests.frames import customers

P1, P2 = "2024-01-01-00-00-00", "2024-01-02-00-00-00"


@pytest.fixture()
def db(spark, scratch_dir):
    name = f"t_{uuid.uuid4().hex[:8]}"
    ddl.create_all(spark, scratch_dir, name, f"{name}_bi")
    yield name
    ddl.drop_all(spark, name, f"{name}_bi")


@pytest.fixture()
def plain(spark, db, scratch_dir):
    """A table without partitions."""
    ddl.create_table(spark, f"{db}.plain", DIM_CUSTOMER, f"{scratch_dir}/plain", ())
    yield f"{db}.plain"
    spark.sql(f"DROP TABLE IF EXISTS {db}.plain")


def one_row(spark):
    return spark.createDataFrame([(1, "k1", "F", "L", "CA", ts(1), ts(1), True, ts(1), ts(9), P1)], DIM_CUSTOMER)


def parts(spark, table):
    return sorted((r["partition"], r["n"]) for r in spark.table(table).groupBy("partition").agg(F.count("*").alias("n")).collect())


def test_replace_partition_keeps_other_partitions_and_is_idempotent(spark, db):
    t = f"{db}.customer"
    a = customers(spark, [(1, "CA", ts(1)), (2, "NY", ts(1))])
    b = customers(spark, [(3, "TX", ts(2))])
    replace_partition(spark, t, stamp(a, P1), P1)
    replace_partition(spark, t, stamp(b, P2), P2)
    replace_partition(spark, t, stamp(b, P1), P1)
    replace_partition(spark, t, stamp(b, P1), P1)
    assert parts(spark, t) == [(P1, 1), (P2, 1)]


def test_empty_batch_clears_partition(spark, db):
    t = f"{db}.customer"
    a = customers(spark, [(1, "CA", ts(1))])
    replace_partition(spark, t, stamp(a, P1), P1)
    replace_partition(spark, t, stamp(a, P2), P2)
    replace_partition(spark, t, stamp(a.where(F.lit(False)), P1), P1)
    assert parts(spark, t) == [(P2, 1)]


def test_partition_that_looks_like_a_date_stays_string(spark, db, scratch_dir):
    t = f"{db}.customer"
    replace_partition(spark, t, stamp(customers(spark, [(1, "CA", ts(1))]), "2025-02-22"), "2025-02-22")
    assert dict(spark.table(t).dtypes)["partition"] == "string"
    loc = table_location(spark, t)
    assert dict(read_path(spark, loc, CUSTOMER_TABLE).dtypes)["partition"] == "string"


def test_failed_replace_keeps_the_old_rows(spark, db):
    t = f"{db}.customer"
    good = customers(spark, [(1, "CA", ts(1)), (2, "NY", ts(1))])
    replace_partition(spark, t, stamp(good, P1), P1)
    broken = good.withColumn("state_id", F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("state_id")))
    with pytest.raises(Exception, match="no"):
        replace_partition(spark, t, stamp(broken, P1), P1)
    assert parts(spark, t) == [(P1, 2)]


def test_created_again_tables_keep_their_rows(spark, scratch_dir):
    name = f"t_{uuid.uuid4().hex[:8]}"
    ddl.create_all(spark, scratch_dir, name, f"{name}_bi")
    t = f"{name}.customer"
    a = customers(spark, [(1, "CA", ts(1)), (2, "NY", ts(1))])
    replace_partition(spark, t, stamp(customers(spark, [(9, "TX", ts(1))]), P1), P1)
    replace_partition(spark, t, stamp(a, P1), P1)
    replace_partition(spark, t, stamp(a, P2), P2)
    replace_partition(spark, t, stamp(a.where(F.lit(False)), P2), P2)
    ddl.create_all(spark, scratch_dir, name, f"{name}_bi")
    assert parts(spark, t) == [(P1, 2)]
    ddl.drop_all(spark, name, f"{name}_bi")
    ddl.create_all(spark, scratch_dir, name, f"{name}_bi")
    assert parts(spark, t) == [(P1, 2)]  # the newest version of each partition, the empty one too
    ddl.drop_all(spark, name, f"{name}_bi")


def test_unused_versions_can_go(spark, db, plain):
    t = f"{db}.customer"
    for state in ("CA", "NY", "TX"):
        replace_partition(spark, t, stamp(customers(spark, [(1, state, ts(1))]), P1), P1)
    replace_partition(spark, t, stamp(customers(spark, [(2, "WA", ts(1))]), P2), P2)
    assert remove_unused(spark, t) == 2 and remove_unused(spark, t) == 0
    assert sorted((r["partition"], r["state_id"]) for r in spark.table(t).collect()) == [(P1, "TX"), (P2, "WA")]
    for state in ("CA", "NY"):
        upsert_table(spark, plain, one_row(spark).withColumn("state_id", F.lit(state)), ["customer_sur_id"])
    assert remove_unused(spark, plain) == 1
    assert [r["state_id"] for r in spark.table(plain).collect()] == ["NY"]


def test_upsert_table_switches_snapshot(spark, plain):
    rows = one_row(spark)
    first = table_location(spark, plain)
    assert upsert_table(spark, plain, rows, ["customer_sur_id"]) == 1
    second = table_location(spark, plain)
    assert second != first and "/_v/" in second
    changed = rows.withColumn("state_id", F.lit("NY")).withColumn("partition", F.lit(P2))
    extra = rows.withColumn("customer_sur_id", F.lit("k2"))
    upsert_table(spark, plain, changed.unionByName(extra), ["customer_sur_id"])
    got = sorted((r["customer_sur_id"], r["state_id"]) for r in spark.table(plain).collect())
    assert got == [("k1", "NY"), ("k2", "CA")]
    # the previous snapshot is untouched, and a table created again finds the newest
    assert spark.read.parquet(second).count() == 1
    spark.sql(f"DROP TABLE {plain}")
    ddl.create_table(spark, plain, DIM_CUSTOMER, first, ())
    attach(spark, plain)
    assert spark.table(plain).count() == 2


def test_failed_upsert_keeps_previous_snapshot(spark, plain):
    rows = one_row(spark)
    upsert_table(spark, plain, rows, ["customer_sur_id"])
    before = table_location(spark, plain)
    with pytest.raises(MergeConflict):
        upsert_table(spark, plain, rows.unionByName(rows), ["customer_sur_id"])
    assert table_location(spark, plain) == before
    assert spark.table(plain).count() == 1


def test_view_shows_newest_partition_and_empty_table(spark, db):
    view = f"{db}_bi.sales_mart"
    assert spark.table(view).count() == 0
    mart = spark.createDataFrame([("2024-01-05", "CA", 3)], "d string, state_id string, num_orders long").select(
        F.to_date("d").alias("deliver_date"), "state_id", "num_orders"
    )
    replace_partition(spark, f"{db}.sales_mart", stamp(mart, P1), P1)
    replace_partition(spark, f"{db}.sales_mart", stamp(mart.withColumn("num_orders", F.lit(7).cast("long")), P2), P2)
    rows = spark.table(view).collect()
    assert [(r["state_id"], r["num_orders"]) for r in rows] == [("CA", 7)]
    assert spark.table(view).columns == ["state_id", "delivery_date", "num_orders"]
    plan = spark.table(view)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1]
    assert "isnotnull(partition" in filters and "Subquery" in plan


def test_drop_all_removes_databases(spark, scratch_dir):
    name = f"t_{uuid.uuid4().hex[:8]}"
    ddl.create_all(spark, scratch_dir, name, f"{name}_bi")
    ddl.drop_all(spark, name, f"{name}_bi")
    dbs = {d.name for d in spark.catalog.listDatabases()}
    assert name not in dbs and f"{name}_bi" not in dbs


def test_upsert_into_partitioned_table_on_declared_keys(spark, db):
    """The bronze customer table is partitioned by run; its declared key is (id, partition)."""
    t = f"{db}.customer"
    a = customers(spark, [(1, "CA", ts(1)), (2, "NY", ts(1))])
    replace_partition(spark, t, stamp(a, P1), P1)
    replace_partition(spark, t, stamp(a, P2), P2)
    changed = stamp(customers(spark, [(2, "TX", ts(2)), (3, "WA", ts(2))]), P2)
    upsert_table(spark, t, changed, ["id", "partition"])
    got = sorted((r["partition"], r["id"], r["state_id"]) for r in spark.table(t).collect())
    assert got == [(P1, 1, "CA"), (P1, 2, "NY"), (P2, 1, "CA"), (P2, 2, "TX"), (P2, 3, "WA")]
    # a partition pruned read sees only the new snapshot's files
    assert spark.table(t).where(F.col("partition") == P1).count() == 2


def test_empty_upsert_source_keeps_the_snapshot(spark, plain):
    rows = one_row(spark)
    upsert_table(spark, plain, rows, ["customer_sur_id"])
    before = table_location(spark, plain)
    assert upsert_table(spark, plain, rows.where(F.lit(False)), ["customer_sur_id"]) == 0
    assert table_location(spark, plain) == before and spark.table(plain).count() == 1


def test_layers_are_created_and_dropped_alone(spark, scratch_dir):
    name = f"t_{uuid.uuid4().hex[:8]}"
    ddl.create_silver_tables(spark, scratch_dir, name)
    assert spark.table(f"{name}.dim_customer").count() == 0
    assert not spark.catalog.tableExists(f"{name}.customer")
    ddl.drop_layer(spark, "silver", name)
    assert not spark.catalog.databaseExists(name)
