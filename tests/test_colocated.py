"""Tables clustered by their join key: no exchange on the fact, equal rows, hot keys and lost catalogs."""

import glob
import re
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators import build_fact, build_mart
from strata.operators.colocated import balanced
from strata.plans import ddl
from strata.plans.etl import SalesMartETL
from strata.schemas import ETL_INSERTED_COL
from strata.sinks import release, replace_partition, upsert_table
from strata.sinks.dimension import DimensionTables, active_rows
from strata.sinks.tables import join_buckets, join_key
from tests.conftest import ts
from tests.frames import customers, orders
from tests.test_plans import plan

RUNS = ["2024-03-01-00-00-00", "2024-03-02-00-00-00"]


def database(spark, folder, buckets=4):
    name = f"co_{uuid.uuid4().hex[:8]}"
    ddl.create_all(spark, folder, name, f"{name}_bi", join_buckets=buckets)
    return name


def source(spark, ctx):
    """400 orders of 60 customers, a third without one, some of unknown customers; half of the customers change."""
    later = ctx.partition == RUNS[1]
    people = [(i, f"S{i % 5}", ts(2 if later and i % 2 else 1)) for i in range(60)]
    bought = [(f"{ctx.partition}-{i}", None if i % 3 == 0 else i % 70, ts(1 + i % 4)) for i in range(400)]
    return customers(spark, people), orders(spark, bought)


def rows_of(df):
    return sorted(map(tuple, df.drop(ETL_INSERTED_COL).collect()), key=str)


def run(spark, db, **options):
    for partition in RUNS:
        SalesMartETL(spark, db, bronze_source=source, quality_gate=True, **options).run(partition)
    return {name: rows_of(spark.table(f"{db}.{name}")) for name in ("orders", "dim_customer", "fct_orders", "sales_mart")}


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("clustered"))
    db = database(spark, folder)
    return db, folder, run(spark, db, broadcast_limit=0)


def test_clustered_run_gives_the_rows_of_a_plain_one(spark, scratch_dir, clustered):
    plain = f"pl_{uuid.uuid4().hex[:8]}"
    ddl.create_all(spark, scratch_dir, plain, f"{plain}_bi")
    assert run(spark, plain) == clustered[2]


def test_fact_and_mart_have_no_exchange_on_the_fact(spark, clustered):
    db = clustered[0]
    active = active_rows(spark, DimensionTables.of(db))
    batch = spark.table(f"{db}.orders").where(F.col("partition") == RUNS[1])
    by_bucket = plan(build_fact(batch, active, broadcast_limit=0, co_located=True))
    assert "Exchange" not in by_bucket and "SortMergeJoin" in by_bucket
    assert plan(build_fact(batch, active, broadcast_limit=0)).count("Exchange") == 2

    fact = spark.table(f"{db}.fct_orders").where(F.col("partition") == RUNS[1])
    by_bucket = plan(build_mart(fact, active, broadcast_limit=0, co_located=True))
    # counts per date and state move, and those per date of rows without a customer; nothing else
    moved = re.findall(r"Exchange hashpartitioning\((\S+?)#\d+L?, (\S+)", by_bucket)
    assert [key for key, _ in moved] == ["deliver_date", "_groupingexpression"] and by_bucket.count("Exchange") == 2
    assert "SortMergeJoin" in by_bucket
    # rows without a customer are read in pieces, not as one bucket
    scans = by_bucket.split("FileScan")[1:]
    assert ["Bucketed: true" in scan for scan in scans] == [True, True, False]


def test_files_hold_one_bucket_and_few_files_are_written(spark, clustered):
    db, folder, _ = clustered
    assert join_key(spark, f"{db}.fct_orders") == ("customer_id", 4) and join_key(spark, f"{db}.sales_mart") is None
    assert join_buckets(spark, f"{db}.orders", f"{db}.fct_orders", f"{db}.dim_customer") == 4
    assert join_buckets(spark, f"{db}.orders", f"{db}.sales_mart") == 0
    for name, key in (("orders", "customer_id"), ("fct_orders", "customer_id"), ("dim_customer", "id")):
        for path in glob.glob(f"{folder}/{name}/**/*.parquet", recursive=True):
            number = int(re.search(r"_(\d{5})\.c\d+", path)[1])
            stored = spark.read.parquet(path).select(F.pmod(F.hash(key), F.lit(4)).alias("b")).distinct().collect()
            assert [r["b"] for r in stored] == [number]
    for name in ("orders", "fct_orders"):
        # 4 buckets; the null bucket may be written by the tasks that read rows without a customer
        assert len(glob.glob(f"{folder}/{name}/partition={RUNS[1]}/*/*.parquet")) <= 8


def test_active_rows_have_one_join_bucket_a_folder(spark, clustered):
    for path in glob.glob(f"{clustered[1]}/dim_customer/part=a/**/*.parquet", recursive=True):
        assert int(re.search(r"bucket=(\d+)/", path)[1]) == int(re.search(r"_(\d{5})\.c\d+", path)[1])


def test_hot_customer_takes_the_shuffle_path(spark, scratch_dir, monkeypatch):
    hot = [(f"o{i}", 7 if i % 3 == 0 else i, ts(1)) for i in range(300)]
    frame = orders(spark, hot)
    assert not balanced(frame, "customer_id", 16, fine=0)
    assert balanced(frame, "customer_id", 16) and balanced(frame.where("customer_id != 7"), "customer_id", 16, fine=0)
    assert balanced(frame.limit(0), "customer_id", 16, fine=0)
    db, taken = database(spark, scratch_dir, 16), []
    monkeypatch.setattr("strata.plans.etl.balanced", lambda df, key, n: taken.append(balanced(df, key, n, fine=0)) or taken[-1])
    etl = SalesMartETL(spark, db, bronze_source=lambda s, c: (customers(s, [(7, "CA", ts(1)), (8, "NY", ts(1))]), frame), broadcast_limit=0)
    etl.run(RUNS[0])
    assert taken == [False] and not etl.co_located
    found = spark.table(f"{db}.fct_orders").where("customer_sur_id is not null").groupBy("customer_id").count().collect()
    assert {r["customer_id"]: r["count"] for r in found} == {7: 101, 8: 1}
    assert {r["state_id"]: r["num_orders"] for r in spark.table(f"{db}.sales_mart").collect()} == {"CA": 101, "NY": 1, None: 198}


def test_tables_created_again_keep_their_buckets(spark, scratch_dir):
    db = database(spark, scratch_dir)
    before = run(spark, db, broadcast_limit=0)
    ddl.drop_all(spark, db, f"{db}_bi")
    # another number, or none, would misread the files
    ddl.create_all(spark, scratch_dir, db, f"{db}_bi", join_buckets=16)
    assert join_key(spark, f"{db}.orders") == ("customer_id", 4)
    assert release.current(spark, f"{db}.dim_customer").join_buckets == 4
    assert {name: rows_of(spark.table(f"{db}.{name}")) for name in before} == before
    ddl.drop_all(spark, db, f"{db}_bi")
    ddl.create_all(spark, scratch_dir, db, f"{db}_bi")
    assert {name: rows_of(spark.table(f"{db}.{name}")) for name in before} == before


def test_replace_and_upsert_of_a_clustered_table(spark, scratch_dir):
    db = database(spark, scratch_dir)
    table = f"{db}.orders"

    def stamped(rows, partition):
        return orders(spark, rows).withColumns({ETL_INSERTED_COL: F.lit(ts(1)), "partition": F.lit(partition)})

    replace_partition(spark, table, stamped([("a", 1, ts(1)), ("b", None, ts(1))], RUNS[0]), RUNS[0])
    replace_partition(spark, table, stamped([("c", 3, ts(1))], RUNS[0]), RUNS[0])
    assert [r["order_id"] for r in spark.table(table).collect()] == ["c"]
    upsert_table(spark, table, stamped([("c", 4, ts(2)), ("d", None, ts(2))], RUNS[1]), ["order_id"])
    found = spark.table(table).select("order_id", "customer_id", "partition").collect()
    assert sorted(map(tuple, found)) == [("c", 4, RUNS[1]), ("d", None, RUNS[1])]
    assert replace_partition(spark, table, stamped([], RUNS[1]), RUNS[1]) == 0
    assert spark.table(table).count() == 0
