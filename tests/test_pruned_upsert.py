"""Upserts of few keys read few row groups of the target, and give the rows they gave."""

import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators.merge import FEW_KEYS, key_filter, key_stats, merge_frames
from strata.plans import ddl
from strata.schemas import CUSTOMER_TABLE
from strata.sinks import replace_partition, upsert_table
from strata.sinks.release import current
from strata.sinks.tables import holding_partitions, released_rows
from tests.conftest import ts

RUNS = [f"2024-03-0{i}-00-00-00" for i in range(1, 5)]
ROWS = 20_000


def scan_rows(df):
    """Rows that the table scans of a plan gave, once it ran."""
    df.collect()
    scans, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif name.startswith("Scan parquet"):
            scans += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return scans


def batch(spark, ids, partition, state="CA"):
    """Customers of these ids, in an order that is not theirs."""
    id_ = F.col("id").cast("int")
    return spark.createDataFrame([(i,) for i in ids], "id int").orderBy(F.xxhash64("id")).select(
        id_.alias("id"), F.md5(id_.cast("string")).alias("first_name"), F.lit("L").alias("last_name"), F.lit(state).alias("state_id"),
        F.lit(ts(1)).alias("datetime_created"), F.lit(ts(1)).alias("datetime_updated"),
        F.lit(ts(1)).alias("etl_inserted"), F.lit(partition).alias("partition"),
    )


@pytest.fixture()
def small_row_groups(spark):
    settings = {"parquet.block.size": "16384", "parquet.page.size.row.check.min": "100", "parquet.page.size.row.check.max": "100"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


@pytest.mark.parametrize("key", ["id", "first_name"])
def test_few_keys_read_few_row_groups(spark, scratch_dir, small_row_groups, key):
    db = f"pr_{uuid.uuid4().hex[:8]}"
    ddl.create_released_table(spark, db, "customer", CUSTOMER_TABLE, scratch_dir)
    table = f"{db}.customer"
    for n, run in enumerate(RUNS[:2]):
        replace_partition(spark, table, batch(spark, range(n * ROWS, (n + 1) * ROWS), run), run, keys=[key])
    few = batch(spark, [5, ROWS - 1, 10 * ROWS], RUNS[2], "NY")
    target = released_rows(spark, table, current(spark, table))
    n_keys = key_stats(few, [key])[0]
    assert n_keys == 3
    found = holding_partitions(target, few, [key], n_keys, small=True)
    assert scan_rows(found) < ROWS * 2 / 10  # of all rows, those in row groups that may hold a key
    assert [r[0] for r in found.collect()] == [RUNS[0]]

    assert upsert_table(spark, table, few, [key]) == 3
    rows = spark.table(table)
    assert rows.count() == 2 * ROWS + 1 and rows.select(key).distinct().count() == 2 * ROWS + 1
    assert sorted(r["id"] for r in rows.where("state_id = 'NY'").collect()) == [5, ROWS - 1, 10 * ROWS]
    # the rewritten partition is laid out for the next upsert
    again = batch(spark, [7], RUNS[3])
    found = holding_partitions(released_rows(spark, table, current(spark, table)), again, [key], 1, small=True)
    assert scan_rows(found) < ROWS * 2 / 10 and [r[0] for r in found.collect()] == [RUNS[0]]


def test_key_filter_lists_few_values_and_the_range_of_many(spark):
    frame = spark.createDataFrame([(1, "a'b"), (3, "c"), (None, "d"), (3, None)], "k int, s string")
    assert key_filter(frame.limit(0), ["k"], 0) is None
    assert key_filter(frame.withColumn("k", F.col("k").cast("double")), ["k"], 2) is None
    both = spark.createDataFrame([(1, "a'b"), (2, "a'b"), (3, "x"), (3, "c"), (None, "c"), (1, None)], "k int, s string")
    kept = both.where(key_filter(frame, ["k", "s"], 2)).collect()
    assert sorted(map(tuple, kept)) == [(1, "a'b"), (3, "c")]
    many = spark.range(10, 10 + 2 * (FEW_KEYS + 1)).where("id % 2 = 0").select(F.col("id").cast("int").alias("k"))
    probe = spark.range(0, 1000).select(F.col("id").cast("int").alias("k"))
    n = many.count()
    assert [r["k"] for r in probe.where(key_filter(many, ["k"], n)).orderBy("k").collect()] == list(range(10, 10 + 2 * n - 1))


def test_merge_with_few_and_many_keys_equals_the_plain_rule(spark):
    target = spark.createDataFrame([(i % 300 if i % 7 else None, f"t{i}") for i in range(600)], "k int, v string")
    for keys in (range(0, 40), range(0, 500, 2)):
        source = spark.createDataFrame([*((k, f"s{k}") for k in keys), (None, "s")], "k int, v string")
        replaced = set(keys)
        before = [tuple(r) for r in target.collect()]
        hits = [(k, f"s{k}") for k, _ in before if k in replaced]
        new = [(k, f"s{k}") for k in replaced - {k for k, _ in before}]
        wanted = [r for r in before if r[0] not in replaced] + hits + new + [(None, "s")]
        assert sorted(map(tuple, merge_frames(target, source, ["k"]).collect()), key=str) == sorted(wanted, key=str)
