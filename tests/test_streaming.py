"""foreachBatch adapters over a Parquet file stream."""

import os
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from strata.plans import ddl
from strata.schemas import CUSTOMER_BATCH
from strata.streaming import epoch_partitions, latest_per_key, scd2_sink, start_available_now
from tests.conftest import ts
from tests.frames import customers


def test_scd2_stream_matches_batch_runs(spark, scratch_dir):
    db = f"s_{uuid.uuid4().hex[:8]}"
    ddl.create_silver_tables(spark, scratch_dir, db)
    inbox = os.path.join(scratch_dir, "inbox")
    # one file per batch, so each batch is exactly one micro-batch (maxFilesPerTrigger=1)
    customers(spark, [(1, "CA", ts(1)), (2, "NY", ts(1))]).coalesce(1).write.parquet(os.path.join(inbox, "a"))
    b = customers(spark, [(1, "TX", ts(2)), (1, "WA", ts(3)), (3, "NV", ts(1))])
    b.coalesce(1).write.parquet(os.path.join(inbox, "b"))
    # the file source orders by modification time: make file b strictly newer than a
    later = os.path.getmtime(os.path.join(inbox, "a")) + 60
    for name in os.listdir(os.path.join(inbox, "b")):
        os.utime(os.path.join(inbox, "b", name), (later, later))
    stream = (
        spark.readStream.schema(CUSTOMER_BATCH)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", 1)
        .parquet(inbox)
    )
    sink = scd2_sink(f"{db}.dim_customer", epoch_partitions(datetime(2024, 5, 1)))
    query = start_available_now(stream, sink, os.path.join(scratch_dir, "stream-checkpoint"))
    query.awaitTermination(300)
    assert query.exception() is None
    # the stream ran in a cloned session: refresh this session's cached relations
    spark.catalog.refreshTable(f"{db}.dim_customer_store")
    dim = spark.table(f"{db}.dim_customer")
    active = {r["id"]: r["state_id"] for r in dim.where("current").collect()}
    # with one file per epoch, file b's newest row for id 1 wins; id 2 untouched
    assert active == {1: "WA", 2: "NY", 3: "NV"}
    assert dim.count() == 4
    assert dim.where(~F.col("current")).first()["valid_to"] == ts(3)


def test_replayed_epoch_changes_nothing(spark, scratch_dir):
    db = f"s_{uuid.uuid4().hex[:8]}"
    ddl.create_silver_tables(spark, scratch_dir, db)
    sink = scd2_sink(f"{db}.dim_customer", epoch_partitions(datetime(2024, 5, 1)))
    batch = customers(spark, [(1, "CA", ts(1)), (None, "NY", ts(1)), (None, "TX", ts(1))])
    for epoch in (0, 0, 1, 0):
        sink(batch, epoch)
    # epoch 1 is a new one: the rules insert its rows with a NULL id again
    assert spark.table(f"{db}.dim_customer").count() == 5


def test_latest_per_key(spark):
    batch = customers(spark, [(1, "CA", ts(1)), (1, "NY", ts(3)), (1, "TX", ts(2)), (2, "WA", ts(1)), (None, "OR", ts(1)), (None, "OR", ts(2))])
    got = sorted(((r["id"], r["state_id"]) for r in latest_per_key(batch).collect()), key=str)
    assert got == [(1, "NY"), (2, "WA"), (None, "OR"), (None, "OR")]
    assert latest_per_key(batch).columns == batch.columns
