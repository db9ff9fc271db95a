"""With Spark's own broadcast thresholds on, joins that were not measured still go through the shuffle."""

import pytest

from strata.operators import apply_scd2, build_fact, build_mart, materialize, merge_frames, scd2_changes
from strata.operators.quality import reconciliation_report
from strata.sinks.tables import holding_partitions
from strata.sources.testdata import customer_batch, orders_batch
from tests.conftest import SF_SMALL, ts
from tests.frames import customers, empty_dim, orders

THRESHOLDS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture()
def eager_broadcasts(spark):
    before = [spark.conf.get(name) for name in THRESHOLDS]
    for name in THRESHOLDS:
        spark.conf.set(name, "100MB")
    yield spark
    for name, value in zip(THRESHOLDS, before):
        spark.conf.set(name, value)


def broadcasts(df) -> int:
    """Joins of the plan that ran, after Spark saw the sizes."""
    execution = df._jdf.queryExecution()
    df._jdf.collectToPython()
    return execution.executedPlan().toString().split("Initial Plan")[0].count("BroadcastHashJoin")


def test_batches_broadcast_nothing_but_the_nations(eager_broadcasts):
    assert broadcasts(orders_batch(eager_broadcasts, SF_SMALL)) == 0
    assert broadcasts(customer_batch(eager_broadcasts, SF_SMALL, 1)) <= 1
    assert broadcasts(customer_batch(eager_broadcasts, SF_SMALL, 2)) <= 1


def test_declined_sides_are_not_broadcast(eager_broadcasts, scratch_dir):
    spark = eager_broadcasts
    for name, df in {
        "dim": apply_scd2(customers(spark, [(1, "CA", ts(1)), (2, "NY", ts(1))]), empty_dim(spark), "p"),
        "batch": customers(spark, [(1, "TX", ts(2)), (3, "WA", ts(1))]),
        "orders": orders(spark, [("a", 1, ts(3)), ("b", None, ts(3))]),
    }.items():
        df.write.parquet(f"{scratch_dir}/{name}")
    dim, batch, placed = (spark.read.parquet(f"{scratch_dir}/{n}") for n in ("dim", "batch", "orders"))
    assert broadcasts(scd2_changes(batch, dim, prefilter_limit=0)) == 0
    changes = materialize(scd2_changes(batch, dim, prefilter_limit=0))
    assert broadcasts(merge_frames(dim, changes, ["customer_sur_id"], broadcast_limit=0)) == 0
    assert broadcasts(holding_partitions(dim, changes, ["customer_sur_id"], 1000, False)) == 0
    fact = materialize(build_fact(placed, dim, broadcast_limit=0))
    assert broadcasts(build_fact(placed, dim, broadcast_limit=0)) == 0
    mart = build_mart(fact, dim, broadcast_limit=0)
    assert broadcasts(mart) == 0
    assert broadcasts(reconciliation_report(placed, fact, mart, dim)) == 0
