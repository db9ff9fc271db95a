"""Sources and column helpers."""

from pyspark.sql import functions as F

from strata.functions import deliver_date, run_partition, surrogate_key, validate_partition
from strata.operators import assert_quality, footprint, quality_report
from strata.operators.quality import InvalidDataError
from strata.session import checkpoint_root
from strata.sources import synthetic_customers, synthetic_orders
from tests.conftest import ts


def test_synthetic_batches_are_seeded_and_complete(spark):
    a = synthetic_customers(spark, 1000, seed=3, as_of="2024-01-01 00:00:00")
    b = synthetic_customers(spark, 1000, seed=3, as_of="2024-01-01 00:00:00")
    assert a.count() == 1000 and a.exceptAll(b).count() == 0
    assert a.select("id").distinct().count() == 1000
    o = synthetic_orders(spark, 10_000, 1000, seed=3, as_of="2024-01-01 00:00:00")
    stats = o.agg(F.min("customer_id"), F.max("customer_id"), F.countDistinct("order_id"), F.countDistinct("item_name")).first()
    assert tuple(stats) == (0, 999, 10_000, 3)
    assert o.where(F.length("order_id") != 36).count() == 0


def test_surrogate_key_text_and_nulls(spark):
    df = spark.createDataFrame([(1, ts(2)), (None, ts(2)), (1, None)], "id int, u timestamp_ntz")
    keys = [r[0] for r in df.select(surrogate_key("id", "u")).collect()]
    import hashlib

    assert keys[0] == hashlib.md5(b"12024-01-02 00:00:00").hexdigest()
    assert keys[1] is None and keys[2] is None


def test_deliver_date_ignores_time(spark):
    df = spark.createDataFrame([(ts(2, 23),)], "t timestamp_ntz")
    assert str(df.select(deliver_date("t")).first()[0]) == "2024-01-02"


def test_run_partition_format():
    p = run_partition()
    assert validate_partition(p) == p


def test_quality_gate(spark):
    from strata.schemas import DIM_CUSTOMER

    dim = spark.createDataFrame(
        [(1, "k", "F", "L", "CA", ts(1), ts(1), True, ts(1), ts(9), "p"),
         (1, "k", "F", "L", "CA", ts(1), ts(1), True, ts(1), ts(9), "p")],
        DIM_CUSTOMER,
    )
    report = {r["check"]: r["value"] for r in quality_report(dim).collect()}
    assert report["multi_active_ids"] == 1 and report["dup_keys"] == 1 and report["rows"] == 2
    try:
        assert_quality(dim)
        raised = False
    except InvalidDataError:
        raised = True
    assert raised
    assert assert_quality(dim, allow=("multi_active_ids", "dup_keys"))["rows"] == 2


def test_footprint_counts_variable_bytes(spark):
    df = spark.createDataFrame([("abc",), ("de",)], "s string")
    fp = footprint(df)
    assert fp.rows == 2 and fp.bytes == 2 * (16 + 8) + 5


def test_checkpoint_root_comes_from_session(spark):
    assert checkpoint_root(spark) == spark.sparkContext.getCheckpointDir().rstrip("/")


def test_bounded_broadcast_uses_row_hint_only_for_fixed_width(spark):
    from strata.operators.bounded import broadcast_if_bounded, fixed_width_bound

    ints = spark.range(10).selectExpr("cast(id as int) k")
    assert fixed_width_bound(ints, 10) == 10 * 24
    assert fixed_width_bound(spark.createDataFrame([("a",)], "s string"), 10) is None
    _, small = broadcast_if_bounded(ints, limit=240, max_rows=10)
    assert small
    _, small = broadcast_if_bounded(ints, limit=239, max_rows=10)
    assert not small


def test_size_shuffles_scales_with_task_slots(spark):
    from strata.session import size_shuffles

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    try:
        n = size_shuffles(spark, per_core=4)
        assert n >= 4 * spark.sparkContext.defaultParallelism
        assert spark.conf.get(key) == str(n)
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def test_batches_keep_every_customer(spark):
    from strata.sources import customer_batch, edge_batch, held_back_batch, load
    from tests.conftest import SF_SMALL

    n = load(spark, SF_SMALL, "customer").count()
    assert customer_batch(spark, SF_SMALL, 1).count() == customer_batch(spark, SF_SMALL, 2).count() == n
    assert 0 < held_back_batch(spark, SF_SMALL).count() < n
    edge = edge_batch(spark, SF_SMALL)
    assert edge.where("id is null").count() > 0 and edge.where("datetime_updated is null").count() > 0
    assert edge.groupBy("id").count().where("id is not null").agg(F.max("count")).first()[0] > n // 4


def test_cluster_without_shared_checkpoint_folder_is_an_error():
    import pytest

    from strata.session import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
