"""Physical plans: pushdown, pruning, and the broadcast guards."""


from strata.operators import apply_scd2, build_fact, build_mart, materialize, merge_frames, scd2_changes
from tests.conftest import ts
from tests.frames import customers, empty_dim, orders


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def dim_of(spark):
    return materialize(apply_scd2(customers(spark, [(1, "CA", ts(1)), (2, "NY", ts(1))]), empty_dim(spark), "p"))


def test_guards_decline_broadcast_above_the_limit(spark):
    dim = dim_of(spark)
    batch = customers(spark, [(1, "TX", ts(2)), (3, "WA", ts(1))])
    assert "BroadcastExchange" in plan(scd2_changes(batch, dim))
    assert "BroadcastExchange" not in plan(scd2_changes(batch, dim, prefilter_limit=0))
    changes = materialize(scd2_changes(batch, dim))
    assert "BroadcastExchange" in plan(merge_frames(dim, changes, ["customer_sur_id"]))
    full = plan(merge_frames(dim, changes, ["customer_sur_id"], broadcast_limit=0))
    assert "BroadcastExchange" not in full and "FullOuter" not in full
    assert "LeftOuter" in full and "LeftAnti" in full


def test_active_filter_and_columns_reach_the_scan(spark, scratch_dir):
    dim = dim_of(spark)
    path = f"{scratch_dir}/dim"
    dim.write.parquet(path)
    stored = spark.read.parquet(path)
    fact_plan = plan(build_fact(orders(spark, [("a", 1, ts(3))]), stored, broadcast_limit=0))
    assert "PushedFilters: [IsNotNull(current), EqualTo(current,true), IsNotNull(id)]" in fact_plan
    assert "ReadSchema: struct<id:int,customer_sur_id:string,current:boolean>" in fact_plan


def test_null_keys_are_a_join_key_not_a_filter(spark):
    fact_plan = plan(build_fact(orders(spark, [("a", None, ts(3))]), dim_of(spark), broadcast_limit=0))
    join_line = next(line for line in fact_plan.splitlines() if "Join" in line)
    assert "_strata_salt" in join_line


def test_broadcast_mart_moves_the_fact_once(spark):
    dim = dim_of(spark)
    fact = materialize(build_fact(orders(spark, [("a", 1, ts(3)), ("b", None, ts(3))]), dim))
    small = plan(build_mart(fact, dim))
    assert small.count("Exchange hashpartitioning") == 1 and "BroadcastExchange" in small
    large = plan(build_mart(fact, dim, broadcast_limit=0))
    assert "BroadcastExchange" not in large
    assert sorted(map(tuple, build_mart(fact, dim).collect()), key=str) == sorted(
        map(tuple, build_mart(fact, dim, broadcast_limit=0).collect()), key=str
    )
