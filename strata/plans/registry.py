"""Registered queries: one Spark builder per operator, and its SQL oracle.

Inputs are the given TPC-H-like tables; the bronze batches are derived from them
(``sources.testdata``), so every query's work grows with the tables. Two runs are
modelled: run 1 publishes customer batch 1, run 2 customer batch 2, both with the
full customer and orders tables. The queries about customers that the dimension does not
know (``scd2_new``, ``fct_orders_unmatched``) start from the held-back batch instead.

Queries that write tables share one two-run ETL per session and input folder; its
tables live in a scratch folder under the session's checkpoint folder. The SCD2
dimension after each run (pure DataFrame form) is checkpointed once and shared.
"""

from __future__ import annotations

import threading
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.keys import surrogate_key
from strata.functions.temporal import deliver_date
from strata.operators.fact import build_fact
from strata.operators.mart import build_mart
from strata.operators.materialize import materialize
from strata.operators.merge import merge_frames
from strata.operators.quality import quality_report, reconciliation_report
from strata.operators.scd2 import NEW, UNCHANGED, apply_scd2, classify, scd2_change_rows
from strata.plans.audit import RunAudit
from strata.plans.ddl import create_all, create_audit_table, create_bronze_tables
from strata.plans.etl import SalesMartETL
from strata.schemas import CUSTOMER_TABLE, DIM_CUSTOMER, ETL_INSERTED_COL
from strata.session import checkpoint_root, scratch_path
from strata.sinks.tables import replace_partition, stamp, table_location, upsert_table
from strata.sources.catalog import read_path
from strata.sources.synthetic import FIRST_NAMES, ITEMS, LAST_NAMES, STATES, synthetic_customers, synthetic_orders
from strata.sources.testdata import (
    EDGE_HOT,
    EDGE_NEW,
    HELD_BACK,
    customer_batch,
    edge_batch,
    held_back_batch,
    load,
    orders_batch,
)

# Fixed run partitions of the two modelled runs.
RUN1 = "2024-06-01-00-00-00"
RUN2 = "2024-06-02-00-00-00"
RUN3 = "2024-06-03-00-00-00"  # a further partition of single tables

_MEMO: dict = {}
_LOCK = threading.Lock()


def _memo(spark: SparkSession, sf_dir: str, name: str, build: Callable):
    key = (spark.sparkContext.applicationId, checkpoint_root(spark), sf_dir.rstrip("/"), name)
    with _LOCK:
        if key not in _MEMO:
            _MEMO[key] = build()
        return _MEMO[key]


def _b1(spark, sf):
    return customer_batch(spark, sf, 1)


def _b2(spark, sf):
    return customer_batch(spark, sf, 2)


def _orders(spark, sf):
    return orders_batch(spark, sf)


def _dims(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Dimension after run 1 and after run 2 (checkpointed, shared)."""

    def build():
        empty = spark.createDataFrame([], DIM_CUSTOMER)
        dim1 = materialize(apply_scd2(_b1(spark, sf), empty, RUN1))
        dim2 = materialize(apply_scd2(_b2(spark, sf), dim1, RUN2))
        return dim1, dim2

    return _memo(spark, sf, "dims", build)


def _held_back_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Dimension after a first run without every tenth customer (checkpointed, shared)."""

    def build():
        empty = spark.createDataFrame([], DIM_CUSTOMER)
        return materialize(apply_scd2(held_back_batch(spark, sf), empty, RUN1))

    return _memo(spark, sf, "held_back_dim", build)


def _warehouse(spark: SparkSession, sf: str, join_buckets: int = 0) -> dict[str, str]:
    """Two ETL runs over the fixture batches, published to scratch tables.

    With ``join_buckets`` the tables are clustered by customer, and nothing is broadcast."""

    def build():
        base = scratch_path(spark, "warehouse")
        db = f"strata_{uuid.uuid4().hex[:10]}"
        bi = f"{db}_bi"
        create_all(spark, base, db, bi, join_buckets)
        options = {"broadcast_limit": 0} if join_buckets else {}
        audit = RunAudit(spark, create_audit_table(spark, base, db))

        def source(version):
            return lambda s, ctx: (customer_batch(s, sf, version), orders_batch(s, sf))

        for version, partition in ((1, RUN1), (2, RUN2)):
            etl = SalesMartETL(spark, db, audit=audit, bronze_source=source(version), bi_database=bi, **options)
            etl.run(partition, run_id=f"run-{version}")
        return {"db": db, "bi": bi, "audit": audit.table, "path": base}

    return _memo(spark, sf, f"warehouse-{join_buckets}", build)


def _customer_table(spark: SparkSession) -> str:
    db = f"strata_{uuid.uuid4().hex[:10]}"
    create_bronze_tables(spark, scratch_path(spark, "bronze"), db)
    return f"{db}.customer"


# ---------------------------------------------------------------- Spark queries

def q_bronze_customer(spark, sf):
    return _b1(spark, sf)


def q_bronze_customer_v2(spark, sf):
    return _b2(spark, sf)


def q_bronze_orders(spark, sf):
    return _orders(spark, sf)


def q_surrogate_key(spark, sf):
    return _b2(spark, sf).select(
        "id", "datetime_updated", surrogate_key("id", "datetime_updated").alias("customer_sur_id")
    )


def q_deliver_date(spark, sf):
    return _orders(spark, sf).select("order_id", deliver_date("delivered_on").alias("deliver_date"))


def q_stamp_partition(spark, sf):
    return stamp(_b1(spark, sf), RUN1).drop(ETL_INSERTED_COL)


def q_scd2_run1(spark, sf):
    return _dims(spark, sf)[0]


def q_scd2_run2(spark, sf):
    return _dims(spark, sf)[1]


def q_current_dim(spark, sf):
    return _dims(spark, sf)[1].where(F.col("current"))


def _run2_changes(spark, sf):
    return scd2_change_rows(_b2(spark, sf), _dims(spark, sf)[0])


def q_scd2_new(spark, sf):
    changes = scd2_change_rows(_b2(spark, sf), _held_back_dim(spark, sf))
    return changes.where(F.col("change") == NEW).drop("change")


def q_scd2_updated(spark, sf):
    return _run2_changes(spark, sf).where(F.col("change") == "updated").drop("change")


def q_scd2_closed(spark, sf):
    return _run2_changes(spark, sf).where(F.col("change") == "closed").drop("change")


def q_scd2_changes(spark, sf):
    return _run2_changes(spark, sf).drop("change")


def q_scd2_edge(spark, sf):
    """Every case of the rules: equal, older, newer and NULL timestamps, NULL ids, two
    versions of an unknown id, and one unknown id that a third of the rows share."""
    return scd2_change_rows(edge_batch(spark, sf), _dims(spark, sf)[0])


def q_scd2_unchanged(spark, sf):
    pairs = classify(_b2(spark, sf), _dims(spark, sf)[0])
    return pairs.where(F.col("change") == UNCHANGED).select("id", "customer_sur_id", "datetime_updated")


def q_fct_orders(spark, sf):
    return build_fact(_orders(spark, sf), _dims(spark, sf)[1])


def q_fct_orders_unmatched(spark, sf):
    return build_fact(_orders(spark, sf), _held_back_dim(spark, sf))


def q_sales_mart(spark, sf):
    dim2 = _dims(spark, sf)[1]
    return build_mart(build_fact(_orders(spark, sf), dim2), dim2)


def q_upsert(spark, sf):
    return merge_frames(_b1(spark, sf), _b2(spark, sf), ["id"])


def q_upsert_multi_key(spark, sf):
    return merge_frames(_b1(spark, sf), _b2(spark, sf), ["id", "state_id"])


def q_upsert_null_key(spark, sf):
    orders = _orders(spark, sf)
    changed = orders.withColumn("item_name", F.upper("item_name"))
    return merge_frames(orders, changed, ["order_id", "item_id"])


def q_upsert_full_outer(spark, sf):
    """The same upsert as ``upsert_multi_key`` through the shuffle (large-source) path."""
    return merge_frames(_b1(spark, sf), _b2(spark, sf), ["id", "state_id"], broadcast_limit=0)


def _third_null(batch: DataFrame) -> DataFrame:
    return batch.withColumn("id", F.when(F.col("id") % 3 != 0, F.col("id")))


def q_upsert_hot_null(spark, sf):
    """Upsert through the shuffle path with a third of the keys NULL on both sides."""
    return merge_frames(_third_null(_b1(spark, sf)), _third_null(_b2(spark, sf)), ["id"], broadcast_limit=0)


def q_quality_report(spark, sf):
    return quality_report(_dims(spark, sf)[1]).withColumnRenamed("check", "metric")


def q_replace_partition(spark, sf):
    table = _customer_table(spark)
    b1, b2 = _b1(spark, sf), _b2(spark, sf)
    replace_partition(spark, table, stamp(b1, RUN1), RUN1)
    replace_partition(spark, table, stamp(b1, RUN2), RUN2)
    replace_partition(spark, table, stamp(b2, RUN1), RUN1)
    return spark.table(table).drop(ETL_INSERTED_COL)


def q_replace_partition_empty(spark, sf):
    table = _customer_table(spark)
    b1, b2 = _b1(spark, sf), _b2(spark, sf)
    replace_partition(spark, table, stamp(b1, RUN1), RUN1)
    replace_partition(spark, table, stamp(b2, RUN2), RUN2)
    replace_partition(spark, table, stamp(b2.where(F.lit(False)), RUN1), RUN1)
    return spark.table(table).drop(ETL_INSERTED_COL)


def q_upsert_partition_move(spark, sf):
    """Upsert on the id alone into three partitions: rows leave two of them for the third,
    and one of the two is left without rows."""
    table = _customer_table(spark)
    b1, b2 = _b1(spark, sf), _b2(spark, sf)
    for rest, run in (((0, 1), RUN1), ((2,), RUN2), ((3,), RUN3)):
        replace_partition(spark, table, stamp(b1.where((F.col("id") % 4).isin(*rest)), run), run)
    upsert_table(spark, table, stamp(b2.where((F.col("id") % 4).isin(1, 2)), RUN3), ["id"])
    return spark.table(table).drop(ETL_INSERTED_COL)


def q_reconciliation_report(spark, sf):
    dim2 = _dims(spark, sf)[1]
    orders = _orders(spark, sf)
    fact = materialize(build_fact(orders, _held_back_dim(spark, sf)))
    mart = build_mart(fact, dim2)
    return reconciliation_report(orders, fact, mart, dim2).withColumnRenamed("check", "metric")


def q_table_by_path(spark, sf):
    """The bronze customers read from their folder with the table's schema, not by way of the catalog."""
    location = table_location(spark, f"{_warehouse(spark, sf)['db']}.customer")
    return read_path(spark, location, CUSTOMER_TABLE).select(*[c for c in CUSTOMER_TABLE.fieldNames() if c != ETL_INSERTED_COL])


def q_dim_scan(spark, sf):
    return spark.read.table(f"{_warehouse(spark, sf)['db']}.dim_customer")


def q_fct_orders_table(spark, sf):
    return spark.table(f"{_warehouse(spark, sf)['db']}.fct_orders").drop(ETL_INSERTED_COL)


def q_sales_mart_table(spark, sf):
    return spark.table(f"{_warehouse(spark, sf)['db']}.sales_mart").drop(ETL_INSERTED_COL)


def q_fct_orders_clustered(spark, sf):
    """The fact of two runs over tables in 8 buckets by customer, joined bucket by bucket."""
    return spark.table(f"{_warehouse(spark, sf, 8)['db']}.fct_orders").drop(ETL_INSERTED_COL)


def q_sales_mart_clustered(spark, sf):
    """The mart of those runs."""
    return spark.table(f"{_warehouse(spark, sf, 8)['db']}.sales_mart").drop(ETL_INSERTED_COL)


def q_latest_mart(spark, sf):
    return spark.table(f"{_warehouse(spark, sf)['bi']}.sales_mart")


def q_max_partition(spark, sf):
    mart = spark.table(f"{_warehouse(spark, sf)['db']}.sales_mart")
    return mart.agg(F.max("partition").alias("max_partition"))


def q_partition_list(spark, sf):
    db = _warehouse(spark, sf)["db"]
    return spark.sql(f"SELECT `partition` FROM {db}.sales_mart GROUP BY 1")


def q_table_counts(spark, sf):
    w = _warehouse(spark, sf)
    db, bi = w["db"], w["bi"]
    return spark.sql(
        f"""SELECT (SELECT count(*) FROM {bi}.sales_mart) AS mart_view_rows,
                   (SELECT count(*) FROM {db}.dim_customer) AS dim_rows,
                   (SELECT count(*) FROM {db}.fct_orders) AS fact_rows,
                   (SELECT count(*) FROM {db}.customer) AS customer_rows,
                   (SELECT count(*) FROM {db}.orders) AS orders_rows"""
    )


def q_recreate_tables(spark, sf):
    """Rows per table and run after the tables were created again over the same folders."""
    w = _warehouse(spark, sf)
    db = f"strata_{uuid.uuid4().hex[:10]}"
    create_all(spark, w["path"], db, f"{db}_bi")
    create_all(spark, w["path"], db, f"{db}_bi")  # a second time: nothing changes
    names = ["customer", "orders", "dim_customer", "fct_orders", "sales_mart"]
    counts = [
        spark.table(f"{db}.{n}").groupBy("partition").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("name"), "partition", "n_rows")
        for n in names
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.union(more)
    return out


def q_run_audit(spark, sf):
    return spark.table(_warehouse(spark, sf)["audit"]).select("run_id", "pipeline_id", "step", "status", "rows")


def q_gen_customer(spark, sf):
    ids = load(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("id"))
    return synthetic_customers(spark, ids, seed=7, as_of="2024-06-01 00:00:00")


def q_gen_orders(spark, sf):
    bounds = load(spark, sf, "customer").agg(F.min("c_custkey").alias("lo"), F.max("c_custkey").alias("hi")).first()
    n = load(spark, sf, "orders").count()
    return synthetic_orders(spark, n, (int(bounds["lo"]), int(bounds["hi"])), seed=7, as_of="2024-06-01 00:00:00")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_customer": q_bronze_customer,
    "bronze_customer_v2": q_bronze_customer_v2,
    "bronze_orders": q_bronze_orders,
    "surrogate_key": q_surrogate_key,
    "deliver_date": q_deliver_date,
    "stamp_partition": q_stamp_partition,
    "scd2_run1": q_scd2_run1,
    "scd2_run2": q_scd2_run2,
    "current_dim": q_current_dim,
    "scd2_new": q_scd2_new,
    "scd2_updated": q_scd2_updated,
    "scd2_closed": q_scd2_closed,
    "scd2_unchanged": q_scd2_unchanged,
    "scd2_changes": q_scd2_changes,
    "scd2_edge": q_scd2_edge,
    "fct_orders": q_fct_orders,
    "fct_orders_unmatched": q_fct_orders_unmatched,
    "sales_mart": q_sales_mart,
    "upsert": q_upsert,
    "upsert_multi_key": q_upsert_multi_key,
    "upsert_null_key": q_upsert_null_key,
    "upsert_full_outer": q_upsert_full_outer,
    "upsert_hot_null": q_upsert_hot_null,
    "quality_report": q_quality_report,
    "replace_partition": q_replace_partition,
    "replace_partition_empty": q_replace_partition_empty,
    "upsert_partition_move": q_upsert_partition_move,
    "reconciliation_report": q_reconciliation_report,
    "table_by_path": q_table_by_path,
    "dim_scan": q_dim_scan,
    "fct_orders_table": q_fct_orders_table,
    "sales_mart_table": q_sales_mart_table,
    "fct_orders_clustered": q_fct_orders_clustered,
    "sales_mart_clustered": q_sales_mart_clustered,
    "latest_mart": q_latest_mart,
    "max_partition": q_max_partition,
    "partition_list": q_partition_list,
    "table_counts": q_table_counts,
    "recreate_tables": q_recreate_tables,
    "run_audit": q_run_audit,
    "gen_customer": q_gen_customer,
    "gen_orders": q_gen_orders,
}

# ---------------------------------------------------------------- SQL oracles

_SUR = "md5(cast(id as varchar) || cast(datetime_updated as varchar))"
_OPEN = "timestamp '2099-01-01 12:00:00'"

CTES: dict[str, str] = {
    "b1": """select cast(c_custkey as int) id, 'Customer' first_name, substring(c_name, 10) last_name,
       (select n_name from nation where n_nationkey = c_nationkey) state_id,
       (select min(o_orderdate) from orders where o_custkey = c_custkey) datetime_created,
       (select min(o_orderdate) from orders where o_custkey = c_custkey) datetime_updated
from customer""",
    "b2": """select cast(c_custkey as int) id, 'Customer' first_name, substring(c_name, 10) last_name,
       (select n_name from nation
        where n_nationkey = case when c_custkey % 5 = 0 then (c_nationkey + 1) % (select count(*) from nation)
                                 else c_nationkey end) state_id,
       (select min(o_orderdate) from orders where o_custkey = c_custkey) datetime_created,
       (select max(o_orderdate) from orders where o_custkey = c_custkey) datetime_updated
from customer""",
    "held": f"select * from b1 where id % {HELD_BACK} <> {HELD_BACK - 1}",
    "edge": f"""select id, first_name, last_name, state_id, datetime_created, datetime_updated from b1 where id % 9 = 0
union all select id, first_name, last_name, state_id, datetime_created, datetime_updated - interval 1 hour from b1 where id % 9 = 1
union all select id, first_name, last_name, state_id, datetime_created, null from b1 where id % 9 = 2
union all select null, first_name, last_name, state_id, datetime_created, datetime_updated from b1 where id % 9 = 3
union all select id + {EDGE_NEW}, first_name, last_name, state_id, datetime_created, datetime_updated from b1 where id % 9 = 4
union all select id + {EDGE_NEW}, first_name, last_name, state_id, datetime_created, datetime_updated + interval 1 hour from b1 where id % 9 = 4
union all select id, first_name, last_name, state_id, datetime_created, datetime_updated + interval 1 hour from b1 where id % 9 = 5
union all select {EDGE_HOT}, first_name, last_name, state_id, datetime_created, datetime_updated from b1 where id % 9 >= 6""",
    "ord": """select cast(o_orderkey as varchar) order_id, cast(o_custkey as int) customer_id,
       cast(pk as varchar) item_id, p_name item_name,
       sd delivered_on, o_orderdate datetime_order_placed
from orders
left join (select l_orderkey, min(l_partkey) pk, max(l_shipdate) sd
           from lineitem group by l_orderkey) l on l_orderkey = o_orderkey
left join part on p_partkey = pk""",
    "s1": f"select *, {_SUR} sur from b1",
    "s2": f"select *, {_SUR} sur from b2",
    "sh": f"select *, {_SUR} sur from held",
    "se": f"select *, {_SUR} sur from edge",
    "dim1": f"""select id, sur customer_sur_id, first_name, last_name, state_id, datetime_created,
       datetime_updated, true as "current", datetime_updated valid_from, {_OPEN} valid_to,
       '{RUN1}' as "partition"
from s1""",
    "dim2": f"""select s2.id, s2.sur customer_sur_id, s2.first_name, s2.last_name, s2.state_id,
       s2.datetime_created, s2.datetime_updated, true as "current", s2.datetime_updated valid_from,
       {_OPEN} valid_to, '{RUN2}' as "partition"
from s2 left join s1 on s1.id = s2.id
where s1.id is null or s2.datetime_updated > s1.datetime_updated
union all
select s1.id, s1.sur, s1.first_name, s1.last_name, s1.state_id, s1.datetime_created,
       case when s2.datetime_updated > s1.datetime_updated then s2.datetime_updated else s1.datetime_updated end,
       not coalesce(s2.datetime_updated > s1.datetime_updated, false), s1.datetime_updated,
       case when s2.datetime_updated > s1.datetime_updated then s2.datetime_updated else {_OPEN} end,
       case when s2.datetime_updated > s1.datetime_updated then '{RUN2}' else '{RUN1}' end
from s1 join s2 on s1.id = s2.id""",
    "fct1": """select o.*, k.customer_sur_id
from ord o left join (select * from dim1 where "current") k on o.customer_id = k.id""",
    "fct2": """select o.*, k.customer_sur_id
from ord o left join (select * from dim2 where "current") k on o.customer_id = k.id""",
    "fcth": """select o.*, k.sur customer_sur_id from ord o left join sh k on o.customer_id = k.id""",
    "mart1": """select cast(f.delivered_on as date) deliver_date, k.state_id, count(*) num_orders
from fct1 f left join (select customer_sur_id, state_id from dim1 where "current") k
  on f.customer_sur_id = k.customer_sur_id
group by 1, 2""",
    "mart2": """select cast(f.delivered_on as date) deliver_date, k.state_id, count(*) num_orders
from fct2 f left join (select customer_sur_id, state_id from dim2 where "current") k
  on f.customer_sur_id = k.customer_sur_id
group by 1, 2""",
    "new2": f"""select s2.id, s2.sur customer_sur_id, s2.first_name, s2.last_name, s2.state_id,
       s2.datetime_created, s2.datetime_updated, true as "current", s2.datetime_updated valid_from,
       {_OPEN} valid_to
from s2 where not exists (select 1 from dim1 d where d."current" and d.id = s2.id)""",
    "upd2": f"""select s2.id, s2.sur customer_sur_id, s2.first_name, s2.last_name, s2.state_id,
       s2.datetime_created, s2.datetime_updated, true as "current", s2.datetime_updated valid_from,
       {_OPEN} valid_to
from s2 join dim1 d on d."current" and d.id = s2.id
where s2.datetime_updated > d.datetime_updated""",
    "newh": f"""select s2.id, s2.sur customer_sur_id, s2.first_name, s2.last_name, s2.state_id,
       s2.datetime_created, s2.datetime_updated, true as "current", s2.datetime_updated valid_from,
       {_OPEN} valid_to
from s2 where not exists (select 1 from sh where sh.id = s2.id)""",
    "chge": f"""select se.id, se.sur customer_sur_id, se.first_name, se.last_name, se.state_id, se.datetime_created,
       se.datetime_updated, true as "current", se.datetime_updated valid_from, {_OPEN} valid_to,
       case when d.id is null then 'new' else 'updated' end as change
from se left join dim1 d on d."current" and d.id = se.id
where d.id is null or se.datetime_updated > d.datetime_updated
union all
select d.id, d.customer_sur_id, d.first_name, d.last_name, d.state_id, d.datetime_created,
       se.datetime_updated, false, d.valid_from, se.datetime_updated, 'closed'
from dim1 d join se on d."current" and d.id = se.id
where se.datetime_updated > d.datetime_updated""",
    "chg2": "select * from new2 union all select * from upd2 union all select * from closed2",
    "closed2": """select d.id, d.customer_sur_id, d.first_name, d.last_name, d.state_id, d.datetime_created,
       s2.datetime_updated, false as "current", d.valid_from, s2.datetime_updated valid_to
from dim1 d join s2 on d."current" and d.id = s2.id
where s2.datetime_updated > d.datetime_updated""",
}

_DEPENDS = {
    "held": ["b1"], "edge": ["b1"], "sh": ["held"], "se": ["edge"], "fcth": ["ord", "sh"],
    "newh": ["s2", "sh"], "chge": ["se", "dim1"], "s1": ["b1"], "s2": ["b2"], "dim1": ["s1"], "dim2": ["s1", "s2"],
    "fct1": ["ord", "dim1"], "fct2": ["ord", "dim2"], "mart1": ["fct1", "dim1"], "mart2": ["fct2", "dim2"],
    "new2": ["s2", "dim1"], "upd2": ["s2", "dim1"], "closed2": ["s2", "dim1"],
    "chg2": ["new2", "upd2", "closed2"],
}


def _with(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(name):
        for dep in _DEPENDS.get(name, []):
            visit(dep)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    ctes = ",\n".join(f"{name} as (\n{CTES[name]}\n)" for name in order)
    return f"with {ctes}\n{body}"


def _bigint(expr: str) -> str:
    return f"cast({expr} as bigint)"


ORACLE_SQL: dict[str, str] = {
    "bronze_customer": _with("select * from b1", "b1"),
    "bronze_customer_v2": _with("select * from b2", "b2"),
    "bronze_orders": _with("select * from ord", "ord"),
    "surrogate_key": _with("select id, datetime_updated, sur customer_sur_id from s2", "s2"),
    "deliver_date": _with("select order_id, cast(delivered_on as date) deliver_date from ord", "ord"),
    "stamp_partition": _with(f"select *, '{RUN1}' as \"partition\" from b1", "b1"),
    "scd2_run1": _with("select * from dim1", "dim1"),
    "scd2_run2": _with("select * from dim2", "dim2"),
    "current_dim": _with('select * from dim2 where "current"', "dim2"),
    "scd2_new": _with("select * from newh", "newh"),
    "scd2_edge": _with("select * from chge", "chge"),
    "scd2_updated": _with("select * from upd2", "upd2"),
    "scd2_closed": _with("select * from closed2", "closed2"),
    "scd2_unchanged": _with(
        """select s2.id, s2.sur customer_sur_id, s2.datetime_updated
from s2 join dim1 d on d."current" and d.id = s2.id
where not coalesce(s2.datetime_updated > d.datetime_updated, false)""",
        "s2", "dim1",
    ),
    "scd2_changes": _with(
        "select * from new2 union all select * from upd2 union all select * from closed2",
        "new2", "upd2", "closed2",
    ),
    "fct_orders": _with("select * from fct2", "fct2"),
    "fct_orders_unmatched": _with("select * from fcth", "fcth"),
    "sales_mart": _with("select * from mart2", "mart2"),
    "upsert": _with(
        "select * from b2 union all select * from b1 where not exists (select 1 from b2 where b2.id = b1.id)",
        "b1", "b2",
    ),
    "upsert_multi_key": _with(
        """select * from b2 union all select * from b1
where not exists (select 1 from b2 where b2.id = b1.id and b2.state_id = b1.state_id)""",
        "b1", "b2",
    ),
    "upsert_null_key": _with(
        """select order_id, customer_id, item_id, upper(item_name) item_name, delivered_on, datetime_order_placed
from ord
union all
select * from ord o
where not exists (select 1 from ord s where s.order_id = o.order_id and s.item_id = o.item_id)""",
        "ord",
    ),
    "quality_report": _with(
        f"""select 'rows' metric, {_bigint('count(*)')} value from dim2
union all select 'active_rows', {_bigint('count(*) filter (where "current")')} from dim2
union all select 'null_ids', {_bigint('count(*) - count(id)')} from dim2
union all select 'null_keys', {_bigint('count(*) - count(customer_sur_id)')} from dim2
union all select 'bad_intervals', {_bigint('count(*) filter (where valid_from > valid_to)')} from dim2
union all select 'multi_active_ids', {_bigint('count(*) filter (where n > 1)')}
  from (select id, count(*) n from dim2 where "current" and id is not null group by id) a
union all select 'dup_keys', {_bigint('count(*) filter (where n > 1)')}
  from (select customer_sur_id, count(*) n from dim2 where customer_sur_id is not null group by customer_sur_id) k""",
        "dim2",
    ),
    "replace_partition": _with(
        f"select *, '{RUN1}' as \"partition\" from b2 union all select *, '{RUN2}' from b1", "b1", "b2"
    ),
    "replace_partition_empty": _with(f"select *, '{RUN2}' as \"partition\" from b2", "b2"),
    "upsert_partition_move": _with(
        f"""select *, '{RUN1}' as "partition" from b1 where id % 4 = 0
union all select *, '{RUN3}' from b1 where id % 4 = 3
union all select *, '{RUN3}' from b2 where id % 4 in (1, 2)""",
        "b1", "b2",
    ),
    "reconciliation_report": _with(
        f"""select 'orders' metric, {_bigint('count(*)')} value from ord
union all select 'fact_rows', {_bigint('count(*)')} from fcth
union all select 'mart_orders', {_bigint('count(*)')} from fcth
union all select 'lost_orders', {_bigint('0')}
union all select 'mart_gap', {_bigint('0')}
union all select 'dup_orders', {_bigint('count(*)')} from (select order_id from fcth group by 1 having count(*) > 1)
union all select 'unknown_keys', {_bigint('count(*)')} from fcth
  where customer_sur_id is not null and customer_sur_id not in (select customer_sur_id from dim2 where "current")""",
        "ord", "fcth", "dim2",
    ),
    "table_by_path": _with(
        f"select *, '{RUN1}' as \"partition\" from b1 union all select *, '{RUN2}' from b2", "b1", "b2"
    ),
    "dim_scan": _with("select * from dim2", "dim2"),
    "fct_orders_table": _with(
        f"select *, '{RUN1}' as \"partition\" from fct1 union all select *, '{RUN2}' from fct2", "fct1", "fct2"
    ),
    "sales_mart_table": _with(
        f"select *, '{RUN1}' as \"partition\" from mart1 union all select *, '{RUN2}' from mart2",
        "mart1", "mart2",
    ),
    "fct_orders_clustered": _with(
        f"select *, '{RUN1}' as \"partition\" from fct1 union all select *, '{RUN2}' from fct2", "fct1", "fct2"
    ),
    "sales_mart_clustered": _with(
        f"select *, '{RUN1}' as \"partition\" from mart1 union all select *, '{RUN2}' from mart2",
        "mart1", "mart2",
    ),
    "latest_mart": _with("select state_id, deliver_date delivery_date, num_orders from mart2", "mart2"),
    "max_partition": _with(
        f"""select max(p) max_partition
from (select '{RUN1}' p from mart1 union all select '{RUN2}' from mart2) t""",
        "mart1", "mart2",
    ),
    "partition_list": _with(
        f"""select distinct p as "partition"
from (select '{RUN1}' p from mart1 union all select '{RUN2}' from mart2) t""",
        "mart1", "mart2",
    ),
    "recreate_tables": _with(
        "\nunion all\n".join(
            [
                f"""select '{name}' as name, '{run}' as "partition", {_bigint('count(*)')} n_rows from {cte} having count(*) > 0"""
                for name, ctes in (("customer", "b1 b2"), ("orders", "ord ord"), ("fct_orders", "fct1 fct2"), ("sales_mart", "mart1 mart2"))
                for run, cte in zip((RUN1, RUN2), ctes.split())
            ]
            + [f"""select 'dim_customer', "partition", {_bigint('count(*)')} from dim2 group by 2"""]
        ),
        "b1", "b2", "ord", "fct1", "fct2", "mart1", "mart2", "dim2",
    ),
    "upsert_hot_null": _with(
        """select * exclude id, case when id % 3 <> 0 then id end id from b2
union all
select * exclude id, case when id % 3 <> 0 then id end id from b1
where id % 3 = 0 or not exists (select 1 from b2 where b2.id = b1.id and b2.id % 3 <> 0)""",
        "b1", "b2",
    ),
    "table_counts": _with(
        """select (select count(*) from mart2) mart_view_rows,
       (select count(*) from dim2) dim_rows,
       (select count(*) from fct1) + (select count(*) from fct2) fact_rows,
       (select count(*) from b1) + (select count(*) from b2) customer_rows,
       2 * (select count(*) from ord) orders_rows""",
        "mart2", "dim2", "fct1", "fct2", "b1", "b2", "ord",
    ),
}
ORACLE_SQL["upsert_full_outer"] = ORACLE_SQL["upsert_multi_key"]


def _audit_sql() -> str:
    plain = ", ".join(
        f"('{step}', '{status}')"
        for step in ("run", "bronze", "silver", "dim_customer", "fct_orders", "gold", "sales_mart")
        for status in ("start", "end")
    )
    parts = []
    for run_id in ("run-1", "run-2"):
        parts.append(
            f"select '{run_id}' run_id, 'sales_mart' pipeline_id, step, status, cast(null as bigint) \"rows\" "
            f"from (values {plain}) t(step, status)"
        )
    published = {
        "run-1": {"customer": "b1", "orders": "ord", "dim_customer": "b1", "fct_orders": "ord", "sales_mart": "mart1"},
        "run-2": {"customer": "b2", "orders": "ord", "dim_customer": "chg2", "fct_orders": "ord", "sales_mart": "mart2"},
    }
    for run_id, tables in published.items():
        for name, source in tables.items():
            parts.append(
                f"select '{run_id}', 'sales_mart', 'publish:{name}', 'end', (select count(*) from {source})"
            )
    return _with("\nunion all\n".join(parts), "b1", "b2", "ord", "mart1", "mart2", "chg2")


def _sql_hash32(seed: str, tag: str, row: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', '{seed}', '{tag}', cast({row} as varchar))), 1, 8))::BIGINT"


def _sql_pick(values: list[str], seed: str, tag: str, row: str) -> str:
    items = ", ".join("'" + v + "'" for v in values)
    return f"list_extract([{items}], cast({_sql_hash32(seed, tag, row)} % {len(values)} + 1 as int))"


def _sql_uuid(seed: str, tag: str, row: str) -> str:
    h = f"md5(concat_ws(':', '{seed}', '{tag}', cast({row} as varchar)))"
    return (
        f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
        f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12)"
    )


ORACLE_SQL["run_audit"] = _audit_sql()

_GEN_TS = "timestamp '2024-06-01 00:00:00'"
ORACLE_SQL["gen_customer"] = f"""select cast(c_custkey as int) id,
       {_sql_pick(FIRST_NAMES, '7', 'first', 'c_custkey')} first_name,
       {_sql_pick(LAST_NAMES, '7', 'last', 'c_custkey')} last_name,
       {_sql_pick(STATES, '7', 'state', 'c_custkey')} state_id,
       {_GEN_TS} datetime_created, {_GEN_TS} datetime_updated
from customer"""
_LO = "(select min(c_custkey) from customer)"
_SPAN = "((select max(c_custkey) from customer) - (select min(c_custkey) from customer) + 1)"
ORACLE_SQL["gen_orders"] = f"""select {_sql_uuid('7', 'order', 'id')} order_id,
       cast({_sql_hash32('7', 'customer', 'id')} % {_SPAN} + {_LO} as int) customer_id,
       {_sql_uuid('7', 'item', 'id')} item_id,
       {_sql_pick(ITEMS, '7', 'item_name', 'id')} item_name,
       {_GEN_TS} delivered_on, {_GEN_TS} datetime_order_placed
from (select row_number() over () - 1 as id from orders) o"""
