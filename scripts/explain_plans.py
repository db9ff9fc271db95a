"""Print the physical plans of the run-2 ETL steps as the ETL runs them: over the published
tables, with the active rows of the dimension's commit before run 2.

Usage: python scripts/explain_plans.py [sf_dir] [mode]   (mode: simple | formatted | executed)
``executed`` runs each step (noop sink) and prints the final adaptive plan.
"""

from __future__ import annotations

import os
import sys
import uuid

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from strata.operators import build_fact, build_mart, conform, materialize, merge_frames, scd2_changes  # noqa: E402
from strata.plans import ddl  # noqa: E402
from strata.plans.etl import SalesMartETL  # noqa: E402
from strata.plans.registry import RUN1, RUN2  # noqa: E402
from strata.session import build_session, scratch_path  # noqa: E402
from strata.sinks import DimensionTables, active_rows, history_rows, stamp  # noqa: E402
from strata.sinks.dimension import colliding_history  # noqa: E402
from strata.sources import customer_batch, orders_batch  # noqa: E402


def show(title, df, mode):
    print(f"\n===== {title} =====")
    if mode == "executed":
        df.write.format("noop").mode("overwrite").save()
        print(df._jdf.queryExecution().executedPlan().toString())
    else:
        df.explain(mode)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    mode = sys.argv[2] if len(sys.argv) > 2 else "simple"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    db = f"plans_{uuid.uuid4().hex[:8]}"
    ddl.create_all(spark, scratch_path(spark, "plans"), db, f"{db}_bi")
    for version, run in ((1, RUN1), (2, RUN2)):
        source = lambda s, c, v=version: (customer_batch(s, sf, v), orders_batch(s, sf))
        SalesMartETL(spark, db, bronze_source=source, bi_database=f"{db}_bi").run(run)
        if version == 1:
            before = materialize(active_rows(spark, DimensionTables.of(db)))
    tables = DimensionTables.of(db)
    customer = spark.table(f"{db}.customer").where(F.col("partition") == RUN2)
    orders = spark.table(f"{db}.orders").where(F.col("partition") == RUN2)
    fact = spark.table(f"{db}.fct_orders").where(F.col("partition") == RUN2)
    active = active_rows(spark, tables)
    show("scd2 change set (batch vs active rows)", scd2_changes(customer, before, batch_rows=customer.count()), mode)
    staged = materialize(conform(stamp(scd2_changes(customer, before), RUN2), before.schema))
    show("merge of the change set into the active rows", merge_frames(before, staged, ["customer_sur_id"]), mode)
    show("merge, large-source path", merge_frames(before, staged, ["customer_sur_id"], broadcast_limit=0), mode)
    show("collision check against history", colliding_history(history_rows(spark, tables), staged, ["customer_sur_id"], True), mode)
    show("fact build", build_fact(orders, active), mode)
    show("mart aggregate", build_mart(fact, active), mode)
    show("mart aggregate, shuffle path", build_mart(fact, active, broadcast_limit=0), mode)
    show("BI view", spark.table(f"{db}_bi.sales_mart"), mode)


if __name__ == "__main__":
    main()
