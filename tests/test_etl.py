"""The layered ETL over several runs: counts, invariants, audit, idempotence."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from strata.plans import ddl
from strata.plans.audit import RunAudit
from strata.plans import etl as etl_module
from strata.plans.etl import Dataset, LayeredETL, MissingInputs, SalesMartETL, synthetic_source
from strata.sources import customer_batch, orders_batch
from tests.conftest import SF_SMALL

RUNS = ["2024-03-01-00-00-00", "2024-03-02-00-00-00", "2024-03-03-00-00-00"]


def fresh(spark, scratch_dir):
    name = f"e_{uuid.uuid4().hex[:8]}"
    ddl.create_all(spark, scratch_dir, name, f"{name}_bi")
    audit = RunAudit(spark, ddl.create_audit_table(spark, scratch_dir, name))
    return name, audit


def test_synthetic_runs_match_published_counts(spark, scratch_dir):
    db, audit = fresh(spark, scratch_dir)
    for p in RUNS[:2]:
        SalesMartETL(spark, db, audit=audit, bronze_source=synthetic_source(200, 2000)).run(p)
    assert spark.table(f"{db}.dim_customer").count() == 200 * 2
    assert spark.table(f"{db}.fct_orders").count() == 2000 * 2
    assert spark.sql(f"select partition from {db}.sales_mart group by 1").count() == 2
    assert spark.table(f"{db}_bi.sales_mart").agg(F.sum("num_orders")).first()[0] == 2000
    steps = {(r["step"], r["status"]) for r in spark.table(audit.table).collect()}
    assert {("run", "start"), ("run", "end"), ("silver", "end"), ("publish:dim_customer", "end")} <= steps
    assert spark.table(audit.table).where("run_id is null").count() == 0


def test_fixture_runs_keep_scd2_invariants_and_rerun_is_stable(spark, scratch_dir):
    db, audit = fresh(spark, scratch_dir)

    def source(version):
        return lambda s, ctx: (customer_batch(s, SF_SMALL, version), orders_batch(s, SF_SMALL))

    SalesMartETL(spark, db, bronze_source=source(1)).run(RUNS[0])
    SalesMartETL(spark, db, bronze_source=source(2)).run(RUNS[1])
    dim = spark.table(f"{db}.dim_customer")
    before = sorted(map(tuple, dim.collect()), key=str)
    # one active row per id
    assert dim.where("current").groupBy("id").count().where("count > 1").count() == 0
    # valid_from <= valid_to
    assert dim.where("valid_from > valid_to").count() == 0
    # a closed row ends where the next version of the id starts
    w = Window.partitionBy("id").orderBy("valid_from")
    chained = dim.withColumn("next_from", F.lead("valid_from").over(w)).where(F.col("next_from").isNotNull())
    assert chained.where(F.col("valid_to") != F.col("next_from")).count() == 0
    # rerunning batch 2 as a new run changes no dimension row
    SalesMartETL(spark, db, bronze_source=source(2)).run(RUNS[2])
    after = sorted(map(tuple, spark.table(f"{db}.dim_customer").collect()), key=str)
    assert after == before
    # and the rerun's fact partition equals run 2's (same active keys)
    fact = spark.table(f"{db}.fct_orders")
    f2 = fact.where(F.col("partition") == RUNS[1]).drop("etl_inserted", "partition")
    f3 = fact.where(F.col("partition") == RUNS[2]).drop("etl_inserted", "partition")
    assert f2.exceptAll(f3).count() == 0 and f3.exceptAll(f2).count() == 0


def test_required_inputs_and_skip_write(spark):
    with pytest.raises(MissingInputs) as found:
        LayeredETL.check_required_inputs({}, ["orders", "customer"])
    assert found.value.names == ["customer", "orders"]

    class Probe(SalesMartETL):
        pass

    etl = Probe(spark, "nowhere")
    # a skipped dataset is not written (the table does not even exist)
    etl.publish({"x": Dataset("x", spark.range(1), "nowhere.x", "2024-01-01-00-00-00", skip_write=True)})
    assert etl.published_rows == {}


def test_partition_format_is_validated(spark):
    etl = SalesMartETL(spark, "nowhere")
    with pytest.raises(ValueError):
        etl.run("YYYY-MM-DD_HH")


def test_changed_share_and_latest_only(spark, scratch_dir):
    db, audit = fresh(spark, scratch_dir)
    source = synthetic_source(400, 1000, changed_share=0.25)
    for p in RUNS[:2]:
        SalesMartETL(spark, db, bronze_source=source, latest_only=True).run(p)
    dim = spark.table(f"{db}.dim_customer")
    changed = dim.where(~F.col("current")).count()
    # about a quarter of the customers got a second version in run 2
    assert 50 <= changed <= 150
    assert dim.count() == 400 + changed
    assert dim.where("current").count() == 400


def test_quality_gate_leaves_everything_as_it_was(spark, scratch_dir):
    from strata.operators.quality import InvalidDataError
    from tests.conftest import ts
    from tests.frames import customers, orders

    db, _ = fresh(spark, scratch_dir)

    def source(rows):
        return lambda s, ctx: (customers(s, rows), orders(s, [("o1", 1, ts(3))]))

    good = [(1, "CA", ts(1)), (2, "TX", ts(1))]
    SalesMartETL(spark, db, bronze_source=source(good), quality_gate=True).run(RUNS[0])
    before = sorted(map(tuple, spark.table(f"{db}.dim_customer").collect()), key=str)
    bad = [(1, "CA", ts(1)), (3, "NY", ts(2)), (3, "TX", ts(1))]
    with pytest.raises(InvalidDataError, match="multi_active_ids"):
        SalesMartETL(spark, db, bronze_source=source(bad), quality_gate=True).run(RUNS[1])
    # the failed run changed neither the dimension nor fact and mart
    assert sorted(map(tuple, spark.table(f"{db}.dim_customer").collect()), key=str) == before
    assert spark.table(f"{db}.fct_orders").where(F.col("partition") == RUNS[1]).count() == 0
    assert spark.table(f"{db}.sales_mart").where(F.col("partition") == RUNS[1]).count() == 0


def test_audit_has_all_steps_with_parameters_in_few_writes(spark, scratch_dir, monkeypatch):
    db, audit = fresh(spark, scratch_dir)
    writes = []
    flush = RunAudit.flush
    monkeypatch.setattr(RunAudit, "flush", lambda self: (writes.append(len(self.held)) if self.held else None, flush(self)))
    SalesMartETL(spark, db, audit=audit, bronze_source=synthetic_source(50, 200)).run(RUNS[0])
    assert len(writes) <= 4
    found = spark.table(audit.table).collect()
    assert len(found) == sum(writes)
    steps = {r["step"] for r in found}
    assert {"run", "bronze", "silver", "gold", "dim_customer", "fct_orders", "sales_mart"} <= steps
    params = {r["step"]: r["run_params"] for r in found if r["status"] == "end"}
    assert f"{db}.fct_orders" in params["fct_orders"] and RUNS[0] in params["fct_orders"]
    assert "customer, orders" in params["silver"]


def test_failed_step_is_audited(spark, scratch_dir):
    db, audit = fresh(spark, scratch_dir)

    def broken(s, ctx):
        raise RuntimeError("no source today")

    with pytest.raises(RuntimeError):
        SalesMartETL(spark, db, audit=audit, bronze_source=broken).run(RUNS[0])
    failed = {r["step"] for r in spark.table(audit.table).where("status = 'failed'").collect()}
    assert failed == {"bronze", "run"}


def test_default_run_shows_every_state(spark, scratch_dir):
    db, _ = fresh(spark, scratch_dir)
    SalesMartETL(spark, db, bronze_source=synthetic_source(1000, 10_000)).run(RUNS[0])
    view = spark.table(f"{db}_bi.sales_mart")
    assert view.select("state_id").distinct().count() == 59


def test_launchers_create_run_and_drop(spark, scratch_dir):
    db = f"l_{uuid.uuid4().hex[:8]}"
    names = ["--database", db, "--bi-database", f"{db}_bi"]
    ddl.main(["create", "--path", scratch_dir, *names], spark)
    etl_module.main([*names, "--partition", RUNS[0], "--customers", "50", "--orders", "300"], spark)
    etl_module.main([*names, "--partition", RUNS[1], "--customers", "50", "--orders", "200"], spark)
    view = spark.table(f"{db}_bi.sales_mart")
    assert view.agg(F.sum("num_orders")).first()[0] == 200
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and "Subquery" not in plan  # the release names the newest run
    assert spark.table(f"{db}.run_metadata").count() > 20
    ddl.main(["drop", "--layer", "silver", *names], spark)
    assert not spark.catalog.tableExists(f"{db}.fct_orders") and spark.catalog.tableExists(f"{db}.orders")
    ddl.main(["create", "--layer", "silver", "--path", scratch_dir, *names], spark)
    assert spark.table(f"{db}.dim_customer").count() == 100
    ddl.main(["purge", "--layer", "silver", "--path", scratch_dir, *names], spark)
    ddl.main(["create", "--layer", "silver", "--path", scratch_dir, *names], spark)
    assert spark.table(f"{db}.dim_customer").count() == 0
    ddl.main(["drop", *names], spark)
    assert not spark.catalog.databaseExists(db) and not spark.catalog.databaseExists(f"{db}_bi")
