"""Quality gates: of the dimension, and across the tables of a run.

Counts the conditions the SCD2 rules let through silently: NULL ids, NULL
surrogate keys, ids with more than one active version, duplicated surrogate keys,
and rows whose validity interval is reversed. The report is a small long-format
frame (``check``, ``value``) built from three aggregates. ``assert_quality`` raises when
a check fails; as the ``gate`` of a dimension publish it sees the rows the publish wrote
(the new active rows and the rows it closed) before they are committed.

``reconciliation_report`` compares what a run wrote: every order is in the fact once, every
key of the fact is an active one, and the mart counts every row of the fact.
``assert_reconciled`` raises before the run is released.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.bounded import shuffled


class InvalidDataError(ValueError):
    """The data breaks a rule of the quality gate."""


INFO_CHECKS = ("rows", "active_rows")


def _long(df: DataFrame) -> DataFrame:
    pairs = ", ".join(f"'{c}', cast(`{c}` as bigint)" for c in df.columns)
    return df.selectExpr(f"stack({len(df.columns)}, {pairs}) as (check, value)")


def quality_report(dim: DataFrame, key: str = "id", sur_key: str = "customer_sur_id") -> DataFrame:
    """Rows ``(check, value)`` for rows, active_rows, null_ids, null_keys,
    bad_intervals, multi_active_ids and dup_keys."""
    totals = dim.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("current"), 1)).alias("active_rows"),
        F.count(F.when(F.col(key).isNull(), 1)).alias("null_ids"),
        F.count(F.when(F.col(sur_key).isNull(), 1)).alias("null_keys"),
        F.count(F.when(F.col("valid_from") > F.col("valid_to"), 1)).alias("bad_intervals"),
    )
    multi_active = (
        dim.where(F.col("current") & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count(F.when(F.col("n") > 1, 1)).alias("multi_active_ids"))
    )
    dup_keys = (
        dim.where(F.col(sur_key).isNotNull())
        .groupBy(sur_key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count(F.when(F.col("n") > 1, 1)).alias("dup_keys"))
    )
    return _long(totals).unionByName(_long(multi_active)).unionByName(_long(dup_keys))


def assert_quality(dim: DataFrame, allow: tuple[str, ...] = ()) -> dict:
    """Raise ``InvalidDataError`` when any check other than those in ``allow`` fails."""
    report = {r["check"]: r["value"] for r in quality_report(dim).collect()}
    failed = {k: v for k, v in report.items() if k not in INFO_CHECKS and k not in allow and v}
    if failed:
        raise InvalidDataError(f"dimension failed quality checks: {failed}")
    return report


def reconciliation_report(orders: DataFrame, fact: DataFrame, mart: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows ``(check, value)``: orders, fact_rows, mart_orders, lost_orders (orders less fact rows),
    mart_gap (fact rows less orders of the mart), dup_orders (order ids of the fact that occur
    more than once) and unknown_keys (fact rows whose key no active row has).

    Tables are joined on counts per key, so a hot customer is one row in the join.
    """
    one = F.lit(1)
    sizes = (
        orders.agg(F.count(one).alias("orders"))
        .unionByName(fact.agg(F.count(one).alias("fact_rows")), allowMissingColumns=True)
        .unionByName(mart.agg(F.coalesce(F.sum("num_orders"), F.lit(0)).alias("mart_orders")), allowMissingColumns=True)
    )
    totals = sizes.agg(*(F.max(c).alias(c) for c in sizes.columns)).withColumns(
        {"lost_orders": F.col("orders") - F.col("fact_rows"), "mart_gap": F.col("fact_rows") - F.col("mart_orders")}
    )
    repeated = (
        fact.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.count(one).alias("n"))
        .agg(F.count(F.when(F.col("n") > 1, 1)).alias("dup_orders"))
    )
    used = fact.where(F.col("customer_sur_id").isNotNull()).groupBy("customer_sur_id").agg(F.count(one).alias("n"))
    known = dim.where(F.col("current")).select("customer_sur_id")
    unknown = used.join(shuffled(known), "customer_sur_id", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unknown_keys"))
    return _long(totals).unionByName(_long(repeated)).unionByName(_long(unknown))


def assert_reconciled(orders: DataFrame, fact: DataFrame, mart: DataFrame, dim: DataFrame, allow: tuple[str, ...] = ()) -> dict:
    """Raise ``InvalidDataError`` when the tables of a run do not agree, but for the checks in ``allow``."""
    report = {r["check"]: r["value"] for r in reconciliation_report(orders, fact, mart, dim).collect()}
    failed = {k: report[k] for k in ("lost_orders", "mart_gap", "dup_orders", "unknown_keys") if k not in allow and report[k]}
    if failed:
        raise InvalidDataError(f"the tables of the run do not agree: {failed}")
    return report
