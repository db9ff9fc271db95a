"""Databases, tables and the BI view, and their launcher.

Tables are views of external Parquet stores with an explicit location, shown by the
database's release (``strata.sinks.release``). Creating what exists changes nothing;
creating a table again after a drop shows what the newest release under the path shows.
Dropping never deletes files; ``purge_layer`` does. Every layer can be created, dropped
and purged alone; a database goes when its last object has gone.

    python -m strata.plans.ddl create --path s3a://bucket/warehouse
    python -m strata.plans.ddl drop --layer silver
    python -m strata.plans.ddl purge --path s3a://bucket/warehouse --layer silver
"""

from __future__ import annotations

import argparse
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from strata.plans.audit import attach_log
from strata.schemas import (
    CUSTOMER_TABLE,
    DIM_CUSTOMER,
    FCT_ORDERS,
    ORDERS_TABLE,
    PARTITION_COL,
    RUN_METADATA,
    SALES_MART,
    ddl_columns,
)
from strata.sinks import files, release
from strata.sinks.dimension import BUCKET, BUCKETS, PART, DimensionTables, create_dimension_view
from strata.sinks.release import Commit, quoted
from strata.sinks.tables import COMMIT, create_released_view, store_of

DATABASE, BI_DATABASE = "ecommerce", "businessintelligence"
DIMENSION_VIEW = "dim_customer"
VIEW = "sales_mart"
AUDIT = "run_metadata"

ORDER_KEY = "customer_id"


class JoinKey(NamedTuple):
    """The column that a store's files are clustered by, the number of buckets (0: none), and the order in a file."""

    column: str
    buckets: int
    order: str = ""

    @property
    def sort(self) -> str:
        # by the key itself, rows without one fill row groups of their own, which a join's filter skips
        return self.order or self.column


LAYERS: dict[str, dict[str, T.StructType]] = {
    "bronze": {"customer": CUSTOMER_TABLE, "orders": ORDERS_TABLE},
    "silver": {DIMENSION_VIEW: DIM_CUSTOMER, "fct_orders": FCT_ORDERS},
    "gold": {"sales_mart": SALES_MART},
}


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    location: str,
    partition_by: tuple[str, ...] = (PARTITION_COL,),
    clustered: str = "",
) -> bool:
    """Create ``table`` unless it exists; returns whether it did. The folder is made if need be."""
    if spark.catalog.tableExists(table):
        return False
    files.make_folder(spark, location)
    columns = ", ".join(f"`{c}`" for c in partition_by)
    partitioned = f"PARTITIONED BY ({columns})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({ddl_columns(schema)}) USING PARQUET {partitioned} {clustered} LOCATION {quoted(location)}")
    return True


def _create_store(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    path: str,
    partition_by: dict[str, T.DataType],
    join: JoinKey | None = None,
) -> int:
    """The store of a released table: its columns and the partition columns, the last of them the commit.

    Returns its number of join buckets: that of the files under ``path`` if a release names
    them, else that of ``join``, for new files.
    """
    name = table.rsplit(".", 1)[1]
    location, known = f"{path.rstrip('/')}/{name}", release.last_marked(spark, path).tables.get(name)
    buckets = known.join_buckets if known else join.buckets if join else 0
    clustered = f"CLUSTERED BY (`{join.column}`) SORTED BY (`{join.sort}`) INTO {buckets} BUCKETS" if join and buckets else ""
    columns = [f for f in schema.fields if f.name not in partition_by]
    columns += [T.StructField(c, kind) for c, kind in (partition_by | {COMMIT: T.LongType()}).items()]
    if create_table(spark, store_of(table), T.StructType(columns), location, (*partition_by, COMMIT), clustered):
        if files.listed(spark, f"{location}/*=*"):
            spark.sql(f"ALTER TABLE {store_of(table)} RECOVER PARTITIONS")
    return buckets


def create_released_table(
    spark: SparkSession,
    database: str,
    name: str,
    schema: T.StructType,
    path: str,
    column: str = PARTITION_COL,
    join: JoinKey | None = None,
) -> None:
    """A table partitioned by ``column``, one of its string columns (it comes last), whose commits the database's release shows.

    With ``join`` its files are clustered by a join key.
    """
    create_database(spark, database)
    buckets = _create_store(spark, f"{database}.{name}", schema, path, {column: schema[column].dataType}, join)
    release.open_release(spark, database, path, {name: Commit(join_buckets=buckets)})
    if not spark.catalog.tableExists(f"{database}.{name}"):
        create_released_view(spark, database, name, [*(c for c in schema.fieldNames() if c != column), column], column)


def create_dimension(
    spark: SparkSession, database: str, name: str, path: str, buckets: int = BUCKETS, join_buckets: int = 0
) -> None:
    """The SCD2 dimension with its active rows in ``buckets`` buckets (about a million rows each are a good size).

    With ``join_buckets`` it has that many buckets instead, and its files are clustered by id, too.
    """
    create_database(spark, database)
    kinds = {PART: T.StringType(), BUCKET: T.IntegerType()}
    # sorted by valid_from, the ranges of history files are narrow for the collision check
    join_buckets = _create_store(spark, f"{database}.{name}", DIM_CUSTOMER, path, kinds, JoinKey("id", join_buckets, "valid_from"))
    live = (0,) * (join_buckets or buckets)
    release.open_release(spark, database, path, {name: Commit(live=live, join_buckets=join_buckets)})
    tables = DimensionTables.of(database, name)
    if not spark.catalog.tableExists(tables.view):
        create_dimension_view(spark, tables)


def create_bronze_tables(spark: SparkSession, path: str, database: str = DATABASE, join_buckets: int = 0) -> None:
    for name, schema in LAYERS["bronze"].items():
        join = JoinKey(ORDER_KEY, join_buckets) if ORDER_KEY in schema.fieldNames() else None
        create_released_table(spark, database, name, schema, path, join=join)


def create_silver_tables(
    spark: SparkSession, path: str, database: str = DATABASE, buckets: int = BUCKETS, join_buckets: int = 0
) -> None:
    create_dimension(spark, database, DIMENSION_VIEW, path, buckets, join_buckets)
    create_released_table(spark, database, "fct_orders", FCT_ORDERS, path, join=JoinKey(ORDER_KEY, join_buckets))


def create_gold_tables(spark: SparkSession, path: str, database: str = DATABASE) -> None:
    for name, schema in LAYERS["gold"].items():
        create_released_table(spark, database, name, schema, path)


def create_interface_views(
    spark: SparkSession, database: str = BI_DATABASE, src_database: str = DATABASE, released: bool = False
) -> None:
    """The BI view: newest run of the mart, ``deliver_date`` renamed ``delivery_date``.

    With ``released`` the newest run is the one that the release names, a literal after
    optimization: a reader plans one partition and runs nothing else, and the view changes
    with the release. Without, it is a scalar subquery over the mart.
    """
    create_database(spark, database)
    newest = f"(SELECT max(`{PARTITION_COL}`) FROM {src_database}.{VIEW})"
    if released:
        newest = release.of_release(src_database, VIEW, "latest")
    spark.sql(
        f"""CREATE OR REPLACE VIEW {database}.{VIEW} TBLPROPERTIES ('strata.released' = '{str(released).lower()}') AS
            SELECT state_id, deliver_date AS delivery_date, num_orders
            FROM {src_database}.{VIEW}
            WHERE `{PARTITION_COL}` = {newest}"""
    )


def point_interface_views(spark: SparkSession, database: str, src_database: str) -> None:
    """Let the BI view follow the release, unless it does."""
    if spark.catalog.tableExists(f"{database}.{VIEW}"):
        found = spark.sql(f"SHOW TBLPROPERTIES {database}.{VIEW} ('strata.released')").collect()
        if found[0]["value"] == "true":
            return
    create_interface_views(spark, database, src_database, released=True)


def create_audit_table(spark: SparkSession, path: str, database: str = DATABASE, name: str = AUDIT) -> str:
    create_database(spark, database)
    if create_table(spark, f"{database}.{name}", RUN_METADATA, f"{path.rstrip('/')}/{name}", ()):
        attach_log(spark, f"{database}.{name}")
    return f"{database}.{name}"


def create_all(
    spark: SparkSession, path: str, database: str = DATABASE, bi_database: str = BI_DATABASE, join_buckets: int = 0
) -> None:
    """All layers. With ``join_buckets`` orders, fact and dimension are clustered by customer in that many buckets."""
    create_bronze_tables(spark, path, database, join_buckets)
    create_silver_tables(spark, path, database, join_buckets=join_buckets)
    create_gold_tables(spark, path, database)
    _create_missing_interface(spark, bi_database, database)


def _create_missing_interface(spark: SparkSession, bi_database: str, database: str) -> None:
    if not spark.catalog.tableExists(f"{bi_database}.{VIEW}"):
        create_interface_views(spark, bi_database, database)


def _drop_database_if_empty(spark: SparkSession, database: str) -> None:
    if not spark.catalog.databaseExists(database):
        return
    left = {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").where("not isTemporary").collect()}
    if left <= {release.RELEASE}:
        spark.sql(f"DROP VIEW IF EXISTS {release.release_view(database)}")
        spark.sql(f"DROP DATABASE {database}")


def drop_layer(spark: SparkSession, layer: str, database: str = DATABASE, bi_database: str = BI_DATABASE) -> None:
    """Drop the catalog objects of one layer (bronze, silver, gold, interface or audit); files stay."""
    if layer == "interface":
        if spark.catalog.databaseExists(bi_database):
            spark.sql(f"DROP VIEW IF EXISTS {bi_database}.{VIEW}")
        _drop_database_if_empty(spark, bi_database)
        return
    if not spark.catalog.databaseExists(database):
        return
    if layer == "audit":
        spark.sql(f"DROP TABLE IF EXISTS {database}.{AUDIT}")
    for name in LAYERS.get(layer, ()):
        spark.sql(f"DROP VIEW IF EXISTS {database}.{name}")
        spark.sql(f"DROP TABLE IF EXISTS {store_of(f'{database}.{name}')}")
    _drop_database_if_empty(spark, database)


def drop_all(spark: SparkSession, database: str = DATABASE, bi_database: str = BI_DATABASE) -> None:
    for layer in ("interface", "gold", "silver", "bronze", "audit"):
        drop_layer(spark, layer, database, bi_database)


def purge_layer(spark: SparkSession, layer: str, path: str, database: str = DATABASE, bi_database: str = BI_DATABASE) -> None:
    """Drop one layer and delete its files: nothing of it can be attached again."""
    drop_layer(spark, layer, database, bi_database)
    if layer in LAYERS:
        release.forget(spark, database, path.rstrip("/"), list(LAYERS[layer]))
    for name in (AUDIT,) if layer == "audit" else LAYERS.get(layer, ()):
        files.delete(spark, f"{path.rstrip('/')}/{name}")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    layers = [*LAYERS, "interface", "audit"]
    parser = argparse.ArgumentParser(description="Create, drop or purge the tables.")
    parser.add_argument("action", choices=["create", "drop", "purge"])
    parser.add_argument("--path", help="folder of the tables (for create and purge)")
    parser.add_argument("--layer", choices=[*layers, "all"], default="all")
    parser.add_argument("--database", default=DATABASE)
    parser.add_argument("--bi-database", default=BI_DATABASE)
    parser.add_argument("--join-buckets", type=int, default=0, help="buckets of orders, fact and dimension by customer")
    args = parser.parse_args(argv)
    if args.action != "drop" and not args.path:
        parser.error("--path is needed")
    if spark is None:
        from strata.session import build_session

        spark = build_session(app_name="strata-ddl")
    chosen = layers if args.layer == "all" else [args.layer]
    create = {
        "bronze": lambda: create_bronze_tables(spark, args.path, args.database, args.join_buckets),
        "silver": lambda: create_silver_tables(spark, args.path, args.database, join_buckets=args.join_buckets),
        "gold": lambda: create_gold_tables(spark, args.path, args.database),
        "interface": lambda: _create_missing_interface(spark, args.bi_database, args.database),
        "audit": lambda: create_audit_table(spark, args.path, args.database),
    }
    for layer in chosen if args.action == "create" else reversed(chosen):
        if args.action == "create":
            create[layer]()
        elif args.action == "drop":
            drop_layer(spark, layer, args.database, args.bi_database)
        else:
            purge_layer(spark, layer, args.path, args.database, args.bi_database)


if __name__ == "__main__":
    main()
