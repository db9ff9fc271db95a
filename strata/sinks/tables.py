"""Publishing to catalog tables without a transactional table format.

**Released tables** (``strata.sinks.release``) are partitioned by one column. A write adds
folders ``<column>=<value>/commit=<n>`` and, when its job committed, gives the table's next
``Commit``; releasing that commit is what readers see.

* **Replace one partition** writes that partition's rows under a new commit; other
  partitions are untouched, a rerun replaces the same partition, and an empty batch leaves
  the partition without rows.
* **Upsert** rewrites only the partitions it touches: those that hold a row it replaces and
  those its rows belong to. A row that moves to another partition leaves its old one, which
  may be left without rows; all of it is one commit.

An upsert writes its rows sorted by key, with Parquet Bloom filters on the keys, and looks for
the partitions it touches with the source's keys as a filter, so later upserts of few keys
read few row groups. ``stage_partition(..., keys)`` writes so, too.

``stage_*`` write and return the commit, so several tables can be released together;
``replace_partition`` and ``upsert_table`` release it at once. A job that fails or is killed
leaves readers with the old rows, and folders that the next write of that number replaces.

**Tables without partitions** are written to a fresh folder ``<root>/_v/<token>``, at which
one catalog call points the table. Tokens sort by time and a folder whose job committed
holds ``_SUCCESS``, so a table created again finds its newest folder (``attach``).

A store may be **clustered** by a join key (``create_released_table(..., join_key, join_buckets)``): its files
are written in as many buckets, and joins and aggregates on that key read them without a
shuffle. The table's commit holds the number, so a store created again reads its files as
they were written.

Folders that readers no longer see are removed by ``remove_unused``. One writer at a time.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import replace
from typing import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.bounded import DEFAULT_BROADCAST_LIMIT, shuffled
from strata.operators.materialize import materialize
from strata.operators.merge import broadcast_fits, conform, key_filter, key_stats, merge_frames
from strata.schemas import ETL_INSERTED_COL, PARTITION_COL
from strata.sinks import files, release
from strata.sinks.release import Commit, quoted

VERSIONS = "_v"
COMMIT = "commit"
_GATHERED = "_strata_join_bucket"
# characters that Spark escapes in partition folders (fixed values of its path format)
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def stamp(df: DataFrame, partition: str) -> DataFrame:
    """Audit columns: ``etl_inserted`` (one timestamp per query) and ``partition``."""
    return df.withColumns(
        {ETL_INSERTED_COL: F.current_timestamp(), PARTITION_COL: F.lit(partition).cast("string")}
    )


def store_of(table: str) -> str:
    return f"{table}_store"


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of a table; of a released table, that of its store."""
    found = release.find(spark, table)
    return found.folder(table) if found else _catalog_location(spark, table)


def _catalog_location(spark: SparkSession, table: str, part: str = "") -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {part}").collect()
    # a partition's own entries come before those of its table
    return next(r["data_type"] for r in (rows if part else reversed(rows)) if r["col_name"] == "Location")


def table_partition_columns(spark: SparkSession, table: str) -> list[str]:
    """Partition columns; of a released table without its commit column."""
    if release.find(spark, table):
        return [c.name for c in spark.catalog.listColumns(store_of(table)) if c.isPartition and c.name != COMMIT]
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def create_released_view(spark: SparkSession, database: str, name: str, columns: Sequence[str], column: str = PARTITION_COL) -> None:
    """The view of a released table: the rows of its store that the release shows."""
    listed = ", ".join(f"`{c}`" for c in columns)
    number, floor, since = (release.of_release(database, name, part) for part in ("number", "floor", "since"))
    spark.sql(
        f"""CREATE OR REPLACE VIEW {database}.{name} AS
            SELECT {listed} FROM {store_of(f"{database}.{name}")}
            WHERE `{COMMIT}` > {floor} AND `{COMMIT}` <= {number}
              AND `{COMMIT}` >= coalesce(try_element_at({since}, `{column}`), 0)"""
    )


def join_key(spark: SparkSession, table: str) -> tuple[str, int] | None:
    """The column by which the store of a released table is clustered, and its number of buckets."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {store_of(table)}").collect()}
    if int(described.get("Num Buckets", 0)) == 0:
        return None
    return described["Bucket Columns"].strip("[]`"), int(described["Num Buckets"])


def join_buckets(spark: SparkSession, *tables: str) -> int:
    """The number of join buckets that all these released tables share; 0 when one has none or another number."""
    found = {(join_key(spark, table) or ("", 0))[1] for table in tables}
    return found.pop() if len(found) == 1 else 0


def gathered(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows moved so that a task writes few buckets; a bucket that is far larger than others, for example
    the one of rows without a key, is split over tasks."""
    placed = rows.withColumn(_GATHERED, F.pmod(F.hash(key), F.lit(buckets)))
    return placed.hint("rebalance", F.col(_GATHERED)).drop(_GATHERED)


def released_rows(spark: SparkSession, table: str, commit: Commit) -> DataFrame:
    """The rows of a released table under any of its commits, also one not released yet."""
    store = spark.table(store_of(table))
    *columns, column, _ = store.columns  # a store ends with its partition column and the commit
    since = ", ".join(f"{quoted(p)}, {n}L" for p, n in sorted(commit.since.items()))
    shown = f"`{COMMIT}` > {commit.floor} AND `{COMMIT}` <= {commit.number}"
    if since:
        shown += f" AND `{COMMIT}` >= coalesce(try_element_at(map({since}), `{column}`), 0)"
    return store.where(shown).select(*[F.col(f"`{c}`") for c in (*columns, column)])


def stored_parts(spark: SparkSession, store: str) -> list[dict[str, str]]:
    """The partitions of a store, as the catalog lists them."""
    rows = spark.sql(f"SHOW PARTITIONS {store}").collect()
    return [{k: unquote(v) for k, v in (x.split("=", 1) for x in r[0].split("/"))} for r in rows]


def part_spec(part: dict[str, str]) -> str:
    return "PARTITION (" + ", ".join(f"`{k}` = {quoted(v)}" for k, v in part.items()) + ")"


def drop_parts(spark: SparkSession, store: str, wanted: Callable[[dict[str, str]], bool], least_age: float = 0.0) -> list[dict[str, str]]:
    """Drop the partitions of a store that ``wanted`` names and that are ``least_age`` seconds old, and their files."""
    before, gone = time.time() - least_age, []
    for part in filter(wanted, stored_parts(spark, store)):
        location = _catalog_location(spark, store, part_spec(part))
        if least_age <= 0 or files.modified(spark, location) <= before:
            spark.sql(f"ALTER TABLE {store} DROP IF EXISTS {part_spec(part)}")
            files.delete(spark, location)
            gone.append(part)
    if gone:
        spark.catalog.refreshTable(store)
    return gone


def _cleared(spark: SparkSession, store: str, root: str, columns: Sequence[str], number: int) -> list[dict[str, str]]:
    """The partitions of a store, after what a stopped write left of commit ``number`` went."""
    stored = stored_parts(spark, store)
    if any(int(part[COMMIT]) == number for part in stored):
        drop_parts(spark, store, lambda part: int(part[COMMIT]) == number)
    for left in files.listed(spark, "/".join([root, *(f"{c}=*" for c in columns), f"{COMMIT}={number}"])):
        files.delete(spark, left)
    return [part for part in stored if int(part[COMMIT]) != number]


def _registered(spark: SparkSession, store: str, root: str, columns: Sequence[str], number: int) -> list[dict[str, str]]:
    """Let the catalog know the written partitions of commit ``number``."""
    names = [*columns, COMMIT]
    found = files.listed(spark, "/".join([root, *(f"{c}=*" for c in columns), f"{COMMIT}={number}"]))
    parts = [dict(zip(names, (unquote(x.split("=", 1)[1]) for x in f.rsplit("/", len(names))[1:]))) for f in found]
    if parts:
        spark.sql(f"ALTER TABLE {store} ADD IF NOT EXISTS {' '.join(map(part_spec, parts))}")
    spark.catalog.refreshTable(store)
    return parts


def key_options(keys: Sequence[str]) -> dict[str, str]:
    """Writer options for Bloom filters on the keys, no larger than a row group's distinct values need."""
    if not keys:
        return {}
    return {"parquet.bloom.filter.adaptive.enabled": "true"} | {f"parquet.bloom.filter.enabled#{k}": "true" for k in keys}


def write_commit(
    spark: SparkSession, store: str, root: str, rows: DataFrame, columns: Sequence[str], number: int, keys: Sequence[str] = ()
) -> tuple[list[dict[str, str]], int]:
    """Write ``rows`` as commit ``number`` of a store, in place of what a write that stopped may have left
    of it; returns all partitions of the store, and the rows written. ``columns`` are the partition
    columns before the commit; ``keys`` those that later upserts will look for."""
    stored = _cleared(spark, store, root, columns, number)
    counted = Observation()
    written = rows.withColumn(COMMIT, F.lit(number).cast("long")).observe(counted, F.count(F.lit(1)).alias("rows"))
    described = spark.catalog.listColumns(store)
    if any(c.isBucket for c in described):
        # by way of the catalog, which knows the buckets; it takes columns by position
        written.select(*[F.col(f"`{c.name}`") for c in described]).write.mode("append").insertInto(store)
    else:
        in_order = written.sortWithinPartitions(*columns, COMMIT, *keys) if keys else written
        in_order.write.options(**key_options(keys)).mode("append").partitionBy(*columns, COMMIT).parquet(root)
    return stored + _registered(spark, store, root, columns, number), int(counted.get["rows"])


def folder_name(column: str, value: str) -> str:
    """``column=value`` as Spark writes it in paths."""
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in value)


def _after(before: Commit, parts: list[dict[str, str]], column: str, touched: set[str]) -> Commit:
    """The commit after ``touched`` partitions were written as the next number; ``parts`` are all of the store."""
    number = before.number + 1
    stored = [(part[column], int(part[COMMIT])) for part in parts]
    since = before.since | {p: number for p in touched}
    # only where older folders remain, or none was written
    older = {p for p, n in stored if n < since.get(p, 0)}
    commit = replace(before, number=number, since={p: n for p, n in since.items() if p in older})
    return replace(commit, latest=max((p for p, n in stored if commit.shows(p, n)), default=None))


def stage_partition(
    spark: SparkSession, table: str, df: DataFrame, partition: str, base: Commit | None = None, placed: bool = False, keys: Sequence[str] = ()
) -> tuple[Commit, int]:
    """Write ``df`` as the rows of one partition of a released table; returns the commit that shows them, and their number.

    ``df`` is projected onto the table's other columns (extra columns dropped, types cast).
    ``base`` is the commit to go on from, by default the released one. Rows for a clustered
    store are gathered by bucket first, unless they are ``placed``: come from a join on its key.
    With ``keys`` the rows are sorted by them, with Bloom filters, for later upserts.
    """
    shown = _released(spark, table)
    before = shown.commit(table) if base is None else base
    *fields, of_column, _ = spark.table(store_of(table)).schema.fields
    column = of_column.name
    store, root, number = store_of(table), shown.folder(table), before.number + 1
    if clustered := join_key(spark, table):
        rows = conform(df, T.StructType(fields))
        rows = rows if placed else gathered(rows, *clustered)
        parts, n = write_commit(spark, store, root, rows.withColumn(column, F.lit(partition)), [column], number)
        return _after(before, parts, column, {partition}), n
    parts = _cleared(spark, store, root, [column], number)
    # one folder is known beforehand: written directly, the rows need no sort by partition
    folder = f"{root}/{folder_name(column, partition)}/{COMMIT}={number}"
    counted = Observation()
    rows = conform(df, T.StructType(fields)).observe(counted, F.count(F.lit(1)).alias("rows"))
    rows = rows.sortWithinPartitions(*keys) if keys else rows
    rows.write.options(**key_options(keys)).parquet(folder)
    n = int(counted.get["rows"])
    if not n:
        files.delete(spark, folder)
    return _after(before, parts + _registered(spark, store, root, [column], number), column, {partition}), n


def _released(spark: SparkSession, table: str) -> release.Release:
    found = release.find(spark, table)
    if found is None:
        raise ValueError(f"{table} is not released (strata.plans.ddl.create_released_table)")
    return found


def replace_partition(spark: SparkSession, table: str, df: DataFrame, partition: str, keys: Sequence[str] = ()) -> int:
    """Replace exactly the rows of one partition of a released table; returns the rows written.

    With ``keys`` they are laid out for later upserts on these columns.
    """
    commit, n = stage_partition(spark, table, df, partition, keys=keys)
    release.publish_one(spark, table, commit)
    return n


def holding_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str], n_keys: int, small: bool) -> DataFrame:
    """The partitions of ``target`` (by its last column) that hold a row with one of ``source``'s keys.

    Reads the key columns, of the row groups that may hold such a key.
    """
    column, pushed = target.columns[-1], key_filter(source, keys, n_keys)
    near = target.select(column, *keys)
    near = near if pushed is None else near.where(pushed)
    key_set = source.select(*keys).dropna().distinct()
    return near.join(F.broadcast(key_set) if small else shuffled(key_set), list(keys), "left_semi").select(column).distinct()


def stage_upsert(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
    base: Commit | None = None,
) -> tuple[Commit, int]:
    """Merge ``source`` into a released table on ``keys``; returns the commit that shows the result, and the source's rows.

    Only the touched partitions are rewritten. They are the partitions of the source's rows
    and, unless the partition column is a key, those that hold a row with one of its keys,
    found by a scan of the key columns. An empty source leaves the commit as it is.
    """
    shown = _released(spark, table)
    before = shown.commit(table) if base is None else base
    target = released_rows(spark, table, before)
    column = target.columns[-1]
    staged = materialize(conform(source, target.schema))
    found = staged.agg(F.count(F.lit(1)).alias("rows"), F.collect_set(column).alias("parts"), F.count(column).alias("known")).first()
    if not found["rows"]:
        return before, 0
    if found["known"] < found["rows"]:
        raise ValueError(f"rows without a value of {column!r} belong to no partition")
    stats = key_stats(staged, keys)
    touched = set(found["parts"])  # run partitions: as many as the catalog lists
    if column not in keys:
        small = broadcast_fits(stats[0], stats[1], broadcast_limit)
        touched |= {r[0] for r in holding_partitions(target, staged, keys, stats[0], small).collect()}
    base_rows = target.where(F.col(f"`{column}`").isin(*sorted(touched)))
    merged = merge_frames(base_rows, staged, keys, broadcast_limit=broadcast_limit, stats=stats)
    parts, _ = write_commit(spark, store_of(table), shown.folder(table), merged, [column], before.number + 1, keys)
    return _after(before, parts, column, touched), int(found["rows"])


def version_root(location: str) -> str:
    """The folder of a table without partitions, whichever of its versions the table is pointed at."""
    return location.split(f"/{VERSIONS}/")[0].rstrip("/")


def versions(spark: SparkSession, root: str) -> list[str]:
    """The version folders under a root whose job committed, oldest first."""
    return [f for f in files.listed(spark, f"{root}/{VERSIONS}/*") if files.exists(spark, f"{f}/_SUCCESS")]


def fresh_version(root: str) -> str:
    return f"{root}/{VERSIONS}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def upsert_table(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
) -> int:
    """Upsert ``source`` into a released table or one without partitions; returns the source's rows.

    An empty source leaves the current rows.
    """
    if release.find(spark, table):
        commit, n = stage_upsert(spark, table, source, keys, broadcast_limit)
        if n:
            release.publish_one(spark, table, commit)
        return n
    if table_partition_columns(spark, table):
        raise ValueError(f"{table} has partitions but is not released (strata.plans.ddl.create_released_table)")
    target = spark.table(table)
    staged = materialize(conform(source, target.schema))
    rows = staged.count()
    if not rows:
        return 0
    snapshot = fresh_version(version_root(table_location(spark, table)))
    merged = merge_frames(target, staged, keys, broadcast_limit=broadcast_limit).sortWithinPartitions(*keys)
    merged.write.options(**key_options(keys)).mode("errorifexists").parquet(snapshot)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(snapshot)}")
    spark.catalog.refreshTable(table)
    return rows


def attach(spark: SparkSession, table: str) -> None:
    """Point a table without partitions, just created, at the newest committed folder under its root."""
    found = versions(spark, version_root(table_location(spark, table)))
    if found:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(found[-1])}")
    spark.catalog.refreshTable(table)


def remove_unused(spark: SparkSession, table: str, least_age: float = 0.0) -> int:
    """Remove the folders that readers of a table do not see; returns how many went.

    Folders younger than ``least_age`` seconds stay. Not for use while a writer is at
    work; readers that run longer than ``least_age`` may lose their files.
    """
    if found := release.find(spark, table):
        commit, column = found.commit(table), spark.table(store_of(table)).columns[-2]
        gone = drop_parts(spark, store_of(table), lambda part: not commit.shows(part[column], int(part[COMMIT])), least_age)
        return len(gone)
    location = table_location(spark, table)
    root = version_root(location)
    used, before, removed = _tail(location), time.time() - least_age, 0
    # of a table that is pointed at a version, the files beside the versions are the oldest ones
    beside = files.listed(spark, f"{root}/*.parquet") if f"/{VERSIONS}/" in location else []
    for folder in files.listed(spark, f"{root}/{VERSIONS}/*") + beside:
        if _tail(folder) != used and files.modified(spark, folder) <= before:
            files.delete(spark, folder)
            removed += 1
    return removed


def _tail(location: str) -> str:
    """The part of a version folder's path from its token on, however the path is spelled."""
    return unquote(location.rstrip("/").rsplit(f"/{VERSIONS}/", 1)[-1])
