"""The release of a database: one object that says which commits of its tables readers see.

A released table ``<name>`` is a view over ``<name>_store``, an external Parquet table whose
last partition column is ``commit``. Every write adds folders under a new commit number;
nothing that readers see changes. What they see is a ``Commit`` per table, and the commits
of all tables together are the release: the view ``strata_release``, one row of literals.
Replacing that view is a single catalog call, so any number of partitions and tables change
together: readers see all of a run or nothing of it.

The tables' views take their numbers from the release by scalar subqueries. It has no
input but literals, so the optimizer turns the subqueries into literals and the filter into
a partition filter: a reader plans only the folders that are shown, and runs no subquery.

Before the view, the release is written as ``<path>/_releases/<number>``, from which the
views of dropped tables are created again. One writer per database at a time.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

from strata.sinks import files

RELEASE = "strata_release"


def quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Commit:
    """What readers see of one table.

    Commits up to ``number`` and above ``floor``. ``since`` holds, for partitions that were
    written again, the commit of their present rows (a partition without rows is there
    alone); ``live`` the same per bucket, for bucketed tables. ``latest`` is the greatest
    partition that has rows, ``epochs`` the last published epoch of each stream.
    ``join_buckets`` is the number of buckets by join key that its files are written in, 0 for none.
    """

    number: int = 0
    floor: int = 0
    since: dict[str, int] = field(default_factory=dict)
    live: tuple[int, ...] = ()
    latest: str | None = None
    epochs: dict[str, int] = field(default_factory=dict)
    join_buckets: int = 0

    @classmethod
    def of(cls, values: dict) -> "Commit":
        return replace(cls(**values), live=tuple(values["live"]))

    def shows(self, partition: str, number: int) -> bool:
        return self.floor < number <= self.number and number >= self.since.get(partition, 0)

    def sql(self) -> str:
        def numbers(held: dict[str, int]) -> str:
            items = ", ".join(f"{quoted(k)}, {v}L" for k, v in sorted(held.items()))
            return f"CAST(map({items}) AS map<string, bigint>)"

        latest = "NULL" if self.latest is None else quoted(self.latest)
        return (
            f"named_struct('number', {self.number}L, 'floor', {self.floor}L, 'since', {numbers(self.since)}, "
            f"'live', CAST(array({', '.join(f'{n}L' for n in self.live)}) AS array<bigint>), "
            f"'latest', CAST({latest} AS string), 'epochs', {numbers(self.epochs)}, "
            f"'join_buckets', {self.join_buckets})"
        )


@dataclass(frozen=True)
class Release:
    """The commits of all tables; the store of table ``name`` lies in ``<path>/<name>``."""

    number: int
    path: str
    tables: dict[str, Commit]

    def folder(self, table: str) -> str:
        return f"{self.path}/{table.rsplit('.', 1)[1]}"

    def commit(self, table: str) -> Commit:
        return self.tables[table.rsplit(".", 1)[1]]


def release_view(database: str) -> str:
    return f"{database}.{RELEASE}"


def of_release(database: str, name: str, part: str) -> str:
    """SQL of one value of a table's commit, for the text of its view."""
    return f"(SELECT `{name}`.{part} FROM {release_view(database)})"


def exists(spark: SparkSession, database: str) -> bool:
    return spark.catalog.tableExists(release_view(database))


def read(spark: SparkSession, database: str) -> Release:
    """The release that readers see now."""
    row = spark.table(release_view(database)).collect()[0].asDict(recursive=True)  # literals: no job runs
    tables = {name: Commit.of(value) for name, value in row.items() if name not in ("number", "path")}
    return Release(row["number"], row["path"], tables)


def find(spark: SparkSession, table: str) -> Release | None:
    """The release that shows ``database.name``, or None for other tables."""
    database, _, name = table.rpartition(".")
    if not database or not exists(spark, database):
        return None
    found = read(spark, database)
    return found if name in found.tables else None


def current(spark: SparkSession, table: str) -> Commit:
    """What readers see of ``database.name`` now."""
    return read(spark, table.rsplit(".", 1)[0]).commit(table)


def _show(spark: SparkSession, database: str, release: Release) -> None:
    columns = "".join(f", {commit.sql()} AS `{name}`" for name, commit in sorted(release.tables.items()))
    spark.sql(
        f"""CREATE OR REPLACE VIEW {release_view(database)} AS
            SELECT {release.number}L AS number, {quoted(release.path)} AS path{columns}"""
    )


def _mark(spark: SparkSession, release: Release) -> None:
    text = json.dumps({name: asdict(commit) for name, commit in release.tables.items()})
    files.write_text(spark, f"{release.path}/_releases/{release.number:012d}", text)


def last_marked(spark: SparkSession, path: str) -> Release:
    """The newest release that was written under ``path``; number 0 when there is none."""
    path = path.rstrip("/")
    found = files.listed(spark, f"{path}/_releases/*")
    if not found:
        return Release(0, path, {})
    tables = json.loads(files.read_text(spark, found[-1]))
    return Release(int(found[-1].rsplit("/", 1)[1]), path, {name: Commit.of(value) for name, value in tables.items()})


def publish(spark: SparkSession, database: str, commits: dict[str, Commit]) -> Release:
    """Show these commits from now on, all of them at once; other tables stay as they are."""
    before = read(spark, database)
    after = Release(before.number + 1, before.path, before.tables | commits)
    _mark(spark, after)
    _show(spark, database, after)
    return after


def publish_one(spark: SparkSession, table: str, commit: Commit) -> None:
    database, name = table.rsplit(".", 1)
    publish(spark, database, {name: commit})


def open_release(spark: SparkSession, database: str, path: str, names: dict[str, Commit]) -> None:
    """Create the release of ``database`` from the newest one under ``path``, unless it exists, and add missing tables."""
    if not exists(spark, database):
        _show(spark, database, last_marked(spark, path))
    found = read(spark, database)
    if found.path != path.rstrip("/"):
        raise ValueError(f"the tables of {database} lie in {found.path}, not in {path}")
    known = found.tables
    added = {name: commit for name, commit in names.items() if name not in known}
    if added:
        publish(spark, database, added)


def forget(spark: SparkSession, database: str, path: str, names: list[str]) -> None:
    """Leave tables out of the newest release, after their files went."""
    shown = exists(spark, database)
    before = read(spark, database) if shown else last_marked(spark, path)
    kept = {name: commit for name, commit in before.tables.items() if name not in names}
    if len(kept) < len(before.tables):
        after = Release(before.number + 1, before.path, kept)
        _mark(spark, after)
        if shown:
            _show(spark, database, after)
