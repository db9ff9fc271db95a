"""SCD2 dimension: one store of active and closed rows, a released table (``strata.sinks.release``).

``<name>_store`` is partitioned by ``part`` ('a' active, 'h' history), ``bucket`` and
``commit``. An active row lies in the bucket of its id's hash; closed rows lie in bucket -1.

* **Copy on write by bucket.** Publish number n touches the buckets of the ids in its change
  set: it reads and rewrites the active rows of those only, to
  ``part=a/bucket=b/commit=n``, and writes the rows it closed to ``part=h/bucket=-1/commit=n``,
  in one job. The table's commit names, per bucket, the commit that holds its active rows
  (``live``), so the other buckets go on being read from where they are.
* Closed rows are written once and never again; active rows of older commits can be removed
  at any time without touching history (``remove_old_commits``).
* ``<name>`` is the dimension: a view of the commit in the release. Releasing is the only
  step that readers see, so a publish that stops anywhere leaves them with the old or with
  the new dimension.

Publishing a change set (rows stamped with the run partition) is the MERGE of the change
set into the dimension on the surrogate key, computed against the touched active rows only.
That is exact when a key determines the id and ``valid_from``, as a hash of id and timestamp
does, unless a change-set key equals the key of a closed row, which MERGE would update. Such
a row has the same ``valid_from``: the check reads only the history between the change set's
least and greatest ``valid_from``, which reaches the Parquet scan. If there is one, the whole
dimension is merged and the commit starts a new history.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.bounded import DEFAULT_BROADCAST_LIMIT, shuffled
from strata.operators.materialize import materialize
from strata.operators.merge import broadcast_fits, conform, key_stats, merge_frames
from strata.schemas import DIM_CUSTOMER
from strata.sinks import files, release  # noqa: F401 (files: tests stop a publish at its marker)
from strata.sinks.release import Commit
from strata.sinks.tables import COMMIT, drop_parts, store_of, write_commit

ACTIVE, HISTORY = "a", "h"
PART, BUCKET = "part", "bucket"
BUCKETS = 8
COLUMNS = [f.name for f in DIM_CUSTOMER.fields]
_SPREAD = "_strata_bucket"


@dataclass(frozen=True)
class DimensionTables:
    view: str
    store: str

    @classmethod
    def of(cls, database: str, name: str = "dim_customer") -> "DimensionTables":
        return cls.from_view(f"{database}.{name}")

    @classmethod
    def from_view(cls, view: str) -> "DimensionTables":
        return cls(view, store_of(view))


def create_dimension_view(spark: SparkSession, tables: DimensionTables) -> None:
    """The dimension: active rows of each bucket's live commit, and the closed rows of the commits shown."""
    database, name = tables.view.rsplit(".", 1)
    live, floor, number = (release.of_release(database, name, part) for part in ("live", "floor", "number"))
    columns = ", ".join(f"`{c}`" for c in COLUMNS)
    spark.sql(
        f"""CREATE OR REPLACE VIEW {tables.view} AS
            SELECT {columns} FROM {tables.store}
            WHERE (`{PART}` = '{ACTIVE}' AND `{COMMIT}` = try_element_at({live}, `{BUCKET}` + 1))
               OR (`{PART}` = '{HISTORY}' AND `{COMMIT}` > {floor} AND `{COMMIT}` <= {number})"""
    )


def current_commit(spark: SparkSession, tables: DimensionTables) -> Commit:
    """The commit that readers see."""
    return release.current(spark, tables.view)


def show_commit(spark: SparkSession, tables: DimensionTables, commit: Commit) -> None:
    """Release a commit of the dimension alone."""
    release.publish_one(spark, tables.view, commit)


def bucket_of(buckets: int, key: str = "id") -> Column:
    """The bucket of an id; rows without one spread by their other columns, as nothing ever matches them.

    It is the hash by which Spark places rows in a table clustered by the id, so that a dimension with join
    buckets has one of them per folder.
    """
    other = F.xxhash64("first_name", "last_name", "state_id", "datetime_created", "datetime_updated")
    return F.pmod(F.coalesce(F.when(F.col(key).isNotNull(), F.hash(key).cast("long")), other), F.lit(buckets)).cast("int")


def active_rows(spark: SparkSession, tables: DimensionTables, commit: Commit | None = None, only: set[int] | None = None) -> DataFrame:
    """The active rows of a commit, by default the one that readers see; ``only`` of these buckets."""
    return _stored(spark, tables, _active_text(commit or current_commit(spark, tables), only))


def _active_text(commit: Commit, only: set[int] | None = None) -> str:
    """SQL for the active rows of a commit: a filter on partition columns."""
    live = ", ".join(f"{b}, {n}L" for b, n in enumerate(commit.live) if only is None or b in only)
    return f"`{PART}` = '{ACTIVE}' AND `{COMMIT}` = try_element_at(CAST(map({live}) AS map<int, bigint>), `{BUCKET}`)"


def _history_text(commit: Commit) -> str:
    return f"`{PART}` = '{HISTORY}' AND `{COMMIT}` > {commit.floor} AND `{COMMIT}` <= {commit.number}"


def _stored(spark: SparkSession, tables: DimensionTables, shown: str) -> DataFrame:
    return spark.table(tables.store).where(shown).select(*COLUMNS)


def history_rows(spark: SparkSession, tables: DimensionTables, commit: Commit | None = None) -> DataFrame:
    """The closed rows of a commit, by default the one that readers see."""
    return _stored(spark, tables, _history_text(commit or current_commit(spark, tables)))


def dimension_rows(spark: SparkSession, tables: DimensionTables, commit: Commit) -> DataFrame:
    """All rows of a commit, also of one that is not released yet."""
    return _stored(spark, tables, f"({_active_text(commit)}) OR ({_history_text(commit)})")


def colliding_history(history: DataFrame, staged: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Keys of closed rows that equal a change-set key, read only where ``valid_from`` can be equal."""
    bounds = staged.agg(F.min("valid_from").alias("low"), F.max("valid_from").alias("high")).first()
    key_set = staged.select(*keys).dropna().distinct()
    near = history.select(*keys, "valid_from").where(F.col("valid_from").between(F.lit(bounds["low"]), F.lit(bounds["high"])))
    return near.join(F.broadcast(key_set) if small else shuffled(key_set), list(keys), "left_semi")


def stage_dimension(
    spark: SparkSession,
    tables: DimensionTables,
    changes: DataFrame,
    keys: Sequence[str] = ("customer_sur_id",),
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
    gate: Callable[[DataFrame], object] | None = None,
    base: Commit | None = None,
) -> tuple[Commit, int]:
    """Write the dimension after ``changes`` (already stamped); returns the commit that shows it, and the changes' rows.

    ``gate`` gets the rows that were written; when it raises, there is nothing to release.
    ``base`` is the commit to go on from, by default the released one. An empty change set
    (a published batch again) writes nothing.
    """
    keys = list(keys)
    shown = release.read(spark, tables.view.rsplit(".", 1)[0])
    before = shown.commit(tables.view) if base is None else base
    live = list(before.live) or [0] * BUCKETS
    staged = materialize(conform(changes, DIM_CUSTOMER))
    found = staged.agg(F.count(F.lit(1)).alias("rows"), F.collect_set(bucket_of(len(live))).alias("buckets")).first()
    if not found["rows"]:
        return before, 0
    stats = key_stats(staged, keys)
    small = broadcast_fits(stats[0], stats[1], broadcast_limit)

    number, floor, touched = before.number + 1, before.floor, set(found["buckets"])
    merged_into = active_rows(spark, tables, before, touched)
    if stats[0] and before.number > before.floor:
        if colliding_history(history_rows(spark, tables, before), staged, keys, small).limit(1).collect():
            merged_into, floor, touched = dimension_rows(spark, tables, before), before.number, set(range(len(live)))
    merged = merge_frames(merged_into, staged, keys, broadcast_limit=broadcast_limit, stats=stats)
    _write(spark, tables, shown.folder(tables.view), merged, number, len(live))
    if gate is not None:
        gate(spark.table(tables.store).where(F.col(COMMIT) == number).select(*COLUMNS))
    live = tuple(number if b in touched else n for b, n in enumerate(live))
    return replace(before, number=number, floor=floor, live=live), int(found["rows"])


def publish_dimension(
    spark: SparkSession,
    tables: DimensionTables,
    changes: DataFrame,
    partition: str,
    keys: Sequence[str] = ("customer_sur_id",),
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
    gate: Callable[[DataFrame], object] | None = None,
    epoch: tuple[str, int] | None = None,
) -> int:
    """Merge ``changes`` (already stamped with ``partition``) into the dimension and release it; returns their rows.

    ``gate`` gets the rows that the publish wrote, before they are released; when it
    raises, the dimension stays as it was. ``epoch`` (stream, number) makes a replayed
    epoch do nothing. Keys must determine id and ``valid_from``, as the surrogate key does.
    """
    before = current_commit(spark, tables)
    if epoch is not None and epoch[1] <= before.epochs.get(epoch[0], -1):
        return 0
    commit, rows = stage_dimension(spark, tables, changes, keys, broadcast_limit, gate, before)
    if rows:
        show_commit(spark, tables, replace(commit, epochs=before.epochs | dict([epoch])) if epoch else commit)
    return rows


def _write(spark: SparkSession, tables: DimensionTables, root: str, rows: DataFrame, number: int, buckets: int) -> None:
    """Write commit ``number``: active rows by bucket, closed rows together."""
    active = F.coalesce(F.col("current"), F.lit(False))
    placed = rows.withColumn(_SPREAD, bucket_of(buckets)).withColumns(
        {PART: F.when(active, ACTIVE).otherwise(HISTORY), BUCKET: F.when(active, F.col(_SPREAD)).otherwise(F.lit(-1))}
    )
    # one file or few per bucket; a bucket that is far larger is split, small ones share a task
    placed = placed.hint("rebalance", F.col(_SPREAD)).drop(_SPREAD)
    # the write sorts by part, bucket and commit anyway; valid_from next keeps the ranges of
    # history files narrow for the collision check
    write_commit(spark, tables.store, root, placed.sortWithinPartitions(PART, BUCKET, "valid_from"), [PART, BUCKET], number)


def remove_old_commits(spark: SparkSession, tables: DimensionTables, least_age: float = 0.0) -> int:
    """Remove what readers do not see: older active rows, replaced history, stopped publishes; returns the
    number of commits that lost rows.

    Folders younger than ``least_age`` seconds stay. Not for use while a publish is at work;
    readers that run longer than ``least_age`` may lose their files.
    """
    commit = current_commit(spark, tables)

    def unseen(part: dict[str, str]) -> bool:
        number = int(part[COMMIT])
        if part[PART] == ACTIVE:
            return commit.live[int(part[BUCKET])] != number
        return not commit.floor < number <= commit.number

    return len({part[COMMIT] for part in drop_parts(spark, tables.store, unseen, least_age)})
