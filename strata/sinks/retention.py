"""Retention: what no reader needs any longer goes, after a least age.

Every write leaves folders behind that the release no longer shows, every release a marker,
and every run checkpoints and staged tables in the shared scratch folder. ``retain`` and
``clear_scratch`` remove them by reference: nothing that is shown goes, whatever its age.
"""

from __future__ import annotations

import time

from pyspark.sql import SparkSession

from strata.session import checkpoint_root
from strata.sinks import files, release
from strata.sinks.dimension import DimensionTables, remove_old_commits
from strata.sinks.tables import remove_unused, store_of

WEEK = 7 * 24 * 3600.0


def retain(spark: SparkSession, database: str, least_age: float = WEEK) -> dict[str, int]:
    """Remove what the release of ``database`` does not show and is ``least_age`` seconds old.

    Returns, per table, how many folders (of the dimension: commits) went, and under
    ``releases`` how many markers; the newest marker always stays. Not for use while a
    writer is at work; a reader that runs longer than ``least_age`` may lose its files.
    """
    now = release.read(spark, database)
    removed: dict[str, int] = {}
    for name, commit in now.tables.items():
        table = f"{database}.{name}"
        if not spark.catalog.tableExists(store_of(table)):
            continue  # dropped, its files stay
        removed[name] = (
            remove_old_commits(spark, DimensionTables.from_view(table), least_age)
            if commit.live
            else remove_unused(spark, table, least_age)
        )
    before = time.time() - least_age
    markers = files.listed(spark, f"{now.path}/_releases/*")[:-1]
    old = [m for m in markers if files.modified(spark, m) <= before]
    for marker in old:
        files.delete(spark, marker)
    return removed | {"releases": len(old)}


def clear_scratch(spark: SparkSession, least_age: float = WEEK) -> int:
    """Remove what was last changed ``least_age`` seconds ago from the shared scratch folder; returns how many entries went.

    Checkpoints of this application and folders of running ones are young: choose an age
    beyond the longest run.
    """
    root, before = checkpoint_root(spark), time.time() - least_age
    scratch = f"{root}/strata"
    found = [f for f in files.listed(spark, f"{root}/*") if f.rstrip("/").rsplit("/", 1)[1] != "strata"]
    found += files.listed(spark, f"{scratch}/*/*")
    old = [f for f in found if files.newest(spark, f) <= before]
    for folder in old:
        files.delete(spark, folder)
    return len(old)
