"""Run audit log: a row per step start, end or failure, and per published table.

Each row carries the run context (run id, pipeline id), the step, its parameters as text,
the status, the rows the step published and its duration. Rows are held until the layer
ends and appended to a Parquet catalog table in one write, so a run makes at most one
write per layer and one at its end. The audit never reads pipeline data.

``compact`` rewrites the log into at most one file per day, in a fresh folder
``<root>/_v/<token>``, at which one catalog call points the table; later rows are appended
there. A compaction that stops changes nothing. A table created again finds the folder with the newest
file (``attach_log``): only the folder in use gets rows, so that one has them all.
"""

from __future__ import annotations

import functools
import time
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any, Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.schemas import RUN_METADATA
from strata.sinks import files
from strata.sinks.release import quoted
from strata.sinks.tables import fresh_version, table_location, version_root, versions


@dataclass
class RunAudit:
    spark: SparkSession
    table: str
    held: list[tuple] = field(default_factory=list)

    def record(
        self,
        run_id: str | None,
        pipeline_id: str | None,
        step: str,
        status: str,
        params: dict[str, Any] | None = None,
        rows: int | None = None,
        seconds: float | None = None,
    ) -> None:
        """Hold a row, with the time of the call."""
        now = datetime.now(timezone.utc)
        self.held.append((run_id, pipeline_id, str(dict(params or {})), step, status, rows, seconds, now))

    def flush(self) -> None:
        """Append the held rows in one write (a few rows per layer, so one file)."""
        if self.held:
            self.spark.createDataFrame(self.held, RUN_METADATA).coalesce(1).write.insertInto(self.table)
            self.held = []


    def compact(self) -> int:
        """Rewrite the log into at most one file per day; returns how many files it had more, 0 when it was so already.

        The old files stay until ``remove_unused``. Not for use while a run writes to the log.
        """
        self.flush()
        log, day = self.spark.table(self.table), F.to_date("timestamp_inserted")
        held = log.select(F.col("_metadata.file_path").alias("file"), day.alias("day")).distinct()
        found = held.agg(F.countDistinct("file").alias("files"), F.countDistinct("day").alias("days")).first()
        if found["files"] <= found["days"]:
            return 0
        folder = fresh_version(version_root(table_location(self.spark, self.table)))
        log.repartition(day).sortWithinPartitions("timestamp_inserted").write.parquet(folder)
        self.spark.sql(f"ALTER TABLE {self.table} SET LOCATION {quoted(folder)}")
        self.spark.catalog.refreshTable(self.table)
        return found["files"] - len(files.listed(self.spark, f"{folder}/*.parquet"))


def attach_log(spark: SparkSession, table: str) -> None:
    """Point a log table, just created, at the folder under its root that rows were written to last."""
    root = version_root(table_location(spark, table))

    def last(folder: str) -> float:
        return max((files.modified(spark, f) for f in files.listed(spark, f"{folder}/*.parquet")), default=0.0)

    newest = max([root, *versions(spark, root)], key=last)
    if newest != root:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(newest)}")
    spark.catalog.refreshTable(table)


def _text(value: Any) -> str | None:
    """A parameter as audit text: plain values as they are, datasets by name, frames left out."""
    if isinstance(value, dict):
        return ", ".join(sorted(map(str, value)))
    return str(value) if isinstance(value, (str, int, float, bool)) else None


def audited(step: str, flush: bool = False) -> Callable:
    """Decorator for pipeline methods: audit rows before and after the call.

    The instance must expose ``audit`` (a ``RunAudit`` or None) and the call must receive
    an argument with ``run_id``, ``pipeline_id`` and ``partition``. With ``flush`` the
    held rows are written when the call ends; a failure always writes them.
    """

    def wrap(func: Callable) -> Callable:
        names = func.__code__.co_varnames[1 : func.__code__.co_argcount]

        @functools.wraps(func)
        def inner(self, *args, **kwargs):
            audit: RunAudit | None = getattr(self, "audit", None)
            if audit is None:
                return func(self, *args, **kwargs)
            given = dict(zip(names, args)) | kwargs
            context = next((v for v in given.values() if hasattr(v, "run_id")), None)
            ids = getattr(context, "run_id", None), getattr(context, "pipeline_id", None)
            params = {"function": func.__name__, "partition": getattr(context, "partition", None)}
            params |= {k: text for k, v in given.items() if (text := _text(v)) is not None}
            audit.record(*ids, step, "start", params)
            started = time.monotonic()
            try:
                result = func(self, *args, **kwargs)
            except Exception:
                audit.record(*ids, step, "failed", params, seconds=time.monotonic() - started)
                audit.flush()
                raise
            audit.record(*ids, step, "end", params, seconds=time.monotonic() - started)
            if flush:
                audit.flush()
            return result

        return inner

    return wrap
