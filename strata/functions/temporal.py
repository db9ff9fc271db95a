"""Date and run-partition helpers."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must stay as they are for results to match:
# the open end of an active dimension row, and the run partition format.
OPEN_END = "2099-01-01 12:00:00"
PARTITION_FORMAT = "%Y-%m-%d-%H-%M-%S"

_PARTITION_RE = re.compile(r"^\d{4}-\d{2}-\d{2}-\d{2}-\d{2}-\d{2}$")


def open_end() -> Column:
    """The ``valid_to`` of an active row, as a TIMESTAMP_NTZ literal."""
    return F.lit(OPEN_END).cast("timestamp_ntz")


def deliver_date(col: str | Column) -> Column:
    """Calendar date of a timestamp (a format pattern has no effect on timestamps)."""
    return F.to_date(F.col(col) if isinstance(col, str) else col)


def run_partition(when: datetime | None = None) -> str:
    """Run identifier used as the partition value, e.g. ``2025-02-22-13-05-09``."""
    return (when or datetime.now()).strftime(PARTITION_FORMAT)


def validate_partition(value: str) -> str:
    """Reject partition strings that would not sort by time.

    The newest run is found with a string ``max``; a value such as ``YYYY-MM-DD_HH``
    would sort above every real run and hide them from the latest-snapshot view.
    """
    if not isinstance(value, str) or not _PARTITION_RE.match(value):
        raise ValueError(f"partition {value!r} does not match {PARTITION_FORMAT}")
    return value
