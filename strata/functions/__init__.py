"""Column-level helpers: surrogate keys, key conditions, dates, run partitions."""

from strata.functions.keys import key_condition, key_condition_sql, surrogate_key
from strata.functions.temporal import (
    OPEN_END,
    deliver_date,
    open_end,
    run_partition,
    validate_partition,
)

__all__ = [
    "OPEN_END",
    "deliver_date",
    "key_condition",
    "key_condition_sql",
    "open_end",
    "run_partition",
    "surrogate_key",
    "validate_partition",
]
