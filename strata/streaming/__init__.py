"""Structured Streaming wiring for the batch operators.

The original job is batch only; these adapters let the same SCD2 upsert and
partition replace run once per micro-batch through ``foreachBatch``. A re-delivered epoch
changes nothing (see ``microbatch``).
"""

from strata.operators.scd2 import latest_per_key
from strata.streaming.microbatch import (
    epoch_partitions,
    replace_partition_sink,
    scd2_sink,
    start_available_now,
)

__all__ = ["epoch_partitions", "latest_per_key", "replace_partition_sink", "scd2_sink", "start_available_now"]
