"""foreachBatch adapters.

* ``scd2_sink``: each micro-batch of customer rows is one SCD2 run against the dimension.
  The commit remembers the last epoch of each stream by the stream's name, so a
  re-delivered epoch changes nothing, rows with a NULL id included.
* ``replace_partition_sink``: each micro-batch replaces its own run partition, so a
  re-delivered epoch overwrites what its first delivery wrote.

``epoch_partitions(start)`` names partitions by the start time plus the epoch id in
seconds: they sort in epoch order. ``start`` belongs to the stream and must be the same
after a restart; two streams into one table need starts whose epochs do not meet.

Streaming queries run in a cloned session; other sessions that cached the tables
see the new commits after ``spark.catalog.refreshTable``.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from strata.functions.temporal import run_partition
from strata.operators.bounded import DEFAULT_BROADCAST_LIMIT
from strata.operators.materialize import materialize
from strata.operators.scd2 import latest_per_key, scd2_changes
from strata.session import scratch_path
from strata.sinks.dimension import DimensionTables, active_rows, publish_dimension
from strata.sinks.tables import replace_partition, stamp

PartitionFor = Callable[[int], str]


def epoch_partitions(start: datetime) -> PartitionFor:
    return lambda epoch_id: run_partition(start + timedelta(seconds=epoch_id))


def scd2_sink(
    dim_view: str,
    partition_for: PartitionFor,
    stream: str = "customers",
    dedupe: bool = True,
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function applying each micro-batch to the dimension ``dim_view`` as
    one SCD2 run of the named ``stream``.

    With ``dedupe`` the batch keeps the newest row per id first (several newer
    versions of one known id in a batch would otherwise be an ambiguous upsert).
    """

    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        tables = DimensionTables.from_view(dim_view)
        source = materialize(latest_per_key(batch) if dedupe else batch)  # read by two jobs
        changes = scd2_changes(source, active_rows(spark, tables), prefilter_limit=broadcast_limit)
        partition = partition_for(epoch_id)
        publish_dimension(
            spark, tables, stamp(changes, partition), partition, ["customer_sur_id"], broadcast_limit, epoch=(stream, epoch_id)
        )

    return apply


def replace_partition_sink(table: str, partition_for: PartitionFor) -> Callable[[DataFrame, int], None]:
    """foreachBatch function writing each micro-batch into its own run partition."""

    def apply(batch: DataFrame, epoch_id: int) -> None:
        partition = partition_for(epoch_id)
        replace_partition(batch.sparkSession, table, stamp(batch, partition), partition)

    return apply


def start_available_now(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint_location: str | None = None
) -> StreamingQuery:
    """Process everything available now through ``sink`` and stop.

    The stream checkpoint goes under the session's shared checkpoint folder unless
    a location is given.
    """
    location = checkpoint_location or scratch_path(stream.sparkSession, "streams")
    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .start()
    )
