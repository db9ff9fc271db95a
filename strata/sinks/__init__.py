"""Write modes on plain Parquet catalog tables: replace one run partition, upsert by key, the
SCD2 dimension, and the release that shows the commits of all tables at once."""

from strata.sinks.dimension import (
    DimensionTables,
    active_rows,
    history_rows,
    publish_dimension,
    remove_old_commits,
    stage_dimension,
)
from strata.sinks.retention import clear_scratch, retain
from strata.sinks.tables import (
    attach,
    remove_unused,
    replace_partition,
    stage_partition,
    stage_upsert,
    stamp,
    table_location,
    table_partition_columns,
    upsert_table,
)

__all__ = [
    "DimensionTables",
    "active_rows",
    "attach",
    "clear_scratch",
    "history_rows",
    "publish_dimension",
    "remove_old_commits",
    "remove_unused",
    "replace_partition",
    "retain",
    "stage_dimension",
    "stage_partition",
    "stage_upsert",
    "stamp",
    "table_location",
    "table_partition_columns",
    "upsert_table",
]
