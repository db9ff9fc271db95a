"""Lineage cuts that survive executor loss.

``DataFrame.checkpoint`` writes to the session's checkpoint folder, the shared
folder the cluster names in ``spark.checkpoint.dir``; a lost executor then
re-reads the files instead of recomputing the lineage. Local checkpoints are never
used: they live on the executors that may be lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.session import checkpoint_root


def materialize(df: DataFrame) -> DataFrame:
    """Eagerly checkpoint ``df`` into the shared checkpoint folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
