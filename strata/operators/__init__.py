"""DataFrame operators: SCD2, upsert, fact, mart, quality gate, bounded broadcast."""

from strata.operators.bounded import DEFAULT_BROADCAST_LIMIT, broadcast_if_bounded, footprint
from strata.operators.colocated import balanced
from strata.operators.fact import build_fact
from strata.operators.mart import build_mart, latest_partition
from strata.operators.materialize import materialize
from strata.operators.merge import MergeConflict, conform, merge_frames
from strata.operators.quality import (
    InvalidDataError,
    assert_quality,
    assert_reconciled,
    quality_report,
    reconciliation_report,
)
from strata.operators.scd2 import (
    apply_scd2,
    classify,
    latest_per_key,
    scd2_change_rows,
    scd2_changes,
    with_surrogate_key,
)

__all__ = [
    "DEFAULT_BROADCAST_LIMIT",
    "InvalidDataError",
    "MergeConflict",
    "apply_scd2",
    "assert_quality",
    "assert_reconciled",
    "balanced",
    "broadcast_if_bounded",
    "build_fact",
    "build_mart",
    "classify",
    "conform",
    "footprint",
    "latest_partition",
    "latest_per_key",
    "materialize",
    "merge_frames",
    "quality_report",
    "reconciliation_report",
    "scd2_change_rows",
    "scd2_changes",
    "with_surrogate_key",
]
