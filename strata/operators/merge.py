"""Upsert (MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *) on DataFrames.

Semantics: a source row whose keys equal a target row's keys replaces that row
(every column); a source row without such a target row is inserted; target rows
without a matching source row are kept; nothing is deleted. NULL keys never match.
Several source rows matching one target row is an error, as in MERGE.

Two physical paths, chosen from a measured size:

* **small source key set** (measured exact bytes <= limit): the distinct source keys
  are broadcast; the target is split with a broadcast anti join (rows kept) and a
  broadcast semi join (how many target rows each source key replaces). The target
  is scanned twice and **never shuffled**; only the matched-key counts move.
* **large source key set**: rows with a NULL key, on either side, never match and go
  around the join by union, so they are not shuffled at all. The others are joined
  twice on the keys: target left join source (replaced or kept rows) and source anti
  join target (inserted rows). AQE can split the left side of both, so a hot key is
  spread over tasks; it cannot split a full outer join.

Scans that only look for rows with one of the source's keys carry those keys as a filter
(``key_filter``): the values themselves when they are few, else their range. Parquet drops
row groups by it, so over files sorted by key, or with Bloom filters on it, few are read.
"""

from __future__ import annotations

from typing import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.keys import key_condition
from strata.operators.bounded import DEFAULT_BROADCAST_LIMIT, shuffled

_HITS = "_strata_hits"
FEW_KEYS = 100  # source keys that are pushed to the scan one by one
_PUSHED = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


class MergeConflict(ValueError):
    """Several source rows match the same target row."""


def conform(df: DataFrame, target_schema) -> DataFrame:
    """Project ``df`` onto the target's columns (by name) with the target's types.

    Extra source columns are dropped; a target column missing from the source is NULL.
    """
    cols = []
    for field in target_schema.fields:
        if field.name in df.columns:
            cols.append(F.col(f"`{field.name}`").cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)


def _non_null(keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"`{k}`").isNotNull()
    return cond


def key_stats(source: DataFrame, keys: Sequence[str]) -> tuple[int, int, int]:
    """(distinct non-NULL keys, their payload bytes, largest rows per key) in one job."""
    per_key = source.where(_non_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    width = F.lit(0)
    for k in keys:
        width = width + F.coalesce(F.octet_length(F.col(f"`{k}`").cast("string")), F.lit(0)) + F.lit(8)
    row = per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum(width + F.lit(16)), F.lit(0)).cast("long").alias("bytes"),
        F.coalesce(F.max("_n"), F.lit(0)).alias("max_n"),
    ).first()
    return int(row["keys"]), int(row["bytes"]), int(row["max_n"])


def key_filter(source: DataFrame, keys: Sequence[str], n_keys: int) -> Column | None:
    """A condition that every row with a key of ``source`` fulfils, for the scan; None when there is nothing to push.

    ``n_keys`` is the number of distinct keys (``key_stats``). Up to ``FEW_KEYS`` of them the condition
    lists each column's values, as equalities, since Parquet asks Bloom filters only for those;
    beyond, it is each column's range.
    """
    pushed = [k for k in keys if isinstance(source.schema[k].dataType, _PUSHED)]
    if not pushed or not n_keys:
        return None
    usable = source.where(_non_null(keys))
    if n_keys <= FEW_KEYS:
        found = usable.select(*pushed).distinct().collect()  # at most FEW_KEYS rows
        by_column = ((k, sorted({row[k] for row in found})) for k in pushed)
        listed = [reduce(Column.__or__, [F.col(f"`{k}`") == F.lit(v) for v in values]) for k, values in by_column]
    else:
        bounds = usable.agg(*[f(k).alias(f"{name}_{k}") for k in pushed for name, f in (("low", F.min), ("high", F.max))]).first()
        listed = [F.col(f"`{k}`").between(F.lit(bounds[f"low_{k}"]), F.lit(bounds[f"high_{k}"])) for k in pushed]
    return reduce(Column.__and__, listed)


def broadcast_fits(n_keys: int, key_bytes: int, limit: int) -> bool:
    """The key set and the per-key hit counts (key + 8-byte count) fit the limit."""
    return 0 < limit and key_bytes + 16 * n_keys <= limit


def _check_single_match(target: DataFrame, source: DataFrame, keys: Sequence[str], small: bool) -> None:
    dup_keys = (
        source.where(_non_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .select(*keys)
    )
    probe = F.broadcast(dup_keys) if small else shuffled(dup_keys)
    clash = target.join(probe, list(keys), "left_semi").select(*keys).limit(1).collect()
    if clash:
        raise MergeConflict(
            f"several source rows match the target row with keys {clash[0].asDict()}; "
            "deduplicate the source before the upsert"
        )


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
    check: bool = True,
    stats: tuple[int, int, int] | None = None,
) -> DataFrame:
    """The target after upserting ``source`` on ``keys`` (columns in target order).

    Runs one small aggregate over the source to size its key set (skipped when the
    caller passes ``stats`` from ``key_stats``), and, only when the source repeats a
    key, one probe of the target to reject ambiguous matches.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("upsert needs at least one key column")
    missing = [k for k in keys if k not in target.columns or k not in source.columns]
    if missing:
        raise ValueError(f"key columns missing: {missing}")
    cols = target.columns
    src = conform(source, target.schema)
    n_keys, key_bytes, max_per_key = stats if stats is not None else key_stats(src, keys)
    small = broadcast_fits(n_keys, key_bytes, broadcast_limit)
    if check and max_per_key > 1:
        _check_single_match(target, src, keys, small)

    if small:
        key_set = F.broadcast(src.where(_non_null(keys)).select(*keys).distinct())
        kept = target.join(key_set, keys, "left_anti").select(*cols)
        pushed = key_filter(src, keys, n_keys)
        near = target if pushed is None else target.where(pushed)
        hits = near.join(key_set, keys, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias(_HITS))
        # a source row is written once per target row it replaces (once if it is new)
        copies = F.greatest(F.coalesce(F.col(_HITS), F.lit(1)), F.lit(1)).cast("int")
        upserted = (
            src.join(F.broadcast(hits), keys, "left")
            .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies)))
            .select(*cols)
        )
        return kept.unionByName(upserted)

    keyed_target, keyed_source = target.where(_non_null(keys)), src.where(_non_null(keys))
    t = keyed_target.alias("t")
    s = keyed_source.withColumn("_strata_s", F.lit(True)).alias("s")
    from_source = F.col("s._strata_s").isNotNull()
    updated = t.join(shuffled(s), key_condition(keys, "t", "s"), "left").select(
        *[F.when(from_source, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c) for c in cols]
    )
    inserted = keyed_source.alias("s").join(
        shuffled(keyed_target.select(*keys).alias("t")), key_condition(keys, "t", "s"), "left_anti"
    )
    around = target.where(~_non_null(keys)).unionByName(src.where(~_non_null(keys)))
    return updated.unionByName(inserted.select(*cols)).unionByName(around)
