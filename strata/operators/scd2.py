"""Type-2 slowly changing dimension.

Change semantics, for each source row against the *active* dimension rows:

* no active row with that id (also a NULL id)        -> insert a new active version;
* an active row whose ``datetime_updated`` is older  -> insert a new active version
  and close that row (``current`` false, ``valid_to`` and ``datetime_updated`` set to
  the new version's timestamp, surrogate key kept);
* equal, older or NULL timestamp                     -> nothing.

The three cases come out of **one** left join of the batch against the active rows
(instead of an anti join plus two inner joins over the same inputs). Each joined
pair yields zero, one or two rows through ``explode`` of an array of structs, so the
join runs once and stays in whole-stage codegen. Rows with a NULL id cannot match;
a salt column spreads them over many shuffle partitions (``operators.skew``), so a
NULL-heavy batch cannot pile onto one task. Hot non-NULL ids on the batch side are
split by AQE skew-join handling (left outer joins split their left side).

When the batch's distinct ids fit a measured broadcast bound, the active rows are
first semi-joined with a broadcast of those ids: the dimension is then scanned and
filtered map-side but never shuffled, and only the rows of ids in the batch reach
the join. Above the bound the plain shuffle join runs.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import surrogate_key
from strata.functions.temporal import open_end
from strata.operators.bounded import DEFAULT_BROADCAST_LIMIT, broadcast_if_bounded, shuffled
from strata.operators.skew import SALT, with_null_salt, zero_salt

SUR_KEY = "customer_sur_id"
ATTRIBUTES = ("first_name", "last_name", "state_id", "datetime_created")

NEW, UPDATED, UNCHANGED, CLOSED = "new", "updated", "unchanged", "closed"


def with_surrogate_key(
    source: DataFrame, key: str = "id", updated_at: str = "datetime_updated", sur_key: str = SUR_KEY
) -> DataFrame:
    """Adds ``sur_key = md5(concat(key, updated_at))``."""
    return source.withColumn(sur_key, surrogate_key(key, updated_at))


def _active(dim: DataFrame, key: str, updated_at: str, sur_key: str, attributes: Sequence[str]) -> DataFrame:
    return dim.where(F.col("current")).select(
        F.col(key).alias("_d_key"),
        F.col(sur_key).alias("_d_sur"),
        *[F.col(a).alias(f"_d_{a}") for a in attributes],
        F.col(updated_at).alias("_d_upd"),
        F.col("valid_from").alias("_d_from"),
        F.lit(True).alias("_d_hit"),
    )


def classify(
    source: DataFrame,
    dim: DataFrame,
    key: str = "id",
    updated_at: str = "datetime_updated",
    sur_key: str = SUR_KEY,
    attributes: Sequence[str] = ATTRIBUTES,
    prefilter_limit: int = DEFAULT_BROADCAST_LIMIT,
    batch_rows: int | None = None,
) -> DataFrame:
    """Source rows joined to their active dimension rows, labelled ``change``.

    One row per (source row, matching active row); a source row without a match
    appears once with the ``_d_*`` columns NULL. ``change`` is ``new``, ``updated``
    or ``unchanged``. ``prefilter_limit`` bounds the broadcast of the batch's ids
    (0 disables the prefilter); ``batch_rows``, a known row count of ``source``,
    lets a fixed-width id be bounded without a sizing job.
    """
    src = with_surrogate_key(source.select(key, *attributes, updated_at), key, updated_at, sur_key)
    active = _active(dim, key, updated_at, sur_key, attributes)
    if prefilter_limit > 0:
        ids = src.where(F.col(key).isNotNull()).select(F.col(key).alias("_b_key")).distinct()
        ids, small = broadcast_if_bounded(ids, prefilter_limit, batch_rows)
        if small:
            active = active.join(ids, F.col("_d_key") == F.col("_b_key"), "left_semi")
    active = active.withColumn("_d_salt", zero_salt("_d_key"))
    cond = (F.col(key) == F.col("_d_key")) & (F.col(SALT) == F.col("_d_salt"))
    pairs = with_null_salt(src, key).join(shuffled(active), cond, "left").drop(SALT, "_d_salt")
    newer = F.col(updated_at) > F.col("_d_upd")
    change = (
        F.when(F.col("_d_hit").isNull(), F.lit(NEW))
        .when(newer, F.lit(UPDATED))
        .otherwise(F.lit(UNCHANGED))
    )
    return pairs.withColumn("change", change)


def latest_per_key(batch: DataFrame, key: str = "id", updated_at: str = "datetime_updated") -> DataFrame:
    """Keep the newest row per key (ties: the greatest row), as a partial aggregate.

    Rows with a NULL key are all kept: none is a version of another. ``max(struct(updated_at, ...))`` is combined map-side, so a hot key costs one
    row per task before the shuffle.
    """
    others = [c for c in batch.columns if c not in (key, updated_at)]
    newest = F.max(F.struct(F.col(updated_at), *[F.col(c) for c in others])).alias("_v")
    keyed = batch.where(F.col(key).isNotNull()).groupBy(key).agg(newest)
    keyed = keyed.select(key, *[F.col(f"_v.{c}") for c in [updated_at, *others]]).select(*batch.columns)
    return keyed.unionByName(batch.where(F.col(key).isNull()))


def _version(
    change: str, key: Column, sur: Column, attrs: Sequence[Column], updated: Column, current: bool,
    valid_from: Column, valid_to: Column, names: Sequence[str], key_name: str, sur_key: str,
    updated_at: str,
) -> Column:
    return F.struct(
        key.alias(key_name),
        sur.alias(sur_key),
        *[a.alias(n) for a, n in zip(attrs, names)],
        updated.alias(updated_at),
        F.lit(current).alias("current"),
        valid_from.alias("valid_from"),
        valid_to.alias("valid_to"),
        F.lit(change).alias("change"),
    )


def scd2_change_rows(
    source: DataFrame,
    dim: DataFrame,
    key: str = "id",
    updated_at: str = "datetime_updated",
    sur_key: str = SUR_KEY,
    attributes: Sequence[str] = ATTRIBUTES,
    prefilter_limit: int = DEFAULT_BROADCAST_LIMIT,
    batch_rows: int | None = None,
) -> DataFrame:
    """The change set with a ``change`` label: ``new``, ``updated`` (new versions of
    known ids) or ``closed`` (the active rows they replace)."""
    pairs = classify(source, dim, key, updated_at, sur_key, attributes, prefilter_limit, batch_rows)
    ts_type = pairs.schema[updated_at].dataType
    upd = F.col(updated_at)
    src_attrs = [F.col(a) for a in attributes]

    def insert(change: str) -> Column:
        return _version(
            change, F.col(key), F.col(sur_key), src_attrs, upd, True,
            upd, open_end().cast(ts_type), attributes, key, sur_key, updated_at,
        )

    close = _version(
        CLOSED, F.col("_d_key"), F.col("_d_sur"), [F.col(f"_d_{a}") for a in attributes], upd, False,
        F.col("_d_from"), upd, attributes, key, sur_key, updated_at,
    )
    # unchanged pairs give NULL, which explode turns into no row
    versions = F.when(F.col("change") == NEW, F.array(insert(NEW))).when(
        F.col("change") == UPDATED, F.array(insert(UPDATED), close)
    )
    return pairs.select(F.explode(versions).alias("v")).select("v.*")


def scd2_changes(
    source: DataFrame,
    dim: DataFrame,
    key: str = "id",
    updated_at: str = "datetime_updated",
    sur_key: str = SUR_KEY,
    attributes: Sequence[str] = ATTRIBUTES,
    prefilter_limit: int = DEFAULT_BROADCAST_LIMIT,
    batch_rows: int | None = None,
) -> DataFrame:
    """The change set to upsert into the dimension on ``sur_key``.

    Columns: key, sur_key, attributes..., updated_at, current, valid_from, valid_to.
    New versions are active with the open end as ``valid_to``; closed rows keep
    their surrogate key, so the upsert updates them in place.
    """
    return scd2_change_rows(
        source, dim, key, updated_at, sur_key, attributes, prefilter_limit, batch_rows
    ).drop("change")


def apply_scd2(
    source: DataFrame,
    dim: DataFrame,
    partition: str | None = None,
    key: str = "id",
    updated_at: str = "datetime_updated",
    sur_key: str = SUR_KEY,
    attributes: Sequence[str] = ATTRIBUTES,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """The dimension after one run, as a DataFrame (no table write).

    The change set is stamped with ``partition`` (when the dimension carries that
    column), checkpointed (it is read by the sizing job and by the merge) and
    merged into ``dim`` on the surrogate key.
    """
    from strata.operators.materialize import materialize
    from strata.operators.merge import merge_frames

    limit = DEFAULT_BROADCAST_LIMIT if broadcast_limit is None else broadcast_limit
    changes = scd2_changes(source, dim, key, updated_at, sur_key, attributes, limit)
    if "partition" in dim.columns:
        changes = changes.withColumn("partition", F.lit(partition).cast("string"))
    changes = materialize(changes)
    return merge_frames(dim, changes, [sur_key], broadcast_limit=limit)
