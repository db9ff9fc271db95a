"""Upsert on DataFrames: both physical paths, NULL keys, conflicts, duplicates."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from strata.functions.keys import key_condition_sql
from strata.operators.merge import MergeConflict, merge_frames

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute_force(target, source):
    """MERGE semantics written out row by row."""
    out = []
    for t in target:
        hits = [s for s in source if s[0] is not None and s[0] == t[0]]
        out.extend(hits if hits else [t])
    for s in source:
        if s[0] is None or not any(t[0] == s[0] for t in target):
            out.append(s)
    return sorted(out, key=str)


def collect(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", [32 * 1024 * 1024, 0], ids=["broadcast", "full_outer"])
def test_update_insert_keep(spark, limit):
    target = [(1, "a"), (2, "b"), (None, "n")]
    source = [(2, "B"), (3, "C"), (None, "m")]
    got = merge_frames(frame(spark, target), frame(spark, source), ["k"], broadcast_limit=limit)
    assert collect(got) == brute_force(target, source)


@pytest.mark.parametrize("limit", [32 * 1024 * 1024, 0], ids=["broadcast", "full_outer"])
def test_duplicate_target_rows_are_each_replaced(spark, limit):
    target = [(1, "a"), (1, "a2"), (2, "b")]
    source = [(1, "X")]
    got = merge_frames(frame(spark, target), frame(spark, source), ["k"], broadcast_limit=limit)
    assert collect(got) == [(1, "X"), (1, "X"), (2, "b")]


@pytest.mark.parametrize("limit", [32 * 1024 * 1024, 0], ids=["broadcast", "full_outer"])
def test_two_source_rows_on_one_target_row_raise(spark, limit):
    with pytest.raises(MergeConflict):
        merge_frames(frame(spark, [(1, "a")]), frame(spark, [(1, "x"), (1, "y")]), ["k"], broadcast_limit=limit)


def test_duplicate_source_keys_without_target_are_inserted(spark):
    got = merge_frames(frame(spark, [(1, "a")]), frame(spark, [(2, "x"), (2, "y")]), ["k"])
    assert collect(got) == [(1, "a"), (2, "x"), (2, "y")]


def test_source_columns_are_projected_onto_target(spark):
    source = spark.createDataFrame([(2, "B", 9.5)], "k int, v string, extra double")
    got = merge_frames(frame(spark, [(1, "a")]), source, ["k"])
    assert got.columns == ["k", "v"]
    assert collect(got) == [(1, "a"), (2, "B")]


def test_join_condition_text():
    assert key_condition_sql(["id", "partition"]) == "target.`id` = source.`id` AND target.`partition` = source.`partition`"
    with pytest.raises(ValueError):
        key_condition_sql([])


rows_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from("abcxyz")), max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows_st, source=rows_st)
def test_both_paths_match_brute_force(spark, target, source):
    # MERGE rejects two source rows on one target row; keep the source unique on matched keys
    seen, src = set(), []
    for k, v in source:
        if k is not None and k in seen:
            continue
        seen.add(k)
        src.append((k, v))
    expected = brute_force(target, src)
    for limit in (32 * 1024 * 1024, 0):
        got = merge_frames(frame(spark, target), frame(spark, src), ["k"], broadcast_limit=limit)
        assert collect(got) == expected
