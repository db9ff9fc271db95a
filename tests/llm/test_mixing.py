import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import mixing
from strata.llm.registry import op2_mixing
from tests.llm.cases import SCHEMA, SF, clashing, edge_docs, edge_rows, empty_docs


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    expected = sorted(con.execute(mixing.mix_sql()).fetchall())
    assert sorted(tuple(r) for r in op2_mixing(spark, SF).collect()) == expected


def test_taken_words_meet_targets(spark):
    sources = {}
    for r in op2_mixing(spark, SF).collect():
        assert 0 <= r.taken <= 2 * r["size"]
        sources.setdefault((r.source_size, r.target), []).append(r.taken)
    for (size, target), taken in sources.items():
        assert abs(sum(taken) - target) <= 0.5
        assert target <= 2 * size
    total = sum(size for size, _ in sources)
    assert sum(target for _, target in sources) == pytest.approx(1.5 * total)


def test_hot_source_and_small_buckets_give_the_same_plan(spark):
    rows = [(k, "w " * (k % 7 + 1), "en", "a" if k % 3 else f"s{k % 11}", 0) for k in range(500)]
    docs = spark.createDataFrame(rows, SCHEMA)
    small = mixing.MixConfig(bucket_rows=1)
    assert sorted(mixing.mix(docs, small).collect()) == sorted(mixing.mix(docs).collect())


def test_time_is_the_inverse_of_the_integral(spark):
    knots = ((0.0, 0.0), (0.3, 2.0), (0.7, 0.5), (1.0, 0.5))
    area = mixing.integrals(knots)[-1]
    shares = spark.range(101).select((F.col("id") / 100).alias("u"))
    for r in shares.select("u", mixing.invert(knots, F.col("u")).alias("t")).collect():
        reached = 0.0
        for (t0, a), (t1, b) in zip(knots, knots[1:]):
            x = min(max(r.t - t0, 0.0), t1 - t0)
            reached += a * x + (b - a) / (t1 - t0) * x * x / 2
        assert reached / area == pytest.approx(r.u, abs=1e-9)


def test_mixed_rows_hold_the_taken_words_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = {r.doc_id: r for r in mixing.mix(docs).collect()}
    mixed = mixing.mixed_rows(docs, length_col="n_chars").collect()
    words, first = {}, []
    for r in mixed:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.encode().split())
        if r.doc_id not in dict(first):
            first.append((r.doc_id, plan[r.doc_id].position))
    assert words == {i: r.taken for i, r in plan.items() if r.taken}
    assert [p for _, p in first] == sorted(p for _, p in first)
    assert all(len(r.text) == r.n_chars for r in mixed if plan[r.doc_id].taken < plan[r.doc_id]["size"])


def test_plan_rows_are_sorted_by_position(spark):
    rows = [(k, "w " * (k % 7 + 1), "en", f"s{k % 4 if k % 3 else 0}", 0) for k in range(900)]
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA))
    positions = [r.position for r in found.collect()]
    taken = [p for p in positions if p is not None]
    assert 0 < len(taken) < 900 and positions == sorted(taken) + [None] * (900 - len(taken))
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 900 / 2  # rows without a position spread, too


def test_numbers_follow_the_order(spark):
    df = spark.createDataFrame([(k * 37 % 101,) for k in range(101)], "x long")
    assert sorted((r.x, r.number) for r in mixing.number_rows(df, "x").collect()) == [(k, k) for k in range(101)]


def test_edge_rows(spark):
    found = mixing.mix(clashing(edge_docs(spark))).collect()
    assert len(found) == len(edge_rows())
    assert all(r["size"] == r.taken == 0 and r.position is None for r in found if r.doc_id in (0, 1, 2))
    assert mixing.mix(empty_docs(spark)).count() == 0
    assert mixing.mixed_rows(empty_docs(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None, "a", None), (2, "", None, None, None)], SCHEMA)
    assert {(r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0.0, 0)}


def test_rows_without_an_id_spread_over_buckets(spark):
    docs = spark.range(30_000).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text")
    )
    keyed = docs.select(mixing.order_key("mix-1", "doc_id", "text").alias("order"))
    sizes = [r["count"] for r in keyed.groupBy(mixing.bucket_of("order", 64).alias("b")).count().collect()]
    assert len(sizes) == 64 and max(sizes) < 2 * 30_000 / 64


def test_another_file_layout_gives_the_same_rows(spark, scratch_dir):
    rows = [(k % 5 if k % 3 else None, f"word {k} " * (k % 4 + 1), "en", f"s{k % 2}", k) for k in range(600)]
    found = []
    for k, order in enumerate((rows, rows[::-1])):
        spark.createDataFrame(order, SCHEMA).repartition(3 + 4 * k).write.parquet(f"{scratch_dir}/{k}")
        found.append(sorted(map(str, mixing.mixed_rows(spark.read.parquet(f"{scratch_dir}/{k}"), length_col="n_chars").collect())))
    assert found[0] == found[1] and len(found[0]) > 600
