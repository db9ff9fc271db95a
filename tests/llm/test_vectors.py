import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import ann, topk, vectors
from strata.llm.registry import op9_ann, op10_topk
from tests.llm.cases import SF

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [
    (1000, None, 0), (1001, [], 0), (1002, [0.0] * 4, 0), (1003, [float("nan"), 1.0, 1.0, 1.0], 0),
    (1004, [float("inf"), 1.0, 1.0, 1.0], 0), (1005, [None, 1.0, 1.0, 1.0], 0), (1006, [1.0, 2.0], 0), (None, [1.0, 1.0, 1.0, 1.0], 0),
]


def table(spark, sf=SF):
    rows = sorted(spark.read.parquet(f"{sf}/embeddings.parquet").collect())
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)


def grouped(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def exact_top(ids, z, query, k):
    scores = z @ z[query]
    order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[query]][:k]
    return [(n + 1, int(ids[j]), int(scores[j])) for n, j in enumerate(order)]


def test_top_k_is_exact_on_the_given_table(spark):
    ids, e = table(spark)
    z = np.floor(e * 1024).astype(np.int64)
    found = grouped(op10_topk(spark, SF))
    assert found == {int(ids[q]): exact_top(ids, z, q, 10) for q in np.flatnonzero(ids % 100 == 0)}


def test_top_k_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF}/embeddings.parquet')")
    expected = sorted(con.execute(topk.top_k_sql()).fetchall())
    assert sorted(tuple(r) for r in op10_topk(spark, SF).collect()) == expected


def test_recall_and_scores_on_the_given_table(spark):
    ids, e = table(spark)
    x = e / np.sqrt((e**2).sum(1, keepdims=True))
    found, hits = grouped(op9_ann(spark, SF)), []
    for q in np.flatnonzero(ids % 50 == 0):
        cosines = x @ x[q]
        best = [j for j in np.lexsort((ids, -cosines)) if j != q][:5]
        mine = found[int(ids[q])]
        hits.append(len({int(ids[j]) for j in best} & {v for _, v, _ in mine}) / 5)
        assert [n for n, _, _ in mine] == [1, 2, 3, 4, 5]
        for _, v, score in mine:
            assert score == pytest.approx(cosines[np.searchsorted(ids, v)], abs=1e-12)
    assert np.mean(hits) >= 0.9


def structured(spark, copies=300):
    """Clusters, many equal vectors (ties), and rows that take no part."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((5, 4))
    rows = [(k, [float(np.float32(v)) for v in centres[k % 5] + 0.05 * rng.standard_normal(4)], 0) for k in range(400)]
    rows += [(2000 + k, [0.5, -0.25, 0.125, 1.0], 0) for k in range(copies)]
    return rows, spark.createDataFrame(rows + ODD, SCHEMA)


def test_dual_tree_on_clusters_ties_and_odd_rows(spark):
    rows, df = structured(spark)
    ids, z = np.array([r[0] for r in rows]), np.floor(np.array([r[1] for r in rows]) * 1024).astype(np.int64)
    for shard_rows, query_rows in ((4096, 4096), (100, 3)):
        config = topk.TopkConfig(leaf=4, shard_rows=shard_rows, query_rows=query_rows)
        found = grouped(topk.top_k(df, F.col("id") % 100 == 0, 10, config=config))
        zero = found.pop(1002, None)  # the zero vector takes part here, as a row and, were its id due, as a query
        assert zero is None
        for q in np.flatnonzero(ids % 100 == 0):
            with_zero = np.append(ids, 1002), np.vstack([z, np.zeros(4, np.int64)])
            if query_rows == 4096:
                assert found[int(ids[q])] == exact_top(*with_zero, q, 10)
            assert [s for _, _, s in found[int(ids[q])]] == [s for _, _, s in exact_top(*with_zero, q, 10)]


def test_dual_tree_prunes_and_stays_exact():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((8, 3)) * 100
    rows = np.floor(np.concatenate([c + rng.standard_normal((200, 3)) for c in centres]))
    search = topk.DualSearch(rows[::40], rows, 8, 5)
    compared = []
    group = search._group
    search._group = lambda asked, leaves, *rest: (compared.append(len(asked) * sum(len(search.tree_d.members[k]) for k in leaves)), group(asked, leaves, *rest))
    found = search.run(lambda q, near: near == q * 40)
    for q, (at, scores) in enumerate(found):
        dots = rows @ rows[q * 40]
        order = [j for j in np.lexsort((np.arange(len(rows)), -dots)) if j != q * 40][:5]
        assert at.tolist() == order and scores.tolist() == dots[order].tolist()
    assert sum(compared) < 0.5 * len(rows) * len(rows[::40])


def test_dual_tree_with_repeated_query_ids(spark, scratch_dir):
    rng = np.random.default_rng(9)
    rows = [(k, [float(np.float32(v)) for v in rng.standard_normal(4)], 0) for k in range(1, 600) if k % 100]
    rows += [(100, [50.0, 40.0, -30.0, 20.0], 0)] * 40  # an outlier: all of a leaf, its products with itself the highest
    centre = np.array([-3.0, 2.0, 1.0, -2.0])
    rows += [(2001 + k, [float(np.float32(v)) for v in centre + 1e-4 * rng.standard_normal(4)], 0) for k in range(9)]
    rows += [(200, centre.tolist(), 0)] * 2  # a tight cluster of eleven rows
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(f"{scratch_dir}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{scratch_dir}/embeddings.parquet/*.parquet')")
    expected = sorted(con.execute(topk.top_k_sql()).fetchall())
    assert {q for q, *_ in expected} == {100, 200} and len(expected) == 20
    for config in (topk.TopkConfig(leaf=1), topk.TopkConfig(leaf=1, shard_rows=200)):
        assert sorted(tuple(r) for r in topk.top_k(df, F.col("id") % 100 == 0, 10, config=config).collect()) == expected


def clustered(spark, clusters, each, seed=11, dims=6):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dims))
    centres *= 3 / np.sqrt((centres**2).sum(1, keepdims=True))
    x = np.repeat(centres, each, axis=0) + 0.02 * rng.standard_normal((clusters * each, dims))
    x = x.astype(np.float32).astype(np.float64)
    return x, spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], SCHEMA)


def test_queries_reach_only_the_cells_that_can_matter(spark):
    config = topk.TopkConfig(leaf=4, shard_rows=64, query_rows=8)
    pairs = {}
    for clusters in (30, 60):
        x, df = clustered(spark, clusters, 50)
        ids, z = np.arange(len(x)), np.floor(x * 1024).astype(np.int64)
        packed = topk.pack(df, "vec_id", "embedding", nonzero=False)
        cells = topk.cover(packed, config)
        assert cells.shards.sum() > len(x) / 64
        assert cells.rows.count() == len(x)
        queries = topk.distinct_queries(packed, F.col("id") % 100 == 0)
        exact = {q: exact_top(ids, z, q, 10) for q in range(0, len(x), 100)}
        worst = spark.createDataFrame([(q, float(rows[-1][2])) for q, rows in exact.items()], "id long, floor double")
        pairs[clusters] = topk.routes(queries.join(worst, "id"), cells, packed, config, home=False).count() / (len(exact) * cells.shards.sum())
        assert grouped(topk.top_k(df, F.col("id") % 100 == 0, 10, config=config)) == exact
    assert pairs[30] < 0.5 and pairs[60] < pairs[30]  # shares of all pairs of query and shard


def test_cells_cover_their_rows_and_large_ones_are_dealt_to_shards(spark):
    rows, df = structured(spark)
    config = topk.TopkConfig(shard_rows=50)
    packed = topk.pack(df, "vec_id", "embedding", nonzero=False)
    cells = topk.cover(packed, config)
    held = cells.rows.collect()
    assert len(held) == len(rows) + 1  # the zero vector takes part
    x = topk.quantised(topk.unpack(topk.pa.chunked_array([[bytes(r.v) for r in held]]), packed.width, packed.dtype), 1024)
    cell, shard = np.array([r.cell for r in held]), np.array([r.shard for r in held])
    assert (np.sqrt(((x - cells.centres[cell]) ** 2).sum(1)) <= cells.radii[cell] + 1e-9).all()
    assert (shard < cells.shards[cell]).all() and cells.shards.max() >= 6  # 300 equal rows
    assert np.bincount(shard[cell == np.argmax(cells.shards)]).max() < 100


def test_cover_tree_invariants():
    points = np.random.default_rng(1).standard_normal((300, 3))
    tree = topk.CoverTree(points, 4)
    assert sorted(np.concatenate(tree.members).tolist()) == list(range(300))
    for above, here in zip(tree.centres, tree.centres[1:]):
        assert set(above) <= set(here)  # nested
    leaf_of = np.empty(300, np.int64)
    for k, m in enumerate(tree.members):
        leaf_of[m] = k
    node = leaf_of
    for level in range(len(tree.centres) - 1, -1, -1):
        gap = np.sqrt(((points - points[tree.centres[level][node]]) ** 2).sum(1))
        assert (gap <= tree.radii[level][node] + 1e-12).all()  # covering
        node = tree.parents[level][node]


def test_large_components_use_integers():
    search = topk.inner_product_search(topk.TopkConfig(), 2)
    ids, big = np.array([1, 2, 3]), np.array([[2.0**40, 1.0], [2.0**30, 5.0], [-(2.0**40), 1.0]])
    at, found, score = search(ids[:1], big[:1], ids, big)
    assert found.tolist() == [1, 2] and score.tolist() == [(1 << 63) - 1, -(1 << 63)]


def test_large_components_against_plain_integers():
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((6, 3)) * 2.0**17
    x = np.concatenate([c + rng.standard_normal((40, 3)) * 2.0**9 for c in centres])
    ids = np.arange(len(x))
    at, found, score = topk.inner_product_search(topk.TopkConfig(leaf=4), 5)(ids[::20], x[::20], ids, x)
    z = [[int(v) for v in row] for row in np.floor(x * 1024).tolist()]
    for n, q in enumerate(ids[::20].tolist()):
        products = sorted((-sum(a * b for a, b in zip(z[q], row)), j) for j, row in enumerate(z) if j != q)[:5]
        assert list(zip((-score[at == n]).tolist(), found[at == n].tolist())) == products
    assert max(abs(p) for p, _ in products) > 2**53


def test_inverted_files_give_the_footrule_distance():
    rng = np.random.default_rng(6)
    orders = np.argsort(rng.random((50, 12)), axis=1)[:, :5]
    files = ann.InvertedFiles(orders, 12)
    place = np.full((50, 12), 5)
    np.put_along_axis(place, orders, np.arange(5)[None], 1)
    distance = np.abs(place - place[7]).sum(1)
    assert (2 * (5 * 6 // 2) - 2 * files.saved(orders[7]) == distance).all()


def test_ann_ties_odd_rows_and_shards(spark):
    rows, df = structured(spark)
    for shard_rows, query_rows in ((4096, 4096), (100, 3)):
        found = grouped(ann.nearest(df, F.col("id") % 100 == 0, 5, config=ann.AnnConfig(shard_rows=shard_rows, query_rows=query_rows, pivots=16, prefix=8)))
        assert set(found) == {0, 100, 200, 300, 2000, 2100, 2200}
        assert [v for _, v, _ in found[2000]] == [2001, 2002, 2003, 2004, 2005]
        assert [v for _, v, _ in found[2100]] == [2000, 2001, 2002, 2003, 2004]
        assert all(abs(s - 1) < 1e-12 for _, _, s in found[2100])


def nearest_by_brute_force(ids, x, query, k):
    cosines = (x * x[query]).sum(1)
    return [int(ids[j]) for j in np.lexsort((ids, -cosines)) if ids[j] != ids[query]][:k]


def test_ann_finds_neighbours_of_a_repeated_query_id(spark):
    rng = np.random.default_rng(8)
    rows = [(k, rng.standard_normal(8).astype(np.float32).astype(float).tolist(), 0) for k in range(1, 150)]
    rows += [(200, [1.0, -1.0, 0.5, 0.25, 2.0, 1.0, 0.0, -0.5], 0)] * 300  # more rows than are reranked
    ids, x = np.array([r[0] for r in rows]), ann.unit(np.array([r[1] for r in rows]))
    found = grouped(ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") == 200))
    assert [v for _, v, _ in found[200]] == nearest_by_brute_force(ids, x, len(ids) - 1, 5)


def test_ann_equal_vectors_take_one_place_of_the_share():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((150, 8))
    scales = np.concatenate([np.ones(150), np.full(300, 1.0), np.full(300, 3.0)])  # the last 600 rows have one direction
    x = np.concatenate([x, np.repeat(x[:1], 600, axis=0)]) * scales[:, None]
    ids, points = np.arange(len(x)), ann.unit(x)
    search = ann.cosine_search(ann.choose_pivots(points, 8), ann.AnnConfig(pivots=8, prefix=4), 5)
    at, found, _ = search(ids[1:150], x[1:150], ids, x)
    for q in range(149):
        assert set(found[at == q].tolist()) - set(range(150, 750)) == set(nearest_by_brute_force(ids, points, q + 1, 5)) - set(range(150, 750))


def test_few_and_no_candidates(spark):
    two = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [1.0, 1.0], 0)], SCHEMA)
    assert [(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(two, F.col("id") == 0).collect()] == [(0, 1, 1)]
    assert [(r.vec_id, r.score) for r in topk.top_k(two, F.col("id") == 0).collect()] == [(1, 1024 * 1024)]
    none = spark.createDataFrame([], SCHEMA)
    assert ann.nearest(none, F.col("id") == 0).count() == 0
    assert topk.top_k(none, F.col("id") == 0).count() == 0


def test_best_of_prefers_the_smaller_index():
    assert vectors.best_of(np.array([1, 3, 3, 2, 3]), 2).tolist() == [1, 2]
    assert vectors.best_of(np.array([1.0]), 3).tolist() == [0]
