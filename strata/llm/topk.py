"""Exact top-k by inner product with a dual cover-tree search.

The top level of the data's cover is global: farthest-first centres from a bounded sample
divide all rows into cells, whose radii and row counts are exact. A query first meets its
home cell, the one whose centre has the highest product with it, which gives it a worst kth
score to carry; then it goes only to the cells whose bound <q, c> + r |q| reaches that
score. A cell that no query reaches is never moved. Cells of more than ``shard_rows`` rows
are dealt to several shards, and more than ``query_rows`` queries at a cell to several blocks.

In every shard a cover tree is built over the rows and one over the block of queries.
Node pairs are visited together. A pair of nodes with centres c, d and covering radii r, s
holds no inner product above <c, d> + r |d| + s |c| + r s; it is pruned when that is below
the worst kth score of the queries under its query node, found here or carried. Leaf pairs
are compared with the highest bounds first, so that kth scores rise early.

Components become floor(1024 x). Scores are exact integers: sums below 2**53 in float64
products, larger ones in Python integers for the leaf pairs that the bounds leave (a score
beyond 64 bits is cut to their range).

Defined cases: vectors that are null, empty, of an uncommon length, or hold null or non-
finite components take no part, nor do rows with a null id; ties go to the smaller id;
rows that share the query's id are not its candidates; fewer candidates than ``k`` are
all returned; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged
from strata.llm.vectors import Packed, best_of, distinct_queries, meetings, numbers, pack, ranked, sample, unpack

EXACT = 2.0**53


@dataclass(frozen=True)
class TopkConfig:
    scale: int = 1024
    leaf: int = 16  # rows under a leaf, about
    shard_rows: int = 4096
    query_rows: int = 4096
    cells: int = 1024  # of the global cover, at most
    centre_sample: int = 4096  # rows from which its centres are taken
    seed: str = "cells"


class CoverTree:
    """Nested farthest-first covers: level by level half the radius, leaves hold the rows.

    ``levels[l]`` has the nodes of a level as (centre row, radius over all rows below,
    parent node); every row belongs to one leaf, a node of the last level.
    """

    def __init__(self, points: np.ndarray, leaf: int) -> None:
        n = len(points)
        most = max(1, n // leaf)
        centres, reach = [0], []
        nearest, owner = self._distance(points, 0), np.zeros(n, np.int64)
        while len(centres) < most:
            far = int(np.argmax(nearest))
            if nearest[far] == 0:
                break
            reach.append(nearest[far])
            distance = self._distance(points, far)
            closer = distance < nearest
            owner[closer], nearest = len(centres), np.minimum(nearest, distance)
            centres.append(far)
        # the first j centres cover all rows within reach[j - 1]; levels halve that radius
        sizes, radius = [1], reach[0] if reach else 0.0
        while sizes[-1] < len(centres):
            radius /= 2
            j = sizes[-1] + int(np.searchsorted(-np.array(reach[sizes[-1] - 1 :]), -radius))
            sizes.append(max(min(j, len(centres)), min(len(centres), sizes[-1] + 1)))
        self.members = [np.flatnonzero(owner == c) for c in range(len(centres))]
        self.centres = [np.array(centres[:s]) for s in sizes]
        self.parents: list[np.ndarray] = [np.zeros(1, np.int64)]
        for above, here in zip(self.centres, self.centres[1:]):
            gaps = np.stack([self._distance(points[here], None, points[c]) for c in above])
            self.parents.append(np.argmin(gaps, axis=0))
        self.radii = [np.zeros(len(c)) for c in self.centres]
        node = owner
        for level in range(len(self.centres) - 1, -1, -1):
            gap = np.sqrt(((points - points[self.centres[level][node]]) ** 2).sum(axis=1))
            np.maximum.at(self.radii[level], node, gap)
            node = self.parents[level][node]

    @staticmethod
    def _distance(points: np.ndarray, row: int | None, to: np.ndarray | None = None) -> np.ndarray:
        return np.sqrt(((points - (points[row] if to is None else to)) ** 2).sum(axis=1))

    def children(self, level: int) -> list[np.ndarray]:
        return [np.flatnonzero(self.parents[level + 1] == k) for k in range(len(self.centres[level]))]


class DualSearch:
    """Top ``k`` inner products of queries with rows, by simultaneous descent of two trees."""

    def __init__(self, queries: np.ndarray, rows: np.ndarray, leaf: int, k: int, floors: np.ndarray | None = None) -> None:
        self.q, self.d, self.k = queries, rows, k
        self.floors = np.full(len(queries), -np.inf) if floors is None else floors
        top_q, top_d = (float(np.abs(x).max()) if x.size else 0.0 for x in (queries, rows))
        large = top_q * top_d * queries.shape[1] >= EXACT
        self.exact_q, self.exact_d = (_integers(queries), _integers(rows)) if large else (queries, rows)
        self.tree_q, self.tree_d = CoverTree(queries.astype(np.float64), leaf), CoverTree(rows.astype(np.float64), leaf)
        self.norm_q, self.norm_d = np.sqrt((self.q.astype(np.float64) ** 2).sum(1)), np.sqrt((self.d.astype(np.float64) ** 2).sum(1))

    def bounds(self, level_q: int, nodes_q: np.ndarray, level_d: int, nodes_d: np.ndarray) -> np.ndarray:
        """Upper bound of all inner products under each pair of nodes."""
        c, d = self.tree_q.centres[level_q][nodes_q], self.tree_d.centres[level_d][nodes_d]
        r, s = self.tree_q.radii[level_q][nodes_q], self.tree_d.radii[level_d][nodes_d]
        dots = np.einsum("nd,nd->n", self.q[c].astype(np.float64), self.d[d].astype(np.float64))
        spread = r * self.norm_d[d] + s * self.norm_q[c] + r * s
        return _bound(dots, spread, self.norm_q[c] * self.norm_d[d])

    def run(self, skip) -> list[tuple[np.ndarray, np.ndarray]]:
        """(row indexes, scores) of each query; ``skip(query, rows)`` marks rows that are not its candidates."""
        every = np.arange(len(self.d))
        floors = [-x for x in self._most(-self.floors)]
        skipped = self._most(np.array([np.count_nonzero(skip(q, every)) for q in range(len(self.q))], np.int64))
        last_q, last_d = len(self.tree_q.centres) - 1, len(self.tree_d.centres) - 1
        pair_q, pair_d = np.zeros(1, np.int64), np.zeros(1, np.int64)
        level_q = level_d = 0
        while level_q < last_q or level_d < last_d:
            if level_q < last_q:
                pair_q, pair_d = _expand(pair_q, pair_d, self.tree_q.children(level_q))
                level_q += 1
            if level_d < last_d:
                pair_d, pair_q = _expand(pair_d, pair_q, self.tree_d.children(level_d))
                level_d += 1
            pair_q, pair_d = self._prune(level_q, pair_q, level_d, pair_d, skipped[level_q], floors[level_q])
        bound = self.bounds(last_q, pair_q, last_d, pair_d)
        results: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, self.exact_q.dtype))] * len(self.q)
        order = np.lexsort((-bound, pair_q))
        pair_q, pair_d, bound = pair_q[order], pair_d[order], bound[order]
        starts = np.searchsorted(pair_q, np.arange(len(self.tree_q.members) + 1))
        for group, asked in enumerate(self.tree_q.members):
            leaves, tops = pair_d[starts[group] : starts[group + 1]], bound[starts[group] : starts[group + 1]]
            self._group(asked, leaves, tops, results, skip)
        return results

    def _most(self, values: np.ndarray) -> list[np.ndarray]:
        """By level, the largest of the queries' values under each query node."""
        out = [np.array([values[m].max() for m in self.tree_q.members])]
        for level in range(len(self.tree_q.centres) - 1, 0, -1):
            above = np.full(len(self.tree_q.centres[level - 1]), values.min())
            np.maximum.at(above, self.tree_q.parents[level], out[0])
            out.insert(0, above)
        return out

    def _prune(self, level_q: int, pair_q: np.ndarray, level_d: int, pair_d: np.ndarray, skipped: np.ndarray, floors: np.ndarray):
        """Drop node pairs that cannot reach the kth best lower bound of their query node.

        A data node with n rows holds n inner products of at least 2 <c, d> - bound; the
        kth of these, over all data nodes paired with a query node, is below its worst kth
        score. As many more rows than ``k`` are asked for as a query under the node skips.
        The least floor of the node's queries is a lower bound, too.
        """
        bound = self.bounds(level_q, pair_q, level_d, pair_d)
        c, d = self.tree_q.centres[level_q][pair_q], self.tree_d.centres[level_d][pair_d]
        dots = np.einsum("nd,nd->n", self.q[c].astype(np.float64), self.d[d].astype(np.float64))
        low = 2 * dots - bound
        sizes = self._sizes(level_d)[pair_d]
        order = np.lexsort((-low, pair_q))
        ordered = pair_q[order]
        held = np.cumsum(sizes[order])
        first = np.searchsorted(ordered, np.arange(len(self.tree_q.centres[level_q])))
        base = np.concatenate([[0], held])[first]
        enough = held - base[ordered] >= self.k + skipped[ordered]
        worst = floors.copy()
        at = np.flatnonzero(enough)
        np.maximum.at(worst, ordered[at], low[order][at])
        keep = bound >= worst[pair_q]
        return pair_q[keep], pair_d[keep]

    def _sizes(self, level: int) -> np.ndarray:
        sizes = np.array([len(m) for m in self.tree_d.members])
        for above in range(len(self.tree_d.centres) - 1, level, -1):
            sizes = np.bincount(self.tree_d.parents[above], sizes, len(self.tree_d.centres[above - 1])).astype(np.int64)
        return sizes

    def _group(self, asked, leaves, tops, results, skip, chunk: int = 64) -> None:
        """Compare the queries of one leaf with data leaves, highest bounds first, until none can matter."""
        for at in range(0, len(leaves), chunk):
            full = all(len(results[q][0]) >= self.k for q in asked)
            worst = max(min(results[q][1][-1] for q in asked) if full else -np.inf, self.floors[asked].min())
            if tops[at] < worst:
                return
            near = np.concatenate([self.tree_d.members[leaf] for leaf in leaves[at : at + chunk]])
            scores = self.exact_q[asked] @ self.exact_d[near].T
            for q, row in zip(asked, scores):
                rows, seen = results[q]
                allowed = ~skip(q, near)
                rows, seen = np.concatenate([rows, near[allowed]]), np.concatenate([seen, row[allowed]])
                by_id = np.argsort(rows)  # rows are sorted by id
                best = best_of(seen[by_id], self.k)
                results[q] = rows[by_id][best], seen[by_id][best]


def _expand(nodes: np.ndarray, others: np.ndarray, children: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([len(c) for c in children])[nodes]
    flat = np.concatenate([children[k] for k in nodes]) if len(nodes) else np.empty(0, np.int64)
    return flat, np.repeat(others, counts)


def quantised(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(vectors.astype(np.float64) * scale)


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape)


def _bound(dots: np.ndarray, spread: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """``dots + spread``, raised above every rounding error; infinite where it cannot be told."""
    bound = dots + spread + 1e-9 * (norms + spread) + 1e-6
    return np.where(np.isnan(bound), np.inf, bound)


def inner_product_search(config: TopkConfig, k: int):
    def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, floors: np.ndarray | None = None):
        q, d = quantised(queries, config.scale), quantised(vectors, config.scale)
        found = DualSearch(q, d, config.leaf, k, floors).run(lambda at, rows: ids[rows] == query_ids[at])
        at = np.repeat(np.arange(len(found)), [len(r) for r, _ in found])
        scores = np.concatenate([s for _, s in found])
        if scores.dtype == object:
            scores = np.array([max(LOW, min(HIGH, s)) for s in scores.tolist()], np.int64)
        return at, np.concatenate([r for r, _ in found]), scores.astype(np.int64)

    return search


LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class Cover:
    """Cells of all rows: centres with radii, row counts and shards; ``rows`` is (cell, shard, id, v)."""

    rows: DataFrame
    centres: np.ndarray
    radii: np.ndarray
    shards: np.ndarray


def choose_centres(points: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first centres; fewer, if fewer points differ."""
    if not len(points):
        return points
    chosen, gaps = [0], np.full(len(points), np.inf)
    while len(chosen) < min(count, len(points)):
        gaps = np.minimum(gaps, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
        far = int(np.argmax(gaps))
        if gaps[far] == 0:
            break
        chosen.append(far)
    return points[chosen]


def cover(packed: Packed, config: TopkConfig) -> Cover:
    """Every row goes to the cell of its nearest centre."""
    wanted = min(config.cells, 2 * -(-packed.count // config.shard_rows)) if packed.count > config.shard_rows else 1
    centres = choose_centres(quantised(sample(packed, config.centre_sample, config.seed), config.scale), wanted)
    if not len(centres):  # an empty table
        centres = np.zeros((1, packed.width))
    width, dtype, scale = packed.width, packed.dtype, config.scale
    norms = (centres**2).sum(axis=1)
    id_type = packed.rows.schema["id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = quantised(unpack(pa.chunked_array([batch.column(2)]), width, dtype), scale)
            cell = np.argmin(norms - 2 * (x @ centres.T), axis=1)
            gap = np.sqrt(((x - centres[cell]) ** 2).sum(axis=1)) if len(x) else np.empty(0)
            gap = np.where(np.isnan(gap), np.inf, gap)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64()), pa.array(gap, pa.float64())], names=["row", "id", "v", "cell", "gap"])

    rows = staged(packed.rows.select("row", "id", "v").mapInArrow(assign, f"row long, id {id_type}, v binary, cell long, gap double"))
    radii, counts = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for r in rows.groupBy("cell").agg(F.max("gap").alias("gap"), F.count("*").alias("n")).collect():  # a row per cell
        radii[r["cell"]], counts[r["cell"]] = r["gap"], r["n"]
    shards = np.maximum(1, -(-counts // config.shard_rows))
    spread = F.pmod(F.xxhash64("row"), F.get(F.lit(shards.tolist()), F.col("cell").cast("int")))
    return Cover(rows.select("cell", spread.alias("shard"), "id", "v"), centres, radii, shards)


def routes(asked: DataFrame, found: Cover, packed: Packed, config: TopkConfig, home: bool) -> DataFrame:
    """The queries (id, v, q, floor) with each (cell, shard) they go to: one shard of the home cell
    (``home``), or all others whose bound reaches the floor."""
    width, dtype, scale = packed.width, packed.dtype, config.scale
    centres, radii, shards = found.centres, found.radii, found.shards
    lengths = np.sqrt((centres**2).sum(axis=1))
    schema = asked.select("id", "v", "q", "floor").schema.add("cell", "long").add("shard", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = quantised(unpack(pa.chunked_array([batch.column(1)]), width, dtype), scale)
            q, floor = (batch.column(k).to_numpy() for k in (2, 3))
            dots, length = x @ centres.T, np.sqrt((x**2).sum(axis=1))[:, None]
            cell = np.argmax(dots, axis=1)
            shard = q % shards[cell]
            if home:
                at = np.arange(len(q))
            else:
                kept = _bound(dots, length * radii, length * lengths) >= floor[:, None]
                at, cells = np.nonzero(kept)
                first_cell, first_shard, at_shards = cell, shard, shards[cells]
                ends = np.cumsum(at_shards)
                shard = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - at_shards, at_shards)
                at, cell = np.repeat(at, at_shards), np.repeat(cells, at_shards)
                other = (cell != first_cell[at]) | (shard != first_shard[at])
                at, cell, shard = at[other], cell[other], shard[other]
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cell, pa.int64()), pa.array(shard, pa.int64())], names=schema.names)

    return asked.select("id", "v", "q", "floor").mapInArrow(run, schema)


def meet_routed(routed: DataFrame, found: Cover, packed: Packed, config: TopkConfig, k: int) -> DataFrame:
    """Queries and rows at the same shard; a cell's rows go out once per block of queries there, those of a cell without queries not at all."""
    most = routed.groupBy("cell", "shard").count().groupBy("cell").agg(F.max("count").alias("n"))
    blocks = most.select("cell", F.ceil(F.col("n") / config.query_rows).alias("blocks"))
    blocks = F.broadcast(blocks)  # a row per cell, of which there are at most ``cells``
    asked = routed.join(blocks, "cell").withColumn("block", F.pmod("q", "blocks")).drop("blocks")
    rows = found.rows.join(blocks, "cell").withColumn("block", F.explode(numbers(F.col("blocks"))))
    search = inner_product_search(config, k)
    return staged(meetings(rows, asked, ["cell", "shard", "block"], packed, search, "long"))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", config: TopkConfig = TopkConfig()
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest inner products of every query. ``is_query`` is a condition on ``id``."""
    packed = pack(vectors, id_col, vector_col, nonzero=False)
    cells = cover(packed, config)
    queries = distinct_queries(packed, is_query).withColumn("floor", F.lit(float("-inf")))
    first = meet_routed(routes(queries, cells, packed, config, home=True), cells, packed, config, k)
    if cells.shards.sum() == 1:
        return ranked(first, k)
    # cut scores are no floor: all beyond the range of 64 bits tie
    worst = first.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    worst = worst.where((F.col("n") >= k) & (F.col("least") > LOW)).select("q", F.col("least").cast("double").alias("known"))
    asked = queries.join(worst, "q", "left").withColumn("floor", F.coalesce("known", "floor"))
    routed = staged(routes(asked, cells, packed, config, home=False))
    return ranked(first.unionByName(meet_routed(routed, cells, packed, config, k)), k)


def top_k_sql(config: TopkConfig = TopkConfig(), k: int = 10, every: int = 100, vectors: str = "embeddings") -> str:
    """The result for every ``every``-th id as one SQL statement for DuckDB (float64 sums, exact below 2**53)."""
    return f"""
with usable as (
  select vec_id, list_transform(embedding, lambda x: floor({config.scale} * cast(x as double))) as z
  from {vectors}
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
width as (
  select len(z) as n from usable group by 1 order by count(*) desc, n limit 1),
fit as (
  select vec_id, z from usable where len(z) = (select n from width)),
pairs as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.z, c.z) as bigint) as score
  from (select distinct vec_id, z from fit where vec_id % {every} = 0) q join fit c on c.vec_id <> q.vec_id),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= {k}"""
