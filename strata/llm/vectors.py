"""Vectors in blocks: packed rows, shards, and query blocks that meet every shard."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import pick, ship, staged


@dataclass(frozen=True)
class Packed:
    """Rows (row, id, v): a number of the row, its id, and its components as bytes of ``dtype``."""

    rows: DataFrame
    width: int
    dtype: str
    count: int


def pack(vectors: DataFrame, id_col: str, vector_col: str, nonzero: bool) -> Packed:
    """Write the usable vectors as bytes: not null or empty, all components finite, of the most
    common length (the shorter of two equally common), and, if ``nonzero``, not all zero."""
    ship(vectors.sparkSession)
    rows = pick(vectors, id_col, vector_col).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    element = rows.schema["v"].dataType.elementType
    dtype = "<f4" if isinstance(element, T.FloatType) else "<f8"
    rows = rows.select("id", F.col("v").cast("array<float>" if dtype == "<f4" else "array<double>").alias("v"))
    usable = F.size("v") > 0
    usable &= ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    if nonzero:
        usable &= F.exists("v", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(usable, F.lit(False)))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    width = lengths[0]["n"] if lengths else 1
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("v", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(dtype)
            step = width * int(dtype[-1])
            data = flat.tobytes()
            packed = [data[k * step : (k + 1) * step] for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=schema.names)

    kept = staged(rows.where(F.size("v") == width).mapInArrow(run, schema))
    kept = kept.withColumn("row", F.monotonically_increasing_id())
    return Packed(kept, width, dtype, kept.count())


def unpack(column: pa.ChunkedArray, width: int, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def sample(packed: Packed, most: int, seed: str) -> np.ndarray:
    """About nine tenths of ``most`` rows (all, if there are no more), chosen by a hash of the row number."""
    rows = packed.rows
    if packed.count > most:
        slots = 1 << 30
        rows = rows.where(F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(slots)) < int(slots * 0.9 * most / packed.count))
    found = [bytes(r["v"]) for r in rows.orderBy("row").select("v").collect()]
    return np.frombuffer(b"".join(found), packed.dtype).reshape(-1, packed.width).astype(np.float64)


Search = Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray]]


def distinct_queries(packed: Packed, is_query: Column) -> DataFrame:
    """The queries as (id, v, q), q a number of the query; equal rows with one id are one query."""
    queries = staged(packed.rows.where(is_query).select("id", "v").distinct())
    return queries.withColumn("q", F.monotonically_increasing_id())


def meetings(left: DataFrame, right: DataFrame, keys: list[str], packed: Packed, search: Search, score_type: str) -> DataFrame:
    """(q, query_id, vec_id, score) of rows and queries that meet in a cell, one task per cell.

    ``search`` gets the ids and vectors of both and returns (query index, vector index,
    score): at least the best ``k`` of the cell for each query, without rows of the query's
    own id. If the queries have a column ``floor``, it gets that, too.
    """
    width, dtype = packed.width, packed.dtype
    id_type = packed.rows.schema["id"].dataType.simpleString()
    numeric = pa.int64() if score_type == "long" else pa.float64()

    def meet(key: tuple, rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"q": [], "query_id": [], "vec_id": [], "score": []}
        if rows.num_rows and asked.num_rows:
            ids, query_ids = rows.column("id").to_numpy(), asked.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            floors = (asked.column("floor").to_numpy(),) if "floor" in asked.column_names else ()
            found = search(query_ids, unpack(asked.column("v"), width, dtype), ids[order], unpack(rows.column("v"), width, dtype)[order], *floors)
            at, found, score = found
            out = {"q": asked.column("q").to_numpy()[at], "query_id": query_ids[at], "vec_id": ids[order][found], "score": score}
        kind = rows.schema.field("id").type
        types = (("q", pa.int64()), ("query_id", kind), ("vec_id", kind), ("score", numeric))
        return pa.table({name: pa.array(out[name], kind) for name, kind in types})

    cells = left.select(*keys, "id", "v").groupBy(*keys).cogroup(right.groupBy(*keys))
    return cells.applyInArrow(meet, f"q long, query_id {id_type}, vec_id {id_type}, score {score_type}")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every query: query_id, rank, vec_id, score; ties go to the smaller vec_id."""
    best = Window.partitionBy("q", "query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def search_blocks(
    packed: Packed, is_query: Column, search: Search, k: int, score_type: str, shard_rows: int, query_rows: int
) -> DataFrame:
    """The ``k`` best of every query: query_id, rank, vec_id, score; ties go to the smaller vec_id.

    The rows are dealt evenly to shards and the queries to blocks; every block of queries
    meets every shard in a task of its own, so a task holds ``shard_rows`` rows and
    ``query_rows`` queries whatever the size of the table. Equal rows with a query's id are
    one query; as candidates they are rows of their own.
    """
    queries = distinct_queries(packed, is_query)
    shards = max(1, -(-packed.count // shard_rows))
    blocks = max(1, -(-queries.count() // query_rows))
    # numbers within a file come one after the other, so remainders deal them evenly
    data = packed.rows.withColumn("shard", F.pmod("row", F.lit(shards)))
    data = data.withColumn("block", F.explode(numbers(blocks)))
    asked = queries.withColumn("block", F.pmod("q", F.lit(blocks)))
    asked = asked.withColumn("shard", F.explode(numbers(shards)))
    return ranked(meetings(data, asked, ["shard", "block"], packed, search, score_type), k)


def numbers(n: int | Column) -> Column:
    """The array 0 .. n - 1 of longs."""
    return F.sequence(F.lit(0).cast("long"), ((F.lit(n) if isinstance(n, int) else n) - 1).cast("long"))


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the ``k`` largest scores, largest first, smaller index first among equals."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > edge)
        chosen = np.concatenate([above, np.flatnonzero(scores == edge)[: k - len(above)]])
    else:
        chosen = np.arange(len(scores))
    return chosen[np.lexsort((chosen, -scores[chosen]))]
