"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strata
from strata.operators.materialize import materialize
from strata.session import scratch_path
from strata.sinks.files import write_bytes

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
BLOCK = 1 << 20
BATCH_ROWS = 512
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application, and bound their batches.

    The source files go out through ``addPyFile`` by way of the shared checkpoint folder;
    nothing is expected to be installed on the executors. Arrow batches are
    counted in rows, and rows here are whole texts: the default of 10,000 would keep tens
    of megabytes per batch on both sides of the pipe, so it is lowered to ``BATCH_ROWS``.
    """
    context = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    package = Path(strata.__file__).parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    archive = f"{scratch_path(spark, 'ship')}/strata_package.zip"
    write_bytes(spark, archive, buffer.getvalue())
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns of ``df``, under these names.

    Columns are found by position, so further columns may clash with them (the same
    name twice, or in other letter case): the first exact match is taken.
    """
    columns = df.columns
    missing = [n for n in names if n not in columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    plain = df.toDF(*(f"c{i}" for i in range(len(columns))))
    return plain.select(*(F.col(f"c{columns.index(n)}").alias(n) for n in names))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder as Parquet and read back.

    Like a reliable checkpoint it survives lost executors, but keeps columns prunable
    and compressed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold_of(id_column: str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % folds


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """``rows`` (one per key), or about nine tenths of ``most`` of them, chosen by a hash of the key.

    Keys are kept by a hash below a threshold that one count gives, so nothing is sorted
    or gathered, and a rerun chooses the same keys.
    """
    n = rows.count()
    if n <= most:
        return rows
    slots = 1 << 30
    return rows.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(slots)) < int(slots * 0.9 * most / n))


def bounded_rows(rows: DataFrame, key: str, text: str, most: int) -> DataFrame:
    """``rows`` of at most ``most`` keys, or, if there are more than ``most`` rows, about that many at most.

    Then equal texts of a key count once, and all keys get the same limit: one with no
    more texts keeps them all, others about as many as the limit, chosen by a hash of the text.
    """
    if rows.count() <= most:
        return rows
    mark, texts, number = unique_name("mark"), unique_name("texts"), unique_name("number")
    marked = rows.withColumn(mark, F.xxhash64(F.col(text), F.lit("rows")))
    sizes = staged(marked.select(key, mark).distinct().groupBy(key).agg(F.count("*").alias(texts)))
    counts = {r[texts]: r[number] for r in sizes.groupBy(texts).agg(F.count("*").alias(number)).collect()}
    limit, above = 1, max(counts, default=1)
    while limit < above:  # the largest limit that holds the bound
        middle = (limit + above + 1) // 2
        if sum(n * min(size, middle) for size, n in counts.items()) <= 0.9 * most:
            limit = middle
        else:
            above = middle - 1
    slots = 1 << 30
    # one row per key, of which there are at most ``most``
    kept = marked.join(F.broadcast(sizes), key).where(F.pmod(mark, F.lit(slots)) * F.col(texts) < F.lit(slots * limit))
    return kept.dropDuplicates([key, mark]).select(*rows.columns)


def word_blocks(text: bytes | None, size: int = BLOCK) -> Iterator[list[bytes]]:
    """Words of a whole text, A-Z lower-cased, as lists from about ``size`` bytes each.

    Words are runs without the six ASCII white-space characters; blocks end at white
    space, so no word is cut and a very long text never is one huge list.
    """
    start, end = 0, len(text or b"")
    while start < end:
        stop = end
        if end - start > size:
            found = _SPACE.search(text, start + size)
            stop = found.start() if found else end
        yield text[start:stop].lower().split()
        start = stop


def star_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of ``edges`` (u, v) as (node, root): every node and its smallest node.

    Alternates large-star and small-star steps (min-aggregations and joins on the node)
    until every edge points from a node to the root of its component. Both join sides
    are written tables, so Spark can split the rows of a hub over tasks; per-node
    minima are combined before the shuffle. Each round is cut with a reliable checkpoint.
    """
    current = materialize(
        edges.where("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct()
    )
    for _ in range(max_rounds):
        if _is_forest(current):
            children = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
            roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
            return children.union(roots)
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            current.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = materialize(
            both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        )
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = materialize(small.union(low.select("a", F.col("m").alias("b"))).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _is_forest(edges: DataFrame) -> bool:
    """Whether every ``a`` has one edge and no ``b`` is an ``a`` (two counting jobs)."""
    ends = edges.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    per_node = ends.groupBy("a").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return per_node.where("up > 1 or (up > 0 and down > 0)").limit(1).count() == 0


CHUNK = 256


def array_sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda total, x: total + x)


def chunk_sums(numbers: Column) -> Column:
    """Sums of each CHUNK numbers of an array, for :func:`sum_before`; null for an empty array."""
    count = F.ceil(F.size(numbers) / CHUNK).cast("int")
    sums = F.transform(F.sequence(F.lit(0), count - 1), lambda b: array_sum(F.slice(numbers, b * CHUNK + 1, F.lit(CHUNK))))
    return F.when(F.size(numbers) > 0, sums)


def sum_before(numbers: Column, sums: Column, at: Column) -> Column:
    """Sum of the first ``at`` numbers: whole chunks, then the rest."""
    whole = F.floor(at / CHUNK).cast("int")
    return array_sum(F.slice(sums, F.lit(1), whole)) + array_sum(F.slice(numbers, whole * CHUNK + 1, at - whole * CHUNK))


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
