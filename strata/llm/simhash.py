"""SimHash near-duplicate groups by a binary trie self-join.

1. Every whole text becomes a 64-bit fingerprint: the bitwise majority of the XXH64
   hashes of its word shingles.
2. Rows fold to distinct fingerprints, so thousands of exact copies are one row.
3. Two fingerprints within ``max_bits`` agree on at least one of ``max_bits + 1`` bit
   blocks, so fingerprints are dealt to cells by (block, value of some of its bits): as many
   bits as leave about ``cell_rows`` fingerprints to a cell, none for a small table. Cells
   far above the mean (a group of near copies) are split into sub-cells that are joined in
   pairs.
4. In each cell a binary trie over the sorted fingerprints is joined with itself: node
   pairs descend together, differing branch bits add up, and a pair is dropped as soon
   as its bits exceed the budget. Linked fingerprints leave the cell as (fingerprint,
   smallest linked fingerprint of the cell), never as all pairs.
5. Components of those links are found by min-label star contraction.

Defined cases: null text counts as empty; a text without words has fingerprint zero and
links like any other; fewer words than the shingle length give one shingle of all
words; rows with a null id take part, but never lend their id to a component unless it
holds no other; equal rows stay and share one component; an empty table gives an empty
result; columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import pick, ship, staged, star_components, unique_name, word_blocks
from strata.operators.materialize import materialize

BITS = 64
ROUTE_BITS = 13  # at most so many bits of a block route, so there are few cells
CELL_ROWS = 8192  # cells hold about half as many to as many fingerprints, and the trie prunes inside them
SEED = 42


def shingle_hashes(text: bytes | None, shingle: int, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 hashes of all word shingles of a text, repeats included, in blocks."""
    hash64 = xxhash.xxh64_intdigest
    tail: list[bytes] = []
    done = False
    for words in word_blocks(text):
        words = tail + words
        n = len(words) - shingle + 1
        if n > 0:
            grams = map(b" ".join, zip(*(words[k : k + n] for k in range(shingle))))
            yield np.fromiter((hash64(g, seed) for g in grams), np.uint64, n)
            done = True
        tail = words[max(0, len(words) - shingle + 1) :] if shingle > 1 else []
    if not done and tail:
        yield np.array([hash64(b" ".join(tail), seed)], np.uint64)


def fingerprint(text: bytes | None, shingle: int, seed: int = SEED) -> int:
    """Bit i is set when it is set in over half of the shingle hashes (unsigned)."""
    ones, total = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, shingle, seed):
        total += len(hashes)
        for at in range(0, len(hashes), 255):  # 255 rows of bits fit a byte sum
            bits = np.unpackbits(hashes[at : at + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.uint8)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, text_hash, fp) of every row; fp is a signed long that holds the 64 bits."""
    ship(docs.sparkSession)
    rows = pick(docs, id_col, text_col).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("binary").alias("t")
    )
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found.view(np.int64))], names=schema.names)

    return rows.mapInArrow(run, schema)


def _merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union the pairs (i, j) in ``labels``; labels stay roots, roots are smallest indexes."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return
        np.minimum.at(labels, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up


def trie_links(
    keys: np.ndarray,
    roots: list[tuple[int, int, int, int]],
    budget: int,
    leaf: int = 16,
    width: int = 100_000,
    counts: dict[str, int] | None = None,
) -> np.ndarray:
    """Component labels (smallest index) of keys linked within ``budget`` bits.

    ``keys`` are unsigned and sorted inside every range; ``roots`` holds the node pairs
    (lo, hi, lo, hi) to join: a range with itself, or two ranges with each other. Node
    pairs of small ranges are compared directly; at most about ``width`` node pairs of
    one level are held at a time. ``counts`` gets the node pairs that were ``descended`` or
    ``pruned`` by the budget, and the key pairs ``compared``.
    """
    counts = {} if counts is None else counts
    labels = np.arange(len(keys))
    start = np.array(roots, np.int64).reshape(-1, 4)
    same = (start[:, 0] == start[:, 2]) & (start[:, 1] == start[:, 3])
    stack = [(BITS - 1, *start.T, np.zeros(len(start), np.int64), same)]
    while stack:
        bit, alo, ahi, blo, bhi, diff, same = stack.pop()
        full = (ahi > alo) & (bhi > blo)
        counts["pruned"] = counts.get("pruned", 0) + int((full & (diff > budget)).sum())
        keep = full & (diff <= budget) & ~(same & (ahi - alo < 2))
        alo, ahi, blo, bhi, diff, same = (x[keep] for x in (alo, ahi, blo, bhi, diff, same))
        small = ((ahi - alo) * (bhi - blo) <= leaf) | (bit < 0)
        if small.any():
            counts["compared"] = counts.get("compared", 0) + int(((ahi - alo) * (bhi - blo))[small].sum())
            _compare(keys, labels, alo[small], ahi[small], blo[small], bhi[small], budget)
            alo, ahi, blo, bhi, diff, same = (x[~small] for x in (alo, ahi, blo, bhi, diff, same))
        if not len(alo):
            continue
        if len(alo) > width:
            half = len(alo) // 2
            stack += [(bit, *(x[part] for x in (alo, ahi, blo, bhi, diff, same))) for part in (slice(half), slice(half, None))]
            continue
        counts["descended"] = counts.get("descended", 0) + len(alo)
        ones = np.concatenate([[0], np.cumsum((keys >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        amid, bmid = ahi - (ones[ahi] - ones[alo]), bhi - (ones[bhi] - ones[blo])
        cross = ~same  # a node with itself has one mixed child pair, two nodes have two
        stack.append(
            (
                bit - 1,
                np.concatenate([alo, amid, alo, amid[cross]]),
                np.concatenate([amid, ahi, amid, ahi[cross]]),
                np.concatenate([blo, bmid, bmid, blo[cross]]),
                np.concatenate([bmid, bhi, bhi, bmid[cross]]),
                np.concatenate([diff, diff, diff + 1, diff[cross] + 1]),
                np.concatenate([same, same, np.zeros(len(same), bool), same[cross]]),
            )
        )
    return labels


def _compare(keys, labels, alo, ahi, blo, bhi, budget, chunk: int = 1 << 20) -> None:
    """Compare all members of small node pairs and union those within the budget."""
    sizes = (ahi - alo) * (bhi - blo)
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(chunk, sizes.sum() + chunk, chunk))
    for lo, hi in zip([0, *cuts + 1], [*cuts + 1, len(sizes)]):
        if lo >= len(sizes):
            break
        n, wide = sizes[lo:hi], (bhi - blo)[lo:hi]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        i = np.repeat(alo[lo:hi], n) + k // np.repeat(wide, n)
        j = np.repeat(blo[lo:hi], n) + k % np.repeat(wide, n)
        near = (i != j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
        if near.any():
            _merge(labels, i[near], j[near])


def _cell_links(budget: int, rows: int = 100_000):
    """mapInArrow function over (cell, side, fp) sorted by cell: links (u, v) of its cells."""

    def solve(cell: np.ndarray, side: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        keys = fp.view(np.uint64)
        order = np.lexsort((keys, side, cell))
        cell, side, keys = cell[order], side[order], keys[order]
        cuts = np.flatnonzero((np.diff(cell) != 0) | (np.diff(side) != 0)) + 1
        lo = np.concatenate([[0], cuts]).astype(np.int64)
        hi = np.concatenate([cuts, [len(keys)]]).astype(np.int64)
        split = _is_split(cell[lo])
        roots = [(a, b, a, b) for a, b in zip(lo[~split], hi[~split])]
        for k in range(len(lo) - 1):  # a split cell of two sides joins only across
            if split[k] and cell[lo[k]] == cell[lo[k + 1]]:
                roots.append((lo[k], hi[k], lo[k + 1], hi[k + 1]))
        labels = trie_links(keys, roots, budget)
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[linked].view(np.int64)), pa.array(keys[labels[linked]].view(np.int64))], names=["u", "v"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            held.append(part)
            count += len(part[0])
            if count >= rows:
                whole = tuple(np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(whole[0], whole[0][-1]))  # the last cell may go on
                if cut:
                    yield solve(*(x[:cut] for x in whole))
                held, count = [tuple(x[cut:] for x in whole)], len(whole[0]) - cut
        if count:
            yield solve(*(np.concatenate(x) for x in zip(*held)))

    return run


# a cell id packs (block, value) above two sub-cell numbers of 20 bits each
_SUB = 20


def _is_split(cell: np.ndarray) -> np.ndarray:
    mask = (1 << _SUB) - 1
    return ((cell >> _SUB) & mask) != (cell & mask)


def route_bits(n: int, cell_rows: int) -> int:
    """Bits of a block that leave ``n`` fingerprints in cells of at most about ``cell_rows``."""
    return min(ROUTE_BITS, max(0, (max(n, 1) - 1) // cell_rows).bit_length())


def fingerprint_links(prints: DataFrame, max_bits: int = 4, cell_rows: int = CELL_ROWS, cell_factor: int = 4) -> DataFrame:
    """Links (u, v) that connect exactly the fingerprints (column fp, distinct) within ``max_bits``.

    A cell of more than max(``cell_rows``, ``cell_factor`` times the mean) rows is split
    by a hash of the fingerprint into s parts, joined as s (s + 1) / 2 sub-cells.
    """
    blocks = max_bits + 1
    if not 0 <= max_bits < BITS:
        raise ValueError("max_bits must be from 0 to 63")
    bits = route_bits(prints.count(), cell_rows)
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    # without routing bits, the cells of all blocks would be the same
    used = list(enumerate(zip(edges, edges[1:])))[: blocks if bits else 1]
    route = F.array(
        *(
            F.struct(
                (F.lit(k << ROUTE_BITS) + F.shiftrightunsigned("fp", lo).bitwiseAND((1 << min(hi - lo, bits)) - 1)).alias("key")
            )
            for k, (lo, hi) in used
        )
    )
    dealt = prints.select("fp", F.explode(route).alias("r")).select("fp", F.col("r.key").alias("key"))
    # at most blocks * 2**ROUTE_BITS rows, whatever the input
    sizes = materialize(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    mean = sizes.agg(F.avg("n")).first()[0] or 0.0
    most = max(cell_rows, int(cell_factor * mean))
    parts = F.ceil(F.col("n") / most).cast("int")
    dealt = dealt.join(F.broadcast(sizes.where(F.col("n") > most).select("key", parts.alias("s"))), "key", "left")
    dealt = dealt.select("fp", "key", F.coalesce("s", F.lit(1)).alias("s"))
    salt = F.pmod(F.hash("fp"), "s")
    cells = dealt.select("fp", "key", salt.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("other"))
    shift = F.lit(1 << _SUB)
    cells = cells.select(
        (
            F.col("key").cast("long") * shift * shift
            + F.least("mine", "other").cast("long") * shift
            + F.greatest("mine", "other").cast("long")
        ).alias("cell"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"),
        "fp",
    )
    sorted_cells = cells.repartition("cell").sortWithinPartitions("cell")
    return sorted_cells.mapInArrow(_cell_links(max_bits), "u long, v long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    max_bits: int = 4,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """One row per document: id, text_hash, ``fp``, ``root`` and ``component_id``, the smallest id reachable."""
    prints = staged(fingerprints(docs, id_col, text_col, shingle))
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("first")))
    nodes = materialize(star_components(fingerprint_links(distinct, max_bits, cell_rows)))
    rooted = materialize(
        distinct.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        )
    )
    lowest = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    named = materialize(rooted.join(lowest, "root").select("fp", "root", "component_id"))
    return prints.join(named, "fp").select(F.col("id").alias(id_col), "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs``, one of each near-duplicate group: a row with the group's smallest id.

    Rows that share that id are told apart by the hash of their text; equal rows count once.
    """
    groups = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    lowest = F.min(F.struct(F.col(id_col).isNull().alias("null"), F.col(id_col).alias("id"), "text_hash"))
    kept = groups.groupBy("root").agg(lowest.alias("k")).select("k.id", "k.text_hash")
    mark = unique_name("h")
    marked = docs.withColumn(mark, F.xxhash64(text_col))
    chosen = marked.join(kept, marked[id_col].eqNullSafe(kept["id"]) & (marked[mark] == kept["text_hash"]), "left_semi")
    return chosen.dropDuplicates([id_col, mark]).select(*docs.columns)
