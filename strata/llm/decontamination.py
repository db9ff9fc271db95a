"""Benchmark decontamination by a positional inverted index of the training texts.

1. Index (``build_index``): every task turns its documents into blocks of about
   ``BLOCK_WORDS`` words and writes, per block, the postings of **every** token: the terms,
   how often each occurs, and their positions, term by term. Documents are never shuffled;
   the table is written to the shared folder and serves any number of test sets.
2. Test phrases: each item gives its windows of ``window`` words (a shorter item is one
   window); equal windows count once and know their items. They reach the tasks in blocks
   of a bounded size, each block meeting the whole index.
3. Search (``search``): per block, windows with a term that does not occur go at once. Of
   the others, the postings of the rarest term, shifted back by its offset, are the
   possible starts; the shifted lists of the other terms, rarest first, are intersected
   with them. All windows take each step together.

With ``slop`` s the search also finds proximity matches: places b such that every word k of
the window occurs within s words of b + k, in the same document; 0 means the exact phrase.

Words are runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased.

Defined cases: null and empty texts have no words, hits or items; documents with a null id
and repeated rows keep a row each; items without words have no windows; equal item ids
count once, a null one counts as the empty text; very long texts are one block of their own
and are searched whole; an empty table gives an empty result, an empty test set no hits;
columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import BLOCK, pick, ship, staged
from strata.session import scratch_path

WINDOW = 10
BLOCK_WORDS = 1 << 18
ROW_GROUP = 32 << 20  # bytes of a Parquet row group of the index, so a reader holds few blocks
TEST_BYTES = 64 << 20  # test windows that meet the index at a time
SEEDS = 1 << 20  # possible starts that are held at a time
_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20 for b in range(256))


def term_blocks(text: bytes | None, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a whole text, as lists from about ``size`` bytes each."""
    folded = (text or b"").translate(_FOLD)
    start, end = 0, len(folded)
    while start < end:
        stop = end
        if end - start > size:
            found = folded.find(b" ", start + size)
            stop = found if found >= 0 else end
        yield folded[start:stop].split()
        start = stop


class _Block:
    """Documents whose postings become one row of the index."""

    def __init__(self) -> None:
        self.ids: list = []
        self.lengths: list[int] = []
        self.words = 0
        self._codes: list[np.ndarray] = []
        self._terms: defaultdict[bytes, int] = defaultdict(count().__next__)

    def add(self, doc_id, text: bytes | None) -> None:
        before = self.words
        code = self._terms.__getitem__
        for words in term_blocks(text):
            self._codes.append(np.fromiter(map(code, words), np.int32, len(words)))
            self.words += len(words)
        self.ids.append(doc_id)
        self.lengths.append(self.words - before)

    def row(self) -> tuple:
        codes = np.concatenate(self._codes) if self._codes else np.zeros(0, np.int32)
        positions = np.argsort(codes, kind="stable")
        gaps = np.diff(positions, prepend=0).astype("<i4")  # small numbers, so they compress
        counts = np.bincount(codes, minlength=len(self._terms)).astype("<i4")
        return self.ids, self.lengths, b" ".join(self._terms), counts.tobytes(), gaps.tobytes()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The written index: per block of documents their ids and word numbers, and the postings of all terms."""
    spark = docs.sparkSession
    ship(spark)
    rows = pick(docs, id_col, text_col).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    schema = T.StructType(
        [
            T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)), T.StructField("lengths", T.ArrayType(T.IntegerType())),
            T.StructField("terms", T.BinaryType()), T.StructField("counts", T.BinaryType()), T.StructField("gaps", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, id_type = _Block(), None

        def flushed() -> pa.RecordBatch:
            ids, lengths, *rest = block.row()
            kinds = (pa.list_(id_type), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((ids, lengths, *rest), kinds)], names=schema.names)

        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc_id, text.as_py())
                if block.words >= block_words:
                    yield flushed()
                    block = _Block()
        if block.ids:
            yield flushed()

    path = scratch_path(spark, "llm", "index")
    index = rows.mapInArrow(run, schema).select(F.monotonically_increasing_id().alias("part"), "*")
    index.write.option("parquet.block.size", str(ROW_GROUP)).option("compression", "zstd").parquet(path)
    return spark.read.schema(index.schema).parquet(path)


@dataclass(frozen=True)
class Windows:
    """Distinct test windows: term numbers (short ones padded with ``len(terms)``), lengths, and their items."""

    terms: dict[bytes, int]
    words: np.ndarray
    lengths: np.ndarray
    first: np.ndarray  # window w has the items owners[first[w]:first[w + 1]]
    owners: np.ndarray
    items: list[str]  # sorted


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(window, item): the distinct windows of every item, words joined by spaces; written."""
    ship(items.sparkSession)
    rows = pick(items, id_col, text_col).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("binary").alias("t")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tail: list[bytes] = []
                full = False
                for words in term_blocks(text.as_py()):
                    words = tail + words
                    n = len(words) - window + 1
                    if n > 0:
                        full = True
                        found = {b" ".join(words[k : k + window]) for k in range(n)}
                        yield _pairs(found, item)
                    tail = words[max(0, n) :]
                if not full and tail:
                    yield _pairs({b" ".join(tail)}, item)

    def _pairs(found: set[bytes], item: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array([item] * len(found))], names=["window", "item"])

    return staged(rows.mapInArrow(run, "window binary, item string").distinct())


def _test_blocks(pairs: DataFrame, most: int) -> Iterator[Windows]:
    """The test windows in blocks of about ``most`` bytes; at least one block, which may be empty."""
    size = pairs.agg(F.sum(F.octet_length("window") + F.octet_length("item") + 64)).first()[0] or 0
    blocks = max(1, -(-int(size) // most))
    for k in range(blocks):
        # by window and item, so a window that many items share is spread, too
        found = pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == k).toArrow()
        yield _windows(found.column("window").to_pylist(), found.column("item").to_pylist())


def _windows(texts: list[bytes], owners: list[str]) -> Windows:
    items = sorted(set(owners))
    number = {item: k for k, item in enumerate(items)}
    held: dict[bytes, list[int]] = {}
    for text, item in zip(texts, owners):
        held.setdefault(text, []).append(number[item])
    split = [text.split(b" ") for text in held]
    terms: defaultdict[bytes, int] = defaultdict(count().__next__)
    coded = [[terms[w] for w in words] for words in split]
    lengths = np.array([len(c) for c in coded], np.int64)
    table = np.full((len(coded), max(lengths, default=1)), len(terms), np.int64)
    for k, c in enumerate(coded):
        table[k, : len(c)] = c
    first = np.cumsum([0, *(len(v) for v in held.values())])
    flat = np.fromiter((i for v in held.values() for i in v), np.int64, first[-1])
    return Windows(dict(terms), table, lengths, first, flat, items)


@dataclass(frozen=True)
class Postings:
    """Postings of the test terms in one block: sorted keys (term number * span + position), counts, document borders."""

    keys: np.ndarray
    first: np.ndarray  # term t has keys[first[t]:first[t] + counts[t]]
    counts: np.ndarray
    span: int
    borders: np.ndarray

    @classmethod
    def of(cls, windows: Windows, lengths: np.ndarray, terms: bytes, counts: bytes, gaps: bytes) -> "Postings":
        """Pick the postings of the test terms from a row of the index."""
        amount = np.frombuffer(counts, "<i4").astype(np.int64)
        positions = np.cumsum(np.frombuffer(gaps, "<i4"), dtype=np.int64)
        borders = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        span = int(borders[-1]) + 1
        known = windows.terms.get
        number = np.fromiter((known(t, -1) for t in terms.split(b" ")) if terms else (), np.int64)
        here = np.flatnonzero(number >= 0)
        here = here[np.argsort(number[here])]
        begin = np.cumsum(amount) - amount
        taken = np.repeat(begin[here] - (np.cumsum(amount[here]) - amount[here]), amount[here]) + np.arange(amount[here].sum())
        keys = np.repeat(number[here], amount[here]) * span + positions[taken]
        per_term = np.zeros(len(windows.terms) + 1, np.int64)
        per_term[number[here]] = amount[here]
        first = np.cumsum(per_term) - per_term
        per_term[-1] = np.iinfo(np.int64).max  # the padding of short windows is never the rarest
        return cls(keys, first, per_term, span, borders)

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.borders, positions, "right") - 1

    def within(self, terms: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each term has a posting from ``low`` to ``high``."""
        at = np.searchsorted(self.keys, terms * self.span + low)
        last = len(self.keys) - 1
        return (at <= last) & (self.keys[np.minimum(at, last)] <= terms * self.span + high)


def intersect(windows: Windows, postings: Postings, slop: int = 0, seeds: int = SEEDS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window, start, document) of all matches, in parts; a match may come more than once with ``slop``."""
    if not len(windows.words) or not len(postings.keys):
        return
    counts = postings.counts[windows.words]
    alive = np.flatnonzero((counts > 0).all(axis=1))
    if not len(alive):
        return
    by_rarity = np.argsort(counts[alive], axis=1, kind="stable")
    rarest = windows.words[alive, by_rarity[:, 0]]
    amount = postings.counts[rarest]
    part = (np.cumsum(amount) - amount) // seeds
    shifts = np.arange(-slop, slop + 1)
    for k in np.unique(part):
        chosen = np.flatnonzero(part == k)
        n = amount[chosen]
        row = np.repeat(chosen, n)
        at = np.repeat(postings.first[rarest[chosen]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        place = postings.keys[at] - rarest[row] * postings.span
        document = postings.document(place)
        start = place - by_rarity[row, 0]
        if slop:
            row, document = np.repeat(row, len(shifts)), np.repeat(document, len(shifts))
            start = (start[:, None] + shifts).ravel()
        low, high = postings.borders[document], postings.borders[document + 1] - 1
        length = windows.lengths[alive[row]]
        inside = (start + slop >= low) & (start + length - 1 - slop <= high)
        row, start, low, high, document = (x[inside] for x in (row, start, low, high, document))
        for step in range(1, windows.words.shape[1]):
            if not len(row):
                break
            offset = by_rarity[row, step]
            more = offset < windows.lengths[alive[row]]
            place = start + offset
            found = ~more
            found[more] = postings.within(
                windows.words[alive[row[more]], offset[more]],
                np.maximum(place[more] - slop, low[more]), np.minimum(place[more] + slop, high[more]),
            )
            row, start, low, high, document = (x[found] for x in (row, start, low, high, document))
        if len(row):
            yield alive[row], start, document


def _items_of(windows: Windows, window: np.ndarray, document: np.ndarray, docs: int) -> list[list[str]]:
    """Per document its items, each once, sorted as strings."""
    pairs = np.unique(document * len(windows.words) + window)
    document, window = pairs // len(windows.words), pairs % len(windows.words)
    n = windows.first[window + 1] - windows.first[window]
    at = np.repeat(windows.first[window] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    found = np.unique(np.repeat(document, n) * len(windows.items) + windows.owners[at])
    out: list[list[str]] = [[] for _ in range(docs)]
    for doc, item in zip((found // len(windows.items)).tolist(), (found % len(windows.items)).tolist()):
        out[doc].append(windows.items[item])
    return out


def _runs(borders: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of positions that the intervals [start, end) cover; runs never cross documents."""
    cover = np.zeros(int(borders[-1]) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, end, -1)
    hit = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
    first, last = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(hit[:-1] & ~hit[1:])
    cuts = np.unique(borders[1:-1])
    cuts = cuts[hit[:-1][cuts] & hit[1:][cuts]]
    return np.sort(np.concatenate([first, cuts])), np.sort(np.concatenate([last, cuts]))


def search_block(windows: Windows, lengths: list[int], terms: bytes, counts: bytes, gaps: bytes, slop: int) -> tuple[list, list, list]:
    """Per document of one row of the index: spans (start, end) of hit words, items, and near items (with ``slop``)."""
    docs = len(lengths)
    postings = Postings.of(windows, np.array(lengths, np.int64), terms, counts, gaps)
    spans: list[list[dict]] = [[] for _ in range(docs)]
    items = [[] for _ in range(docs)]
    found = [np.concatenate(x) for x in zip(*intersect(windows, postings))]
    if found:
        window, start, document = found
        items = _items_of(windows, window, document, docs)
        first, last = _runs(postings.borders, start, start + windows.lengths[window])
        document = postings.document(first)
        base = postings.borders[document]
        for doc, a, b in zip(document.tolist(), (first - base).tolist(), (last - base).tolist()):
            spans[doc].append({"start": a, "end": b})
    near = items
    if slop:
        found = [np.concatenate(x) for x in zip(*intersect(windows, postings, slop))]
        near = _items_of(windows, found[0], found[2], docs) if found else items
    return spans, items, near


def search(index: DataFrame, pairs: DataFrame, id_col: str = "doc_id", slop: int = 0, test_bytes: int = TEST_BYTES) -> DataFrame:
    """One row per document of the index: id, n_words, spans, items, near_items.

    ``spans`` are the maximal runs of words inside exact matches, as word numbers from 0
    (end exclusive); ``items`` the test items with an exact match, ``near_items`` those with
    a match within ``slop``; both sorted as strings. ``pairs`` comes from :func:`item_windows`.
    """
    spark = index.sparkSession
    ship(spark)
    id_type = index.schema["ids"].dataType.elementType
    span_type = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    strings = T.ArrayType(T.StringType())
    schema = T.StructType(
        [
            T.StructField("part", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField(id_col, id_type),
            T.StructField("n_words", T.LongType()), T.StructField("spans", span_type),
            T.StructField("items", strings), T.StructField("near_items", strings),
        ]
    )
    arrow_span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def found_in(windows: Windows) -> DataFrame:
        sent = spark.sparkContext.broadcast(windows)  # at most about test_bytes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    part, ids, lengths, terms, counts, gaps = (c[k] for c in batch.columns)
                    lengths = lengths.as_py()
                    spans, items, near = search_block(sent.value, lengths, terms.as_py(), counts.as_py(), gaps.as_py(), slop)
                    n = len(lengths)
                    columns = [
                        pa.array([part.as_py()] * n, pa.int64()), pa.array(range(n), pa.int32()), ids.values,
                        pa.array(lengths, pa.int64()), pa.array(spans, arrow_span),
                        pa.array(items, pa.list_(pa.string())), pa.array(near, pa.list_(pa.string())),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        return index.mapInArrow(run, schema)

    parts = [found_in(w) for w in _test_blocks(pairs, test_bytes)]
    if len(parts) == 1:
        return parts[0].drop("part", "at")
    every = parts[0]
    for other in parts[1:]:
        every = every.union(other)
    merged = every.groupBy("part", "at").agg(
        F.first(id_col).alias(id_col),
        F.max("n_words").alias("n_words"),
        merged_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
        *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("items", "near_items")),
    )
    return merged.drop("part", "at")


def merged_spans(spans):
    """Maximal runs of overlapping or touching spans of one document."""
    kind = "array<struct<start:int,end:int>>"

    def step(done, span):
        last = F.try_element_at(done, F.lit(-1))  # null at first
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(
            last["end"] >= span["start"], F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined)).cast(kind)
        ).otherwise(F.concat(done, F.array(span)).cast(kind))

    return F.aggregate(F.array_sort(spans), F.array().cast(kind), step)


def n_hit(spans: str = "spans"):
    """Words inside the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


def decontaminate_sql(window: int = WINDOW) -> str:
    """DuckDB SQL for ``op12``: grams of every occurring window length, joined on equality."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
        with d as (select row_number() over () as r, doc_id, {words} as w from documents),
        b as (select coalesce(cast(item_id as varchar), '') as item, {words} as w from benchmark),
        windows as (
            select distinct item, least(len(w), {window}) as n, array_to_string(w[i : i + {window} - 1], ' ') as gram
            from (select item, w, unnest(range(1, greatest(len(w) - {window} + 1, 1) + 1)) as i from b where len(w) > 0)
        ),
        grams as (
            select r, i, n, array_to_string(w[i : i + n - 1], ' ') as gram
            from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from windows) where len(w) >= n)
        ),
        found as (select distinct r, i, grams.n, item from grams join windows on grams.n = windows.n and grams.gram = windows.gram),
        hit as (
            select r, count(distinct p) as n_hit
            from (select r, unnest(range(i, i + n)) as p from (select distinct r, i, n from found)) group by r
        ),
        owned as (
            select r, count(*) as n_items, string_agg(item, ',' order by item) as items
            from (select distinct r, item from found) group by r
        )
        select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
               cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 as contaminated
        from d left join hit on d.r = hit.r left join owned on d.r = owned.r"""
