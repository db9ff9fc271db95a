"""Source divergence audit by hash-consed segment trees over term ids.

Every language keeps the terms that at least ``least_docs`` of its documents hold. A
(language, source) group gives each kept term the smoothed share
``p = 1 + floor(UNIT * (count + 2) / (N + 2 * V))``, N being its count over kept terms and V
the number of kept terms; so does the language as a whole. Two shares p and q are priced
``floor((p - q)^2 / (p + q))``. The audit gives, per group, its price against every other
source of the language, summed over all kept terms, and the terms it uses more than its
language that have the highest price.

1. Counts per (language, source, term) are combined in every task, then by Spark; from them
   the kept terms of each language, numbered by falling frequency and dealt to blocks of
   consecutive numbers.
2. Per language, block and pair of source tiles, one task builds a segment tree of counts
   for every source at once: level by level, nodes with equal children become one node, so
   equal count subtrees are shared between sources and places (rare terms make many).
3. All pairs of sources are traversed together from the roots: a state is two nodes with
   the totals of their sources; equal states are kept once per level, a state whose two
   sides are equal costs nothing and is not descended, and prices return upwards.
4. Spark adds the prices of the blocks. All arithmetic is in exact integers.

Terms are runs of ASCII letters and all characters beyond ASCII, A-Z lower-cased.

Defined cases: null text, language and source count as empty texts; empty texts and very
long ones are counted whole; repeated rows are documents of their own; a group without
terms still has pairs, and a language without kept terms gives the value 0 to every pair; a
language with one source has no pairs; an empty table gives an empty result; columns other
than text, language and source are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import BLOCK, pick, ship, staged
from strata.operators.bounded import broadcast_if_bounded

UNIT = 1_000_000_000
LEAST_DOCS = 10
BLOCK_TERMS = 1 << 12
TILE = 64  # sources of a language that meet another such tile in one task
HELD = 400_000  # distinct counts that a task holds before it passes them on
STATES = 1 << 20  # leaf states of the pairs that are traversed together
_KEEP = {*range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20 for b in range(256))


def term_blocks(text: bytes | None, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The terms of a whole text, as lists from about ``size`` bytes each."""
    folded = (text or b"").translate(_FOLD)
    start, end = 0, len(folded)
    while start < end:
        stop = end
        if end - start > size:
            found = folded.find(b" ", start + size)
            stop = found if found >= 0 else end
        yield folded[start:stop].split()
        start = stop


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs), written: occurrences and documents; an empty term stands for the group itself."""
    ship(docs.sparkSession)
    rows = pick(docs, lang_col, source_col, text_col).select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.col(text_col).cast("binary").alias("t"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (total, holding) in held.items():
                n = len(total) + 1
                columns = [
                    pa.array([lang] * n), pa.array([source] * n), pa.array([b"", *total], pa.binary()).cast(pa.string()),
                    pa.array([0, *total.values()], pa.int64()), pa.array([0, *(holding[t] for t in total)], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
            held.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                total, holding = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(total)
                seen: set[bytes] = set()
                for terms in term_blocks(text.as_py()):
                    total.update(terms)
                    seen.update(terms)
                holding.update(seen)
                size += len(total)
                if size > HELD:
                    yield from passed_on()
                    size = 0
        yield from passed_on()

    counted = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return staged(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def kept_terms(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, lang_n, number), written: the terms of enough documents, numbered by falling frequency inside a language."""
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    ordered = kept.where(F.col("docs") >= least_docs).repartitionByRange("lang", F.desc("lang_n"), "term")
    ordered = ordered.sortWithinPartitions("lang", F.desc("lang_n"), "term")
    return staged(ordered.select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("number")))


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """Smoothed shares of the counts, in units; exact."""
    return (1 + UNIT * (counts.astype(object) + 2) // (total + 2 * terms)).astype(np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)  # shares are at most UNIT + 1, so squares fit int64


class Forest:
    """Segment trees of several count vectors of one length, with equal subtrees shared.

    ``roots`` has a node per vector; ``levels`` lists, from the roots down, the left and
    right children of that level's nodes; ``leaves`` the counts of the leaf nodes, -1 for
    the padding up to a power of two.
    """

    def __init__(self, counts: np.ndarray) -> None:
        groups, terms = counts.shape
        width = 1 << max(0, (terms - 1).bit_length())
        padded = np.full((groups, width), -1, np.int64)
        padded[:, :terms] = counts
        self.leaves, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(groups, width).astype(np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        most = len(self.leaves)
        while nodes.shape[1] > 1:
            both, parents = np.unique(nodes[:, ::2] * most + nodes[:, 1::2], return_inverse=True)
            self.levels.insert(0, (both // most, both % most))
            nodes, most = parents.reshape(groups, -1).astype(np.int64), len(both)
        self.roots = nodes[:, 0]

    def prices(self, left: np.ndarray, right: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
        """Summed price of each pair of vectors (left[k], right[k]); ``totals`` is N of every vector.

        A side of a state is node * classes + class, the class being the vector's total:
        equal sides have equal shares everywhere below.
        """
        known, classes = np.unique(totals, return_inverse=True)
        k = len(known)
        a, b = self.roots[left] * k + classes[left], self.roots[right] * k + classes[right]
        back: list[tuple[int, np.ndarray, np.ndarray]] = []
        a, b, inverse = _once(a, b)
        first = inverse
        for level_left, level_right in self.levels:
            apart = np.flatnonzero(a != b)
            (na, ca), (nb, cb) = divmod(a[apart], k), divmod(b[apart], k)
            size = len(a)
            a = np.concatenate([level_left[na] * k + ca, level_right[na] * k + ca])
            b = np.concatenate([level_left[nb] * k + cb, level_right[nb] * k + cb])
            a, b, inverse = _once(a, b)
            back.append((size, apart, inverse))
        value = self._leaf_prices(a, b, known, terms)
        for size, apart, inverse in reversed(back):
            above = np.zeros(size, np.int64)
            above[apart] = value[inverse[: len(apart)]] + value[inverse[len(apart) :]]
            value = above
        return value[first]

    def _leaf_prices(self, a: np.ndarray, b: np.ndarray, known: np.ndarray, terms: int) -> np.ndarray:
        k = len(known)
        sides, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
        counts, classes = self.leaves[sides // k], sides % k
        share = np.ones(len(sides), np.int64)
        for c in np.unique(classes):
            here = (classes == c) & (counts >= 0)
            share[here] = shares(counts[here], int(known[c]), terms)
        p, q = share[inverse[: len(a)]], share[inverse[len(a) :]]
        return np.where((self.leaves[a // k] >= 0) & (a != b), price(p, q), 0)


def _once(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct unordered pairs of sides, and where each given pair went."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    span = int(high.max(initial=0)) + 1
    both, inverse = np.unique(low * span + high, return_inverse=True)
    return both // span, both % span, inverse


def audit_block(
    sources: list[str], totals: np.ndarray, sides: tuple[np.ndarray, np.ndarray], counts: np.ndarray, terms: int, states: int = STATES
) -> Iterator[tuple[str, str, int]]:
    """(source, other, price over this block) of all pairs between two lists of sources."""
    left, right = (x.ravel() for x in np.meshgrid(*sides, indexing="ij"))
    wanted = left < right if sides[0] is sides[1] else left != right
    left, right = left[wanted], right[wanted]
    forest = Forest(counts)
    step = max(1, states // counts.shape[1])
    for at in range(0, len(left), step):
        a, b = left[at : at + step], right[at : at + step]
        for x, y, value in zip(a.tolist(), b.tolist(), forest.prices(a, b, totals, terms).tolist()):
            yield sources[x], sources[y], value


def top_terms(
    terms: np.ndarray, counts: np.ndarray, total: int, lang_counts: np.ndarray, lang_total: int, kept: int, most: int
) -> list[tuple[str, int]]:
    """The ``most`` highest priced terms that a source uses more than its language, ties to the smaller term."""
    used = np.flatnonzero(counts > 0)
    p, q = shares(counts[used], total, kept), shares(lang_counts[used], lang_total, kept)
    used, value = used[p > q], price(p, q)[p > q]
    found = sorted(zip((-value).tolist(), (terms[k].encode() for k in used)))[:most]
    return [(term.decode(), -v) for v, term in found]


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = LEAST_DOCS,
    most_terms: int = 10,
    block_terms: int = BLOCK_TERMS,
    tile: int = TILE,
) -> DataFrame:
    """lang, source, part, item, value, rank: every other source (part ``pair``), and the ``most_terms`` first terms (part ``term``)."""
    counts = term_counts(docs, text_col, lang_col, source_col)
    kept = kept_terms(counts, least_docs)
    block = F.floor(F.col("number") / block_terms).alias("block")
    used = counts.where("term <> ''").join(kept, ["lang", "term"])
    used = staged(used.select("lang", "source", "term", "n", "lang_n", "number", block))

    by_lang = Window.partitionBy("lang")  # over groups: one row per language and source
    groups = (
        counts.where("term = ''").select("lang", "source")
        .join(used.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total")), "lang", "left")
        .fillna(0, ["total", "kept", "lang_total"])
        .withColumn("tile", F.floor((F.row_number().over(by_lang.orderBy("source")) - 1) / tile))
        .withColumn("tiles", F.max("tile").over(by_lang) + 1)
    )
    groups = staged(groups)
    looked_up, _ = broadcast_if_bounded(groups)

    # a source meets every tile of its language in one task, the smaller tile first
    met = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1),
        lambda t: F.struct(F.least(t, F.col("tile")).alias("a"), F.greatest(t, F.col("tile")).alias("b")),
    )
    blocks = kept.groupBy("lang", block).agg(F.count("*").alias("width"))
    head = blocks.join(looked_up, "lang").withColumn("cell", F.explode(met))
    head = head.select("lang", "block", "cell.a", "cell.b", "source", "total", "kept", "lang_total", "tile", "width")
    rows = used.join(looked_up, ["lang", "source"]).withColumn("cell", F.explode(met))
    rows = rows.select("lang", "block", "cell.a", "cell.b", "source", "number", "term", "lang_n", "n")

    def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        lang, _, a, b = (k.as_py() for k in key)
        out: list[tuple] = []
        if right.num_rows:
            sources = right.column("source").to_pylist()
            totals, tile_of = right.column("total").to_numpy(), right.column("tile").to_numpy()
            kept_n, lang_total, width = (right.column(c)[0].as_py() for c in ("kept", "lang_total", "width"))
            _, first, at = np.unique(left.column("number").to_numpy(), return_index=True, return_inverse=True)
            terms = np.array(left.column("term").take(pa.array(first)).to_pylist(), object)
            lang_counts = left.column("lang_n").to_numpy()[first]
            place = {source: k for k, source in enumerate(sources)}
            held = np.array([place[s] for s in left.column("source").to_pylist()], np.int64)
            # terms of the block that none of these sources has stay columns of zeros
            table = np.zeros((len(sources), width), np.int64)
            table[held, at] = left.column("n").to_numpy()
            in_a, in_b = np.flatnonzero(tile_of == a), np.flatnonzero(tile_of == b)
            for source, other, value in audit_block(sources, totals, (in_a, in_a if a == b else in_b), table, kept_n):
                out += [(lang, source, "pair", other, value), (lang, other, "pair", source, value)]
            for k in in_a if a == b else ():
                best = top_terms(terms, table[k, : len(terms)], int(totals[k]), lang_counts, lang_total, kept_n, most_terms)
                out += [(lang, sources[k], "term", term, value) for term, value in best]
        columns = list(zip(*out)) or [()] * 5
        kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("lang", "source", "part", "item", "value"), columns, kinds)})

    cell = ("lang", "block", "a", "b")
    priced = rows.groupBy(*cell).cogroup(head.groupBy(*cell))
    priced = staged(priced.applyInArrow(meet, "lang string, source string, part string, item string, value long"))

    summed = priced.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    # languages without kept terms have no blocks: their pairs are worth 0
    bare = groups.where("kept = 0").select("lang", "source")
    bare = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    bare = bare.select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    ranked = summed.unionByName(bare).unionByName(priced.where("part = 'term'"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = ranked.withColumn("rank", F.row_number().over(best))
    return ranked.where(f"part = 'pair' or rank <= {most_terms}").select("lang", "source", "part", "item", "value", "rank")


def audit_sql(least_docs: int = LEAST_DOCS, most_terms: int = 10) -> str:
    """DuckDB SQL for ``op13``: every group with every kept term."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    terms = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
        with d as (
            select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, {terms} as terms from documents
        ),
        w as (select r, lang, source, unnest(terms) as term from d),
        kept as (select lang, term, count(*) as lang_n from w group by lang, term having count(distinct r) >= {least_docs}),
        c as (select w.lang, w.source, w.term, count(*) as n from w join kept using (lang, term) group by all),
        totals as (select lang, source, sum(n) as total from c group by all),
        size as (select lang, count(*) as v, sum(lang_n) as total from kept group by lang),
        g as (
            select distinct d.lang, d.source, coalesce(totals.total, 0) as total, coalesce(v, 0) as v, coalesce(size.total, 0) as lang_total
            from d left join totals on d.lang = totals.lang and d.source = totals.source left join size on d.lang = size.lang
        ),
        p as (
            select g.lang, g.source, kept.term, coalesce(c.n, 0) as n,
                   1 + cast(1000000000 as bigint) * (coalesce(c.n, 0) + 2) // cast(g.total + 2 * g.v as bigint) as p,
                   1 + cast(1000000000 as bigint) * (lang_n + 2) // cast(lang_total + 2 * g.v as bigint) as lang_p
            from g join kept on g.lang = kept.lang
            left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term
        ),
        priced as (
            select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
            from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
        ),
        pairs as (
            select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value
            from g a join g b on a.lang = b.lang and a.source <> b.source
            left join priced on priced.lang = a.lang and priced.source = a.source and priced.item = b.source
        ),
        terms as (
            select lang, source, 'term' as part, term as item, cast((p - lang_p) * (p - lang_p) // (p + lang_p) as bigint) as value
            from p where n > 0 and p > lang_p
        ),
        ranked as (
            select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
            from (select * from pairs union all select * from terms)
        )
        select * from ranked where part = 'pair' or rank <= {most_terms}"""
