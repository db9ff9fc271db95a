"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a share of the mix by its weight, but never more than ``most`` times its
own words; the excess is shared again by weight until no source is above. Training time
runs from 0 to 1. A source's weight follows a piecewise-linear schedule; its integral,
scaled to the source's target, is its cumulative word demand. The source's documents
stand in a seeded order, pass after pass, and a document that starts at word c of that
stream is trained at the time when the cumulative demand reaches c. The mix is range-
sorted by that position.

Prefix sums along a source are taken in two steps: within hash buckets of the order, and
over the buckets' sums. So a source with a third of all rows is spread over all buckets,
and no window ever holds a whole source.

Defined cases: null text counts as empty (size 0, nothing taken); a null source is a
source of its own, last in the order; rows with null or equal ids are ordinary rows and
spread by their texts, rows with equal ids and texts take interchangeable places (and one
bucket); a mix without any words has targets 0; very long
texts are only counted; columns other than id, text, source and the carried ones are not
looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import pick, staged, unique_name

Knots = tuple[tuple[float, float], ...]


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[float, ...] = (5, 2, 1)  # of the sources in code-point order, repeating
    # weight over training time, one schedule per weight: fading, steady, rising
    schedules: tuple[Knots, ...] = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.6, 0.5), (1.0, 2.0)))
    share: float = 1.5  # words of the mix, as a multiple of all words
    most: int = 2  # passes over a source at most
    seed: str = "mix-1"
    bucket_rows: int = 4096


def integrals(knots: Knots) -> list[float]:
    """Integral of a piecewise-linear schedule up to each knot."""
    out = [0.0]
    for (t0, a), (t1, b) in zip(knots, knots[1:]):
        out.append(out[-1] + (a + b) / 2 * (t1 - t0))
    return out


def invert(knots: Knots, share: Column) -> Column:
    """The time at which the schedule's integral reaches ``share`` (0 to 1) of its whole."""
    area = integrals(knots)
    need = share * F.lit(area[-1])
    times = None
    for (t0, a), (t1, b), done, until in zip(knots, knots[1:], area, area[1:]):
        rest = need - F.lit(done)
        slope = (b - a) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * slope) * rest, F.lit(0.0)))
        time = F.lit(t0) + F.lit(2.0) * rest / F.nullif(F.lit(a) + root, F.lit(0.0))
        time = F.coalesce(time, F.lit(t0))
        times = F.when(need <= F.lit(until), time) if times is None else times.when(need <= F.lit(until), time)
    return F.least(times.otherwise(F.lit(knots[-1][0])), F.lit(knots[-1][0]))


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def number_rows(df: DataFrame, *order: Column | str, start: int = 0, name: str = "number") -> DataFrame:
    """Rows of a range-sorted ``df`` numbered from ``start``; the driver only sees a count per partition."""
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    mark = unique_name("at")
    placed = staged(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(mark, F.monotonically_increasing_id())
    )
    part = F.shiftright(mark, 33)
    counts = placed.groupBy(part.alias("p")).count().orderBy("p").collect()  # one row per partition
    offsets, total = {}, start
    for row in counts:
        offsets[row["p"]] = total
        total += row["count"]
    if not offsets:
        return placed.withColumn(name, F.lit(0).cast("long")).drop(mark)
    offset = F.create_map(*(F.lit(x) for pair in offsets.items() for x in pair))[part]
    return placed.withColumn(name, offset + F.col(mark).bitwiseAND((1 << 33) - 1)).drop(mark)


def targets(sources: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """``sources`` (no_source, source, source_size) with kind (position of its weight) and target.

    Shares by weight are found round by round from three sums: what is above its limit
    is set to it, and the rest is shared again, until nothing is above.
    """
    kinds = len(config.weights)
    numbered = number_rows(sources, "no_source", "source").withColumn("kind", (F.col("number") % kinds).cast("int")).drop("number")
    weight = F.array(*(F.lit(float(w)) for w in config.weights))[F.col("kind")]
    numbered = staged(numbered.withColumn("weight", weight).withColumn("limit", F.col("source_size") * config.most))
    whole = numbered.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * float(config.share)
    level, full = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("limit") <= F.lit(level) * F.col("weight")
        n, limits, weights = numbered.agg(
            F.coalesce(F.sum(above.cast("long")), F.lit(0)),
            F.coalesce(F.sum(F.when(above, F.col("limit")).otherwise(0)), F.lit(0)),
            F.coalesce(F.sum(F.when(above, 0.0).otherwise(F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == full or weights == 0:
            break
        level, full = (whole - limits) / weights, n
    share = F.lit(0.0 if level is None else float(level)) * F.col("weight")
    return numbered.select(
        "no_source", "source", "source_size", "kind",
        F.when(F.col("limit") <= share, F.col("limit").cast("double")).otherwise(share).alias("target"),
    )


def order_key(seed: str, id_col: str, text_col: str) -> Column:
    """The place of a row in its source's order: by id and text, so rows that share an id, or have none, spread."""
    text = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text))


def bucket_of(order: str, buckets: int) -> Column:
    """The order's first 48 bits deal rows to ``buckets`` (a power of two) equal slices of it."""
    first_bits = F.conv(F.substring(order, 1, 12), 16, 10).cast("long")
    return F.shiftright(first_bits, 48 - (buckets.bit_length() - 1))


def plan(
    docs: DataFrame,
    config: MixConfig = MixConfig(),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per row: id, size, source_size, target, and the words and the position of each pass.

    ``passes`` is an array of structs (taken, position) for the passes that take words
    of the row. Columns named in ``carry`` come along as fields of the struct ``carried``;
    ``docs`` is then read twice and must be the same both times, as a table is.
    """
    names = dict.fromkeys([id_col, text_col, source_col, *carry])
    rows = pick(docs, *names)
    carried = F.struct(*(F.col(c).alias(c) for c in carry)) if carry else F.lit(None)
    rows = rows.select(
        F.col(id_col).alias("id"),
        word_count(text_col).alias("size"),
        F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        order_key(config.seed, id_col, text_col).alias("order"),
        carried.alias("carried"),
    )
    light = staged(rows.drop("carried"))
    n = light.count()
    buckets = 256
    while buckets * config.bucket_rows < n:
        buckets *= 2
    bucket = bucket_of("order", buckets)
    light = light.withColumn("bucket", bucket)
    # carried columns (whole texts) are read again from ``docs`` rather than written once more
    full = rows.withColumn("bucket", bucket) if carry else light
    place = ["no_source", "source", "bucket"]

    sums = staged(light.groupBy(*place).agg(F.sum("size").alias("words")))
    sources = staged(sums.groupBy("no_source", "source").agg(F.sum("words").alias("source_size")))
    aimed = targets(sources, config)
    along = Window.partitionBy("no_source", "source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("bucket_start", F.coalesce(F.sum("words").over(along), F.lit(0))).drop("words")
    starts = starts.join(aimed, ["no_source", "source"])

    # equal ids with equal texts may differ in what they carry; what is left are equal rows
    ties = [F.xxhash64("carried")] if carry else []
    inside = Window.partitionBy(*place).orderBy("order", "size", *ties).rowsBetween(Window.unboundedPreceding, -1)
    placed = full.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, place)
    start = F.col("bucket_start") + F.col("before")
    words = F.floor(F.col("target") + 0.5).cast("long")
    passes = []
    for k in range(config.most):
        begin = start + F.lit(k) * F.col("source_size")
        taken = F.greatest(F.least(words - begin, F.col("size")), F.lit(0).cast("long"))
        share = begin.cast("double") / words.cast("double")
        position = None
        for kind in range(len(config.weights)):
            time = invert(config.schedules[kind % len(config.schedules)], share)
            position = F.when(F.col("kind") == kind, time) if position is None else position.when(F.col("kind") == kind, time)
        passes.append(F.when(taken > 0, F.struct(taken.alias("taken"), position.alias("position"))))
    taken_passes = F.filter(F.array(*passes), lambda p: p.isNotNull())
    return placed.select(
        F.col("id").alias(id_col), "size", "source_size", "target", taken_passes.alias("passes"),
        "order", *(["carried"] if carry else []),
    )


def mix(docs: DataFrame, config: MixConfig = MixConfig(), **columns: str) -> DataFrame:
    """Per row: id, size, source_size, target, taken (words of all its passes) and position (of its first pass).

    The rows are range-sorted by position, as training first meets them; those that give nothing come last.
    """
    planned = plan(docs, config, **columns)
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda total, p: total + p["taken"])
    rows = staged(planned.withColumn("taken", taken).withColumn("position", F.get("passes", F.lit(0))["position"]).drop("passes"))
    # the order splits the rows that have no position, which may be most
    return in_order(rows, [F.col("position").asc_nulls_last(), "order"]).drop("order")


def in_order(rows: DataFrame, places: Sequence[Column | str], ties: Sequence[str] = ()) -> DataFrame:
    """``rows`` range-sorted by ``places``, equal ones inside a partition by ``ties``."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartitionByRange(parts, *places).sortWithinPartitions(*places, *ties)


def mixed_rows(
    docs: DataFrame,
    config: MixConfig = MixConfig(),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    length_col: str | None = None,
) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, once per pass, range-sorted by position.

    The last document that a source gives may be cut at a word: its text is then its
    first words, joined with spaces (and ``length_col`` its length).
    """
    columns = docs.columns
    planned = plan(docs, config, id_col, text_col, source_col, carry=columns)
    copies = planned.select("size", F.explode("passes").alias("p"), "order", "carried")
    text = F.col("carried").getField(text_col)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    cut = F.col("p.taken") < F.col("size")
    new_text = F.when(cut, F.array_join(F.slice(words, 1, F.col("p.taken").cast("int")), " ")).otherwise(text)
    out = copies.select(
        *(new_text.alias(c) if c == text_col else F.col("carried").getField(c).alias(c) for c in columns),
        F.col("p.position").alias("_position"),
        F.col("order").alias("_order"),
        cut.alias("_cut"),
    )
    if length_col:
        length = F.when(F.col("_cut"), F.length(text_col).cast(dict(docs.dtypes)[length_col])).otherwise(F.col(length_col))
        out = out.withColumn(length_col, length)
    return in_order(out, ["_position"], [id_col, "_order"]).select(*columns)


def mix_sql(config: MixConfig = MixConfig(), documents: str = "documents") -> str:
    """The rule of :func:`mix` as one SQL statement for DuckDB, with plain windows per source."""
    weight = " ".join(f"when {k} then cast({w} as double)" for k, w in enumerate(config.weights))

    def time(kind: int, share: str) -> str:
        knots = config.schedules[kind % len(config.schedules)]
        area = integrals(knots)
        need = f"({share}) * {area[-1]!r}::double"
        parts = []
        for (t0, a), (t1, b), done, until in zip(knots, knots[1:], area, area[1:]):
            rest, slope = f"({need} - {done!r}::double)", (b - a) / (t1 - t0)
            root = f"sqrt(greatest({a * a!r}::double + {2 * slope!r}::double * {rest}, 0.0::double))"
            parts.append(f"when {need} <= {until!r}::double then {t0!r}::double + 2.0::double * {rest} / ({a!r}::double + {root})")
        return f"least(case {' '.join(parts)} else {knots[-1][0]!r}::double end, {knots[-1][0]!r}::double)"

    def position(start: str) -> str:
        share = f"cast({start} as double) / cast(words as double)"
        return "case kind " + " ".join(f"when {k} then {time(k, share)}" for k in range(len(config.weights))) + " end"

    taken = [f"greatest(least(words - (start + {k} * source_size), size), 0)" for k in range(config.most)]
    return f"""
with docs as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
         md5('{config.seed}:' || coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as ord
  from {documents}),
sources as (
  select source, cast(sum(size) as bigint) as source_size from docs group by source),
kinds as (
  select *, (row_number() over (order by source nulls last) - 1) % {len(config.weights)} as kind from sources),
weighted as (
  select *, case kind {weight} end as weight, source_size * {config.most} as lim,
         (select sum(source_size) from sources) * {float(config.share)!r}::double as whole from kinds),
levels as (
  select *, (whole - coalesce(cast(sum(lim) over below as bigint), 0)) / sum(weight) over above as level
  from weighted
  window below as (order by lim / weight, source rows between unbounded preceding and 1 preceding),
         above as (order by lim / weight, source rows between current row and unbounded following)),
lev as (
  select coalesce(arg_min(level, lim / weight) filter (where lim > level * weight), 0) as level from levels),
aimed as (
  select source, source_size, kind,
         case when lim <= lev.level * weight then cast(lim as double) else lev.level * weight end as target
  from weighted, lev),
placed as (
  select doc_id, size, source_size, kind, target, cast(floor(target + 0.5) as bigint) as words,
         coalesce(cast(sum(size) over (partition by d.source order by ord, size rows between unbounded preceding and 1 preceding) as bigint), 0) as start
  from docs d join aimed a on d.source is not distinct from a.source),
taken as (
  select *, {taken[0]} as t0, {' + '.join(taken)} as taken from placed)
select doc_id, cast(size as bigint) as size, source_size, target, cast(taken as bigint) as taken,
       case when t0 > 0 then {position('start')} end as position
from taken"""
