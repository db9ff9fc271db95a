"""Licence scan by ordered signature rules, in DataFrame functions only.

A text is normalised to its words with single spaces between. Signature families
(:mod:`strata.llm.license_rules`) whose keyword does not occur are skipped; the others'
patterns give intervals. Intervals are sorted by start, then longest, then priority, and
resolved in one pass: an interval contained in one that came before is suppressed, and
of two that overlap otherwise the one with the higher priority stays. All of it happens
inside the row, so nothing is shuffled.

Places of the base phrases are counted whatever the rules decide. Defined cases: null
text counts as empty (no words, no labels, score 0); rows with null or equal ids are
ordinary rows; the time grows with the length of the text; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import chunk_sums, pick, sum_before
from strata.llm.license_rules import BASE, signatures

_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_HIT = "struct<start:int,neg_end:int,priority:int,label:string,weight:double>"


def normalised(text: Column) -> Column:
    """A space, then every word with a space after it.

    ``lower`` also lowers letters beyond A-Z; that neither joins nor splits words, and no
    phrase holds a letter (k) that a non-ASCII one lowers to.
    """
    words = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), _GAP, " "))
    return F.when(words == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), F.lower(words), F.lit(" ")))


def _count_spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _families() -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(keyword).alias("keyword"),
                F.array(
                    *(
                        F.struct(
                            F.lit(f"(?<= ){s.pattern}(?= )").alias("pattern"),
                            F.lit(s.label).alias("label"),
                            F.lit(float(s.weight)).alias("weight"),
                            F.lit(s.priority).alias("priority"),
                        )
                        for s in rules
                    )
                ).alias("rules"),
            )
            for keyword, rules in signatures()
        )
    )


def _matches(text: Column, rule: Column) -> Column:
    found, pieces = F.regexp_extract_all(text, rule["pattern"], F.lit(0)), F.split(text, rule["pattern"], -1)
    return F.struct(rule.alias("rule"), found.alias("found"), pieces.alias("pieces"))


def _with_lengths(m: Column) -> Column:
    lengths = F.zip_with(m["found"], F.slice(m["pieces"], F.lit(1), F.size(m["found"])), lambda a, b: F.length(a) + F.length(b))
    return F.struct(m["rule"].alias("rule"), m["found"].alias("found"), m["pieces"].alias("pieces"), lengths.alias("lengths"))


def _hits(m: Column) -> Column:
    def hit(value: Column, i: Column) -> Column:
        start = sum_before(m["lengths"], m["sums"], i) + F.length(F.get(m["pieces"], i))
        return F.struct(
            start.alias("start"),
            (-start - F.length(value)).alias("neg_end"),
            m["rule"]["priority"].alias("priority"),
            m["rule"]["label"].alias("label"),
            m["rule"]["weight"].alias("weight"),
        )

    return F.transform(m["found"], hit)


def _resolve(hits: Column) -> Column:
    """The intervals that stay, from intervals sorted by (start, -end, priority)."""
    state = f"struct<kept:array<{_HIT}>,end:int,priority:int>"
    start = F.struct(F.array().cast(f"array<{_HIT}>").alias("kept"), F.lit(-1).alias("end"), F.lit(0).alias("priority")).cast(state)

    def step(acc: Column, h: Column) -> Column:
        end = -h["neg_end"]
        apart, contained = h["start"] >= acc["end"], end <= acc["end"]
        better = h["priority"] < acc["priority"]
        with_it = F.struct(F.concat(acc["kept"], F.array(h)).alias("kept"), end.alias("end"), h["priority"].alias("priority"))
        before = F.slice(acc["kept"], F.lit(1), F.greatest(F.size(acc["kept"]) - 1, F.lit(0)))
        instead = F.struct(F.concat(before, F.array(h)).alias("kept"), end.alias("end"), h["priority"].alias("priority"))
        return F.when(apart, with_it.cast(state)).when(~contained & better, instead.cast(state)).otherwise(acc)

    return F.aggregate(hits, start, step, lambda acc: acc["kept"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, detections, labels (sorted, distinct), score, and the base phrases' places.

    ``detections`` are structs (label, start, end, weight) with code-point offsets in the
    normalised text; ``score`` is the chance that at least one of them is right when each
    is with its weight.
    """
    rows = pick(docs, id_col, text_col).select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("text"))
    rows = rows.withColumn("n_words", F.greatest(_count_spaces(F.col("text")) - 1, F.lit(0)).cast("long"))
    text = F.col("text")

    for k, phrase in enumerate(BASE):
        has = F.contains(text, F.lit(f" {phrase} "))
        rows = rows.withColumn(f"_has{k}", has)
        n = F.regexp_count(text, F.lit(f"(?<= ){phrase}(?= )")).cast("long")
        first = _count_spaces(F.substring_index(text, f" {phrase} ", 1)).cast("long")
        after = _count_spaces(F.substring_index(text, f" {phrase} ", -1))
        last = (F.col("n_words") - after - len(phrase.split())).cast("long")
        for name, value in (("n", n), ("first", first), ("last", last)):
            rows = rows.withColumn(f"_{name}{k}", F.when(F.col(f"_has{k}"), value))

    rules = F.flatten(F.transform(F.filter(_families(), lambda f: F.contains(text, f["keyword"])), lambda f: f["rules"]))
    rows = rows.withColumn("_rules", rules)
    some = F.size("_rules") > 0
    found = F.filter(F.transform("_rules", lambda r: _matches(text, r)), lambda m: F.size(m["found"]) > 0)
    rows = rows.withColumn("_found", F.when(some, found))
    rows = rows.withColumn("_found", F.when(F.size("_found") > 0, F.transform("_found", _with_lengths)))
    rows = rows.withColumn("_found", F.transform("_found", lambda m: m.withField("sums", chunk_sums(m["lengths"]))))
    hits = F.array_sort(F.flatten(F.transform("_found", _hits)))
    rows = rows.withColumn("_hits", F.when(F.col("_found").isNotNull(), hits))
    rows = rows.withColumn("_kept", F.coalesce(_resolve(F.col("_hits")), F.array().cast(f"array<{_HIT}>")))

    base = F.filter(
        F.array(*(F.when(F.col(f"_has{k}"), F.lit(label)) for k, label in enumerate(BASE.values()))), lambda x: x.isNotNull()
    )
    detections = F.transform(
        "_kept", lambda h: F.struct(h["label"].alias("label"), h["start"].alias("start"), (-h["neg_end"]).alias("end"), h["weight"].alias("weight"))
    )
    missed = F.aggregate("_kept", F.lit(1.0), lambda p, h: p * (1.0 - h["weight"]))
    bases = range(len(BASE))
    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        sum((F.coalesce(F.col(f"_n{k}"), F.lit(0).cast("long")) for k in bases), F.lit(0).cast("long")).alias("n_base"),
        F.least(*(f"_first{k}" for k in bases)).alias("first_word"),
        F.greatest(*(f"_last{k}" for k in bases)).alias("last_word"),
        F.array_sort(base).alias("base_labels"),
        detections.alias("detections"),
        F.array_sort(F.array_union(base, F.transform("_kept", lambda h: h["label"]))).alias("labels"),
        F.when(F.size("_kept") > 0, 1.0 - missed).otherwise(F.lit(0.0)).alias("score"),
    )
