"""Toxicity scores from a weighted finite-state pattern grammar.

Clauses are matched by the composed transducers of :mod:`strata.llm.toxic_grammar`; a
document's features are the summed weights of its matched clauses by pattern, and a logistic
regression on them gives the score. A hostile word counts only where its clause governs it: a
target, a verb of being, an article, a call, a command, another hostile word; alone it
counts nothing. Besides the written word lists the grammar knows stems learnt from labels,
which need a governor like the others: words and word beginnings that labelled toxic documents
hold much more often than others, by more evidence than chance gives the best of all candidates. Labels come from a bounded sample of the labelled training
rows (``sample`` rows, chosen by a hash of the id, near copies once, so that the words of a
much copied text do not pass for marks of toxicity). The regression is fitted on one half
with stems from the other, so that it sees stems at their worth for new texts; the model
then takes the stems of both halves. Labels, language, source and id are never inputs of a score.

Defined cases: null text counts as empty; a text without matched clauses gets the score
of the bias alone; without labels of both kinds the written start weights hold; several
labels of one id count as toxic if any is; rows with null or equal ids are scored like
others; very long texts are read whole; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import bounded_rows, bounded_sample, pick, ship, staged
from strata.llm.toxic_grammar import PATTERNS, TOKEN, Lexicon, pattern_weights, word_features

# bias, then one weight per pattern, in force until labels say otherwise
START = (-2.5, 0.2, 0.2, 1.5, 1.0, 2.0, 1.2, 2.5, 1.5, 2.5, 1.5, 3.0, 2.0, 2.0, 2.5)


@dataclass(frozen=True)
class ToxicConfig:
    sample: int = 20_000  # labelled rows at most
    stems: int = 3_000  # learnt words and stems at most
    least_odds: float = 3.0  # log-odds of a learnt stem
    least_rows: int = 4  # toxic rows that hold it
    chance: float = 1.0  # stems expected to pass by chance, at most
    sketch: int = 4  # least word hashes that near copies share


@dataclass
class ToxicModel:
    stems: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = START


def _stem_counts(limit: int = 200_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter[str], Counter[str]] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            keys = list(counts[0].keys() | counts[1].keys())
            arrays = [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)]
            counts[0].clear(), counts[1].clear()
            return pa.RecordBatch.from_arrays(arrays, names=["stem", "clean", "toxic"])

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                words = set(TOKEN.findall((text.as_py() or "").lower()))
                counts[toxic].update({s for w in words if len(w) > 2 for s in word_features(w)})
                if len(counts[0]) + len(counts[1]) > limit:
                    yield out()
        if counts[0] or counts[1]:
            yield out()

    return run


def learn_stems(rows: DataFrame, config: ToxicConfig) -> dict[str, float]:
    """Weights of words and stems, from rows (text, toxic).

    The second round looks only at toxic rows that hold neither a written insult or
    threat nor a stem of the first, where a rarer mark stands out.
    """
    first = _associated(rows, config)
    matched = _features(rows.select("toxic", F.col("text").alias("kept"), "text"), first)
    free = F.aggregate("patterns", F.lit(0.0), lambda total, x: total + x) == 0
    # written between the two Python steps: in one task each would hold a worker process of its own,
    # which Spark keeps for later stages; and the rows are read twice
    rest = staged(matched.where((F.col("toxic") == 0) | free).select("toxic", F.col("kept").alias("text")))
    return _associated(rest, config) | first


def _associated(rows: DataFrame, config: ToxicConfig) -> dict[str, float]:
    """Words and stems that toxic rows hold much more often than others.

    The evidence for a stem bounds the logarithm of the probability that so large a share of
    the rows that hold it is toxic by chance (Chernoff); it must exceed that of the number of
    candidates over ``chance``.
    """
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {}
    counts = rows.select("text", "toxic").mapInArrow(_stem_counts(), "stem string, clean long, toxic long")
    counts = counts.groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = staged(counts.where(F.col("clean") + F.col("toxic") >= config.least_rows))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    base, share = toxic / (toxic + clean), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    evidence = F.col("toxic") * F.log(share / base)
    evidence += F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base))).otherwise(0.0)
    chosen = (
        counts.withColumn("odds", odds)
        .where((F.col("odds") >= config.least_odds) & (F.col("toxic") >= config.least_rows))
        .where(evidence >= math.log(max(1, counts.count()) / config.chance))
        .orderBy(F.desc("toxic"), "stem")
        .limit(config.stems)
    )
    return {r["stem"]: min(1.0, r["odds"] / 6.0) for r in chosen.collect()}


def _without_near_copies(rows: DataFrame, size: int) -> DataFrame:
    """One of all rows that share the ``size`` least hashes of their words, and the label."""
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"))
    sketch = F.slice(F.array_sort(F.transform(words, lambda w: F.xxhash64(w))), 1, size)
    return rows.withColumn("sketch", sketch).dropDuplicates(["toxic", "sketch"]).drop("sketch")


def _features(rows: DataFrame, stems: dict[str, float]) -> DataFrame:
    """The first columns of ``rows`` and, instead of its last column (the text), the array of pattern weights."""
    shared = rows.sparkSession.sparkContext.broadcast(stems)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("patterns", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(shared.value)
        for batch in batches:
            found = [pattern_weights(text.as_py() or "", lexicon) for text in batch.columns[-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.float64()))], names=schema.names)

    return rows.mapInArrow(run, schema)


def fit_weights(features: np.ndarray, toxic: np.ndarray, ridge: float = 0.05, steps: int = 50) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps, pulled towards the start weights."""
    start = np.array(START)
    if not len(toxic) or toxic.min() == toxic.max():
        return START
    x = np.column_stack([np.ones(len(features)), np.log1p(features)])
    w, pull = start.copy(), ridge * np.array([1e-3] + [1.0] * features.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - toxic) + pull * (w - start)
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(pull)
        move = np.linalg.solve(hessian, gradient)
        w -= np.clip(move, -2.0, 2.0)
        if np.abs(move).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    config: ToxicConfig = ToxicConfig(),
) -> ToxicModel:
    """Learn stems and weights from labelled rows of ``docs`` whose id satisfies ``train``."""
    ship(docs.sparkSession)
    marks = pick(labels, id_col, label_col).where(train & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    marks = marks.groupBy(id_col).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    marks = bounded_sample(marks, id_col, config.sample)
    half = F.pmod(F.xxhash64(F.col(id_col), F.lit("half")), F.lit(2))
    # the sample's size has a bound, so it is sent to every task and no text is shuffled
    rows = bounded_rows(pick(docs, id_col, text_col).join(F.broadcast(marks), id_col), id_col, text_col, config.sample)
    rows = rows.select(half.alias("half"), "toxic", F.col(text_col).alias("text"))
    rows = staged(_without_near_copies(rows, config.sketch))
    some = learn_stems(rows.where("half = 0"), config)
    found = _features(rows.where("half = 1").select("toxic", "text"), some).collect()  # bounded like the sample
    features = np.array([r["patterns"] for r in found], float).reshape(len(found), len(PATTERNS))
    return ToxicModel(learn_stems(rows, config), fit_weights(features, np.array([r["toxic"] for r in found], float)))


def score(docs: DataFrame, model: ToxicModel, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, ``patterns`` (weight of each pattern) and ``score`` (0 to 1) of every row."""
    ship(docs.sparkSession)
    rows = pick(docs, *dict.fromkeys([*keep, text_col])).select(*keep, F.col(text_col).alias("_text"))
    scored = _features(rows, model.stems)
    bias, *weights = (F.lit(w) for w in model.weights)
    logit = bias
    for k, weight in enumerate(weights):
        logit = logit + weight * F.log1p(F.get("patterns", F.lit(k)))
    return scored.withColumn("score", F.round(1 / (1 + F.exp(-logit)), 9))
