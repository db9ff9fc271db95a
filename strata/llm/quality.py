"""Quality grades by ordinal cumulative-link regression on hashed text.

P(grade <= k) = sigmoid(threshold_k - w . x): one weight vector over hashed features is
shared by all grades, and the thresholds are ordered by construction (each is the one
before plus an exponential). Features are the words of a text, the shapes of its tokens,
repeats of the token before, and a few binned proportions, all hashed into ``2 ** bits``
slots; counts are damped and the vector has length 1.

The model is fitted on a bounded sample of rated rows (``sample`` rows, chosen by a hash
of the id); every row is scored. Results are the expected grade and the tail
probability P(grade >= ``least_grade``) for selection.

Defined cases: null text counts as empty and has only the proportions as features;
without ratings of at least two grades all weights are zero, and the thresholds give the
smoothed grade shares; several ratings of one id count as the lowest; rows with null or
equal ids are scored like others; very long texts are read whole, in blocks; other
columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import bounded_rows, bounded_sample, pick, ship


@dataclass(frozen=True)
class QualityConfig:
    bits: int = 16
    sample: int = 8_000  # rated rows at most
    epochs: int = 12
    batch: int = 64
    rate: float = 0.3
    ridge: float = 1e-5
    seed: int = 11


@dataclass
class OrdinalModel:
    config: QualityConfig
    weights: np.ndarray
    thresholds: np.ndarray  # rising, one fewer than grades

    def tails(self, dot: float | np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return 1 / (1 + np.exp(-np.clip(np.asarray(dot)[..., None] - self.thresholds, -30, 30)))


_DIGITS, _LOWER, _UPPER, _ACCENTS = re.compile(rb"[0-9]+"), re.compile(rb"[a-z]+"), re.compile(rb"[A-Z]+"), re.compile(rb"[\x80-\xff]+")
_RUNS = re.compile(rb"([^aA9z])\1+")


def shape(token: bytes) -> bytes:
    """Letters, digits and other bytes by kind, runs as one: ``Of%%%`` is ``Aa%``."""
    token = _UPPER.sub(b"A", _DIGITS.sub(b"9", _LOWER.sub(b"a", token)))
    return _RUNS.sub(rb"\1", _ACCENTS.sub(b"z", token)).replace(b"za", b"a").replace(b"az", b"a")


class Hasher:
    """Hashed features of texts; slots of common tokens are remembered."""

    def __init__(self, bits: int, memo: int = 200_000) -> None:
        self.mask, self.limit = (1 << bits) - 1, memo
        self.slots: dict[bytes, tuple[int, int]] = {}

    def slot(self, kind: bytes, value: bytes) -> int:
        return zlib.crc32(kind + value) & self.mask

    def token(self, token: bytes) -> tuple[int, int]:
        found = self.slots.get(token)
        if found is None:
            if len(self.slots) >= self.limit:
                self.slots.clear()
            found = self.slots[token] = (self.slot(b"w", token.lower().strip(b".,;:!?\"'()")), self.slot(b"s", shape(token)))
        return found

    def __call__(self, text: bytes | None, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """Distinct slots of the text and their values (of length 1 together)."""
        text = text or b""
        words: dict[int, int] = {}
        n = repeats = 0
        before = b""
        at = 0
        while at < len(text):
            cut = text.find(b" ", at + block) if len(text) - at > block else -1
            cut = cut if cut >= 0 else len(text)
            tokens = text[at:cut].split()
            if tokens:
                slots = np.array([self.token(t) for t in tokens]).ravel()
                for slot, count in zip(*(x.tolist() for x in np.unique(slots, return_counts=True))):
                    words[slot] = words.get(slot, 0) + count
                repeats += sum(a == b for a, b in zip(tokens, tokens[1:])) + (tokens[0] == before)
                before = tokens[-1]
                n += len(tokens)
            at = cut
        lines = text.split(b"\n")
        upper = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        marks = len(text) - len(text.translate(None, b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~"))
        size = max(1, len(text))
        shares = {
            b"repeats": repeats / max(1, n), b"lines": 1 - len(set(lines)) / len(lines),
            b"upper": upper / size, b"marks": marks / size, b"distinct": len(words) / max(1, 2 * n),
        }
        bins = {self.slot(b"p", name + b"%d" % int(share * 20)) for name, share in shares.items()}
        bins.add(self.slot(b"p", b"size%d" % size.bit_length()))
        slots = np.array([*words, *bins], np.int64)
        values = np.concatenate([np.log1p(np.fromiter(words.values(), float, len(words))), np.full(len(bins), 3.0)])
        return slots, values / np.sqrt((values**2).sum())


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, levels: int, config: QualityConfig) -> OrdinalModel:
    """Maximum likelihood by AdaGrad over minibatches in a seeded order."""
    size = 1 << config.bits
    shares = np.array([(grades >= k).sum() + 0.5 for k in range(1, levels)]) / (len(grades) + 1)
    thresholds = -np.log(shares / (1 - shares))
    thresholds = np.maximum.accumulate(thresholds + np.arange(levels - 1) * 1e-6)
    weights = np.zeros(size)
    if len(np.unique(grades)) < 2:
        return OrdinalModel(config, weights, thresholds)
    base, gaps = thresholds[0], np.log(np.maximum(np.diff(thresholds), 1e-3))
    seen_w, seen_t = np.full(size, 1e-6), np.full(levels - 1, 1e-2)
    rng = np.random.default_rng(config.seed)
    for _ in range(config.epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), config.batch):
            batch = order[at : at + config.batch]
            sizes = [len(rows[k][0]) for k in batch]
            slots, values = np.concatenate([rows[k][0] for k in batch]), np.concatenate([rows[k][1] for k in batch])
            owner = np.repeat(np.arange(len(batch)), sizes)
            dots = np.bincount(owner, weights[slots] * values, len(batch))
            thresholds = base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
            by_dot, by_threshold = _gradients(dots, thresholds, grades[batch])
            used, place = np.unique(slots, return_inverse=True)
            g = np.bincount(place, by_dot[owner] * values, len(used)) / len(batch) - config.ridge * weights[used]
            seen_w[used] += g * g
            weights[used] += config.rate * g / np.sqrt(seen_w[used])
            below = np.cumsum(by_threshold[::-1])[::-1] / len(batch)
            g = np.concatenate([below[:1], below[1:] * np.exp(gaps)])
            seen_t += g * g
            move = config.rate * g / np.sqrt(seen_t)
            base, gaps = base + move[0], gaps + np.clip(move[1:], -1, 1)
    return OrdinalModel(config, weights, base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def _gradients(dots: np.ndarray, thresholds: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the log-likelihood by each row's w . x, and by each threshold."""
    levels = len(thresholds)
    cdf = 1 / (1 + np.exp(-np.clip(thresholds[None, :] - dots[:, None], -30, 30)))
    full = np.concatenate([np.zeros((len(dots), 1)), cdf, np.ones((len(dots), 1))], axis=1)
    slope = full * (1 - full)
    at = np.arange(len(dots))
    p = np.maximum(full[at, grades + 1] - full[at, grades], 1e-12)
    by_dot = (slope[at, grades] - slope[at, grades + 1]) / p
    by_threshold = np.zeros(levels + 2)
    np.add.at(by_threshold, grades + 1, slope[at, grades + 1] / p)
    np.add.at(by_threshold, grades, -slope[at, grades] / p)
    return by_dot, by_threshold[1:-1]


def fit(
    docs: DataFrame,
    ratings: DataFrame,
    grade: Column,
    train: Column,
    levels: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    config: QualityConfig = QualityConfig(),
) -> OrdinalModel:
    """Fit on rated rows: ``grade`` (0 to ``levels`` - 1, null: no rating) and ``train`` are over ``ratings``."""
    ship(docs.sparkSession)
    marks = ratings.where(train & F.col(id_col).isNotNull()).select(F.col(id_col), grade.cast("int").alias("grade"))
    marks = marks.where(F.col("grade").between(0, levels - 1)).groupBy(id_col).agg(F.min("grade").alias("grade"))
    marks = bounded_sample(marks, id_col, config.sample)
    # the sample's size has a bound, so it is sent to every task and no text is shuffled
    rows = bounded_rows(pick(docs, id_col, text_col).join(F.broadcast(marks), id_col), id_col, text_col, config.sample)
    rows = rows.select(id_col, "grade", F.col(text_col).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(config.bits)
        for batch in batches:
            pairs = [hasher(t.as_py()) for t in batch.column(2)]
            slots = pa.array([s.astype("<i4").tobytes() for s, _ in pairs], pa.binary())
            values = pa.array([v.astype("<f4").tobytes() for _, v in pairs], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], slots, values], names=["id", "grade", "slots", "values"])

    kind = rows.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, grade int, slots binary, values binary").collect()
    found.sort(key=lambda r: (r["id"], bytes(r["slots"])))
    sparse = [(np.frombuffer(r["slots"], "<i4").astype(np.int64), np.frombuffer(r["values"], "<f4").astype(float)) for r in found]
    return fit_ordinal(sparse, np.array([r["grade"] for r in found], np.int64), levels, config)


def grade_rows(
    docs: DataFrame, model: OrdinalModel, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", least_grade: int = 1
) -> DataFrame:
    """The ``keep`` columns, ``expected_grade`` and ``tail`` = P(grade >= ``least_grade``) of every row."""
    ship(docs.sparkSession)
    rows = pick(docs, *dict.fromkeys([*keep, text_col])).select(*keep, F.col(text_col).cast("binary").alias("_text"))
    doubles = [T.StructField(n, T.DoubleType()) for n in ("expected_grade", "tail")]
    schema = T.StructType([*rows.schema.fields[:-1], *doubles])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        hasher = Hasher(fitted.config.bits)
        for batch in batches:
            dots = []
            for text in batch.columns[-1]:
                slots, values = hasher(text.as_py())
                dots.append(float((fitted.weights[slots] * values).sum()))
            tails = fitted.tails(np.array(dots))
            out = [pa.array(tails.sum(axis=1)), pa.array(tails[:, least_grade - 1].copy())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], names=schema.names)

    return rows.mapInArrow(run, schema)
