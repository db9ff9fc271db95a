"""Log-bilinear language model, trained with noise-contrastive estimation.

Tokens are the words of a text (A-Z lower-cased, cut at ASCII white space) and one end
token. Every token belongs to a class: the ``shortlist`` most frequent words and the end
are classes of their own, all other words fall into ``buckets`` classes by crc32. The
model is P(class | two previous classes) * P(word | class):

* the first factor is log-bilinear: a context vector (position matrices times class
  vectors) times the class's target vector plus bias. Every task trains on all its
  training rows with noise-contrastive estimation from common start values, and Spark
  averages the parameters, weighted by tokens. Normalisers of all context pairs come
  from one matrix product, since exp(a + b) = exp(a) exp(b);
* the second is the smoothed share of the word in its class, (c + 0.5) / (n + 0.5 (v + 1)),
  where an unseen word (c = 0) takes the class's one unknown place.

Word counts cover all training rows. Words of the ``local`` most frequent (a bounded
list) are looked up in the task, rarer ones are counted per row and joined with the
count table, so no hot word is ever shuffled.

Defined cases: null text counts as empty (one end token); a null id counts as the empty
text for the fold; without training rows every word scores log10 1 = 0 in the base and
classes are uniform in the model; very long texts are read in blocks; equal rows stay;
other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import pick, ship, staged, unique_name, word_blocks

END = b""  # no word is empty
LOG10 = float(np.log(10))


@dataclass(frozen=True)
class LmConfig:
    shortlist: int = 1000
    buckets: int = 23
    local: int = 65_536  # words looked up without a join
    width: int = 24
    batch: int = 4096
    noise: int = 64
    rate: float = 0.1
    seed: int = 7

    @property
    def classes(self) -> int:
        return self.shortlist + self.buckets + 1

    @property
    def end(self) -> int:
        return self.classes - 1

    @property
    def start(self) -> int:
        return self.classes  # a context only


@dataclass
class LmModel:
    config: LmConfig
    counts: DataFrame  # (token, n), written
    tokens: int
    types: int
    words: list[bytes]  # the most frequent ones, most frequent first
    word_counts: np.ndarray
    class_n: np.ndarray
    class_v: np.ndarray
    params: dict[str, np.ndarray] = field(default_factory=dict)
    key: str = ""


def _counter(limit: int = 200_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            arrays = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["token", "n"])

        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                for words in word_blocks(text.as_py()):
                    counts.update(words)
                counts[END] += 1
                if len(counts) > limit:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return run


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, n) over all rows of the one binary column, summed in the tasks first."""
    return texts.mapInArrow(_counter(), "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int) -> list:
    """At most ``most`` rows of the most frequent words: all above a count that a histogram gives.

    The histogram has a row per eighth of a doubling of the count; only the chosen rows
    reach the driver, however many partitions the table has.
    """
    words = counts.where(F.octet_length("token") > 0).withColumn("step", F.floor(F.log2("n") * 8).cast("int"))
    least, kept = None, 0
    for row in sorted(words.groupBy("step").count().collect(), reverse=True):
        if kept + row["count"] > most:
            break
        least, kept = row["step"], kept + row["count"]
    if least is None:
        return []
    rows = words.where(F.col("step") >= least).select("token", "n").collect()
    return sorted(rows, key=lambda r: (-r["n"], bytes(r["token"])))


class _Lexicon:
    """Class and word number of every token, from the bounded list of frequent words."""

    def __init__(self, config: LmConfig, words: list[bytes]) -> None:
        self.config = config
        self.number = {w: k for k, w in enumerate(words)}
        classes = [k if k < config.shortlist else self.bucket(w) for k, w in enumerate(words)]
        self.class_of = np.array(classes, np.int64)

    def bucket(self, word: bytes) -> int:
        return self.config.shortlist + zlib.crc32(word) % self.config.buckets

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Word numbers, -1 for words outside the list."""
        get = self.number.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def classes(self, words: list[bytes], numbers: np.ndarray) -> np.ndarray:
        out = self.class_of[numbers] if len(self.class_of) else np.empty(len(words), np.int64)
        for k in np.flatnonzero(numbers < 0).tolist():
            out[k] = self.bucket(words[k])
        return out


def start_params(config: LmConfig, class_n: np.ndarray) -> dict[str, np.ndarray]:
    """Small vectors from a fixed seed; biases start at the unigram log-probabilities."""
    rng = np.random.default_rng(config.seed)
    d, c = config.width, config.classes
    return {
        "context": (rng.standard_normal((c + 1, d)) * 0.1).astype(np.float32),
        "target": (rng.standard_normal((c, d)) * 0.1).astype(np.float32),
        "first": (np.eye(d) * 0.7).astype(np.float32),
        "second": (np.eye(d) * 0.7).astype(np.float32),
        "bias": np.log(unigram(class_n)).astype(np.float32)[:, None],
    }


def unigram(class_n: np.ndarray) -> np.ndarray:
    return (class_n + 1.0) / (class_n.sum() + len(class_n))


class NceTrainer:
    """Noise-contrastive gradient steps (AdaGrad) on minibatches of (c1, c2, target)."""

    def __init__(self, config: LmConfig, params: dict[str, np.ndarray], noise: np.ndarray, seed: int) -> None:
        self.config, self.p = config, {k: v.copy() for k, v in params.items()}
        self.squares = {k: np.full_like(v, 1e-2) for k, v in params.items()}
        self.cumulative, self.log_noise = np.cumsum(noise), np.log(noise * config.noise).astype(np.float32)
        self.rng = np.random.default_rng(seed)
        self.held: list[np.ndarray] = []
        self.waiting = self.seen = 0

    def add(self, classes: np.ndarray) -> None:
        """Positions of one block: classes with its two context classes in front."""
        self.held.append(np.stack([classes[:-2], classes[1:-1], classes[2:]]))
        self.waiting += len(classes) - 2
        if self.waiting >= 16 * self.config.batch:
            self.flush()

    def flush(self) -> None:
        if not self.waiting:
            return
        rows = np.concatenate(self.held, axis=1)
        rows = rows[:, self.rng.permutation(rows.shape[1])]
        for at in range(0, rows.shape[1], self.config.batch):
            self.step(*rows[:, at : at + self.config.batch])
        self.seen += rows.shape[1]
        self.held, self.waiting = [], 0

    def step(self, c1: np.ndarray, c2: np.ndarray, target: np.ndarray) -> None:
        p, n = self.p, len(target)
        drawn = np.searchsorted(self.cumulative, self.rng.random(self.config.noise) * self.cumulative[-1])
        drawn = np.minimum(drawn, self.config.classes - 1)
        r1, r2, q = p["context"][c1], p["context"][c2], p["target"][target]
        hidden = r1 @ p["first"] + r2 @ p["second"]
        true = np.einsum("nd,nd->n", hidden, q) + p["bias"][target, 0] - self.log_noise[target]
        false = hidden @ p["target"][drawn].T + p["bias"][drawn, 0] - self.log_noise[drawn]
        up = _sigmoid(-true) / n  # gradient of the log-likelihood
        down = -_sigmoid(false) / n
        d_hidden = up[:, None] * q + down @ p["target"][drawn]
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        _scatter(grads["target"], target, up[:, None] * hidden)
        np.add.at(grads["target"], drawn, down.T @ hidden)
        grads["bias"][:, 0] = np.bincount(target, up, self.config.classes) + np.bincount(
            drawn, down.sum(axis=0), self.config.classes
        )
        _scatter(grads["context"], c1, d_hidden @ p["first"].T)
        _scatter(grads["context"], c2, d_hidden @ p["second"].T)
        grads["first"], grads["second"] = r1.T @ d_hidden, r2.T @ d_hidden
        for k, g in grads.items():
            g *= n / 16  # so that the rate does not depend on the batch size
            self.squares[k] += g * g
            p[k] += (self.config.rate * g / np.sqrt(self.squares[k])).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _scatter(out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """out[rows] += values, with one sum per distinct row."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    out[ordered[first]] += np.add.reduceat(values[order], first, axis=0)


def _class_blocks(lexicon: _Lexicon, text: bytes | None):
    """(classes with two context classes in front, words, word numbers) of each block; the end in the last."""
    config = lexicon.config
    before = np.array([config.start, config.start])
    for words in word_blocks(text):
        numbers = lexicon.numbers(words)
        found = np.concatenate([before, lexicon.classes(words, numbers)])
        before = found[-2:]
        yield found, words, numbers
    yield np.concatenate([before, [config.end]]), [], np.empty(0, np.int64)


_MATRICES = ("context", "target", "first", "second", "bias")


def fit(
    docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", config: LmConfig = LmConfig()
) -> LmModel:
    """Count all words of the rows where ``train`` (a condition on the id) holds, and train the class model on them."""
    spark = docs.sparkSession
    ship(spark)
    texts = pick(docs, id_col, text_col).where(train).select(F.col(text_col).cast("binary").alias("t"))
    counts = staged(token_counts(texts))
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = frequent_words(counts, config.local)
    words, word_counts = [bytes(r["token"]) for r in top], np.array([r["n"] for r in top], np.int64)

    # words and types of each class; the shortlist's part is taken off its buckets
    class_n, class_v = np.zeros(config.classes), np.zeros(config.classes)
    bucket = F.when(F.octet_length("token") == 0, -1).otherwise(F.crc32("token") % config.buckets)
    for b, n, v in counts.groupBy(bucket.alias("b")).agg(F.sum("n"), F.count(F.lit(1))).collect():
        at = config.end if b < 0 else config.shortlist + b
        class_n[at], class_v[at] = n, v
    lexicon = _Lexicon(config, words)
    for k, n in enumerate(word_counts[: config.shortlist].tolist()):
        at = lexicon.bucket(words[k])
        class_n[k], class_v[k] = n, 1
        class_n[at] -= n
        class_v[at] -= 1

    start, noise = start_params(config, class_n), unigram(class_n)
    shared = spark.sparkContext.broadcast((config, words, start, noise))
    width = config.width
    names = ["part", "row", "weight", *(f"v{k}" for k in range(width))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settings, listed, begin, spread = shared.value
        lexicon = _Lexicon(settings, listed)
        trainer = None
        for batch in batches:
            for text in batch.column(0):
                data = text.as_py()
                if trainer is None:  # the noise is drawn alike when the task runs again
                    trainer = NceTrainer(settings, begin, spread, zlib.crc32(data or b""))
                for found, _, _ in _class_blocks(lexicon, data):
                    trainer.add(found)
        if trainer is None:
            return
        trainer.flush()
        for part, name in enumerate(_MATRICES):
            matrix = trainer.p[name].astype(np.float64)
            wide = np.zeros((len(matrix), width))
            wide[:, : matrix.shape[1]] = matrix
            n = len(matrix)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, float(trainer.seen)))]
                + [pa.array(wide[:, k].copy()) for k in range(width)],
                names=names,
            )

    schema = "part int, row int, weight double, " + ", ".join(f"v{k} double" for k in range(width))
    trained = texts.mapInArrow(run, schema)
    means = [(F.sum(F.col("weight") * F.col(f"v{k}")) / F.sum("weight")).alias(f"v{k}") for k in range(width)]
    params = {k: v.copy() for k, v in start.items()}
    for row in trained.groupBy("part", "row").agg(*means).collect():  # as many rows as the model has
        matrix = params[_MATRICES[row["part"]]]
        matrix[row["row"]] = [row[f"v{k}"] for k in range(matrix.shape[1])]
    return LmModel(config, counts, int(tokens), int(types), words, word_counts, class_n, class_v, params, unique_name("lm"))


def class_tables(params: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, z): log P(w | c1, c2) = a[c1, w] + b[c2, w] - z[c1, c2]."""
    a = (params["context"] @ params["first"]) @ params["target"].T
    b = (params["context"] @ params["second"]) @ params["target"].T + params["bias"][:, 0]
    top_a, top_b = a.max(axis=1, keepdims=True), b.max(axis=1, keepdims=True)
    a, b = a - top_a, b - top_b
    z = np.log(np.exp(a.astype(np.float64)) @ np.exp(b.astype(np.float64)).T)
    return a.astype(np.float32), b.astype(np.float32), z.astype(np.float32)


class _Scorer:
    def __init__(self, state: tuple) -> None:
        _, config, words, word_counts, class_n, class_v, tokens, types, end_count, params = state
        self.config, self.lexicon = config, _Lexicon(config, words)
        self.a, self.b, self.z = class_tables(params)
        self.log_count = np.log10(np.append(word_counts, 0) + 0.5)  # the last: outside the list, added by the join
        self.log_count[-1] = 0.0
        self.log_class = np.log10(class_n + 0.5 * (class_v + 1))
        self.log_class[: config.shortlist] = 0.0  # a class of one word: probability 1
        self.log_class[config.end] = 0.0
        self.log_all = float(np.log10(tokens + 0.5 * (types + 1)))
        self.log_end = float(np.log10(end_count + 0.5))
        self.end_known = int(end_count > 0)

    def __call__(self, text: bytes | None) -> tuple[int, int, float, float, Counter[bytes]]:
        """n_tokens, n_known, base and model score of the listed words and the end, and the other words."""
        n, known, base, score, rare = 1, self.end_known, self.log_end, 0.0, Counter()
        for found, words, numbers in _class_blocks(self.lexicon, text):
            c1, c2, target = found[:-2], found[1:-1], found[2:]
            log_p = self.a[c1, target] + self.b[c2, target] - self.z[c1, c2]
            score += float(log_p.sum(dtype=np.float64)) / LOG10
            if not words:
                continue
            n += len(words)
            outside = np.flatnonzero(numbers < 0).tolist()
            rare.update(words[k] for k in outside)
            known += len(words) - len(outside)
            counted = self.log_count[numbers]
            base += float(counted.sum())
            open_class = (target >= self.config.shortlist) & (target < self.config.end)
            score += float(counted[open_class].sum()) - float(self.log_class[target].sum())
        return n, known, base - n * self.log_all, score, rare


@lru_cache(maxsize=2)
def _scorer(key: str, shared) -> _Scorer:
    return _Scorer(shared.value)


def score(docs: DataFrame, model: LmModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, n_tokens, n_known, base_score and score (log10) of every row."""
    spark = docs.sparkSession
    ship(spark)
    end = model.counts.where(F.octet_length("token") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    state = (
        model.key, model.config, model.words, model.word_counts, model.class_n, model.class_v,
        model.tokens, model.types, int(end), model.params,
    )
    shared, key = spark.sparkContext.broadcast(state), model.key
    rows = pick(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text")
    )
    heads = rows.schema.fields[:-1]
    schema = T.StructType(
        heads
        + [T.StructField("n", T.LongType()), T.StructField("known", T.LongType())]
        + [T.StructField("base", T.DoubleType()), T.StructField("model", T.DoubleType())]
        + [T.StructField("rare", T.ArrayType(T.BinaryType())), T.StructField("times", T.ArrayType(T.LongType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(key, shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [scorer(t.as_py()) for t in part.columns[-1]]
                n, known, base, total, rare = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(total, pa.float64())]
                    + [pa.array([list(r) for r in rare], pa.list_(pa.binary())), pa.array([list(r.values()) for r in rare], pa.list_(pa.int64()))],
                    names=schema.names,
                )

    local = staged(rows.mapInArrow(run, schema))
    words = local.select("_row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(
        "_row", F.col("w.rare").alias("token"), F.col("w.times").alias("k")
    )
    count = F.coalesce(F.col("n"), F.lit(0))
    joined = words.join(model.counts, "token", "left").groupBy("_row").agg(
        F.sum(F.col("k") * F.log10(count + 0.5)).alias("log_count"),
        F.sum(F.when(count > 0, F.col("k")).otherwise(0)).alias("joined_known"),
    )
    more = F.coalesce("log_count", F.lit(0.0))
    return local.drop("rare", "times").join(joined, "_row", "left").select(
        F.col("_id").alias(id_col),
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("joined_known", F.lit(0))).alias("n_known"),
        (F.col("base") + more).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
