import numpy as np
from pyspark.sql import functions as F

from strata.llm import quality, toxicity
from strata.llm.common import bounded_rows
from strata.llm.registry import op5_quality
from tests.llm.cases import clashing, edge_docs, edge_rows, empty_docs


def test_gradients_are_those_of_the_likelihood():
    rng = np.random.default_rng(1)
    dots, thresholds, grades = rng.standard_normal(20), np.array([-1.0, 0.2, 1.1]), rng.integers(0, 4, 20)

    def likelihood(d, t):
        cdf = 1 / (1 + np.exp(-(t[None, :] - d[:, None])))
        full = np.concatenate([np.zeros((len(d), 1)), cdf, np.ones((len(d), 1))], axis=1)
        at = np.arange(len(d))
        return np.log(full[at, grades + 1] - full[at, grades])

    by_dot, by_threshold = quality._gradients(dots, thresholds, grades)
    step = 1e-6
    assert np.allclose((likelihood(dots + step, thresholds) - likelihood(dots - step, thresholds)) / (2 * step), by_dot, atol=1e-5)
    for k in range(3):
        e = np.eye(3)[k] * step
        slope = (likelihood(dots, thresholds + e) - likelihood(dots, thresholds - e)) / (2 * step)
        assert np.isclose(slope.sum(), by_threshold[k], atol=1e-4)


def test_thresholds_stay_ordered_and_tails_fall():
    config = quality.QualityConfig(bits=8, epochs=20)
    rows = [(np.array([k % 4]), np.array([1.0])) for k in range(200)]
    grades = np.array([k % 4 for k in range(200)])
    model = quality.fit_ordinal(rows, grades, 4, config)
    assert (np.diff(model.thresholds) > 0).all()
    expected = [model.tails(model.weights[k]).sum() for k in range(4)]
    assert expected == sorted(expected)
    assert (np.diff(model.tails(0.3)) < 0).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = op5_quality(spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    good = [r for r in rows if r.quality == 1]
    assert np.mean([r.predicted for r in good]) > 0.98
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail <= 1 for r in rows)


def test_edge_rows(spark):
    docs = clashing(edge_docs(spark))
    ratings = spark.createDataFrame([(3, 2), (4, 0), (4, 1), (None, 1), (5, None), (6, 9)], "doc_id long, g int")
    model = quality.fit(docs, ratings, F.col("g"), F.lit(True), levels=3)
    found = quality.grade_rows(docs, model).collect()
    assert len(found) == len(edge_rows())
    assert all(np.isfinite(r.expected_grade) for r in found)
    none = quality.fit(docs, ratings.where("false"), F.col("g"), F.lit(True), levels=3)
    assert not none.weights.any()
    assert quality.grade_rows(empty_docs(spark), none).count() == 0


def test_rows_of_one_id_are_bounded(spark, monkeypatch):
    def text(k):
        return f"text {k} " + " ".join(f"w{k * 7 % m}" for m in range(2, 9))

    rows = [(k, text(k)) for k in range(1, 40)] + [(100, text(1000 + k)) for k in range(2000)] + [(101, "one copy")] * 1000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(k, k % 2) for k in [*range(1, 40), 100, 101]], "doc_id long, toxic int")
    seen = []
    fit_ordinal, features = quality.fit_ordinal, toxicity._without_near_copies
    monkeypatch.setattr(quality, "fit_ordinal", lambda sparse, *rest: (seen.append(len(sparse)), fit_ordinal(sparse, *rest))[1])
    monkeypatch.setattr(toxicity, "_without_near_copies", lambda found, size: (seen.append(found.count()), features(found, size))[1])
    quality.fit(docs, marks, F.col("toxic"), F.lit(True), 2, config=quality.QualityConfig(bits=8, epochs=2, sample=200))
    toxicity.fit(docs, marks, F.lit(True), config=toxicity.ToxicConfig(sample=200))
    assert all(100 < n <= 200 for n in seen) and len(seen) == 2
    chosen = bounded_rows(docs, "doc_id", "text", 200)
    assert {r.doc_id: r["count"] for r in chosen.where("doc_id <> 100").groupBy("doc_id").count().collect()} == dict.fromkeys([*range(1, 40), 101], 1)
    assert bounded_rows(docs, "doc_id", "text", len(rows)).count() == len(rows)
