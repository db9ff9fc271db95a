from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import lm
from strata.llm.registry import op4_lm
from tests.llm.cases import SF, clashing, edge_docs, edge_rows, empty_docs, fold


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def brute_base(rows, held_out):
    counts = Counter()
    for doc_id, text in rows:
        if not held_out(doc_id):
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    return n, [(len(t), sum(counts[x] > 0 for x in t), sum(log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t)) for t in (tokens(x) for _, x in rows)]


def test_counts_and_base_score_match_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    n, expected = brute_base(rows, lambda i: fold(i) == 1)
    found = {r.doc_id: r for r in op4_lm(spark, SF).collect()}
    model = base = words = 0
    for (doc_id, _), (n_tokens, n_known, score) in zip(rows, expected):
        r = found[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(doc_id) == 1, n_tokens, n_known, n)
        assert r.base_score == pytest.approx(score, rel=1e-9)
        if r.held_out:
            model, base, words = model + r.score, base + r.base_score, words + n_tokens
    assert model / words > base / words  # better than single words on held-out texts


def test_few_listed_words_leave_the_rest_to_the_join(spark):
    """The same counts and base scores when almost all words are joined."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60)
    rows = [tuple(r) for r in docs.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm.fit(docs, F.col("doc_id") % 2 == 0, config=lm.LmConfig(shortlist=4, buckets=3, local=8, width=4))
    assert 0 < len(model.words) <= 8
    _, expected = brute_base(rows, lambda i: i % 2)
    found = {r.doc_id: r for r in lm.score(docs, model).collect()}
    for (doc_id, _), (n_tokens, n_known, score) in zip(rows, expected):
        assert (found[doc_id].n_tokens, found[doc_id].n_known) == (n_tokens, n_known)
        assert found[doc_id].base_score == pytest.approx(score, rel=1e-9)


def test_class_probabilities_add_up_to_one():
    config = lm.LmConfig(shortlist=5, buckets=2, width=3)
    params = lm.start_params(config, np.arange(8.0))
    rng = np.random.default_rng(0)
    params = {k: v + rng.standard_normal(v.shape).astype(np.float32) for k, v in params.items()}
    a, b, z = lm.class_tables(params)
    p = np.exp(a[:, None, :] + b[None, :, :] - z[:, :, None])
    assert np.allclose(p.sum(axis=2), 1, atol=1e-5)
    hidden = params["context"][2] @ params["first"] + params["context"][4] @ params["second"]
    logits = params["target"] @ hidden + params["bias"][:, 0]
    assert np.allclose(p[2, 4], np.exp(logits) / np.exp(logits).sum(), atol=1e-5)


def test_training_learns_a_pattern():
    config = lm.LmConfig(shortlist=4, buckets=1, width=6, batch=128, noise=8)
    classes = np.tile([0, 1, 2, 3], 6000)
    start = lm.start_params(config, np.bincount(classes, minlength=6).astype(float))
    trainer = lm.NceTrainer(config, start, lm.unigram(np.bincount(classes, minlength=6).astype(float)), 1)
    trainer.add(np.concatenate([[config.start, config.start], classes]))
    trainer.flush()
    a, b, z = lm.class_tables(trainer.p)
    assert np.exp(a[1, 3] + b[2, 3] - z[1, 2]) > 0.8


def test_edge_rows(spark):
    docs = clashing(edge_docs(spark))
    model = lm.fit(docs, F.lit(True), config=lm.LmConfig(shortlist=4, buckets=3, local=8, width=4))
    found = lm.score(docs, model).collect()
    assert len(found) == len(edge_rows())
    assert all(r.n_tokens == 1 for r in found if r.doc_id in (0, 1, 2))
    assert all(np.isfinite(r.score) and r.score <= 1e-9 for r in found)
    untrained = lm.fit(docs, F.lit(False), config=lm.LmConfig(shortlist=4, buckets=3, local=8, width=4))
    assert all(r.n_known == 0 and abs(r.base_score) < 1e-9 for r in lm.score(docs, untrained).collect())
    assert lm.score(empty_docs(spark), lm.fit(empty_docs(spark), F.lit(True))).count() == 0
