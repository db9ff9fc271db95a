import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import licenses
from strata.llm.license_rules import BASE, signatures
from tests.llm.cases import SF, clashing, edge_docs, edge_rows, empty_docs, lower_ascii


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))
    places = []
    for phrase, label in BASE.items():
        q = phrase.split()
        places += [(k, label) for k in range(len(w) - len(q) + 1) if w[k : k + len(q)] == q]
    padded = " " + "".join(x + " " for x in w)
    hits = []
    for keyword, rules in signatures():
        if keyword in padded:
            for r in rules:
                hits += [(m.start(), -m.end(), r.priority, r.label, r.weight) for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", padded)]
    kept, end = [], -1
    for hit in sorted(hits):
        if hit[0] >= end:
            kept.append(hit)
            end = -hit[1]
        elif -hit[1] > end and hit[2] < kept[-1][2]:
            kept[-1] = hit
            end = -hit[1]
    missed = 1.0
    for hit in kept:
        missed *= 1 - hit[4]
    labels = sorted({label for _, label in places} | {hit[3] for hit in kept})
    starts = [k for k, _ in places]
    base = sorted({label for _, label in places})
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(labels), 1 - missed if kept else 0.0


def scanned(df):
    columns = ["n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ","), F.array_join("labels", ","), "score"]
    return {r[0]: tuple(r)[1:] for r in licenses.scan(df).select("doc_id", *columns).collect()}


def check(found, rows):
    assert len(found) == len(rows)
    for doc_id, text in rows:
        expected = brute(text)
        assert found[doc_id][:6] == expected[:6], (doc_id, (text or "")[:200])
        assert found[doc_id][6] == pytest.approx(expected[6], abs=1e-9)


def test_random_texts_of_rule_words(spark):
    rng = random.Random(5)
    parts = [re.sub(r"\(\?:([^()|]*)[^()]*\)\??", r"\1", r.pattern).replace("?", "").replace("\\", "") for _, rules in signatures() for r in rules]
    parts += ["CC BY cc by cc-by", "General Public License", "all rights reserved. all rights", "the mit", "mit der", "© 2001 é"]
    rows = []
    for k in range(300):
        some = [rng.choice(parts) for _ in range(rng.randint(0, 12))]
        rows.append((k, " . ".join(p.upper() if rng.random() < 0.3 else p for p in some)))
    rows += [(900, "cc by " * 500), (901, "licensed under the mit license; " * 800)]
    check(scanned(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(scanned(docs), [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_hundreds_of_rules_with_keywords_that_their_patterns_need():
    assert sum(len(rules) for _, rules in signatures()) >= 200
    assert len({r.priority for _, rules in signatures() for r in rules}) == sum(len(rules) for _, rules in signatures())


def test_edge_rows(spark):
    found = licenses.scan(clashing(edge_docs(spark))).collect()
    assert len(found) == len(edge_rows())
    assert all(r.n_words == 0 and r.first_word is None and r.labels == [] and r.score == 0 for r in found if r.doc_id in (0, 1, 2))
    assert licenses.scan(empty_docs(spark)).count() == 0
