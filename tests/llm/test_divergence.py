import random
import re
from collections import Counter

import duckdb
import numpy as np

from strata.llm import divergence as dv
from strata.llm.registry import ORACLE_SQL, op13_divergence
from tests.llm.cases import SF, clashing, edge_docs, empty_docs, lower_ascii

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "text string, lang string, source string"


def brute(rows, least_docs, most=10):
    rows = [tuple(v or "" for v in r) for r in rows]
    out = set()
    for lang in {r[1] for r in rows}:
        texts = [(TERM.findall(lower_ascii(t)), s) for t, la, s in rows if la == lang]
        held = Counter(t for terms, _ in texts for t in set(terms))
        kept = sorted(t for t, n in held.items() if n >= least_docs)
        counts = {s: Counter() for _, s in texts}
        for terms, s in texts:
            counts[s].update(t for t in terms if t in set(kept))
        counts[None] = sum(counts.values(), Counter())
        p = {}
        for s, c in counts.items():
            total = sum(c.values())
            p[s] = {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(x, y):
            return (x - y) ** 2 // (x + y)

        for s in counts:
            if s is None:
                continue
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in counts if o not in (s, None)]
            term = [(-f(p[s][t], p[None][t]), t) for t in kept if counts[s][t] and p[s][t] > p[None][t]]
            for part, items in (("pair", pair), ("term", term)):
                ranked = sorted(items, key=lambda x: (x[0], x[1].encode()))
                out |= {(lang, s, part, item, -v, k) for k, (v, item) in enumerate(ranked, 1) if part == "pair" or k <= most}
    return out


def random_rows(seed, n=300):
    rng = random.Random(seed)
    terms = [f"{a}{b}" for a in "abcdefgé日" for b in "xyzXYZ"]
    return [
        (
            rng.choice([None, ""]) if rng.random() < 0.05 else " 1".join(rng.choices(terms, range(1, len(terms) + 1), k=rng.randint(1, 30))),
            rng.choice(["en", "en", "de", None]),
            rng.choice(["a", "b", "c", "d", "é", None, ""]),
        )
        for _ in range(n)
    ]


def test_given_table_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    found = op13_divergence(spark, SF)
    columns = sorted(found.columns)
    expected = con.execute(f"select {', '.join(columns)} from ({ORACLE_SQL['op13_divergence']})").fetchall()
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == sorted(expected)


def test_random_rows_match_brute_force_in_any_blocks_and_tiles(spark):
    rows = random_rows(1)
    docs = spark.createDataFrame(rows, SCHEMA)
    expected = brute(rows, 10)
    assert {tuple(r) for r in dv.audit(docs).collect()} == expected
    found = [tuple(r) for r in dv.audit(clashing(docs), block_terms=5, tile=2).collect()]
    assert len(found) == len(expected) and set(found) == expected


def test_edge_rows(spark):
    docs = edge_docs(spark)
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    # no term is in 10 documents: pairs are worth 0; a language with one source has none
    found = {tuple(r) for r in dv.audit(clashing(docs)).collect()}
    assert found == brute(rows, 10) and {r[4] for r in found} == {0}
    assert {tuple(r) for r in dv.audit(docs, least_docs=1).collect()} == brute(rows, 1)
    assert dv.audit(empty_docs(spark)).collect() == []


def test_equal_totals_and_ties_by_utf8(spark):
    rows = [("b a é 日 a", "en", s) for s in ("s1", "s2", "s3", "é", "z")] + [("q q", "en", "s9")]
    assert {tuple(r) for r in dv.audit(spark.createDataFrame(rows, SCHEMA), least_docs=1).collect()} == brute(rows, 1)


def test_equal_subtrees_are_shared_and_priced_once(monkeypatch):
    counts = np.zeros((30, 1024), np.int64)
    counts[:, :8] = np.arange(240).reshape(30, 8) % 7
    forest = dv.Forest(counts)
    nodes = len(forest.leaves) + sum(len(left) for left, _ in forest.levels)
    assert nodes < 200  # of 30 * 2047 places
    priced = []
    monkeypatch.setattr(dv, "price", lambda p, q: priced.append(len(p)) or (p - q) * (p - q) // (p + q))
    totals = counts.sum(axis=1)
    left, right = np.triu_indices(30, 1)
    found = forest.prices(left, right, totals, 1024)
    shares = [dv.shares(counts[k], int(totals[k]), 1024) for k in range(30)]
    direct = [int(((shares[i] - shares[j]) ** 2 // (shares[i] + shares[j])).sum()) for i, j in zip(left, right)]
    assert found.tolist() == direct
    assert sum(priced) < 435 * 1024 / 20


def test_large_counts_stay_exact():
    counts = np.array([[10**15, 3, 0], [7, 10**14, 1]])
    totals = counts.sum(axis=1)
    p = [[1 + 10**9 * (int(c) + 2) // (int(t) + 6) for c in row] for row, t in zip(counts, totals)]
    expected = sum((a - b) ** 2 // (a + b) for a, b in zip(*p))
    assert dv.Forest(counts).prices(np.array([0]), np.array([1]), totals, 3).tolist() == [expected]


def test_long_texts_are_counted_whole_and_passed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(dv, "HELD", 50)
    rows = [(" ".join(f"t{a}{b}" for a in "abcdef" for b in "ghijkl") * 20_000, "en", f"s{k % 3}") for k in range(2)]
    rows += random_rows(2, 60)
    assert {tuple(r) for r in dv.audit(spark.createDataFrame(rows, SCHEMA), least_docs=2).collect()} == brute(rows, 2)
