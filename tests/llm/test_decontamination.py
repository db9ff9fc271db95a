import hashlib
import random
import re

import duckdb

from strata.llm import decontamination as dc
from strata.llm.registry import ORACLE_SQL, op12_decontamination
from tests.llm.cases import SF, clashing, edge_docs, edge_rows, empty_docs, lower_ascii

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORD.findall(lower_ascii(text))


def brute(docs, items, window=10, slop=0):
    """Per document its words, hit words, items with exact matches, and items with near ones."""
    wanted = []
    for item, text in items:
        w = split(text)
        wanted += [(str(item) if item is not None else "", w[k : k + window]) for k in range(max(1, len(w) - window + 1) if w else 0)]
    out = []
    for _, text in docs:
        w, hit, owners, near = split(text), set(), set(), set()
        for item, gram in wanted:
            for b in range(-slop - len(gram), len(w) + slop):
                if b >= 0 and w[b : b + len(gram)] == gram:
                    hit |= set(range(b, b + len(gram)))
                    owners.add(item)
                if all(g in w[max(b + k - slop, 0) : max(b + k + slop + 1, 0)] for k, g in enumerate(gram)):
                    near.add(item)
        out.append((len(w), hit, sorted(owners), sorted(near)))
    return out


def found_rows(docs, items, **options):
    window = options.pop("window", 10)
    index = dc.build_index(docs, block_words=options.pop("block_words", dc.BLOCK_WORDS))
    return dc.search(index, dc.item_windows(items, window=window), **options).collect()


def words_in(spans):
    return {p for s in spans for p in range(s["start"], s["end"])}


def test_given_table_matches_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from read_parquet('{SF}/{name}.parquet')")
    found = op12_decontamination(spark, SF)
    columns = sorted(found.columns)
    expected = con.execute(f"select {', '.join(columns)} from ({ORACLE_SQL['op12_decontamination']})").fetchall()
    assert sorted(found.select(*columns).collect()) == sorted(expected)
    assert any(r.contaminated for r in found.collect())


def random_case(seed):
    rng = random.Random(seed)

    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(["a", "B", "c", "É", "日", "9"]) for _ in range(n))

    docs = [(k, text(rng.choice([0, 1, 2, 3, 5, 30, 60]))) for k in range(40)]
    items = [(k % 9, text(rng.choice([0, 1, 2, 3, 4, 6]))) for k in range(12)]
    return docs, items


def test_random_texts_match_brute_force(spark):
    for seed, slop in ((1, 0), (2, 1), (3, 2)):
        docs, items = random_case(seed)
        expected = {i: b for (i, _), b in zip(docs, brute(docs, items, window=4, slop=slop))}
        d, t = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
        for options in ({}, {"block_words": 7}, {"test_bytes": 300}):  # one block, many index rows, many test blocks
            rows = found_rows(d, t, window=4, slop=slop, **options)
            assert {r.doc_id: (r.n_words, words_in(r.spans), r["items"], r.near_items) for r in rows} == expected
            for r in rows:
                ends = [s["end"] for s in r.spans]
                assert all(s["start"] > e for s, e in zip(r.spans[1:], ends))  # maximal runs


def test_seeds_in_small_parts_change_nothing():
    docs, items = random_case(5)
    block = dc._Block()
    for i, text in docs:
        block.add(i, text.encode())
    _, lengths, *row = block.row()
    pairs = {(" ".join(split(t)[k : k + 4]).encode(), str(i)) for i, t in items for k in range(max(1, len(split(t)) - 3)) if split(t)}
    windows = dc._windows(*map(list, zip(*pairs)))
    postings = dc.Postings.of(windows, lengths, *row)
    whole, parts = ({tuple(map(int, m)) for x in dc.intersect(windows, postings, 0, n) for m in zip(*x)} for n in (1 << 20, 3))
    assert whole == parts and whole


def test_edge_rows(spark):
    items = [(5, "One two three"), (5, "one"), (None, "日本語 😀"), (6, None), (7, " \n"), (8, "word " * 12), (9, "five six"), (10, "x" * 50_000)]
    tests = spark.createDataFrame(items, "item_id long, text string")
    rows = found_rows(clashing(edge_docs(spark)), clashing(tests))
    assert len(rows) == len(edge_rows())
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [(r.n_words, r.spans, r["items"]) for i in (0, 1, 2) for r in by_id[i]] == [(0, [], [])] * 3
    assert [(r["items"], words_in(r.spans)) for r in by_id[3]] == [(["5"], {0})] * 3
    assert (by_id[4][0]["items"], words_in(by_id[4][0].spans)) == (["5", "9"], {0, 1, 2, 4, 5})
    assert by_id[None][0]["items"] == ["5", "9"]
    assert by_id[5][0]["items"] == [""] and by_id[6][0]["items"] == ["10"]
    assert by_id[7][0].n_words == 30_000 and by_id[7][0].spans == [(0, 30_000)]
    empty_tests = spark.createDataFrame([], "item_id long, text string")
    assert {len(r["items"]) for r in found_rows(edge_docs(spark), empty_tests)} == {0}
    assert found_rows(empty_docs(spark), tests) == []


def test_hits_stop_at_documents_and_shared_windows_give_all_items(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, ""), (4, "a b c d")], "doc_id long, text string")
    tests = spark.createDataFrame([(k, "b c") for k in range(30)] + [(99, "a b"), (98, "c d")], "item_id long, text string")
    by_id = {r.doc_id: r for r in found_rows(docs.coalesce(1), tests)}
    assert by_id[1]["items"] == ["99"] and by_id[2]["items"] == ["98"] and by_id[3]["items"] == []
    assert by_id[1].spans == [(0, 2)] and by_id[2].spans == [(0, 2)] and by_id[4].spans == [(0, 4)]
    assert by_id[4]["items"] == sorted([str(k) for k in range(30)] + ["98", "99"])


def test_digest_of_the_query(spark, scratch_dir):
    spark.createDataFrame([(1, "x one two"), (2, "x")], "doc_id long, text string").write.parquet(f"{scratch_dir}/documents.parquet")
    spark.createDataFrame([(10, "one two"), (9, "Two")], "item_id long, text string").write.parquet(f"{scratch_dir}/benchmark.parquet")
    found = {r.doc_id: tuple(r)[1:] for r in op12_decontamination(spark, scratch_dir).collect()}
    assert found[1] == (3, 2, 2, hashlib.sha256(b"10,9").hexdigest(), True)
    assert found[2] == (1, 0, 0, hashlib.sha256(b"").hexdigest(), False)
