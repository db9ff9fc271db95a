import random

import numpy as np
import xxhash

from strata.llm import simhash
from strata.llm.registry import op6_simhash
from tests.llm.cases import SF, clashing, edge_docs, edge_rows, empty_docs, lower_ascii, words


def brute_fingerprint(text, shingle=4):
    w = words(lower_ascii(text))
    grams = [" ".join(w[k : k + shingle]) for k in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints, ids, budget=4):
    keys = np.array(prints, np.uint64)
    label = list(range(len(keys)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for k in range(len(keys)):
        for j in np.flatnonzero(np.bitwise_count(keys[k + 1 :] ^ keys[k]) <= budget) + k + 1:
            label[max(root(k), root(int(j)))] = min(root(k), root(int(j)))
    lowest = {}
    for k, i in enumerate(ids):
        if i is not None:
            lowest[root(k)] = min(i, lowest.get(root(k), i))
    return [lowest.get(root(k)) for k in range(len(keys))]


def test_given_table_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    prints = [brute_fingerprint(t) for _, t in rows]
    expected = {i: (f"{f:016x}", c) for (i, _), f, c in zip(rows, prints, brute_components(prints, [i for i, _ in rows]))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in op6_simhash(spark, SF).collect()} == expected


def test_edge_rows(spark):
    found = simhash.near_duplicates(clashing(edge_docs(spark))).collect()
    assert len(found) == len(edge_rows())
    by_id = {r.doc_id: r for r in found}
    assert by_id[0].fp == by_id[1].fp == by_id[2].fp == 0  # null, empty and blank
    assert by_id[0].component_id == by_id[2].component_id == 0
    assert by_id[None].component_id == 4  # the same text under an id
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


def test_links_of_near_fingerprints_and_split_cells(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = {centre}
    while len(prints) < 300:  # one dense group, far from the rest
        flipped = centre
        for bit in rng.sample(range(64), rng.randint(1, 6)):
            flipped ^= 1 << bit
        prints.add(flipped)
    prints |= {rng.getrandbits(64) for _ in range(700)}
    prints = sorted(prints)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    expected = brute_components(prints, prints)
    for cell_rows in (16, 1024):  # split cells, and whole ones
        links = simhash.fingerprint_links(df, 4, cell_rows=cell_rows).collect()
        assert len(links) < 20_000
        label = {p: p for p in prints}

        def root(p, label=label):
            while label[p] != p:
                p = label[p]
            return p

        for r in links:
            a, b = root(r.u % (1 << 64)), root(r.v % (1 << 64))
            label[max(a, b)] = min(a, b)
        assert [root(p) for p in prints] == expected


def test_trie_join_equals_all_pairs():
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 1 << 20, 400, dtype=np.uint64) << np.uint64(44))
    keys = np.unique(keys)
    labels = simhash.trie_links(keys, [(0, len(keys), 0, len(keys))], 3, leaf=4, width=50)
    expected = brute_components(keys.tolist(), list(range(len(keys))), 3)
    assert labels.tolist() == expected


def test_one_row_of_each_group_stays(spark):
    kept = simhash.keep_one(edge_docs(spark)).collect()
    assert sorted((r.doc_id for r in kept if r.doc_id is not None)) == [0, 3, 4, 5, 6, 7]
    assert len(kept) == 6
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}
    assert simhash.keep_one(empty_docs(spark)).count() == 0


def test_the_trie_prunes_in_the_cells_of_the_given_table(spark):
    prints = simhash.fingerprints(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    keys = np.unique(np.array([r.fp for r in prints.select("fp").collect()], np.int64).view(np.uint64))
    assert simhash.route_bits(len(keys), simhash.CELL_ROWS) == 1  # two cells a block
    counts = {}
    labels = simhash.trie_links(keys, [(0, len(keys), 0, len(keys))], 4, counts=counts)
    assert labels.tolist() == brute_components(keys.tolist(), list(range(len(keys))), 4)
    assert counts["descended"] > 100_000 and counts["pruned"] > 100_000
    assert counts["compared"] < 0.4 * len(keys) ** 2 / 2


def test_cells_keep_their_size_as_the_table_grows():
    for n in (10_000, 200_000, 5_000_000, 60_000_000):
        assert 4000 < n / 2 ** simhash.route_bits(n, 8192) <= 8192
    assert [simhash.route_bits(n, 1024) for n in (0, 1, 1024, 1025, 10**12)] == [0, 0, 0, 1, 13]
