import hashlib
import random
import time

import numpy as np
import pytest
from tokenizers import Tokenizer

from strata.llm import bpe
from strata.llm.registry import op7_bpe, tokenizer_path
from tests.llm.cases import EDGE_TEXTS, SF, clashing, edge_docs, edge_rows, empty_docs


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def model():
    return bpe.WordBpe(bpe.load(tokenizer_path()))


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_texts_match_the_library(library, model):
    rng = random.Random(1)
    letters = "aeiourstnlhe'!?.<|>é0 1ßΣ́\n😀 ​\x1c"
    texts = [t for t in EDGE_TEXTS if t is not None]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 120))) for _ in range(500)]
    texts += ["".join(rng.choice("ab") for _ in range(30)) for _ in range(100)]
    texts += [" ".join(rng.sample(list(library.get_vocab()), 100)) for _ in range(50)]
    texts += ["<|endoftext|>a<|startoftext|>b<|ENDOFTEXT|>", "don't we'll I'VE 's", "</w>x</w>"]
    encoded = library.encode_batch(texts, add_special_tokens=False)
    for text, packed, whole in zip(texts, model.encode_all(texts), encoded):
        assert ids_of(packed) == whole.ids, text[:80]
        assert model.decode(packed) == library.decode(whole.ids, skip_special_tokens=False)


def test_compatible_pairs_are_those_that_merging_keeps(model):
    """The vectorised check against exact merging of the two tokens' bytes."""
    rng = random.Random(2)
    inner = [(raw, i) for raw, i in model.inner.items() if len(raw) > 1]
    final = [(raw, i) for raw, i in model.final.items() if len(raw) > 1]
    pairs = [(rng.choice(inner), rng.choice(final)) for _ in range(3000)]
    ok = model.compatible(np.array([a for (_, a), _ in pairs]), np.array([b for _, (_, b) in pairs]))
    for ((left, a), (right, b)), good in zip(pairs, ok):
        assert (model.merge(left + right) == [a, b]) == good


def test_memo_overflow_gives_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 8)
    model = bpe.WordBpe(bpe.load(tokenizer_path()))
    texts = ["the quick brown fox jumps over the lazy dog again and again " * 3, "un deux trois quatre", "the fox"]
    for text, packed in zip(texts, model.encode_all(texts)):
        assert ids_of(packed) == library.encode(text, add_special_tokens=False).ids


def test_query_on_the_given_table(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op7_bpe(spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edge_rows(spark):
    path = tokenizer_path()
    found = bpe.decode(bpe.encode(clashing(edge_docs(spark)), path), path).collect()
    assert len(found) == len(edge_rows())
    assert all(r.n_tokens == 0 and r.decoded == "" for r in found if r.doc_id in (0, 1, 2))
    both = bpe.encode(clashing(edge_docs(spark)), path, decoded_col="decoded").collect()
    assert sorted(map(str, both)) == sorted(map(str, found))
    assert bpe.encode(empty_docs(spark), path).count() == 0


def test_long_unbroken_words_match_the_library_in_linear_time(library, model):
    rng = random.Random(7)
    seconds = []
    for n in (50_000, 200_000):
        word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
        started = time.process_time()
        (packed,) = model.encode_all([word])
        seconds.append(time.process_time() - started)
        assert ids_of(packed) == library.encode(word, add_special_tokens=False).ids
    assert seconds[1] < 12 * seconds[0] + 1  # four times the letters
    for n in (100, 127, 128, 129, 130, 500):  # both ways of finding the next merge
        for letters in ("ab", "aeiourst", "é日a"):
            word = "".join(rng.choice(letters) for _ in range(n))
            (packed,) = model.encode_all([word])
            assert ids_of(packed) == library.encode(word, add_special_tokens=False).ids
