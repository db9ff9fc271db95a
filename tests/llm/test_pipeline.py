"""The pipeline against plain rules, stage by stage, and on edge rows."""

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from strata.llm import mixing, pii, simhash, toxicity
from strata.llm.common import staged
from strata.llm.registry import tokenizer_path
from tests.llm.cases import SF, edge_docs, empty_docs
from tests.llm.test_simhash import brute_components, brute_fingerprint

COLUMNS = list(corpus_pipeline.COLUMNS)


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = [r.asDict() for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF))
        out[name] = [r.asDict() for r in docs.collect()]
        assert name == "bpe" or docs.columns == COLUMNS
    return out


def test_toxicity_only_drops(stages, spark):
    before = {d["doc_id"]: d for d in stages["documents"]}
    kept = {d["doc_id"]: d for d in stages["toxicity"]}
    assert all(before[i] == d for i, d in kept.items())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(labels.get(i) != 0 for i in before.keys() - kept.keys())


def test_one_of_each_group_stays(stages):
    rows = stages["toxicity"]
    ids = [d["doc_id"] for d in rows]
    groups = brute_components([brute_fingerprint(d["text"]) for d in rows], ids)
    assert {d["doc_id"] for d in stages["near_dedup"]} == set(groups)
    assert len(stages["near_dedup"]) == len(set(groups))


def test_personal_data_is_masked_and_all_else_kept(stages):
    before = {d["doc_id"]: d for d in stages["near_dedup"]}
    assert len(stages["pii"]) == len(before)
    changed = 0
    for d in stages["pii"]:
        old = before[d["doc_id"]]
        changed += d["text"] != old["text"]
        assert d["text"] == old["text"] or any(f"[{k.name.upper()}]" in d["text"] for k in pii.KINDS)
        assert d["text"] == old["text"] or d["n_chars"] == len(d["text"])
        assert [d[c] for c in ("lang", "source")] == [old[c] for c in ("lang", "source")]
    assert changed


def test_last_stage_encodes_what_the_mix_takes(stages):
    library = Tokenizer.from_file(tokenizer_path())
    mixed = sorted(
        hashlib.sha256(np.array(library.encode(d["text"], add_special_tokens=False).ids, "<u4").tobytes()).hexdigest() for d in stages["mixing"]
    )
    assert sorted(d["ids_sha256"] for d in stages["bpe"]) == mixed


def test_run_gives_the_stages_result_again(stages, spark):
    rows = sorted((r.doc_id, r.ids_sha256) for r in entry.queries()["pipeline"](spark, SF).collect())
    assert rows == sorted((d["doc_id"], d["ids_sha256"]) for d in stages["bpe"])


def test_edge_rows_pass_every_stage(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, SF))
            if name in ("toxicity", "pii"):
                assert docs.columns == COLUMNS


def test_stages_call_the_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "pii", "mixing", "bpe"]
    for module, function in ((toxicity, "score"), (simhash, "keep_one"), (pii, "redact"), (mixing, "mixed_rows")):
        assert callable(getattr(module, function))
