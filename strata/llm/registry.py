"""The queries of this subpackage: thin derivations of the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import ann, bpe, decontamination, divergence, licenses, lm, mixing, pii, quality, simhash, topk, toxicity, whitening
from strata.llm.common import fold_of, pick, read_table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, and all spans."""
    found = pii.personal_data(read_table(spark, sf_dir, "documents"))
    counts = [pii.count_spans("base", kind).alias(f"n_{kind}") for kind in pii.BASE]
    digest = F.sha2(pii.span_text("base"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.span_text("spans").alias("spans"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, by weights 5, 2, 1 of the sources."""
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of every document, and the places of the base phrases."""
    found = licenses.scan(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text, learnt from the rows whose fold is not 1."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold_of("doc_id") == 1
    model = lm.fit(docs, ~held_out)
    return lm.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of every document, learnt from labelled rows whose fold is not 0.

    Grades: 0 poor quality, 1 good but toxic, 2 good; ``tail`` is the probability of 1 or more.
    """
    docs, labels = read_table(spark, sf_dir, "documents"), pick(read_table(spark, sf_dir, "labels"), "doc_id", "quality", "toxic")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    model = quality.fit(docs, labels, grade, fold_of("doc_id") != 0, levels=3)
    graded = quality.grade_rows(docs, model)
    return graded.select(
        "doc_id", (fold_of("doc_id") == 0).alias("held_out"), "expected_grade", "tail",
        F.col("tail").alias("score"), (F.col("tail") >= 0.5).cast("int").alias("predicted"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: 4-word shingles, at most 4 differing bits."""
    groups = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def tokenizer_path() -> str:
    """The word-level tokenizer file of the installed public collection."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text decoded from them, as digests."""
    encoded = bpe.encode(read_table(spark, sf_dir, "documents"), tokenizer_path(), decoded_col="decoded")
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labelled rows whose fold is not 0."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), fold_of("doc_id") != 0)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest found of every 50th vector."""
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products of every 100th vector."""
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every vector, fitted on the distinct integer vectors."""
    vectors = read_table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    rows = whitening.whiten(vectors, model)
    parts = rows.select("vec_id", "n", "deviation", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part"))
    return parts.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "part.whitened", "part.explained",
        F.lit(model.identity_error).alias("identity_error"),
    )


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 10-word passages of the benchmark, and the items they come from."""
    index = decontamination.build_index(read_table(spark, sf_dir, "documents"))
    found = decontamination.search(index, decontamination.item_windows(read_table(spark, sf_dir, "benchmark")))
    n_hit = decontamination.n_hit("spans")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and its most telling terms."""
    return divergence.audit(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_mixing": op2_mixing,
    "op3_licenses": op3_licenses,
    "op4_lm": op4_lm,
    "op5_quality": op5_quality,
    "op6_simhash": op6_simhash,
    "op7_bpe": op7_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_ann": op9_ann,
    "op10_topk": op10_topk,
    "op11_whitening": op11_whitening,
    "op12_decontamination": op12_decontamination,
    "op13_divergence": op13_divergence,
}

# queries that SQL can express; the others are held against brute force in tests/llm
ORACLE_SQL: dict[str, str] = {
    "op2_mixing": mixing.mix_sql(),
    "op10_topk": topk.top_k_sql(),
    "op12_decontamination": decontamination.decontaminate_sql(),
    "op13_divergence": divergence.audit_sql(),
}
