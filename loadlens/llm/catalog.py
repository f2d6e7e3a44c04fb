"""Registered queries of the thirteen operators and the pipeline, with their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from loadlens.llm import (conversations, decontaminate, language_model, mixing, near_vectors, repeats, rule_quality, secrets,
                          shingle_join, token_counts, toxicity, vector_codes, whitening)
from loadlens.llm.tables import table


def op1_secret_novelty(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_chat_snapshots(spark, sf_dir):
    return conversations.render(table(spark, sf_dir, "conversations"))


def op3_suffix_repeats(spark, sf_dir):
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op4_near_vectors(spark, sf_dir):
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_recurrent_lm(spark, sf_dir):
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op6_unigram_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op7_shingle_jaccard_join(spark, sf_dir):
    return shingle_join.shingle_join(table(spark, sf_dir, "documents"))


def op8_toxicity_nnpu(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pfair_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op10_benchmark_alignment(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark, sf_dir):
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_rule_quality(spark, sf_dir):
    return rule_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_polarisation_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_secret_novelty, op2_chat_snapshots, op3_suffix_repeats, op4_near_vectors, op5_recurrent_lm, op6_unigram_token_counts,
    op7_shingle_jaccard_join, op8_toxicity_nnpu, op9_pfair_mixing, op10_benchmark_alignment, op11_vector_codes,
    op12_rule_quality, op13_polarisation_whitening,
)} | {"pipeline": corpus_pipeline.run}

ORACLE: dict[str, str] = {"op2_chat_snapshots": conversations.SQL, "op11_vector_codes": vector_codes.SQL}
