"""Registered queries of the text operators, and their SQL where it can state them."""

from __future__ import annotations

from fleetpulse.llm import (
    alignment,
    digests,
    html_text,
    language_id,
    mixing,
    near_dedup,
    packing,
    pii,
    quality_rules,
    seed_extend,
    suffix_dedup,
    toxicity,
    vector_codes,
)
from fleetpulse.llm.common import table


def op1_pii(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op4_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


def op5_near_dedup(spark, sf_dir):
    found = near_dedup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "weight",
                        (found.doc_id == found.class_id).alias("kept"))


def op6_fingerprints(spark, sf_dir):
    return digests.compare_edited(table(spark, sf_dir, "documents"))


def op7_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op9_pack(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op11_align_tokens(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark, sf_dir):
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


def op13_seed_extend(spark, sf_dir):
    return seed_extend.dedup(table(spark, sf_dir, "documents"))


REGISTRY = {
    "op1_pii": op1_pii,
    "op2_toxicity": op2_toxicity,
    "op5_near_dedup": op5_near_dedup,
    "op6_fingerprints": op6_fingerprints,
    "op7_html_text": op7_html_text,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_pack": op9_pack,
    "op10_language_id": op10_language_id,
    "op3_mix_sources": op3_mix_sources,
    "op4_quality_rules": op4_quality_rules,
    "op11_align_tokens": op11_align_tokens,
    "op12_vector_codes": op12_vector_codes,
    "op13_seed_extend": op13_seed_extend,
}

ORACLES = {
    "op4_quality_rules": quality_rules.oracle(),
    "op5_near_dedup": near_dedup.oracle(),
    "op12_vector_codes": vector_codes.oracle(),
    "op13_seed_extend": seed_extend.oracle(),
}
