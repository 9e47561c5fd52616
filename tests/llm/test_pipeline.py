"""The pipeline against each stage's rule, stage by stage, and its last rows as a whole."""

import test_near_dedup
import test_quality_rules

import __spark_entry__ as entry_points
import corpus_pipeline
from fleetpulse.llm import packing, pii


def test_stages_follow_their_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        tables.append(stage(spark, tables[-1], sf_dir).cache())
        assert tables[-1].columns == columns
    start, passed, single, clean, mixed = [t.collect() for t in tables]

    for r in start:
        words, chars, symbols, _, repeated = test_quality_rules.counted(r.text)
        if words < 50 or 100 * repeated > 50 * words or 100 * symbols > 10 * words:
            assert r not in passed
    classes = test_near_dedup.all_pairs({r.doc_id: r.text for r in passed})
    assert sorted(r.doc_id for r in single) == sorted(set(classes.values()))
    assert {r.doc_id: r.source for r in clean} == {r.doc_id: r.source for r in single}
    for r in clean:
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in clean}
    assert set(mixed) <= set(clean)

    pieces = packing.pack(tables[-1]).collect()
    assert sum(r.length for r in pieces) == sum(
        len(packing.encoder(packing.TOKENIZER)(r.text)) + 1 for r in mixed)


def test_run_is_the_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = entry_points.queries()["pipeline"](spark, sf_dir).select(*key).collect()
    assert sorted(got) == sorted(docs.select(*key).collect())


def test_operators_are_registered():
    names = set(entry_points.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert "pipeline" in names
