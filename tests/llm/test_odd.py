"""Each operator and stage on odd, repeated, missing and clashing input."""

import odd
import pytest

import corpus_pipeline
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
)


def labels(spark, rows=((1, 0), (7, 1), (8, 0), (10, 1), (4, 1), (None, 1), (11, None))):
    return spark.createDataFrame([(i, 1, t) for i, t in rows],
                                 "doc_id long, quality int, toxic int")


def pages(spark, docs):
    return docs.selectExpr("doc_id AS page_id", "'http://h.example.com/en/1' AS url", "text AS html")


OPERATORS = {
    "pii": pii.find,
    "toxicity": lambda d: toxicity.judge(d, labels(d.sparkSession)),
    "mixing": mixing.mix,
    "quality": lambda d: quality_rules.judge(d.select("doc_id", "text")),
    "near_dedup": near_dedup.classes,
    "digests": digests.compare_edited,
    "html": lambda d: html_text.extract(pages(d.sparkSession, d)),
    "suffix": suffix_dedup.dedup,
    "alignment": alignment.align,
    "seed_extend": seed_extend.dedup,
    "language": lambda d: language_id.fuse(language_id.document_evidence(d), language_id.learn(d)),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_every_row_comes_back(spark, name):
    docs = odd.odd_documents(spark)
    plain = odd.rows(OPERATORS[name](docs))
    assert len(plain) == docs.count()
    # columns with clashing names change nothing
    assert odd.rows(OPERATORS[name](odd.with_extra(docs))) == plain


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    empty = odd.odd_documents(spark).limit(0)
    assert OPERATORS[name](empty).count() == 0


def blanks(spark):
    """Blank texts in partitions of their own, and two texts after them."""
    rows = [(i, text, "en", "s", 0) for i, text in enumerate(
        [None, "", " ", "\n", "a", "é", "", None])]
    rows += [(90, odd.PLAIN, "en", "t", 1), (91, odd.LONG, "de", "t", 1)]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), odd.SCHEMA)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_blank_partitions(spark, name):
    docs = blanks(spark)
    assert docs.rdd.getNumPartitions() >= 9
    assert OPERATORS[name](docs).count() == docs.count()
    assert OPERATORS[name](docs.filter("doc_id < 90")).count() == 8


def test_identify_blank_and_odd_pages(spark):
    docs = blanks(spark)
    odd_pages = spark.createDataFrame(
        [(1, None, None), (2, "", ""), (3, "no address", "<p>"), (None, "http://a.example.com/en/x", None),
         (4, "http://a.example.com", "<html lang='en'><p>" + odd.PLAIN)],
        "page_id long, url string, html string")
    for some in (docs, docs.filter("doc_id < 90"), docs.limit(0)):
        got = language_id.identify(odd.with_extra(some), odd.with_extra(odd_pages))
        assert got.count() == some.count() + 5
        assert language_id.identify(some, odd_pages.limit(0)).count() == some.count()


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stage_on_blanks(spark, sf_dir, stage):
    step = dict(corpus_pipeline.STAGES)[stage]
    for docs in (blanks(spark), blanks(spark).filter("doc_id < 90")):
        kept = {r.doc_id for r in step(spark, docs, sf_dir).select("doc_id").collect()}
        assert kept <= {r.doc_id for r in docs.collect()}


def test_packing_of_odd_rows(spark):
    docs = odd.odd_documents(spark)
    got = odd.rows(packing.pack(odd.with_extra(docs)), "doc_id", "piece", "start", "length")
    assert got == odd.rows(packing.pack(docs), "doc_id", "piece", "start", "length")
    assert {r[0] for r in got} == {r[0] for r in docs.select("doc_id").collect()}
    assert packing.pack(docs.limit(0)).count() == 0


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_keeps_columns(spark, sf_dir, stage):
    step = dict(corpus_pipeline.STAGES)[stage]
    docs = odd.with_extra(odd.odd_documents(spark))
    out = step(spark, docs, sf_dir)
    assert out.columns == docs.columns
    assert out.filter("size <> 'extra size'").count() == 0
    assert step(spark, docs.limit(0), sf_dir).count() == 0
