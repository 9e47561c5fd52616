"""Quality rules against plain Python, and the compiled table against its SQL."""

import re
from collections import Counter

import odd
import oracle

from fleetpulse.llm import quality_rules
from fleetpulse.llm.queries import ORACLES, REGISTRY

SPACE = re.compile(r"[ \t-\r]+")


def counted(text):
    words = [w for w in SPACE.split(text or "") if w]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    again = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if SPACE.sub("", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(again))


def test_measures_as_counted(spark):
    docs = odd.odd_documents(spark)
    got = quality_rules.measures(docs).select(
        "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    for row in got:
        assert tuple(row)[1:] == counted(row.text)


def test_sql(spark, sf_dir):
    name = "op4_quality_rules"
    con = oracle.connect(sf_dir)
    assert oracle.compare(spark, con, REGISTRY[name], ORACLES[name], sf_dir) is None


def test_labelled_quality(spark, sf_dir):
    """Junk by the labels goes, clean documents of enough words stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality_rules.judge(docs).join(labels, "doc_id")
    assert judged.filter("quality = 0 AND kept").count() == 0
    assert judged.filter("quality = 1 AND NOT base_failed AND NOT kept").count() == 0


def test_keep_runs_no_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = quality_rules.keep(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
