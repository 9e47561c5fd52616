"""From raw documents to packed training sequences, stage by stage, each written before the next.

Needs the subpackage ``fleetpulse.llm``; a missing folder is an import error here.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.llm import mixing, near_dedup, packing, pii, quality_rules
from fleetpulse.llm.common import shared_folder, table
from fleetpulse.sources.keyed import Files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the threshold table.

    Null, empty and short texts go; repeated rows and ties are judged one by one, a very long text as
    a whole. All columns stay as they are, whatever their names; an empty table gives no rows.
    """
    return quality_rules.keep(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id.

    Of rows with the same doc_id one stays; rows with a null doc_id all stay, and so do texts without
    words, which are copies of nothing. Very long texts are compared whole. Columns stay as they are.
    """
    return near_dedup.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked.

    A null text stays null; every row comes back, repeated ones and very long texts too, with all its
    columns.
    """
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn or repeated so that sources reach their targets.

    A row is left out or repeated up to three times; documents without words are left out. A null
    source is a source. The draw is by hashes of the row, so reruns agree and ties are broken.
    """
    return mixing.resample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences.

    Null and empty texts are pieces of one token, very long ones several; repeated rows are packed as
    rows of their own. Of the columns only doc_id and text are read; no rows give no pieces.
    """
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", dedup),
    ("PII", redact),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: Signatures, the field's decoding, seeded draws and token ids have no SQL; tests/llm holds the whole
#: run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet to the shared folder and reread.

    A stage's table is dropped once the next one is written; the last one stays for the reader.
    """
    docs = table(spark, sf_dir, "documents")
    files = Files(spark, f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}")
    for number, (_, stage) in enumerate(STAGES):
        written = f"{files.root}/{number}"
        stage(spark, docs, sf_dir).write.parquet(written)
        docs = spark.read.parquet(written)
        if number:
            files.delete(str(number - 1))
    return docs
