"""Language ID (operator 10): Bayesian fusion of four kinds of evidence.

Text gives the likelihood of each language; what a page declares in its markup and the ending of its
address are worth what they have been worth over the corpus; and a host has a prior, smoothed towards
its domain and that towards all rows. These worths and priors are sums over all rows, grouped by the
declared language, the ending, the host and the domain, of what the texts alone say.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.llm.arrowtext import mix, steps, text_bytes
from fleetpulse.llm.common import checkpoint
from fleetpulse.llm.html_text import visible_text

#: Labelled documents of each language that the likelihoods are learned from, at most, and the longest
#: one of them. Every label that occurs is learned.
SAMPLE, SAMPLE_CHARS = 300, 20_000
GRAM_ROWS = 1 << 16
#: Neighbouring triplets tell much the same: a text counts as this share of its triplets, and a long
#: one as this many, so that the other evidence is never drowned altogether.
INDEPENDENT, MOST_TRIPLETS = 0.25, 200.0
#: Rows that a prior is worth at each level: host towards domain, domain towards all.
PRIOR_ROWS = 5.0

_LOWER = np.arange(256, dtype="uint8")
_LOWER[ord("A"):ord("Z") + 1] += 32
_LOWER[[*range(0x21, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80), 9, 10, 13]] = 0x20


def _triplets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every byte triplet inside a row, letters lower-case, all else a space."""
    if len(data) < 3:
        return np.zeros(0, dtype="int64"), np.zeros(0, dtype="int64")
    x = _LOWER[data].astype("uint64")
    h = x[:-2] | x[1:-1] << np.uint64(8) | x[2:] << np.uint64(16)
    h = (mix(h) & np.uint64(GRAM_ROWS - 1)).astype("int64")
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = rows[:-2] == rows[2:]
    return h[inside], rows[:-2][inside]


@dataclass(frozen=True)
class Likelihoods:
    languages: tuple[str, ...]
    table: np.ndarray  # log probability of each triplet for each language

    def logs(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tempered log likelihood of each row for each language, the best at 0."""
        h, rows = _triplets(data, offsets)
        n, k = len(offsets) - 1, len(self.languages)
        sums = np.stack([np.bincount(rows, weights=self.table[h, j], minlength=n)
                         for j in range(k)], axis=1) if k else np.zeros((n, 0))
        count = np.bincount(rows, minlength=n)
        worth = np.minimum(count * INDEPENDENT, MOST_TRIPLETS) / np.maximum(count, 1)
        sums = sums * worth[:, None]  # sums of nothing are whole numbers
        return sums - sums.max(axis=1, keepdims=True) if k else sums


def learn(docs: DataFrame, sample: int = SAMPLE, most_chars: int = SAMPLE_CHARS) -> Likelihoods:
    """Triplet likelihoods of every label in ``lang``, each from a bounded sample of its rows.

    A label whose texts are all longer than ``most_chars`` is learned from their beginnings.
    """
    known = docs.filter("lang IS NOT NULL AND length(text) > 0")
    fits = F.length("text") <= most_chars
    found = known.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(fits).alias("short"))
    labels = checkpoint(found)
    names = [r.lang for r in labels.orderBy(F.desc("n"), "lang").select("lang").collect()]
    draw = F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")), F.lit(9))
    # by hash first, some four times the sample of each label, so that few rows are sorted
    rows = F.when(F.col("short") > 0, F.col("short")).otherwise(F.col("n"))
    share = F.least(F.lit(1.0), F.lit(4.0 * sample) / rows)
    lowest = F.pmod(draw, F.lit(1 << 40)) < (share * F.lit(float(1 << 40))).cast("long") + 1
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))
    taken = (known.join(F.broadcast(labels), "lang").filter((fits | (F.col("short") == 0)) & lowest)
             .select("lang", draw.alias("draw"), F.substring("text", 1, most_chars).alias("text"))
             .withColumn("place", place).filter(F.col("place") <= sample).select("lang", "text"))

    def count(rows: pa.Table) -> pa.Table:
        data, offsets = text_bytes(pa.concat_arrays(rows["text"].chunks))
        counts = 0.05 + np.bincount(_triplets(data, offsets)[0], minlength=GRAM_ROWS)
        logs = np.log(counts / counts.sum()).astype("float32")
        return pa.table({"lang": pa.array([rows["lang"][0].as_py()], pa.string()),
                         "logs": pa.array([logs.tobytes()], pa.binary())})

    # by language in memory, as that is how it is read
    table = np.full((GRAM_ROWS, len(names)), -np.log(GRAM_ROWS), dtype="float32", order="F")
    number = {name: j for j, name in enumerate(names)}
    for r in taken.groupBy("lang").applyInArrow(count, "lang string, logs binary").toLocalIterator():
        table[:, number[r.lang]] = np.frombuffer(r.logs, dtype="float32")
    return Likelihoods(tuple(names), table)


def page_evidence(pages: DataFrame) -> DataFrame:
    """``kind``, ids, html, host, domain, ending and declared language of every page.

    The host is what stands between ``://`` and the next ``/``, ``?``, ``#`` or ``:``; its domain is
    its last two labels. The ending is the host's last label with the first path part of two
    letters, if there is one. All are null where the address has none.
    """
    host = F.nullif(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?"
                                             r"([^/?#:@]+)", 1)), F.lit(""))
    part = F.nullif(F.lower(F.regexp_extract("url", r"://[^/?#]*(?:/[^/?#]*)*?/([A-Za-z]{2})(?:[/?#]|$)", 1)),
                    F.lit(""))
    declared = F.nullif(F.lower(F.regexp_extract(
        "html", r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})\b", 1)), F.lit(""))
    return pages.select(
        F.lit("page").alias("kind"), F.lit(None).cast("long").alias("doc_id"),
        F.col("page_id").cast("long").alias("page_id"), F.col("html").alias("text"),
        host.alias("host"), F.substring_index(host, ".", -2).alias("domain"),
        F.concat_ws("/", F.substring_index(host, ".", -1), part).alias("ending"),
        declared.alias("declared"))


def document_evidence(docs: DataFrame) -> DataFrame:
    """The same for documents: their source stands for the host; they declare nothing.

    The label ``lang`` is not evidence.
    """
    nothing = F.lit(None).cast("string")
    return docs.select(
        F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("doc_id"),
        F.lit(None).cast("long").alias("page_id"), "text", F.col("source").alias("host"),
        F.lit("documents").alias("domain"), nothing.alias("ending"), nothing.alias("declared"))


def _text_logs(rows: DataFrame, model: Likelihoods) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            names = batch.schema.names
            texts = batch.column(names.index("text"))
            if any(k == "page" for k in batch.column(names.index("kind")).unique().to_pylist()):
                kinds = batch.column(names.index("kind")).to_pylist()
                texts = pa.array([visible_text(t) if k == "page" else t or ""
                                  for k, t in zip(kinds, texts.to_pylist())],
                                 type=pa.large_string())
            logs = shared.value.logs(*text_bytes(texts))
            width = logs.shape[1]
            flat = pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1, dtype="int32") * width),
                pa.array(logs.ravel()))
            kept = [c for n, c in zip(names, batch.columns) if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*kept, flat], names=[*(n for n in names if n != "text"), "logs"])

    return rows.mapInArrow(run, "kind string, doc_id long, page_id long, host string, "
                                "domain string, ending string, declared string, "
                                "logs array<double>")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, also where ``body`` is a function of elements."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def fuse(rows: DataFrame, model: Likelihoods) -> DataFrame:
    """The most likely language of every row of evidence.

    Returns kind, doc_id, page_id, lang, confidence (its probability), text_lang (by the text
    alone, null without triplets), declared. A row's own text is left out of its host's and
    domain's sums. Missing evidence counts nothing: null and empty texts go by the rest, a row
    without any by the prior of all rows. Repeated rows get equal results; without labelled rows
    to learn from, lang is null.
    """
    k = len(model.languages)
    if not k:
        return rows.select("kind", "doc_id", "page_id", F.lit(None).cast("string").alias("lang"),
                           F.lit(0.0).alias("confidence"),
                           F.lit(None).cast("string").alias("text_lang"), "declared")
    read = checkpoint(_text_logs(rows, model))
    # the best log is 0
    read = read.withColumn("own", _let(F.transform("logs", F.exp), lambda parts: _let(
        _sum(parts), lambda total: F.transform(parts, lambda p: p / total))))
    own_sums = F.array(*(F.sum(F.get("own", F.lit(j))) for j in range(k)))

    def sums(key: str) -> DataFrame:
        return read.filter(F.col(key).isNotNull()).groupBy(key).agg(
            F.count("*").alias(f"{key}_n"), own_sums.alias(f"{key}_own"))

    out = read
    for key in ("host", "domain", "ending", "declared"):
        out = out.join(sums(key), key, "left")
    everything = read.agg(F.count("*"), own_sums).first()
    total = everything[0] or 1
    overall = [((x or 0.0) + 1.0) / (total + k) for x in everything[1]]

    def smoothed(key: str, j: Column, prior: Column) -> Column:
        here = F.coalesce(f"{key}_n", F.lit(1)) - 1
        own = F.get("own", j)
        seen = F.greatest(F.coalesce(F.get(f"{key}_own", j), own) - own, F.lit(0.0))
        return (seen + PRIOR_ROWS * prior) / (here + PRIOR_ROWS)

    def worth(key: str, j: Column, overall_j: Column) -> Column:
        """Log of how much likelier the value is under this language than under all."""
        rate = (F.get(f"{key}_own", j) + overall_j) / (total * overall_j + 1.0)
        average = (F.col(f"{key}_n") + 1.0) / (total + 1.0)
        return F.coalesce(F.log(rate / average), F.lit(0.0))

    def fused(overall_j: Column, j: Column) -> Column:
        prior = smoothed("host", j, smoothed("domain", j, overall_j))
        return (F.get("logs", j) + F.log(F.greatest(prior, F.lit(1e-9)))
                + worth("ending", j, overall_j) + worth("declared", j, overall_j))

    def name_of(values: str) -> Column:
        best = F.array_position(values, F.array_max(values)).cast("int")
        return F.element_at(F.lit(list(model.languages)), best)

    out = out.withColumn("fused", F.transform(F.lit(overall), fused))
    confidence = _let(F.array_max("fused"), lambda top: 1.0 / _sum(
        F.transform("fused", lambda x: F.exp(x - top))))
    has_text = F.array_min("logs") < 0
    return out.select(
        "kind", "doc_id", "page_id", name_of("fused").alias("lang"), confidence.alias("confidence"),
        F.when(has_text, name_of("own")).alias("text_lang"), "declared")


def identify(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Languages of all documents and all pages; likelihoods from the documents' labels."""
    rows = document_evidence(docs).unionByName(page_evidence(pages))
    return fuse(rows, learn(docs))
