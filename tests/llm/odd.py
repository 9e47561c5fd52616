"""Odd documents that every operator has to take."""

from __future__ import annotations

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} of{i % 13} the{i}" for i in range(30_000))
PLAIN = ("the quiet river went by the old mill and the people of the town came to see it in the "
         "evening when the light was low and the air was still and clear over the wide green "
         "fields that lay between the road and the hills to the north of the place")
EXTRA = ("size", "taken", "target", "source_size", "id", "draw", "row", "grp", "node", "bucket",
         "component", "words", "n_words", "kept", "score", "spans", "piece", "start", "length",
         "branch", "shard", "carried", "tie", "place", "ord", "w", "token")


def odd_documents(spark):
    rows = [
        (1, PLAIN, "en", "a", 1), (2, PLAIN, "en", "a", 1),        # an exact copy
        (3, PLAIN.replace("wide green", "broad brown"), "en", None, 1),   # a near copy
        (4, None, None, None, None), (5, "", "en", "b", 0), (6, " \t\n\r\x0b\x0c ", "de", "b", 7),
        (7, LONG, "en", "b", len(LONG)), (8, "x", "fr", "c", 1),
        (9, "café \U0001f600 naïve 你好", "fr", "c", 5),
        (9, "café \U0001f600 naïve 你好", "fr", "c", 5),     # a repeated row
        (None, PLAIN, "en", "a", 3), (None, None, None, None, None),
        (10, "write to ann@example.org or +1 (555) 010-9999 from 10.0.0.1", "en", "c", 2),
        (11, "a\nb\na\n\n" * 40, "es", "d", 3), (12, "!" * 5000, "es", "d", 3),
        (13, "<|endoftext|> is a name", "en", "d", 3),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def with_extra(docs):
    return docs.withColumns({c: F.lit(f"extra {c}") for c in EXTRA})


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()),
                  key=repr)
