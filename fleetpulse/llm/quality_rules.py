"""Quality rules (operator 4): a threshold table compiled into one projection.

Every number is a Spark expression over the row itself: no user function, no shuffle. Rules
compare ``100 * numerator`` with ``percent * denominator`` in whole numbers, so that the verdict
does not hang on rounding.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import fenced, text_of, words_of

# The base rule of the contract.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

# Frequent words of the four languages.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on that the this to was with "
    "als auf das dem den der des die ein eine in ist mit nicht sich und von zu im "
    "au avec dans de des du elle en est et la le les par pas pour que qui sur un une "
    "con del el en es esos la las lo los no para por que se su un una y"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a text only if ``low <= 100 * numerator / denominator <= high``."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None


#: The production table. Margins are wide: clean prose is at the far side of each of them.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=200, high=2000),
    Rule("symbols_per_word", "n_symbols", "n_words", high=10),
    Rule("exclamations_per_word", "n_exclamations", "n_words", high=50),
    Rule("stop_words", "n_stop_words", "n_words", low=3),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
)


def _repeat_words(hashes: Column) -> Column:
    """Words in windows whose hash is found at two or more places."""
    places = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def found_again(ordered: Column) -> Column:
        def place(x: Column, k: Column) -> Column:
            again = (F.get(ordered, k - 1)["h"].eqNullSafe(x["h"])
                     | F.get(ordered, k + 1)["h"].eqNullSafe(x["h"]))
            return F.when(again, x["i"])
        return F.array_compact(F.transform(ordered, place))

    # an array of one element binds the sorted array to a name, so that it is sorted once
    windows = F.transform(F.array(F.sort_array(places)), found_again)[0]
    covered = F.flatten(F.transform(windows, lambda i: F.array(i, i + 1, i + 2)))
    return F.size(F.array_distinct(covered))


def measures(docs: DataFrame, text_column: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the whole numbers that the rules compare.

    Adds ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_exclamations``,
    ``n_lines`` (lines with a word), ``n_dup_lines`` (of those, equal to an earlier one),
    ``n_repeat_words`` (words in 3-word windows found twice or more) and ``n_stop_words``, all
    long, each with ``prefix`` before its name; a column of that name is replaced. A null or empty
    text has zeros. Rows are independent, so repeated rows get equal numbers.
    """
    t, w, h = "__quality_text", "__quality_words", "__quality_hashes"
    step = docs.withColumn(t, text_of(text_column))
    step = step.withColumn(w, words_of(F.col(t)))
    n = F.size(w)
    step = step.withColumn(h, F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))))
    lines = F.filter(F.split(F.col(t), "\n"), lambda line: line.rlike("[^ \t-\r]"))
    stop = F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))
    numbers = {
        "n_words": n,
        "word_chars": F.char_length(F.array_join(w, "")),
        "n_symbols": F.regexp_count(t, F.lit(f"[{SYMBOLS}]")),
        "n_exclamations": F.regexp_count(t, F.lit("!")),
        "n_stop_words": F.size(stop),
        "n_repeat_words": F.when(F.size(F.array_distinct(h)) < F.size(h), _repeat_words(F.col(h)))
        .otherwise(0),
    }
    step = step.withColumn("__quality_lines", lines)
    numbers["n_lines"] = F.size("__quality_lines")
    numbers["n_dup_lines"] = F.size("__quality_lines") - F.size(F.array_distinct("__quality_lines"))
    named = {prefix + k: v.cast("long") for k, v in numbers.items()}
    return fenced(step.withColumns(named).drop(t, w, h, "__quality_lines"))


def verdict(rules: tuple[Rule, ...] = RULES, prefix: str = "") -> Column:
    """The threshold table as one condition over the columns of ``measures``."""
    kept = F.lit(True)
    for rule in rules:
        share = 100 * F.col(prefix + rule.numerator)
        whole = F.col(prefix + rule.denominator)
        if rule.low is not None:
            kept = kept & (share >= rule.low * whole)
        if rule.high is not None:
            kept = kept & (share <= rule.high * whole)
    return kept


def base_failed(prefix: str = "") -> Column:
    words, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text",
          prefix: str = "") -> DataFrame:
    """``docs`` with its measures, ``base_failed`` and ``kept``.

    Null and empty texts have no words, so they fail the base rule. All rows are returned.
    """
    judged = measures(docs, text_column, prefix).withColumn(f"{prefix}base_failed",
                                                             base_failed(prefix))
    return judged.withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed")
                             & verdict(rules, prefix))


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    prefix = "__rule_"
    return judge(docs, rules, prefix=prefix).filter(f"{prefix}kept").select(
        *(F.col(f"`{c}`") for c in docs.columns))


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The query op4_quality_rules in DuckDB's SQL, measured another way (rows, not arrays)."""
    tests = [f"100 * {r.numerator} >= {r.low} * n_words".replace("* n_words", f"* {r.denominator}")
             for r in rules if r.low is not None]
    tests += [f"100 * {r.numerator} <= {r.high} * {r.denominator}"
              for r in rules if r.high is not None]
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[ \\t-\\r]+'),
        lambda x: x <> '') AS words FROM t),
one AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
gram AS (SELECT a.doc_id, a.i, a.word || ' ' || b.word || ' ' || c.word AS g
  FROM one a JOIN one b ON a.doc_id = b.doc_id AND b.i = a.i + 1
  JOIN one c ON a.doc_id = c.doc_id AND c.i = a.i + 2),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM gram),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM again, (VALUES (0), (1), (2)) AS o(k) WHERE n >= 2 GROUP BY doc_id),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM line WHERE regexp_matches(line, '[^ \\t-\\r]') GROUP BY doc_id),
counts AS (SELECT w.doc_id, len(words) AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
    (length(text) - length(replace(text, '!', '')))::BIGINT AS n_exclamations,
    len(list_filter(words, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
    AND {' AND '.join(tests)} AS kept
FROM counts"""
