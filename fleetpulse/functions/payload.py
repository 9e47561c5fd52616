"""Fields inside the JSON text columns of messages. All JVM-side expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: JSON texts that count as "no bag" (null, empty text, zero, false, empty containers),
# as a variant is written back.
FALSY_JSON = ("null", '""', "0", "0.0", "-0.0", "false", "[]", "{}")


def mode_of(config: Column) -> Column:
    return F.get_json_object(config, "$.extra_args.mode")


def bag_list(workflow_output: Column) -> Column:
    """The replayed bags as an array of variants; an absent list is empty."""
    parsed = F.from_json(workflow_output, "bag_replayed_list array<variant>")
    return F.coalesce(parsed["bag_replayed_list"], F.array().cast("array<variant>"))


def truthy(v: Column) -> Column:
    return ~F.coalesce(F.to_json(v), F.lit("null")).isin(*FALSY_JSON)


def count_bags(bags: Column) -> Column:
    """``struct<n_ok, n_bad>``: truthy and other elements, in one pass."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n_ok"), F.lit(0).cast("bigint").alias("n_bad"))

    def add(acc: Column, v: Column) -> Column:
        ok = truthy(v).cast("bigint")
        return F.struct((acc["n_ok"] + ok).alias("n_ok"), (acc["n_bad"] + 1 - ok).alias("n_bad"))

    return F.aggregate(bags, zero, add)


def profile_of(metric: Column) -> Column:
    """The free-form profile object, still as JSON text."""
    return F.get_json_object(metric, "$.bags_profile_summary")


def duration_of(metric: Column) -> Column:
    return F.get_json_object(metric, "$.bag_duration").try_cast("double")


def malformed(c: Column) -> Column:
    """Null or unparsable JSON text."""
    return F.try_parse_json(c).isNull()


def split_rejects(df: DataFrame, json_columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose JSON columns all parse, the others); keep the second as a rejects table."""
    bad = reduce(lambda a, b: a | b, [malformed(F.col(c)) for c in json_columns])
    return df.filter(~bad), df.filter(bad)
