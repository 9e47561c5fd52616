"""Nested maps kept as long rows ``(keys..., path array<string>, value)``.

The path form lets partial aggregation and the shuffle do what a recursive map merge would do on
one machine; the JSON form is built only for the final, per-statistic record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NODE = "array<struct<path:array<string>,node:variant>>"


def _children(text: Column) -> Column:
    return F.transform(
        F.map_entries(F.from_json(text, "map<string,variant>")),
        lambda e: F.struct(F.array(e["key"]).alias("path"), e["value"].alias("node")),
    )


def _as_map(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _described(x: Column) -> Column:
    """path, kind, value, text of a node with its ``shape`` (the schema text of its variant)."""
    shape, node = x["shape"], x["node"]
    kind = (
        F.when(shape.startswith("OBJECT"), "object")
        .when(shape.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"), "number")
        .otherwise("other")
    )
    flag = F.try_variant_get(node, "$", "boolean").cast("int").cast("double")
    number = F.when(shape == "BOOLEAN", flag).otherwise(F.try_variant_get(node, "$", "double"))
    return F.struct(
        x["path"].alias("path"),
        kind.alias("kind"),
        F.when(kind == "number", number).alias("value"),
        F.when(kind == "other", F.to_json(node)).alias("text"),
    )


def nodes(json_text: Column) -> Column:
    """Every node of a JSON object: ``array<struct<path, kind, value double, text string>>``.

    ``kind`` is ``number``, ``object`` or ``other``. The fold goes down one level per step, so the
    text is parsed once; a text has no more levels than opening braces, which bounds the steps.
    """
    empty = F.array().cast(_NODE)
    top = F.struct(
        F.coalesce(_children(json_text), empty).alias("level"), empty.alias("seen"))

    def below(level: Column) -> Column:
        return F.flatten(F.transform(level, lambda x: F.coalesce(
            F.transform(
                F.map_entries(_as_map(x["node"])),
                lambda e: F.struct(
                    F.concat(x["path"], F.array(e["key"])).alias("path"),
                    e["value"].alias("node"))),
            empty)))

    def down(acc: Column, _: Column) -> Column:
        return F.when(F.size(acc["level"]) > 0, F.struct(
            below(acc["level"]).alias("level"),
            F.concat(acc["seen"], acc["level"]).alias("seen"))).otherwise(acc)

    def finish(acc: Column) -> Column:
        shaped = F.transform(acc["seen"], lambda x: F.struct(
            x["path"].alias("path"), x["node"].alias("node"),
            F.schema_of_variant(x["node"]).alias("shape")))
        return F.transform(shaped, _described)

    braces = F.length(json_text) - F.length(F.replace(json_text, F.lit("{")))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.coalesce(braces, F.lit(1)), F.lit(1))),
                       top, down, finish)


def explode_nodes(df: DataFrame, json_column: str, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.inline(nodes(F.col(json_column))))


def add_at_path(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of ``value`` per path."""
    return df.groupBy(*keys, "path").agg(F.sum("value").alias("value"))


def overwrite_at_path(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last ``value`` per path."""
    return df.groupBy(*keys, "path").agg(F.max_by("value", order).alias("value"))


def deep_sum(df: DataFrame, keys: list[str], order: str, clashes: str = "resolve") -> DataFrame:
    """Recursive sum of nested maps, given their nodes (see :func:`explode_nodes`).

    Input: ``keys..., order, path, kind, value, text``. Numbers at the same path add up. Where a
    path changes kind (number, object, other), what came before the change is discarded, and a
    non-number is replaced by the newer one. Output: ``keys..., path, value, text``.

    ``resolve`` first finds, per path, the last record of another kind than the newest (``cut``),
    and drops what lies before it, there and below. Only paths at or below such a change reach the right
    side of the join, one row each; with steady layouts it is empty. The raw side is on the left,
    where a hot key can be split. ``fail`` saves the first pass: one aggregation, and an
    error if any path has two kinds.
    """
    def last_of(kind):
        return F.max(F.when(F.col("kind") == kind, F.col(order)))

    if clashes == "fail":
        mixed = F.count_if(F.col("kind") == "number") * F.count_if(F.col("kind") != "number") + (
            F.count_if(F.col("kind") == "object") * F.count_if(F.col("kind") == "other"))
        error = F.raise_error(F.concat(F.lit("path of two kinds: "), F.array_join("path", ".")))
        return (
            df.groupBy(*keys, "path")
            .agg(F.sum("value").alias("value"), F.max_by("text", order).alias("text"),
                 mixed.alias("mixed"))
            .withColumn("value", F.when(F.col("mixed") > 0, error.cast("double"))
                        .otherwise(F.col("value")))
            .filter(F.col("value").isNotNull() | F.col("text").isNotNull()).drop("mixed")
        )
    if clashes != "resolve":
        raise ValueError("clashes must be 'resolve' or 'fail'")

    newest = F.array_sort(F.array_compact(F.array(
        *[last_of(k) for k in ("number", "object", "other")])))
    paths = df.groupBy(*keys, "path").agg(newest.alias("newest"))
    cuts = paths.filter(F.size("newest") > 1).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("path").alias("_prefix"),
        F.element_at("newest", -2).alias("cut"))
    # a path is cut by the last change of kind at any place on the way to it
    prefixes = F.transform(F.sequence(F.lit(1), F.size("path")),
                           lambda n: F.slice("path", F.lit(1), n))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    cut = (
        paths.select(*keys, "path", F.explode(prefixes).alias("prefix"))
        .join(cuts, [*same, F.col("prefix") == F.col("_prefix")])
        .groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.col("path").alias("_path"))
        .agg(F.max("cut").alias("cut"))
    )
    leaves = (
        df.filter(F.col("kind") != "object")
        .join(cut, [*same, F.col("path") == F.col("_path")], "left")
        .filter(F.col("cut").isNull() | (F.col(order) > F.col("cut")))
    )
    return leaves.groupBy(*keys, "path").agg(
        F.sum("value").alias("value"), F.max_by("text", order).alias("text"))


def json_key(c: Column) -> Column:
    quoted = F.to_json(F.array(c))
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)


def json_number(c: Column) -> Column:
    """Whole numbers without a fraction, others as doubles."""
    whole = (c == F.rint(c)) & (F.abs(c) < F.lit(9.2e18))
    return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def nest_to_json(df: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """Rows ``keys..., path, value`` to one JSON object per key, built from the deepest level up.

    A record is one dashboard entry, so its size is bounded by its distinct paths, not by the
    rows that were summed into it. All levels share the one shuffle on ``keys``.
    """
    checked = F.when(
        F.size("path") > depth,
        F.raise_error(F.lit(f"path longer than {depth}")).cast("string"),
    ).otherwise(json_number(F.col("value")))
    level = df.repartition(*keys).select(*keys, "path", checked.alias("body"))
    for d in range(depth, 0, -1):
        here = F.size("path") >= d
        rows = level.select(
            *keys,
            F.when(here, F.slice("path", 1, d - 1)).otherwise(F.col("path")).alias("parent"),
            F.when(here, F.concat(json_key(F.element_at("path", -1)), F.lit(":"), "body"))
            .alias("entry"),
            F.when(~here, F.col("body")).alias("leaf"),
        )
        members = F.array_join(F.array_sort(F.collect_list("entry")), ",")
        level = rows.groupBy(*keys, F.col("parent").alias("path")).agg(
            F.coalesce(F.first("leaf", ignorenulls=True),
                       F.concat(F.lit("{"), members, F.lit("}"))).alias("body"))
    return level.select(*keys, F.col("body").alias("info"))
