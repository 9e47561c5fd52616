"""Text rules: first-match tags, levels, value maps, alert lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
LOG_MARKERS = ("A", "B", "C")
LOG_FALLBACK = "D"
PROBE_ERROR_MARK = "err!"
GROUP_ALIASES = {"cp": "CP"}
FAULT_SENTENCE = "FAULT! %s on machine %s in cluster %s found at %s."
RECOVERY_SENTENCE = (
    "Recovery! %s on machine %s in cluster %s recovered at %s. Fault duration: %d minutes.")


def first_match_tag(
    c: Column, markers: Sequence[str] = LOG_MARKERS, otherwise: str = LOG_FALLBACK
) -> Column:
    """The first marker, in the given order, that occurs in the text."""
    hits = [F.when(c.contains(m), F.lit(m)) for m in markers]
    return F.coalesce(*hits, F.lit(otherwise))


def probe_level(c: Column) -> Column:
    return F.when(F.lower(c).contains(PROBE_ERROR_MARK), "fault").otherwise("health")


def map_values(c: Column, aliases: Mapping[str, str]) -> Column:
    out = c
    for old, new in aliases.items():
        out = F.when(c == old, F.lit(new)).otherwise(out)
    return out


def name_part(c: Column, index: int, sep: str = "-") -> Column:
    """Zero-based part of a separated name; null when the name is too short."""
    return F.get(F.split(c, sep), F.lit(index))


def fault_text(fault_type: Column, node: Column, cluster: Column, at: Column) -> Column:
    return F.format_string(FAULT_SENTENCE, fault_type, node, cluster, at)


def recovery_text(
    fault_type: Column, node: Column, cluster: Column, at: Column, minutes: Column
) -> Column:
    return F.format_string(RECOVERY_SENTENCE, fault_type, node, cluster, at, minutes)


def percent_difference(left: Column, right: Column) -> Column:
    """100 * (left - right) / right, two decimals, half to even; null for a zero base."""
    return F.bround(F.try_divide((left - right).cast("double"), right.cast("double")) * 100, 2)
