"""JSON topics as named rows. A topic is Kafka where its connector is installed, else text files.

File topics hold one JSON object per line with ``seq`` (arrival order), ``record_ts`` (record time)
and ``value`` (the message text), so both kinds decode through the same code.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetpulse.functions.times import parse_text
from fleetpulse.schemas import layout

ENVELOPE = layout("seq long, record_ts timestamp, value string")
CORRUPT = "_corrupt_record"
PARTITION_ROOM = 1 << 20


def start_options(
    start: datetime | str | None = None, group_prefix: str | None = None
) -> dict[str, str]:
    """Kafka start position: a time, ``earliest`` or ``latest`` (default).

    A query that has a checkpoint goes on from there, whatever is set here.
    """
    opts = {}
    if isinstance(start, datetime):
        opts["startingTimestamp"] = str(int(start.timestamp()) * 1000)
        opts["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        opts["startingOffsets"] = start or "latest"
    if group_prefix:
        opts["groupIdPrefix"] = group_prefix
    return opts


def kafka_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    start: datetime | str | None = None,
    options: Mapping[str, str] | None = None,
    stream: bool = True,
) -> DataFrame:
    """``(seq, record_ts, value)``; ``seq`` follows the offsets, so it orders each partition.

    Offsets of different partitions say nothing about each other: the arrival order over a whole topic
    is ``(record_ts, seq)``. Producers must key the topic by workflow or machine, as any per-key
    order needs. Up to ``PARTITION_ROOM`` partitions get distinct numbers.
    """
    reader = spark.readStream if stream else spark.read
    if start is None and not stream:
        start = "earliest"
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, **start_options(start),
            **(options or {})}
    raw = reader.format("kafka").options(**opts).load()
    return raw.select(
        (F.col("offset") * PARTITION_ROOM + F.col("partition")).alias("seq"),
        F.col("timestamp").alias("record_ts"), F.col("value").cast("string").alias("value"))


def file_topic(
    spark: SparkSession,
    path: str,
    start: datetime | None = None,
    files_per_trigger: int | None = None,
    stream: bool = True,
) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).schema(ENVELOPE)
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    raw = reader.json(path)
    return raw if start is None else raw.filter(F.col("record_ts") >= F.lit(start))


def decode(raw: DataFrame, schema: StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """Envelope columns plus the message fields. Missing fields are null.

    PERMISSIVE keeps a malformed text in ``_corrupt_record`` with all fields null; FAILFAST fails.
    The row is taken out through ``inline``, which later filters are not pushed through: each text
    is parsed once, not once more per filter.
    """
    meta = [c for c in raw.columns if c != "value"]
    if mode == "FAILFAST":
        row = F.from_json("value", schema, {"mode": "FAILFAST"})
    else:
        wide = StructType(list(schema.fields)).add(CORRUPT, "string")
        row = F.from_json(
            "value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return raw.select(*meta, F.inline(F.array(row)))


def good(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt(decoded: DataFrame) -> DataFrame:
    meta = [c for c in ("seq", "record_ts") if c in decoded.columns]
    return decoded.filter(F.col(CORRUPT).isNotNull()).select(*meta, CORRUPT)


def rejects(
    decoded: DataFrame, time_field: str | None = None,
    read_time: Callable[[Column], Column] = parse_text,
) -> DataFrame:
    """Rows that the jobs can't use, with the reason: malformed, untimed or badly timed ones.

    ``time_field`` is the field that has the message's time, if the job goes by it, and ``read_time``
    gives the time that the job reads there.
    """
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed")
    if time_field:
        reason = (reason.when(F.col(time_field).isNull(), "no time")
                  .when(read_time(F.col(time_field)).isNull(), "bad time"))
    fields = [c for c in decoded.columns if c not in ("seq", "record_ts", CORRUPT)]
    return decoded.withColumn("reason", reason).filter("reason IS NOT NULL").select(
        "seq", "record_ts", "reason",
        F.coalesce(CORRUPT, F.to_json(F.struct(*fields))).alias("value"))


def messages(raw: DataFrame, schema: StructType) -> DataFrame:
    """Decoded rows without the malformed ones."""
    return good(decode(raw, schema))
