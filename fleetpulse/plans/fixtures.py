"""Topics and tables of the fleet, derived from the given synthetic tables.

Messages are JSON text, so every query decodes what it reads. The rules are plain arithmetic on ids,
so the same figures can be computed from the raw columns by another engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse import schemas
from fleetpulse.functions import times
from fleetpulse.operators import replication
from fleetpulse.sources import topics

TIME_SCALE = 600
BASE_MILLIS = 1_704_067_200_000  # 2024-01-01T00:00:00Z


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a given table, which is one small file, dealt out for work that is heavy per row."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read(spark, sf_dir, "events"))


def _text(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _envelope(df: DataFrame, schema, fields: dict[str, Column], *extra) -> DataFrame:
    """(seq, record_ts, extra..., value): the fields the source gives as JSON; others are absent."""
    known = [fields[f.name].cast(f.dataType).alias(f.name)
             for f in schema.fields if f.name in fields]
    return df.select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("record_ts"), *extra,
        F.to_json(F.struct(*known)).alias("value"))


def _status() -> Column:
    kind = F.col("event_type")
    return (F.when(kind == "error", "FAILURE").when(kind.isin("purchase", "signup"), "SUCCESS")
            .when(kind == "click", "RUNNING"))


def _mode_json(empty_rule: Column | None = None) -> Column:
    n = F.col("event_id")
    mode = _text("m", n % 4)
    if empty_rule is not None:
        mode = F.when(empty_rule, "").otherwise(mode)
    return F.when(n % 5 == 0, "{}").otherwise(
        F.to_json(F.struct(F.struct(mode.alias("mode")).alias("extra_args"))))


def workflow_topic(events: DataFrame, *extra: Column, clash: bool = False) -> DataFrame:
    """``clash``: every ninth profile has a number where the others have an object."""
    n, u = F.col("event_id"), F.col("user_id")
    bags = F.transform(
        F.filter(F.array(*[F.lit(i) for i in range(3)]), lambda i: i < n % 4),
        lambda i: F.when((n + i) % 3 == 0, "").otherwise(_text("bag-", i)))
    profile = F.struct(
        F.struct(F.col("value").alias("total")).alias("total"),
        F.struct((F.col("value") / 2).alias("cpu")).alias("load"))
    summary = F.to_json(F.struct(profile.alias("bags_profile_summary")))
    if clash:
        other = F.struct(profile["total"].alias("total"), F.col("value").alias("load"))
        summary = F.when(n % 9 == 0, F.to_json(F.struct(other.alias("bags_profile_summary")))
                         ).otherwise(summary)
    updated = times.to_text(F.col("ts"))
    return _envelope(events, schemas.WORKFLOW_MESSAGE, {
        "workflow_id": _text("wf-", u),
        "workflow_type": F.when(u % 3 == 0, "replay").when(u % 3 == 1, "probe_detect")
        .otherwise("convert"),
        "category": _text("cat", u % 4),
        "device": _text("dev", u % 2),
        "bag_nums": n % 5,
        "workflow_input": _mode_json(),
        "workflow_output": F.when(n % 7 == 0, "{}").otherwise(
            F.to_json(F.struct(bags.alias("bag_replayed_list")))),
        "workflow_status": _status(),
        "create_time": updated,
        "update_time": updated,
        "metric": F.when(n % 6 == 0, "{}").otherwise(summary),
    }, *extra)


def arrival(ts: str = "ts") -> Column:
    n = F.col("event_id") % 50
    late = F.when(n == 0, F.expr("INTERVAL 60 HOURS")).when(n == 1, F.expr("INTERVAL 20 HOURS"))
    return F.col(ts) + F.coalesce(late, F.expr("INTERVAL 0 HOURS"))


def bag_topic(events: DataFrame, *extra: Column) -> DataFrame:
    n, u, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    return _envelope(events, schemas.BAG_MESSAGE, {
        "result_id": _text("r-", n),
        "pod_id": _text("wf-", u),
        "type": F.when(kind == "click", "convert").otherwise("replay"),
        "status": F.when(kind == "error", "FAILURE").otherwise("SUCCESS"),
        "pod_start_timestamp": times.epoch_seconds(F.col("ts")),
        "group": F.when(u % 4 == 0, "cp").when(u % 4 == 1, "CP").when(u % 4 == 2, "g2"),
        "output_bag": F.when(kind == "error", "").when(kind != "view", _text("out/", n)),
        "error_type": F.when(kind == "error", _text("E", n % 3)).when(kind != "view", ""),
        "error_stage": _text("s", n % 2),
        "metric": F.when(n % 6 == 0, "{}").otherwise(
            F.to_json(F.struct(F.col("value").alias("bag_duration")))),
        "backtrace": F.when(n % 2 != 0, F.when(n % 9 == 0, "").otherwise(_text("trace ", n))),
        "config": _mode_json(n % 11 == 0),
    }, *extra)


def node_topic(events: DataFrame, *extra: Column) -> DataFrame:
    kind = F.col("event_type")
    return _envelope(events, schemas.NODE_MESSAGE, {
        "cluster_name": _text("c", F.col("user_id") % 2),
        "node_name": _text("n", F.col("user_id") % 20),
        "msg": F.col("props"),
        "msg_level": F.when(kind.isin("error", "click"), "fault").when(kind == "view", "health")
        .otherwise("odd"),
        "fault_type": _text("f", F.col("event_id") % 3),
        "timestamp": times.epoch_seconds(F.col("ts")),
    }, *extra)


def job_topic(events: DataFrame) -> DataFrame:
    n, kind = F.col("event_id"), F.col("event_type")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    millis = F.lit(BASE_MILLIS) + F.floor((micros - BASE_MILLIS * 1000) / (TIME_SCALE * 1000))
    return _envelope(events, schemas.JOB_MESSAGE, {
        "node_name": _text("n", F.col("user_id")),
        "job_status": F.when(kind == "purchase", "successed").when(kind != "signup", "failed"),
        "job_name": F.when(n % 4 == 0, "a-b").otherwise(
            F.concat(_text("a-b-c-wf", n % 40), F.lit("-replay"))),
        "timestamp": millis.cast("bigint").cast("string"),
    })


def pod_topic(events: DataFrame) -> DataFrame:
    return _envelope(events, schemas.POD_MESSAGE, {
        "pod_id": _text("wf-", F.col("user_id")),
        "status": _status(),
        "job_start_timestamp": times.epoch_seconds(F.col("ts")),
        "group": _text("cat", F.col("user_id") % 4),
        "log": F.col("props"),
    })


def workflow_messages(spark, sf_dir, *extra: Column) -> DataFrame:
    raw = workflow_topic(events(spark, sf_dir), *extra)
    return topics.messages(raw, schemas.WORKFLOW_MESSAGE)


def bag_messages(spark, sf_dir) -> DataFrame:
    return topics.messages(bag_topic(events(spark, sf_dir)), schemas.BAG_MESSAGE)


def node_messages(spark, sf_dir) -> DataFrame:
    return topics.messages(node_topic(events(spark, sf_dir)), schemas.NODE_MESSAGE)


def job_messages(spark, sf_dir) -> DataFrame:
    return topics.messages(job_topic(events(spark, sf_dir)), schemas.JOB_MESSAGE)


def pod_messages(spark, sf_dir) -> DataFrame:
    return topics.messages(pod_topic(events(spark, sf_dir)), schemas.POD_MESSAGE)


def _typed(df: DataFrame, schema, fields: dict[str, Column]) -> DataFrame:
    return df.select(*[
        fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def workflow_table(spark, sf_dir, prepare=lambda df: df, category: bool = True) -> DataFrame:
    """Workflows from orders; ``category`` costs a join, which can be left out (then it is null)."""
    rows = prepare(read(spark, sf_dir, "orders"))
    status = F.col("o_orderstatus")
    if category:
        segment = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
        rows = rows.join(segment, F.col("o_custkey") == F.col("c_custkey"), "left")
    else:
        rows = rows.withColumn("c_mktsegment", F.lit(None).cast("string"))
    return _typed(rows, schemas.WORKFLOW_TABLE, {
        "workflow_id": F.col("o_orderkey"),
        "workflow_type": F.lit("replay"),
        "workflow_name": _text("order ", F.col("o_orderkey")),
        "user": F.col("o_custkey"),
        "workflow_status": F.when(status == "F", "FAILURE").when(status == "O", "SUCCESS")
        .otherwise("RUNNING"),
        "tag": F.col("o_orderpriority"),
        "create_time": F.col("o_orderdate"),
        "update_time": F.col("o_orderdate"),
        "category": F.col("c_mktsegment"),
        "upload_ttl": F.col("o_totalprice") / 1000,
        "bag_nums": F.col("o_orderkey") % 5,
    })


def result_table(spark, sf_dir) -> DataFrame:
    """Children of workflows. Line numbers repeat within an order, so there is no unique id."""
    return _typed(read(spark, sf_dir, "lineitem"), schemas.RESULT_TABLE, {
        "id": F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
                          F.col("l_suppkey")),
        "log": F.col("l_linestatus"),
        "create_time": F.col("l_shipdate"),
        "update_time": F.col("l_shipdate"),
        "workflow_id_id": F.col("l_orderkey"),
        "error_type": F.col("l_returnflag"),
    })


def numbered_results(spark, sf_dir) -> DataFrame:
    """Results with a unique id: repeated (order, line) pairs are numbered by their other columns."""
    lines = read(spark, sf_dir, "lineitem")
    pair = ["l_orderkey", "l_linenumber"]
    n = F.row_number().over(Window.partitionBy(*pair).orderBy(
        *[c for c in lines.columns if c not in pair]))
    rows = lines.withColumn("n", n)
    return _typed(rows, schemas.RESULT_TABLE, {
        "id": F.concat_ws("-", *pair, "n"),
        "log": F.col("l_linestatus"),
        "create_time": F.col("l_shipdate"),
        "update_time": F.col("l_shipdate"),
        "workflow_id_id": F.col("l_orderkey"),
        "error_type": F.col("l_returnflag"),
    })


def altered_results(results: DataFrame) -> DataFrame:
    """The other side of a results check: orders left out, a changed log, a missing error type."""
    key = F.col("workflow_id_id").cast("bigint")
    return results.filter(key % 97 != 0).withColumns({
        "log": F.when(key % 89 == 0, "changed").otherwise(F.col("log")),
        "error_type": F.when(key % 83 != 0, F.col("error_type")),
    })


def lake_copy(spark, sf_dir, category: bool = True) -> DataFrame:
    """The lake side of the workflow table with gaps, changes and rows of its own."""
    key = F.col("workflow_id").cast("bigint")
    lake = replication.to_lake_workflow(workflow_table(spark, sf_dir, category=category))
    altered = (
        lake.withColumn("bag_nums", F.when(key % 89 == 0, F.col("bag_nums") + 1)
                        .otherwise(F.col("bag_nums")))
        .withColumn("_tag", F.when(key % 83 != 0, F.col("_tag")))
    )
    extra = lake.filter(key < 5).withColumn("workflow_id", F.concat(F.lit("x"), "workflow_id"))
    return altered.filter(key % 97 != 0).unionByName(extra)


def change_log(spark, sf_dir) -> DataFrame:
    """JSON change rows: insert all, update every third, delete every tenth as its last change."""
    table = workflow_table(spark, sf_dir, spread)
    key = F.col("workflow_id").cast("bigint")
    fields = [F.col(c) for c in table.columns]
    changed = [
        (F.col("upload_ttl") + 1).alias(c) if c == "upload_ttl" else F.col(c)
        for c in table.columns
    ]
    old, new = F.struct(*fields), F.struct(*changed)
    none = F.lit(None).cast(schemas.WORKFLOW_TABLE)

    def change(op, step, before, after):
        return F.struct(
            F.lit(op).alias("op"), (key * 4 + step).alias("seq"),
            before.cast(schemas.WORKFLOW_TABLE).alias("before"),
            after.cast(schemas.WORKFLOW_TABLE).alias("after"))

    third, tenth = key % 3 == 0, key % 10 == 0
    rows = F.array_compact(F.array(
        change("c", 0, none, old),
        F.when(third, change("ub", 1, old, none)),
        F.when(third, change("u", 2, none, new)),
        F.when(tenth, change("d", 3, F.when(third, new).otherwise(old), none)),
    ))
    return table.select(F.explode(rows).alias("change")).select(
        F.col("change.seq").alias("seq"), F.to_json("change").alias("value"))


def altered_statistics(stats: DataFrame) -> DataFrame:
    """A second side for comparison: even days differ by one, one group is missing."""
    even = F.dayofmonth("stat_date") % 2 == 0
    return stats.filter(F.element_at("path", 1) != "g2").withColumn(
        "value", F.when(even, F.col("value") + 1).otherwise(F.col("value")))


def probe_outputs(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    marked = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" ERR!")))
    return docs.select("doc_id", F.coalesce(marked, "text").alias("text"))
