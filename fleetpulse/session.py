"""One place for session settings; every endpoint and credential is a parameter."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def catalog_conf(name: str, options: Mapping[str, str]) -> dict[str, str]:
    """Settings that register a lake catalog.

    ``options`` holds ``class`` (the catalog implementation) and whatever that implementation
    needs, e.g. ``type``, ``uri`` and ``warehouse``.
    """
    opts = dict(options)
    conf = {f"spark.sql.catalog.{name}": opts.pop("class")}
    conf.update({f"spark.sql.catalog.{name}.{k}": v for k, v in opts.items()})
    return conf


def session_conf(timezone: str = "UTC", extra: Mapping[str, str] | None = None) -> dict[str, str]:
    conf = {
        "spark.sql.session.timeZone": timezone,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # rows are costly (JSON): where there are few, keep all cores busy after a shuffle; larger
        # shuffles are above this size anyway
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        # call sites of column expressions are not looked up: building a plan takes a third
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    conf.update(extra or {})
    return conf


def build_session(
    app: str = "fleetpulse",
    master: str | None = None,
    timezone: str = "UTC",
    catalogs: Mapping[str, Mapping[str, str]] | None = None,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = session_conf(timezone, extra)
    for name, options in (catalogs or {}).items():
        conf.update(catalog_conf(name, options))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names for checkpoints; ``fallback`` only where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not root:
        raise ValueError("spark.checkpoint.dir is not set and no fallback folder was given")
    return root
