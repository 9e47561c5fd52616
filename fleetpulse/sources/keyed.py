"""Read a keyed folder: a table of current rows, kept as sorted runs under a versioned manifest.

``<folder>/_manifests/<version>.json`` names the table's key, its sequence column, its layout and the
runs it consists of. A run is a folder of Parquet files, sorted by key, that is never changed. Readers go
by the newest manifest, or by one they choose, and take the newest image of each key over all runs; so
they see whole commits only, whatever a writer left behind.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"
#: Column of a run: the key was deleted at this sequence number.
GONE = "_gone"


@dataclass(frozen=True)
class Run:
    folder: str
    bytes: int
    rows: int


@dataclass(frozen=True)
class Manifest:
    """One version of a table; ``runs`` are the oldest (and largest) first."""

    version: int
    keys: tuple[str, ...]
    seq: str
    schema: str
    runs: tuple[Run, ...]

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def of(text: str) -> Manifest:
        found = json.loads(text)
        return Manifest(found["version"], tuple(found["keys"]), found["seq"], found["schema"],
                        tuple(Run(**r) for r in found["runs"]))


class Files:
    """A folder through the file system that Spark reaches it by."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self.root = spark._jvm, root
        self._fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def names(self, name: str) -> list[str]:
        if not self.exists(name):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self.path(name))]

    def size(self, name: str) -> int:
        return self._fs.getContentSummary(self.path(name)).getLength()

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self.path(name), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def rename(self, name: str, to: str) -> None:
        """Atomic on a file system like HDFS; there a name that is taken is an error too."""
        if self.exists(to) or not self._fs.rename(self.path(name), self.path(to)):
            raise FileExistsError(f"{self.root}/{to} was written by someone else")

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)


def versions(files: Files) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in files.names(MANIFESTS)
                  if n.removesuffix(".json").isdigit())


def manifest_name(version: int) -> str:
    return f"{MANIFESTS}/{version:012d}.json"


def manifest(files: Files, version: int | None = None) -> Manifest | None:
    """A version of the table, by default the newest; None if nothing was committed."""
    if version is None:
        found = versions(files)
        if not found:
            return None
        version = found[-1]
    return Manifest.of(files.read(manifest_name(version)))


def is_keyed(spark: SparkSession, folder: str) -> bool:
    return bool(versions(Files(spark, folder)))


def images(spark: SparkSession, folder: str, table: Manifest, runs: tuple[Run, ...]) -> DataFrame:
    """All images of some runs, with ``_gone``."""
    layout = StructType.fromJson(json.loads(table.schema))
    wide = StructType([*layout.fields]).add(GONE, "boolean")
    return spark.read.schema(wide).parquet(*(f"{folder}/{r.folder}" for r in runs))


def newest(rows: DataFrame, table: Manifest) -> DataFrame:
    """The last image of each key, a deletion after an image of the same number."""
    keys = list(table.keys)
    rest = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(
        F.struct(*rest), F.struct(table.seq, F.coalesce(GONE, F.lit(False)))).alias("_row"))
    return last.select(*keys, "_row.*").select(*rows.columns)


def keyed_rows(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The current rows of a keyed folder."""
    table = manifest(Files(spark, folder), version)
    if table is None:
        raise ValueError(f"{folder} has no committed version")
    rows = images(spark, folder, table, table.runs)
    if len(table.runs) > 1:
        rows = newest(rows, table)
    return rows.filter(f"NOT coalesce({GONE}, false)").drop(GONE)
