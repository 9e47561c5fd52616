"""Small helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the only separator of words in this folder.
SPACE = r"[ \t-\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share: ``spark.checkpoint.dir``, or what the context has.

    Where the session names none and none was set, it is a folder in the warehouse, which all
    machines share too; only a session on one machine gets a temporary folder, as in tests.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root and context.master.startswith("local["):
            root = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(root or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the shared folder, reread from there.

    For wide or packed rows, which take a fraction of a checkpoint's room in columns.
    """
    folder = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fenced(df: DataFrame) -> DataFrame:
    """``df``, through which later filters are not pushed.

    A pushed filter takes the whole expressions of the columns it names with it, and they would be
    worked out again for every mention. A row number that is not known when planning stops that.
    """
    fence = "__fence"
    return df.withColumn(fence, F.monotonically_increasing_id()).filter(
        F.col(fence) >= 0).drop(fence)


def drawn(draw: Column, wanted: int, rows: int) -> Column:
    """Whether a row's draw, a hash, is among the lowest: of ``rows`` about four times ``wanted`` are.

    Put before a sorted limit, it keeps what every task sends for the sort in proportion to the
    sample and not to the number of tasks.
    """
    share = min(1.0, 4 * wanted / max(rows, 1))
    return F.pmod(draw, F.lit(1 << 40)) < F.lit(int(share * (1 << 40)) + 1)


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text."""
    return F.array_remove(F.split(text, SPACE), "")


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with the dense row number 0.. along ``order``, without a one-task window.

    Rows are dealt by range; a row's number is its place in its partition plus the rows of the
    partitions before. The driver sees one count per partition.
    """
    pid, place = f"__{name}_pid", f"__{name}_place"
    dealt = checkpoint(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(pid, F.spark_partition_id())
        .withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    before, total = [], 0
    for part, rows in sorted((r[0], r[1]) for r in dealt.groupBy(pid).count().collect()):
        before.append((part, total))
        total += rows
    starts = df.sparkSession.createDataFrame(before, f"{pid} int, __{name}_start long")
    return (dealt.join(starts, pid).withColumn(name, F.col(place) + F.col(f"__{name}_start"))
            .drop(pid, place, f"__{name}_start"))
