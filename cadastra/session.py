"""Session settings the plans count on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings that only change physical planning, never results.
PLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the split costs a later exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Do not run a (property, date) step on a placement by property alone.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    # A shuffle is dealt finely and put together again by size, so that a task sorts about as much whatever the input:
    # the rows of billing days take some hundred times their shuffled bytes in the sorts and windows of one stage, and the
    # tasks of an executor share its memory. Above 2000 partitions Spark no longer keeps the size of each.
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    # A task sorts what it read to aggregate or deal it out, so it reads a bounded part of a table too.
    "spark.sql.files.maxPartitionBytes": "32m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the planning settings above plus UTC on ``spark`` and return it."""
    for key, value in PLANNING.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder of the cluster (``spark.checkpoint.dir``); a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="cadastra-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir()


_SCOPE: ContextVar[str | None] = ContextVar("scope", default=None)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """What ``written`` writes inside goes when the block ends, also by an error; of nested ones the outermost counts.

    For steps whose results are stored elsewhere by then. A driver that is lost leaves the folder ``scope-...``.
    """
    if _SCOPE.get():
        yield
        return
    path = f"{work_dir(spark)}/scope-{uuid.uuid4().hex}"
    token = _SCOPE.set(path)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: Spark removes the shuffle files of an execution at its end, not when the driver's garbage collection finds them unused.
OWN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: A stage that does more steps for each row it reads takes smaller parts (see ``PLANNING``).
BY_PROPERTY = {"spark.sql.requireAllClusterKeysForDistribution": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m"}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def own_shuffles(spark: SparkSession):
    """Shuffle files of what is written inside go with each write, so steps that follow each other don't add up on disk.

    For writes only: they plan a table anew, so nothing reads these files again.
    """
    return _settings(spark, {OWN_SHUFFLES: "true"})


def placed_by_property(spark: SparkSession):
    """What is written inside may run its (property, date) steps on a placement by property, without another shuffle.

    For tables of which a property has a few rows a date, once raw rows have been brought to that.
    """
    return _settings(spark, BY_PROPERTY)


def written(df: DataFrame, *by: str) -> DataFrame:
    """``df`` written as parquet in the work folder and read back: short lineage, column pruning, statistics.

    With columns ``by``, rows lie in one folder per value and the others are not opened by a filter on them.
    """
    spark = df.sparkSession
    path = f"{_SCOPE.get() or work_dir(spark)}/cut-{uuid.uuid4().hex}"
    with own_shuffles(spark):
        df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` when it has at most ``max_rows`` rows, else return it without a hint.

    The rows are read once (``limit`` bounds what reaches the driver) and handed back as a local relation.
    """
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(table, schema=df.schema))
