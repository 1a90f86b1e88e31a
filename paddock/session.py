"""Session settings and the shared folder for durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession

# Runtime settings every plan here counts on. forceOptimizeSkewedJoin lets AQE
# split a hot join partition even where that costs one more exchange above it.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method of more bytes than this; a stage that would be one runs operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session built elsewhere."""
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("paddock")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the call site of every column costs more driver time than planning.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for name, value in RUNTIME.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; a temporary one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="paddock-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Store a result in the shared folder, so a lost executor cannot undo or change it."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def staged(df: DataFrame) -> DataFrame:
    """Write a result as Parquet into the shared folder, for readers that want few of its columns."""
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Shuffle files of a query that has ended are else kept until the driver's memory fills and its references are collected.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders stored since the innermost open scratch() or settled() began, none where no one is open.
_stored: ContextVar[list[str] | None] = ContextVar("stored", default=None)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside give up their shuffle files as they end. A write plans its rows anew, so no one reads these again."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def packed(df: DataFrame, codec: str | None = "zstd") -> DataFrame:
    """As staged, in little room: closely compressed, without the shuffle files, and gone with the scratch() it is in.

    Files are read in the order of their sizes; without a codec of its own a result keeps the order staged() gives it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    stored = _stored.get()
    if stored is not None:
        stored.append(path)
    with shuffles_dropped(spark):
        (df.write if codec is None else df.write.option("compression", codec)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def released(df: DataFrame) -> None:
    """Delete a packed result that nothing reads any more."""
    _delete(df.sparkSession, sorted({name.rpartition("/")[0] for name in df.inputFiles() if "/staged-" in name}))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Results packed inside are deleted at the end, shuffle files with each query; nothing that outlives it may read them."""
    stored: list[str] = []
    token = _stored.set(stored)
    try:
        with shuffles_dropped(spark):
            yield
    finally:
        _stored.reset(token)
        _delete(spark, stored)


def settled(spark: SparkSession, make: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Pack the frames that `make` returns, then delete what was packed on the way to them."""
    outside = _stored.get()
    with scratch(spark):
        frames = make()
        inside = _stored.set(outside)  # the results belong to the scratch around this one
        try:
            return {name: packed(df) for name, df in frames.items()}
        finally:
            _stored.reset(inside)


def spread(df: DataFrame) -> DataFrame:
    """A scan of a few large splits dealt over all cores, for costly work on each row; one of many splits as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def together(df: DataFrame, *order: str | Column) -> DataFrame:
    """Rows dealt in ranges of an order, for writing folders by its first columns.

    A folder is written by the one or few tasks whose ranges it falls into, so there are no more files than folders
    and tasks; a huge folder is split by the later columns. The tasks are never coalesced, since opening files is
    what costs. The rows are computed twice, the first time for the bounds of the ranges.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartitionByRange(tasks, *order)
