"""Tables in the shared folder, and gapless positions over a total order."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Bytes of texts that a Python function gets at a time, about.
BATCH_BYTES, _BATCH = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, one temporary folder per application of a local session.
    Executors of a cluster share no temporary folder, so there it must be set."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} is not set")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="shelfseries-")
        folder = _own[app]
    return f"{folder.rstrip('/')}/shelfseries"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def hold(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: evaluated once, its lineage cut, safe when executors are lost."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def text_batches(spark: SparkSession):
    """Tables held inside have their texts go to Python in batches of ``BATCH_BYTES``, unless the session has a bound of its
    own. Spark's own bound is 10,000 rows, which are as large as the texts are, in the JVM and in Python."""
    bound = spark.conf.get(_BATCH, None) is None
    if bound:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        if bound:
            spark.conf.unset(_BATCH)


def _give_back() -> None:
    """What this process has freed goes back to the system: from Arrow's pool, and where the C library can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """``run``, for ``mapInArrow``, with freed memory given back before and after it. Python workers live on from task to
    task, of this operator and of others, and would keep what they needed once."""
    def tidied(batches):
        _give_back()
        yield from run(batches)
        _give_back()
    return tidied


def discard(*held: DataFrame) -> None:
    """Removes tables that ``hold`` wrote and no later step reads, so that the disk has only what is still needed."""
    for df in held:
        files = df.inputFiles()
        if files:
            context = df.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def positions(df: DataFrame, order: list[str], name: str, weight: Column | None = None, partitions: int | None = None) -> DataFrame:
    """``df`` held, with ``position``: the sum of ``weight`` (1 if None) over all rows before this one in ``order``.

    Rows are dealt by ranges of ``order`` and sorted inside each range, so no task sees all rows; only one total per
    range meets in one place. Rows that agree in all columns of ``order`` stand in any order among themselves.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    amount = F.lit(1).cast("long") if weight is None else weight.cast("long")
    ranged = df.withColumn("_weight", amount).repartitionByRange(n, *order).sortWithinPartitions(*order)
    numbered = hold(
        ranged.select("*", F.spark_partition_id().alias("_range"),
                      F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_line")), name)
    totals = numbered.groupBy("_range").agg(F.sum("_weight").alias("total")).collect()  # a row per range
    before, seen = {}, 0
    for r in sorted(totals, key=lambda r: r["_range"]):
        before[r["_range"]] = seen
        seen += r["total"]
    start = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("_range")) if before else F.lit(0)
    if weight is None:
        inside = F.col("_line")
    else:
        from pyspark.sql import Window

        rows = Window.partitionBy("_range").orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum("_weight").over(rows), F.lit(0))
    return numbered.withColumn("position", (start + inside).cast("long")).drop("_weight", "_range", "_line")
