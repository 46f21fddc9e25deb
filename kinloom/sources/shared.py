"""Tables that are written once to the folder the cluster shares and read from there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local: dict[str, str] = {}
_kept: dict[tuple, tuple] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset a local folder will do for a local master; a cluster must name one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = "file://" + tempfile.mkdtemp(prefix="kinloom-")
    return _local[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def state_of(spark: SparkSession, path: str) -> tuple:
    """What tells one state of a file or folder from another: its bytes, its files and when it was last changed."""
    where, fs = _path(spark, path)
    size = fs.getContentSummary(where)
    return path, size.getLength(), size.getFileCount(), fs.getFileStatus(where).getModificationTime()


def kept(spark: SparkSession, source: str, name: str, make: Callable[[], DataFrame], by: tuple[str, ...] = ()) -> DataFrame:
    """``make()``, written once in this application for each state of ``source`` and read by all who ask for it again; in folders ``by`` columns."""
    key = (spark.sparkContext.applicationId, name, *state_of(spark, source))
    if key in _kept:
        path, schema = _kept[key]
        where, fs = _path(spark, f"{path}/_SUCCESS")
        if fs.exists(where):
            return spark.read.schema(schema).parquet(path)
    table = make()
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    table.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    _kept[key] = path, table.schema
    return spark.read.schema(table.schema).parquet(path)


#: A table that takes at most so many bytes is sent to every executor where that saves a shuffle of many rows; rows are counted, not guessed.
BROADCAST_BYTES = 128 << 20


def broadcast_if_small(table: DataFrame, row_bytes: int = 64) -> DataFrame:
    """``table``, marked to be broadcast if its rows take few bytes; runs a job that counts them."""
    return F.broadcast(table) if table.count() * row_bytes <= BROADCAST_BYTES else table


def spread(table: DataFrame) -> DataFrame:
    """A scan of few large parts, such as one unsplittable file, dealt to all cores; one of many parts as it is, and what isn't a mere scan too."""
    planned = table._jdf.queryExecution()
    if "AdaptiveSparkPlan" in planned.executedPlan().toString():
        return table
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if planned.toRdd().getNumPartitions() < cores else table
