"""Online linking: records of source 1 that arrive as files are paired with targets that are already there.

The key table of the targets is static; a batch of new records is joined with it as in batch mode. With
event time, records that come again within the watermark are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import blocking


def new_records(spark: SparkSession, folder: str, schema: StructType, files_at_once: int = 8) -> DataFrame:
    """A stream of the Parquet files that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def index(s2: DataFrame, s3: DataFrame, s: blocking.Blocking | None = None) -> DataFrame:
    """The key table without suppressed keys: what a batch of new records is joined with."""
    return blocking.kept_index(blocking.target_keys(s2, s3, s), s)


def link(arrived: DataFrame, targets: DataFrame, s: blocking.Blocking | None = None) -> DataFrame:
    """s1, t, target_source, mask for a batch (or a static table) of records and a key table from ``index``."""
    return blocking.match(blocking.keys(arrived, s), targets, s)


def key_stream(arrived: DataFrame, targets: DataFrame, s: blocking.Blocking | None = None) -> DataFrame:
    """A stateless stream of s1, t, target_source, bit: a row for each key that a new record shares with a target."""
    s = s or blocking.Blocking()
    left = blocking.keys(arrived, s).select(F.col("entity_id").alias("s1"), F.col("country").alias("c1"), "key", "bit")
    right = targets.select("t", "target_source", F.col("country").alias("c2"), F.col("key").alias("key2"))
    return left.join(right, (F.col("key") == F.col("key2")) & blocking.agreement(F.col("c1"), F.col("c2"), s.country_agreement_mode)).select("s1", "t", "target_source", "bit")


def once(arrived: DataFrame, event_time: str, delay: str) -> DataFrame:
    """Records without those that come again while the watermark lasts."""
    return arrived.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["entity_id"])


def run(arrived: DataFrame, targets: DataFrame, out: str, checkpoint: str, s: blocking.Blocking | None = None):
    """Starts a query that adds each batch's pairs to a table; a batch that is repeated after a failure replaces its own part."""

    def add(batch: DataFrame, number: int) -> None:
        link(batch, targets, s).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return arrived.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).start()
