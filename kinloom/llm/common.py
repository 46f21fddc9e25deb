"""What the operators of this subpackage share: worker-side batch mapping and written intermediate tables.

Conventions that hold for every operator here, unless its own docstring says otherwise:

* ids are whole numbers or strings of them: an id that isn't one fails the job under ANSI rules;
* it reads only the id and text columns it is told of, so extra columns, also ones named like its
  outputs, have no effect;
* a null text counts as the empty text; a null id is kept and passed through;
* repeated rows are answered once each; an empty table gives an empty result of the same schema.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from ..sources.shared import shared_folder, spread

#: Documents that a worker handles at once; bounds what Python holds beside the Arrow batch.
CHUNK = 512
#: Rows of an Arrow batch while the session has Spark's default; texts are long.
BATCH_ROWS, DEFAULT_ROWS = "2000", "10000"


def schema_of(spark: SparkSession, ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns alone, under the names of the keywords; nothing else of ``df`` can clash."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and whole texts, dealt to all cores where the scan has fewer parts."""
    return spread(df.select(df[id_col].cast("long").alias("doc_id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text")))


_held: dict[str, object] = {}


def held(name: str, make: Callable[[], object]):
    """What a worker process keeps from task to task: one operator's tables and caches at a time, so that operators don't add up."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def release() -> None:
    """Gives memory that a task no longer needs back to the system; idle workers would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def small_batches(spark: SparkSession) -> None:
    """Fewer rows in an Arrow batch than by default, unless the session has a value of its own."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == DEFAULT_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    """``mapInArrow`` in small batches, with memory released after each task."""
    small_batches(df.sparkSession)

    def run_and_release(batches):
        yield from run(batches)
        release()

    return df.mapInArrow(run_and_release, schema)


def map_chunks(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list]], ddl: str, chunk: int = CHUNK) -> DataFrame:
    """Runs ``make()`` once in each task; what it returns turns a batch of at most ``chunk`` rows into a list of columns."""
    schema = schema_of(df.sparkSession, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        one = None
        for batch in batches:
            one = one or make()
            for at in range(0, batch.num_rows, chunk):  # an empty batch has none
                columns = one(batch.slice(at, chunk))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return map_batches(df, run, schema)


#: Rows of narrow tables that go into one file; tables of a few rows need no file for each partition.
FILE_ROWS = 200_000


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, read back: lineage ends there, and a lost executor costs no recomputation.

    ``rows`` is about how many narrow rows it has, where that is known: they are then put together in
    fewer files, in proportion to them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucketed(df: DataFrame, name: str, buckets: int, by: str, parts: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a table in the shared folder, in ``buckets`` by a hash of ``by``: joins and groups by it need no shuffle.

    Rows should be dealt by ``by`` already, or each task writes a file for every bucket.
    """
    spark = df.sparkSession
    tag = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    out = df.write.option("compression", "zstd").option("path", f"{shared_folder(spark)}/{tag}")
    out = out.partitionBy(*parts) if parts else out
    out.bucketBy(buckets, by).saveAsTable(tag)
    return spark.read.table(tag)
