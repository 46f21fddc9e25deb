"""Where tables come from and go to: TSV with quotes, ground truth of three shapes, record sets, reports.

The empty string stands for a missing value, so every reader fills nulls with it.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import text
from .shared import spread

#: The columns of the tables.
RECORD_COLUMNS = ("entity_id", "business_name", "business_address", "country")
DERIVED_COLUMNS = ("business_name_normalized", "business_name_core", "business_name_alnum", "business_address_normalized", "business_address_alnum", "country_normalized")
NORMAL_COLUMNS = ("entity_id", "business_name", *DERIVED_COLUMNS[:3], "business_address", *DERIVED_COLUMNS[3:5], "country", DERIVED_COLUMNS[5])
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")
PAIR_COLUMNS = ("source1_entity_id", "target_entity_id", "target_source", "label", "pair_type")
CANDIDATE_COLUMNS = ("source1_entity_id", "target_entity_id", "target_source", "strategies")
#: The files of a data set, and what each is.
EXPECTED_FILES = {
    "train/train_source1.tsv": "source1", "train/train_source2.tsv": "source2", "train/train_source3.tsv": "source3", "train/train_ground_truth.tsv": "truth",
    "test/test_source1.tsv": "source1", "test/test_source2.tsv": "source2", "test/test_source3.tsv": "source3",
}
_TSV = {"sep": "\t", "header": True, "quote": '"', "escape": '"'}


def join_path(root: str, relative: str) -> str:
    """A path below a root, which may be local or of any Hadoop scheme; an object-store root needs a bucket."""
    parts = urlparse(root)
    if parts.scheme in ("s3", "s3a", "s3n", "gs") and not parts.netloc:
        raise ValueError(f"no bucket in {root}")
    root = "s3a" + root[2:] if parts.scheme == "s3" else root
    return f"{root.rstrip('/')}/{relative.lstrip('/')}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or any that a pattern names) is there, in any file system that Spark reads; other errors are raised."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def resolve(spark: SparkSession, root: str, relative: str) -> str:
    """The normalised file beside a raw one if it is there, else the raw one."""
    stem, end = os.path.splitext(relative)
    normal = join_path(root, f"{stem}_normalized{end}")
    return normal if exists(spark, normal) else join_path(root, relative)


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted cell may go on in the next line: the first line of such a cell has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_tsv(spark: SparkSession, path: str, dealt: bool = True) -> DataFrame:
    """All columns as strings, '' for missing ones. A missing file is an error.

    Files are split by lines, unless a quoted cell holds a line break: those are read whole. ``dealt``
    deals what few unsplittable files hold (such ones, or gzip) to all cores; else rows come in order of files.
    """
    if not exists(spark, path):
        raise FileNotFoundError(path)
    table = spark.read.options(**_TSV, multiLine=has_broken_lines(spark, path)).csv(path)
    table = table.select(*[text.filled(F.col(f"`{c}`")).alias(c) for c in table.columns])
    return spread(table) if dealt else table


def read_records(spark: SparkSession, root: str, relative: str, first: int | None = None) -> DataFrame:
    """A source's records; ``first`` keeps so many in order of id (a sampling operator)."""
    table = read_tsv(spark, resolve(spark, root, relative))
    return table.orderBy("entity_id").limit(first) if first else table


def only_ids(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Records whose id is in a sample."""
    return records.join(ids.select("entity_id").distinct(), "entity_id", "left_semi")


def check_columns(table: DataFrame, expected: Iterable[str]) -> tuple[list[str], list[str]]:
    """Expected columns that are missing, and columns that weren't expected."""
    expected = list(expected)
    return [c for c in expected if c not in table.columns], [c for c in table.columns if c not in expected]


def record_schema() -> StructType:
    return StructType([StructField(c, StringType()) for c in RECORD_COLUMNS])


def write_tsv(table: DataFrame, path: str, order: Iterable[str] = (), compression: str = "none") -> None:
    """A folder of TSV files; with ``order`` the rows are in order from file to file."""
    rows = table.orderBy(*order) if order else table
    rows = rows.select(*[F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c) for c, t in table.dtypes])
    out = rows.write.mode("overwrite").options(sep="\t", header=True, quote='"', escape='"', emptyValue="", compression=compression)
    out.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)  # blanks at the ends stay


def write_parquet(table: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    table.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """A small file, from the driver, in any file system that Spark writes."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()


def write_json(spark: SparkSession, path: str, report: object) -> None:
    write_text(spark, path, json.dumps(report, indent=2, default=str))


def write_bundle(spark: SparkSession, folder: str, tables: dict[str, DataFrame], reports: dict[str, object], order: Iterable[str] = ()) -> None:
    """Tables as TSV and reports as JSON below one folder."""
    for name, table in tables.items():
        write_tsv(table, join_path(folder, name), [c for c in order if c in table.columns])
    for name, report in reports.items():
        write_json(spark, join_path(folder, f"{name}.json"), report)


def write_features(features: DataFrame, folder: str, names: Iterable[str], ids: Iterable[str]) -> None:
    """Features, labels and ids apart, each with the same row key: ids as one string, and the number of the row among those that repeat them."""
    ids = list(ids)
    key = F.concat_ws("\t", *[F.array_join(c, ",") if t.startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit("")) for c, t in features.dtypes if c in ids])
    order = Window.partitionBy("row_key").orderBy(*[c for c in names])
    keyed = features.withColumn("row_key", key).withColumn("row_copy", F.row_number().over(order))
    for name, columns in (("X", list(names)), ("ids", ids), ("y", ["label"] if "label" in features.columns else [])):
        if columns:
            write_parquet(keyed.select("row_key", "row_copy", *columns), join_path(folder, name))


def report_of(row) -> dict:
    """A one-row table as a plain report."""
    return row.asDict(recursive=True)
