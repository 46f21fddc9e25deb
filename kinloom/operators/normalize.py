"""Normalised records and what normalising did."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.tables import DERIVED_COLUMNS, NORMAL_COLUMNS, RECORD_COLUMNS, check_columns


def normalize(records: DataFrame, compose: bool = True, extra: tuple[str, ...] = ()) -> DataFrame:
    """Ten columns, the four of a record and six derived ones, and those named in ``extra``.

    A missing column is an error; others are dropped. Each step is a projection of its own, so that what
    several columns derive from is computed once.
    """
    missing, _ = check_columns(records, RECORD_COLUMNS)
    if missing:
        raise ValueError(f"missing columns: {missing}")
    raw = records.select(*[text.filled(F.col(c)).alias(c) for c in RECORD_COLUMNS], *extra)
    cleaned = raw.withColumns({
        "n0": text.clean(F.col("business_name"), compose),
        "a0": text.clean(F.col("business_address"), compose),
        "c0": text.clean(F.col("country"), compose),
    })
    normal = cleaned.withColumns({
        "business_name_normalized": text.normal_name(F.col("n0")),
        "business_address_normalized": text.normal_address(F.col("a0")),
        "country_normalized": text.normal_country(F.col("c0")),
    }).withColumn("cut", text.without_forms(F.col("business_name_normalized")))
    out = normal.withColumns({
        "business_name_core": text.name_core(F.col("business_name_normalized"), F.col("cut")),
        "business_name_alnum": text.alnum_name(F.col("business_name_normalized")),
        "business_address_alnum": text.alnum_address(F.col("business_address_normalized")),
    })
    return out.select(*NORMAL_COLUMNS, *extra)


def stored_fields(normal: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """entity_id, name, address, country for blocking, of records that ``normalize`` made; see ``fields``.

    A derived column that is blank stays so: what it derives from is blank too.
    """
    value = lambda c: text.strip(F.col(c))
    name = F.when(text.is_blank(F.col("business_name_core")), value("business_name_alnum")).otherwise(value("business_name_core"))
    rows = normal.select(
        value("entity_id").alias("entity_id"), *extra, name.alias("name"),
        value("business_address_alnum").alias("address"), value("country_normalized").alias("country"),
    )
    return rows.where("entity_id <> ''")


def fields(records: DataFrame) -> DataFrame:
    """entity_id, name, address, country for blocking: a stored derived column where it isn't blank, else derived from the raw one.

    ``name`` is the core, and the alphanumeric name where that is empty. A core that isn't stored is
    derived from the alphanumeric name. Rows without an id are left out.
    """
    has = set(records.columns)
    raw = lambda c: text.filled(F.col(c)) if c in has else F.lit("")
    stored = lambda c: F.when(~text.is_blank(F.col(c)), text.strip(text.filled(F.col(c)))) if c in has else F.lit(None).cast("string")
    rows = records.select(
        text.strip(raw("entity_id")).alias("entity_id"), *[stored(c).alias(k) for k, c in (("core", "business_name_core"), ("alnum", "business_name_alnum"), ("aa", "business_address_alnum"), ("cc", "country_normalized"))],
        text.clean(raw("business_name")).alias("n0"), text.clean(raw("business_address")).alias("a0"), text.clean(raw("country")).alias("c0"),
    ).where("entity_id <> ''")
    made = rows.withColumns({"an": text.alnum(text.normal_name(F.col("n0"))), "address": F.coalesce("aa", text.alnum(text.normal_address(F.col("a0")))), "country": F.coalesce("cc", text.normal_country(F.col("c0")))})
    cut = made.withColumn("cut", text.without_forms(F.col("an")))
    named = cut.withColumn("derived", text.name_core(F.col("an"), F.col("cut")))
    return named.select("entity_id", F.coalesce("core", F.when(F.col("derived") != "", F.col("derived")), F.coalesce("alnum", "an")).alias("name"), "address", "country")


def summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows and blank cells before and after, distinct ids, lengths of the derived columns over all rows, and the verdict."""
    blanks = lambda table, columns, tag: table.agg(
        F.count(F.lit(1)).alias(f"rows_{tag}"), *[F.count_if(text.is_blank(F.col(c))).alias(f"{c}_blank_{tag}") for c in columns]
    )
    lengths = [f(F.length(c)).alias(f"{c}_{n}_length") for c in DERIVED_COLUMNS for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    out = blanks(before, RECORD_COLUMNS[1:], "before").crossJoin(blanks(after, DERIVED_COLUMNS, "after")).crossJoin(after.agg(F.count_distinct("entity_id").alias("distinct_ids"), *lengths))
    return out.withColumn("status", F.when(F.col("rows_before") == F.col("rows_after"), "PASS").otherwise("FAIL"))
