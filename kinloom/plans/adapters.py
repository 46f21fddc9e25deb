"""The driver's tables as records: a document's first line is the name, what follows is the address, its language the country.

Every document is a record of one of three sources, whole text included. Documents of equal text in
different sources match, all of them. What several queries need (normalised records, keys, pairs,
matches, what features need of a record) is written once for each state of the documents and shared.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking, cells, features, normalize, pairs
from ..sources import tables
from ..sources.shared import kept, shared_folder, spread

#: Ids in one list of the ground truth, on average; the matches of a larger group of copies take several rows.
LIST = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def all_records(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Records of all sources with ``source`` (1 to 3) and the whole text; ``dealt`` to all cores if asked for."""
    docs = table(spark, sf_dir, "documents")
    lang = F.col("lang")
    country = (
        F.when(F.col("source") == "src0", "").when(lang == "en", "United States")
        .when(lang == "de", "Deutschland").when(lang == "fr", "FRA").otherwise(lang)
    )
    k = F.col("doc_id") % 3 + 1
    return (spread(docs) if dealt else docs).select(
        F.concat(F.lit("s"), k.cast("string"), F.lit("_"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.regexp_extract("text", r"^([^\n]*)", 1).alias("business_name"),
        F.regexp_replace("text", r"^[^\n]*\n?", "").alias("business_address"),
        country.alias("country"), k.alias("source"), "text",
    )


def sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw records of each source."""
    rows = all_records(spark, sf_dir)
    return tuple(rows.where(F.col("source") == k).drop("source", "text") for k in (1, 2, 3))


def _kept(spark: SparkSession, sf_dir: str, name: str, make, by: tuple[str, ...] = ()) -> DataFrame:
    return kept(spark, f"{sf_dir}/documents.parquet", name, make, by)


def normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised records with ``source``."""

    def make():
        return normalize.normalize(all_records(spark, sf_dir, dealt=True), extra=("source",))

    return _kept(spark, sf_dir, "normal", make)


def normal_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = normal(spark, sf_dir)
    return tuple(rows.where(F.col("source") == k).drop("source") for k in (1, 2, 3))


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, source, name, address, country: what blocking reads of a normalised record."""
    return normalize.stored_fields(normal(spark, sf_dir), extra=("source",))


def ids(spark: SparkSession, sf_dir: str, *of: int) -> DataFrame:
    """entity_id and country of the records of some sources; no text is read for them."""
    rows = normalize.normalize(all_records(spark, sf_dir), extra=("source",))
    return normalize.stored_fields(rows, extra=("source",)).where(F.col("source").isin(*of)).select("entity_id", "country")


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, source, country, key, bit of all strategies."""

    def make():
        return blocking.keys_of(fields(spark, sf_dir), extra=("source",))

    return _kept(spark, sf_dir, "keys", make)


def left_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys(spark, sf_dir).where("source = 1").drop("source")


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t, target_source, country, key, bit of the targets."""
    name = F.concat(F.lit("Source "), F.col("source").cast("string"))
    return keys(spark, sf_dir).where("source > 1").select(
        F.col("entity_id").alias("t"), name.alias("target_source"), "country", "key", "bit"
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocks of records whose cells are joined, made from the texts alone; equal texts have equal tags."""

    def make():
        tag = F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("tag")
        rows = all_records(spark, sf_dir, dealt=True)
        rows = normalize.stored_fields(normalize.normalize(rows.select("*", tag), extra=("source", "tag")), extra=("source", "tag"))
        return blocking.blocked(rows, F.col("tag"))

    return _kept(spark, sf_dir, "blocks", make, ("side",))


def described_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``blocks`` with what features need of each record."""

    def make():
        normal = normalize.normalize(all_records(spark, sf_dir, dealt=True), extra=("source",))
        kept = ("entity_id", "business_name_core", "business_name_alnum", "business_address_alnum", "country_normalized", "source")
        rows = normalize.stored_fields(features.described(normal, kept), extra=("source", "about"))
        return blocking.blocked(rows, F.lit(None).cast("long"))

    return _kept(spark, sf_dir, "described-blocks", make, ("side",))


def distinct_ids(spark: SparkSession, sf_dir: str) -> bool:
    ids = table(spark, sf_dir, "documents").select("doc_id")
    return ids.groupBy("doc_id").count().where("count > 1").isEmpty()


def found(spark: SparkSession, sf_dir: str, mode: str = "allow_missing") -> DataFrame:
    """s1, t, target_source, mask, tagged: the pairs that blocking finds with its own settings, each once and those of a record in a cell together.

    They aren't written: whoever reads them makes them from the blocks. All that are true are ``tagged``.
    """
    rows = cells.pairs(blocks(spark, sf_dir), mode)
    if distinct_ids(spark, sf_dir):
        return rows
    return rows.groupBy("s1", "t").agg(F.max("target_source").alias("target_source"), F.bit_or("mask").alias("mask"), F.max("tagged").alias("tagged"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, source, h: records with a hash of their text."""

    def make():
        return all_records(spark, sf_dir).select("entity_id", "source", F.sha2("text", 256).alias("h"))

    return _kept(spark, sf_dir, "members", make)


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s1, t, target_source: every pair of a record of source 1 and one of another source with its text, a row each."""

    def make():
        rows = members(spark, sf_dir)
        name = F.concat(F.lit("Source "), F.col("source").cast("string")).alias("target_source")
        others = rows.where("source > 1").select("h", F.col("entity_id").alias("t"), name)
        return rows.where("source = 1").select("h", F.col("entity_id").alias("s1")).join(others, "h").drop("h")

    return _kept(spark, sf_dir, "matches", make)


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source1_entity_id, matched_entity_ids: the matches of each record of source 1 as lists, a blank one without any.

    Ids of a large group are dealt by their hash to lists of some ``LIST`` each, so that no list is unbounded; a
    record that matches them has a row for each list.
    """
    rows = members(spark, sf_dir)
    others = rows.where("source > 1 and h is not null")
    sizes = others.groupBy("h").agg(F.ceil(F.count(F.lit(1)) / LIST).alias("lists"))
    dealt = others.join(sizes, "h").withColumn("list", F.pmod(pairs.rank_of(42, F.col("entity_id")), F.col("lists")))
    lists = dealt.groupBy("h", "list").agg(F.array_join(F.array_sort(F.collect_list("entity_id")), ",").alias("ids"))
    return rows.where("source = 1").join(lists, "h", "left").select(
        F.col("entity_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("matched_entity_ids")
    )


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n1, n2, n3: for each text how many records of each source have it; a null text matches none."""
    rows = members(spark, sf_dir)
    n = lambda k: F.count_if((F.col("source") == k) & (F.col("h").isNotNull() | (F.col("source") == 1)))
    return rows.groupBy("h").agg(*[n(k).alias(f"n{k}") for k in (1, 2, 3)]).drop("h")


def feature_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What features need of each record."""

    def make():
        return features.one_of_each(*normal_sources(spark, sf_dir))

    return _kept(spark, sf_dir, "feature-records", make)


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All matches, and two negatives for each, hard ones from blocking and from the same country."""

    def make():
        edges = matches(spark, sf_dir)
        pool = ids(spark, sf_dir, 2, 3).withColumnRenamed("entity_id", "t")
        drawn = pairs.negatives(
            edges, pool, pairs.Negatives(negatives_per_positive=2), ids(spark, sf_dir, 1), found(spark, sf_dir)
        )
        return pairs.positives(edges).unionByName(drawn)

    return _kept(spark, sf_dir, "training-pairs", make)


def by_tsv(spark: SparkSession, sf_dir: str, name: str, make, compression: str = "none") -> DataFrame:
    """``make()`` written as TSV below the shared folder and read back."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}.tsv"
    tables.write_tsv(make(), path, compression=compression)
    return tables.read_tsv(spark, path)
