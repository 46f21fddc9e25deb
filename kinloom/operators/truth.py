"""Ground truth: edges, cardinalities, and a profile of the raw lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text

POSITIVE = ("1", "1.0", "positive")


def edges(truth: DataFrame, mode: str = "lenient") -> DataFrame:
    """s1, t, target_source: the distinct pairs of raw lists. Rows with a blank id or list have none."""
    rows = truth.where(text.strip(text.filled(F.col("source1_entity_id"))) != "").where(~text.is_blank(F.col("matched_entity_ids")))
    spread = rows.select(text.strip(F.col("source1_entity_id")).alias("s1"), F.explode(F.split("matched_entity_ids", ",")).alias("t"))
    spread = spread.select("s1", text.strip(F.col("t")).alias("t")).where("t <> ''").distinct()
    return spread.withColumn("target_source", text.target_source(F.col("t"), mode))


def positives(table: DataFrame) -> DataFrame:
    """s1, t, target_source of labelled pairs, raw lists or two plain columns, whichever the columns tell of."""
    columns = [c.lower() for c in table.columns]
    if "matched_entity_ids" in columns:
        return edges(table)
    s1, t = ("source1_entity_id", "target_entity_id") if {"source1_entity_id", "target_entity_id"} <= set(columns) else table.columns[:2]
    rows = table.where(F.lower(text.strip(F.col("label").cast("string"))).isin(*POSITIVE)) if "label" in columns else table
    rows = rows.select(text.strip(text.filled(F.col(s1))).alias("s1"), text.strip(text.filled(F.col(t))).alias("t")).where("s1 <> '' and t <> ''").distinct()
    return rows.withColumn("target_source", text.target_source(F.col("t"), "lenient"))


def degrees(truth: DataFrame) -> DataFrame:
    """s1, matches, pairs of every row of the lists: how many tokens it has, blanks aside."""
    blank = text.is_blank(F.col("matched_entity_ids"))
    tokens = F.filter(F.transform(F.split(text.filled(F.col("matched_entity_ids")), ","), text.strip), lambda x: x != "")
    return truth.select(text.strip(text.filled(F.col("source1_entity_id"))).alias("s1"), F.when(blank, F.array().cast("array<string>")).otherwise(tokens).alias("tokens"), blank.alias("blank")).withColumn("matches", F.size("tokens"))


def cardinality(truth: DataFrame) -> DataFrame:
    """matches, n, percentage: how many rows have so many matches."""
    counts = degrees(truth).groupBy("matches").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(F.col("matches").cast("long").alias("matches"), "n", (F.col("n") * 100.0 / F.col("total")).alias("percentage")).orderBy("matches")


def profile(truth: DataFrame) -> DataFrame:
    """One row: rows, ids, pairs, zero / one / multi matches, targets by source, repeats, references that name no source."""
    d = degrees(truth)
    rows = d.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct(F.when(F.col("s1") != "", F.col("s1"))).alias("unique_source1"), F.coalesce(F.sum("matches"), F.lit(0)).alias("positive_pairs"),
        F.count_if(F.col("matches") == 0).alias("zero_match"), F.count_if(F.col("matches") == 1).alias("one_match"), F.count_if(F.col("matches") > 1).alias("multi_match"), F.coalesce(F.max("matches"), F.lit(0)).cast("long").alias("max_matches"),
        F.count_if(F.col("s1") == "").alias("missing_source1"), F.coalesce(F.sum(F.col("matches") - F.size(F.array_distinct("tokens"))), F.lit(0)).alias("duplicates_in_rows"),
    )
    source = text.target_source(F.col("t"), "strict")
    spread = d.where("s1 <> ''").select("s1", F.explode("tokens").alias("t"))
    found = d.select(F.explode("tokens").alias("t")).withColumn("source", source).agg(
        *[F.count_if(F.col("source") == s).alias(f"{k}_references") for k, s in (("s2", "Source 2"), ("s3", "Source 3"), ("unknown", "Unknown"))],
        *[F.count_distinct(F.when(F.col("source") == s, F.col("t"))).alias(f"{k}_targets") for k, s in (("s2", "Source 2"), ("s3", "Source 3"))],
    )
    pairs = spread.groupBy("s1", "t").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_pairs"))
    out = rows.crossJoin(found).crossJoin(pairs)
    named = d.agg(F.count_if(F.col("s1") != "").alias("named"))
    return out.crossJoin(named).select(*out.columns, (F.col("named") - F.col("unique_source1")).alias("duplicate_source1_rows"))


def cardinality_of_classes(classes: DataFrame) -> DataFrame:
    """``cardinality`` of records that match where their texts are equal, from n1, n2, n3 of each text."""
    counts = classes.where("n1 > 0").groupBy((F.col("n2") + F.col("n3")).alias("matches")).agg(F.sum("n1").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("matches", "n", (F.col("n") * 100.0 / F.col("total")).alias("percentage")).orderBy("matches")


def profile_of_classes(classes: DataFrame) -> DataFrame:
    """``profile`` of such records, whose ids are there and unique: what would need lists is counted in classes."""
    n, m = F.col("n1"), F.col("n2") + F.col("n3")
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    when = lambda c, x: F.when(c, x).otherwise(0)
    none = F.lit(0).cast("long")
    return classes.where("n1 > 0").agg(
        total(n).alias("row_count"), total(n).alias("unique_source1"), total(n * m).alias("positive_pairs"), total(when(m == 0, n)).alias("zero_match"), total(when(m == 1, n)).alias("one_match"), total(when(m > 1, n)).alias("multi_match"),
        F.coalesce(F.max(m), F.lit(0)).cast("long").alias("max_matches"), none.alias("missing_source1"), none.alias("duplicates_in_rows"), total(n * F.col("n2")).alias("s2_references"), total(n * F.col("n3")).alias("s3_references"),
        none.alias("unknown_references"), total("n2").alias("s2_targets"), total("n3").alias("s3_targets"), none.alias("repeated_pairs"), none.alias("duplicate_source1_rows"),
    )


def samples(truth: DataFrame, n: int = 10) -> DataFrame:
    """kind, s1, t: the first positive pairs and the first ids without matches (a report of ``n`` each)."""
    d = degrees(truth)
    some = d.where("matches > 0").select(F.lit("positive").alias("kind"), "s1", F.explode("tokens").alias("t")).orderBy("s1", "t").limit(n)
    return some.unionByName(d.where("matches = 0").select(F.lit("zero_match").alias("kind"), "s1", F.lit("").alias("t")).orderBy("s1").limit(n))
