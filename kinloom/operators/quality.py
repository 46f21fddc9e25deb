"""Quality of raw tables: cells, ids, countries, references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.tables import EXPECTED_FILES, RECORD_COLUMNS, TRUTH_COLUMNS, check_columns, exists, join_path, read_tsv

KINDS = ("null", "empty", "whitespace", "valid")


def column_quality(table: DataFrame, columns=RECORD_COLUMNS) -> DataFrame:
    """column, null, empty, whitespace, valid, missing: one pass over the table."""
    counts = table.agg(*[F.count_if(text.cell_kind(F.col(c)) == k).alias(f"{c}|{k}") for c in columns for k in KINDS])
    line = lambda c: F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{k}`").alias(f"{k}_count") for k in KINDS])
    out = counts.select(F.explode(F.array(*[line(c) for c in columns])).alias("r")).select("r.*")
    return out.withColumn("missing_count", F.col("null_count") + F.col("empty_count") + F.col("whitespace_count"))


def id_integrity(table: DataFrame, column: str = "entity_id") -> DataFrame:
    """One row: rows, distinct ids, repeats beyond the first, missing ids."""
    valid = text.cell_kind(F.col(column)) == "valid"
    counts = table.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(F.when(valid, text.strip(F.col(column)))).alias("unique_ids"), F.count_if(valid).alias("valid"))
    return counts.select("row_count", "unique_ids", (F.col("valid") - F.col("unique_ids")).alias("duplicate_ids"), (F.col("row_count") - F.col("valid")).alias("missing_ids"))


def country_distribution(table: DataFrame, column: str = "country") -> DataFrame:
    """country, row_count, percentage; missing ones under <MISSING>."""
    name = F.when(text.cell_kind(F.col(column)) == "valid", text.strip(F.col(column))).otherwise("<MISSING>")
    counts = table.groupBy(name.alias("country")).agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.sum("row_count").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("country", "row_count", (F.col("row_count") * 100.0 / F.col("total")).alias("percentage")).orderBy(F.desc("row_count"), "country")


def truth_tokens(truth: DataFrame) -> DataFrame:
    """Every token of the match lists, blank ones too, with its row: row, s1, place, token, seen (the same token stands earlier in the list)."""
    rows = truth.withColumn("row", F.monotonically_increasing_id()).where(text.cell_kind(F.col("matched_entity_ids")) == "valid")
    lists = rows.select("row", F.col("source1_entity_id").alias("s1"), F.transform(F.split("matched_entity_ids", ","), text.strip).alias("tokens"))
    spread = lists.select("row", "s1", "tokens", F.posexplode("tokens").alias("place", "token"))
    return spread.select("row", "s1", "place", "token", (F.array_position("tokens", F.col("token")) <= F.col("place")).alias("seen"))


def truth_quality(truth: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """One row of counts: rows, empty and other lists, missing ids, unknown references, repeats and blanks in lists."""
    valid_id = text.cell_kind(F.col("source1_entity_id")) == "valid"
    has_list = text.cell_kind(F.col("matched_entity_ids")) == "valid"
    rows = truth.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(~has_list).alias("empty_match_count"), F.count_if(has_list).alias("non_empty_match_count"), F.count_if(~valid_id).alias("missing_source1_id_count"))
    tokens = truth_tokens(truth)
    lists = tokens.agg(F.count_if(F.col("token") == "").alias("malformed_reference_count"), F.count_if((F.col("token") != "") & F.col("seen")).alias("duplicate_in_match_list_count"))
    unknown_s1 = truth.where(valid_id).select(text.strip(F.col("source1_entity_id")).alias("id")).join(_ids(s1), "id", "left_anti").agg(F.count(F.lit(1)).alias("n1"))
    unknown_t = tokens.where("token <> ''").select(F.col("token").alias("id")).join(_ids(targets), "id", "left_anti").agg(F.count(F.lit(1)).alias("n2"))
    some = lambda t: _ids(t).agg((F.count(F.lit(1)) > 0).alias("some"))
    out = rows.crossJoin(lists).crossJoin(unknown_s1).crossJoin(unknown_t).crossJoin(some(s1).withColumnRenamed("some", "some1")).crossJoin(some(targets).withColumnRenamed("some", "some2"))
    return out.select(*rows.columns, *lists.columns, F.when(F.col("some1"), F.col("n1")).otherwise(0).alias("invalid_source1_reference_count"), F.when(F.col("some2"), F.col("n2")).otherwise(0).alias("invalid_match_reference_count"))


def _ids(table: DataFrame) -> DataFrame:
    return table.where(text.cell_kind(F.col("entity_id")) == "valid").select(text.strip(F.col("entity_id")).alias("id")).distinct()


def unknown_references(truth: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """side, id, n: references to records that aren't there."""
    left = truth.where(text.cell_kind(F.col("source1_entity_id")) == "valid").select(text.strip(F.col("source1_entity_id")).alias("id")).join(_ids(s1), "id", "left_anti").groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    right = truth_tokens(truth).where("token <> ''").select(F.col("token").alias("id")).join(_ids(targets), "id", "left_anti").groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return left.select(F.lit("source1").alias("side"), "id", "n").unionByName(right.select(F.lit("target").alias("side"), "id", "n"))


def dataset_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """table, rows, missing ids, duplicate ids, missing cells, status: FAIL if an id is missing."""
    parts = []
    for name, table in tables.items():
        cells = column_quality(table).agg(F.sum("missing_count").alias("missing_cells"))
        parts.append(id_integrity(table).crossJoin(cells).select(F.lit(name).alias("table_name"), "row_count", "unique_ids", "duplicate_ids", "missing_ids", "missing_cells", F.when(F.col("missing_ids") > 0, "FAIL").otherwise("PASS").alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate_dataset(spark, root: str) -> dict:
    """A report on the seven files: FAIL if one is missing or has an error."""
    errors = [f"required file missing: {f}" for f in EXPECTED_FILES if not exists(spark, join_path(root, f))]
    report: dict = {"errors": errors, "warnings": [], "files": {}}
    if not errors:
        tables = {f: read_tsv(spark, join_path(root, f)) for f in EXPECTED_FILES}
        for f, table in tables.items():
            missing, extra = check_columns(table, TRUTH_COLUMNS if EXPECTED_FILES[f] == "truth" else RECORD_COLUMNS)
            errors += [f"{f}: missing column {c}" for c in missing]
            report["warnings"] += [f"{f}: unexpected column {c}" for c in extra]
            if missing:
                continue
            if EXPECTED_FILES[f] != "truth":
                ids = id_integrity(table).first().asDict()
                errors += [f"{f}: {ids['missing_ids']} missing ids"] if ids["missing_ids"] else []
                report["warnings"] += [f"{f}: {ids['duplicate_ids']} repeated ids"] if ids["duplicate_ids"] else []
                report["files"][f] = ids | {"columns": [r.asDict() for r in column_quality(table).collect()], "countries": [r.asDict() for r in country_distribution(table).toLocalIterator()]}
        if not errors:
            train = {k.rsplit("source", 1)[-1][:1]: t for k, t in tables.items() if k.startswith("train/") and "source" in k}
            stats = truth_quality(tables["train/train_ground_truth.tsv"], train["1"], train["2"].unionByName(train["3"])).first().asDict()
            report["files"]["train/train_ground_truth.tsv"] = stats
            for k in ("missing_source1_id_count", "invalid_source1_reference_count", "invalid_match_reference_count", "malformed_reference_count"):
                errors += [f"ground truth: {k} is {stats[k]}"] if stats[k] else []
    report["status"] = "FAIL" if errors else "PASS"
    return report
