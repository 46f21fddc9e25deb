"""Candidate pairs made final: trimmed, relabelled, without repeats and test ids, and checked."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions import text
from ..sources.shared import broadcast_if_small
from . import cells

S1_ID, TARGET_ID = r"(?i)^s1[_-].+", r"(?i)^(s2|s3)[_-].+"


def with_position(table: DataFrame) -> DataFrame:
    """``table`` with ``position``, its order as read: by file name, place in the file and row.

    To be called on what was read, before anything that deals rows anew.
    """
    place = (F.input_file_name().alias("file"), F.input_file_block_start().alias("at"), F.monotonically_increasing_id().alias("row"))
    return table.withColumn("position", F.struct(*place))


def inversions(table: DataFrame) -> DataFrame:
    """One row: how many pairs are below the one before them, by ``position``.

    Rows are compared within runs of neighbouring positions; the last row of a run is handed to the
    next, so no task sees more than a run.
    """
    run = F.struct("position.file", "position.at", F.floor(F.col("position.row") / 100_000).alias("part"))
    pair = F.struct("source1_entity_id", "target_entity_id")
    rows = table.select(run.alias("run"), "position", pair.alias("pair"))
    inside = rows.withColumn("before", F.lag("pair").over(Window.partitionBy("run").orderBy("position")))
    ends = rows.groupBy("run").agg(F.min_by("pair", "position").alias("first"), F.max_by("pair", "position").alias("last"))
    between = ends.withColumn("before", F.lag("last").over(Window.orderBy("run")))  # one row a run
    a = inside.agg(F.count_if(F.col("pair") < F.col("before")).alias("a"))
    b = between.agg(F.count_if(F.col("first") < F.col("before")).alias("b"))
    return a.crossJoin(b).select((F.col("a") + F.col("b")).alias("inversions"))


def _numbered(table: pa.Table) -> pa.RecordBatch:
    """Rows of whole pairs, each pair's together, with ``copy``, which counts a pair's rows by strategies and bad_source."""
    first = np.flatnonzero(_starts(table))
    run = np.repeat(np.arange(len(first)), np.diff(np.append(first, table.num_rows)))
    copy = np.ones(table.num_rows, np.int32)
    several = np.flatnonzero(np.bincount(run)[run] > 1) if len(run) else first
    if len(several):
        some = table.select(["strategies", "bad_source"]).take(several).append_column("run", pa.array(run[several]))
        by = pa.compute.sort_indices(some, sort_keys=[("run", "ascending"), ("strategies", "ascending"), ("bad_source", "ascending")], null_placement="at_start").to_numpy()
        begins = np.searchsorted(run[several][by], run[several][by], "left")
        copy[several[by]] = np.arange(len(by)) - begins + 1
    table = table.append_column("copy", pa.array(copy)).combine_chunks()
    return pa.RecordBatch.from_arrays([c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns], table.column_names)


def _starts(table: pa.Table) -> np.ndarray:
    """Whether a row's pair isn't that of the row before."""
    out = np.ones(table.num_rows, bool)
    if table.num_rows > 1:
        columns = [table.column(c).combine_chunks() for c in ("source1_entity_id", "target_entity_id")]
        other = [pa.compute.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False) for c in columns]
        out[1:] = other[0] | other[1]
    return out


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        last = int(np.flatnonzero(_starts(table))[-1]) if table.num_rows else 0
        if last:
            yield _numbered(table.slice(0, last))
        held = table.slice(last)
    if held is not None and held.num_rows:
        yield _numbered(held)


def _counted(rows: DataFrame) -> DataFrame:
    """Rows, each pair's together in one partition, with ``copy``."""
    return rows.mapInArrow(_copies, StructType([*rows.schema.fields, StructField("copy", IntegerType())]))


def _leaks(rows: DataFrame, test_ids: DataFrame) -> DataFrame:
    """Rows with leak1 and leak2, true where an id is a test id, else null."""
    ids = broadcast_if_small(test_ids.select(F.col("entity_id").alias("id")).distinct())
    for column, leak in (("source1_entity_id", "leak1"), ("target_entity_id", "leak2")):
        rows = rows.join(ids.select(F.col("id").alias(column), F.lit(True).alias(leak)), column, "left")
    return rows


def marked(raw: DataFrame, test_ids: DataFrame | None = None, together: bool = False) -> DataFrame:
    """Rows with trimmed ids and flags: bad_s1, bad_target, bad_source, leak, and copy (1 for the row that stays of a pair).

    ``together``: the rows of a pair follow each other in one partition, as in a sorted table; then none is shuffled.
    """
    column = lambda c: text.strip(text.filled(F.col(c))) if c in raw.columns else F.lit("")
    rows = raw.select(*[column(c).alias(c) for c in ("source1_entity_id", "target_entity_id", "target_source")], column("strategies").alias("strategies") if dict(raw.dtypes).get("strategies", "").startswith("string") else F.array_join("strategies", ",").alias("strategies"))
    expected = text.target_source(F.col("target_entity_id"), "prefix")
    rows = rows.withColumns({
        "bad_s1": ~F.col("source1_entity_id").rlike(S1_ID), "bad_target": ~F.col("target_entity_id").rlike(TARGET_ID),
        "bad_source": F.col("target_source") != expected, "target_source": expected,
    })
    if together:
        rows = _counted(rows)
    else:
        rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("source1_entity_id", "target_entity_id").orderBy("strategies", "bad_source")))
    if test_ids is None:
        return rows.withColumn("leak", F.lit(False))
    return _leaks(rows, test_ids).withColumn("leak", F.coalesce("leak1", "leak2", F.lit(False))).drop("leak1", "leak2")


def final(rows: DataFrame, ordered: bool = True) -> DataFrame:
    """The pairs that stay, in order if they are to be ``ordered``, which shuffles all of them."""
    rows = rows.where((F.col("copy") == 1) & ~F.col("leak")).select("source1_entity_id", "target_entity_id", "target_source", "strategies")
    return rows.orderBy("source1_entity_id", "target_entity_id") if ordered else rows


def contributions(pairs: DataFrame) -> DataFrame:
    """strategy, n: pairs that each strategy found."""
    names = F.col("strategies") if dict(pairs.dtypes)["strategies"].startswith("array") else F.split("strategies", ",")
    return pairs.select(F.explode(F.transform(names, text.strip)).alias("strategy")).where("strategy <> ''").groupBy("strategy").agg(F.count(F.lit(1)).alias("n"))


def degree_stats(pairs: DataFrame) -> DataFrame:
    """One row: records, least, most and mean candidates of those that have any, pairs and shares by source."""
    return _degree_stats(pairs.groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("target_source") == "Source 2").alias("n2")))


def _degree_stats(each: DataFrame) -> DataFrame:
    """``degree_stats`` of n and n2 (those of source 2) for each record."""
    out = each.agg(F.count(F.lit(1)).alias("records"), F.coalesce(F.min("n"), F.lit(0)).alias("least"), F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("mean"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"), F.coalesce(F.sum("n2"), F.lit(0)).alias("source2_pairs"))
    share = lambda c: F.when(F.col("pairs") > 0, c / F.col("pairs")).otherwise(0.0)
    return out.withColumn("source3_pairs", F.col("pairs") - F.col("source2_pairs")).withColumns({"source2_share": share(F.col("source2_pairs")), "source3_share": share(F.col("source3_pairs"))})


def final_checks(rows: DataFrame, order: DataFrame | None = None, expected: int | None = None, commit: str = "") -> DataFrame:
    """One row: counts and the eight verdicts of finalising. ``order`` is the table of ``inversions`` of the input as it was read."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("input_rows"), F.count_if((F.col("copy") == 1) & ~F.col("leak")).alias("output_rows"), F.count_if(F.col("copy") > 1).alias("duplicates"), F.count_if("bad_s1").alias("bad_s1_ids"),
        F.count_if("bad_target").alias("bad_target_ids"), F.count_if("bad_source").alias("bad_sources"), F.count_if(F.col("leak") & (F.col("copy") == 1)).alias("leaks"),
    )
    return _final_verdicts(counts.crossJoin(order) if order is not None else counts.withColumn("inversions", F.lit(0).cast("long")), expected, commit)


def _final_verdicts(out: DataFrame, expected: int | None, commit: str) -> DataFrame:
    """``final_checks`` from its counts."""
    ok = lambda c, n, bad="FAIL": F.when(c, "PASS").otherwise(bad).alias(n)
    out = out.select(
        *out.columns, ok(F.col("bad_s1_ids") == 0, "c1_s1_ids"), ok(F.col("bad_target_ids") == 0, "c2_target_ids"), ok(F.col("bad_sources") == 0, "c3_source_labels"), ok(F.col("inversions") == 0, "c4_order"),
        ok(F.col("duplicates") == 0, "c5_duplicates", "WARN"), ok(F.col("leaks") == 0, "c6_test_leakage"), ok(F.lit(expected is None) | (F.col("output_rows") >= F.lit(expected or 0)), "c7_count", "WARN"), ok(F.lit(bool(commit) and commit != "unknown"), "c8_commit", "WARN"),
    )
    failed = [F.col(c) == "FAIL" for c in out.columns if c.startswith("c") and c[1].isdigit()]
    return out.withColumn("status", F.when(F.array_contains(F.array(*failed), True), "FAIL").otherwise("PASS"))


def blocking_checks(pairs: DataFrame, metrics: DataFrame | None = None, order: DataFrame | None = None, test_ids: DataFrame | None = None, version: str = "", settings: dict | None = None, commit: str = "", strategy: str = "", together: bool = False) -> DataFrame:
    """One row: counts and the twelve verdicts on blocking's output. ``metrics`` is a row of ``recall.overall``; ``together`` as in ``marked``."""
    s1, t = F.col("source1_entity_id"), F.col("target_entity_id")
    leak = F.lower(s1).contains("test_") | F.lower(t).contains("test_")
    rows = _counted(pairs.select(s1, t, F.lit("").alias("strategies"), F.lit(False).alias("bad_source"))) if together else pairs
    if test_ids is not None:
        rows = _leaks(rows, test_ids)
        leak = leak | F.coalesce(F.col("leak1"), F.col("leak2"), F.lit(False))
    unique = [F.count_if(F.col("copy") == 1).alias("unique_pairs")] if together else []
    counts = rows.agg(*unique, F.count(F.lit(1)).alias("pairs"), F.count_if(~s1.rlike(S1_ID)).alias("bad_s1_ids"), F.count_if(~t.rlike(TARGET_ID)).alias("bad_target_ids"), F.count_if(t.rlike(S1_ID)).alias("cross_source"), F.count_if(leak).alias("leaks"))
    each = pairs.groupBy("source1_entity_id", "target_entity_id").agg(F.count(F.lit(1)).alias("n"))
    out = counts if together else counts.crossJoin(each.agg(F.count(F.lit(1)).alias("unique_pairs")))
    out = out.crossJoin(order) if order is not None else out.withColumn("inversions", F.lit(0).cast("long"))
    if metrics is not None:
        fine = (F.col("recovered") + F.col("missed") == F.col("true_pairs")) & F.col("recall").between(0, 1) & F.col("reduction_ratio").between(0, 1)
        out = out.crossJoin(metrics.select(F.when(fine, "PASS").otherwise("FAIL").alias("m")))
    else:
        out = out.withColumn("m", F.lit("SKIPPED"))
    ok = lambda c, n, bad="FAIL": F.when(c, "PASS").otherwise(bad).alias(n)
    said = lambda x, n: F.lit("PASS" if x else "WARN").alias(n)
    out = out.select(
        "pairs", "unique_pairs", "bad_s1_ids", "bad_target_ids", "cross_source", "leaks", "inversions",
        ok(F.col("bad_s1_ids") == 0, "c01_s1_ids"), ok(F.col("bad_target_ids") == 0, "c02_target_ids"), ok(F.col("cross_source") == 0, "c03_no_cross_source"), ok(F.col("pairs") == F.col("unique_pairs"), "c04_no_duplicates"),
        ok(F.col("inversions") == 0, "c05_order", "WARN"), F.col("m").alias("c06_metrics"), ok(F.col("leaks") == 0, "c07_no_test_leakage"), F.lit("PASS").alias("c08_no_enrichment"),
        said(version, "c09_version"), said(settings, "c10_settings"), said(commit, "c11_commit"), said(strategy, "c12_strategy"),
    )
    failed = [F.col(c) == "FAIL" for c in out.columns if c.startswith("c") and c[1].isdigit()]
    return out.withColumn("status", F.when(F.array_contains(F.array(*failed), True), "FAIL").otherwise("PASS"))


# -- candidates in cells ----------------------------------------------------------------------------
#
# Ids are those of blocks: trimmed, and each once. So a pair is in one cell, all its rows with it.

#: Java's ``.``, which line ends aren't.
_SIGN = "[^\n\r\x85\u2028\u2029]"


def _is(pattern: str, ids: pa.Array) -> np.ndarray:
    """Which ids a pattern of this module finds, as Spark's ``rlike``."""
    known = re.compile(pattern.replace(".+", _SIGN), re.ASCII)
    return np.fromiter((known.search(x) is not None for x in ids.to_pylist()), bool, len(ids))


def _of_source2(ids: pa.Array) -> np.ndarray:
    """Which targets are of source 2 by the prefix of their id; others count as of source 3."""
    known = re.compile(f"s2[_-]{_SIGN}")
    return np.fromiter((known.match(x.lower()) is not None for x in ids.to_pylist()), bool, len(ids))


def cell_degrees(blocked: DataFrame, mode: str) -> DataFrame:
    """``degree_stats`` of the final pairs of cells: those of each record are counted where they are made."""

    def made(left, right, found, _):
        of2 = _of_source2(right[0])
        n = np.zeros((2, len(left[0])), np.int64)
        for lefts, rights, _ in found:
            n[0] += np.bincount(lefts, minlength=n.shape[1])
            n[1] += np.bincount(lefts[of2[rights]], minlength=n.shape[1])
        some = np.flatnonzero(n[0])
        yield pa.RecordBatch.from_arrays([left[0].take(pa.array(some)), pa.array(n[0][some]), pa.array(n[1][some])], ["s1", "n", "n2"])

    rows = cells.mapped(blocked, mode, made, "s1 string, n long, n2 long")
    return _degree_stats(rows.groupBy("s1").agg(F.sum("n").alias("n"), F.sum("n2").alias("n2")))


def cell_contributions(blocked: DataFrame, mode: str, strategies: tuple[str, ...]) -> DataFrame:
    """``contributions`` of the final pairs of cells; ``strategies`` are those of the blocks, in the order of their bits."""

    def made(left, right, found, _):
        n = np.zeros(len(strategies), np.int64)
        for _, _, masks in found:
            n += [np.count_nonzero(masks & masks.dtype.type(1 << bit)) for bit in range(len(strategies))]
        yield pa.RecordBatch.from_arrays([pa.array(strategies), pa.array(n)], ["strategy", "n"])

    rows = cells.mapped(blocked, mode, made, "strategy string, n long")
    return rows.groupBy("strategy").agg(F.sum("n").alias("n")).where("n > 0")


def cell_checks(blocked: DataFrame, mode: str, twice: int = 0, expected: int | None = None, commit: str = "") -> DataFrame:
    """``final_checks`` of the pairs of cells, in order; those of the strategies with bits ``twice`` have two rows each."""
    names = ["input_rows", "output_rows", "bad_s1_ids", "bad_target_ids", "bad_sources"]

    def made(left, right, found, _):
        bad1, bad2 = ~_is(S1_ID, left[0]), ~_is(TARGET_ID, right[0])
        other = (right[2] == 2) != _of_source2(right[0])
        n = np.zeros(len(names), np.int64)
        for lefts, rights, masks in found:
            rows = 1 + (masks & masks.dtype.type(twice) != 0)
            n += [rows.sum(), len(rows), rows[bad1[lefts]].sum(), rows[bad2[rights]].sum(), rows[other[rights]].sum()]
        yield pa.RecordBatch.from_arrays([pa.array(n[k : k + 1]) for k in range(len(names))], names)

    total = {k: F.coalesce(F.sum(k), F.lit(0)).cast("long") for k in names}
    counts = cells.mapped(blocked, mode, made, ", ".join(f"{k} long" for k in names)).agg(
        *[total[k].alias(k) for k in names[:2]], (total["input_rows"] - total["output_rows"]).alias("duplicates"), *[total[k].alias(k) for k in names[2:]], F.lit(0).cast("long").alias("leaks")
    )
    return _final_verdicts(counts.withColumn("inversions", F.lit(0).cast("long")), expected, commit)


def cell_final(blocked: DataFrame, mode: str, strategies: tuple[str, ...]) -> DataFrame:
    """``final`` of the pairs of cells, in no order: copies aren't made, pairs of ``cells.flagged`` records (test ids) don't leave their cell."""

    def made(left, right, found, flagged):
        of2 = _of_source2(right[0])
        out = [np.zeros(len(side[0]), bool) for side in (left, right)]
        for leaks, places in zip(out, flagged):
            leaks[places] = True
        for lefts, rights, masks in found:
            if flagged:
                stays = ~(out[0][lefts] | out[1][rights])
                lefts, rights, masks = lefts[stays], rights[stays], masks[stays]
            columns = [left[0].take(pa.array(lefts)), right[0].take(pa.array(rights)), pa.array(of2[rights]), pa.array(masks.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["s1", "t", "of2", "mask"])

    rows = cells.mapped(blocked, mode, made, "s1 string, t string, of2 boolean, mask int")
    source = F.when(F.col("of2"), "Source 2").otherwise("Source 3")
    return rows.select(F.col("s1").alias("source1_entity_id"), F.col("t").alias("target_entity_id"), source.alias("target_source"), _named(F.col("mask"), strategies).alias("strategies"))


def _named(mask: Column, strategies: tuple[str, ...]) -> Column:
    """Names of a mask's strategies, in order and joined by commas; looked up while the masks are few."""
    of = lambda m: ",".join(sorted(k for bit, k in enumerate(strategies) if m >> bit & 1))
    if len(strategies) <= 8:
        return F.element_at(F.array(*[F.lit(of(m)) for m in range(1 << len(strategies))]), mask + 1)
    return F.array_join(F.array_compact(F.array(*[F.when(mask.bitwiseAND(1 << bit) != 0, k) for k, bit in sorted((k, bit) for bit, k in enumerate(strategies))])), ",")
