"""Training pairs: all true pairs, and negatives drawn by hash, so that any machine draws the same."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..sources.shared import broadcast_if_small
from . import normalize

#: Targets of the same country that a record may draw hard negatives from, beside those that blocking finds.
SAME_COUNTRY = 50
#: Targets in a bucket of the pool that random negatives come from.
BUCKET = 1000


@dataclass(frozen=True)
class Negatives:
    negatives_per_positive: int = 1
    hard_negative_ratio: float = 0.5
    seed: int = 42


def rank_of(seed: int, *parts: Column) -> Column:
    """A number that seed and parts decide."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, 15), 16, 10).cast("long")


def pool(s2: DataFrame, s3: DataFrame, first: int | None = None) -> DataFrame:
    """t and country of all targets; ``first`` keeps so many of each source, in order of id (a sampling operator)."""
    some = lambda r: r.orderBy("entity_id").limit(first) if first else r
    part = lambda r: normalize.fields(some(r)).select(F.col("entity_id").alias("t"), "country")
    return part(s2).unionByName(part(s3))


def positives(truth_edges: DataFrame) -> DataFrame:
    """The true pairs as training pairs."""
    return truth_edges.select(
        F.col("s1").alias("source1_entity_id"), F.col("t").alias("target_entity_id"), "target_source",
        F.lit(1).alias("label"), F.lit("positive").alias("pair_type"),
    )


def _same_country(needs: DataFrame, countries: DataFrame, pool: DataFrame, seed: int) -> DataFrame:
    """s1, t: for each record so many targets of its country, neighbours on a ring in order of a hash.

    Countries need not fit in a task: a ring is cut in pieces.
    """
    places = pool.where("country <> ''").select("t", F.col("country").alias("c"), rank_of(seed, F.col("t")).alias("h"))
    sizes = places.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / BUCKET).alias("pieces"))
    in_piece = places.join(sizes, "c").withColumn("piece", F.pmod("h", F.col("pieces")))
    place = F.row_number().over(Window.partitionBy("c", "piece").orderBy("h", "t")) - 1
    ranked = in_piece.withColumn("place", place).select("c", "piece", "place", "t")
    counts = ranked.groupBy("c", "piece").agg(F.count(F.lit(1)).alias("n"))
    named = countries.where("country <> ''").groupBy(F.col("entity_id").alias("s1")).agg(F.min("country").alias("c"))
    asks = needs.join(named, "s1").join(sizes, "c").withColumn("piece", F.pmod(rank_of(seed, F.col("s1")), F.col("pieces")))
    asks = asks.join(counts, ["c", "piece"])
    first = F.pmod(rank_of(seed, F.lit("ring"), F.col("s1")), F.col("n"))
    steps = F.sequence(F.lit(0), F.least(F.col("n"), F.lit(SAME_COUNTRY)) - 1)
    asks = asks.withColumn("place", F.explode(F.transform(steps, lambda i: F.pmod(first + i, F.col("n")))))
    asks = asks.select("s1", "c", "piece", F.col("place").cast("int").alias("place"))
    return asks.join(ranked, ["c", "piece", "place"]).select("s1", "t")


def _random(needs: DataFrame, pool: DataFrame, seed: int) -> DataFrame:
    """s1, t, draw: four draws and eight more for each negative that is needed, from buckets of the pool."""
    n = pool.select("t").distinct()
    size = n.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / BUCKET)).alias("buckets"))
    placed = n.crossJoin(F.broadcast(size)).withColumn("h", rank_of(seed, F.col("t"))).withColumn("bucket", F.pmod("h", "buckets"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("h", "t")) - 1
    placed = placed.withColumn("place", place).select("bucket", "place", "t")
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    draws = needs.crossJoin(F.broadcast(size)).withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("need") * 4 + 8)))
    of = lambda what: rank_of(seed, F.lit(what), F.col("s1"), F.col("draw").cast("string"))
    draws = draws.withColumn("bucket", F.pmod(of("bucket"), F.col("buckets"))).join(counts, "bucket")
    draws = draws.withColumn("place", F.pmod(of("place"), F.col("n")).cast("int"))
    return draws.select("s1", "draw", "bucket", "place").join(placed, ["bucket", "place"]).select("s1", "t", "draw")


def _lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (s1, t, rank, least) without those that ``least`` rows of their s1 in the same batch are below.

    That many are enough: of a record's lowest ranks no more than its true pairs are taken out, and no more
    than its hard negatives are kept. Most pairs go before they are shuffled.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        record = batch.column(0).dictionary_encode().indices.to_numpy()
        rank, least = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        order = np.lexsort((rank, record))
        record, rank, least = record[order], rank[order], least[order]
        first = np.searchsorted(record, record, "left")
        last = np.searchsorted(record, record, "right") - 1
        limit = rank[np.minimum(first + least - 1, last)]  # ties stay
        kept = pa.array(order[rank <= limit])
        yield pa.RecordBatch.from_arrays([batch.column(i).take(kept) for i in range(3)], ["s1", "t", "rank"])


def negatives(
    truth_edges: DataFrame, pool: DataFrame, s: Negatives | None = None, countries: DataFrame | None = None, blocked: DataFrame | None = None
) -> DataFrame:
    """Training pairs that aren't true: for each record so many for each true pair, a share of them hard.

    ``pool`` has t and country of the targets; hard ones come from ``blocked`` (s1, t) and, if
    ``countries`` (entity_id, country) are given, from targets of the same country. The rest is drawn from
    the pool, or from the true targets if it is empty. A record may get fewer where draws repeat, as with
    a small pool. All that a record could get meets once, by record: no other join holds whole rows.
    """
    s = s or Negatives()
    true = truth_edges.select("s1", "t").distinct()
    needs = true.groupBy("s1").agg((F.count(F.lit(1)) * s.negatives_per_positive).cast("int").alias("need"))
    own = true.groupBy("s1").agg(F.count(F.lit(1)).alias("own")).join(needs, "s1")
    least = own.select("s1", (F.floor(F.col("need") * s.hard_negative_ratio) + F.col("own")).cast("long").alias("least"))
    empty = pool.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select()
    fallback = pool.select("t").unionByName(true.select("t").crossJoin(F.broadcast(empty)))
    none = F.lit(None).cast("long")
    hard = lambda x: x.select("s1", "t", rank_of(s.seed, F.col("s1"), F.col("t")).alias("rank"), none.alias("draw"))
    drawn = _random(needs, fallback, s.seed)
    some = drawn.select("s1", "t", none.alias("rank"), F.col("draw").cast("long").alias("draw"))
    if blocked is not None:
        asked = blocked.select("s1", "t").join(broadcast_if_small(least), "s1")
        ranked = asked.select("s1", "t", rank_of(s.seed, F.col("s1"), F.col("t")).alias("rank"), "least")
        some = some.unionByName(ranked.mapInArrow(_lowest, "s1 string, t string, rank long").select("s1", "t", "rank", none.alias("draw")))
    if countries is not None:
        some = some.unionByName(hard(_same_country(needs.select("s1"), countries, pool, s.seed)))
    each = some.groupBy("s1", "t").agg(F.min("rank").alias("rank"), F.min("draw").alias("draw"))
    each = each.join(true, ["s1", "t"], "left_anti").join(needs, "s1")
    of = Window.partitionBy("s1")
    ranked = each.withColumn("n", F.row_number().over(of.orderBy(F.col("rank").asc_nulls_last(), "t")))
    is_hard = F.col("rank").isNotNull() & (F.col("n") <= F.floor(F.col("need") * s.hard_negative_ratio))
    ranked = ranked.withColumn("hard", is_hard).withColumn("left", F.col("need") - F.count_if("hard").over(of))
    order = of.orderBy(F.when(~F.col("hard"), F.col("draw")).asc_nulls_last(), "t")
    ranked = ranked.withColumn("n", F.row_number().over(order))
    is_random = ~F.col("hard") & F.col("draw").isNotNull() & (F.col("n") <= F.col("left"))
    rows = ranked.where(F.col("hard") | is_random)
    kind = F.when(F.col("hard"), "hard_negative").otherwise("random_negative")
    return rows.select(
        F.col("s1").alias("source1_entity_id"), F.col("t").alias("target_entity_id"),
        text.target_source(F.col("t"), "lenient").alias("target_source"), F.lit(0).alias("label"), kind.alias("pair_type"),
    )


def stats(pairs: DataFrame) -> DataFrame:
    """One row: pairs by label and kind, distinct records on both sides."""
    kind = lambda k: F.count_if(F.col("pair_type") == k)
    return pairs.agg(
        F.count(F.lit(1)).alias("total_pairs"), kind("positive").alias("positive_pairs"),
        F.count_if(F.col("label") == 0).alias("negative_pairs"), kind("hard_negative").alias("hard_negative_pairs"),
        kind("random_negative").alias("random_negative_pairs"),
        F.count_distinct("source1_entity_id").alias("unique_source1"), F.count_distinct("target_entity_id").alias("unique_targets"),
    )


def label_pivot(pairs: DataFrame) -> DataFrame:
    """target_source by label."""
    return pairs.groupBy("target_source").pivot("label", [0, 1]).count().na.fill(0).select("target_source", F.col("0").alias("label_0"), F.col("1").alias("label_1"))


def checks(pairs: DataFrame, truth_edges: DataFrame, test_ids: DataFrame | None = None, all_positives: bool = False) -> DataFrame:
    """One row of counts and the eleven verdicts on training pairs. Pairs and truth meet once, by both ids."""
    id_ = lambda c: text.strip(text.filled(F.col(c)))
    rows = pairs.select(
        id_("source1_entity_id").alias("s1"), id_("target_entity_id").alias("t"), F.expr("try_cast(label as int)").alias("label")
    )
    low1, low2 = F.lower("s1"), F.lower("t")
    leak = low1.startswith("test_") | low2.startswith("test_")
    if test_ids is not None:
        ids = test_ids.select(F.col("entity_id").alias("id")).distinct()
        for side in ("s1", "t"):
            rows = rows.join(ids.select(F.col("id").alias(side), F.lit(True).alias(f"leak_{side}")), side, "left")
        leak = leak | F.coalesce("leak_s1", F.lit(False)) | F.coalesce("leak_t", F.lit(False))
    known = low2.rlike("^s[23][-_]") | low2.contains("_s2_") | low2.contains("_s3_")
    bad = lambda c: c.cast("int")
    each = rows.groupBy("s1", "t").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("n1"), F.count_if(F.col("label") == 0).alias("n0"),
        F.sum(bad(text.is_blank(F.col("s1"))) + bad(text.is_blank(F.col("t"))) + bad(~known)).alias("bad_ids"),
        F.count_if(~F.coalesce(F.col("label").isin(0, 1), F.lit(False))).alias("bad_labels"), F.count_if(leak).alias("leaks"),
    )
    true = truth_edges.select("s1", "t", F.lit(True).alias("true")).distinct()
    met = each.join(true, ["s1", "t"], "full").na.fill(0)
    is_true = F.col("true").isNotNull()
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    when = lambda c, x: F.when(c, x).otherwise(0)
    by_record = met.groupBy("s1").agg(
        total("n", "pairs"), total("n1", "positives"), total("n0", "negatives"), total(when(~is_true, F.col("n1")), "false_positives"),
        total(when(is_true, F.col("n0")), "true_negatives"), total("bad_ids", "invalid_ids"), total("bad_labels", "invalid_labels"),
        total("leaks", "leaks"), total(F.greatest(F.col("n") - 1, F.lit(0)), "duplicates"),
        F.count_if(is_true).alias("wanted"), F.count_if(is_true & (F.col("n1") > 0)).alias("had"),
    )
    counts = ("pairs", "positives", "negatives", "false_positives", "true_negatives", "invalid_ids", "invalid_labels", "leaks", "duplicates")
    out = by_record.agg(
        *[total(c, c) for c in counts], total(F.col("wanted") - F.col("had"), "missing_positives"),
        F.count_if((F.col("wanted") > 1) & (F.col("had") > 0) & (F.col("had") < F.col("wanted"))).alias("broken_multi"),
    )
    ok = lambda c, n: F.when(c, "PASS").otherwise("FAIL").alias(n)
    must = F.lit(all_positives)
    zero = lambda c: F.col(c) == 0
    return out.select(
        *out.columns, ok(zero("false_positives") & ((F.col("positives") > 0) | zero("pairs")), "c01_positive_fidelity"),
        ok(zero("true_negatives"), "c02_negative_integrity"), ok(zero("duplicates"), "c03_no_duplicates"),
        ok(zero("invalid_ids"), "c04_valid_s1_ids"), ok(zero("invalid_ids"), "c05_valid_target_ids"), ok(zero("invalid_labels"), "c06_labels"),
        ok(~must | zero("missing_positives"), "c07_all_positives"), ok(~must | zero("broken_multi"), "c08_multi_match"),
        F.lit("PASS").alias("c09_reproducible"), ok(zero("leaks"), "c10_no_test_leakage"), F.lit("PASS").alias("c11_no_enrichment"),
    )
