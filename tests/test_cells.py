"""The join in cells: the pairs of the join on keys, without a shuffle of pairs."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kinloom.operators import blocking, candidates, cells, pairs
from kinloom.plans import adapters
from kinloom.sources import shared

SF = "/root/testdata/sf0.001"


def rows(table):
    return sorted(tuple(r) for r in table.collect())



@pytest.mark.parametrize("mode", ["allow_missing", "strict", "none"])
@pytest.mark.parametrize("slice_keys,block", [(4_000_000, 12_288), (50, 3)])
def test_cells_give_the_pairs_of_the_join(spark, monkeypatch, mode, slice_keys, block):
    monkeypatch.setattr(cells, "SLICE_KEYS", slice_keys)
    monkeypatch.setattr(cells, "BLOCK_RECORDS", block)
    words = ["fjord", "blue", "trading", "valley", "green", "quantum", "leap"]
    made = [(f"s{i % 3 + 1}_{i}", i % 3 + 1, " ".join(words[(i * k) % 7] for k in (1, 2, 3)), f"{i % 5} {words[i % 7]} road {10000 + i % 9}", ["", "us", "de"][i % 4 % 3]) for i in range(60)]
    table = spark.createDataFrame(made, "entity_id string, source int, name string, address string, country string").repartition(3)
    s = blocking.Blocking(max_posting_list_size=9, country_agreement_mode=mode)
    index = blocking.keys_of(table.where("source > 1"), s, ("source",)).select(F.col("entity_id").alias("t"), F.concat(F.lit("Source "), F.col("source").cast("string")).alias("target_source"), "country", "key", "bit")
    want = blocking.match(blocking.keys_of(table.where("source = 1"), s), blocking.kept_index(index, s), s)
    blocked = shared.written(blocking.blocked(table, F.lit(None).cast("long"), s), "test-blocks")
    got = cells.pairs(blocked, mode)
    assert rows(got.drop("tagged")) == rows(want) and got.where("tagged").isEmpty() and not want.isEmpty()


def test_no_pairs_without_records(spark):
    table = spark.createDataFrame([], "entity_id string, source int, name string, address string, country string")
    assert cells.pairs(shared.written(blocking.blocked(table, F.lit(None).cast("long")), "test-blocks"), "none").collect() == []


@pytest.mark.parametrize("name", ["candidates_allow_missing", "candidates_strict", "candidates_none", "final_candidates", "final_candidates_without_test_ids", "final_candidate_checks", "strategy_contributions", "blocking_checks", "blocking_leaks", "candidate_degrees"])
def test_pairs_are_not_shuffled(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "partitioning(" in line and "Exchange" in line]
    assert "rangepartitioning" not in plan
    assert not [x for x in exchanges if "target_entity_id" in x]


def test_adjacent_copies_are_counted_as_by_windows(spark):
    made = [("s1_1", "s2_1", "Source 2", "b"), ("s1_1", "s2_1", "Source 2", "a"), ("s1_1", "s2_1", "Source 3", "a"), ("s1_1", "s3_1", "Source 3", ""), ("s1_2", "s3_1", "Source 3", "x"), ("s1_2", "s3_1", "Source 3", "x")]
    raw = spark.createDataFrame(made, "source1_entity_id string, target_entity_id string, target_source string, strategies string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        same = candidates.marked(raw, together=True)
        assert rows(same.select(sorted(same.columns))) == rows(candidates.marked(raw).select(sorted(same.columns)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repeated_ids_give_a_pair_once(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs.unionByName(docs).write.parquet(str(tmp_path / "documents.parquet"))
    found = adapters.found(spark, str(tmp_path))
    assert found.count() == found.select("s1", "t").distinct().count() > 0


def test_lowest_ranks_are_enough(spark):
    table = spark.createDataFrame([("a", str(i), i * 7 % 20, 3) for i in range(20)] + [("b", "x", 5, 2)], "s1 string, t string, rank long, least long").coalesce(1)
    kept = rows(table.mapInArrow(pairs._lowest, "s1 string, t string, rank long"))
    assert {r[2] for r in kept if r[0] == "a"} == {0, 1, 2} and ("b", "x", 5) in kept
