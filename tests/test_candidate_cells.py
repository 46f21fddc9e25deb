"""Final candidates in cells: those of the rows, of which none is handed on that isn't asked for."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kinloom.operators import blocking, candidates, cells
from kinloom.sources import shared

SF = "/root/testdata/sf0.001"
MODE, STRATEGIES = "allow_missing", blocking.Blocking().strategies


def rows(table):
    return sorted(tuple(r) for r in table.select(sorted(table.columns)).collect())


@pytest.fixture(scope="module")
def blocked(spark):
    """Blocks of three records at most, with ids in capitals, of another source, of none and with a line end."""
    words = ["fjord", "blue", "trading", "valley", "green", "quantum", "leap"]
    ids = lambda i: {5: f"S1-{i}", 7: f"S3-{i}", 11: f"x{i}", 13: f"s2_\r{i}", 17: f"s1_ {i}"}.get(i % 19, f"s{i % 3 + 1}_{i}")
    made = [(ids(i), i % 3 + 1, " ".join(words[(i * k) % 7] for k in (1, 2, 3)), f"{words[i % 7]} road {10000 + i % 9}", ["", "us", "de"][i % 4 % 3]) for i in range(80)]
    table = spark.createDataFrame(made, "entity_id string, source int, name string, address string, country string").repartition(3)
    patch = pytest.MonkeyPatch()
    patch.setattr(cells, "SLICE_KEYS", 50)
    patch.setattr(cells, "BLOCK_RECORDS", 3)
    out = shared.written(blocking.blocked(table, F.lit(None).cast("long")), "test-blocks")
    patch.undo()
    return out


@pytest.fixture(scope="module")
def twice(spark, blocked):
    """The rows of the pairs, those of exact names twice."""
    found = cells.pairs(blocked, MODE).withColumn("copy", F.explode(F.when(F.col("mask").bitwiseAND(1) != 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    names = F.array_join(blocking.strategy_names(F.col("mask"), blocking.Blocking()), ",").alias("strategies")
    return shared.written(found.select(F.col("s1").alias("source1_entity_id"), F.col("t").alias("target_entity_id"), "target_source", names), "test-twice")


def test_degrees_are_those_of_the_rows(blocked, twice):
    want = candidates.degree_stats(candidates.final(candidates.marked(twice)))
    assert rows(candidates.cell_degrees(blocked, MODE)) == rows(want) and want.first().pairs > 100


def test_contributions_are_those_of_the_rows(blocked, twice):
    want = candidates.contributions(candidates.final(candidates.marked(twice)))
    assert rows(candidates.cell_contributions(blocked, MODE, STRATEGIES)) == rows(want) and want.count() == 5


def test_checks_are_those_of_the_rows(blocked, twice):
    want = candidates.final_checks(candidates.marked(twice))
    got = candidates.cell_checks(blocked, MODE, twice=1)
    assert got.columns == want.columns and got.first() == want.first()
    assert min(want.first()[k] for k in ("duplicates", "bad_s1_ids", "bad_target_ids", "bad_sources")) > 0
    assert candidates.cell_checks(blocked, MODE, expected=10**6).first().c7_count == "WARN"


def test_final_pairs_are_those_of_the_rows(spark, blocked, twice):
    assert rows(candidates.cell_final(blocked, MODE, STRATEGIES)) == rows(candidates.final(candidates.marked(twice)))
    tests = twice.select(F.col("source1_entity_id").alias("entity_id")).union(twice.select("target_entity_id")).distinct().where("substring(entity_id, -1) in ('1', '3')")
    want = candidates.final(candidates.marked(twice, tests))
    assert rows(candidates.cell_final(cells.flagged(blocked, tests), MODE, STRATEGIES)) == rows(want) and 0 < want.count() < twice.count() - 100
    nothing = cells.flagged(blocked, tests.limit(0))
    assert candidates.cell_final(nothing, MODE, STRATEGIES).count() == candidates.cell_final(blocked, MODE, STRATEGIES).count()


def test_names_are_looked_up_or_joined(spark):
    many = tuple(f"k{i:02d}" for i in range(9, -1, -1))
    for known in (STRATEGIES, many):
        got = spark.range(32).select(candidates._named(F.col("id").cast("int"), known).alias("a"), F.array_join(F.array_sort(F.array_compact(F.array(*[F.when(F.col("id").bitwiseAND(1 << b) != 0, k) for b, k in enumerate(known)]))), ",").alias("b"))
        assert got.where("a <> b").count() == 0


@pytest.mark.parametrize("name", ["candidate_degrees", "strategy_contributions", "final_candidate_checks"])
def test_counts_are_made_in_cells(spark, name):
    """No pair leaves its cell: ids of targets are nowhere in the plan."""
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "target_entity_id" not in plan and "CartesianProduct" in plan


@pytest.mark.parametrize("name", ["candidate_degrees", "strategy_contributions", "final_candidate_checks"])
def test_repeated_ids_count_a_pair_once(spark, tmp_path, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs.write.parquet(str(tmp_path / "once/documents.parquet"))
    docs.unionByName(docs).write.parquet(str(tmp_path / "twice/documents.parquet"))
    once, both = (rows(entry.queries()[name](spark, str(tmp_path / k))) for k in ("once", "twice"))
    assert once == both
