"""Features of pairs in cells: those of the join with records, without one."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kinloom.functions import text
from kinloom.operators import blocking, cells, features, normalize
from kinloom.sources import shared

SF = "/root/testdata/sf0.001"
STRATEGIES = blocking.Blocking().strategies


def rows(table):
    return sorted((tuple(r) for r in table.select(sorted(table.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def world(spark):
    """Records with blanks, names of one to five letters, signs beyond 16 bits, numbers, and ids that say another source."""
    names = ["", "a", "né", "abc", "abcd ltd", "abcde gmbh", "\U0001d51f\U0001d51e\U0001d51f\U0001d51e trading", "blue fjord trading ltd", "blue fjord", None]
    streets = ["", None, "5 valley road 12345", "7 valley road 12345", "green valley 12 12 quantum 99999", "quantum leap road"]
    made = [(("S3-" if i % 17 == 0 else f"s{i % 3 + 1}_") + str(i), i % 3 + 1, names[i % 10], streets[i * 7 % 6], ["", "us", "Deutschland", None][i % 4]) for i in range(120)]
    raw = spark.createDataFrame(made, "entity_id string, source int, business_name string, business_address string, country string")
    return normalize.normalize(raw.repartition(3), extra=("source",))


@pytest.fixture(scope="module")
def both(spark, world):
    """Blocks with described records, and features by the join."""
    kept = ("entity_id", "business_name_core", "business_name_alnum", "business_address_alnum", "country_normalized", "source")
    fields = normalize.stored_fields(features.described(world, kept), extra=("source", "about"))
    made = shared.written(blocking.blocked(fields, F.lit(None).cast("long")), "test-described")
    found = cells.pairs(made, "allow_missing")
    pairs = found.select(F.col("s1").alias("source1_entity_id"), F.col("t").alias("target_entity_id"), "target_source", blocking.strategy_names(F.col("mask"), blocking.Blocking()).alias("strategies"))
    known = features.one_of_each(*[world.where(F.col("source") == k).drop("source") for k in (1, 2, 3)])
    return made, shared.written(features.pair_features(pairs, known), "test-features")


def test_features_are_those_of_the_join(spark, both):
    blocked, want = both
    got = features.feature_cells(blocked, "allow_missing", STRATEGIES)
    assert got.columns == [c for c in want.columns if c not in ("strategies", "s1_found", "target_found")]
    assert want.count() > 500 and rows(got) == rows(want.select(got.columns))
    assert want.where("name_char_qgram_jaccard between 0.01 and 0.99").count() > 0 and want.where("is_target_source2 = 1 and is_target_source3 = 1").count() > 0


def test_summary_and_checks_are_those_of_the_rows(spark, both):
    blocked, want = both
    near = lambda t: sorted((r.feature, round(r["mean"], 12), r.least, r.most) for r in t.collect())
    assert near(features.cell_summary(blocked, "allow_missing", STRATEGIES)) == near(features.summary(want))
    assert rows(features.cell_checks(blocked, "allow_missing", STRATEGIES)) == rows(features.checks(want, candidate=True))
    assert features.cell_checks(blocked, "allow_missing", STRATEGIES, expected=1).first().c5_rows == "WARN"


def test_nothing_of_no_pairs(spark, world):
    kept = ("entity_id", "business_name_core", "business_name_alnum", "business_address_alnum", "country_normalized", "source")
    fields = normalize.stored_fields(features.described(world.where("source = 2"), kept), extra=("source", "about"))
    for some in (fields, fields.limit(0)):
        blocked = shared.written(blocking.blocked(some, F.lit(None).cast("long")), "test-described")
        assert features.feature_cells(blocked, "none", STRATEGIES).isEmpty()
        assert features.cell_checks(blocked, "none", STRATEGIES).first().row_count == 0
        summed = features.cell_summary(blocked, "none", STRATEGIES).collect()
        assert len(summed) == 51 and {r["mean"] for r in summed} == {None}


@pytest.mark.parametrize("common", [0, 0.02, 2])
@pytest.mark.parametrize("matches", [1 << 20, 3])
def test_intersections_are_those_of_sets(monkeypatch, common, matches):
    """All members in bits, some, none; lists laid out at once and a few at a time."""
    monkeypatch.setattr(cells, "COMMON", common)
    monkeypatch.setattr(cells, "MATCHES", matches)
    monkeypatch.setattr(cells, "GATHERED", 7)
    r = np.random.default_rng(1)
    sides = [[[set(map(str, r.zipf(1.4, r.integers(0, 30)) % 200)) for _ in range(n)] for _ in range(2)] for n in (23, 31)]

    def coded(records):
        column = pa.array([{"x": list(s)} for s in records], pa.struct([("x", pa.list_(pa.string()))]))
        parts = [cells._columns(column.slice(at, 9)) for at in range(0, len(records), 9)]
        return cells._set_of(*cells._joined(parts)[1]["x"])

    count = cells.intersections([(coded(a), coded(b)) for a, b in zip(*sides)])
    lefts, rights = np.divmod(np.flatnonzero(r.random(23 * 31) < 0.4), 31)
    for got, a, b in zip(count(lefts, rights), *sides):
        assert got.tolist() == [len(a[i] & b[k]) for i, k in zip(lefts, rights)]


def test_trigrams_are_windows_of_characters(spark):
    names = ["", "ab", "abc", "a b c", "\U0001d51f\U0001d51eé\U0001d51f", "aaaa", "x" * 5000 + "y", None]
    made = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "n string, i int").select("i", text.trigrams(F.col("n")).alias("q")).collect()
    assert {r.i: sorted(r.q) for r in made} == {i: sorted({n[k : k + 3] for k in range(len(n) - 2)}) if n else [] for i, n in enumerate(names)}


@pytest.mark.parametrize("name", ["features_candidates", "feature_summary", "feature_checks"])
def test_features_shuffle_neither_pairs_nor_records(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x or "partitioning(" in x]
    assert not [x for x in joins if "entity_id" in x or "l_key" in x or "r_key" in x]


def test_repeated_ids_give_features_once(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs.unionByName(docs).write.parquet(str(tmp_path / "documents.parquet"))
    made = entry.queries()["features_candidates"](spark, str(tmp_path))
    n = made.count()
    assert n == made.select("source1_entity_id", "target_entity_id").distinct().count() > 0
    assert entry.queries()["feature_checks"](spark, str(tmp_path)).first().row_count == n
