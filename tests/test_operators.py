from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from kinloom.operators import blocking, candidates, features, normalize, pairs, quality, recall, truth

RECORD = "entity_id string, business_name string, business_address string, country string"


def records(spark, rows):
    return spark.createDataFrame(rows, RECORD)


@pytest.fixture(scope="module")
def world(spark):
    """Five records to link: exact, word order, suffix and dots, typo, several targets; one without a match."""
    s1 = records(spark, [
        ("s1_1", "Blue Fjord Trading Ltd.", "14 Harbour Lane, Bergen 50120", "Norway"), ("s1_2", "Green Valley Organics", "9 Orchard St", "US"),
        ("s1_3", "Müller & Sohn GmbH", "Hauptstr. 7, Berlin 10115", "Germany"), ("s1_4", "Quantum Leap Robotics", "", "JP"), ("s1_5", "Lonely Island Cafe", "1 Nowhere Rd", ""),
    ])
    s2 = records(spark, [
        ("s2_1", "blue fjord trading", "14 harbour ln", "Norway"), ("s2_2", "Organics Green Valley Inc", "9 Orchard Street", "USA"), ("s2_3", "Mueller Sohn", "Hauptstr 7 Berlin 10115", "de"),
        ("s2_4", "Quantum Leep Robotics K.K.", "Tokyo", "Japan"), ("s2_9", "Other Thing", "77 Else Blvd", "FR"),
    ])
    s3 = records(spark, [("s3_1", "Blue Fjord Trading Limited", None, "norway"), ("s3_2", "Unrelated Works", "5 Far Ave", "US")])
    lists = spark.createDataFrame([("s1_1", "s2_1,s3_1"), ("s1_2", "s2_2"), ("s1_3", " s2_3 "), ("s1_4", "s2_4"), ("s1_5", "")], "source1_entity_id string, matched_entity_ids string")
    return s1, s2, s3, lists


def rows(table, *columns):
    return sorted(tuple(r[c] for c in columns or table.columns) for r in table.collect())


def test_all_true_pairs_are_found(world):
    s1, s2, s3, lists = world
    edges, found = truth.edges(lists), blocking.pairs(s1, s2, s3)
    total = recall.overall(edges, found, s1, s2.unionByName(s3)).first()
    assert (total.recall, total.missed, total.true_pairs) == (1.0, 0, 5) and total.reduction_ratio > 0.5
    assert {r.s1: r.n for r in recall.per_record(s1, found).collect()}["s1_5"] == 0
    assert recall.missed(edges, found).collect() == []


def test_composite_is_the_union_of_strategies(world):
    s1, s2, s3, _ = world
    whole = set(rows(blocking.pairs(s1, s2, s3), "s1", "t"))
    parts = [set(rows(blocking.pairs(s1, s2, s3, replace(blocking.Blocking(), strategies=(s,))), "s1", "t")) for s in blocking.Blocking().strategies]
    assert set().union(*parts) == whole


def test_address_keys(spark):
    s = replace(blocking.Blocking(), strategies=("address_conservative",))
    keys = lambda a: [k for _, k in rows(blocking.keys(records(spark, [("x", "", a, "")]), s), "entity_id", "key")]
    assert keys("100 Market Street 94105") == ["addr_num:100_market", "addr_tok:market", "addr_zip:94105"]
    assert keys("Suite 400") == [] and keys("Baker 22") == ["addr_num:22_baker", "addr_tok:baker"]
    assert keys("12 34 Elm") == ["addr_num:34_elm"] and keys("") == []


def test_suppression_counts_rows_and_keeps_the_limit(spark):
    targets = records(spark, [(f"s2_{i}", "common name", "", "") for i in range(3)])
    empty = records(spark, [])
    one = records(spark, [("s1_1", "common name", "", "")])
    for most, n in ((3, 3), (2, 0)):
        assert blocking.pairs(one, targets, empty, replace(blocking.Blocking(), max_posting_list_size=most)).count() == n
    stats = blocking.posting_stats(blocking.target_keys(targets, empty), replace(blocking.Blocking(), max_posting_list_size=2)).first()
    assert stats.active_keys == 0 and stats.largest == 3


@pytest.mark.parametrize(("mode", "want"), [("allow_missing", ["s2_1", "s2_3"]), ("strict", ["s2_1"]), ("none", ["s2_1", "s2_2", "s2_3"])])
def test_country_modes(spark, mode, want):
    s1 = records(spark, [("s1_1", "acme", "", "US")])
    s2 = records(spark, [("s2_1", "acme", "", "usa"), ("s2_2", "acme", "", "FR"), ("s2_3", "acme", "", "")])
    assert [t for (t,) in rows(blocking.pairs(s1, s2, records(spark, []), replace(blocking.Blocking(), country_agreement_mode=mode)), "t")] == want


def test_strategy_names(spark):
    assert blocking.strategies_of(" Address ") == ("address_conservative",) and blocking.strategies_of("composite") == blocking.Blocking().strategies
    with pytest.raises(ValueError):
        blocking.strategies_of("nothing")
    assert blocking.Blocking.from_dict(blocking.Blocking(seed=7).to_dict()) == blocking.Blocking(seed=7)


def test_own_strategy(spark):
    blocking.register("initials", lambda s: F.array(F.concat(F.lit("ini:"), F.substring("name", 1, 1))))
    s = replace(blocking.Blocking(), strategies=("initials",))
    found = blocking.candidates(records(spark, [("s1_1", "abc", "", "")]), records(spark, [("s2_1", "axe", "", ""), ("s2_2", "box", "", "")]), records(spark, []), s)
    assert [(r.target_entity_id, r.strategies) for r in found.collect()] == [("s2_1", ["initials"])]


def test_recall_of_parts(world, spark):
    s1, s2, s3, lists = world
    edges = truth.edges(lists)
    found = spark.createDataFrame([("s1_1", "s2_1"), ("s1_2", "s2_9"), ("s1_2", "s2_2")], "s1 string, t string")
    got = recall.s1_recovery(edges, found).first()
    assert (got.records, got.zero, got.full, got.partial, got.recovered, got.missed, got.consistent) == (4, 2, 1, 1, 2, 3, True)
    assert [(r.target_source, r.recall) for r in recall.by_source(edges, found).orderBy("target_source").collect()] == [("Source 2", 0.5), ("Source 3", 0.0)]
    several = recall.multi_match(s1, edges, found).first()
    assert (several.records, several.pairs, several.recovered, several.whole) == (1, 2, 1, 0)
    none = recall.zero_match(s1, edges, found).first()
    assert (none.records, none.most) == (1, 0)
    assert recall.overall(edges.limit(0), found, s1, s2).first().recall == 1.0
    assert {(r.country, r.recall) for r in recall.by_country(edges, found, normalize.fields(s1)).collect()} >= {("us", 1.0), ("norway", 0.5)}


def test_truth_of_three_shapes(spark, world):
    edges = {("s1_1", "s2_1", "Source 2"), ("s1_1", "s3_1", "Source 3")}
    lists = spark.createDataFrame([("s1_1", "s2_1, s3_1,,s2_1"), ("s1_2", "null"), (" ", "s2_5"), (None, "s2_6")], "source1_entity_id string, matched_entity_ids string")
    labelled = spark.createDataFrame([("s1_1", "s2_1", "1"), ("s1_1", "s3_1", "positive"), ("s1_1", "s2_7", "0")], "source1_entity_id string, target_entity_id string, label string")
    plain = spark.createDataFrame([("s1_1", "s2_1"), ("s1_1", "s3_1"), ("s1_1", "s3_1")], "a string, b string")
    for t in (lists, labelled, plain):
        assert set(rows(truth.positives(t), "s1", "t", "target_source")) == edges
    p = truth.profile(lists).first()
    assert (p.row_count, p.unique_source1, p.zero_match, p.multi_match, p.duplicates_in_rows, p.missing_source1) == (4, 2, 1, 1, 1, 2)


def test_quality(spark):
    t = records(spark, [("a", "x", "", "US"), ("a", "NULL", " ", None), ("", None, "y", "US"), (" b ", "z", "y", "FR")])
    q = {r.column: (r.null_count, r.empty_count, r.whitespace_count, r.valid_count) for r in quality.column_quality(t).collect()}
    assert q["business_name"] == (2, 0, 0, 2) and q["business_address"] == (0, 1, 1, 2)
    i = quality.id_integrity(t).first()
    assert (i.row_count, i.unique_ids, i.duplicate_ids, i.missing_ids) == (4, 2, 1, 1)
    assert [(r.country, r.row_count, r.percentage) for r in quality.country_distribution(t).collect()] == [("US", 2, 50.0), ("<MISSING>", 1, 25.0), ("FR", 1, 25.0)]
    lists = spark.createDataFrame([("a", "p,,p,q"), ("zz", ""), ("", "p")], "source1_entity_id string, matched_entity_ids string")
    got = quality.truth_quality(lists, t, records(spark, [("p", "", "", "")])).first()
    assert (got.row_count, got.empty_match_count, got.missing_source1_id_count, got.malformed_reference_count, got.duplicate_in_match_list_count, got.invalid_source1_reference_count, got.invalid_match_reference_count) == (3, 1, 1, 1, 1, 1, 1)


def test_training_pairs(spark, world):
    s1, s2, s3, lists = world
    edges = truth.edges(lists)
    pool = normalize.fields(s2).unionByName(normalize.fields(s3)).select(F.col("entity_id").alias("t"), "country")
    settings = pairs.Negatives(negatives_per_positive=2)
    made = pairs.positives(edges).unionByName(pairs.negatives(edges, pool, settings, normalize.fields(s1), blocking.pairs(s1, s2, s3)))
    again = pairs.positives(edges).unionByName(pairs.negatives(edges, pool.repartition(3), settings, normalize.fields(s1), blocking.pairs(s1, s2, s3)))
    assert rows(made) == rows(again)
    verdict = pairs.checks(made, edges, all_positives=True).first().asDict()
    assert verdict["positives"] == 5 and verdict["negatives"] >= 6 and "FAIL" not in verdict.values()
    per = {}
    for s, t, label in rows(made.where("label = 0"), "source1_entity_id", "target_entity_id", "label"):
        per[s] = per.get(s, 0) + 1
    assert per["s1_1"] <= 4 and per["s1_2"] == 2
    bad = made.unionByName(spark.createDataFrame([("s1_1", "s2_1", "Source 2", 0, "x"), ("test_1", "zz", "", 7, "x")], made.schema))
    verdict = pairs.checks(bad, edges).first()
    assert (verdict.duplicates, verdict.true_negatives, verdict.invalid_ids, verdict.invalid_labels, verdict.leaks) == (1, 1, 1, 1, 1)


def test_hard_share_is_floored(spark):
    edges = spark.createDataFrame([("s1_1", "s2_1", "Source 2"), ("s1_2", "s2_1", "Source 2"), ("s1_2", "s2_2", "Source 2")], "s1 string, t string, target_source string")
    pool = spark.createDataFrame([(f"s2_{i}", "us") for i in range(200)], "t string, country string")
    countries = spark.createDataFrame([("s1_1", "us"), ("s1_2", "us")], "entity_id string, country string")
    kinds = pairs.negatives(edges, pool, countries=countries).groupBy("source1_entity_id", "pair_type").count()
    assert rows(kinds) == [("s1_1", "random_negative", 1), ("s1_2", "hard_negative", 1), ("s1_2", "random_negative", 1)]


def test_final_candidates(spark):
    raw = spark.createDataFrame([
        ("s1_1", "s2_1", "Source 2", "exact_name"), ("s1_1", "s2_1", "Source 2", "exact_name"), ("s1_1", "s3_1", "Source 2", "name_token,exact_name"), ("s1_0", "s2_2", "Source 2", ""), ("x", "s2_3", "Source 2", ""), ("s1_4", "s2_bad", "Source 2", ""),
    ], "source1_entity_id string, target_entity_id string, target_source string, strategies string").coalesce(1)
    placed = candidates.with_position(raw)
    marked = candidates.marked(placed, spark.createDataFrame([("s2_bad",)], "entity_id string"))
    assert rows(candidates.final(marked), "source1_entity_id", "target_entity_id", "target_source") == [("s1_0", "s2_2", "Source 2"), ("s1_1", "s2_1", "Source 2"), ("s1_1", "s3_1", "Source 3"), ("x", "s2_3", "Source 2")]
    c = candidates.final_checks(marked, candidates.inversions(placed), expected=9, commit="abc").first()
    assert (c.input_rows, c.output_rows, c.duplicates, c.bad_s1_ids, c.bad_sources, c.leaks, c.inversions) == (6, 4, 1, 1, 1, 1, 2)
    assert (c.c4_order, c.c5_duplicates, c.c6_test_leakage, c.c7_count, c.c8_commit, c.status) == ("FAIL", "WARN", "FAIL", "WARN", "PASS", "FAIL")
    assert rows(candidates.contributions(candidates.final(marked))) == [("exact_name", 2), ("name_token", 1)]
    d = candidates.degree_stats(candidates.final(marked)).first()
    assert (d.records, d.least, d.most, d.pairs, d.source3_pairs) == (3, 1, 2, 4, 1)
    assert candidates.blocking_checks(raw).first().c04_no_duplicates == "FAIL"


def test_features(spark, world):
    s1, s2, s3, _ = world
    known = features.one_of_each(*[normalize.normalize(r) for r in (s1, s2, s3)])
    asked = spark.createDataFrame([("s1_1", "s3_1", "Source 3", "exact_name,name_token"), ("s1_2", "nobody", "", "")], "source1_entity_id string, target_entity_id string, target_source string, strategies string")
    made = {r.source1_entity_id: r for r in features.pair_features(asked, known).collect()}
    a, b = made["s1_1"], made["s1_2"]
    assert len(features.feature_names()) == 51
    assert (a.name_core_exact_match, a.name_exact_match, a.name_token_overlap_count, a.name_token_jaccard, a.country_exact_match, a.is_target_source3, a.strategy_count, a.strategy_name_token, a.target_address_missing, a.total_available_fields) == (1, 0, 3, 0.6, 1, 1, 2, 1, 1, 5)
    assert (b.target_found, b.target_name_missing, b.strategy_count, b.country_missing_either, b.is_target_source2, b.total_available_fields, b.name_char_qgram_jaccard) == (False, 1, 1, 1, 0, 3, 0)
    c = features.checks(features.pair_features(asked, known), candidate=True, expected=2).first()
    assert (c.row_count, c.missing_targets, c.c1_schema, c.c3_finite, c.c5_rows, c.status) == (2, 1, "PASS", "PASS", "PASS", "PASS")
    assert features.checks(features.pair_features(asked.withColumn("label", F.lit(1)), known), candidate=True).first().c4_no_labels == "FAIL"
    assert len(features.summary(features.pair_features(asked, known)).collect()) == 51


def test_normalize_needs_its_columns(spark):
    with pytest.raises(ValueError):
        normalize.normalize(spark.createDataFrame([("a",)], "entity_id string"))


def test_empty_tables(spark):
    none = records(spark, [])
    assert blocking.candidates(none, none, none).collect() == []
    lists = spark.createDataFrame([], "source1_entity_id string, matched_entity_ids string")
    assert truth.profile(lists).first().row_count == 0 and quality.column_quality(none).count() == 4
    assert recall.by_strategy(truth.edges(lists), blocking.pairs(none, none, none), none, none).count() == 6
