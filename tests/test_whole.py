"""Queries over whole tables, and blocking, against brute force."""

from collections import defaultdict
from dataclasses import replace

import pytest

import __spark_entry__ as entry
from kinloom.operators import blocking, candidates, truth
from kinloom.plans import adapters, queries
from kinloom.sources import shared
from kinloom.sources import tables as io

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Ninety documents of one first line, thirty a source; twelve of them in two copy groups, the rest apart; null and empty texts."""
    path = str(tmp_path_factory.mktemp("whole"))
    text = lambda i: f"Harbour Lane Bakery\n{i} Orchard Street" if i >= 12 else f"Harbour Lane Bakery\ncopy {i // 6}"
    rows = [(i, text(i), "en", "src1", 0) for i in range(90)] + [(i, f"Lone Name{i}\nplace {i}", "de", "src1", 0) for i in range(90, 99)]
    rows += [(99, None, "en", "src1", 0), (100, None, None, "src1", 0), (101, None, "en", None, 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    return path


def brute_pairs(spark, sf_dir, most):
    """s1, t and bits of pairs that share a key of at most ``most`` targets, of agreeing countries."""
    by = defaultdict(list)
    for r in adapters.keys(spark, sf_dir).collect():
        by[r.key].append((r.entity_id, r.country, r.bit))
    found = defaultdict(int)
    for rows in by.values():
        right = [x for x in rows if x[0][1] != "1"]
        for a, c1, bit in (x for x in rows if x[0][1] == "1" and len(right) <= most):
            for b, c2, _ in right:
                if not c1 or not c2 or c1 == c2:
                    found[a, b] |= bit
    return found


def test_pairs_are_those_of_the_production_settings(spark, tables):
    assert queries.SETTINGS == blocking.Blocking() and queries.MOST == 500
    want = brute_pairs(spark, tables, 500)
    got = entry.queries()["candidates_allow_missing"](spark, tables).collect()
    names = sorted(zip(queries.SETTINGS.strategies, (1, 2, 4, 8, 16)))
    assert {(r.source1_entity_id, r.target_entity_id): r.strategies for r in got} == {k: ",".join(n for n, b in names if m & b) for k, m in want.items()}


@pytest.mark.parametrize("most", [5, 20])
def test_suppressed_keys_make_no_pairs(spark, tables, most):
    s = replace(blocking.Blocking(), max_posting_list_size=most)
    found = blocking.match(adapters.left_keys(spark, tables), blocking.kept_index(adapters.index(spark, tables), s), s)
    want = brute_pairs(spark, tables, most)
    assert {(r.s1, r.t): r["mask"] for r in found.collect()} == want and len(want) < len(brute_pairs(spark, tables, 500))


def test_salted_keys_make_the_same_pairs(spark, tables, monkeypatch):
    monkeypatch.setattr(blocking, "HOT", 7)
    left, index = adapters.left_keys(spark, tables), blocking.kept_index(adapters.index(spark, tables))
    hot = blocking.hot_keys(left)
    assert hot.count() > 0
    plain, salted = blocking.match(left, index), blocking.match(left, index, None, hot)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))


def test_entry_finds_records_of_a_common_first_line(spark, tables):
    by = {r.strategy: r for r in queries.flagship(spark, tables).collect()}
    assert by["exact_name"].recall == by["composite"].recall == 1.0 and by["exact_name"].candidate_pairs >= 30 * 60


def brute_matches(spark, sf_dir):
    rows = [(r.entity_id, r.source, r.text) for r in adapters.all_records(spark, sf_dir).collect()]
    return {(a, b) for a, k, x in rows if k == 1 for b, j, y in rows if j > 1 and x == y and x is not None}


@pytest.mark.parametrize("most", [500, 2])
def test_truth_has_all_equal_texts(spark, tables, monkeypatch, most):
    monkeypatch.setattr(adapters, "LIST", most)  # lists of about two ids: a record has several rows
    want = brute_matches(spark, tables)
    assert len(want) == 16
    for edges in (truth.edges(adapters.truth(spark, tables)), adapters.matches(spark, tables)):
        assert sorted((r.s1, r.t, r.target_source[-1]) for r in edges.collect()) == sorted((a, b, b[1]) for a, b in want)
    one = [r.entity_id for r in adapters.sources(spark, tables)[0].collect()]
    lists = spark.createDataFrame([(a, ",".join(sorted(b for c, b in want if c == a))) for a in one], "source1_entity_id string, matched_entity_ids string")
    assert entry.queries()["truth_cardinality"](spark, tables).collect() == truth.cardinality(lists).collect()
    assert entry.queries()["truth_profile"](spark, tables).first().asDict() == truth.profile(lists).first().asDict()


def test_no_equal_text_is_a_negative(spark, tables):
    want = brute_matches(spark, tables)
    rows = entry.queries()["training_pairs"](spark, tables).collect()
    assert {(r.source1_entity_id, r.target_entity_id) for r in rows if r.label == 1} == want
    negative = [(r.source1_entity_id, r.target_entity_id) for r in rows if r.label == 0]
    assert len(negative) == 2 * len(want) and not want & set(negative)


def scans(table):
    """Files of documents that the executed plan reads."""
    table.collect()
    return table._jdf.queryExecution().executedPlan().toString().count("documents.parquet")


def test_shared_tables_are_read_instead_of_documents(spark, tables):
    known = entry.queries()
    known["training_pairs"](spark, tables), known["feature_summary"](spark, tables)
    for name in ("training_pairs", "training_pair_checks", "candidates_allow_missing", "blocking_recall", "record_recovery", "final_candidates", "feature_summary"):
        assert scans(known[name](spark, tables)) == 0


def test_shared_tables_follow_the_documents(spark, tmp_path):
    path = str(tmp_path)
    write = lambda n: spark.createDataFrame([(i, f"name {i}", "en", "s", 1) for i in range(n)], DOCS).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    write(3)
    assert entry.queries()["normalized_records"](spark, path).count() == 3
    write(5)
    assert entry.queries()["normalized_records"](spark, path).count() == 5


def test_a_cluster_needs_a_shared_folder(spark):
    class Cluster:
        conf = {}
        sparkContext = type("C", (), {"master": "spark://somewhere:7077", "applicationId": "x"})()

    with pytest.raises(RuntimeError):
        shared.shared_folder(Cluster())


@pytest.mark.parametrize("kind", ["parquet", "tsv"])
def test_order_is_that_of_files_and_rows(spark, tmp_path, kind):
    """Three sorted files of uneven size, which Spark reads largest first, are in order; one swapped row isn't."""
    rows = [(f"s1_{i:07d}", f"s2_{i:07d}", "Source 2", "exact_name") for i in range(6100)]

    def folder(name, rows):
        for part, (a, b) in enumerate(((0, 100), (100, 1100), (1100, 6100))):
            table = spark.createDataFrame(rows[a:b], "source1_entity_id string, target_entity_id string, target_source string, strategies string").coalesce(1)
            out = f"{tmp_path}/{name}/part={part}"
            io.write_parquet(table, out) if kind == "parquet" else io.write_tsv(table, out)
        return f"{tmp_path}/{name}/*"

    read = lambda p: spark.read.parquet(p) if kind == "parquet" else io.read_tsv(spark, p, dealt=False)
    n = lambda p: candidates.inversions(candidates.with_position(read(p))).first().inversions
    assert n(folder("sorted", rows)) == 0
    rows[600], rows[601] = rows[601], rows[600]
    assert n(folder("swapped", rows)) == 1
