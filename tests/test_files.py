import gzip
import json
import os
import random
import shutil
import subprocess
import sys
import zipfile

import pytest
from pyspark.sql import functions as F

from kinloom import cli
from kinloom.operators import blocking
from kinloom.sources import tables as io
from kinloom.streaming import linking

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FILES = {
    "train/train_source1.tsv": [("s1_1", 'Bright "Star" Ltd', "5 Kings Road", "UK"), ("s1_2", "North Mill", "", "France"), ("s1_3", "Void", "", "")],
    "train/train_source2.tsv": [("s2_1", "bright star", "5 Kings Rd", "GB"), ("s2_2", "North Mill SA", "Rue 9", "FR"), ("s2_3", "Some Else", "", "")],
    "train/train_source3.tsv": [("s3_1", "Bright Star Limited", "", ""), ("s3_2", "More", "", "")],
    "test/test_source1.tsv": [("t1_1", "A", "", "")], "test/test_source2.tsv": [("t2_1", "A", "", "")], "test/test_source3.tsv": [("t3_1", "A", "", "")],
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    cell = lambda x: '"' + x.replace('"', '""') + '"' if '"' in x else x
    for name, lines in FILES.items():
        (d / name).parent.mkdir(exist_ok=True)
        (d / name).write_text("\t".join(io.RECORD_COLUMNS) + "\n" + "".join("\t".join(map(cell, r)) + "\n" for r in lines))
    (d / "train/train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\ns1_1\ts2_1,s3_1\ns1_2\ts2_2\ns1_3\t\n")
    return str(d)


def test_reading(spark, root):
    t = io.read_tsv(spark, io.join_path(root, "train/train_source1.tsv")).orderBy("entity_id").collect()
    assert [tuple(r) for r in t] == FILES["train/train_source1.tsv"]
    with pytest.raises(FileNotFoundError):
        io.read_tsv(spark, io.join_path(root, "nothing.tsv"))
    assert io.join_path("s3://bucket/a/", "/b") == "s3a://bucket/a/b"
    with pytest.raises(ValueError):
        io.join_path("s3://", "b")
    assert io.read_records(spark, root, "train/train_source1.tsv", first=2).count() == 2


def test_all_commands(spark, root, tmp_path):
    out = str(tmp_path)
    run = lambda *a: cli.main([*a], spark)
    assert run("validate", "--input", root, "--output", f"{out}/v") == 0
    assert json.load(open(f"{out}/v/validation_report.json"))["status"] == "PASS"
    assert run("normalize", "--input", root, "--output", f"{out}/n") == 0
    n = spark.read.options(**io._TSV).csv(f"{out}/n/train/train_source1_normalized.tsv")
    assert n.columns == list(io.NORMAL_COLUMNS) and n.where("entity_id = 's1_1'").first().business_name_core == "bright star"
    for normal in ([], ["--normalized", f"{out}/n"]):
        assert run("evaluate-blocking", "--input", root, "--output", f"{out}/e", *normal) == 0
        assert json.load(open(f"{out}/e/blocking_strategy_results.json"))["overall"]["recall"] == 1.0
    assert run("training-pairs", "--input", root, "--output", f"{out}/p") == 0
    assert run("generate-candidates", "--input", root, "--output", f"{out}/c") == 0
    assert run("evaluate-recall", "--input", f"{out}/c/candidate_pairs.tsv", "--ground-truth", f"{root}/train/train_ground_truth.tsv", "--output", f"{out}/r") == 0
    assert json.load(open(f"{out}/r/blocking_recall_report.json"))["recall"] == 1.0
    assert run("finalize", "--input", f"{out}/c/candidates", "--output", f"{out}/f") == 0
    assert run("features", "--input", root, "--output", f"{out}/x", "--pairs", f"{out}/f/candidates") == 0
    assert run("features", "--input", root, "--output", f"{out}/x", "--pairs", f"{out}/p/training_pairs", "--mode", "train") == 0
    x, y = spark.read.parquet(f"{out}/x/matrix_train/X"), spark.read.parquet(f"{out}/x/matrix_train/y")
    assert len(x.columns) == 53 and x.join(y, ["row_key", "row_copy"]).count() == y.count() == y.distinct().count() > 0


def test_limits_and_all_features(spark, root, tmp_path):
    out = str(tmp_path)
    run = lambda *a: cli.main([*a], spark)
    assert run("training-pairs", "--input", root, "--output", f"{out}/p", "--max-rows", "1") == 0
    made = spark.read.parquet(f"{out}/p/training_pairs")
    assert {r.source1_entity_id for r in made.collect()} == {"s1_1"}
    assert run("generate-candidates", "--input", root, "--output", f"{out}/c", "--sample-size", "1") == 0
    found = spark.read.parquet(f"{out}/c/candidates")
    assert {r.source1_entity_id for r in found.collect()} == {"s1_1"}
    assert run("features", "--input", root, "--output", f"{out}/x", "--mode", "all", "--pairs", f"{out}/c/candidates", "--training-pairs", f"{out}/p/training_pairs") == 0
    assert spark.read.parquet(f"{out}/x/features_train").count() == made.count() and spark.read.parquet(f"{out}/x/features_candidates").count() == found.count()


def test_smoke(spark, tmp_path):
    assert cli.main(["smoke-test", "--output", str(tmp_path)], spark) == 0
    assert set(json.load(open(f"{tmp_path}/smoke_report.json"))["steps"].values()) == {"PASS"}
    with pytest.raises(SystemExit):
        cli.main(["validate", "--output", str(tmp_path)], spark)


def test_countries_of_the_report_are_whole(spark, root, tmp_path):
    d = tmp_path / "raw"
    shutil.copytree(root, d)
    lines = "".join(f"s2_{i}\tn{i}\ta\tc{i}\n" for i in range(1500))
    (d / "train/train_source2.tsv").write_text("\t".join(io.RECORD_COLUMNS) + "\n" + lines)
    cli.main(["validate", "--input", str(d), "--output", f"{tmp_path}/v"], spark)
    assert len(json.load(open(f"{tmp_path}/v/validation_report.json"))["files"]["train/train_source2.tsv"]["countries"]) == 1500


def test_a_quoted_line_break_and_gzip_are_read(spark, tmp_path):
    cell = '"two\nlines ""quoted"""'
    (tmp_path / "a.tsv").write_text(f"x\ty\n1\t{cell}\n2\tplain\n")
    assert sorted(map(tuple, io.read_tsv(spark, f"{tmp_path}/a.tsv").collect())) == [("1", 'two\nlines "quoted"'), ("2", "plain")]
    with gzip.open(tmp_path / "b.tsv.gz", "wt") as f:
        f.write("x\ty\n" + "".join(f"{i}\t\n" for i in range(100)))
    table = io.read_tsv(spark, f"{tmp_path}/b.tsv.gz")
    assert table.count() == 100 and table.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_cells_come_back_as_they_were(spark, tmp_path):
    """Generated cells of quotes, tabs, line breaks, backslashes and blanks, written and read back."""
    draw = random.Random(1)
    parts = ['"', "\t", "\n", "\r", "\\", " ", "a", "é", ",", "'", '""']
    rows = [(str(i), "".join(draw.choices(parts, k=draw.randint(0, 6))), "".join(draw.choices(parts, k=draw.randint(0, 6)))) for i in range(800)]
    table = spark.createDataFrame(rows, "id string, x string, y string")
    for kind in ("none", "gzip"):
        io.write_tsv(table, f"{tmp_path}/{kind}.tsv", compression=kind)
        assert sorted(map(tuple, io.read_tsv(spark, f"{tmp_path}/{kind}.tsv").collect())) == sorted(rows)


def test_a_missing_file_fails(spark, root, tmp_path):
    assert cli.main(["validate", "--input", str(tmp_path), "--output", f"{tmp_path}/v"], spark) == 1


def test_streamed_records_are_linked(spark, tmp_path):
    schema = "entity_id string, business_name string, business_address string, country string"
    s2 = spark.createDataFrame([("s2_1", "bright star", "", ""), ("s2_2", "other", "", "")], schema)
    targets = linking.index(s2, s2.limit(0))
    arrived = spark.createDataFrame([("s1_1", "Bright Star Ltd", "", ""), ("s1_2", "Nobody", "", "")], schema)
    arrived.write.parquet(f"{tmp_path}/in")
    stream = linking.new_records(spark, f"{tmp_path}/in", arrived.schema)
    q = linking.run(stream, targets, f"{tmp_path}/out", f"{tmp_path}/cp")
    q.processAllAvailable()
    q.stop()
    assert [(r.s1, r.t) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("s1_1", "s2_1")]
    batch = blocking.pairs(arrived, s2, s2.limit(0))
    assert {(r.s1, r.t, r["mask"]) for r in linking.link(arrived, targets).collect()} == {(r.s1, r.t, r["mask"]) for r in batch.collect()}
    assert linking.key_stream(stream, targets).isStreaming
    timed = linking.once(stream.withColumn("at", F.current_timestamp()), "at", "1 hour")
    assert timed.isStreaming


def test_library_stands_without_the_llm_folder(tmp_path):
    """The entry, and with it every query of the library, must import where the subpackage and the pipeline are gone."""
    archive = f"{tmp_path}/r.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for top, _, names in os.walk(f"{ROOT}/kinloom"):
            if "llm" not in top and "__pycache__" not in top:
                for n in names:
                    z.write(os.path.join(top, n), os.path.relpath(os.path.join(top, n), ROOT))
        z.write(f"{ROOT}/__spark_entry__.py", "__spark_entry__.py")
    zipfile.ZipFile(archive).extractall(f"{tmp_path}/r")
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=f"{tmp_path}/r", env={**os.environ, "PYTHONPATH": f"{tmp_path}/r"}, capture_output=True).returncode == 0
