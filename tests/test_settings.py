import json

from kinloom.operators import blocking, features, pairs
from kinloom.plans import settings


def test_file_env_file_and_environment(tmp_path):
    (tmp_path / "s.yaml").write_text("raw: /a\nout: /b\nblocking:\n  max_posting_list_size: 9\n  prefix_length: 5\n")
    (tmp_path / ".env").write_text('# no\nexport KINLOOM_OUT="/c"\nKINLOOM_BLOCKING__PREFIX_LENGTH=6\nOTHER=1\n')
    tree = settings.load(f"{tmp_path}/s.yaml", {"KINLOOM_BLOCKING__PREFIX_LENGTH": "7", "KINLOOM_NEGATIVES__SEED": "3"})
    run = settings.run_of(tree)
    assert (run.raw, run.out, run.settings.max_posting_list_size, run.settings.prefix_length, run.negatives.seed) == ("/a", "/c", 9, 7, 3)


def test_json_and_missing_files(tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"raw": "x", "out": "y", "unknown": 1}))
    assert settings.run_of(settings.load(f"{tmp_path}/s.json", {})).settings == blocking.Blocking()
    assert settings.load(f"{tmp_path}/none.yaml", {}) == {}
    assert settings.load(None, {"KINLOOM_SETTINGS": f"{tmp_path}/s.json"})["raw"] == "x"


def test_capped_pools(spark):
    r = lambda *ids: spark.createDataFrame([(i, "n", "a", "us") for i in ids], "entity_id string, business_name string, business_address string, country string")
    assert [x.entity_id for x in blocking.targets(r("s2_2", "s2_1"), r("s3_1"), first=2).collect()] == ["s2_1", "s2_2"]
    assert sorted(x.t for x in pairs.pool(r("s2_2", "s2_1"), r("s3_1"), first=1).collect()) == ["s2_1", "s3_1"]


def test_feature_schema():
    made = features.feature_schema("7")
    assert [m["name"] for m in made] == features.feature_names() and {m["version"] for m in made} == {"7"}
