import pytest

from folioloom.config import apply, execution, expanded, relative, under
from folioloom.functions import prompts


def test_paths():
    known = {"A": "x", "B_1": "y"}
    assert expanded("$A/${B_1}z$A", known) == "x/yzx" and expanded("plain", {}) == "plain"
    assert under("/r/", "a/$A", known) == "/r/a/x" and under("/r", "/abs") == "/abs" and under("/r", "s3://b/c") == "s3://b/c"
    assert relative("/r", "/r/a/b") == "a/b" and relative("/r", "/q/a") == "/q/a"
    for bad in ("$NOPE", "${A"):
        with pytest.raises((KeyError, ValueError)):
            expanded(bad, known)


def test_execution():
    assert execution({"num_workers": 8}, {"num_workers": 4, "worker_batch_size": 512}, None) == {"num_workers": 8, "worker_batch_size": 512, "schema_sample_size": 4096}
    with pytest.raises(ValueError):
        execution({"num_workers": 0})


def test_only_named_options_become_settings(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    apply(spark, {"num_workers": None}, None)
    assert spark.conf.get(key) == before
    apply(spark, {"num_workers": None}, {"num_workers": 3})
    assert spark.conf.get(key) == "3"
    spark.conf.set(key, before)


def test_rules_of_older_profiles_are_ranked():
    rules = [{"match": {"task_type_contains": "a table or text"}, "prompt": "first"}, {"match": {"region_type": "table"}, "prompt": "second"}, {"match": {"region_type": "seals"}, "prompt": "third"}, {"match": {"region_type": "formula"}}, {"match": {"task_type": "formula"}, "prompt": "late"}, {}]
    old = {"region": {"rules": rules}, "page": {"rules": [{"match": {"region_type": "other"}, "prompt": "no"}], "default": "whole"}, "detection": {"default": "boxes"}}
    assert prompts.by_task(old) == {"table": "first", "text": "first", "layout": "boxes", "page": "whole"}
    assert prompts.by_task({}) == {} and prompts.by_task({"region": None}) == {}


def test_templates_of_tasks(spark):
    tasks = spark.createDataFrame([("text",), ("seal",), ("odd",)], "task string")
    pick = lambda profile: [r.p for r in tasks.select(prompts.chosen(profile, {"seal": "built in"}).alias("p")).collect()]
    assert pick({"text": "own"}) == ["own", "built in", prompts.UNKNOWN]
    assert pick({"text": "own", "default": "others"}) == ["own", "others", "others"]
