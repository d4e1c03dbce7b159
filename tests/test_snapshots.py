"""Views that are replaced as a whole, failures that nothing prunes, and files of resized images."""

import json

import pytest
from pyspark.sql import functions as F

from folioloom import cli
from folioloom.functions import images
from folioloom.plans import snapshots
from folioloom.plans.view import ViewPlan, read_view, view_rows, write_view
from folioloom.sources.file_sink import content_path, write_files
from tests.test_runs import picture, source

PLAN = ViewPlan.of({"name": "v", "include": [{"task": "layout"}, {"task": "table"}, {"task": "text"}], "shard_policy": {"rows_per_shard": 1}, "split_policy": {"level": "record", "train_ratio": 1.0, "val_ratio": 0.0}})


def broken(records):
    """A record of a task that has no format beside the others."""
    return records.unionByName(records.where("task = 'text'").withColumns({"task": F.lit("diagram"), "record_id": F.lit("bad")}))


ANY = ViewPlan.of({"name": "v", "include": [{}], "split_policy": {"level": "record", "train_ratio": 1.0, "val_ratio": 0.0}})


def test_a_failing_build_leaves_the_old_view(spark, tmp_path):
    made, root = source(spark, tmp_path), f"{tmp_path}/views"
    write_view(PLAN, made["records"], made["assets"], root)
    assert snapshots.current(spark, f"{root}/v")["rows"] == {"train": 3}
    with pytest.raises(Exception, match="no format for task diagram"):
        write_view(ANY, broken(made["records"]), made["assets"], root)
    assert spark.read.parquet(f"{root}/v").count() == read_view(spark, f"{root}/v").count() == 3
    assert not list((tmp_path / "views" / "_staged" / "v").iterdir())
    write_view(ANY, made["records"].where("task = 'text'"), made["assets"], root)
    assert read_view(spark, f"{root}/v").count() == 1 and snapshots.current(spark, f"{root}/v")["rows"] == {"train": 1}
    assert not list((tmp_path / "views" / "_replaced" / "v").iterdir())


def test_a_build_that_dies(spark, tmp_path):
    made, root = source(spark, tmp_path), tmp_path / "views"
    view = write_view(PLAN, made["records"], made["assets"], str(root))
    # a driver that dies while it writes leaves files that nothing refers to
    spark.range(5).write.parquet(f"{root}/_staged/v/1-dead/split=train")
    assert read_view(spark, view).count() == 3
    # one that dies between the renames leaves no view, but a whole one beside it
    spark.range(7).write.parquet(f"{root}/_staged/v/2-whole/split=train")
    (root / "_staged" / "v" / "2-whole" / "_committed").write_text('{"rows": {"train": 7}}')
    (root / "_replaced" / "v").mkdir(parents=True, exist_ok=True)
    (root / "v").rename(root / "_replaced" / "v" / "2-whole")
    assert read_view(spark, view).count() == 7 and snapshots.current(spark, view)["rows"] == {"train": 7}
    write_view(PLAN, made["records"], made["assets"], str(root))
    assert read_view(spark, view).count() == 3


def test_splits_without_rows_vanish_and_shards_are_cut(spark, tmp_path):
    made, root = source(spark, tmp_path), f"{tmp_path}/views"
    keys = [r.record_id for r in made["records"].select("record_id").collect()]
    given = lambda *names: spark.createDataFrame(list(zip(keys, names, strict=True)), "record_id string, split string")
    path = write_view(PLAN, made["records"], made["assets"], root, splits=given("train", "val", "test"))
    assert {p.name for p in (tmp_path / path).iterdir() if p.is_dir()} == {"split=train", "split=val", "split=test"}
    path = write_view(PLAN, made["records"], made["assets"], root, splits=given("train", "train", "train"))
    assert [p.name for p in (tmp_path / path).iterdir() if p.is_dir()] == ["split=train"]
    assert len(list((tmp_path / path / "split=train").glob("*.parquet"))) == 3
    with pytest.raises(Exception, match="no such split: extra"):
        write_view(PLAN, made["records"], made["assets"], root, splits=given("train", "extra", "test"))
    assert read_view(spark, f"{root}/v").count() == 3


def test_failures_are_not_pruned(spark, tmp_path):
    made = source(spark, tmp_path)
    rows = view_rows(ANY, broken(made["records"]), made["assets"])
    for use in (rows.count, rows.select("label").collect, rows.select(F.lit(1)).collect, rows.groupBy("split").count().collect):
        with pytest.raises(Exception, match="no format for task diagram"):
            use()
    good = view_rows(ANY, made["records"], made["assets"])
    assert [good.where(F.col("task") == t).count() for t in ("layout", "text", "none")] == [1, 1, 0]


def test_every_file_that_a_view_refers_to_exists(spark, tmp_path):
    made = source(spark, tmp_path)
    raw, _ = picture(40, 20, (0,))
    files = spark.createDataFrame([("m1.jpg", bytearray(raw))], "path string, content binary")
    twice = made["records"].where("task = 'layout'")
    twice = twice.unionByName(twice.withColumn("record_id", F.lit("again")))
    plan = ViewPlan.of({"name": "fit", "include": [{"task": "layout"}], "image_transform": {"layout": {"resize_to": 100, "pad_to_square": True}}})
    path = write_view(plan, twice, made["assets"], f"{tmp_path}/views", files)
    rows = read_view(spark, f"{tmp_path}/views/fit").collect()
    (there,) = (tmp_path / "views").glob("assets/*")
    assert len(rows) == 2 and {r.images_path[0] for r in rows} == {f"assets/{there.name}"}
    assert images.image_size(there.read_bytes()) == (100, 100, "png")
    assert {p.name for p in (tmp_path / path).iterdir() if p.name[0] != "."} == {"split=train", "_SUCCESS", "_committed"}


def test_files_are_written_whole_and_once(spark, tmp_path):
    rows = spark.range(200).select((F.col("id") % 3).cast("string").cast("binary").alias("content")).repartition(7)
    rows = rows.select(content_path(F.col("content"), F.lit("a/x_"), ".bin").alias("path"), "content")
    for _ in range(2):
        write_files(rows, f"{tmp_path}/out", "keep")
    assert sorted(p.read_bytes() for p in (tmp_path / "out" / "a").iterdir()) == [b"0", b"1", b"2"]
    write_files(spark.createDataFrame([("b/y", bytearray(b"old")), ("b/none", None)], "path string, content binary"), f"{tmp_path}/out")
    write_files(spark.createDataFrame([("b/y", bytearray(b"new"))], "path string, content binary"), f"{tmp_path}/out")
    assert [p.read_bytes() for p in (tmp_path / "out" / "b").iterdir()] == [b"new"]
    with pytest.raises(Exception, match="use append"):
        rows.write.format("files").mode("overwrite").save(f"{tmp_path}/out")


def test_command_line_reads_the_view(spark, tmp_path, capsys):
    made = source(spark, tmp_path)
    write_view(PLAN, made["records"], made["assets"], f"{tmp_path}/views")
    assert cli.main(["deploy-manifest", f"{tmp_path}/views/v", f"{tmp_path}/list"]) == 0
    assert "'view_files': 3" in capsys.readouterr().out
    assert json.loads((tmp_path / "views" / "v" / "_committed").read_text())["rows"] == {"train": 3}
