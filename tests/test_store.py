import json

import pytest
from pyspark.sql import functions as F

from folioloom import canonical
from folioloom.plans.view import ViewPlan, view_rows, write_view
from folioloom.sources.adapters import annotated_pages, chat_messages, nested_jsonl, table_parquet
from folioloom.streaming.incremental import ingest

#: Two pages of a made-up leaflet.
BLOCKS = [
    [{"type": "heading", "index": 3, "bbox": [0.25, 0.05, 0.75, 0.15], "angle": 0, "content": "Tide times"}, {"type": "table", "index": 7, "bbox": [0.25, 0.5, 0.5, 0.75], "angle": 90, "content": "<table><tr><td>06:10</td><td>low</td></tr></table>"}],
    [{"type": "interline_equation", "index": 1, "bbox": [0.5, 0.25, 1.0, 0.5], "angle": 0, "content": r"h = a\sin t"}, {"type": "seal", "index": 2, "bbox": [40, 80, 200, 160], "angle": 0, "content": ""}, {"index": 4}],
]


@pytest.fixture
def pages(spark, tmp_path):
    (tmp_path / "tides_model.json").write_text(json.dumps(BLOCKS))
    images = spark.createDataFrame([("tides.jpg", 400, 800)], "path string, width int, height int")
    return annotated_pages(spark, f"{tmp_path}/*_model.json", "demo", images)


def test_annotated_pages(pages):
    assert {k: v.count() for k, v in pages.items()} == {"documents": 1, "pages": 2, "regions": 4, "records": 5, "assets": 6}
    assert sorted(r.task for r in pages["records"].collect()) == ["formula", "layout", "layout", "table", "text"]
    for name, df in pages.items():
        if name not in ("assets",):
            assert canonical.validate(df, name).count() == 0
    boxes = {r.element_type: (r.bbox, r.reading_order) for r in pages["regions"].collect()}
    assert boxes == {"heading": ([100.0, 40.0, 300.0, 120.0], 1), "table": ([100.0, 400.0, 200.0, 600.0], 2), "interline_equation": ([200.0, 200.0, 400.0, 400.0], 1), "seal": ([40.0, 80.0, 200.0, 160.0], 2)}


def test_view_of_pages(spark, pages, tmp_path):
    plan = ViewPlan.of({"name": "demo", "stage": "rlvr", "include": [{"task": t} for t in ("text", "table", "formula", "layout")], "shard_policy": {"rows_per_shard": 2}})
    rows = {r.task: r for r in view_rows(plan, pages["records"], pages["assets"]).collect()}
    labels = sorted(r.label for r in view_rows(plan, pages["records"], pages["assets"]).where("task = 'layout'").collect())
    assert rows["table"].label == "<fcel>06:10<fcel>low<nl>" and rows["formula"].label == r"h = a\sin t"
    assert labels[0].startswith("<|box_start|>100 100 500 200<|box_end|><|ref_start|>seal") or labels[1].startswith("<|box_start|>500 250 1000 500")
    assert any(x.startswith("<|box_start|>250 50 750 150<|box_end|><|ref_start|>heading<|ref_end|><|rotate_up|>") for x in labels)
    assert rows["text"].reward_profile_id == "normalized_levenshtein_v1" and rows["text"].reward_model.ground_truth == "Tide times"
    path = write_view(plan, pages["records"], pages["assets"], f"{tmp_path}/views")
    assert spark.read.parquet(path).count() == 5


def test_chat_and_jsonl_and_tables(spark, tmp_path):
    chat = [{"messages": [{"role": "user", "content": "<image>\nText Recognition:"}, {"role": "assistant", "content": " hi "}], "images": ["a.png"]}, {"messages": [{"role": "user", "content": "Layout Detection:"}, {"role": "assistant", "content": "<|box_start|>0 0 500 1000<|box_end|><|ref_start|>text<|ref_end|>"}], "images": ["b.png"]}, {"messages": [], "images": []}]
    (tmp_path / "chat.json").write_text(json.dumps(chat))
    images = spark.createDataFrame([("b.png", 200, 100)], "path string, width int, height int")
    got = {r.task: r.target for r in chat_messages(spark, f"{tmp_path}/chat.json", "c", images)["records"].collect()}
    assert got["text"].text == "hi" and got["layout"].elements[0].bbox == [0.0, 0.0, 100.0, 100.0]
    rows = [{"record_id": "1", "subset_id": s, "label": r"\[ x^2 \]", "size_key": "48_16", "image_path": "i.jpg", "label_empty": False} for s in ("u", "v")] + [{"record_id": "2", "subset_id": "u", "label": " ", "label_empty": True}]
    (tmp_path / "r.jsonl").write_text("\n".join(map(json.dumps, rows)))
    out = nested_jsonl(spark, f"{tmp_path}/r.jsonl", "n")
    assert out["documents"].select("document_id").distinct().count() == 2
    assert {r.target.latex for r in out["records"].collect()} == {"x^2"} and {r.width for r in out["pages"].collect()} == {48}
    spark.createDataFrame([("t/x.png", None, ["<tr><td>", "1", "</td></tr>"])], "filename string, image struct<bytes:binary,path:string>, html_with_text array<string>").write.parquet(f"{tmp_path}/t")
    assert table_parquet(spark, f"{tmp_path}/t", "t")["records"].first().target.html == "<table><tr><td>1</td></tr></table>"


def test_store_overwrites_only_its_partitions_and_appends_new_ids(spark, pages, tmp_path):
    root = f"{tmp_path}/store"
    other = pages["documents"].withColumns({"source_name": F.lit("other"), "document_id": F.lit("doc:other:1")})
    canonical.write(pages["documents"], root, "documents")
    canonical.write(other, root, "documents")
    canonical.write(other, root, "documents")
    canonical.write(pages["documents"], root, "documents", append=True)
    assert canonical.read(spark, root, "documents").count() == 2
    assert canonical.read(spark, root, "pages") is None


def test_ingest_reads_new_files_once(spark, tmp_path):
    one = lambda k: spark.createDataFrame([(k, "s")], "document_id string, source_name string").write.mode("append").parquet(f"{tmp_path}/in")
    run = lambda: ingest(spark, f"{tmp_path}/in", "document_id string, source_name string", f"{tmp_path}/store", "documents", f"{tmp_path}/cp", lambda df: df)
    one("a")
    run()
    one("b")
    one("a")
    run()
    run()
    assert sorted(r.document_id for r in canonical.read(spark, f"{tmp_path}/store", "documents").collect()) == ["a", "b"]


def test_bad_plans():
    for config in ({}, {"name": "x", "stage": "nope"}, {"name": "x", "shard_policy": {"rows_per_shard": -1}}):
        with pytest.raises(ValueError):
            ViewPlan.of(config)
