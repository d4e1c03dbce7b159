"""Exports, resizing, failures, checks of views and the command line."""

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioloom import canonical, cli
from folioloom.functions import images, numeric, prompts
from folioloom.functions import text as T
from folioloom.operators import deploy, lineage, tables
from folioloom.operators import select as S
from folioloom.operators import views as V
from folioloom.plans import export
from folioloom.plans.view import ViewPlan, failures, view_assets, view_rows, write_view
from folioloom.sources.adapters import annotated_pages, embedded_images, nested_jsonl, scan_documents
from folioloom.sources.files import write_files

PAGES = [[{"type": "paragraph", "index": 5, "bbox": [0.0, 0.0, 0.5, 0.5], "angle": 0, "content": "Low water at noon"}, {"type": "table", "index": 6, "bbox": [0.5, 0.5, 1.0, 1.0], "angle": 0, "content": "<table><tr><td>1</td></tr></table>"}]]


def source(spark, folder, middle=None):
    (folder / "m1_model.json").write_text(json.dumps(PAGES))
    sizes = spark.createDataFrame([("m1.jpg", 40, 20)], "path string, width int, height int")
    return annotated_pages(spark, f"{folder}/*_model.json", "leaflets", sizes, middle)


def picture(width, height, filters=(0, 1, 2, 3, 4)):
    """A PNG whose lines use all filters, and its pixels."""
    rng = np.random.default_rng(1)
    pixels = rng.integers(0, 256, (height, width, 3), dtype=np.uint8)
    lines, above = [], np.zeros((width, 3), int)
    for y in range(height):
        kind, line = filters[y % len(filters)], pixels[y].astype(int)
        left = np.vstack([np.zeros((1, 3), int), line[:-1]])
        corner = np.vstack([np.zeros((1, 3), int), above[:-1]])
        p = left + above - corner
        a, b, c = abs(p - left), abs(p - above), abs(p - corner)
        paeth = np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))
        guess = (0 * line, left, above, (left + above) // 2, paeth)[kind]
        lines.append(bytes([kind]) + ((line - guess) % 256).astype(np.uint8).tobytes())
        above = line
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b""), pixels


def test_png_round_trip_and_resizing():
    raw, pixels = picture(9, 11)
    assert (images.decoded_png(raw) == pixels).all() and (images.decoded_png(images.encoded_png(pixels)) == pixels).all()
    flat = np.full((10, 30, 3), 200, np.uint8)
    square = images.resized(flat, 15, True)
    assert square.shape == (15, 15, 3) and (abs(square[7].astype(int) - 200) <= 1).all() and (square[0] == 0).all()
    assert (abs(images.resized(flat, 5, False).astype(int) - 200) <= 1).all() and (images.resized(pixels, 9, False).shape) == (9, 9, 3)
    assert images.refitted_bytes(b"no image", 5, True) is None and images.refitted_bytes(None, 5, True) is None
    assert (images.decoded_png(images.cropped_bytes(raw, [2, 3, 5, 7])) == pixels[3:7, 2:5]).all()


def test_views_resize_and_tell_failures(spark, tmp_path):
    made = source(spark, tmp_path)
    raw, _ = picture(40, 20, (0,))
    files = spark.createDataFrame([("m1.jpg", bytearray(raw))], "path string, content binary")
    config = {"name": "fit", "include": [{"task": "layout"}, {"task": "text"}], "image_transform": {"layout": {"resize_to": 100, "pad_to_square": True}}, "image_policy": {"filter": {"max_aspect_ratio": 1.5}}}
    plan = ViewPlan.of(config)
    rows = {r.task: r for r in view_rows(plan, made["records"], made["assets"], files).collect()}
    # 40 by 20 becomes 100 by 100 with 25 above: the ratio of what is shown is 1
    assert set(rows) == {"layout"} and rows["layout"].label.startswith("<|box_start|>0 250 500 500<|box_end|><|ref_start|>paragraph")
    assert rows["layout"].images_path[0].startswith("assets/view_asset_fit_layout")
    (asset,) = view_assets(plan, made["records"], made["assets"], files).collect()
    assert asset.path == rows["layout"].images_path[0] and images.image_size(asset.content) == (100, 100, "png")
    assert spark.read.parquet(write_view(plan, made["records"], made["assets"], f"{tmp_path}/v", files)).count() == 1
    with pytest.raises(Exception, match="can't resize the image of"):
        view_rows(plan, made["records"], made["assets"]).collect()
    skipping = ViewPlan.of(config | {"skip_failure": True, "include": [{"task": "layout"}, {"task": "table"}, {"task": "text"}], "image_policy": {"materialization": {"mode": "embedded"}}})
    assert view_rows(skipping, made["records"], made["assets"]).count() == 0
    told = {r.task: r for r in failures(skipping, made["records"], made["assets"]).collect()}
    assert set(told) == {"layout", "table", "text"} and told["table"].target_keys == ["html"] and told["text"].target_preview == "text=Low water at noon"
    assert told["table"].exception_type == "ValueError" and told["layout"].message.startswith("can't resize the image of record:")


def test_middle_files_and_folders(spark, tmp_path):
    middle = {"pdf_info": [{"page_size": [400, 200], "para_blocks": [{"index": 5, "bbox": [1, 2, 30, 40]}, {"index": 5, "bbox": [3, 4, 50, 60]}, {"index": 9}]}]}
    (tmp_path / "m1_middle.json").write_text(json.dumps(middle))
    made = source(spark, tmp_path, f"{tmp_path}/*_middle.json")
    boxes = {r.source_annotation_id: r.bbox for r in made["regions"].collect()}
    assert boxes == {"5": [3.0, 4.0, 50.0, 60.0], "6": [200.0, 100.0, 400.0, 200.0]}
    assert [(r.width, r.height) for r in made["pages"].collect()] == [(400, 200)]
    folder = tmp_path / "lines" / "set7" / "annotations"
    folder.mkdir(parents=True)
    (folder / "records.jsonl").write_text(json.dumps({"record_id": "r1", "label": "ink", "image_path": "p.png"}) + "\n")
    docs = nested_jsonl(spark, f"{tmp_path}/lines/*/annotations/*.jsonl", "n")["documents"].collect()
    assert [d.source_document_id for d in docs] == ["set7/r1"]
    assert [tuple(r) for r in scan_documents(spark, f"{tmp_path}/lines/*/annotations/*.jsonl", "n").collect()] == [(docs[0].document_id, "set7/r1", "p.png")]


def test_crops_and_files(spark, tmp_path):
    made = source(spark, tmp_path)
    raw, pixels = picture(40, 20)
    files = spark.createDataFrame([("m1.jpg", bytearray(raw))], "path string, content binary")
    crops = export.region_crops(made, files)
    assert crops.count() == 2
    write_files(crops, f"{tmp_path}/out")
    boxes = sorted(images.decoded_png(p.read_bytes()).shape for p in (tmp_path / "out" / "assets").iterdir())
    assert boxes == [(10, 20, 3), (10, 20, 3)]
    rows = [("a/b.png", (bytearray(raw), "t/b.png"), ["<tr></tr>"])]
    spark.createDataFrame(rows, "filename string, image struct<bytes:binary,path:string>, html_with_text array<string>").write.parquet(f"{tmp_path}/tables")
    write_files(embedded_images(spark, f"{tmp_path}/tables"), f"{tmp_path}/out")
    assert (tmp_path / "out" / "t" / "b.png").read_bytes() == raw


def test_formats_are_for_their_tasks(spark, tmp_path):
    made = source(spark, tmp_path)
    for formats, error in (({"text": "latex_plain_v1"}, ValueError), ({"text": "no_such_v1"}, KeyError)):
        with pytest.raises(error):
            view_rows(ViewPlan.of({"name": "x", "include": [{"task": "text"}], "target_serialization": formats}), made["records"], made["assets"])


def test_exports_resume_and_report(spark, tmp_path):
    root = f"{tmp_path}/store"
    got = export.export(spark, source(spark, tmp_path), root, "annotated_pages", "leaflets", tasks=["text", "layout"])
    assert (got["documents"], got["records"], got["records/text"], got["skipped"]) == (1, 2, 1, 0)
    (tmp_path / "m2_model.json").write_text(json.dumps(PAGES))
    sizes = spark.createDataFrame([("m1.jpg", 40, 20)], "path string, width int, height int")
    both = annotated_pages(spark, f"{tmp_path}/*_model.json", "leaflets", sizes)
    assert export.report(export.limited(both, 1)).where("name = 'pages'").first().n == 1
    got = export.export(spark, both, root, "annotated_pages", "leaflets", skip_completed=True)
    assert (got["scanned"], got["skipped"], got["documents"]) == (2, 1, 1)
    assert canonical.read(spark, root, "documents").count() == 2 and canonical.read(spark, root, "records").count() == 5
    report = json.loads("\n".join(r.value for r in spark.read.text(f"{root}/manifests/source=leaflets").collect()))
    assert report["adapter"] == "annotated_pages" and report["report"]["skipped"] == 1
    export.write_asset_manifest(spark, root, f"{tmp_path}/assets.parquet")
    assert spark.read.parquet(f"{tmp_path}/assets.parquet").count() == canonical.read(spark, root, "assets").count()
    with pytest.raises(ValueError):
        export.limited(both, -1)
    assert lineage.record_files(spark.read.parquet(f"{root}/records")).count() == 5


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m1_model.json").write_text(json.dumps(PAGES))
    root, out = f"{tmp_path}/store", f"{tmp_path}/views"
    assert cli.main(["export-source", "annotated_pages", f"{tmp_path}/in", "leaflets", root, "--max-samples", "5"]) == 0
    assert cli.main(["validate-canonical", root]) == 0
    (tmp_path / "view.yaml").write_text("name: v\nstage: rlvr\ninclude:\n  - task: text\n  - task: table\nsplit_policy: {train_ratio: 1.0}\n")
    (tmp_path / "prompts.yaml").write_text("system_prompt: Read.\ntask: {text: 'Say {{ image_placeholder }} of {{ source_name }}'}\n")
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    assert cli.main(["build-view", f"{tmp_path}/view.yaml", root, out, "--num-workers", "2", "--prompts", f"{tmp_path}/prompts.yaml"]) == 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    view = {r.task: r for r in spark.read.parquet(f"{out}/v").collect()}
    assert [t.content for t in view["text"].prompt] == ["Read.", "Say <image> of leaflets"]
    assert cli.main(["reward-smoke-test", f"{out}/v"]) == 0 and "'mean': 1.0" in capsys.readouterr().out
    assert cli.main(["validate-view", f"{out}/v"]) == 0
    (tmp_path / "none").mkdir()
    assert cli.main(["validate-view", f"{out}/v", "--images", f"{tmp_path}/none"]) == 1
    assert cli.main(["deploy-manifest", f"{out}/v", f"{tmp_path}/list"]) == 0
    lines = [r.value for r in spark.read.text(f"{tmp_path}/list").collect()]
    assert lines == sorted(lines) and len(lines) >= 3


def test_older_prompt_profiles():
    old = {"page": {"rules": [{"match": {"task_type": "layout_detection"}, "prompt": "Boxes"}]}, "region": {"rules": [{"match": {"region_type": "table"}, "prompt": "Cells"}, {"match": {"task_type_contains": "formula"}, "prompt": "TeX"}]}}
    assert prompts.by_task(old) == {"layout": "Boxes", "table": "Cells", "formula": "TeX"} and prompts.by_task({"task": {"text": "x"}}) == {"text": "x"}


def test_carriers_and_required_columns(spark):
    with pytest.raises(ValueError, match="extra_info"):
        V.grpo_violations(spark.createDataFrame([(1,)], "prompt int"))
    turn = "prompt array<struct<role:string,content:string>>"
    rows = [(1, [("user", "<image>")], ["a.png"], None), (2, [("user", "<image>")], ["a.png"], [b"x"]), (3, [("user", "<image>")], None, [b""]), (4, [("user", "hi")], None, None), (5, [("user", "<image>")], ["../a"], None)]
    df = spark.createDataFrame(rows, f"id int, {turn}, images_path array<string>, images_bytes array<binary>").withColumns({"extra_info": F.lit("x"), "data_source": F.lit("s")})
    got = {}
    for r in V.grpo_violations(df).collect():
        got.setdefault(r.id, set()).add(r.rule)
    assert got == {2: {"image_carriers", "image_count"}, 3: {"image_valid"}, 4: {"image_data"}, 5: {"image_valid"}}


def test_small_operators(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "i int, n string, m string")
    assert tables.without_null_columns(df, ["n", "m", "z"]).columns == ["i", "m"]
    with pytest.raises(Exception, match="no split for 2"):
        S.split_by_table(df, "i", spark.createDataFrame([(1, "val")], "i int, split string")).collect()
    with pytest.raises(Exception, match="no node z"):
        deploy.chosen_nodes(spark.createDataFrame([("a",)], "name string"), ["z"]).collect()
    with pytest.raises(Exception, match="can't be negative"):
        spark.range(1).select(numeric.schedule(F.lit(-1), "constant", value=1)).collect()
    one = spark.range(1).select(T.as_list(F.lit(None).cast("string"), "string").alias("a"), T.as_list(F.array(F.lit("x")), "array<string>").alias("b"), T.first_positive(F.lit("0"), F.lit("x"), F.lit("12.7")).alias("c")).first()
    assert (one.a, one.b, one.c) == ([], ["x"], 12)
    c = lineage.checkpoint_record(spark.createDataFrame([("a", "{}")], "checkpoint_id string, config string")).first()
    assert c.config_hash == "44136fa355b3678a1146ad16f7e8649e94fb4fc21fe77e8310c060f61caaff8a"
