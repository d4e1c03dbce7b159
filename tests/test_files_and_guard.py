import os
import shutil
import struct
import subprocess
import sys
from pathlib import Path

import pytest

from folioloom.functions.content import content_text
from folioloom.functions.images import image_size
from folioloom.operators.views import score_predictions, view_violations
from folioloom.sources.files import image_listing, markdown_outputs, resolved_images

REPO = Path(__file__).resolve().parents[1]
PNG = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 100, 200) + b"\x08\2\0\0\0"
JPEG = b"\xff\xd8\xff\xe0\0\x04ab\xff\xc0\0\x11\x08" + struct.pack(">HH", 20, 10) + b"\3" * 12
WEBP = b"RIFF\0\0\0\0WEBPVP8X\0\0\0\0\0\0\0\0" + (49).to_bytes(3, "little") + (29).to_bytes(3, "little")


@pytest.mark.parametrize("raw,size", [(PNG, (100, 200, "png")), (JPEG, (10, 20, "jpeg")), (WEBP, (50, 30, "webp")), (b"GIF89a" + struct.pack("<HH", 3, 4), (3, 4, "gif")), (b"", (None,) * 3), (None, (None,) * 3), (PNG[:12], (None,) * 3), (b"\xff\xd8\0\0", (None,) * 3)])
def test_image_size(raw, size):
    assert image_size(raw) == size


def test_listing_and_markdown(spark, tmp_path):
    (tmp_path / "im").mkdir()
    (tmp_path / "im" / "a.png").write_bytes(PNG)
    (tmp_path / "im" / "b.txt").write_bytes(b"x")
    assert [tuple(r) for r in image_listing(spark, f"{tmp_path}/im").collect()] == [("a.png", 100, 200, "png")]
    (tmp_path / "md" / "s1" / "out").mkdir(parents=True)
    (tmp_path / "md" / "s1" / "out" / "s1.md").write_bytes(b"# caf\xc3\xa9")
    assert [(r.sample_id, r.text) for r in markdown_outputs(spark, f"{tmp_path}/md").collect()] == [("s1", "# café")]


@pytest.mark.parametrize("files,ask,want", [(["abc_long.jpg"], "abc", "abc_long.jpg"), (["abc.png", "abc_long.jpg"], "abc", "abc.png"), (["p_x.jpg", "p_y.jpg", "p_z.jpg"], "p_2", "p_y.jpg"), (["q.jpg"], "z", None), (["a.png", "a.jpg"], "a", "a.jpg")])
def test_resolution(spark, files, ask, want):
    got = resolved_images(spark.createDataFrame([(ask,)], "sample_id string"), spark.createDataFrame([(f,) for f in files], "name string"))
    assert got.first().image == want


def test_content():
    assert content_text('{"a": [{"content": "x"}], "content": "y"}') == "y\nx"
    assert content_text("plain") == "plain" and content_text(None) == "" and content_text('"s"') == "s" and content_text('{"a": 1}') == '{"a": 1}'


def test_unknown_prediction_fails(spark):
    view = spark.createDataFrame([("a", "x", "normalized_levenshtein_v1")], "id string, label string, reward_profile_id string")
    ok = spark.createDataFrame([("a", "x")], "id string, prediction string")
    assert score_predictions(view, ok).first().score == 1.0
    with pytest.raises(Exception, match="no view row"):
        score_predictions(view, spark.createDataFrame([("b", "x")], "id string, prediction string")).collect()


def test_view_needs_columns(spark):
    with pytest.raises(ValueError):
        view_violations(spark.createDataFrame([(1,)], "id int"))


def test_entry_works_without_the_pipeline_operators(tmp_path):
    for name in ("folioloom", "__spark_entry__.py"):
        (shutil.copytree if (REPO / name).is_dir() else shutil.copy)(REPO / name, tmp_path / name)
    shutil.rmtree(tmp_path / "folioloom" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and 'split_assign' in q and set(e.oracle_sql()) <= set(q); print(len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=False)
    assert out.returncode == 0, out.stderr
