"""Look-ups that read one file, and lines and rows with their numbers."""

import json

import pytest
from pyspark.sql import functions as F

from folioloom import canonical, cli
from folioloom.operators import index
from folioloom.plans.view import ViewPlan, read_view, write_view
from folioloom.sources.lines import numbered_lines, numbered_rows
from tests.test_runs import source


def metrics(df):
    """(files, rows) that the scan of a frame read."""
    plan = df._jdf.queryExecution().executedPlan()
    assert plan.execute().count() >= 0
    while plan.children().size():
        plan = plan.children().apply(0)
    of = lambda name: plan.metrics().get(name).get().value()
    return of("numFiles"), of("numOutputRows")


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("indexed"))
    key = F.sha2(F.col("id").cast("string"), 256)
    rows = spark.range(20_000).select(F.concat(F.lit("record:"), key).alias("record_id"), F.lit("text").alias("task"), F.lit("s").alias("source_name"), F.concat(F.lit("d"), "id").alias("document_id"))
    canonical.write(rows, root, "records", rows_per_file=1000)
    return root, [r[0] for r in rows.where("id in (7, 77, 12345)").select("record_id").collect()]


def test_bloom_filters_skip_files_that_lack_an_id(spark, store):
    root, (one, *_) = store
    files, rows = metrics(canonical.lookup(spark, root, "records", [one]))
    assert files >= 20 and rows <= 2000  # the file that has it, and one more by chance
    assert canonical.lookup(spark, root, "records", [one]).count() == 1
    assert canonical.lookup(spark, root, "records", ["record:none"]).count() == 0


def test_an_indexed_look_up_reads_one_file(spark, store):
    root, ids = store
    canonical.build_index(spark, root, "records")
    found = canonical.lookup(spark, root, "records", ids[:1])
    assert found.count() == 1 and metrics(found) == (1, 1000)
    assert sorted(r.record_id for r in canonical.lookup(spark, root, "records", ids).collect()) == sorted(ids)
    assert canonical.lookup(spark, root, "records", ["record:none"]) is None and canonical.lookup(spark, root, "records", []) is None
    with pytest.raises(ValueError, match="rows_of_many"):
        index.files_of(spark, canonical.index_path(root, "records"), ["x"] * 20_000)
    needed = spark.createDataFrame([(i,) for i in [*ids, ids[0], "no"]], "record_id string")
    assert index.rows_of_many(canonical.read(spark, root, "records"), "record_id", needed).count() == 3


def test_tracing_one_row_on_the_command_line(spark, tmp_path, capsys):
    made = source(spark, tmp_path)
    root = f"{tmp_path}/store"
    for name, df in made.items():
        canonical.write(df, root, name)
    view = write_view(ViewPlan.of({"name": "v", "include": [{"task": "text"}]}), made["records"], made["assets"], f"{tmp_path}/views")
    row = read_view(spark, view).first()
    for _ in range(2):  # without an index, then with one
        assert cli.main(["trace", view, root, row.id]) == 0
        said = json.loads(capsys.readouterr().out)
        assert (said["record_id"], said["document_path"]) == (row.canonical_record_id, "m1")
        assert cli.main(["index", root]) == 0
    assert canonical.read(spark, root, "records").count() == 3


TEXTS = {"b/two.jsonl": "x\n\n  \ny\r\n", "a/one.jsonl": "é1\n\n日2\nlast without end", "c/none.jsonl": "", "d/blank.jsonl": "\n \n", "e/long.jsonl": "\n".join("z" * (k % 37) for k in range(60)), "other.txt": "no\n"}


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_lines_have_the_numbers_of_a_plain_loop(spark, tmp_path, block):
    for name, text in TEXTS.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(text.encode())
    want, idx = [], 0
    for file in sorted(tmp_path.glob("*/*.jsonl")):
        with open(file, newline="\n") as f:
            for number, line in enumerate(f, 1):
                if line.strip():
                    idx += 1
                    want.append((str(file), number, idx, line.removesuffix("\n").removesuffix("\r")))
    got = numbered_lines(spark, str(tmp_path), "*/*.jsonl", block)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert numbered_lines(spark, str(tmp_path), "*.none", block).count() == 0


def test_rows_have_the_numbers_of_a_plain_loop(spark, tmp_path):
    for k, n in enumerate((3, 0, 5)):
        spark.range(100 * k, 100 * k + n).coalesce(1).write.mode("append").option("parquet.block.size", "64").parquet(f"{tmp_path}/t/part={k}")
    got = numbered_rows(spark.read.schema("id long").parquet(f"{tmp_path}/t/part=*")).select("id", "row", "idx")
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1), (1, 2, 2), (2, 3, 3), *((200 + k, k + 1, k + 4) for k in range(5))]
