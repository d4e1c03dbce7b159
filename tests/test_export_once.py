"""An export judges each line once, whatever number of tables is made of it."""

from pyspark.sql import functions as F

from folioloom import canonical
from folioloom.plans import export as X
from folioloom.sources import adapters


def test_each_line_is_judged_once(spark, tmp_path, monkeypatch):
    judged = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def task(label):
        judged.add(1)
        return "formula" if label.startswith("$$") else "text"

    monkeypatch.setattr(adapters.T, "classify", lambda label, *hints: task(label))
    lines, root = f"{tmp_path}/set1/annotations", f"{tmp_path}/store"
    one = [(f"r{k}", "$$ x $$" if k % 4 == 0 else f"text {k}") for k in range(12)]
    spark.createDataFrame(one[:8], "record_id string, label string").write.json(f"{lines}/one")
    spark.createDataFrame(one[8:], "record_id string, label string").write.json(f"{lines}/two")
    for paths, scanned, new in (([f"{lines}/one"], 8, 8), ([f"{lines}/one", f"{lines}/two"], 12, 4)):
        before = judged.value
        got = X.export(spark, adapters.nested_jsonl(spark, paths, "t"), root, "nested_jsonl", "t", skip_completed=True)
        assert (got["scanned"], got["skipped"], got["records"]) == (scanned, scanned - new, new)
        assert judged.value - before == new
    found = {r.document_id: (r.task, r.text, r.latex) for r in canonical.read(spark, root, "records").select("document_id", "task", "target.text", "target.latex").collect()}
    assert len(found) == 12 and set(found.values()) == {("formula", None, "x")} | {("text", t, None) for _, t in one if t[0] == "t"}
