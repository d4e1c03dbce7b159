"""Exports and streams that die halfway and run again."""

import json

import pytest
from pyspark.sql import functions as F

from folioloom import canonical
from folioloom.plans import export
from folioloom.sources.adapters import annotated_pages
from folioloom.streaming import incremental
from tests.test_runs import PAGES

TABLES = ("documents", "pages", "regions", "records", "assets")


def leaflets(spark, folder, names, source="leaflets"):
    for name in names:
        (folder / f"{name}_model.json").write_text(json.dumps(PAGES))
    sizes = spark.createDataFrame([(f"{n}.jpg", 40, 20) for n in names], "path string, width int, height int")
    return annotated_pages(spark, f"{folder}/*_model.json", source, sizes)


def rows_of(spark, root):
    return {t: canonical.read(spark, root, t).count() for t in TABLES}


@pytest.mark.parametrize("dies_at", ["pages", "records", "documents", "commit"])
def test_an_export_that_dies_is_resumed_without_loss(spark, tmp_path, monkeypatch, dies_at):
    root, folder = f"{tmp_path}/store", tmp_path / "in"
    folder.mkdir()
    tables = leaflets(spark, folder, ["m1", "m2"])
    whole = {t: df.count() for t, df in tables.items()}
    real = canonical.write

    def dying(df, where, table, **how):
        if table == dies_at:
            raise KeyboardInterrupt
        return real(df, where, table, **how)

    with monkeypatch.context() as m:
        m.setattr(export, "write", dying)
        if dies_at == "commit":
            m.setattr(export, "_commit", lambda *a: dying(None, None, "commit"))
        with pytest.raises(KeyboardInterrupt):
            export.export(spark, tables, root, "annotated_pages", "leaflets", skip_completed=True)
    assert export.completed(spark, root) is None
    got = export.export(spark, tables, root, "annotated_pages", "leaflets", skip_completed=True)
    assert rows_of(spark, root) == whole and got["skipped"] == 0
    assert got["records"] == (0 if dies_at in ("documents", "commit") else whole["records"])
    again = export.export(spark, tables, root, "annotated_pages", "leaflets", skip_completed=True)
    assert (again["skipped"], again["documents"], again["records"]) == (2, 0, 0) and rows_of(spark, root) == whole


def test_the_report_is_what_was_written(spark, tmp_path):
    root = f"{tmp_path}/store"
    tables = leaflets(spark, tmp_path, ["m1"])
    twice = tables | {t: tables[t].unionByName(tables[t]) for t in ("pages", "records", "documents")}
    got = export.export(spark, twice, root, "annotated_pages", "leaflets")
    assert {t: got[t] for t in TABLES} == rows_of(spark, root) and got["records/layout"] == 1 and got["scanned"] == 1


def test_overwriting_takes_commits_back_first(spark, tmp_path, monkeypatch):
    root, name = f"{tmp_path}/store", "leaf lets/1"
    tables = leaflets(spark, tmp_path, ["m1"], name)
    export.export(spark, tables, root, "annotated_pages", name)
    assert export.completed(spark, root).count() == 1
    with monkeypatch.context() as m:
        m.setattr(export, "write", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            export.export(spark, tables, root, "annotated_pages", name)
    assert not [r for r in (export.completed(spark, root) or spark.createDataFrame([], "x int")).collect()]


SCHEMA = "document_id string, source_name string, path string"


def stream(spark, top, **how):
    to_rows = lambda df: df.select("document_id", "source_name", F.col("path").alias("document_path"))
    return incremental.ingest(spark, f"{top}/in", SCHEMA, f"{top}/store", "documents", f"{top}/cp", to_rows, **how)


def arrive(spark, top, *ids):
    spark.createDataFrame([(i, "s", f"p{k}") for k, i in enumerate(ids)], SCHEMA).coalesce(1).write.mode("append").parquet(f"{top}/in")


def stored(spark, top):
    return sorted(r.document_id for r in canonical.read(spark, f"{top}/store", "documents").collect())


def test_ids_of_earlier_runs_are_known_without_the_store(spark, tmp_path):
    canonical.write(spark.createDataFrame([("old", "s", "x")], SCHEMA), f"{tmp_path}/store", "documents")
    arrive(spark, tmp_path, "a", "a", "old", None)
    stream(spark, tmp_path)
    assert stored(spark, tmp_path) == ["a", "old"]
    (tmp_path / "store").rename(tmp_path / "moved")  # the next run has nothing to look ids up in
    arrive(spark, tmp_path, "a", "b")
    arrive(spark, tmp_path, "b", "old", "c")
    assert stream(spark, tmp_path, files_per_batch=1) >= 2
    assert stored(spark, tmp_path) == ["b", "c"]
    stream(spark, tmp_path)
    assert stored(spark, tmp_path) == ["b", "c"]


def test_a_batch_that_dies_after_its_write_is_not_written_twice(spark, tmp_path, monkeypatch):
    arrive(spark, tmp_path, "a")
    stream(spark, tmp_path)
    arrive(spark, tmp_path, "b", "c")
    real = canonical.write

    def dying(*args, **how):
        real(*args, **how)
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(incremental, "write", dying)
        with pytest.raises(Exception, match="lost the driver"):
            stream(spark, tmp_path)
    assert stored(spark, tmp_path) == ["a", "b", "c"]
    arrive(spark, tmp_path, "d")
    stream(spark, tmp_path)
    assert stored(spark, tmp_path) == ["a", "b", "c", "d"]
