"""Exporting a source: which documents go, into which tables, and a report of what was written.

An adapter gives the canonical tables as lazy frames; a document that is left out goes from all of them. When all tables of
a run are written, the run commits: a marker for each of its documents goes into the table `commits`, and only that makes
a document completed. A run that dies before leaves rows, but no marker, so the next one exports its documents again;
ids that are there already aren't written twice.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..canonical import path_of, read, write
from ..functions.geometry import crop_box
from ..functions.images import cropped
from ..schemas import TASKS
from ..sources.adapters import OnePage
from .snapshots import Files

Tables = dict[str, DataFrame]
COMMITS = "source_name string, source_document_id string, source string, run string"
#: Documents come last, so that a table of documents tells what the others have.
ORDER = ("assets", "pages", "regions", "records", "documents")


def of_documents(tables: Tables, documents: DataFrame) -> Tables:
    """The rows of all tables that belong to the documents (document_id); assets without one stay."""
    if isinstance(tables, OnePage):
        return tables.of(documents)
    keep = documents.select("document_id").distinct()
    out = {k: df.join(keep, "document_id", "left_semi") for k, df in tables.items() if k != "assets"}
    assets = tables["assets"]
    return out | {"assets": assets.where(F.col("document_id").isNull()).unionByName(assets.join(keep, "document_id", "left_semi"))}


def limited(tables: Tables, most: int | None) -> Tables:
    """The first `most` documents in the order of their source ids; None: all."""
    if most is None:
        return tables
    if most < 0:
        raise ValueError("a limit can't be negative")
    return of_documents(tables, tables["documents"].orderBy("source_document_id").limit(most))


def completed(spark: SparkSession, root: str) -> DataFrame | None:
    """source_name and source_document_id of the documents that some run has committed; None if none has ever."""
    try:
        return spark.read.schema(COMMITS).parquet(path_of(root, "commits")).select("source_name", "source_document_id").distinct()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def not_completed(spark: SparkSession, tables: Tables, root: str) -> Tables:
    """Without the documents that are committed for their source."""
    if (done := completed(spark, root)) is None:
        return tables
    return of_documents(tables, tables["documents"].join(done, ["source_name", "source_document_id"], "left_anti"))


def _commit(documents: DataFrame, root: str, source: str, run: str) -> None:
    """Markers of the documents of a run; a run's folder is put in place when they are all written."""
    rows = documents.select("source_name", "source_document_id").distinct()
    rows.write.mode("overwrite").parquet(f"{path_of(root, 'commits')}/{_source_folder(documents.sparkSession, source)}/run={run}")


def _source_folder(spark: SparkSession, source: str) -> str:
    return "source=" + spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(source)


def with_tasks(tables: Tables, tasks: Sequence[str] | None) -> Tables:
    if tasks is None:
        return tables
    return tables | {"records": tables["records"].where(F.col("task").isin(list(tasks)))}


def report(tables: Tables) -> DataFrame:
    """(name, n): rows of each table, and of the records by task, in one job."""
    out = None
    for name, df in tables.items():
        one = df.groupBy().agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    tasks = tables["records"].groupBy("task").agg(F.count("*").alias("n"))
    return out.unionByName(tasks.select(F.concat(F.lit("records/"), "task").alias("name"), "n"))


def region_crops(tables: Tables, images: DataFrame) -> DataFrame:
    """path (of the crop asset) and content (PNG) of the regions that have one; images: path and content of page images."""
    assets = tables["assets"].select("asset_id", "path")
    pages = tables["pages"].select("page_id", "width", "height", F.col("page_image_asset_id").alias("asset_id")).join(assets, "asset_id").join(images, "path")
    regions = tables["regions"].where(F.col("crop_asset_id").isNotNull()).select("page_id", "bbox", F.col("crop_asset_id").alias("crop"))
    crops = assets.select(F.col("asset_id").alias("crop"), F.col("path").alias("crop_path"))
    rows = regions.join(pages.drop("path", "asset_id"), "page_id").join(crops, "crop")
    return rows.select(F.col("crop_path").alias("path"), cropped("content", crop_box(F.col("bbox"), F.col("width"), F.col("height"))).alias("content"))


def write_json(spark: SparkSession, value: Any, path: str) -> None:
    """One file of JSON below `path`, indented, other scripts as they are."""
    spark.createDataFrame([(json.dumps(value, indent=2, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def export(spark: SparkSession, tables: Tables, root: str, adapter: str, source: str, tasks: Sequence[str] | None = None, append: bool = False, skip_completed: bool = False, most: int | None = None) -> dict[str, int]:
    """Writes the tables, commits their documents and writes a manifest of the source.

    Returns the report: rows written of each table, and of records by task, counted while they were written; documents
    scanned, and skipped by `skip_completed` or `most`. Overwriting takes the source's commits back first.
    """
    append = append or skip_completed
    some = append or most is not None  # else the documents written tell how many there are
    scanned = tables["documents"].count() if some else None
    if skip_completed:
        tables = not_completed(spark, tables, root)
    tables, rows = limited(tables, most), None
    if isinstance(tables, OnePage):  # else each table would judge all rows again
        tables, rows = tables.settled()
    tables = with_tasks(tables, tasks)
    if not append:
        where = f"{path_of(root, 'commits')}/{_source_folder(spark, source)}"
        Files(spark, where).delete(where)
    counts: dict[str, int] = {}
    for name in ORDER:
        by = {name: F.count(F.lit(1))}
        if name == "records":
            by |= {f"records/{t}": F.count_if(F.col("task") == t) for t in TASKS}
        counts |= {k: n for k, n in write(tables[name], root, name, append=append, counted=by).items() if n or k == name}
    _commit(tables["documents"], root, source, f"{time.time_ns()}-{uuid.uuid4().hex[:8]}")
    counts |= {"scanned": scanned, "skipped": scanned - tables["documents"].count()} if some else {"scanned": counts["documents"], "skipped": 0}
    if rows is not None:
        Files(spark, rows).delete(rows)
    write_json(spark, {"adapter": adapter, "source": source, "report": counts}, path_of(root, f"manifests/source={source}"))
    return counts


def write_asset_manifest(spark: SparkSession, root: str, path: str) -> None:
    """All assets of the store in one file, the last path of an id."""
    assets = read(spark, root, "assets")
    last = assets.groupBy("asset_id").agg(F.max_by(F.struct(*assets.columns[1:]), F.struct("path", "source_name")).alias("row")).select("asset_id", "row.*")
    last.repartition(1).write.mode("overwrite").parquet(path)
