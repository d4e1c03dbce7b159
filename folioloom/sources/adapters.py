"""Four source adapters. Each maps raw rows to the canonical tables as a dict of lazy frames.

chat_messages: arrays of {messages, images}; nested_jsonl: one JSON object a line; table_parquet: images with cell
arrays; annotated_pages: per sample a JSON list of pages of blocks. Width and height come with the input or a
listing of images (path, width, height); where both are missing they are 1, as for any unreadable image.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..canonical import conform
from ..functions import text as T
from ..functions.geometry import scaled_if_normal
from ..functions.ids import stable_hash, stable_id
from ..schemas import CANONICAL, TARGET
from ..storage import written

# Region types by task; any other type is text.
REGION_TASKS = {"table": "table", "equation": "formula", "formula": "formula", "interline_equation": "formula", "image": "diagram", "chart": "diagram", "diagram": "diagram", "seal": "seal"}


def _sized(df: DataFrame, images: DataFrame | None) -> DataFrame:
    if images is not None:
        found = images.groupBy("path").agg(F.max(F.struct("width", "height")).alias("_size"))
        df = df.join(found.withColumnRenamed("path", "image_path"), "image_path", "left")
        size = lambda name: F.greatest(F.coalesce(F.col(f"_size.{name}"), F.col(name), F.lit(1)), F.lit(1))
        return df.withColumns({"width": size("width"), "height": size("height")}).drop("_size")
    return df.withColumns({n: F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)) for n in ("width", "height")})


class OnePage(dict):
    """The tables of documents of one page each, and the rows that they are all made from.

    `judge` works out tasks and targets, the dear part; `settled` does that once for all tables.
    """

    def __init__(self, rows: DataFrame, tasks: Sequence[str] | None, judge: Callable[[DataFrame], DataFrame]):
        self.rows, self.tasks, self.judge = rows, tasks, judge
        super().__init__(_tables_of(judge(rows), tasks))

    def of(self, documents: DataFrame) -> OnePage:
        """Of some documents (document_id); the others' rows go before they are judged."""
        keep = documents.select("document_id").distinct()
        rows = self.rows.withColumn("document_id", _document_id(self.rows)).join(keep, "document_id", "left_semi")
        return OnePage(rows.drop("document_id"), self.tasks, self.judge)

    def settled(self) -> tuple[OnePage, str]:
        """The same tables with their rows judged and written, and the path of these rows."""
        rows = self.judge(self.rows)
        rows = written(rows.select(*(c for c in rows.columns if c in _USED)), "one-page")
        return OnePage(rows, self.tasks, lambda df: df), rows.written_to


#: Columns of rows that tables are made from.
_USED = {"source_name", "doc_key", "record_key", "image_path", *(f.split()[0] for t in CANONICAL.values() for f in t.replace(TARGET, "target").split(", "))}


def _document_id(df: DataFrame) -> Column:
    return stable_id("doc", df["source_name"], df["doc_key"])


def _one_page_tables(df: DataFrame, tasks: Sequence[str] | None, judge: Callable[[DataFrame], DataFrame] = lambda df: df) -> OnePage:
    """From rows with source_name, doc_key, record_key, image_path, width, height, language, category, and, once judged, task and target."""
    return OnePage(df, tasks, judge)


def _tables_of(df: DataFrame, tasks: Sequence[str] | None) -> dict[str, DataFrame]:
    if tasks is not None:
        df = df.where(F.col("task").isin(list(tasks)))
    name = F.col("source_name")
    ids = {"document_id": _document_id(df), "page_id": stable_id("page", name, F.col("doc_key"), F.lit("0")), "region_id": stable_id("region", name, F.col("record_key")), "record_id": stable_id("record", name, F.col("task"), F.col("record_key")), "asset_id": stable_id("asset", name, F.col("doc_key"))}
    df = df.withColumns(ids).withColumn("image_asset_id", F.col("asset_id"))
    box = F.array(F.lit(0.0), F.lit(0.0), F.col("width").cast("double"), F.col("height").cast("double"))
    region = df.where(F.col("task") != "layout")
    made = {
        "documents": df.select("*", F.col("doc_key").alias("source_document_id"), F.col("image_path").alias("document_path"), F.lit("image").alias("document_type"), F.lit(1).alias("num_pages")),
        "pages": df.select("*", F.col("doc_key").alias("source_page_id"), F.lit(0).alias("page_index"), F.col("asset_id").alias("page_image_asset_id"), F.lit(0.0).alias("rotation")),
        "regions": region.select("*", F.col("record_key").alias("source_annotation_id"), box.alias("bbox"), F.col("task").alias("element_type"), F.lit(1).alias("reading_order")),
        "records": df,
        "assets": df.select("*", F.lit("page_image").alias("asset_type"), F.col("image_path").alias("path"), F.ltrim(T.extension(F.col("image_path")), F.lit(".")).alias("format")),
    }
    return {k: conform(v, k) for k, v in made.items()}


def _target(**fields: Column) -> Column:
    """A target of the given fields; the others are null."""
    kinds = StructType.fromDDL(TARGET.removeprefix("struct<").removesuffix(">"))
    return F.struct(*(fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds))


def chat_messages(spark: SparkSession, paths: str | list[str], name: str, images: DataFrame | None = None, tasks: Sequence[str] | None = None) -> dict[str, DataFrame]:
    raw = spark.read.schema("messages array<struct<role:string,content:string>>, images array<string>").json(paths, multiLine=True)
    content = lambda role: F.get(F.filter("messages", lambda m: m["role"] == role), F.lit(0))["content"]
    df = raw.where((F.size("messages") >= 2) & (F.size("images") >= 1)).select(content("user").alias("ask"), content("assistant").alias("answer"), F.col("images")[0].alias("image_path"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"))
    df = _sized(df, images).withColumn("task", T.detect_task(F.col("ask")))
    key = stable_hash(F.concat_ws("\n", "image_path", "ask", "answer"))
    answer, task = T.parse_answer(F.col("task"), F.col("answer")), F.col("task")
    boxes = T.parse_boxes(F.col("answer"), F.col("width"), F.col("height"))
    boxes = F.transform(boxes, lambda e: F.struct(F.lit(None).cast("string").alias("region_id"), e["bbox"].alias("bbox"), e["label"].alias("label"), e["rotation"].alias("rotation"), e["reading_order"].alias("reading_order")))
    layout = F.when(task == "layout", boxes)
    space = F.when(task == "layout", "canonical_page_pixel_xyxy")
    df = df.select("*", F.lit(name).alias("source_name"), key.alias("doc_key"), key.alias("record_key"), _target(coordinate_space=space, elements=layout, text=F.when(task == "text", answer), otsl=F.when(task == "table", answer), latex=F.when(task == "formula", answer)).alias("target"))
    return _one_page_tables(df, tasks)


def nested_jsonl(spark: SparkSession, paths: str | list[str], name: str, images: DataFrame | None = None, tasks: Sequence[str] | None = None) -> dict[str, DataFrame]:
    schema = "record_id string, subset_id string, category string, language string, document_types array<string>, annotation_source string, original_file_name string, image_path string, size_key string, label string, label_empty boolean, raw struct<file_name:string,label:string,type:string>, type string"
    df = spark.read.schema(schema).json(paths)
    df = df.withColumn("subset_id", F.coalesce("subset_id", F.nullif(F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+/[^/]+$", 1), F.lit(""))))
    df = df.where(~F.coalesce("label_empty", F.lit(False)) & T.filled(F.col("label")))
    side = lambda k: F.try_element_at(F.split("size_key", "_"), F.lit(k)).try_cast("int")
    df = _sized(df.withColumns({"width": side(1), "height": side(2)}), images)
    task = T.classify(F.col("label"), *(F.col(c) for c in ("category", "subset_id", "type", "raw.type", "annotation_source", "original_file_name")), F.array_join("document_types", " "))
    clean = T.clean_label(F.col("label"))
    latex = F.when(F.col("task") == "formula", T.strip_formula_wrappers(F.col("label")))
    target = _target(text=F.when(F.col("task") != "formula", clean), latex=latex, display=F.when(F.col("task") == "formula", True))
    key = F.concat_ws("/", "subset_id", "record_id")
    df = df.select("*", F.lit(name).alias("source_name"), key.alias("doc_key"), key.alias("record_key"))
    return _one_page_tables(df, tasks, lambda df: df.withColumn("task", task).withColumn("target", target))


def scan_documents(spark: SparkSession, paths: str | list[str], name: str) -> DataFrame:
    """document_id, source_document_id and image_path of nested JSON lines, before anything is exported."""
    df = spark.read.schema("record_id string, subset_id string, image_path string").json(paths)
    subset = F.coalesce("subset_id", F.nullif(F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+/[^/]+$", 1), F.lit("")))
    key = F.concat_ws("/", subset, "record_id")
    return df.select(stable_id("doc", F.lit(name), key).alias("document_id"), key.alias("source_document_id"), "image_path")


def table_parquet(spark: SparkSession, paths: str | list[str], name: str, images: DataFrame | None = None, tasks: Sequence[str] | None = None) -> dict[str, DataFrame]:
    df = spark.read.schema("filename string, image struct<bytes:binary,path:string>, html_with_text array<string>").parquet(*([paths] if isinstance(paths, str) else paths))
    joined = T.py_strip(F.array_join(F.coalesce("html_with_text", F.array().cast("array<string>")), ""))
    html = F.when(joined.rlike("(?is)<table"), joined).otherwise(F.concat(F.lit("<table>"), joined, F.lit("</table>")))
    path = F.coalesce("image.path", "filename")
    df = df.select(path.alias("image_path"), F.element_at(F.split("filename", "/"), -1).alias("doc_key"), html.alias("html"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), F.lit("table").alias("task"), F.lit(name).alias("source_name"))
    df = _sized(df, images).withColumn("record_key", F.col("doc_key")).withColumn("target", _target(html=F.col("html")))
    return _one_page_tables(df, tasks)


def _middle(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """sample, page_index, page_size and para_blocks of files <sample>_middle.json."""
    schema = "pdf_info array<struct<page_size:array<double>,para_blocks:array<struct<index:int,bbox:array<double>>>>>"
    raw = spark.read.text(paths, wholetext=True).select("value", F.regexp_extract("_metadata.file_path", r"([^/]+)_middle\.json$", 1).alias("sample"))
    pages = raw.select("sample", F.posexplode(F.from_json("value", schema)["pdf_info"]).alias("page_index", "p"))
    return pages.select("sample", "page_index", F.col("p.page_size").alias("page_size"), F.col("p.para_blocks").alias("para_blocks"))


def annotated_pages(spark: SparkSession, paths: str | list[str], name: str, images: DataFrame | None = None, middle: str | list[str] | None = None) -> dict[str, DataFrame]:
    """paths: files <sample>_model.json with a list of pages, each a list of blocks of type, index, bbox, angle, content.

    middle: files <sample>_middle.json, whose page sizes, and boxes of the blocks with one index, come first."""
    block = "struct<type:string,index:int,bbox:array<double>,angle:double,content:string>"
    raw = spark.read.text(paths, wholetext=True).select("value", F.regexp_extract("_metadata.file_path", r"([^/]+)_model\.json$", 1).alias("sample"))
    pages = raw.select("sample", F.posexplode(F.from_json("value", f"array<array<{block}>>")).alias("page_index", "blocks"))
    pages = pages.withColumn("image_path", F.concat("sample", F.lit(".jpg"))).withColumns({c: F.lit(None).cast("int") for c in ("width", "height")})
    pages = _sized(pages, images)
    if middle is not None:
        pages = pages.join(_middle(spark, middle), ["sample", "page_index"], "left")
        side = lambda k, c: F.when(F.size("page_size") >= 2, F.greatest(F.get("page_size", F.lit(k)).cast("int"), F.lit(1))).otherwise(F.col(c))
        pages = pages.withColumns({"width": side(0, "width"), "height": side(1, "height")})
    else:
        pages = pages.withColumn("para_blocks", F.lit(None).cast("array<struct<index:int,bbox:array<double>>>"))
    sample, page = F.col("sample"), F.col("page_index").cast("string")
    pages = pages.withColumns({"source_name": F.lit(name), "document_id": stable_id("doc", F.lit(name), sample), "page_id": stable_id("page", F.lit(name), sample, page), "page_asset": stable_id("asset", F.lit(name), sample, page)})
    blocks = pages.select("*", F.posexplode("blocks").alias("position", "b")).where(F.col("b.type").isNotNull())
    kind = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in REGION_TASKS.items() for x in kv)), F.lower("b.type")), F.lit("text"))
    key = stable_hash(F.concat_ws("|", sample, page, F.col("b.index").cast("string"), F.to_json("b.bbox")))
    given = F.try_element_at(F.filter("para_blocks", lambda x: (x["index"] == F.col("b.index")) & x["bbox"].isNotNull()), F.lit(-1))["bbox"]
    blocks = blocks.withColumns({"task": kind, "bbox": F.coalesce(given, scaled_if_normal(F.col("b.bbox"), F.col("width"), F.col("height"))), "region_id": stable_id("region", F.lit(name), key), "crop": stable_id("asset", F.lit(name), F.lit("crop"), key), "reading_order": F.col("position") + 1})
    content, task = F.coalesce("b.content", F.lit("")), F.col("task")
    region_target = _target(text=F.when(task == "text", content), html=F.when(task == "table", content), latex=F.when(task == "formula", content), raw=F.when(~task.isin("text", "table", "formula"), content))
    regions = blocks.select("*", F.col("b.index").cast("string").alias("source_annotation_id"), F.col("b.angle").alias("rotation"), F.col("b.type").alias("element_type"), F.col("b.type").alias("category"), F.col("crop").alias("crop_asset_id"))
    records = blocks.where(T.filled(content)).select("*", stable_id("record", F.lit(name), task, key).alias("record_id"), F.col("crop").alias("image_asset_id"), region_target.alias("target"), F.col("b.type").alias("category"))
    element = F.struct("position", "region_id", "bbox", F.col("b.type").alias("label"), F.coalesce(F.col("b.angle").cast("int"), F.lit(0)).alias("rotation"), "reading_order")
    layout = blocks.groupBy("source_name", "document_id", "page_id", "page_asset").agg(F.array_sort(F.collect_list(element)).alias("elements"))
    layout = layout.select("*", F.lit("layout").alias("task"), F.replace("page_id", F.lit("page:"), F.lit("record:layout:")).alias("record_id"), F.col("page_asset").alias("image_asset_id"), _target(coordinate_space=F.lit("canonical_page_pixel_xyxy"), elements=F.transform("elements", lambda e: e.dropFields("position"))).alias("target"))
    docs = pages.groupBy("source_name", "document_id", "sample").agg((F.max("page_index") + 1).alias("num_pages"))
    made = {
        "documents": docs.select("*", sample.alias("source_document_id"), sample.alias("document_path"), F.lit("pages").alias("document_type")),
        "pages": pages.select("*", page.alias("source_page_id"), F.col("page_asset").alias("page_image_asset_id"), F.lit(0.0).alias("rotation")),
        "regions": regions,
        "records": conform(records, "records").unionByName(conform(layout, "records")),
        "assets": conform(pages.select("*", F.col("page_asset").alias("asset_id"), F.lit("page_image").alias("asset_type"), F.col("image_path").alias("path"), F.lit("jpg").alias("format")), "assets").unionByName(conform(blocks.select("*", F.col("crop").alias("asset_id"), F.lit("region_crop").alias("asset_type"), F.concat(F.lit("assets/"), F.translate("crop", ":", "_"), F.lit(".jpg")).alias("path"), F.col("page_asset").alias("parent_asset_id"), F.lit("jpg").alias("format")), "assets")),
    }
    return {k: conform(v, k) for k, v in made.items()}


def embedded_images(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path and content of the images that table parquet files hold, as files to write."""
    df = spark.read.schema("filename string, image struct<bytes:binary,path:string>").parquet(*([paths] if isinstance(paths, str) else paths))
    return df.where(F.col("image.bytes").isNotNull()).select(F.coalesce("image.path", "filename").alias("path"), F.col("image.bytes").alias("content"))


ADAPTERS = {"chat_messages": chat_messages, "nested_jsonl": nested_jsonl, "table_parquet": table_parquet, "annotated_pages": annotated_pages}
