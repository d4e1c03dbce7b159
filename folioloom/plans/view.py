"""A view definition (mapping or YAML) compiled into one lazy plan: include, sample, exclude, filter, resize, split, project.

The asset manifest is joined by key, prompts and serializers are Column expressions, and the schema is declared;
nothing runs before the result is written (samples of very many keys count them first).
Records that can't be made (no format for their task, or an image that an embedded or resized one needs is missing)
fail the job, or are left out and told by `failures` where the plan says skip_failure.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..canonical import asset_manifest
from ..functions.geometry import fitted, layout_text
from ..functions.ids import stable_hash, stable_id
from ..functions.images import refitted
from ..functions.prompts import chosen, rendered
from ..functions.tables import html_to_cells
from ..functions.text import truncated
from ..operators import select
from ..schemas import STAGES
from ..sources.file_sink import content_path, write_files
from . import snapshots

SYSTEM_PROMPT = "You are a helpful assistant."
# Prompts by task; {image} stands for the image placeholder.
PROMPTS = {"layout": "\nLayout Detection:", "table": "{image}\nTable Recognition:", "formula": "{image}\nFormula Recognition:", "text": "{image}\nText Recognition:", "diagram": "{image}\nImage Analysis:", "seal": "{image}\nSeal Recognition:"}
# The default format of a task, and the task that each format is for.
FORMATS = {"layout": "layout_box_v1", "table": "enhanced_otsl_v1", "formula": "latex_plain_v1", "text": "plain_text_v1"}
FORMAT_TASKS = {"layout_box_v1": "layout", "enhanced_otsl_v1": "table", "table_text_v1": "table", "latex_plain_v1": "formula", "plain_text_v1": "text"}
SPLITS = ("train", "val", "test")
MODES = ("embedded", "source_reference", "nested_reference")
TABLE_KEYS = ("display", "elements", "enhanced_otsl", "html", "latex", "otsl", "raw", "text")


@dataclass(frozen=True)
class ViewPlan:
    name: str
    stage: str = "sft"
    include: tuple[Mapping, ...] = ()
    exclude: tuple[Mapping, ...] = ()
    sample: tuple[Mapping, ...] = ()
    formats: Mapping[str, str] = field(default_factory=dict)
    prompts: Mapping[str, str] = field(default_factory=dict)
    split: Mapping[str, Any] = field(default_factory=dict)
    max_aspect_ratio: float | None = None
    image_mode: str = "source_reference"
    rewards: Mapping[str, Any] = field(default_factory=dict)
    rows_per_shard: int = 0
    transforms: Mapping[str, Mapping] = field(default_factory=dict)
    system_prompt: str = SYSTEM_PROMPT
    skip_failure: bool = False
    prune: tuple[str, ...] = ()
    image_placeholder: str = "<image>"

    @classmethod
    def of(cls, config: Mapping[str, Any]) -> ViewPlan:
        if not config.get("name"):
            raise ValueError("a view needs a name")
        stage = config.get("stage") or "sft"
        if stage not in STAGES:
            raise ValueError(f"stage {stage!r} is none of {', '.join(STAGES)}")
        images, shards = config.get("image_policy") or {}, config.get("shard_policy") or config.get("sharding") or {}
        rows = int(shards.get("rows_per_shard") or shards.get("shard_size") or 0)
        if rows < 0:
            raise ValueError("rows_per_shard can't be negative")
        mode = (images.get("materialization") or {}).get("mode") or "source_reference"
        if mode not in MODES:
            raise ValueError(f"image mode {mode!r} isn't supported")
        return cls(config["name"], stage, tuple(config.get("include") or ()), tuple(config.get("exclude") or ()), tuple([sample] if isinstance(sample := config.get("sample") or (), Mapping) else sample), dict(config.get("target_serialization") or {}), dict(config.get("prompts") or {}), dict(config.get("split_policy") or {}), float((images.get("filter") or {}).get("max_aspect_ratio") or 0) or None, mode, dict(config.get("reward_profile") or {}), rows, {t: dict(x) for t, x in (config.get("image_transform") or {}).items() if x and x.get("resize_to")}, config.get("system_prompt") or SYSTEM_PROMPT, bool(config.get("skip_failure")), tuple(config.get("prune") or ()), config.get("image_placeholder") or "<image>")

    @classmethod
    def from_yaml(cls, spark: SparkSession, path: str) -> ViewPlan:
        return cls.of(read_yaml(spark, path))


def read_yaml(spark: SparkSession, path: str) -> dict[str, Any]:
    import yaml

    return yaml.safe_load(spark.read.text(path, wholetext=True).first()[0]) or {}


def _by_task(values: Mapping[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for task, value in values.items():
        out = F.when(F.col("task") == task, F.lit(value)).otherwise(out)
    return out


def serialized(formats: Mapping[str, str], width: Column, height: Column, fit: Column | None = None) -> Column:
    """The label of a record by the format of its task; null counts as empty."""
    t = lambda name: F.coalesce(F.col(f"target.{name}"), F.lit(""))
    cells = lambda: F.coalesce(F.nullif(t("enhanced_otsl"), F.lit("")), F.nullif(t("otsl"), F.lit("")), html_to_cells(t("html")))
    layout = lambda: F.coalesce(layout_text(F.col("target.elements"), width, height, fit), F.lit(""))
    made = {"layout_box_v1": layout, "enhanced_otsl_v1": cells, "table_text_v1": lambda: t("text"), "latex_plain_v1": lambda: t("latex"), "plain_text_v1": lambda: t("text")}
    out = F.lit(None).cast("string")
    for task, name in formats.items():
        if name not in made:
            raise KeyError(f"no serializer {name}")
        if FORMAT_TASKS[name] != task:
            raise ValueError(f"format {name} is for {FORMAT_TASKS[name]}, not for {task}")
        out = F.when(F.col("task") == task, made[name]()).otherwise(out)
    return out


def _tasks(plan: ViewPlan) -> set[str] | None:
    """Tasks that the view can hold, or None if an include takes any."""
    out: set[str] = set()
    for r in plan.include:
        want = r.get("task") or r.get("tasks")
        if not want:
            return None
        out |= {want} if isinstance(want, str) else set(want)
    return out


def selected(plan: ViewPlan, records: DataFrame, assets: DataFrame) -> DataFrame:
    """Records of the view with width, height, path, label and problem (null where the record is kept)."""
    df = select.sample(select.include(records, plan.include), plan.sample)
    df = select.exclude(df, plan.exclude)
    manifest = asset_manifest(assets, df).select(F.col("asset_id").alias("image_asset_id"), F.col("path").alias("asset_path"), F.col("width").alias("asset_width"), F.col("height").alias("asset_height"))
    df = df.join(manifest, "image_asset_id", "left")
    side = lambda name: F.coalesce(F.col(f"asset_{name}"), F.get_json_object("metadata", f"$.{name}").cast("int"))
    df = df.withColumns({"width": side("width"), "height": side("height"), "path": F.coalesce("asset_path", "image_asset_id")})
    df = df.withColumn("fit", _fit(plan))
    shown = lambda name: F.coalesce(F.col(f"fit.output_{name}"), F.col(name))
    formats = FORMATS | dict(plan.formats)
    if (tasks := _tasks(plan)) is not None:  # serializers of other tasks stay out of the plan, Python ones above all
        formats = {t: f for t, f in formats.items() if t in tasks}
    df = df.withColumn("label", serialized(formats, F.coalesce("width", F.lit(1)), F.coalesce("height", F.lit(1)), F.col("fit") if plan.transforms else None))
    problem = F.coalesce(select.label_problem(F.col("task"), F.col("label"), plan.stage), select.image_problem(shown("width"), shown("height"), plan.max_aspect_ratio))
    return df.withColumn("problem", problem).drop("asset_path", "asset_width", "asset_height")


def _fit(plan: ViewPlan) -> Column:
    out = F.lit(None)
    for task, how in plan.transforms.items():
        out = F.when(F.col("task") == task, fitted(F.col("width"), F.col("height"), int(how["resize_to"]), bool(how.get("pad_to_square")))).otherwise(out)
    return out if plan.transforms else F.lit(None).cast("struct<output_width:int,output_height:int>")


def _made(plan: ViewPlan, records: DataFrame, assets: DataFrame, images: DataFrame | None) -> DataFrame:
    """Records without a problem, with bytes (of their image, where the view needs them), view_asset and error."""
    df = selected(plan, records, assets)
    known = _by_task(FORMATS | dict(plan.formats))
    df = df.where(F.col("problem").isNull() | known.isNull())
    changed = F.col("fit").isNotNull()
    needs = F.lit(True) if plan.image_mode == "embedded" else changed
    if images is not None and (plan.transforms or plan.image_mode == "embedded"):
        df = df.join(images.select("path", F.col("content").alias("bytes")), "path", "left")
        if plan.transforms:
            square = F.lit(False)
            for task, how in plan.transforms.items():
                square = F.when(F.col("task") == task, F.lit(bool(how.get("pad_to_square")))).otherwise(square)
            df = df.withColumn("bytes", F.when(changed, refitted("bytes", F.col("fit.output_width"), square)).otherwise(F.col("bytes")))
    elif plan.transforms or plan.image_mode == "embedded":
        df = df.withColumn("bytes", F.lit(None).cast("binary"))
    what = F.when(changed, F.lit("can't resize the image of ")).otherwise(F.lit("can't read the image of "))
    error = F.when(known.isNull(), F.struct(F.lit("KeyError").alias("exception_type"), F.concat(F.lit("no format for task "), "task").alias("message")))
    if plan.transforms or plan.image_mode == "embedded":
        error = error.when(needs & F.col("bytes").isNull(), F.struct(F.lit("ValueError").alias("exception_type"), F.concat(what, "record_id").alias("message")))
    return df.withColumn("error", error)


def failures(plan: ViewPlan, records: DataFrame, assets: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """A row for each record that can't be made: where it is, what it holds, and why."""
    df = _made(plan, records, assets, images).where(F.col("error").isNotNull())
    t = lambda k: F.to_json(F.col(f"target.{k}")) if k == "elements" else F.col(f"target.{k}").cast("string")
    filled = lambda k: F.coalesce(t(k), F.lit("")) != ""
    keys = F.array_compact(F.array(*(F.when(filled(k), k) for k in TABLE_KEYS)))
    preview = F.concat_ws("; ", *(F.when(filled(k), F.concat(F.lit(f"{k}="), truncated(t(k), 160))) for k in TABLE_KEYS))
    return df.select(F.lit("materialize").alias("phase"), "record_id", "source_name", "task", "document_id", "page_id", "region_id", _by_task(FORMATS | dict(plan.formats)).alias("target_format"), keys.alias("target_keys"), truncated(preview, 512).alias("target_preview"), "error.exception_type", truncated(F.col("error.message"), 512).alias("message"))


def _unless(bad: Column, message: Column) -> Column:
    """A filter that keeps all rows and fails the job at a bad one, whatever columns are read.

    As it names the partition it isn't deterministic, and filters on the view aren't merged with it; they could make it
    judge rows that they leave out by what is only true of those they keep."""
    return F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.spark_partition_id() >= 0)


def view_rows(plan: ViewPlan, records: DataFrame, assets: DataFrame, images: DataFrame | None = None, splits: DataFrame | None = None) -> DataFrame:
    """The rows of a view. images: path and content of files, where bytes are needed; splits: given ones, by key.

    A split that is none of train, val and test fails the job."""
    return _rows(plan, _made(plan, records, assets, images), splits)


def _rows(plan: ViewPlan, df: DataFrame, splits: DataFrame | None, *more: Column) -> DataFrame:
    failed = F.col("error").isNotNull()
    df = df.where(~failed) if plan.skip_failure else df.where(_unless(failed, F.col("error.message")))
    level = select.LEVELS[plan.split.get("level", "document")]
    split = select.split_of(F.col(level), int(plan.split.get("seed", 42)), float(plan.split.get("train_ratio", 0.98)), float(plan.split.get("val_ratio", 0.01)))
    if splits is not None:
        df = select.split_by_table(df, level, splits, split)
        split = F.col("split")
        df = df.where(_unless(~F.coalesce(split.isin(*SPLITS), F.lit(False)), F.concat(F.lit("no such split: "), F.coalesce(split, F.lit("null")))))
    prompt = rendered(chosen(plan.prompts, PROMPTS), plan.image_placeholder)
    template = F.concat("task", F.lit("_default_v1"))
    content = stable_hash(F.concat("record_id", template))
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    asset_id = stable_id("view_asset", F.lit(plan.name), F.col("task"), content)
    path = F.when(F.col("fit").isNotNull(), _asset_path(plan)).otherwise(F.col("path")) if plan.transforms else F.col("path")
    image = {"embedded": F.array("bytes").alias("images_bytes"), "source_reference": F.array(path).alias("images_path"), "nested_reference": F.array(F.struct(path.alias("image"))).alias("images")}[plan.image_mode]
    cols = [
        stable_id("view", F.lit(plan.name), content).alias("id"), F.lit(plan.stage).alias("stage"), "task", path.alias("image_path"),
        F.array(turn("system", F.lit(plan.system_prompt)), turn("user", prompt)).alias("prompt"), "label", "source_name", "document_id", "page_id", "region_id",
        F.col("record_id").alias("canonical_record_id"), F.col("image_asset_id").alias("canonical_image_asset_id"), _by_task(FORMATS | dict(plan.formats)).alias("target_format"),
        template.alias("prompt_template_id"), split.alias("split"), asset_id.alias("view_image_asset_id"), image, F.col("task").alias("data_source"),
    ]
    if plan.stage == "sft":
        cols.append(F.array(turn("user", prompt), turn("assistant", F.col("label"))).alias("messages"))
    if plan.stage == "rlvr":
        profile = F.coalesce(_by_task(plan.rewards.get("by_task") or {}), F.lit(plan.rewards.get("default") or "normalized_levenshtein_v1"))
        cols += [profile.alias("reward_profile_id"), F.struct(F.col("label")).alias("reward_payload"), F.struct(F.lit("rule").alias("style"), F.col("label").alias("ground_truth")).alias("reward_model"), F.col("label").alias("answer_key"), F.struct(F.col("record_id").alias("sample_id"), split.alias("split")).alias("extra_info")]
    return df.select(*cols, *more).drop(*plan.prune)


def _asset_path(plan: ViewPlan) -> Column:
    before = F.concat(F.lit(f"assets/view_asset_{plan.name}_".replace(":", "_")), "task", F.lit("_"))
    return content_path(F.col("bytes"), before, ".png")


def view_assets(plan: ViewPlan, records: DataFrame, assets: DataFrame, images: DataFrame) -> DataFrame:
    """path (below the folder of views) and content of the images that the view resizes, each once."""
    df = _made(plan, records, assets, images).where(F.col("error").isNull() & F.col("fit").isNotNull())
    return df.select(_asset_path(plan).alias("path"), F.col("bytes").alias("content")).dropDuplicates(["path"])


def shard_counts(plan: ViewPlan, rows: DataFrame) -> DataFrame:
    """Files of each split: as many as its rows fill, one where they aren't cut."""
    return rows.groupBy("split").agg(F.count("*").alias("n")).select("split", "n", (F.ceil(F.col("n") / plan.rows_per_shard) if plan.rows_per_shard else F.lit(1)).cast("int").alias("shards"))


def filter_counts(plan: ViewPlan, records: DataFrame, assets: DataFrame) -> DataFrame:
    return selected(plan, records, assets).where(F.col("problem").isNotNull()).groupBy("problem").agg(F.count("*").alias("n"))


def write_view(plan: ViewPlan, records: DataFrame, assets: DataFrame, root: str, images: DataFrame | None = None, splits: DataFrame | None = None) -> str:
    """Replaces <root>/<view>/split=<split>/ as a whole, for splits that have rows; returns the view's path.

    A job that fails leaves the view as it was. Resized images, which are made once, become files below <root>, named by
    their content, before the view is replaced. `snapshots.current` tells the rows of each split.
    """
    spark, path = records.sparkSession, f"{root.rstrip('/')}/{plan.name}"

    def write(staged: str) -> dict[str, Any]:
        made, own = _made(plan, records, assets, images), f"{staged}/_made"
        resized = bool(plan.transforms) and images is not None and plan.image_mode != "embedded"
        if resized:
            _rows(plan, made, splits, F.when(F.col("fit").isNotNull(), F.col("bytes")).alias("asset_content")).write.parquet(own)
            rows = spark.read.parquet(own)
            write_files(rows.select(F.col("image_path").alias("path"), F.col("asset_content").alias("content")), root, "keep")
            rows = rows.drop("asset_content")
        else:
            rows = _rows(plan, made, splits)
        seen = Observation()
        out = rows.observe(seen, *(F.count_if(F.col("split") == s).alias(s) for s in SPLITS)).write.mode("append").partitionBy("split")
        (out.option("maxRecordsPerFile", plan.rows_per_shard) if plan.rows_per_shard else out).parquet(staged)
        if resized:
            snapshots.Files(spark, own).delete(own)
        return {"view": plan.name, "stage": plan.stage, "rows": {s: n for s, n in seen.get.items() if n}}

    snapshots.commit(spark, path, write)
    return path


def read_view(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a view; a replacement that died halfway is ended first."""
    snapshots.current(spark, path)
    return spark.read.parquet(path)
