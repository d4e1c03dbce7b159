"""Operators on built views: validation, scoring of predictions, image references, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rewards
from ..functions.geometry import aspect_ratio
from ..functions.text import count_placeholders, relative_path_ok
from .tables import split_leaks, violations

NEEDED = ("id", "prompt", "label", "split", "document_id")
REWARDS = {"normalized_levenshtein_v1": rewards.similarity, "truth_levenshtein_v1": rewards.truth_reward}


def placeholders(prompt: Column) -> Column:
    """Image placeholders in all turns of a chat."""
    return F.aggregate(prompt, F.lit(0), lambda n, turn: n + count_placeholders(F.coalesce(turn["content"], F.lit(""))))


def image_paths(df: DataFrame) -> Column:
    """All image references of a row, whichever column carries them."""
    # both are arrays of paths
    parts = [F.coalesce(c, F.array().cast("array<string>")) for n, c in (("images_path", F.col("images_path") if "images_path" in df.columns else None), ("images", F.col("images.image") if "images" in df.columns else None)) if c is not None]
    return F.concat(*parts) if parts else F.array().cast("array<string>")


CARRIERS = ("images", "images_bytes", "images_path")


def carrier_rules(view: DataFrame, needed: bool) -> dict[str, Column]:
    """One carrier of images at most, as many images as placeholders, and none that is empty or not a path below the root."""
    there = [c for c in CARRIERS if c in view.columns]
    count = {c: F.coalesce(F.size(c), F.lit(0)) for c in there}
    count = {c: F.greatest(n, F.lit(0)) for c, n in count.items()}
    images = sum(count.values(), F.lit(0))
    used = sum(((n > 0).cast("int") for n in count.values()), F.lit(0))
    rules = {"image_carriers": used <= 1, "image_count": (placeholders(F.col("prompt")) == images) | ((images == 0) & F.lit(not needed))}
    if needed:
        rules["image_data"] = images > 0
    valid = F.forall(image_paths(view), relative_path_ok)
    if "images_bytes" in there:
        valid = valid & F.forall(F.coalesce("images_bytes", F.array().cast("array<binary>")), lambda b: F.coalesce(F.octet_length(b) > 0, F.lit(False)))
    return rules | {"image_valid": valid}


def grpo_violations(view: DataFrame, files: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Rows (key, rule) of a view for group-relative training: a source, one carrier, images that exist; files: (path)."""
    if lacking := [c for c in ("prompt", "extra_info", "data_source") if c not in view.columns]:
        raise ValueError(f"the view lacks {', '.join(lacking)}")
    out = violations(view, key, {"data_source": F.coalesce(F.col("data_source"), F.lit("")) != ""} | carrier_rules(view, True))
    if files is not None:
        each = view.select(key, F.explode(image_paths(view)).alias("path"))
        out = out.unionByName(each.join(files.select("path").distinct(), "path", "left_anti").select(key, F.lit("image_missing").alias("rule")))
    return out


def stage_violations(view: DataFrame, folder: Column | None = None) -> DataFrame:
    """Rows (id, rule): the split column and the folder's differ, a reward stage lacks what it needs, images don't fit."""
    rules = carrier_rules(view, False)
    if folder is not None:
        rules["split_folder"] = F.col("split") == folder
    profile = F.col("reward_profile_id") if "reward_profile_id" in view.columns else F.lit("")
    rules["reward_profile"] = (F.col("stage") != "rlvr") | (F.coalesce(profile, F.lit("")) != "")
    for c in ("data_source", "extra_info"):
        rules[f"{c}_column"] = (F.col("stage") != "rlvr") | F.lit(c in view.columns)
    return violations(view, "id", rules)


def first_rows(view: DataFrame, most: int, file: Column, *order: str) -> DataFrame:
    """The first `most` rows of each file; 0 or less: all."""
    if most <= 0:
        return view
    row = F.row_number().over(Window.partitionBy(file).orderBy(*order))
    return view.withColumn("file_row", row).where(F.col("file_row") <= most).drop("file_row")


def view_violations(view: DataFrame, most_aspect: float = 200.0, sizes: DataFrame | None = None) -> DataFrame:
    """Rows (id, rule): missing prompt or label, unknown split, wrong number or kind of images, leaks between splits.

    sizes (path, width, height): images that it lacks are missing files; a ratio of most_aspect or more is broken.
    """
    if lacking := [c for c in NEEDED if c not in view.columns]:
        raise ValueError(f"the view lacks {', '.join(lacking)}")
    refs = image_paths(view)
    rules = {"prompt": F.size("prompt") > 0, "label": F.col("label") != "", "split": F.col("split").isin("train", "val", "test"), "image_count": placeholders(F.col("prompt")) == F.size(refs), "image_path": F.forall(refs, relative_path_ok)}
    if "reward_payload" in view.columns:
        rules["reward_payload"] = F.coalesce(F.col("reward_payload.label"), F.lit("")) != ""
    out = violations(view, "id", rules)
    leaks = view.join(split_leaks(view).select("document_id"), "document_id", "left_semi").select("id", F.lit("split_leak").alias("rule"))
    out = out.unionByName(leaks)
    if sizes is not None:
        each = view.select("id", F.explode(refs).alias("path")).join(sizes, "path", "left")
        bad = F.when(F.col("width").isNull(), "image_missing").when(~F.coalesce(aspect_ratio(F.col("width"), F.col("height")) < most_aspect, F.lit(False)), "aspect_ratio")
        out = out.unionByName(each.select("id", bad.alias("rule")).where(F.col("rule").isNotNull()))
    return out


def score_predictions(view: DataFrame, predictions: DataFrame) -> DataFrame:
    """predictions (id, prediction) scored by the view row's reward; an id that the view lacks fails the job."""
    rows = predictions.join(view.select("id", "label", "reward_profile_id"), "id", "left")
    score = F.raise_error(F.concat(F.lit("no view row or reward for prediction "), F.col("id"))).cast("double")
    for name, reward in REWARDS.items():
        score = F.when(F.col("reward_profile_id") == name, reward(F.col("prediction"), F.col("label"))).otherwise(score)
    return rows.select("id", "reward_profile_id", score.alias("score"))


def reward_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(F.count("*").alias("n"), F.min("score").alias("least"), F.avg("score").alias("mean"), F.max("score").alias("most"))


def trace(view: DataFrame, records: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """View rows with their canonical record and document; rows whose record is gone have nulls."""
    out = view.select("id", F.col("canonical_record_id").alias("record_id"), "split").join(records.select("record_id", "task", "source_name", "document_id"), "record_id", "left")
    return out.join(documents.select("document_id", "document_path"), "document_id", "left") if documents is not None else out
