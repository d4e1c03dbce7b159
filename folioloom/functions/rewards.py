"""Edit-distance rewards. The two normalisations differ: by the longer text, or by the ground truth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .edit_distance import edit_distance
from .text import py_strip


def normalized(text: Column, case_sensitive: bool = True, strip: bool = True) -> Column:
    text = F.coalesce(text, F.lit(""))
    text = py_strip(text) if strip else text
    return text if case_sensitive else F.lower(text)


def similarity(prediction: Column, label: Column, **how) -> Column:
    """max(0, 1 - distance / longer length)."""
    p, g = normalized(prediction, **how), normalized(label, **how)
    return F.greatest(F.lit(0.0), F.lit(1.0) - edit_distance(p, g) / F.greatest(F.length(p), F.length(g), F.lit(1)))


def truth_reward(prediction: Column, label: Column, **how) -> Column:
    """1 - min(distance / length of the truth, 1); an empty truth gives 1 to an empty prediction and else 0."""
    p, g = normalized(prediction, **how), normalized(label, **how)
    empty = F.when(p == "", 1.0).otherwise(0.0)
    return F.when(g == "", empty).otherwise(F.lit(1.0) - F.least(edit_distance(p, g) / F.length(g), F.lit(1.0)))


def register(spark) -> None:
    """The two rewards as functions for SQL: normalized_similarity and truth_reward, of a prediction and a label."""
    strip = lambda x: f"regexp_replace(coalesce({x}, ''), '(?U)^\\\\s+|\\\\s+$', '')"
    p, g = strip("prediction"), strip("label")
    head = "CREATE OR REPLACE TEMPORARY FUNCTION {}(prediction STRING, label STRING) RETURNS DOUBLE RETURN "
    spark.sql(head.format("normalized_similarity") + f"greatest(0D, 1D - levenshtein({p}, {g}) / greatest(length({p}), length({g}), 1))")
    spark.sql(head.format("truth_reward") + f"CASE WHEN {g} = '' THEN (CASE WHEN {p} = '' THEN 1D ELSE 0D END) ELSE 1D - least(levenshtein({p}, {g}) / length({g}), 1D) END")
