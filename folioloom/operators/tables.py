"""Keyed operators: de-duplication, resuming, references, lineage and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = ("train", "val", "test")


def keep_first(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key; partial minima are taken before the shuffle."""
    return _pick(df, key, order, F.min_by)


def keep_last(df: DataFrame, key: str, *order: str) -> DataFrame:
    return _pick(df, key, order, F.max_by)


def _pick(df: DataFrame, key: str, order: Sequence[str], by) -> DataFrame:
    row = F.struct(*(F.col(c) for c in df.columns))
    return df.groupBy(F.col(key).alias("_key")).agg(by(row, F.struct(*map(F.col, order))).alias("_row")).select("_row.*")


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return df.join(done.select(key).distinct(), key, "left_anti")


def first_n(df: DataFrame, group: Sequence[str], n: int, *order: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def split_counts(df: DataFrame) -> DataFrame:
    """Rows of each split, the empty ones too."""
    every = df.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    return every.join(df.groupBy("split").agg(F.count("*").alias("n")), "split", "left").select("split", F.coalesce("n", F.lit(0)).alias("n"))


def split_leaks(df: DataFrame, document: str = "document_id") -> DataFrame:
    """Documents with rows in more than one split."""
    found = df.groupBy(document).agg(F.array_sort(F.collect_set("split")).alias("splits"))
    return found.where(F.size("splits") > 1)


def repeated_ids(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def failure_stats(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts by each of the columns on its own, in one pass; null and empty as unknown."""
    named = df.select(*(F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown")).alias(c) for c in by))
    sets = named.groupingSets([[c] for c in by], *by).agg(F.count("*").alias("n"))
    kind, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for c in by:
        kind, value = F.when(F.col(c).isNotNull(), c).otherwise(kind), F.when(F.col(c).isNotNull(), F.col(c)).otherwise(value)
    return sets.select(kind.alias("kind"), value.alias("value"), "n")


def broken_links(child: DataFrame, parent: DataFrame, on: Column) -> DataFrame:
    return child.join(parent, on, "left_anti")


def file_manifest(*files: DataFrame) -> DataFrame:
    """Distinct paths of frames with a path column, relative ones only."""
    out = files[0].select("path")
    for f in files[1:]:
        out = out.unionByName(f.select("path"))
    return out.where(F.col("path").isNotNull() & (F.col("path") != "")).distinct()


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """A row for each rule that a row of df breaks; a rule that comes out null counts as broken."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items())))
    return df.select(F.col(key), F.explode(broken).alias("rule"))


def without_null_columns(df: DataFrame, optional: Sequence[str]) -> DataFrame:
    """df without those of the optional columns that hold nothing but nulls; looked at in one pass."""
    there = [c for c in optional if c in df.columns]
    if not there:
        return df
    filled = df.agg(*(F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(there))).first()
    return df.drop(*(c for i, c in enumerate(there) if not filled[i]))


def flagged_summary(df: DataFrame, reasons: str = "reasons") -> DataFrame:
    """How many rows were looked at, how many are flagged, and how many for each reason."""
    each = df.select(F.explode(F.concat(F.array(F.lit("scanned")), F.when(F.size(reasons) > 0, F.array(F.lit("flagged"))).otherwise(F.array().cast("array<string>")), reasons)).alias("name"))
    return each.groupBy("name").agg(F.count("*").alias("n"))


def metric_means(df: DataFrame, rank: Sequence[str], value: str) -> DataFrame:
    """Sums within a rank, then the mean over ranks."""
    within = df.groupBy(*rank).agg(F.sum(value).alias("v"))
    return within.groupBy(*rank[1:]).agg(F.avg("v").alias("mean_of_sums"), F.count("*").alias("ranks"))
