"""Include, exclude, sample, split and label filters of a view, as lazy DataFrame operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import aspect_ratio
from ..functions.ids import seeded_digest, unit_interval
from ..functions.text import has_media_token

#: Up to so many keys a sample is taken by top-k.
TOP = 10_000
LEVELS = {"document": "document_id", "page": "page_id", "record": "record_id"}


def where(df: DataFrame, rule: Mapping | None) -> Column:
    """All conditions of a rule: a value (null-safe), {"in": [...]}, or {"not_contains": value or values} of an array."""
    out = F.lit(True)
    for name, want in (rule or {}).items():
        col = F.col(name) if name in df.columns else F.lit(None)
        if isinstance(want, Mapping):
            if "in" in want:
                known = [v for v in want["in"] if v is not None]
                hit = F.coalesce(col.isin(known), F.lit(False))
                out = out & (hit | col.isNull() if None in want["in"] else hit)
            if "not_contains" in want:
                values = want["not_contains"]
                values = [values] if isinstance(values, str) else list(values)
                if name in df.columns:
                    out = out & ~F.coalesce(F.arrays_overlap(col, F.array(*map(F.lit, values))), F.lit(False))
        else:
            out = out & (col.isNull() if want is None else F.coalesce(col == F.lit(want), F.lit(False)))
    return out


def applies(df: DataFrame, rule: Mapping) -> Column:
    out = where(df, rule.get("where"))
    for key, names in (("task", ("task",)), ("tasks", ("task",)), ("sources", ("source_name", "source"))):
        if want := rule.get(key):  # an empty list asks for any
            for name in names:
                if name in df.columns:  # source, where it is there, is the partition that holds source_name
                    out = out & F.coalesce(F.col(name).isin([want] if isinstance(want, str) else list(want)), F.lit(False))
    return out


def include(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Rows of each rule, with its number; a row that two rules want comes twice. The table is read once."""
    if not rules:
        raise ValueError("a view includes nothing")
    wanted, some = [], F.lit(False)
    for i, r in enumerate(rules):
        fits = applies(df, r)
        wanted.append(F.when(fits, F.lit(i)))
        some = some | fits
    return df.where(some).withColumn("include_order", F.explode(F.array_compact(F.array(*wanted))))


def exclude(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    gone = F.lit(False)
    for r in rules:
        gone = gone | F.coalesce(applies(df, r), F.lit(False))
    return df.where(~gone)


def sample_keys(df: DataFrame, key: str, count: int, seed: int = 42) -> DataFrame:
    """The `count` distinct keys with the least seeded digests.

    Up to TOP keys, tasks keep that many each and are merged. Beyond, keys are counted by three hex digits of their
    digests at a time until the cut is known, so that no task gets more than those that share its digits.
    """
    if count < 0:
        raise ValueError("a sample's count can't be negative")
    keys = df.select(F.col(key).cast("string").alias("sample_key")).where(F.col("sample_key").isNotNull()).distinct()
    digest = seeded_digest(seed, F.col("sample_key"))
    if count <= TOP:
        return keys.orderBy(digest).limit(count)
    prefix, left = "", count
    while True:
        digits = F.substr(digest, F.lit(len(prefix) + 1), F.lit(3))
        near = keys.where(digest.startswith(prefix)) if prefix else keys
        for value, n in sorted(tuple(r) for r in near.groupBy(digits.alias("d")).count().collect()):
            if n > left:
                break
            left -= n
        else:
            return keys if not prefix else keys.where(F.substr(digest, F.lit(1), F.lit(len(prefix))) <= prefix)
        prefix += value
        if n <= TOP:
            break
    below = keys.where(F.substr(digest, F.lit(1), F.lit(len(prefix))) < prefix)
    return below.unionByName(keys.where(digest.startswith(prefix)).orderBy(digest).limit(left))


def sample(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Rows that a rule applies to stay if their key is drawn; others stay anyway. Draws don't depend on each other."""
    whole = df
    for i, r in enumerate(rules):
        if r.get("count") is None:
            continue
        key = LEVELS[r.get("level", "document")]
        drawn = sample_keys(whole.where(applies(whole, r)), key, int(r["count"]), int(r.get("seed", 42)))
        flag = f"_drawn{i}"
        df = df.join(drawn.withColumn(flag, F.lit(True)), F.col(key).cast("string") == F.col("sample_key"), "left").drop("sample_key")
        df = df.where(~applies(df, r) | F.col(flag).isNotNull()).drop(flag)
    return df


def sample_per_group(df: DataFrame, group: Sequence[str], key: str, count: int, seed: int = 42) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(seeded_digest(seed, F.col(key)))
    return df.withColumn("sample_rank", F.row_number().over(order)).where(F.col("sample_rank") <= count)


def split_of(key: Column, seed: int = 42, train: float = 0.98, val: float = 0.01) -> Column:
    """train, val or test by the key's place in the unit interval, so all rows of a key go together."""
    u = unit_interval(seed, key)
    return F.when(u < train, "train").when(u < train + val, "val").otherwise("test")


def split_by_table(df: DataFrame, key: str, splits: DataFrame, otherwise: Column | None = None) -> DataFrame:
    """df with split from a table of (key, split); keys that it lacks get `otherwise`, or fail the job without one."""
    known = splits.select(F.col(key).cast("string").alias("split_key"), F.col("split").alias("given_split")).dropDuplicates(["split_key"])
    lacking = F.raise_error(F.concat(F.lit("no split for "), F.col(key).cast("string"))).cast("string") if otherwise is None else otherwise
    out = df.join(known, F.col(key).cast("string") == F.col("split_key"), "left")
    return out.withColumn("split", F.coalesce("given_split", lacking)).drop("split_key", "given_split")


def label_problem(task: Column, label: Column, stage: str) -> Column:
    """empty_label, reserved_media_token_label (sft only) or null."""
    empty = F.coalesce(label, F.lit("")) == ""
    out = F.when(empty, "empty_label")
    return out.when(has_media_token(label), "reserved_media_token_label") if stage == "sft" else out


def image_problem(width: Column, height: Column, most: float | None) -> Column:
    """invalid_dimensions, aspect_ratio or null; a ratio just at the limit is kept."""
    if not most:
        return F.lit(None).cast("string")
    ratio = aspect_ratio(width, height)
    return F.when(ratio.isNull(), "invalid_dimensions").when(ratio > most, "aspect_ratio")
