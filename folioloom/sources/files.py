"""Listings of files: image sizes, and which file a sample's image is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.images import image_header
from .file_sink import write_files as write_files

EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp")


def image_listing(spark: SparkSession, path: str) -> DataFrame:
    """path (file name), width, height, format of the images below a folder; headers are read on the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.where(F.lower("path").rlike(r"\.(jpe?g|png|webp)$"))
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("path"), image_header(F.substring("content", 1, 262_144)).alias("s")).select("path", "s.*")


def relative_files(spark: SparkSession, root: str) -> DataFrame:
    """path (below the folder) and content of all files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    inside = F.regexp_extract("path", r"^(?:file:)?/*(.*)$", 1)
    top = root.split(":", 1)[-1].strip("/")
    return files.select(F.substr(inside, F.lit(len(top) + 2)).alias("path"), "content")


def markdown_outputs(spark: SparkSession, root: str, glob: str = "*/*/*.md") -> DataFrame:
    """sample_id (folder two above), path, text of generated documents."""
    raw = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{glob}")
    return raw.select(F.regexp_extract("path", r"([^/]+)/[^/]+/[^/]+$", 1).alias("sample_id"), "path", F.decode("content", "UTF-8").alias("text"))


def resolved_images(samples: DataFrame, files: DataFrame) -> DataFrame:
    """samples (sample_id) with the name of their image among files (name), or null.

    A file named as the sample with an extension comes first, in the order of EXTENSIONS. Else, for an id that ends in
    _N, the N-th by name of the files that start with the rest; else the first by name of those that start with
    the id. Prefixes are joined by equality: each file offers the prefixes that some sample asks for by length.
    """
    stem = F.regexp_replace("name", r"\.[^.]+$", "")
    files = files.select("name", stem.alias("stem"), F.lower(F.regexp_extract("name", r"(\.[^.]+)$", 1)).alias("ext")).where(F.col("ext").isin(*EXTENSIONS))
    order = F.array_position(F.array(*map(F.lit, EXTENSIONS)), F.col("ext"))
    exact = files.groupBy(F.col("stem").alias("sample_id")).agg(F.min_by("name", order).alias("exact"))
    base, number = F.regexp_extract("sample_id", r"^(.*)_(\d+)$", 1), F.regexp_extract("sample_id", r"^(.*)_(\d+)$", 2)
    asks = samples.select("sample_id", F.explode(F.array(F.struct(F.col("sample_id").alias("prefix"), F.lit(1).alias("nth"), F.lit(1).alias("turn")), F.struct(base.alias("prefix"), number.try_cast("int").alias("nth"), F.lit(0).alias("turn")))).alias("a")).select("sample_id", "a.*")
    asks = asks.where((F.col("prefix") != "") & (F.col("nth") >= 1))
    lengths = asks.select(F.length("prefix").alias("n")).distinct()
    offered = files.join(F.broadcast(lengths), F.length("stem") >= F.col("n")).select(F.substr("stem", F.lit(1), F.col("n")).alias("prefix"), "name")
    wanted = offered.join(asks.select("prefix").distinct(), "prefix", "left_semi").groupBy("prefix").agg(F.array_sort(F.collect_list("name")).alias("names"))
    found = asks.join(wanted, "prefix").where(F.size("names") >= F.col("nth"))
    # one file alone needs no number; several are told apart by it
    found = found.where((F.col("turn") == 1) | (F.size("names") > 1))
    best = found.groupBy("sample_id").agg(F.min_by(F.get("names", F.col("nth") - 1), "turn").alias("prefixed"))
    return samples.join(exact, "sample_id", "left").join(best, "sample_id", "left").withColumn("image", F.coalesce("exact", "prefixed")).drop("exact", "prefixed")


def missing_files(references: DataFrame, files: DataFrame) -> DataFrame:
    return references.join(files.select("path").distinct(), "path", "left_anti")


def under_root(root: str, path: Column) -> Column:
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def first_existing(df: DataFrame, candidates: str, files: DataFrame, name: str = "path") -> DataFrame:
    """df with the first of its candidate paths (array) that is among files (path), else the first of all."""
    each = df.select(F.col(candidates).alias("asked")).distinct().select("asked", F.posexplode("asked").alias("place", "path"))
    found = each.join(files.select("path").distinct(), "path", "left_semi").groupBy("asked").agg(F.min_by("path", "place").alias("found"))
    out = df.withColumn("asked", F.col(candidates)).join(found, "asked", "left")
    return out.withColumn(name, F.coalesce("found", F.get(candidates, F.lit(0)))).drop("asked", "found")
