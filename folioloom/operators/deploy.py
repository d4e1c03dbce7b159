"""What a view needs where it is used: its files and the images that its rows refer to."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .views import image_paths


def references(view: DataFrame) -> DataFrame:
    """path: a row for each image reference of each row."""
    return view.select(F.explode(image_paths(view)).alias("path")).where(F.coalesce("path", F.lit("")) != "")


def manifest(files: DataFrame, view: DataFrame) -> DataFrame:
    """Distinct paths of the view's files and of the images that it refers to."""
    return files.select("path").unionByName(references(view)).distinct()


def manifest_counts(files: DataFrame, view: DataFrame) -> DataFrame:
    """view_files, image_references (each time counted) and unique_files."""
    both = files.select("path", F.lit(1).alias("file")).unionByName(references(view).withColumn("file", F.lit(0)))
    once = both.groupBy("path").agg(F.sum("file").alias("files"), F.sum(1 - F.col("file")).alias("refs"))
    return once.agg(F.sum("files").alias("view_files"), F.sum("refs").alias("image_references"), F.count("*").alias("unique_files"))


def missing(view: DataFrame, existing: DataFrame, most: int | None = 10) -> DataFrame:
    """Images that the view refers to and that aren't among the existing paths, the first `most` by name; None: all."""
    out = references(view).distinct().join(existing.select("path").distinct(), "path", "left_anti")
    return out if most is None else out.orderBy("path").limit(most)


def write_lines(paths: DataFrame, target: str) -> None:
    """The paths in order, one a line; sorted by ranges, so files follow each other by name."""
    paths.select(F.col("path").alias("value")).orderBy("value").write.mode("overwrite").text(target)


def glob_pattern(glob: str) -> str:
    """A file name pattern (*, ?, [...]) as a regular expression for the whole name."""
    out, k = "", 0
    while k < len(glob):
        c, k = glob[k], k + 1
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif c == "[" and "]" in glob[k + 1 :]:
            end = glob.index("]", k + 1)
            body = glob[k:end].replace("\\", "\\\\")
            out += f"[^{body[1:]}]" if body.startswith("!") else f"[{body}]"
            k = end + 1
        else:
            out += c if c.isalnum() or c in "_-/ " else "\\" + c
    return f"(?s)^{out}$"


def _fits(pattern: str) -> Callable[[Column], Column]:
    return lambda part: part.rlike(pattern)


def glob_kept(path: Column, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> Column:
    """Whether a path is packed: an exclude pattern that fits it or any of its parts drops it, an include keeps it anyway."""

    def fits(globs: Sequence[str]) -> Column:
        hit = F.lit(False)
        for pattern in map(glob_pattern, globs):
            part = F.filter(F.split(path, "/"), _fits(pattern))
            hit = hit | path.rlike(pattern) | (F.size(part) > 0)
        return hit

    return fits(include) | ~fits(exclude)


def recent_logs(files: DataFrame, node: str | None = None, label: str | None = None, most: int = 20) -> DataFrame:
    """The last `most` files by name, of a node (-node. in the name) and a label (the name's start)."""
    out = files
    if node:
        out = out.where(F.col("name").contains(f"-{node}."))
    if label:
        out = out.where(F.col("name").startswith(label))
    return out.orderBy(F.desc("name")).limit(most)


def chosen_nodes(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """name, rank, and the other columns of the named nodes in the order asked for; an unknown one fails the job."""
    if len(set(names)) != len(names):
        raise ValueError("a node is named twice")
    asked = nodes.sparkSession.createDataFrame(list(enumerate(names)), "rank int, name string")
    found = asked.join(nodes.withColumn("there", F.lit(True)), "name", "left")
    lacking = F.raise_error(F.concat(F.lit("no node "), F.col("name"))).cast("int")
    return found.withColumn("rank", F.when(F.col("there").isNull(), lacking).otherwise(F.col("rank"))).drop("there")
