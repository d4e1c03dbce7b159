"""The canonical store: one partitioned parquet table for each entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators import index
from .operators.index import bloom_options
from .operators.tables import keep_first, not_done, repeated_ids, violations
from .plans.snapshots import Files
from .schemas import CANONICAL, KEYS

PARTITIONS = {"records": ["task", "source"]}


def path_of(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in order and of its types; missing ones are null."""
    fields = df.sparkSession.createDataFrame([], CANONICAL[table]).schema
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    return df.select(*cols)


def write(df: DataFrame, root: str, table: str, append: bool = False, rows_per_file: int = 10_000, counted: Mapping[str, Column] | None = None, unseen: bool = False) -> dict[str, int]:
    """Overwrites the partitions that df has rows of; appending leaves out ids that are there already.

    Returns aggregates of the rows written, which are taken while they are. unseen: df has no id that is there, and no
    id twice, so nothing is looked up.
    """
    spark, df = df.sparkSession, conform(df, table)
    if not unseen:
        df = keep_first(df, KEYS[table], "source_name", KEYS[table])
        if append and (there := read(spark, root, table)) is not None:
            df = not_done(df, there, KEYS[table])
    seen = Observation()
    if counted:
        df = df.observe(seen, *(v.alias(k) for k, v in counted.items()))
    df, by = df.withColumn("source", F.col("source_name")), PARTITIONS.get(table, ["source"])
    # Rows of a file are in the order of their ids, with a bloom filter of them, so that look-ups of ids skip files.
    df = df.sortWithinPartitions(*by, KEYS[table])
    out = df.write.option("maxRecordsPerFile", rows_per_file).options(**bloom_options(KEYS[table], rows_per_file)).partitionBy(*by)
    out.option("partitionOverwriteMode", "dynamic").mode("append" if append else "overwrite").parquet(path_of(root, table))
    return seen.get if counted else {}


def read(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The table with its partition column source, or None if it isn't there."""
    try:
        return spark.read.schema(CANONICAL[table] + ", source string").parquet(path_of(root, table))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def index_path(root: str, table: str) -> str:
    return path_of(root, f"_index_{table}")


def build_index(spark: SparkSession, root: str, table: str) -> None:
    """The index of a table's ids, to be built again after the table has changed."""
    index.build(spark.read.schema(CANONICAL[table] + ", source string").parquet(path_of(root, table)), KEYS[table], index_path(root, table))


def lookup(spark: SparkSession, root: str, table: str, ids: Sequence[str]) -> DataFrame | None:
    """Rows of a table with the ids; by its index where there is one, else by what the files' row groups tell."""
    key = KEYS[table]
    if Files(spark, root).exists(index_path(root, table)):
        return index.rows_of(spark, index_path(root, table), key, ids, CANONICAL[table])
    there = read(spark, root, table)
    return there if there is None else there.where(F.col(key).isin(list(ids)))


def asset_manifest(assets: DataFrame, needed: DataFrame) -> DataFrame:
    """Assets that are needed (column image_asset_id); of rows with one id the last path counts."""
    ids = needed.select(F.col("image_asset_id").alias("asset_id")).distinct()
    last = F.max_by(F.struct("path", "width", "height", "format"), F.struct("path", "source_name"))
    return assets.join(ids, "asset_id", "left_semi").groupBy("asset_id").agg(last.alias("last")).select("asset_id", "last.*")


def constraints(table: str) -> dict[str, Column]:
    filled = lambda *names: {f"{n}_empty": F.coalesce(F.col(n), F.lit("")) != "" for n in names}
    box = F.col("bbox") if table == "regions" else None
    return {
        "documents": lambda: filled("document_id", "source_name") | {"num_pages": F.col("num_pages") > 0},
        "pages": lambda: filled("page_id", "document_id", "page_image_asset_id") | {"page_index": F.col("page_index") >= 0, "size": (F.col("width") > 0) & (F.col("height") > 0)},
        "regions": lambda: filled("region_id", "page_id", "document_id") | {"bbox": (F.size(box) == 4) & (F.get(box, F.lit(0)) < F.get(box, F.lit(2))) & (F.get(box, F.lit(1)) < F.get(box, F.lit(3)))},
        "records": lambda: filled("record_id", "task", "source_name", "document_id", "page_id", "image_asset_id") | {"target": F.col("target").isNotNull()},
        "assets": lambda: filled("asset_id", "path") | {"size": (F.col("width") > 0) & (F.col("height") > 0)},
    }[table]()


def validate(df: DataFrame, table: str) -> DataFrame:
    """Rows (key, rule) of all broken constraints and of repeated ids."""
    key = KEYS[table]
    again = repeated_ids(df, key).select(key, F.lit("repeated_id").alias("rule"))
    return violations(df, key, constraints(table)).unionByName(again)
