"""Which file holds an id: an index of the ids of a table's files, and look-ups that read only what they need.

The index is a table (id, file), dealt into ranges of ids and sorted within them, in small row groups with bloom filters.
A look-up of some ids reads the row groups of the index that can have them, then those files alone, and in them the row
groups whose statistics or bloom filter don't exclude the ids. Nothing grows with the table but the index itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids that are looked up at once; more are a join (see rows_of_many).
AT_ONCE = 10_000
#: Bytes of a row group of an index.
ROW_GROUP = 1 << 20


def bloom_options(key: str, rows: int) -> dict[str, str]:
    """Settings of a parquet writer that add a bloom filter of the key to each row group of up to so many rows."""
    return {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": str(rows)}


def build(table: DataFrame, key: str, path: str, files: int = 8) -> None:
    """Writes the index of a frame that was read from files. Of an id that several files hold, the last by name counts."""
    rows = table.select(F.col(key).alias("id"), F.col("_metadata.file_path").alias("file")).where("id IS NOT NULL")
    rows = rows.groupBy("id").agg(F.max("file").alias("file")).repartitionByRange(files, "id").sortWithinPartitions("id")
    rows.write.mode("overwrite").options(**bloom_options("id", 50_000)).option("parquet.block.size", str(ROW_GROUP)).parquet(path)


def files_of(spark: SparkSession, path: str, ids: Sequence[str]) -> list[str]:
    """The files that hold the ids."""
    if len(ids) > AT_ONCE:
        raise ValueError(f"more than {AT_ONCE} ids: use rows_of_many")
    found = spark.read.parquet(path).where(_is_one_of("id", ids)).select("file").distinct()
    return sorted(r.file for r in found.collect())


def rows_of(spark: SparkSession, path: str, key: str, ids: Sequence[str], schema: str | None = None) -> DataFrame | None:
    """The rows with the ids, read from their files alone; None if the index has none of them."""
    if not (files := files_of(spark, path, ids)):
        return None
    read = spark.read.schema(schema) if schema else spark.read
    return read.parquet(*files).where(_is_one_of(key, ids))


def _is_one_of(key: str, ids: Sequence[str]):
    """A condition that parquet readers test against row groups: equalities, which bloom filters know, and the range."""
    if not ids:
        return F.lit(False)
    return F.col(key).isin(list(ids)) & F.col(key).between(min(ids), max(ids))


def rows_of_many(table: DataFrame, key: str, needed: DataFrame) -> DataFrame:
    """The table's rows whose key is in `needed` (a column of that name), which may be many.

    Spark makes a bloom filter of the smaller side's keys and applies it to the scan of the larger, if their sizes make
    that worth while; here only the key column is shuffled of `needed`, each key once.
    """
    return table.join(needed.select(key).distinct(), key, "left_semi")
