"""Incremental ingestion: new files only, ids that are stored already left out, safe to run again."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..canonical import read, write
from ..plans.snapshots import Files
from ..schemas import KEYS

#: The state lives on disk, and a batch adds its changes to the checkpoint instead of another copy of all. No disk is set
#: aside in advance, which would be some megabytes for each of many small partitions.
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true", "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8", "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session while a query starts, which copies them."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def ingest(spark: SparkSession, source: str, schema: str, root: str, table: str, checkpoint: str, to_rows: Callable[[DataFrame], DataFrame], files_per_batch: int = 1000) -> int:
    """Reads the parquet files of `source` that no earlier run has read, into a table of the store; returns the batches.

    to_rows makes the table's rows of a stream of the files' rows; it works row by row (select, filter, explode). Ids that
    were seen live in a state store of the checkpoint, on disk, dealt by id: each batch looks up its own ids only, and the
    table isn't read. Rows without an id are left out, as the table can't hold them. Of rows of one batch with one id, any
    one stays.

    The first run of a checkpoint takes the ids of the table into the state, and looks its own rows up there once. Ids that
    something else writes to the table later are not known; let it write with append, which looks them up.

    A batch that died while it was written is sent again after a restart; only such a batch is held against the table.
    """
    key, files = KEYS[table], Files(spark, checkpoint)
    seed, begun, fresh = f"{checkpoint}-ids", f"{checkpoint}-begun", f"{checkpoint}-first"
    if not files.exists(seed):  # the ids that are there when the checkpoint is new
        there = read(spark, root, table)
        ids = there.select(F.col(key).alias("seen")) if there is not None else spark.createDataFrame([], "seen string")
        files.put(fresh, "")
        ids.write.mode("overwrite").parquet(f"{seed}-staged")
        files.move(f"{seed}-staged", seed)
    first = files.exists(fresh)

    new = to_rows(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source))
    known = spark.readStream.schema(StructType([StructField("seen", StringType())])).parquet(seed)
    own = F.struct(*(F.col(f"`{c}`").alias(c) for c in new.columns))
    rows = known.select(F.col("seen"), F.lit(None).cast(new.select(own.alias("r")).schema["r"].dataType).alias("r"))
    rows = rows.unionByName(new.select(F.col(key).cast("string").alias("seen"), own.alias("r")))
    rows = rows.where(F.col("seen").isNotNull()).dropDuplicates(["seen"])

    def put(batch: DataFrame, number: int) -> None:
        again = files.exists(f"{begun}/{number}")
        files.put(f"{begun}/{number}", "")
        out = batch.where(F.col("r").isNotNull()).select("r.*")
        write(out, root, table, append=True, unseen=not (first or again))
        for name, _ in files.names(begun):  # a batch begins when those before it are done
            if name.isdigit() and int(name) < number:
                files.delete(f"{begun}/{name}")

    with _settings(spark, STATE):
        query = rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    files.delete(fresh)
    return len(query.recentProgress)


def windowed_counts(events: DataFrame, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Counts and sums by window and kind, for batch frames and streams; rows later than `late` are dropped on streams."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
