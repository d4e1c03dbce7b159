"""Where things come from: checkpoints and their parents, records and their files, progress of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import written


def ancestors(checkpoints: DataFrame, start: str, key: str = "checkpoint_id", parent: str = "parent_id") -> DataFrame:
    """The chain from a checkpoint to its root: key and depth, 0 for itself; of several ways up, all.

    Links are doubled: after k rounds each checkpoint has the one 2^k above it, and twice as many of the chain are
    known, so a chain of n takes log n joins. A chain that comes back to itself is an error.
    """
    links = _links(checkpoints, key, parent)
    if _branching(links):
        return _level_by_level(links, start)
    most, jumps, found, reach = links.count(), links, _start(checkpoints, start), 1
    while True:
        more = found.join(jumps, "id").select(F.col("up").alias("id"), (F.col("depth") + reach).alias("depth"))
        found = written(found.unionByName(more), "ancestors")
        if not found.where(F.col("depth") >= reach).limit(1).count():
            return found
        if reach > most:
            raise ValueError(f"the checkpoints above {start} form a cycle")
        reach *= 2
        jumps = _doubled(jumps)


def descendants(checkpoints: DataFrame, start: str, key: str = "checkpoint_id", parent: str = "parent_id") -> DataFrame:
    """All that come from a checkpoint: key and depth, 0 for itself; of several ways down, all.

    Each checkpoint looks above itself by doubled links: whether the start is among the 2^k above it is known from
    whether it is among the 2^(k-1) above it or above the one that far up. A start that comes from itself is an error.
    """
    links = _links(checkpoints, key, parent)
    if _branching(links):
        return _level_by_level(links.select(F.col("up").alias("id"), F.col("id").alias("up")), start)
    most, reach = links.count(), 1
    state = written(links.select("id", "up", F.when(F.col("up") == start, 1).alias("depth")), "descendants")
    while state.where("up IS NOT NULL AND depth IS NULL").limit(1).count() and reach <= most:
        above = state.select(F.col("id").alias("up"), F.col("up").alias("top"), F.col("depth").alias("higher"))
        deeper = F.coalesce("depth", F.col("higher") + reach)
        state = written(state.join(above, "up", "left").select("id", F.col("top").alias("up"), deeper.cast("int").alias("depth")), "descendants")
        reach *= 2
    if state.where((F.col("id") == start) & F.col("depth").isNotNull()).limit(1).count():
        raise ValueError(f"{start} comes from itself")
    return _start(checkpoints, start).unionByName(state.where("depth IS NOT NULL").select("id", "depth"))


def _links(checkpoints: DataFrame, key: str, parent: str) -> DataFrame:
    """id and up of checkpoints that have a parent, each pair once."""
    links = checkpoints.select(F.col(key).cast("string").alias("id"), F.col(parent).cast("string").alias("up"))
    return written(links.where("id IS NOT NULL AND up IS NOT NULL").distinct(), "links")


def _start(checkpoints: DataFrame, start: str) -> DataFrame:
    return checkpoints.sparkSession.createDataFrame([(start, 0)], "id string, depth int")


def _branching(links: DataFrame) -> bool:
    """Whether some checkpoint has several parents."""
    return bool(links.groupBy("id").count().where("count > 1").limit(1).count())


def _doubled(jumps: DataFrame) -> DataFrame:
    return written(jumps.join(jumps.select(F.col("id").alias("up"), F.col("up").alias("top")), "up").select("id", F.col("top").alias("up")), "jumps")


def _level_by_level(links: DataFrame, start: str) -> DataFrame:
    """The walk where a checkpoint has several links: each round follows those of the last level; depth by each way."""
    most, depth = links.count(), 0
    level = found = _start(links, start)
    while level.limit(1).count():
        if (depth := depth + 1) > most + 1:
            raise ValueError(f"the checkpoints from {start} on form a cycle")
        level = written(level.join(links, "id").select(F.col("up").alias("id"), F.lit(depth).alias("depth")).distinct(), "level")
        found = found.unionByName(level)
    return found


def checkpoint_record(configs: DataFrame, config: str = "config") -> DataFrame:
    """Checkpoints with the hash of their configuration, that of its JSON text."""
    return configs.withColumn("config_hash", F.sha2(F.col(config).cast("string"), 256))


def record_files(records: DataFrame, key: str = "record_id") -> DataFrame:
    """key and the file that holds it, the last by name, of a frame read from files."""
    return records.select(key, F.col("_metadata.file_path").alias("file")).groupBy(key).agg(F.max("file").alias("file"))


def progress(done: Column, total: Column, seconds: Column) -> Column:
    """rate (a second), pct and eta (seconds) of a run; null where they can't be told."""
    rate = F.when(seconds > 0, done / seconds)
    return F.struct(rate.alias("rate"), F.when(total > 0, done * 100.0 / total).alias("pct"), F.when((rate > 0) & (total > 0), (total - done) / rate).alias("eta"))
