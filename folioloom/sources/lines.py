"""Lines of text files with their physical number and a running index, and rows of parquet files with theirs.

`numbered_lines` is a data source whose partitions are blocks of files: a line is of the block that it begins in. A first
pass counts the lines of each block, which gives what stands before it; the second adds that to the places of its lines.
Files are taken in the order of their paths. Lines end at a line feed; a carriage return before it is dropped. The running
index counts lines that aren't blank, over all files; blank lines have a number but no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK = 64 << 20
#: Bytes that are read at a time.
STEP = 1 << 20
ROWS = "file string, block int, line long, filled long, value string"
COUNTS = "file string, block int, lines long, filled long"


@dataclass
class Block(InputPartition):
    file: str
    block: int
    start: int
    stop: int


class LineReader(DataSourceReader):
    def __init__(self, options):
        path = options["path"]
        self.root = (path if "://" in path else f"file://{path}").rstrip("/")
        self.glob, self.size = options.get("glob", "*"), int(options.get("block", BLOCK))
        self.counts = options.get("counts", "false") == "true"

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.root)

    def partitions(self) -> list[Block]:
        from pyarrow import fs

        store, base = self._store()
        found = store.get_file_info(fs.FileSelector(base, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and fnmatchcase(f.path[len(base) :].lstrip("/"), self.glob))
        out = [Block(path, k, start, min(start + self.size, size)) for path, size in files for k, start in enumerate(range(0, max(size, 1), self.size))]
        return out or [Block("", 0, 0, 0)]

    def _lines(self, part: Block) -> Iterator[bytes]:
        """The lines that begin in the block."""
        if part.stop <= part.start:
            return
        store, _ = self._store()
        with store.open_input_file(part.file) as f:
            at = part.start - 1 if part.start else 0  # a line begins here if the byte before is a line feed
            f.seek(at)
            rest, skip = b"", bool(part.start)
            while True:
                data = f.read(STEP)
                pieces = (rest + data).split(b"\n")
                rest = pieces.pop()
                for piece in pieces:
                    if not skip and at < part.stop:
                        yield piece
                    skip, at = False, at + len(piece) + 1
                if at >= part.stop or not data:
                    break
            if rest and not skip and at < part.stop:
                yield rest

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        lines = filled = 0
        numbers, indexes, values, size = [], [], [], 0

        def batch() -> pa.RecordBatch:
            n = len(values)
            return pa.RecordBatch.from_arrays([pa.array([partition.file] * n, pa.string()), pa.array([partition.block] * n, pa.int32()), pa.array(numbers, pa.int64()), pa.array(indexes, pa.int64()), pa.array(values, pa.string())], names=["file", "block", "line", "filled", "value"])

        for raw in self._lines(partition):
            lines += 1
            text = raw.removesuffix(b"\r").decode("utf-8", "replace")
            if not text.strip():
                continue
            filled += 1
            if self.counts:
                continue
            numbers.append(lines)
            indexes.append(filled)
            values.append(text)
            if (size := size + len(raw)) > STEP:
                yield batch()
                numbers, indexes, values, size = [], [], [], 0
        if self.counts:
            yield pa.RecordBatch.from_pydict({"file": [partition.file], "block": pa.array([partition.block], pa.int32()), "lines": [lines], "filled": [filled]})
        elif values:
            yield batch()


class LineSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "numbered_lines"

    def schema(self) -> str:
        return COUNTS if self.options.get("counts") == "true" else ROWS

    def reader(self, schema) -> LineReader:
        return LineReader(self.options)


def numbered_lines(spark: SparkSession, folder: str, glob: str = "*", block: int = BLOCK) -> DataFrame:
    """file, line (from 1, of all lines of the file), idx (from 1, of the filled lines of all files) and value."""
    spark.dataSource.register(LineSource)
    source = spark.read.format("numbered_lines").option("glob", glob).option("block", block)
    counts = source.option("counts", "true").load(folder)
    within = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("file", "block", *(F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"{c}_before") for c in ("lines", "filled")))
    # One row for each file goes through one task.
    over = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = counts.groupBy("file").agg(F.sum("filled").alias("n")).select("file", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("files_before"))
    rows = source.option("counts", "false").load(folder).join(before.join(files, "file"), ["file", "block"])
    return rows.select("file", (F.col("line") + F.col("lines_before")).alias("line"), (F.col("filled") + F.col("filled_before") + F.col("files_before")).alias("idx"), "value")


def numbered_rows(table: DataFrame) -> DataFrame:
    """A frame read from parquet files, with file, row (from 1, within its file) and idx (from 1, over the files by path)."""
    own = table.select("*", F.col("_metadata.file_path").alias("file"), (F.col("_metadata.row_index") + 1).alias("row"))
    over = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    counts = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("file", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    return own.join(before, "file").withColumn("idx", F.col("row") + F.col("before")).drop("before")
