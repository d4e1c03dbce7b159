"""A sink that writes a file for each row: df.write.format("files").mode("append").save(folder).

Rows have a path below the folder and content. A file is written beside its place and moved there when it is whole, so
nobody sees half of one. Of the attempts of a task Spark lets one commit, and what the others wrote are the same files.
A file that is there already is replaced, or stays with option("existing", "keep"), which is for paths that tell their
content, as those of content_path do. Rows without content are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType


def content_path(content: Column, before: Column, extension: str) -> Column:
    """A path that no other content has."""
    return F.concat(before, F.sha2(content, 256), F.lit(extension))


@dataclass
class Wrote(WriterCommitMessage):
    files: int


class FileWriter(DataSourceWriter):
    def __init__(self, root: str, keep: bool):
        self.keep = keep
        self.root = root if "://" in root else f"file://{root}"

    def write(self, iterator: Iterator[Row]) -> Wrote:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.root)
        base, made, n = base.rstrip("/"), set(), 0
        for row in iterator:
            where = f"{base}/{row['path']}"
            there = store.get_file_info(where).type != fs.FileType.NotFound
            if row["content"] is None or there and self.keep:
                continue
            folder = where.rsplit("/", 1)[0]
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            beside = f"{where}.{uuid.uuid4().hex}.part"
            with store.open_output_stream(beside) as out:
                out.write(bytes(row["content"]))
            if there:
                store.delete_file(where)
            store.move(beside, where)
            n += 1
        return Wrote(n)

    def commit(self, messages: list[Wrote | None]) -> None:
        """Nothing is left to do: each file is in its place once it is whole."""

    def abort(self, messages: list[Wrote | None]) -> None:
        """Whole files stay, as the next attempt needs them with the same content."""


class FileSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "files"

    def writer(self, schema: StructType, overwrite: bool) -> FileWriter:
        if overwrite:
            raise ValueError("mode overwrite would empty the folder; use append")
        if lacking := {"path", "content"} - set(schema.names):
            raise ValueError(f"rows lack {', '.join(sorted(lacking))}")
        return FileWriter(self.options["path"], self.options.get("existing") == "keep")


def write_files(df: DataFrame, root: str, existing: str = "replace") -> None:
    """Writes a file for each different path of df (path below root, content); existing: replace or keep those there.

    root: a folder or URI that the executors' Arrow can write to; a folder has to be shared by them."""
    df.sparkSession.dataSource.register(FileSink)
    rows = df.where(F.col("content").isNotNull()).select("path", "content").dropDuplicates(["path"])
    rows.write.format("files").option("existing", existing).mode("append").save(root)
