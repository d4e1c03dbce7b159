"""Tables that are replaced as a whole: a write goes to a folder beside, and two renames put it in the old one's place.

<folder>/<name>/                 the table, with `_committed`: JSON of what its writer says of it
<folder>/_staged/<name>/<id>/    what a write makes; it has `_committed` when it is whole
<folder>/_replaced/<name>/<id>/  the table that the write <id> replaces

A build that fails or dies leaves the table as it was. One that dies between the two renames has a whole staged folder
and the replaced table under its id, from which the next `current` or `commit` puts it in place. Paths may be of any file
system that Spark's Hadoop client can rename folders in.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

STAGED, REPLACED, DONE = "_staged", "_replaced", "_committed"
#: Seconds after which a staged folder that was never whole is taken for left over.
ABANDONED = 7 * 86_400


class Files:
    """The few operations on files that a commit needs, by Hadoop's client in the driver."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, where: str):
        return self.jvm.org.apache.hadoop.fs.Path(where)

    def exists(self, where: str) -> bool:
        return self.fs.exists(self.path(where))

    def names(self, where: str) -> list[tuple[str, int]]:
        """(name, milliseconds of its last change) of what a folder holds; nothing if it isn't there."""
        return [(s.getPath().getName(), s.getModificationTime()) for s in self.fs.listStatus(self.path(where))] if self.exists(where) else []

    def read(self, where: str) -> str | None:
        if not self.exists(where):
            return None
        stream = self.fs.open(self.path(where))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, where: str, text: str) -> None:
        stream = self.fs.create(self.path(where), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def move(self, where: str, to: str) -> None:
        """Renames a folder; it must not be there already."""
        self.fs.mkdirs(self.path(to).getParent())
        if self.exists(to) or not self.fs.rename(self.path(where), self.path(to)):
            raise OSError(f"can't move {where} to {to}")

    def delete(self, where: str) -> None:
        self.fs.delete(self.path(where), True)


def _beside(root: str, kind: str) -> str:
    folder, name = root.rsplit("/", 1)
    return f"{folder}/{kind}/{name}"


def recover(files: Files, root: str) -> None:
    """Ends a replacement that died between its renames."""
    if files.exists(root):
        return
    for name, _ in sorted(files.names(_beside(root, REPLACED)), reverse=True):
        if files.exists(f"{_beside(root, STAGED)}/{name}/{DONE}"):
            files.move(f"{_beside(root, STAGED)}/{name}", root)
            return


def current(spark: SparkSession, root: str) -> dict[str, Any] | None:
    """What the last commit says of the table; None where there is none."""
    root = root.rstrip("/")
    files = Files(spark, root)
    recover(files, root)
    text = files.read(f"{root}/{DONE}")
    return None if text is None else json.loads(text)


def commit(spark: SparkSession, root: str, write: Callable[[str], dict[str, Any]], keep: int = 0) -> dict[str, Any]:
    """Calls `write` with the path of a new folder; if it returns, that becomes the table.

    If it raises, what it has written goes and the table stays. `keep` tables that were replaced stay under _replaced.
    """
    root = root.rstrip("/")
    files, name = Files(spark, root), f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    staged, replaced = f"{_beside(root, STAGED)}/{name}", f"{_beside(root, REPLACED)}/{name}"
    recover(files, root)
    try:
        said = {"snapshot": name, **write(staged)}
    except BaseException:
        files.delete(staged)
        raise
    files.put(f"{staged}/{DONE}", json.dumps(said))
    if files.exists(root):
        files.move(root, replaced)
    files.move(staged, root)
    for old, _ in sorted(files.names(_beside(root, REPLACED)), reverse=True)[keep:]:
        files.delete(f"{_beside(root, REPLACED)}/{old}")
    for left, changed in files.names(_beside(root, STAGED)):
        if changed / 1000 < time.time() - ABANDONED:
            files.delete(f"{_beside(root, STAGED)}/{left}")
    return said
