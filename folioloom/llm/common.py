"""What the operators share: tables, the shared folder, and text columns as byte arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Words are runs of anything but ASCII white space; bytes.split() cuts at just these bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keeps Arrow batches small, as one text may be long; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


_own_dirs: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set, one of our own, if all runs on one machine."""
    if path := spark.conf.get("spark.checkpoint.dir", None):
        return path.rstrip("/")
    if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    if not _own_dirs:
        _own_dirs.append(f"file://{tempfile.mkdtemp(prefix='folioloom-')}")
    return _own_dirs[0]


def written(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends there, and it outlives executors."""
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def release(*frames: DataFrame) -> None:
    """Empties tables of `written` that nothing will read again."""
    for df in frames:
        df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(df.written_to)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that columns of the operators' own can't clash with them."""
    return F.struct(*(F.col(f"`{c}`").alias(c) for c in df.columns))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    at = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def as_arrow(data: np.ndarray, at: np.ndarray, binary: bool = False) -> pa.Array:
    """The inverse of utf8: a column of strings, or of binaries."""
    wide = at[-1] >= 2**31
    kind = (pa.large_binary() if wide else pa.binary()) if binary else (pa.large_string() if wide else pa.string())
    return pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(at.astype(np.int64 if wide else np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def beside(df: DataFrame, left_out: str) -> Column:
    """All columns but one, as one struct."""
    rest = df.select(*(F.col(f"`{c}`") for c in df.columns if c != left_out))
    return whole_row(rest) if rest.columns else F.struct(F.lit(0))


def schema_beside(rows: DataFrame, results: dict[str, DataType]) -> StructType:
    """Of a kernel that returns the struct `row` and results."""
    return StructType([rows.schema["row"], *(StructField(k, v) for k, v in results.items())])


def with_results(out: DataFrame, columns: list[str], results: dict[str, str]) -> DataFrame:
    """The columns of `row`, without those named like results, then the results under their names."""
    taken = {r.lower() for r in results}
    return out.select(*(F.col(f"`row`.`{c}`").alias(c) for c in columns if c.lower() not in taken), *(F.col(v).alias(k) for k, v in results.items()))


def in_parts(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 2_000_000, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each holds some `most` bytes of text or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = utf8(batch.column(text))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(at, at[start] + most, "right")) - 1
            stop = min(max(stop, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def first_by_hash(df: DataFrame, hashed: str, most: int) -> DataFrame:
    """The rows with the `most` least values of the long column `hashed`, or of them all if there are fewer.

    The place of the cut is found by counting 12 bits of the hash at a time, so no task gets more than the few rows
    that share the cut's digits; of rows that tie at the cut by the whole hash, any.
    """
    near, left, low = df, most, None
    place = F.col(hashed).bitwiseXOR(F.lit(-(1 << 63)))  # unsigned order becomes signed order
    for level in range(5):
        digit = F.shiftrightunsigned(place, 52 - 12 * level).bitwiseAND(F.lit(4095))
        counts = sorted((r[0], r[1]) for r in near.groupBy(digit.alias("digit")).count().collect())
        for value, n in counts:
            if n > left:
                break
            left -= n
        else:
            return df if low is None else df.where(low)
        inside, below = digit == value, digit < value
        taken = below if low is None else (low | (within & below))
        within = inside if level == 0 else within & inside
        low, near = taken, df.where(within)
        if n <= 1000 or not left:
            break
    rest = near.orderBy(hashed).limit(left)
    return df.where(low).unionByName(rest) if left else df.where(low)


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, most: int, most_bytes: int) -> DataFrame:
    """doc_id, h, y, text of at most `most` labelled documents and `most_bytes`, those of the least hashes h, as a table.

    A text that would exceed the bytes is left out, however long; those behind it are taken while they fit.

    Labels that are null, neither 0 nor 1, or of a null id are left out; of an id's labels the higher counts, and
    of its texts the one with the least hash. A null text is empty.
    """
    known = labels.where(F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.max("y").alias("y")).withColumn("h", F.xxhash64("doc_id", F.lit(13)))
    known = written(first_by_hash(known, "h", most), "chosen-labels", 1)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    rows = written(rows.groupBy("doc_id", "h", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "labelled-texts")
    total, last, over = 0, None, []
    for h, size in sorted(tuple(r) for r in rows.select("h", F.octet_length("text")).collect()):
        if total + size > most_bytes:  # a text that doesn't fit is left out, and shorter ones behind it aren't
            over.append(h)
        else:
            total, last = total + size, h
    release(known)
    if last is None:
        out = rows.limit(0)
    else:
        out = rows.where((F.col("h") <= last) & ~F.col("h").isin([h for h in over if h < last]))
    out.written_to = rows.written_to
    return out


def held_out(doc_id: str, of: int):
    """crc32 of the id as text has remainder 2; false where the id is null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % of == 2, F.lit(False))


def words_of(text: str | bytes | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased; bytes.lower() changes ASCII letters only."""
    if text is None:
        return []
    return (text if isinstance(text, bytes) else text.encode()).lower().split()


_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_CHUNK = 1 << 17


class _Kept(dict):
    """What a process has worked out; it stays there when functions that use it travel."""

    def __reduce__(self) -> tuple:
        return _Kept, ()


_KEPT = _Kept()


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers and one more; those of usual chunks are worked out once."""
    most = 2 * _CHUNK
    if n > most:
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))
    if base not in _KEPT:
        _KEPT[base] = _powers(base, most + 1)
    return _KEPT[base][: n + 1]


def word_hashes(low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first bytes, ends, hashes) of the words in a byte array, one after the other; a word has no space (32).

    A word's hash is the sum of its bytes times powers of a base, of which prefix sums give all at once.
    """
    inside = np.zeros(len(low) + 2, bool)
    np.not_equal(low, 32, out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edge[::2], edge[1::2]
    out, k = np.empty(len(first), np.uint64), 0
    while k < len(first):
        stop = max(k + 1, int(np.searchsorted(last, first[k] + _CHUNK)))
        s, e = first[k:stop] - first[k], last[k:stop] - first[k]
        size = int(e[-1]) + 1
        power, back = (_powers(b, size) for b in (int(_BASE), int(_INVERSE)))
        sums = np.zeros(size, np.uint64)
        np.add(low[first[k] : first[k] + size - 1], np.uint64(1), out=sums[1:], dtype=np.uint64)
        sums *= power[:-1]  # one place on, which is the first power too much
        np.cumsum(sums, out=sums)
        out[k:stop] = (sums[e] - sums[s]) * back[s + 1]
        k = stop
    out ^= out >> np.uint64(32)
    out *= _MIX
    return first, last, out ^ (out >> np.uint64(29))


def apart(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, starts) of texts with a space between them, so that words end with their texts."""
    if len(at) > 2 and len(data):
        ends = at[1:-1]
        data = np.insert(data, ends, 32)
        return data, at + np.concatenate([np.arange(len(at) - 1), [len(at) - 2]])
    return data, at


class HashTable:
    """Numbers of known words, found by hash: in order, with a table of where their first 20 bits start."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.starts = np.searchsorted(self.hashes >> np.uint64(44), np.arange((1 << 20) + 1, dtype=np.uint64))
        self.longest = int(np.diff(self.starts).max())

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """-1 where unknown."""
        out = np.full(len(h), -1, np.int64)
        if len(self.hashes):
            at = self.starts[(h >> np.uint64(44)).astype(np.int64)]
            for k in range(self.longest):
                place = np.minimum(at + k, len(self.hashes) - 1)
                same = self.hashes[place] == h
                out[same] = place[same]
        return out
