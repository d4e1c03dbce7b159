"""Fill-in-middle: texts are cut into prefix, middle and suffix, and written in another order between marks.

One kernel does a whole Arrow batch on its UTF-8 bytes: a table gives each byte's class, neighbouring bytes give the
mask of units' first bytes, cumulative sums that start anew with each document number them, and one search finds
the cuts of all rows.

Units are lines (`[^\n]*\n|[^\n]+`) or, with `unit="char"`, code points. What a row becomes hangs on its id and the
seed alone: of the sha256 of `seed:id` the first four groups of eight digits, h1 to h4, give the two cuts (h1 and h2
modulo units + 1), whether the row stays plain (h3) and in which form it is written (h4).

Null texts are empty, and empty texts stay plain, as do texts that hold a mark. A null id counts as an empty one. Rows
that repeat give equal results, an empty table gives an empty one. Texts of any length are done whole; only the text's
own column reaches Python. Other columns stay, but for those named like the results, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from .common import as_arrow, beside, bounded_batches, in_parts, schema_beside, utf8, with_results

#: Fixed by contract: before the prefix, the suffix and the middle.
MARKS = (b"<P>", b"<S>", b"<M>")
RESULTS = {"units": LongType(), "form": StringType(), "prefix_chars": LongType(), "middle_chars": LongType(), "output": StringType()}

#: Classes of bytes, as bits: continuation of a code point, line feed, and the bytes of the marks.
CONTINUES, FEED, OPENS, LETTER, CLOSES = 1, 2, 4, 8, 16
CLASSES = np.zeros(256, np.uint8)
CLASSES[0x80:0xC0] = CONTINUES
for _of, _class in ((b"\n", FEED), (b"<", OPENS), (b"PSM", LETTER), (b">", CLOSES)):
    CLASSES[list(_of)] = _class


def marks_at(data: np.ndarray, kinds: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first bytes, rows) of all marks that lie within one document."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero((kinds[:-2] == OPENS) & (kinds[1:-1] == LETTER) & (kinds[2:] == CLOSES))
    row = np.searchsorted(at, first, "right") - 1
    inside = first + 3 <= at[row + 1]
    return first[inside], row[inside]


def unit_starts(kinds: np.ndarray, at: np.ndarray, unit: str) -> np.ndarray:
    """True at each byte that begins a unit."""
    if unit == "char":
        return kinds != CONTINUES
    starts = np.zeros(len(kinds), bool)
    starts[1:] = kinds[:-1] == FEED
    starts[at[:-1][at[:-1] < at[1:]]] = True
    return starts


def count_before(mask: np.ndarray) -> np.ndarray:
    """How many are set before each place, and at the end all."""
    out = np.zeros(len(mask) + 1, np.int32 if len(mask) < 2**31 else np.int64)
    np.cumsum(mask, out=out[1:], dtype=out.dtype)
    return out


def cuts(data: np.ndarray, at: np.ndarray, h: np.ndarray, unit: str, plain_from: int, spm_below: int) -> dict[str, np.ndarray]:
    """units, plain, spm, first and second cut (as bytes) and code points before the cuts, of all rows at once."""
    kinds = CLASSES[data]
    seen = count_before(unit_starts(kinds, at, unit))
    units = (seen[at[1:]] - seen[at[:-1]]).astype(np.int64)  # the sum starts anew with each document
    one, two = h[0] % (units + 1), h[1] % (units + 1)
    wanted = np.stack([np.minimum(one, two), np.maximum(one, two)])
    # The unit after k others is the first byte behind which k + 1 of its document have begun.
    found = np.searchsorted(seen, (seen[at[:-1]] + wanted + 1).astype(seen.dtype)) - 1
    found = np.where(wanted == units, at[1:], found)
    marked = np.zeros(len(units), bool)
    marked[marks_at(data, kinds, at)[1]] = True
    chars = count_before(kinds != CONTINUES)
    plain = marked | (units == 0) | (h[2] % 100 >= plain_from)
    return {"units": units, "plain": plain, "spm": h[3] % 100 < spm_below, "cut": found, "chars": (chars[found] - chars[at[:-1]]).astype(np.int64)}


def joined(pieces: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of rows that are made of slices of `pieces`: first and size have a row for each."""
    out = [pieces[a : a + n] for a, n in zip(first.ravel().tolist(), size.ravel().tolist(), strict=True) if n]
    return np.concatenate(out) if out else np.zeros(0, np.uint8), np.concatenate([[0], np.cumsum(size.sum(1))])


def written_out(data: np.ndarray, at: np.ndarray, of: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The outputs of all rows, as (bytes, offsets)."""
    start, end, (a, b) = at[:-1], at[1:], of["cut"]
    pieces = np.concatenate([data, np.frombuffer(b"".join(MARKS), np.uint8)])
    p, s, m = (np.full(len(start), len(data) + 3 * k) for k in range(3))
    spm = of["spm"][:, None]
    first = np.where(spm, np.stack([s, b, p, start, m, a], 1), np.stack([p, start, s, b, m, a], 1))
    three, head, middle, tail = np.full(len(start), 3), a - start, b - a, end - b
    size = np.where(spm, np.stack([three, tail, three, head, three, middle], 1), np.stack([three, head, three, tail, three, middle], 1))
    whole = of["plain"]
    first[whole, 0], size[whole, 0] = start[whole], (end - start)[whole]
    size[whole, 1:] = 0
    return joined(pieces, first, size)


def put_back(data: np.ndarray, at: np.ndarray, spm: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts from which outputs were made: outputs that aren't plain hold three marks each."""
    start, end = at[:-1], at[1:]
    first, row = marks_at(data, CLASSES[data], at)
    kept = ~plain[row]
    first, row = first[kept], row[kept]
    counts = np.bincount(row, minlength=len(start))
    if (counts[~plain] != 3).any():
        raise ValueError("an output that is not plain has to hold three marks")
    one, two, three = np.zeros((3, len(start)), np.int64)
    one[~plain], two[~plain], three[~plain] = first[0::3], first[1::3], first[2::3]
    head = np.where(spm, two, one) + 3, np.where(spm, three - two, two - one) - 3
    tail = np.where(spm, one, two) + 3, np.where(spm, two - one, three - two) - 3
    middle = three + 3, end - three - 3
    begins, size = np.stack([head[0], middle[0], tail[0]], 1), np.stack([head[1], middle[1], tail[1]], 1)
    begins[plain, 0], size[plain, 0] = start[plain], (end - start)[plain]
    size[plain, 1:] = 0
    return joined(data, begins, size)


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def infill(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = "7", rate: int = 100, spm: int = 50, unit: str = "line") -> DataFrame:
    """The rows without their text, with units, form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output.

    `rate` of a hundred texts are cut, and of these `spm` of a hundred have the suffix first.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unit {unit!r} is neither line nor char")
    bounded_batches(docs.sparkSession)
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))).cast("binary"), 256)
    parts = [F.conv(F.substring(digits, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k}") for k in range(4)]
    rows = docs.select(beside(docs, text).alias("row"), F.col(f"`{text}`").cast("string").alias("text"), *parts)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            data, at = utf8(batch.column("text"))
            of = cuts(data, at, np.stack([_numbers(batch, f"h{k}") for k in range(4)]), unit, rate, spm)
            form = np.where(of["plain"], "plain", np.where(of["spm"], "spm", "psm"))
            before, middle = of["chars"][0], of["chars"][1] - of["chars"][0]
            result = [pa.array(of["units"]), pa.array(form.tolist(), pa.string()), pa.array(before, mask=of["plain"]), pa.array(middle, mask=of["plain"]), as_arrow(*written_out(data, at, of))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *result], names=["row", *RESULTS])

    out = rows.mapInArrow(kernel, schema_beside(rows, RESULTS))
    return with_results(out, [c for c in docs.columns if c != text], {c: c for c in RESULTS})


def restore(rows: DataFrame, output: str = "output", form: str = "form", result: str = "text") -> DataFrame:
    """The rows of `infill` with the exact texts that outputs and forms were made of, in the place of the outputs.

    A null output is empty, a null form plain. An output in the other forms that doesn't hold three marks is an error.
    """
    bounded_batches(rows.sparkSession)
    kind = F.col(f"`{form}`")
    wanted = rows.select(beside(rows, output).alias("row"), F.col(f"`{output}`").alias("text"), (kind == "spm").alias("spm"), F.coalesce(kind == "plain", F.lit(True)).alias("plain"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            spm, plain = (batch.column(c).fill_null(False).to_numpy(zero_copy_only=False) for c in ("spm", "plain"))
            yield pa.RecordBatch.from_arrays([batch.column("row"), as_arrow(*put_back(*utf8(batch.column("text")), spm, plain))], names=["row", "restored"])

    out = wanted.mapInArrow(kernel, schema_beside(wanted, {"restored": StringType()}))
    return with_results(out, [c for c in rows.columns if c != output], {result: "restored"})


def infill_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and the hashes of the output and of the text made from it again."""
    made = infill(docs.select("doc_id", "text"))
    back = restore(made.withColumn("output_sha256", F.sha2(F.col("output").cast("binary"), 256)))
    return back.select("doc_id", F.col("units").alias("n"), "form", "prefix_chars", "middle_chars", "output_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("restored_sha256"))
