"""Document fingerprints of closed syncmers.

A closed syncmer is a k-mer whose least s-mer (by hash) starts at its first or last place; whether a k-mer is
one depends on nothing around it. Of a text's syncmers, each of SLOTS slots keeps the one with the least hash
(the first, if it occurs more than once) and its position. A fingerprint is ten hex digits a slot: three of
the hash, seven of the position in steps of STEP bytes, enough for any string; dots where a slot is empty.
Likeness is the share of the slots filled in either fingerprint in which both have one hash on the commonest
shift of positions.

Texts are compared as UTF-8. A text shorter than a k-mer has one anchor, its own hash; an empty or null text
has none, and two without any are alike (1.0). Ids may be of any type that can be ordered. Rows of one id are in
the order of their texts' hash, so a hot id is dealt to many tasks; rows that repeat an id and a text follow each
other. Very long texts are read whole, one at a time. Other columns don't matter. An empty table gives an empty
result, a single row is its own next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

K, S, SLOTS, STEP = 16, 8, 128, 16
#: A part of the ids has at most about so many bytes of text; there are as many as shuffle partitions at least.
PART_BYTES, SAMPLED = 64_000_000, 8
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def syncmers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, 64-bit hashes) of the closed syncmers of a byte array."""
    if len(data) < K:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    v = data.astype(np.uint64)
    v = v[:-1] | v[1:] << np.uint64(8)
    v = v[:-2] | v[2:] << np.uint64(16)
    v = v[:-4] | v[4:] << np.uint64(32)
    v *= _A
    v ^= v >> np.uint64(32)
    h = (v * _B >> np.uint64(32)).astype(np.uint32)
    n, gap = len(data) - K + 1, K - S
    least = np.minimum(h[:-1], h[1:])
    least = np.minimum(least[:-2], least[2:])
    least = np.minimum(least[:-4], least[4:])[:n]  # of eight; the ninth is the last
    at = np.flatnonzero((h[:n] <= np.minimum(least, h[gap : gap + n])) | (h[gap : gap + n] < least))
    mixed = (v[at] * _C) ^ v[at + gap]
    mixed *= _B
    return at, mixed ^ (mixed >> np.uint64(29))


def sketches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(texts, SLOTS) hashes, -1 where empty, and positions in steps."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    hashes, places = np.full((len(texts), SLOTS), -1, np.int32), np.zeros((len(texts), SLOTS), np.int32)
    at, h = syncmers(data)
    doc = np.searchsorted(ends, at, "right")
    own = at + K <= ends[doc] if len(at) else np.zeros(0, bool)
    at, h, doc = at[own], h[own], doc[own]
    at = at - np.concatenate([[0], ends])[doc]
    slot = (h >> np.uint64(57)).astype(np.int64)
    order = np.lexsort((at, (h & np.uint64(0xFFFFFFFFFFF)), doc * SLOTS + slot)) if len(at) else np.zeros(0, np.int64)
    cell = (doc * SLOTS + slot)[order]
    first = order[np.flatnonzero(np.diff(cell, prepend=-1))]
    hashes[doc[first], slot[first]] = (h[first] & np.uint64(0xFFF)).astype(np.int32)
    places[doc[first], slot[first]] = at[first] // STEP
    for i, t in enumerate(texts):
        if 0 < len(t) < K:
            x = xxhash.xxh64_intdigest(t)
            hashes[i, x >> 57] = x & 0xFFF
    return hashes, places


_HEX = np.array([list(b"%03x" % i) for i in range(4096)], np.uint8)


def strings(hashes: np.ndarray, places: np.ndarray) -> list[str]:
    out = np.concatenate([_HEX[hashes & 0xFFF], _HEX[places >> 16 & 0xFFF], _HEX[places >> 4 & 0xFFF], _HEX[places & 0xF, 2:]], axis=2)
    out[hashes < 0] = ord(".")
    return [row.tobytes().decode() for row in out.reshape(len(out), -1)]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Of fingerprints row by row, from 0 to 1."""
    filled = ((a[0] >= 0) | (b[0] >= 0)).sum(axis=1)
    same = (a[0] == b[0]) & (a[0] >= 0)
    none = np.int64(-(1 << 40))
    shift = np.where(same, a[1].astype(np.int64) - b[1], none)  # a step more or less from rounding goes with its neighbour
    out = np.zeros(len(filled))
    shift.sort(axis=1)
    for i in range(len(out)):
        if not filled[i]:
            out[i] = 1.0
        elif len(own := shift[i, np.searchsorted(shift[i], none, "right") :]):
            near = np.searchsorted(own, own + 1, "right") - np.arange(len(own))
            out[i] = near.max() / filled[i]
    return out


def _edited(text: str, after: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _order(kind: str) -> Column:
    """doc_id as a long or a string that sorts like it, null first."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    if kind.startswith(("decimal", "float", "double", "date", "timestamp", "boolean")):
        raise ValueError(f"ids of type {kind}: cast them to long or string")
    return F.coalesce(F.concat(F.lit("1"), F.col("doc_id").cast("string")), F.lit("0"))


def _place(cut_key: np.ndarray, cut_hash: np.ndarray, key: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(how many cuts are at or before each (key, hash), whether it is one)."""
    low, high = np.searchsorted(cut_key, key, "left"), np.searchsorted(cut_key, key, "right")
    at, is_cut = low.copy(), np.zeros(len(key), bool)
    for k in np.unique(low[high > low]):
        own = (low == k) & (high > low)
        cuts = cut_hash[k : high[own][0]]
        at[own] = k + np.searchsorted(cuts, h[own], "right")
        is_cut[own] = np.isin(h[own], cuts)
    return at, is_cut


def fingerprint_with_edits(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Fingerprints of every text and of the text whose last half gives way to the front of the next document's.

    Next is by doc_id, null first, then by hash of the text; the first follows the last. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Documents are dealt to ranges of ids; the first of each range is also sent to the range before it.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    bounded_batches(spark)
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), _order(kind).alias("key"), F.xxhash64(text).alias("h"))
    total, n, least = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*"), F.min(F.struct("key", "h"))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1 + total // part_bytes)
    # cuts are keys of a sample, the first of all included
    chosen = F.pmod(F.xxhash64("key", "h", F.lit(3)), F.lit(1 << 30)) < int(min(1.0, SAMPLED * parts / max(1, n)) * (1 << 30))
    sample = sorted({(r["key"], r["h"]) for r in docs.select("key", "h").where(chosen).toArrow().to_pylist()})
    cuts = sorted({sample[k * len(sample) // parts] for k in range(1, parts)} | {tuple(least)}) if sample else [tuple(least)] if least else []
    keys = np.array([k for k, _ in cuts], np.int64 if docs.schema["key"].dataType.simpleString() == "bigint" else object)
    bounds = spark.sparkContext.broadcast((keys, np.array([h for _, h in cuts], np.int64)))

    @F.pandas_udf("array<int>")
    def dealt(key: pd.Series, h: pd.Series) -> pd.Series:
        at, first = _place(*bounds.value, key.to_numpy(), h.to_numpy(np.int64))
        last = len(bounds.value[0]) - 1
        return pd.Series([[p, p - 1 if p else last] if f else [p] for p, f in zip((at - 1).tolist(), first.tolist(), strict=True)])

    rows = docs.withColumn("to", dealt("key", "h")).select("doc_id", "text", "key", "h", F.posexplode("to").alias("guest", "part"))
    rows = rows.repartitionById(max(1, len(cuts)), F.col("part")).sortWithinPartitions("guest", "key", "h", "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A part's own rows come in their order, then its guest, the first row of the next part."""

        def out(ids: list, texts: list[str]) -> pa.RecordBatch:
            """Of all texts but the last, which is the next of the one before it."""
            edited = [_edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
            raw = [t.encode() for t in edited]
            mine, theirs = sketches([t.encode() for t in texts]), sketches(raw)
            own, after = tuple(x[:-1] for x in mine), tuple(x[1:] for x in mine)
            cols = [pa.array(ids[:-1], pa_kind), pa.array([len(t) for t in texts[:-1]], pa.int64()), [hashlib.sha256(t).hexdigest() for t in raw], strings(*own), strings(*theirs), likeness(own, theirs), likeness(own, after)]
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names)

        ids, texts, size, pa_kind, over = [], [], 0, None, False
        for batch in batches:
            pa_kind = batch.column("doc_id").type
            for i, t, g in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("guest").to_pylist(), strict=True):
                if over:
                    break  # guests that repeat the first one
                t, over = t.as_py(), bool(g)
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size > 600_000:
                    if len(ids) > 1:
                        yield out(ids, texts)
                    ids, texts, size = ids[-1:], texts[-1:], len(t)
        if len(ids) > 1:
            yield out(ids, texts)

    return rows.select("doc_id", "text", "guest").mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
