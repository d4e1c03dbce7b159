"""Exact removal of repeated byte strings with merged Burrows-Wheeler transforms.

A byte goes if a string of WINDOW bytes that covers it also starts anywhere else, in any document or the same.

1. Every window has an anchor, the first least 16-byte hash among its first WIDTH places, which depends on the
   window alone. Windows that start one after the other and share an anchor are a group. Equal windows have
   equal REST bytes from their anchor on, so groups whose REST bytes occur once in the corpus are done with.
2. The other groups' strings (their windows, as one string) are gathered by those REST bytes. A string that
   occurs twice has all its windows repeated. Where different strings share REST bytes, one of each goes on.
3. In a task, only windows whose middle another string of the group has are looked at. It suffix-sorts their
   strings shard by shard, and merges the shards' Burrows-Wheeler transforms by refining their interleave: each
   round sorts by some bytes more, stably by those before, with no suffix sorted again, and marks where the
   common prefix ends. The rows that are followed are those that end up as windows; after WINDOW bytes the
   intervals of more than one row are the repeated windows.
4. Groups of more than HOT different strings are too many for a task. Step 3's middles, narrowed to the windows
   themselves, are counted by hash (128 bits) for them, with partial counts before the shuffle: exact as well.

Texts shorter than WINDOW bytes have no window and stay whole; a null text is empty in the digest and stays null
as a text. Rows that repeat, ids and all, are repeats of each other. Very long texts are worked through like any
other, in a task's memory one at a time. There are no ties: a byte goes or stays by the input alone. Other columns
pass through, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, in_parts, release, utf8, whole_row, written

WINDOW, WIDTH, SEED_BYTES = 200, 150, 16
REST = WINDOW - WIDTH + 1
#: Different strings of a group in one task; bytes merged at once, and shards of them.
HOT, MERGED_BYTES, SHARDS = 10_000, 600_000, 4
SEPARATOR = 0xFF  # no byte of UTF-8
BLOCK = 16_384  # windows hashed at once
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number; a view of the bytes."""
    return np.ndarray((max(0, len(data) - 7),), np.dtype("<u8"), np.ascontiguousarray(data), strides=(1,))


def _anchors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor of each window, whether the window before has another one); v: _eights of the text.

    Windows are worked through by blocks whose arrays stay in a processor's cache."""
    n = len(v) + 8 - WINDOW
    anchor, new = np.empty(n, np.int32), np.empty(n, bool)
    place = np.arange(BLOCK + WIDTH - 1, dtype=np.uint64)
    for start in range(0, n, BLOCK):
        size = min(BLOCK, n - start)
        m = size + WIDTH - 1
        near = v[start : start + m + 8].copy()
        h, spare = near[:m] * _A, near[8:] * _B
        h ^= spare
        np.right_shift(h, np.uint64(29), out=spare)
        h ^= spare
        h *= _B
        h &= np.uint64(0xFFFFFFFF00000000)
        h |= place[:m]
        have = 1
        while have < WIDTH:
            step = min(have, WIDTH - have)
            h, spare = np.minimum(h[:-step], h[step:], out=spare[: len(h) - step]), h
            have += step
        h &= np.uint64(0xFFFFFFFF)
        own = anchor[start : start + size]
        own[:] = h
        own += start
        np.not_equal(own[1:], own[:-1], out=new[start + 1 : start + size])
        new[start] = not start or own[0] != anchor[start - 1]
    return anchor, new


def groups(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first start, last start, places from the first to the anchor, hash of the REST bytes) of each group of windows; starts within the text."""
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return (none,) * 5
    v = _eights(data)
    anchor, edge = _anchors(v)
    inside = at[:-1][at[:-1] < len(edge)]
    edge[inside] = True
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(anchor)) - 1
    text = np.searchsorted(at, first, "right") - 1
    last = np.minimum(last, at[text + 1] - WINDOW)
    ok = last >= first
    text, first, last = text[ok], first[ok], last[ok]
    anchor = anchor[first].astype(np.int64)
    x = np.zeros(len(first), np.uint64)
    for k in (*range(0, REST - 8, 8), REST - 8):
        x = (x ^ v[anchor + k]) * _A
        x ^= x >> np.uint64(31)
    return text, first - at[text], last - at[text], anchor - first, (x * _B).view(np.int64)


def transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(transform, suffix order) of strings, each closed by a separator; separators sort by their string's number."""
    text = np.frombuffer(b"".join(s + b"\xff" for s in strings), np.uint8)
    n = len(text)
    if not n:
        return text, np.zeros(0, np.int64)
    ends = np.flatnonzero(text == SEPARATOR)
    owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=-1))
    left = ends[owner] - np.arange(n)
    beyond = np.maximum(0, 7 - left).astype(np.uint64)  # of the first eight bytes, those after the separator
    first = _eights(np.concatenate([text, np.resize(text, 7)])).byteswap() >> np.uint64(8) * beyond
    rank = np.unique(first << np.uint64(8) * beyond, return_inverse=True)[1]
    rank = np.unique(rank * np.int64(len(ends) + 1) + np.where(left < 8, owner + 1, 0), return_inverse=True)[1]
    have = 8
    while have < n and rank.max() + 1 < n:
        rank = np.unique(rank * np.int64(n + 1) + np.roll(rank, -have), return_inverse=True)[1]
        have *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return text[order - 1], order


def steps_back(transforms: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of all shards' rows, one shard after the other: [b]: (row of the suffix b + 1 bytes longer, number of those bytes).

    A stable sort of a transform leads from a suffix to the one that a byte more in front makes of it. Bytes are
    numbered by the order of what they spell; there are as many steps as need no more than 65536 numbers.
    """
    every = np.concatenate(transforms)
    before, base = np.empty(len(every), np.int32), 0
    for t in transforms:
        before[base + np.argsort(t, kind="stable")] = np.arange(base, base + len(t), dtype=np.int32)
        base += len(t)
    letters = np.cumsum(np.bincount(every, minlength=256) > 0) - 1
    letter, size = letters[every].astype(np.int32), int(letters[-1]) + 1
    out, back, number, names = [], np.arange(len(every), dtype=np.int32), np.zeros(len(every), np.int32), 1
    for _ in range(8):
        spelled = letter[back] * np.int32(names) + number  # the byte farthest back is the first to sort by
        have = np.zeros(size * names, bool)
        have[spelled] = True
        if np.count_nonzero(have) > 65536:
            break
        dense = np.cumsum(have, dtype=np.int32) - 1
        number, names, back = dense[spelled], int(dense[-1]) + 1, before[back]
        out.append((back, number.astype(np.uint16)))
    return out


def merge(transforms: list[np.ndarray], rounds: int, row: np.ndarray | None = None, interval: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, interval of each) after so many bytes: rows of all shards, one after the other, that are like another one.

    A round puts the row of each suffix's predecessor where the bytes before it sort, so that rows which were in
    order by k bytes are in order by more, and an interval ends where those bytes or the interval before differ.
    A row alone in its interval stays alone, and so do all its predecessors: it needs no more rounds. Rows that
    aren't asked for need none either: row, interval (ascending) are those to follow, else all rows in one.
    """
    steps = steps_back(transforms)
    if row is None:
        row = np.arange(sum(map(len, transforms)), dtype=np.int32)
    if interval is None:
        interval = np.zeros(len(row), np.int32)
    left = rounds
    while left and len(row):
        back, number = steps[min(left, len(steps)) - 1]
        left -= min(left, len(steps))
        byte = number[row]
        order = np.argsort(byte, kind="stable")
        byte, row, old = byte[order], back[row[order]], interval[order]
        ends = np.ones(len(row) + 1, bool)
        ends[1:-1] = (byte[1:] != byte[:-1]) | (old[1:] != old[:-1])
        several = ~(ends[:-1] & ends[1:])
        row, interval = row[several], np.cumsum(ends[:-1], dtype=np.int32)[several]
    return row, interval


def repeated_starts(strings: list[bytes], kinds: list[tuple[int, int]] | None = None, shards: int = SHARDS, window: int = WINDOW) -> list[np.ndarray]:
    """For each string, a flag for each of its windows: whether an equal one starts anywhere else in the strings.

    kinds: a group of each string and its anchor's place; equal windows are of one group, as far before their
    anchors. The merge then starts with the intervals of what can be equal.
    """
    shards = max(1, min(shards, len(strings)))
    pieces = [list(range(k, len(strings), shards)) for k in range(shards)]
    dealt = [i for own in pieces for i in own]
    parts, row_of, base = [], [], 0
    for own in pieces:
        t, order = transform([strings[i] for i in own])
        back = np.empty(len(order), np.int32)
        back[order] = np.arange(base, base + len(order), dtype=np.int32)
        parts.append(t)
        row_of.append(back)
        base += len(t)
    sizes = np.array([len(strings[i]) for i in dealt], np.int64)
    have = np.maximum(sizes - window + 1, 0)
    nth = np.arange(have.sum()) - np.repeat(np.cumsum(have) - have, have)
    start = np.repeat(np.cumsum(sizes + 1) - sizes - 1, have) + nth
    row_of = np.concatenate(row_of or [np.zeros(0, np.int32)])
    flag = np.zeros(base, bool)
    if len(start):
        interval = np.zeros(len(start), np.int64)
        if kinds is not None:
            group, place = (np.array([kinds[i][k] for i in dealt], np.int64) for k in (0, 1))
            interval = np.repeat(np.unique(group, return_inverse=True)[1] * (2 * WIDTH), have) + np.repeat(place, have) - nth + WIDTH
        order = np.argsort(interval, kind="stable")
        followed = start[order]
        interval = np.unique(interval[order], return_inverse=True)[1].astype(np.int32)
        row, interval = merge(parts, window, row_of[followed + window], interval)
        place_of = np.empty(base, np.int64)
        place_of[row_of] = np.arange(base)
        flag[place_of[row]] = True
    ends = np.cumsum(sizes + 1)
    out = {i: flag[e - n - 1 : e - n - 1 + h] for i, e, n, h in zip(dealt, ends.tolist(), sizes.tolist(), have.tolist(), strict=True)}
    return [out[i] for i in range(len(strings))]


def narrowed(strings: list[bytes], kinds: list[tuple[int, int]], step: int = 25) -> list[tuple[int, int, int]]:
    """(string, first, last start) of the windows that others may equal.

    Windows that start from step * j to step * j + step - 1 places before their anchor all hold the same bytes of it
    but for step - 1 at either end: only those of which another string of the group has the same are kept.
    """
    cores: dict[tuple, int] = {}
    own: list[list[tuple]] = []
    for s, (group, place) in zip(strings, kinds, strict=True):
        mine = []
        for j in range((place - len(s) + WINDOW) // step, place // step + 1):
            at = place - j * step
            mine.append((group, j, s[at : at + WINDOW - step + 1]))
            cores[mine[-1]] = cores.get(mine[-1], 0) + 1
        own.append(mine)
    out = []
    for i, (s, (_, place), mine) in enumerate(zip(strings, kinds, own, strict=True)):
        run: list[int] = []
        for core in [*mine, None]:
            if core is not None and cores[core] > 1:
                run.append(core[1])
            elif run:
                out.append((i, max(0, place - run[-1] * step - step + 1), min(len(s) - WINDOW, place - run[0] * step)))
                run = []
    return out


def repeated_windows(strings: list[bytes], kinds: list[tuple[int, int]]) -> list[np.ndarray]:
    """What repeated_starts gives, of the windows that `narrowed` leaves; pieces that occur twice as a whole are known to repeat."""
    out = [np.zeros(max(0, len(s) - WINDOW + 1), bool) for s in strings]
    pieces: dict[tuple[int, int, bytes], list[tuple[int, int]]] = {}
    for i, first, last in narrowed(strings, kinds):
        pieces.setdefault((kinds[i][0], kinds[i][1] - first, strings[i][first : last + WINDOW]), []).append((i, first))
    flags = repeated_starts([s for *_, s in pieces], [k[:2] for k in pieces])
    for own, flag in zip(pieces.values(), flags, strict=True):
        for i, first in own:
            out[i][first : first + len(flag)] = True if len(own) > 1 else flag
    return out


def runs(flag: np.ndarray) -> list[list[int]]:
    """[first, last] of the runs of true."""
    closed = np.zeros(len(flag) + 2, bool)
    closed[1:-1] = flag
    edge = np.flatnonzero(closed[1:] != closed[:-1])
    edge[1::2] -= 1
    return edge.reshape(-1, 2).tolist()


def _keyed(docs: DataFrame) -> DataFrame:
    """row (all columns of docs), text, and _k, _l: 128 bits that tell rows apart by id and text."""
    key: list[Column] = [F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))]
    return docs.select(whole_row(docs).alias("row"), "text", F.xxhash64(*key).alias("_k"), F.xxhash64(F.lit("l"), *reversed(key)).alias("_l"))


def repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """_k, _l and spans (array of [first, last] starts of repeated windows) of the rows of _keyed(docs) that have any."""
    bounded_batches(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_parts(batches):
            x, n = np.unique(groups(*utf8(part.column("text")))[4], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(n, pa.int64())], ["x", "n"])

    def find_with_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_parts(batches):
            text, first, last, ahead, x = groups(*utf8(part.column("text")))
            own = pa.array(text)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), part.column("_k").take(own), part.column("_l").take(own), *(pa.array(c.astype(np.int32)) for c in (first, last, ahead))], ["x", "_k", "_l", "first", "last", "ahead"])

    twice = docs.select("text").mapInArrow(find, "x long, n long").groupBy("x").agg(F.sum("n").alias("n")).where(F.col("n") > 1).select("x")
    twice = written(twice, "repeated")  # a plain table, so that the join can split a hot key
    placed = docs.select("_k", "_l", "text").mapInArrow(find_with_places, "x long, _k long, _l long, first int, last int, ahead int")
    listed = placed.join(twice, "x", "left_semi").groupBy("_k", "_l").agg(F.collect_set(F.struct("first", "last", "ahead", "x")).alias("groups"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for part in in_parts(batches):
            data, at = utf8(part.column("text"))
            own = part.column("groups")
            row = np.repeat(np.arange(part.num_rows), pc.list_value_length(own).to_numpy())
            own = own.flatten()
            first, last, ahead, x = (own.field(c) for c in ("first", "last", "ahead", "x"))
            start = (at[row] + first.to_numpy()).tolist()
            stop = (at[row] + last.to_numpy() + WINDOW).tolist()
            raw = data.tobytes()
            view = memoryview(raw)
            name = np.fromiter((xxhash.xxh64_intdigest(view[a:z]) for a, z in zip(start, stop, strict=True)), np.uint64, len(row)).view(np.int64)
            if len(seen) > 300_000:
                seen.clear()
            strings: list[bytes | None] = []
            for pair, a, z in zip(zip(x.to_pylist(), name.tolist(), strict=True), start, stop, strict=True):
                strings.append(None if pair in seen else raw[a:z])
                seen.add(pair)
            owner = pa.array(row)
            yield pa.RecordBatch.from_arrays([x, pa.array(name), part.column("_k").take(owner), part.column("_l").take(owner), first, last, ahead, pa.array(strings, pa.binary())], ["x", "name", "_k", "_l", "first", "last", "ahead", "string"])

    once = docs.select("_k", "_l", "text").join(listed, ["_k", "_l"])  # rows that repeat give their groups each
    cells = written(once.mapInArrow(cut, "x long, name long, _k long, _l long, first int, last int, ahead int, string binary"), "windows")
    release(twice)
    counted = cells.groupBy("x", "name").agg(F.count("*").alias("n"))
    counted = written(counted, "strings")
    # a group goes on if it has several strings and one of them occurs once: the others are known to repeat
    kinds = counted.groupBy("x").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where((F.col("kinds") > 1) & (F.col("least") == 1)).drop("least")
    kinds = written(kinds, "kinds")  # plain tables on both sides, so that the join can split a hot group
    several = counted.join(kinds, "x")
    strings = cells.where(F.col("string").isNotNull()).select("x", "name", "ahead", "string").join(several, ["x", "name"]).dropDuplicates(["x", "name"])
    strings = written(strings, "open-strings")
    whole = counted.where(F.col("n") > 1).select("x", "name", F.lit(None).cast("array<array<int>>").alias("spans"))

    def by_transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by x."""
        held: list[tuple[int, int, int, int, bytes]] = []
        size = 0

        def out() -> pa.RecordBatch:
            flags = repeated_windows([s for *_, s in held], [(x, ahead) for x, _, _, ahead, _ in held])
            got = [(x, name, r) for (x, name, n, *_), f in zip(held, flags, strict=True) if n == 1 and (r := runs(f))]
            cols = zip(*got, strict=True) if got else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int32()))), strict=True)], ["x", "name", "spans"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("x", "name", "n", "ahead", "string")), strict=True):
                if size > MERGED_BYTES and row[0] != held[-1][0]:
                    yield out()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield out()

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, name, n, string in zip(*(batch.column(c).to_pylist() for c in ("x", "name", "n", "string")), strict=True):
                count = len(string) - WINDOW + 1
                digest = [xxhash.xxh3_128_digest(string[k : k + WINDOW]) for k in range(count)]
                yield pa.RecordBatch.from_arrays([pa.array([x] * count), pa.array([name] * count), pa.array([n] * count), pa.array(np.arange(count, dtype=np.int32)), pa.array(digest, pa.binary())], ["x", "name", "n", "start", "window"])

    few = strings.where(F.col("kinds") <= hot).select("x", "name", "n", "ahead", "string").repartition("x").sortWithinPartitions("x", "name")
    merged = few.mapInArrow(by_transform, "x long, name long, spans array<array<int>>")
    found = whole.unionByName(merged)
    many = strings.where(F.col("kinds") > hot)
    if not many.isEmpty():
        each = many.select("x", "name", "n", "string").mapInArrow(windows, "x long, name long, n long, start int, window binary")
        again = each.groupBy("window").agg(F.sum("n").alias("times")).where(F.col("times") > 1).select("window")
        hits = each.where(F.col("n") == 1).join(again, "window", "left_semi")
        found = found.unionByName(hits.groupBy("x", "name").agg(F.collect_list(F.array("start", "start")).alias("spans")))
    placed = cells.select("x", "name", "_k", "_l", "first", "last").join(found, ["x", "name"])
    shifted = F.transform("spans", lambda s: F.array(s[0] + F.col("first"), s[1] + F.col("first")))
    return placed.select("_k", "_l", F.coalesce(shifted, F.array(F.array("first", "last"))).alias("spans"))


def _gone(text: pa.Array, own: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, the bytes that go) of some texts; own: [first, last] starts of repeated windows of each, or null."""
    data, at = utf8(text)
    row = np.repeat(np.arange(len(text)), pc.fill_null(pc.list_value_length(own), 0).to_numpy())
    span = own.flatten().flatten().to_numpy().reshape(-1, 2) + at[row][:, None]
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, span[:, 0], 1)
    np.subtract.at(change, span[:, 1] + WINDOW, 1)
    return data, at, np.cumsum(change[:-1], dtype=np.int32) > 0


def spans_by_row(docs: DataFrame, **options) -> DataFrame:
    """row (all columns of docs), text, and own: [first, last] starts of repeated windows, null where there are none."""
    docs = _keyed(docs)
    own = repeats(docs, **options).groupBy("_k", "_l").agg(F.flatten(F.collect_set("spans")).alias("own"))
    return docs.join(own, ["_k", "_l"], "left")


def dedup_digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of docs."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_parts(batches):
            data, at, gone = _gone(part.column("text"), part.column("own"))
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            begins[at[:-1][at[:-1] < len(gone)]] = gone[at[:-1][at[:-1] < len(gone)]]
            upto = lambda flag: np.diff(np.concatenate([[0], np.cumsum(flag)])[at])
            size, less = np.diff(at), upto(gone)
            kept = memoryview(data[~gone].tobytes())
            stop = np.cumsum(size - less).tolist()
            digest = [hashlib.sha256(kept[a:z]).hexdigest() for a, z in zip([0, *stop], stop, strict=False)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(size), pa.array(less), pa.array(upto(begins)), pa.array(digest)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    out = spans_by_row(docs.select("doc_id", "text"), **options).select("row.doc_id", "text", "own")
    return out.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """docs with the repeated bytes gone from text; bytes left of a character that was cut go too."""

    @F.arrow_udf("string")
    def kept(text: pa.Array, own: pa.Array) -> pa.Array:
        out: list[str | None] = []
        for part in in_parts([pa.RecordBatch.from_arrays([text, own], ["text", "own"])]):
            data, at, gone = _gone(part.column("text"), part.column("own"))
            for changed, a, z in zip(part.column("own").is_valid().to_pylist(), at.tolist(), at[1:].tolist(), strict=False):
                out.append(data[a:z][~gone[a:z]].tobytes().decode(errors="ignore") if changed else None)
        return pa.array(out, pa.string())

    out = spans_by_row(docs, **options)
    text = F.when(F.col("own").isNull(), F.col("text")).otherwise(kept("text", "own"))
    return out.select(*(text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))
