"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and items are compared in a normal form: A-Z lower-cased, white space runs as one space, ends stripped.
An item of up to SEGMENT bytes is one segment; a longer one is cut into overlapping segments of that length.
A segment of L bytes is found where a region of the text is within e = floor(RATE * L) edits of it (none below
EXACT bytes). By the q-gram lemma such a region shares at least L - q + 1 - q * e of the segment's q-grams.
First every window of a text is held against that bound with all segments' q-grams together; where it is met,
the shared q-grams are counted by segment in overlapping bands of diagonals; bands that meet the bound are
verified by banded alignment. All three steps keep every true match.

Texts are gone through in stretches of CHUNK bytes, and shared q-grams are expanded POSTINGS at a time, so long and
repetitive texts take no more memory than others, but for their normal form. A segment that is found in a text
isn't looked for in it again: start, end and edits are those of the places found first.

Null and empty texts match nothing. Items without a text or an id carry no evidence and match nothing. Those of
less than `shortest` bytes in normal form (by default Q, for shorter ones are found anywhere) don't either; below
Q bytes an item has no q-gram and is searched as it is. Items that repeat are each reported, and so are rows that
repeat. Ties of edits keep the place found first. Other columns don't matter to `find` and pass through
`keep_clean`. An empty table of documents gives an empty result, an empty benchmark finds nothing. A benchmark of
more than INDEX_BYTES is searched in parts of about that size, so what is broadcast stays bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, in_parts, utf8

Q, SEGMENT, STRIDE, RATE, EXACT = 8, 100, 50, 0.08, 40
INDEX_BYTES, TABLE_BITS = 16_000_000, 22
#: Bytes gone through at once, bytes of a region at most, q-grams of segments expanded at once.
CHUNK, LONGEST, POSTINGS = 1 << 22, 1 << 14, 1 << 21
#: Segments are filtered with others of like length.
LENGTH_CLASSES = (EXACT, 60, 80)


def _lower() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    out[[9, 10, 11, 12, 13]] = 32
    return out


def normal(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, places in data) of texts in normal form; a space may stay at the end."""
    low = _lower()[data]
    space = low == 32
    before = np.empty(len(low), bool)
    before[1:] = space[:-1]
    before[at[:-1][np.diff(at) > 0]] = True
    keep = ~(space & before)
    ends = np.concatenate([[0], np.cumsum(keep)])[at]
    return low[keep], ends, np.flatnonzero(keep)


def grams(data: np.ndarray) -> np.ndarray:
    """The Q = 8 bytes from each place on, as a number."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    v = data.astype(np.uint64)
    v = v[:-1] | v[1:] << np.uint64(8)
    v = v[:-2] | v[2:] << np.uint64(16)
    return v[:-4] | v[4:] << np.uint64(32)


def _slot(gram: np.ndarray) -> np.ndarray:
    return ((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int32)


class Index:
    def __init__(self, items: list[tuple[int, bytes]], shortest: int = Q):
        """items: (id, text in normal form)."""
        self.short = [(k, text) for k, (_, text) in enumerate(items) if max(1, shortest) <= len(text) < Q]
        self.segments: list[tuple[int, int, bytes, int, int]] = []  # number of the item, place, bytes, e, bound
        self.ids = [i for i, _ in items]
        for k, (_, text) in enumerate(items):
            if len(text) < max(Q, shortest):
                continue
            starts = range(0, max(1, len(text) - SEGMENT + STRIDE), STRIDE) if len(text) > SEGMENT else (0,)
            for s in sorted({min(s, max(0, len(text) - SEGMENT)) for s in starts}):
                seg = text[s : s + SEGMENT]
                e = int(RATE * len(seg)) if len(seg) >= EXACT else 0
                self.segments.append((k, s, seg, e, len(seg) - Q + 1 - Q * e))
        self.classes = []
        for k in range(len(LENGTH_CLASSES) + 1):
            own = [i for i, s in enumerate(self.segments) if np.searchsorted(LENGTH_CLASSES, len(s[2]), "right") == k]
            if not own:
                continue
            parts = [grams(np.frombuffer(self.segments[i][2], np.uint8)) for i in own]
            gram = np.concatenate(parts)
            seg = np.repeat(own, [len(p) for p in parts])
            place = np.concatenate([np.arange(len(p)) for p in parts])
            order = np.argsort(gram, kind="stable")
            bitmap = np.zeros(1 << TABLE_BITS, np.uint8)
            bitmap[_slot(gram)] = 1
            keys, first = np.unique(gram[order], return_index=True)
            reach = max(len(self.segments[i][2]) + self.segments[i][3] for i in own)
            self.classes.append({"number": k, "bitmap": bitmap, "keys": keys, "first": first, "count": np.diff(np.append(first, len(gram))), "seg": seg[order], "place": place[order], "reach": reach, "bound": max(1, min(self.segments[i][4] for i in own))})
        self.e = np.array([s[3] for s in self.segments], np.int64)
        self.bound = np.maximum(1, np.array([s[4] for s in self.segments], np.int64))


def regions(hit: np.ndarray, at: np.ndarray, group: dict) -> np.ndarray:
    """Rows (text, start, stop) where some window has enough hits for the segments of a class."""
    width, reach = group["reach"] - Q + 1, group["reach"]
    total = np.zeros(len(hit) + 1, np.int32)
    np.cumsum(hit, dtype=np.int32, out=total[1:])
    within = total[1:].copy()
    within[width:] -= total[1:-width]
    ends = np.flatnonzero((within >= group["bound"]) & (hit > 0))
    if not len(ends):
        return np.zeros((0, 3), np.int64)
    text = np.searchsorted(at, ends, "right") - 1
    cut = (np.diff(ends) > 4 * reach) | (np.diff(text) > 0) | (np.diff(ends // LONGEST) > 0)
    first, last = np.flatnonzero(np.r_[True, cut]), np.flatnonzero(np.r_[cut, True])
    text = text[first]
    start, stop = np.maximum(ends[first] - 2 * reach, at[text]), np.minimum(ends[last] + 2 * reach, at[text + 1])
    return np.stack([text, start, stop], axis=1)


def shared(group: dict, hit: np.ndarray, gram: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, region, number of the q-gram in the class) of the q-grams in regions that segments have."""
    start, n = found[:, 1], np.maximum(found[:, 2] - found[:, 1] - Q + 1, 0)
    at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
    region = np.repeat(np.arange(len(found)), n)
    own = hit[at] > 0
    at, region = at[own], region[own]
    where = np.searchsorted(group["keys"], gram[at])
    where[where == len(group["keys"])] = 0
    own = group["keys"][where] == gram[at]
    return at[own], region[own], where[own]


def candidates(index: Index, group: dict, at: np.ndarray, region: np.ndarray, where: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(region, segment, band) of the bands that hold enough of a segment's q-grams; start: of each region."""
    lo, n = group["first"][where], group["count"][where]
    ends, keys, counts = np.cumsum(n), np.zeros(0, np.int64), np.zeros(0, np.int64)
    k = 0
    while k < len(at):
        stop = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + POSTINGS, "right")))
        m = n[k:stop]
        post = np.repeat(lo[k:stop] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        r, seg = np.repeat(region[k:stop], m), group["seg"][post]
        band = (np.repeat(at[k:stop], m) - start[r] - group["place"][post] + SEGMENT) // (index.e[seg] + 1)
        key = (r * len(index.e) + seg) << 24
        key, count = np.unique(np.concatenate([key | band, (key | (band - 1))[band > 0]]), return_counts=True)
        both, back = np.unique(np.concatenate([keys, key]), return_inverse=True)
        keys, counts = both, np.bincount(back, np.concatenate([counts, count]), len(both)).astype(np.int64)
        k = stop
    seg = (keys >> 24) % len(index.e)
    enough = counts >= index.bound[seg]
    return (keys >> 24)[enough] // len(index.e), seg[enough], (keys & 0xFFFFFF)[enough]


def aligned(segment: np.ndarray, text: np.ndarray, first: int, width: int) -> tuple[int, int]:
    """(edits, end) of the best place of segment in text, on the `width` diagonals from `first` on."""
    n, k, far = len(text), np.arange(width, dtype=np.int32), np.int32(1 << 20)
    j = first + np.arange(len(segment), dtype=np.int32)[:, None] + k  # the text's bytes that each cell would read
    cost = np.where((j >= 0) & (j < n), text[np.clip(j, 0, n - 1)] != segment[:, None], far).astype(np.int32)
    outside = np.where((j < -1) | (j >= n), far, np.int32(0))
    row = np.where((first + k >= 0) & (first + k <= n), np.int32(0), far)
    for i in range(len(segment)):
        step = row + cost[i]
        np.minimum(step[:-1], row[1:] + 1, out=step[:-1])
        step -= k
        np.minimum.accumulate(step, out=step)
        step += k
        row = np.minimum(step + outside[i], far)
    best = int(row.argmin())
    return int(row[best]), first + len(segment) + best


class _Search:
    """What has been found so far in some texts."""

    def __init__(self, index: Index, whole: bool):
        self.index, self.whole = index, whole
        self.found: dict[tuple[int, int], list[int]] = {}
        self.done: dict[int, set[int]] = {}
        self.failed: set[tuple[int, bytes]] = set()
        self.seen: set[tuple[int, bytes]] = set()  # texts and digests of regions: bytes that repeat in a text need no second look

    def add(self, t: int, item: int, edits: int, a: int, z: int) -> None:
        old = self.found.get((t, item))
        self.found[t, item] = [min(edits, old[0]), min(a, old[1]), max(z, old[2]), old[3] + 1] if old else [edits, a, z, 1]

    def verify(self, data: np.ndarray, t: int, start: int, stop: int, s: int, band: int) -> tuple[int, int, int] | None:
        """(edits, first, last) of the segment on a band of the region, places within the data."""
        text, e = self.index.segments[s][2:4]
        low = band * (e + 1) - SEGMENT  # the band's diagonals: from here 2e + 2 on
        base, end = start + max(0, low), min(stop, start + low + 2 * e + 2 + len(text))
        piece = data[base:end].tobytes()
        if (exact := piece.find(text)) >= 0:
            return 0, base + exact, base + exact + len(text)
        if not e:
            return None
        around, pattern = data[start:stop], np.frombuffer(text, np.uint8)
        edits, last = aligned(pattern, around, low - e, 4 * e + 2)
        if edits > e:
            if 0 <= low - e and low + 3 * e + 2 + len(text) + e <= stop - start:  # all that was looked at is in sight
                wide = data[start + low - e : start + low + 3 * e + 2 + len(text) + e].tobytes()
                self.failed.add((s, wide)) if len(self.failed) < 10_000 else None
            return None
        first = max(0, last - aligned(pattern[::-1], around[:last][::-1], -e, 2 * e + 1)[1])
        return edits, start + first, start + last

    def known_to_fail(self, data: np.ndarray, start: int, stop: int, s: int, band: int) -> bool:
        text, e = self.index.segments[s][2:4]
        low = band * (e + 1) - SEGMENT
        if not self.failed or low - e < 0 or low + 3 * e + 2 + len(text) + e > stop - start:
            return False
        return (s, data[start + low - e : start + low + 3 * e + 2 + len(text) + e].tobytes()) in self.failed

    def run(self, data: np.ndarray, at: np.ndarray, base: int, place_of: np.ndarray, begin: np.ndarray) -> None:
        """Looks for all segments in data, which stands `base` bytes from the start of the texts in normal form."""
        index = self.index
        gram = grams(data)
        slot = _slot(gram)
        for group in index.classes if len(gram) else ():
            hit = group["bitmap"][slot]
            for end in at[1:-1]:  # q-grams that reach into the next text
                hit[max(0, end - Q + 1) : end] = 0
            where = regions(hit, at, group)
            names = [hashlib.blake2b(data[a:z], digest_size=16, salt=bytes([group["number"]])).digest() for _, a, z in where.tolist()]
            names = list(zip(where[:, 0].tolist(), names, strict=True))
            where, names = where[np.array([n not in self.seen for n in names], bool)], [n for n in names if n not in self.seen]
            place, region, number = shared(group, hit, gram, where)
            bounds = np.searchsorted(region, np.arange(len(where) + 1))
            total = np.concatenate([[0], np.cumsum(group["count"][number])])[bounds]
            r = 0
            while r < len(where):
                if names[r] in self.seen:
                    r += 1
                    continue
                stop = max(r + 1, int(np.searchsorted(total, total[r] + POSTINGS, "right")) - 1)
                own = slice(bounds[r], bounds[stop])
                texts = np.unique(where[r:stop, 0])
                sub = (place[own], region[own], number[own])
                if len(texts) == 1 and (gone := self.done.get(int(texts[0]))):
                    if not self.whole:
                        r = stop
                        continue
                    open_ = np.ones(len(index.e), bool)
                    open_[list(gone)] = False
                    alive = np.add.reduceat(open_[group["seg"]].astype(np.int64), group["first"]) > 0
                    keep = alive[sub[2]]
                    sub = tuple(c[keep] for c in sub)
                for i, s, b in zip(*(x.tolist() for x in candidates(index, group, *sub, where[:, 1])), strict=True):
                    t, start, end = where[i].tolist()
                    gone = self.done.setdefault(t, set())
                    if s in gone or gone and not self.whole or self.known_to_fail(data, start, end, s, b):
                        continue
                    if got := self.verify(data, t, start, end, s, b):
                        gone.add(s)
                        edits, first, last = got
                        a, z = (int(place_of[base + x]) - int(begin[t]) for x in (first, last - 1))
                        self.add(t, index.segments[s][0], edits, a, z + 1)
                if len(self.seen) < 100_000:
                    self.seen.update(names[r:stop])
                r = stop


def matches(index: Index, data: np.ndarray, at: np.ndarray, whole: bool = True) -> dict[tuple[int, int], list[int]]:
    """By (text, item): [fewest edits, start, stop, segments found]; whole: else one match a text is enough."""
    begin = at
    data, at, place_of = normal(data, at)
    search = _Search(index, whole)
    over = 4 * max((g["reach"] for g in index.classes), default=0)
    if len(data) <= CHUNK + over or len(at) > 2 and not (np.diff(at) > CHUNK).any():
        search.run(data, at, 0, place_of, begin)
    else:  # a stretch of one text at a time
        for t in range(len(at) - 1):
            seen: set[tuple[int, bytes]] = set()
            for a in range(int(at[t]), int(at[t + 1]), CHUNK):
                own = _Search(index, whole)
                own.done, own.failed, own.seen = {0: search.done.setdefault(t, set())}, search.failed, seen
                piece = data[a : min(int(at[t + 1]), a + CHUNK + over)]
                own.run(piece, np.array([0, len(piece)]), a, place_of, begin[t : t + 1])
                for (_, item), (edits, first, last, n) in own.found.items():
                    for _ in range(n):
                        search.add(t, item, edits, first, last)
    for k, text in index.short:
        raw = data.tobytes()
        for t in range(len(at) - 1):
            if (p := raw.find(text, at[t], at[t + 1])) >= 0:
                search.add(t, k, 0, int(place_of[p] - begin[t]), int(place_of[p + len(text) - 1] - begin[t]) + 1)
    return search.found


def _indexes(benchmark: DataFrame, index_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    items = benchmark.select("item_id", "text").where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // index_bytes)
    for k in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect() if parts > 1 else items.collect()
        out = []
        for r in sorted(own):
            raw = np.frombuffer(r[1].encode(), np.uint8)
            out.append((r[0], normal(raw, np.array([0, len(raw)]))[0].tobytes().strip()))
        yield out


def find(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES, shortest: int = Q) -> DataFrame:
    """A row for each document and item found in it: doc_id, item_id, edits, start_byte, end_byte, segments."""
    spark = docs.sparkSession
    bounded_batches(spark)
    kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, edits int, start_byte long, end_byte long, segments int"
    out = None
    for items in _indexes(benchmark, index_bytes):
        sent = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], items=sent) -> Iterator[pa.RecordBatch]:
            index = Index(items.value, shortest)
            for part in in_parts(batches):
                got = matches(index, *utf8(part.column("text")))
                if got:
                    doc = part.column("doc_id").take(pa.array([t for t, _ in got]))
                    item = pa.array([index.ids[i] for _, i in got])
                    cols = [pa.array(c, k) for c, k in zip(zip(*got.values(), strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int32()), strict=True)]
                    yield pa.RecordBatch.from_arrays([doc, item, *cols], ["doc_id", "item_id", "edits", "start_byte", "end_byte", "segments"])

        one = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], schema) if out is None else out


def keep_clean(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES, shortest: int = Q) -> DataFrame:
    """The rows of docs, with all their columns, in which no item is found."""
    spark = docs.sparkSession
    bounded_batches(spark)
    for items in _indexes(benchmark, index_bytes):
        sent = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], items=sent) -> Iterator[pa.RecordBatch]:
            index = Index(items.value, shortest)
            for part in in_parts(batches):
                bad = {t for t, _ in matches(index, *utf8(part.column("text")), whole=False)}
                yield part.filter(pa.array([i not in bad for i in range(part.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
