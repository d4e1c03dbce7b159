"""SimHash near-duplicates: fingerprints within a few bits, found with vantage-point trees.

Fingerprint: of the lower-cased words' shingles, repeats included, bit i is 1 if more than half of the 64-bit
XXH64 values (seed 42) have it. It is cut into CHUNKS chunks, each with a radius, and the radii add up to
`most - CHUNKS + 1`: two fingerprints within `most` bits are within the radius on one chunk at least, as they would
differ in more bits otherwise. With 4 bits and 4 chunks the first chunk has radius 1, the others 0. For each chunk a
vantage-point tree, built from a bounded sample of chunk values, divides all distinct fingerprints into shards by
their chunk's distance from vantage points; the triangle bound says which other shards a fingerprint's ball can
reach, and it queries those too. A ball of radius 0 is a point, which only its own shard can hold. A shard compares
whole fingerprints in a vantage-point tree of its own, exactly.

Shards of more than DEEP * BLOCK fingerprints are dealt once more: where a chunk agrees, the other bits differ in
`most` places at most, so one of `most + 1` parts of them agrees too, and so on up to LEVELS times; where it is only
near, no bits are known to agree yet. The key so gets longer as the corpus grows. What still is over BLOCK is cut
into blocks, and each pair of blocks is searched.
A shard gives links that connect what it found connected, not all pairs, so dense groups stay linear.

Empty and null texts have fingerprint zero and are linked like any other. Equal fingerprints are one class.
A component's id is its least doc_id; a null doc_id counts only if the component has no other. Rows that repeat
are of one component. Texts of any length are read whole. Other columns don't matter, whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, first_by_hash, whole_row, words_of, written
from .components import components

SEED, BITS = 42, 64
CHUNKS, SAMPLE, BLOCK, LEAF = 4, 20_000, 8192, 48  # chunks of at most 16 bits
DEEP, LEVELS = 16, 3
#: Lists of full shards up to this length are broadcast.
BROADCAST_SHARDS = 100_000


def shingle_hashes(text: str | None, width: int = 4) -> np.ndarray:
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    joined, ends = b" ".join(words), []
    end = -1
    for w in words:
        end += len(w) + 1
        ends.append(end)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    starts = [0, *(e + 1 for e in ends)]
    return np.array([digest(view[s:e], SEED) for s, e in zip(starts, ends[width - 1 :], strict=False)], np.uint64)


def fingerprint(text: str | None, width: int = 4) -> int:
    h = shingle_hashes(text, width)
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 8192):
        ones += np.unpackbits(h[k : k + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 4, more: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and the columns `more`."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), width) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp, pa.int64()), *(batch.column(c) for c in more)], ["doc_id", "fp", *more])

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", *more)]
    return docs.select("doc_id", "text", *more).mapInArrow(run, ", ".join([kinds[0], "fp long", *kinds[1:]]))


class VantageTree:
    """Splits distinct values by their distance from vantage points, at the median of each node's sample."""

    def __init__(self, values: np.ndarray, leaf: int, deepest: int = 40, seed: int = 1):
        self.vantage: list[np.uint64] = []
        self.radius: list[int] = []
        self.below: list[list[int]] = []  # near, far; leaves are negative
        self.members: list[np.ndarray] = []
        self.rng = np.random.default_rng(seed)
        self.root = self._grow(np.asarray(values, np.uint64), np.arange(len(values)), leaf, deepest)

    def _leaf(self, rows: np.ndarray) -> int:
        self.members.append(rows)
        return -len(self.members)

    def _grow(self, values: np.ndarray, rows: np.ndarray, leaf: int, deepest: int) -> int:
        if len(rows) <= leaf or not deepest:
            return self._leaf(rows)
        v = values[rows[self.rng.integers(len(rows))]]
        d = np.bitwise_count(values[rows] ^ v)
        radius = int(np.median(d))
        near = d <= radius
        if near.all():
            radius = int(d.max()) - 1
            near = d <= radius
        if not near.any() or near.all():
            return self._leaf(rows)
        k = len(self.vantage)
        self.vantage.append(v)
        self.radius.append(radius)
        self.below.append([0, 0])
        self.below[k][0] = self._grow(values, rows[near], leaf, deepest - 1)
        self.below[k][1] = self._grow(values, rows[~near], leaf, deepest - 1)
        return k

    def reached(self, queries: np.ndarray, reach: int) -> list[tuple[int, np.ndarray]]:
        """(leaf, rows of queries whose ball of radius `reach` can meet it); reach 0 gives each its own leaf."""
        out, stack = [], [(self.root, np.arange(len(queries)))]
        while stack:
            node, rows = stack.pop()
            if node < 0:
                if len(rows):
                    out.append((-node - 1, rows))
                continue
            d = np.bitwise_count(queries[rows] ^ self.vantage[node]).astype(np.int16)
            stack.append((self.below[node][0], rows[d <= self.radius[node] + reach]))
            stack.append((self.below[node][1], rows[d > self.radius[node] - reach]))
        return out

    def routes(self, bits: int, reach: int, step: int = 8192) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By each value of `bits` bits, where its leaves start; the leaves that its ball meets; which of them is its own.

        The bounds give leaves that a ball may meet; of those, leaves stay that hold a value of the ball. Values are
        taken in slices, as the bounds leave many leaves and all this is the driver's.
        """
        values, leaves = np.arange(1 << bits, dtype=np.uint64), len(self.members)
        own = np.zeros(len(values), np.int64)
        for leaf, rows in self.reached(values, 0):
            own[rows] = leaf
        if not reach:
            return np.arange(len(values) + 1), own, np.ones(len(own), bool)
        near = np.unique(values.astype(np.int64) * leaves + own)
        for _ in range(reach):
            v, x = np.divmod(near, leaves)
            near = np.unique(np.concatenate([near, *((v ^ (1 << b)) * leaves + x for b in range(bits))]))
        kept = []
        for start in range(0, len(values), step):
            met = self.reached(values[start : start + step], reach)
            key = np.concatenate([(start + rows) * leaves + leaf for leaf, rows in met])
            key.sort()
            low, high = np.searchsorted(near, [start * leaves, (start + step) * leaves])
            kept.append(key[np.isin(key, near[low:high], assume_unique=True)])
        value, leaf = np.divmod(np.concatenate(kept), leaves)
        return np.searchsorted(value, np.arange(len(values) + 1)), leaf, leaf == own[value]


def forest(values: np.ndarray, most: int, home: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of row numbers that connect all values within `most` bits of each other, fewer than values.

    home: only pairs with a row of which home is true are looked for.
    """
    root, a, b = np.arange(len(values)), [], []

    def connect(mine: np.ndarray, members: np.ndarray) -> None:
        # a member's own row may be in another slice of `mine`, so it never counts as near
        near = (np.bitwise_count(values[mine][:, None] ^ values[members][None, :]) <= most) & (mine[:, None] != members[None, :])
        for k in np.flatnonzero(near.any(axis=0)).tolist():
            own = np.append(mine[near[:, k]], members[k])
            while (root[own] != own).any():
                own = root[own]
            own = np.unique(own)
            if len(own) > 1:
                root[own[1:]] = own[0]
                a.append(np.full(len(own) - 1, own[0]))
                b.append(own[1:])

    asked = np.arange(len(values)) if home is None else np.flatnonzero(home)
    if len(values) <= LEAF:
        connect(asked, np.arange(len(values)))
    else:
        tree = VantageTree(values, LEAF)
        for leaf, rows in tree.reached(values[asked], most):
            for k in range(0, len(rows), 4096):
                connect(asked[rows[k : k + 4096]], tree.members[leaf])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(a or none), np.concatenate(b or none)


def _bits(first: int, last: int) -> int:
    return (1 << last) - (1 << first)


def _parts(mask: int, parts: int) -> list[int]:
    """The bits that a mask leaves, in `parts` masks."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    return [sum(1 << int(i) for i in own) for own in np.array_split(free, parts) if len(own)]


def radii(most: int, chunks: int) -> list[int]:
    """By chunk, how near two fingerprints within `most` bits are on one chunk at least."""
    each, more = divmod(max(0, most - chunks + 1), chunks)
    return [each + (k < more) for k in range(chunks)]


def _shards(distinct: DataFrame, most: int, chunks: int, sample: int) -> DataFrame:
    """shard, fp, home (whether the shard is the fingerprint's own), mask (bits that agree, where a ball is a point)."""
    reach, edges = radii(most, chunks), np.linspace(0, BITS, chunks + 1).astype(int).tolist()
    if -(-BITS // chunks) > 16:
        raise ValueError("chunks must have at most 16 bits")
    some = first_by_hash(distinct.withColumn("h", F.xxhash64("fp")), "h", sample).select("fp").toArrow()["fp"].to_numpy().view(np.uint64)
    cut = lambda v, k: (v >> np.uint64(edges[k])) & np.uint64(_bits(0, edges[k + 1] - edges[k]))
    routes = distinct.sparkSession.sparkContext.broadcast([VantageTree(np.unique(cut(some, k)), 2, seed=k).routes(edges[k + 1] - edges[k], reach[k]) for k in range(chunks)])
    masks = np.array([0 if near else _bits(a, z) for a, z, near in zip(edges, edges[1:], reach, strict=False)], np.uint64).view(np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            for k, (first, leaf, home) in enumerate(routes.value):
                value = cut(fp.view(np.uint64), k).astype(np.int64)
                n = first[value + 1] - first[value]
                at = np.repeat(first[value] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                yield pa.RecordBatch.from_arrays([pa.array(k * 10_000_000 + leaf[at]), pa.array(np.repeat(fp, n)), pa.array(home[at]), pa.array(np.full(len(at), masks[k]))], ["shard", "fp", "home", "mask"])

    return distinct.mapInArrow(deal, "shard long, fp long, home boolean, mask long")


def _deeper(rows: DataFrame, most: int) -> DataFrame:
    """Rows of full shards, dealt by a part of the bits that aren't known to agree."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, mask = batch.column("fp").to_numpy(), batch.column("mask").to_numpy()
            for m in np.unique(mask):
                own = fp[mask == m]
                for part in _parts(int(m) & _bits(0, BITS), most + 1):
                    both = np.array([int(m) & _bits(0, BITS) | part], np.uint64).view(np.int64)[0]
                    yield pa.RecordBatch.from_arrays([pa.array(own & both), pa.array(own), pa.array(np.ones(len(own), bool)), pa.array(np.full(len(own), both))], ["value", "fp", "home", "mask"])

    return rows.select("fp", "mask").mapInArrow(deal, "value long, fp long, home boolean, mask long").select(F.xxhash64("mask", "value").alias("shard"), "fp", "home", "mask").distinct()


def links(distinct: DataFrame, most: int = 4, chunks: int = CHUNKS, block: int = BLOCK, sample: int = SAMPLE, deep: int = DEEP) -> DataFrame:
    """u, v that connect the fingerprints (column fp, distinct) within `most` bits of each other."""
    dealt, ready = written(_shards(distinct, most, chunks, sample), "shards"), []
    for _ in range(LEVELS):
        full = written(dealt.groupBy("shard").count().where(F.col("count") > deep * block).select("shard"), "full-shards")
        if not (n := full.count()):
            break
        full = F.broadcast(full) if n <= BROADCAST_SHARDS else full
        ready.append(dealt.join(full, "shard", "left_anti"))
        dealt = written(_deeper(dealt.join(full, "shard", "left_semi"), most), "shards")
    for other in ready:
        dealt = dealt.unionByName(other)
    # full shards are cut into blocks; a block meets itself and each later one
    sizes = written(dealt.groupBy("shard").count().where(F.col("count") > block).select("shard", F.ceil(F.col("count") / block).cast("int").alias("parts")), "full-shards")
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_SHARDS else sizes
    dealt = dealt.join(sizes, "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(9)), F.col("parts")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j")))
    dealt = dealt.select("shard", "fp", "home", F.explode(others).alias("pair"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard and pair; a group may go on in the next batch."""

        def found(fp: list[np.ndarray], home: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            values = np.concatenate(fp)
            if len(values) > 1:
                a, b = forest(values.view(np.uint64), most, np.concatenate(home))
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(values[a]), pa.array(values[b])], ["u", "v"])

        key, fp, home = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "i", "j")]).astype(np.int64)
            values, homes = batch.column("fp").to_numpy(), batch.column("home").to_numpy(zero_copy_only=False).astype(bool)
            starts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for s, e in zip(starts, starts[1:], strict=False):
                now = tuple(keys[:, s].tolist())
                if now != key and fp:
                    yield from found(fp, home)
                    fp, home = [], []
                key = now
                fp.append(values[s:e])
                home.append(homes[s:e])
        if fp:
            yield from found(fp, home)

    dealt = dealt.select("shard", "fp", "home", "pair.i", "pair.j").repartition("shard", "i", "j").sortWithinPartitions("shard", "i", "j")
    return dealt.mapInArrow(search, "u long, v long").distinct()


def _rooted(rows: DataFrame, least: Column, most: int, **options) -> DataFrame:
    """fp, least (of its rows) and root (the least fp of its component) for every fp of rows."""
    classes = written(rows.groupBy("fp").agg(F.min(least).alias("least")), "classes")
    root = components(links(classes.select("fp"), most, **options)).withColumnRenamed("u", "fp")
    return classes.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, width: int = 4, most: int = 4, **options) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id for every row of docs."""
    docs = written(fingerprints(docs, width), "fingerprints")
    classes = _rooted(docs, F.col("doc_id"), most, **options)
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "root").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return docs.join(classes, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 4, most: int = 4, **options) -> DataFrame:
    """One row of each component, with all its columns: the least id, of equal ids the least digest of the text.

    A row is known by its id, its text and its other columns (but for maps, which have no order), so rows that share
    an id but not a component don't touch each other. Of rows that are alike in all that one stays; a null id stays
    only where its component has no other.
    """
    plain = [F.col(f"`{f.name}`") for f in docs.schema if f.name not in ("doc_id", "text") and "map<" not in f.dataType.simpleString()]
    marked = docs.select(whole_row(docs).alias("row"), "doc_id", "text", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), F.xxhash64(F.col("text").isNull(), *plain).alias("rest"))
    rows = written(fingerprints(marked, width, ("digest", "rest")), "fingerprints")
    key = ["doc_id", "digest", "rest"]
    first = F.struct(F.col("doc_id").isNull().alias("none"), *key)
    stays = _rooted(rows, first, most, **options).groupBy("root").agg(F.min("least").alias("row")).select(*(F.col(f"row.{k}").alias(f"its_{k}") for k in key))
    same = F.col("doc_id").eqNullSafe(F.col("its_doc_id")) & (F.col("digest") == F.col("its_digest")) & (F.col("rest") == F.col("its_rest"))
    out = marked.join(stays, same, "left_semi")
    again = rows.groupBy(*key).count().where(F.col("count") > 1).select(*(F.col(k).alias(f"its_{k}") for k in key))
    again = written(again, "repeated-rows")
    if not again.isEmpty():
        out = out.join(again, same, "left_anti").unionByName(out.join(again, same, "left_semi").dropDuplicates(key))
    return out.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
