"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is put in the order of a seeded hash of its rows (id and text), which cuts it into equal permuted
blocks. A source whose target is t = r * size + rest is drawn r times in full, and `rest` words more from the
front of its order, to the word: the row where they end gives its first words only. Where that is known, so are
the exact numbers of blocks that each source gives, and these are dealt to output shards by a tree: each node
holds the exact number of blocks of each source, and its left half gets a multivariate hypergeometric draw of
them. A shard's blocks are consecutive places in the permuted draws of a source, so shards are disjoint and
hold just as many blocks of each source as their leaf of the tree says; within a shard rows are ordered by hash.

What a row gives depends on the row and on a few numbers of its source alone, so the mix is read off in one pass
over the documents, without a join of texts.

Nulls: a null source is a source of its own (last), unlike an empty one; a null id is unlike an empty one; a null
text has size 0 and isn't drawn. Rows that repeat an id are rows of their own. Rows that repeat id and text stand
at one place; if the words end there they share them equally, the remainder of that division is not taken. Texts
of any length are drawn like others; a very long one may end a source's draw in its middle. There are no other
ties. Other columns pass through, but for the four that `mix` adds. An empty table gives an empty mix. Kept on
the driver: some numbers of each source, and one for each source and shard.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import WORD, bounded_batches, release, whole_row, written

#: Blocks of a source; the one where its draw ends is cut once more into as many parts.
BLOCKS = 1024
#: Plans of more sources than that are joined, a source in so many parts, instead of broadcast.
BROADCAST_SOURCES, SALTS = 10_000, 16
WEIGHTS = (5, 2, 1)


def water_fill(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of total by weight; none above `most` times its size, the excess reshared by weight."""
    target, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while free:
        whole = sum(weights[i] for i in sorted(free))
        over = [i for i in sorted(free) if left * weights[i] / whole > most * sizes[i]] if whole else []
        if not over:
            for i in free:
                target[i] = left * weights[i] / whole if whole else 0.0
            break
        for i in over:
            target[i] = float(most * sizes[i])
            free.discard(i)
        left = max(0.0, left - sum(target[i] for i in over))
    return target


def splitting_tree(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """(shards, sources): blocks of each source in each shard; columns add up to the quotas."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(held: np.ndarray, first: int, last: int) -> None:
        if last - first == 1:
            out[first] = held
            return
        middle = (first + last) // 2
        total = int(held.sum())
        take = total * (middle - first) // (last - first)
        rng = np.random.default_rng([seed, first, last])
        left = rng.multivariate_hypergeometric(held, take, method="marginals") if total else np.zeros_like(held)
        split(left, first, middle)
        split(held - left, middle, last)

    if len(quotas) and shards:
        split(np.asarray(quotas, np.int64), 0, shards)
    return out


def _hash(docs: DataFrame, seed: int) -> Column:
    """64 bits that place a row within its source; rows of one id and text have one place."""
    return F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")))


def _size(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _digit(level: int, bits: int) -> Column:
    """The digits of a hash, from the front, in the order of the signed number."""
    front = F.shiftright("h", 64 - bits) + (1 << (bits - 1))
    return (front if not level else F.shiftright("h", 64 - 2 * bits).bitwiseAND(F.lit((1 << bits) - 1))).cast("int")


def _with_source(rows: DataFrame, plan: DataFrame, sources: int, source: str = "source") -> DataFrame:
    """rows with the columns of plan, which has a row for each source (as _s)."""
    if sources <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(plan), _same(source, "_s")).drop("_s")
    # too many to broadcast: a hot source's rows are dealt to several tasks, each with its own copy of the plan's row
    salted = rows.withColumn("_salt", F.pmod(F.col("h"), F.lit(SALTS)).cast("int"))
    plan = plan.withColumn("_salt2", F.explode(F.array(*(F.lit(k) for k in range(SALTS)))))
    return salted.join(plan, _same(source, "_s") & (F.col("_salt") == F.col("_salt2"))).drop("_s", "_salt", "_salt2")


def _boundary(cells: DataFrame, place: str, left: str) -> DataFrame:
    """Of each source, the cell in whose words the `left` first ones end; before: words ahead of it."""
    before = F.sum("words").over(Window.partitionBy("source").orderBy(place)) - F.col("words")
    cells = cells.withColumn("before", before)
    return cells.where((F.col("before") < F.col(left)) & (F.col("before") + F.col("words") >= F.col(left)))


def source_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, most: float = 3.0, shards: int = 64, blocks: int = BLOCKS, seed: int = 7) -> tuple[DataFrame, int]:
    """(_s, source_size, target, whole, cut, left, copies, ends of each source; how many sources).

    cut: the place where the last pass ends, left: the words that it takes there, copies: rows that stand there;
    ends: for each shard, how many of the source's blocks it and those before it hold.
    """
    spark, bits = docs.sparkSession, blocks.bit_length() - 1
    if blocks != 1 << bits or not bits:
        raise ValueError("blocks must be a power of two")
    meta = written(docs.select("source", _size().alias("size"), _hash(docs, seed).alias("h")), "mix-sizes")
    by_block = written(meta.groupBy("source", _digit(0, bits).alias("b0")).agg(F.sum("size").alias("words")), "mix-blocks")
    totals = by_block.groupBy("source").agg(F.sum("words").alias("words")).toArrow().to_pylist()
    totals = sorted(((r["source"], int(r["words"])) for r in totals), key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [n for _, n in totals]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(totals))], share * sum(sizes), most)

    rows = []
    for (source, n), target in zip(totals, targets, strict=True):
        whole, rest = divmod(round(target), n) if n else (0, 0)
        rows.append((source, n, float(target), int(whole), int(rest)))
    rests = spark.createDataFrame([(r[0], r[4]) for r in rows], "_s string, rest long")

    # where the rest of each source ends: block, then part of it, then place
    first = _boundary(_with_source(by_block.withColumn("h", F.xxhash64("b0")), rests, len(rows)), "b0", "rest").select(F.col("source").alias("_s"), F.col("b0").alias("cut0"), (F.col("rest") - F.col("before")).alias("left0"))
    first = written(first, "mix-cuts", 1)
    inside = _with_source(meta, first, len(rows)).where(_digit(0, bits) == F.col("cut0"))
    parts = inside.groupBy("source", _digit(1, bits).alias("b1"), "cut0", "left0").agg(F.sum("size").alias("words"))
    second = _boundary(parts, "b1", "left0").select(F.col("source").alias("_s"), "cut0", F.col("b1").alias("cut1"), (F.col("left0") - F.col("before")).alias("left1"))
    second = written(second, "mix-cuts", 1)
    inside = _with_source(meta, second, len(rows)).where((_digit(0, bits) == F.col("cut0")) & (_digit(1, bits) == F.col("cut1")))
    places = inside.groupBy("source", "h", "cut0", "left1").agg(F.sum("size").alias("words"), F.count("*").alias("copies"))
    third = _boundary(places, "h", "left1").select("source", "cut0", F.col("h").alias("cut"), (F.col("left1") - F.col("before")).alias("left"), "copies")
    cuts = {r["source"]: r for r in third.toArrow().to_pylist()}
    release(meta, by_block, first, second)

    # the blocks that are really drawn, the last one partly, are what the tree deals out
    quotas = [r[3] * blocks + (cuts[r[0]]["cut0"] + 1 if r[0] in cuts else 0) for r in rows]
    ends = splitting_tree(quotas, shards, seed).cumsum(axis=0)
    none = {"cut": None, "left": 0, "copies": 1}
    out = [(*r[:4], *(cuts.get(r[0], none)[k] for k in ("cut", "left", "copies")), ends[:, i].tolist()) for i, r in enumerate(rows)]
    return spark.createDataFrame(out, "_s string, source_size long, target double, whole int, cut long, left long, copies long, ends array<long>"), len(out)


def _draws(blocks: int, shards: int, seed: int) -> Column:
    """What a row with size, h and its source's plan gives: array of pass, shard, block (its place), words."""
    bits, n_blocks = blocks.bit_length() - 1, F.lit(blocks)
    at_end = F.least(F.col("size"), F.floor(F.col("left") / F.col("copies")).cast("long"))
    partly = F.when(F.col("h") < F.col("cut"), F.col("size")).when(F.col("h") == F.col("cut"), at_end).otherwise(F.lit(0)).cast("long")
    passes = F.transform(F.sequence(F.lit(0), F.col("whole")), lambda k: F.struct(k.alias("pass"), F.when(k < F.col("whole"), F.col("size")).otherwise(partly).alias("words")))
    passes = F.filter(passes, lambda d: d["words"] > 0)
    # a pass deals its blocks in an order of its own; in the last the blocks in front come first
    b0 = _digit(0, bits)
    turn = lambda k: F.pmod(b0 * (2 * k + 1) + F.pmod(F.hash(k, F.lit(seed)), n_blocks), n_blocks)
    place = lambda d: d["pass"].cast("long") * n_blocks + F.when(d["pass"] < F.col("whole"), turn(d["pass"])).otherwise(b0)
    shard = lambda d: F.size(F.filter(F.col("ends"), lambda e: e <= place(d)))
    return F.transform(passes, lambda d: F.struct(d["pass"].alias("pass"), shard(d).alias("shard"), place(d).alias("block"), d["words"].alias("words")))


def plan_mix(docs: DataFrame, shards: int = 64, blocks: int = BLOCKS, seed: int = 7, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, draws (array of pass, shard, block, words)."""
    plan, n = source_plan(docs, shards=shards, blocks=blocks, seed=seed, **options)
    rows = docs.select("doc_id", "source", _size().alias("size"), _hash(docs, seed).alias("h"))
    rows = _with_source(rows, plan, n).withColumn("draws", _draws(blocks, shards, seed))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "draws")


def _first_words(text: str, n: int) -> str:
    end = 0
    for k, m in enumerate(re.finditer(WORD, text)):
        if k == n:
            break
        end = m.end()
    return text[:end]


def mix(docs: DataFrame, shards: int = 64, blocks: int = BLOCKS, seed: int = 7, **options) -> DataFrame:
    """The mix itself: a row for each draw of a document, with all its columns and mix_shard, mix_pass,
    mix_order (ascending within a shard) and mix_words. A part of a document is its first mix_words words."""
    plan, n = source_plan(docs, shards=shards, blocks=blocks, seed=seed, **options)
    own = ("mix_shard", "mix_pass", "mix_order", "mix_words")
    names = [c for c in docs.columns if c not in own]
    rows = docs.select(whole_row(docs).alias("row"), "source", _size().alias("size"), _hash(docs, seed).alias("h"))
    rows = _with_source(rows, plan, n).select("row", "size", "h", F.explode(_draws(blocks, shards, seed)).alias("draw"))
    more = [F.col("draw.shard"), F.col("draw.pass"), F.xxhash64("h", "draw.shard", "draw.pass"), F.col("draw.words")]
    kept = [F.col("row").getField(c).alias(c) for c in names]
    rows = rows.select(*kept, *(c.alias(k) for c, k in zip(more, own, strict=True)), (F.col("draw.words") < F.col("size")).alias("part of " + "".join(names)))
    bounded_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, part = batch.columns[:-1], batch.columns[-1].to_numpy(zero_copy_only=False)
            if part.any():
                at = names.index("text")
                texts, words = columns[at].to_pylist(), columns[-1].to_pylist()
                columns[at] = pa.array([_first_words(t, n) if p else t for t, n, p in zip(texts, words, part, strict=True)], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, [*names, *own])

    return rows.mapInArrow(cut, StructType(rows.schema.fields[:-1]))
