"""Language identification by prediction by partial matching (PPM).

Every language has a byte context tree of variable order: contexts of up to three bytes, grown where the
learned texts use them most. A context gives a byte its count over (total + distinct), and escapes with
distinct over (total + distinct) to the next shorter context, of which the bytes already seen are excluded;
the last resort is a uniform byte. With the statistics frozen, all code lengths are worked out beforehand, so
a text costs one look-up of its context and one of its code lengths per byte. The language with the shortest
code wins; ties go to the first in code point order.

Learned from about `most` documents and `most_bytes` of each language at most, chosen by hash of id and text.
Languages are kept in tables of up to BESIDE, each with the contexts that its own languages use most, so a tree
doesn't shrink with the number of languages; a table has 4 MB a language. Code lengths are kept to 1/1024 bit.

A null text, or one without a letter, is `und` with score 0; so is everything if there is nothing to learn from.
The score is the posterior of the language, the evidence held to that of EVIDENCE bytes. A null id is not held
out, a null lang not learned from. Rows that repeat get the same result. Texts of any length are read whole.
Other columns don't matter. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, held_out, in_parts, utf8

MOST_DOCS, MOST_BYTES = 3000, 30_000_000
#: More values of lang are an error: what is broadcast has a table for each.
MOST_LANGS = 1000
#: Contexts of a table, and languages in it; a unit of its code lengths.
CONTEXTS, BESIDE, UNIT = 8192, 8, 1024
EVIDENCE = 64
#: Stands before the first byte of a text.
START = 10


def contexts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The three bytes before each byte, as a number; line ends stand before a text."""
    b = data.astype(np.int32)
    out = np.zeros(len(b), np.int32)
    firsts = at[:-1][np.diff(at) > 0]
    for back in (1, 2, 3):
        earlier = np.full(len(b), START, np.int32)
        earlier[back:] = b[:-back]
        for k in range(back):
            # a byte that is the k-th of its text has nothing so far back
            where = firsts + k
            where = where[where < len(b)]
            own = np.searchsorted(at, where, "right") - 1
            earlier[where[at[own] == where - k]] = START
        out |= earlier << (8 * (back - 1))
    return out


def gram_counts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (three bytes before, byte) as 32-bit numbers, and how often each occurs."""
    return np.unique(contexts(data, at).astype(np.int64) << 8 | data, return_counts=True)


class Model:
    def __init__(self, langs: list[str], grams: list[tuple[np.ndarray, np.ndarray]], most: int = CONTEXTS):
        """grams: of each language what gram_counts returns, added up."""
        self.langs = langs
        totals: dict[tuple[int, int], int] = {}
        by_order = []
        for order in range(4):
            mask = (1 << 8 * order) - 1
            rows = []
            for key, count in grams:
                joint = ((key >> 8) & mask) << 8 | (key & 255)
                joint, back = np.unique(joint, return_inverse=True)
                rows.append((joint, np.bincount(back, weights=count, minlength=len(joint))))
                c, back = np.unique(joint >> 8, return_inverse=True)
                part = np.bincount(back, weights=rows[-1][1])
                for x, n in zip(c.tolist(), (part / max(1, part.sum())).tolist(), strict=True):  # a language's contexts by their share
                    totals[order, x] = totals.get((order, x), 0) + n
            by_order.append(rows)
        totals[0, 0] = totals.get((0, 0), 0) + 1
        chosen = sorted(totals, key=lambda k: (k[0] > 0, -totals[k], k))[:most]
        self.nodes = sorted(chosen)  # by order: parents come first
        number = {k: i for i, k in enumerate(self.nodes)}
        parent = np.array([number[o - 1, x & ((1 << 8 * (o - 1)) - 1)] if o else 0 for o, x in self.nodes])
        order_of = np.array([o for o, _ in self.nodes])
        self.bits = np.zeros((len(self.nodes) * 256, max(1, len(langs))), np.uint16)
        for k in range(len(langs)):
            count = np.zeros((len(self.nodes), 256))
            for order in range(4):
                joint, n = by_order[order][k]
                node = np.array([number.get((order, x), -1) for x in (joint >> 8).tolist()], np.int64)
                count[node[node >= 0], (joint & 255)[node >= 0]] = n[node >= 0]
            p = np.full((len(self.nodes), 256), 1 / 256)
            for order in range(4):
                at = np.flatnonzero(order_of == order)
                if not len(at):
                    continue
                c, below = count[at], p[parent[at]] if order else np.full((1, 256), 1 / 256)
                total, distinct, seen = c.sum(1, keepdims=True), (c > 0).sum(1, keepdims=True), c > 0
                free = 1 - (below * seen).sum(1, keepdims=True)
                with np.errstate(divide="ignore", invalid="ignore"):
                    escaped = distinct / (total + distinct) * below / free
                    full = distinct == 256  # nothing to escape to
                    mine = np.where(seen, c / np.where(full, total, total + distinct), escaped)
                p[at] = np.where(total > 0, mine, below)
            self.bits[:, k] = np.round(-np.log2(np.maximum(p, 1e-12)) * UNIT).ravel()

    def longest(self) -> np.ndarray:
        """By the three bytes before, the number of the longest context that the tree has."""
        out = np.zeros((256, 256, 256), np.int16)
        for i, (order, x) in enumerate(self.nodes):
            a, b, c = x >> 16 & 255, x >> 8 & 255, x & 255
            if order == 1:
                out[:, :, c] = i
            elif order == 2:
                out[:, b, c] = i
            elif order == 3:
                out[a, b, c] = i
        return out.ravel()

    def code_lengths(self, longest: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(texts, languages): bits of each text under each language."""
        out = np.zeros((len(at) - 1, self.bits.shape[1]))
        if len(data) and len(at) > 1:
            row = longest[contexts(data, at)].astype(np.int32) * np.int32(256) + data
            filled = np.flatnonzero(np.diff(at) > 0)
            out[filled] = np.add.reduceat(self.bits[row], at[filled], axis=0, dtype=np.int64) / UNIT
        return out


def tables(langs: list[str], grams: list[tuple[np.ndarray, np.ndarray]], contexts_most: int = CONTEXTS) -> list[dict]:
    """Plain parts of the models of up to BESIDE languages each."""
    out = []
    for k in range(0, len(langs), BESIDE):
        model = Model(langs[k : k + BESIDE], grams[k : k + BESIDE], contexts_most)
        out.append({"langs": model.langs, "nodes": model.nodes, "bits": model.bits})
    return out


def train(docs: DataFrame, most: int = MOST_DOCS, contexts_most: int = CONTEXTS, most_bytes: int = MOST_BYTES) -> list[dict]:
    """docs: doc_id, text, lang of those to learn from."""
    bounded_batches(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).limit(MOST_LANGS + 1).collect()
    if len(counts) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    if not counts:
        return []
    rate = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], min(1.0, most / r["n"], most_bytes / max(1, r["bytes"])))))
    unit = F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1_000_003)) / 1_000_003
    sample = known.where(unit < rate[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_parts(batches):
            lang = part.column("lang").to_numpy(zero_copy_only=False)
            for x in sorted(set(lang)):
                key, n = gram_counts(*utf8(part.column("text").filter(pa.array(lang == x))))
                yield pa.RecordBatch.from_arrays([pa.array([x] * len(key), pa.string()), pa.array(key), pa.array(n)], ["lang", "gram", "n"])

    got: pd.DataFrame = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    grams = [(g["gram"].to_numpy(), g["n"].to_numpy()) for g in (got[got["lang"] == x].sort_values("gram") for x in langs)]
    return tables(langs, grams, contexts_most)


def predict(docs: DataFrame, model: list[dict]) -> DataFrame:
    """doc_id, lang_pred, score of docs with doc_id and text."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    types = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double"
    docs = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = []
        for part in shared.value:
            trees.append(Model.__new__(Model))
            vars(trees[-1]).update(part)
        longest = [tree.longest() for tree in trees]
        names = np.array([*(x for tree in trees for x in tree.langs), "und"], dtype=object)
        for part in in_parts(batches):
            data, at = utf8(part.column("text"))
            letters = part.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            best, score = np.full(part.num_rows, len(names) - 1), np.zeros(part.num_rows)
            if trees:
                bits = np.concatenate([tree.code_lengths(own, data, at) for tree, own in zip(trees, longest, strict=True)], axis=1)
                n = np.maximum(np.diff(at), 1)[:, None]
                logit = -np.log(2) * (bits - bits.min(1, keepdims=True)) * np.minimum(1, EVIDENCE / n)
                p = np.exp(logit) / np.exp(logit).sum(1, keepdims=True)
                best = np.where(letters, bits.argmin(1), best)
                score = np.where(letters, p.max(1), 0.0)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.mapInArrow(run, types)


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs, learned from its rows that aren't held out."""
    held = held_out("doc_id", 4)
    model = train(docs.select("doc_id", "text", "lang").where(~held), **options)
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
