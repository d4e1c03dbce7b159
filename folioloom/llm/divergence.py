"""Source divergence audit: how the words of each source of a language differ from its other sources and from all.

Terms are runs of letters and of whatever isn't ASCII, A-Z lower-cased. A language keeps the terms of at least `least`
of its documents. In a group (language and source) as in the whole language a kept term has the smoothed probability
p = 1 + floor(scale * (count + add) / (N + add * V)), an integer; V is the number of kept terms, N their occurrences.

Part `pair` gives, for each group and other source of its language, the sum of |p - p'| over all kept terms. Each term's
postings, which are the sources that have it, give what the terms that two sources share add to it; the terms that
one of the two lacks come from the group's counts, of which there are few different ones.

Part `term` gives, for each group, the `most` kept terms that exceed the language's probability q by most. Terms of one
count in a group are a bucket, in which p - q is at most p minus the least q. The buckets of highest bounds are looked
at first, till they hold `most` terms; then those of which the bound isn't below the least difference that counts by
then. Only their terms are ranked.

Null texts, languages and sources are read as ''. Rows that repeat count each. Groups without a kept term have pairs,
and with V = 0 all values are 0. Ties are ordered by the item's UTF-8. An empty table gives an empty result. Texts of any
length are read whole. Numbers are exact at any count: products are decimals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, in_parts, utf8, written

#: Bytes of terms, A-Z in lower case; others are 0.
TERM_BYTES = np.zeros(256, np.uint8)
TERM_BYTES[0x80:] = np.arange(0x80, 0x100)
TERM_BYTES[0x41:0x5B] = TERM_BYTES[0x61:0x7B] = np.arange(0x61, 0x7B)

#: Tables of groups and buckets of up to so many rows, with names of up to so many bytes in all, are broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 30_000_000
#: Pairs of sources that the postings of some terms make, before they are summed.
PAIRS_AT_ONCE = 2_000_000


def terms_of(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(all terms, the text of each), in order."""
    low = TERM_BYTES[data]
    inside = low != 0
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    begins = at[:-1][at[:-1] < at[1:]]
    starts[begins] = inside[begins]
    first = np.flatnonzero(starts)
    kept = np.cumsum(inside, dtype=np.int64)
    offsets = np.append(kept[first] - 1, kept[-1] if len(kept) else 0)
    terms = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(low[inside])])
    return terms, np.searchsorted(at, first, "right") - 1


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """lang, source, term, n, docs of the texts of a batch."""
    terms, text = terms_of(*utf8(batch.column("text")))
    terms = terms.dictionary_encode()
    lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    term, size = terms.indices.to_numpy().astype(np.int64), max(1, len(terms.dictionary))
    each, n = np.unique(text * size + term, return_counts=True)  # by document first, then by group
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    key, back = np.unique(group[each // size] * size + each % size, return_inverse=True)
    total = np.bincount(back, weights=n, minlength=len(key)).astype(np.int64)
    docs = np.bincount(back, minlength=len(key)).astype(np.int64)
    of_lang, of_source = (d.dictionary.take(pa.array(k)) for d, k in ((lang, key // size // len(source.dictionary)), (source, key // size % len(source.dictionary))))
    return pa.RecordBatch.from_arrays([of_lang, of_source, terms.dictionary.take(pa.array(key % size)).cast(pa.binary()).cast(pa.string()), pa.array(total), pa.array(docs)], names=["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        yield _counted(batch)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that have it)."""
    bounded_batches(docs.sparkSession)
    read = docs.select(_name("lang"), _name("source"), F.coalesce("text", F.lit("")).alias("text"))
    found = read.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _name(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(column)


def _p(count: str, total: str, v: str, add: int, scale: int) -> Column:
    """1 + floor(scale * (count + add) / (total + add * v)), 0 where nothing is kept."""
    wide = f"CAST({count} + {add} AS DECIMAL(20, 0)) * CAST({scale} AS DECIMAL(10, 0))"
    return F.expr(f"CASE WHEN {v} = 0 THEN 0L ELSE 1 + ({wide}) DIV CAST({total} + {add} * {v} AS DECIMAL(20, 0)) END")


def _small(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if its size allows that."""
    rows, size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length("lang") + F.octet_length("source"))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else df


def _pairs_of_shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, a, b, value of postings: what the terms that two sources share add to what their own counts give."""
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        lang = langs.indices.to_numpy().astype(np.int64)
        lists = batch.column("postings")
        inner, at = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        at = at - at[0]
        who, p, z = (inner.field(k).to_numpy() for k in ("place", "p", "z"))
        size, found = np.diff(at), {}
        for m in np.unique(size[size > 1]):
            rows = np.flatnonzero(size == m)
            one, two = np.triu_indices(m, 1)
            for k in range(0, len(rows), most := max(1, PAIRS_AT_ONCE // len(one))):
                some = rows[k : k + most]
                index = at[some][:, None] + np.arange(m)
                w, pp, zz = who[index], p[index], z[index]
                (pa_, pb), (za, zb) = (pp[:, one], pp[:, two]), (zz[:, one], zz[:, two])
                value = np.abs(pa_ - pb) - np.abs(pa_ - zb) - np.abs(za - pb) + np.abs(za - zb)
                key = np.stack([np.repeat(lang[some], len(one)), w[:, one].ravel(), w[:, two].ravel()])
                order = np.lexsort(key[::-1])
                key, value = key[:, order], value.ravel()[order]
                new = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
                for g, a, b, v in zip(*key[:, new].tolist(), np.add.reduceat(value, new).tolist(), strict=True):
                    found[g, a, b] = found.get((g, a, b), 0) + v
        if found:
            g, a, b = (np.array(x, np.int64) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(g)), pa.array(a), pa.array(b), pa.array(list(found.values()), pa.int64())], names=["lang", "a", "b", "value"])


def _pairs_of_own_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, a, b, value: the sum over a's terms of |p - z|, z being the other's probability of a term that it lacks.

    In rows of a before b also what the terms add that both lack, as if they shared none.
    """
    for batch in batches:
        for row in batch.to_pylist():
            p, n = (np.array([x[k] for x in row["buckets"] or ()], np.int64) for k in ("p", "n"))
            order = np.argsort(p)
            p, n = p[order], n[order]
            below, weight = (np.concatenate([[0], np.cumsum(x)]) for x in (n, n * p))
            z, size = (np.array([x[k] for x in row["others"]], np.int64) for k in ("z", "size"))
            k = np.searchsorted(p, z)
            value = z * below[k] - weight[k] + (weight[-1] - weight[k]) - z * (below[-1] - below[k])
            place, me = np.arange(len(z)), row["place"]
            value += np.where(place > me, (row["v"] - size[me] - size) * np.abs(z[me] - z), 0)
            other = place[place != me]
            yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * len(other), pa.string()), pa.array(np.minimum(other, me)), pa.array(np.maximum(other, me)), pa.array(value[other])], names=["lang", "a", "b", "value"])


PAIRS = "lang string, a long, b long, value long"


def audit(docs: DataFrame, least: int = 30, add: int = 5, scale: int = 1_000_000_000, most: int = 50) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank: rank 1 has the greatest value."""
    counts = term_counts(docs)
    # A term's postings: its sources, with how often each has it.
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n"), F.collect_list(F.struct("source", "n")).alias("postings")).where(F.col("docs") >= least)
    kept = written(kept, "kept-terms")
    flat = kept.select("lang", "term", "all_n", F.explode("postings").alias("posting")).select("lang", "term", "all_n", "posting.source", "posting.n")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all_n").alias("lang_total"))
    sizes = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("size"))
    groups = docs.select(_name("lang"), _name("source")).distinct()
    groups = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "size", "v", "lang_total"])
    groups = groups.withColumn("z", _p("0", "total", "v", add, scale))
    ordered = Window.partitionBy("lang").orderBy("source")
    groups = written(groups.withColumn("place", (F.row_number().over(ordered) - 1).cast("long")), "source-groups")
    shared = _small(groups)

    flat = flat.join(shared, ["lang", "source"]).withColumn("p", _p("n", "total", "v", add, scale)).withColumn("q", _p("all_n", "lang_total", "v", add, scale))
    buckets = flat.groupBy("lang", "source", "n", "p").agg(F.count(F.lit(1)).alias("terms"), F.min("q").alias("least_q"))
    buckets = written(buckets, "count-buckets")
    return _pairs(flat, buckets, groups, shared).unionByName(_terms(flat, buckets, most))


def _pairs(flat: DataFrame, buckets: DataFrame, groups: DataFrame, shared: DataFrame) -> DataFrame:
    postings = flat.groupBy("lang", "term").agg(F.collect_list(F.struct("place", "p", "z")).alias("postings"))
    in_order = postings.select("lang", F.array_sort("postings").alias("postings"))
    both = in_order.mapInArrow(_pairs_of_shared_terms, PAIRS)

    own = buckets.groupBy("lang", "source").agg(F.collect_list(F.struct("p", F.col("terms").alias("n"))).alias("buckets"))
    others = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "z", "size"))).alias("others"))
    alone = groups.select("lang", "source", "place", "v").join(own, ["lang", "source"], "left").join(others, "lang")
    alone = alone.select("lang", "place", "v", "buckets", "others").mapInArrow(_pairs_of_own_terms, PAIRS)

    sums = both.unionByName(alone).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = sums.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("me"), F.col("b").alias("other")), F.struct(F.col("b").alias("me"), F.col("a").alias("other")))).alias("way"))
    name = lambda place, to: shared.select("lang", F.col("place").alias(place), F.col("source").alias(to))
    named = ways.select("lang", "value", "way.*").join(name("me", "source"), ["lang", "me"]).join(name("other", "item"), ["lang", "other"])
    return _ranked(named, "pair")


def _ranked(df: DataFrame, part: str, most: int | None = None) -> DataFrame:
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = df.withColumn("rank", F.row_number().over(by))
    out = out if most is None else out.where(F.col("rank") <= most)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _terms(flat: DataFrame, buckets: DataFrame, most: int) -> DataFrame:
    bounded = buckets.withColumn("bound", F.col("p") - F.col("least_q")).where("bound > 0")
    best_first = Window.partitionBy("lang", "source").orderBy(F.desc("bound"), "n").rowsBetween(Window.unboundedPreceding, -1)
    bounded = bounded.withColumn("before", F.coalesce(F.sum("terms").over(best_first), F.lit(0)))

    def looked_at(some: DataFrame) -> DataFrame:
        """Terms of buckets that exceed the language."""
        return flat.join(_small(written(some.select("lang", "source", "n"), "buckets-looked-at")), ["lang", "source", "n"]).where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    first = _ranked(looked_at(bounded.where(F.col("before") < most)), "term", most)
    # The least value that counts so far; 0 where there are fewer than that.
    reached = first.groupBy("lang", "source").agg(F.max(F.when(F.col("rank") == most, F.col("value"))).alias("kth"))
    unseen = bounded.join(reached, ["lang", "source"], "left").where(F.col("bound") >= F.coalesce("kth", F.lit(0)))
    return _ranked(looked_at(unseen), "term", most)
