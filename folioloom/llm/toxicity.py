"""Toxicity by nearest labelled examples: exact cosine of label-weighted TF-IDF over a block-max inverted index.

The index holds at most `most` labelled documents of at most `most_bytes` in all, chosen by hash, one for each id.
Terms are runs of letters and digits (A-Z lower-cased, bytes above 127 count as letters). The vector space has all
terms of the examples; others have no axis. A term's weight is (1 + ln tf) * idf * telling. idf is
ln((N + 1) / (df + 1)), with df counted over all N documents of the corpus. telling is the term's log-likelihood
ratio G2 against the examples' labels, over what chance lets the best of all terms reach (2 ln of their number),
and at least FLOOR: without it most of a long text's cosine comes from words that say nothing of the label.
Terms of many examples are rows of a matrix, and their part of all cosines is one product for a batch of texts.
The others have postings in blocks of examples, with the highest weight of each term in each block: for a text,
the weights of its terms times those maxima, on top of the best that a block has so far, bound the block. Only
blocks whose bound is above the K-th best so far can hold one of the K nearest and are scored; all that are left
out cannot. Ties go to the earlier example. Terms are told apart by 64-bit hashes.

The vote is the mean label of the nearest, weighted by cosine to the power SHARP; a text without any of the
terms (an empty or null one too) is nearest to the examples that have none and gets their mean label. A
logistic curve turns votes into scores, with `cut` at the vote that divides best the votes that examples get
from the others. Evidence: labels and cosines of the five nearest. Without labels every score is 0.

Labels that are null, neither 0 nor 1, or of a null id are left out; of an id's labels the higher counts, and of
its texts the one with the least hash. Rows that repeat get the same score. Texts of any length are scored whole.
Other columns don't matter. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HashTable, apart, bounded_batches, held_out, in_parts, labelled_texts, release, utf8, word_hashes

MOST_LABELLED, MOST_BYTES, K, BLOCK, SHARP, FLOOR, DENSE = 3000, 64_000_000, 31, 64, 2.0, 0.25, 32
CUT = 0.3


def _table() -> bytes:
    keep = b"abcdefghijklmnopqrstuvwxyz0123456789" + bytes(range(128, 256))
    out = bytearray(b" " * 256)
    for c in keep:
        out[c] = c
    for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        out[c] = c + 32
    return bytes(out)


_TERMS = _table()


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERMS).split()


_KEEP = np.frombuffer(_TERMS, np.uint8)


def hashed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first bytes, hashes) of the terms in a byte array."""
    first, _, h = word_hashes(_KEEP[data])
    return first, h


class Vocabulary(HashTable):
    def counts(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, how often) of the known terms of each text, by text."""
        low, bounds = apart(data, at)
        first, h = hashed(low)
        number = self.numbers(h)
        text = np.searchsorted(bounds, first[number >= 0], "right") - 1
        key, n = np.unique(text * max(1, len(self.hashes)) + number[number >= 0], return_counts=True)
        return key // max(1, len(self.hashes)), key % max(1, len(self.hashes)), n


def telling(text: np.ndarray, term: np.ndarray, labels: np.ndarray, size: int, floor: float = FLOOR) -> np.ndarray:
    """By term, how much more than chance lets the best of them all its presence goes with the label; `floor` at least."""
    ones, n = int(labels.sum()), len(labels)
    if not size or not 0 < ones < n:
        return np.ones(size)
    both = np.bincount(term, minlength=size).astype(np.float64)
    a = np.bincount(term, labels[text], size)
    b, out = both - a, 0.0
    for seen, total, whole in ((a, both, ones), (b, both, n - ones), (ones - a, n - both, ones), (n - ones - b, n - both, n - ones)):
        out = out + 2 * seen * np.log(np.maximum(seen, 1e-12) * n / np.maximum(total * whole, 1e-12))
    return np.maximum(floor, out / (2 * np.log(max(2, size))))


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def digest(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=7).digest())


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


class Index:
    """Examples, ordered by label, then by their heaviest term, to make bounds tight.

    Its attributes are plain arrays, which executors get by broadcast and put into an Index of their own.
    """

    def __init__(self, texts: list[bytes], labels: list[int], known: np.ndarray, df: np.ndarray, n: int, block: int = BLOCK, floor: float = FLOOR, dense: int = DENSE):
        """known: the vocabulary's hashes in order; df: of its terms, over n documents."""
        words = Vocabulary(known)
        self.known, self.block, size = known, block, len(known)
        text, term, tf = words.counts(*joined(texts))
        y = np.array(labels, np.float64)
        self.axis = np.log((n + 1) / (np.minimum(n, df) + 1)) * telling(text, term, y, size, floor)
        weight = (1 + np.log(tf)) * self.axis[term]
        norm = np.sqrt(np.bincount(text, weight * weight, len(texts)))
        weight = weight / np.where(norm > 0, norm, 1)[text]
        lead, heaviest = np.full(len(texts), -1), np.lexsort((weight, text))
        lead[text[heaviest]] = term[heaviest]  # the last one of each text stays
        order = sorted(range(len(texts)), key=lambda i: (labels[i], lead[i], texts[i]))
        self.labels, self.digests = y[order], np.array([digest(texts[i]) for i in order], np.int64)
        without = y[np.bincount(text, minlength=len(texts)) == 0]
        self.vote_without = float(without.mean()) if len(without) else float(y.mean()) if len(y) else 0.0
        place = np.empty(len(texts), np.int64)
        place[order] = np.arange(len(texts))
        self.blocks = len(texts) // block + 1
        # terms of many examples are rows of a matrix, the others have postings
        often = np.bincount(term, minlength=size) > max(16, len(texts) // dense)
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        self.rows = np.zeros((int(often.sum()), self.blocks * block), np.float32)
        mine = often[term]
        self.rows[self.row[term[mine]], place[text[mine]]] = weight[mine]
        term, doc, weight = term[~mine], place[text[~mine]], weight[~mine]
        order = np.lexsort((doc, term))
        term, self.doc, self.weight = term[order], doc[order], weight[order]
        # a cell is a term in a block: its postings from cell_first on, and their highest weight
        key = term * self.blocks + self.doc // block
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.cell_first = np.append(first, len(key))
        self.cell_block = self.doc[first] // block
        self.cell_most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.term_cells = np.searchsorted(term[first], np.arange(size + 1))

    def nearest(self, data: np.ndarray, at: np.ndarray, words: Vocabulary, k: int = K, unlike: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text, (examples, cosines) of the k nearest that share a term with it; unlike: digests to pass over."""
        text, term, tf = words.counts(data, at)
        weight = (1 + np.log(tf)) * self.axis[term]
        norm = np.sqrt(np.bincount(text, weight * weight, len(at) - 1))
        weight = weight / np.where(norm > 0, norm, 1)[text]
        bounds = np.searchsorted(text, np.arange(len(at)))
        for start in range(0, len(at) - 1, 64):
            stop = min(start + 64, len(at) - 1)
            own = slice(bounds[start], bounds[stop])
            row = self.row[term[own]]
            by_row = np.zeros((stop - start, len(self.rows)), np.float32)
            by_row[(text[own] - start)[row >= 0], row[row >= 0]] = weight[own][row >= 0]
            dense = (by_row @ self.rows).astype(np.float64)
            for i in range(start, stop):
                own = slice(bounds[i], bounds[i + 1])
                few = self.row[term[own]] < 0
                yield self._best(dense[i - start], term[own][few], weight[own][few], k, None if unlike is None else unlike[i])

    def _best(self, score: np.ndarray, term: np.ndarray, q: np.ndarray, k: int, unlike: int | None) -> tuple[np.ndarray, np.ndarray]:
        """score: what the matrix gives, a lower bound of each cosine."""
        banned = np.flatnonzero(self.digests == unlike) if unlike is not None else None
        if banned is not None:
            score[banned] = 0.0
        k = min(k, len(score))
        least = np.partition(score, len(score) - k)[len(score) - k] - 1e-9
        n = self.term_cells[term + 1] - self.term_cells[term]
        cell, by_cell = _ranges(self.term_cells[term], n), np.repeat(q, n)
        where = self.cell_block[cell]
        bound = score.reshape(self.blocks, self.block).max(axis=1) + np.bincount(where, by_cell * self.cell_most[cell], self.blocks)
        own = (bound > least)[where]
        c = cell[own]
        m = self.cell_first[c + 1] - self.cell_first[c]
        post = _ranges(self.cell_first[c], m)
        score = score + np.bincount(self.doc[post], np.repeat(by_cell[own], m) * self.weight[post], len(score))
        if banned is not None:
            score[banned] = 0.0
        last = np.partition(score, len(score) - k)[len(score) - k]
        over = np.flatnonzero(score > last)
        best = np.concatenate([over, np.flatnonzero(score == last)[: k - len(over)]])  # of those that tie with the last, the earlier ones
        best = best[score[best] > 1e-9]
        best = best[np.lexsort((best, -score[best]))]
        return best, score[best]

    def vote(self, own: np.ndarray, cosine: np.ndarray, sharp: float = SHARP) -> float:
        if not len(own):
            return self.vote_without
        w = cosine**sharp
        return float((w * self.labels[own]).sum() / w.sum())


def calibrate(votes: np.ndarray, labels: np.ndarray, cut: float = CUT) -> tuple[float, float]:
    """(slope, middle) of the curve from votes to scores, with `cut` at the vote that divides the labels best."""
    if not len(votes) or labels.min() == labels.max():
        return 8.0, 0.5
    order = np.argsort(votes, kind="stable")
    v, y = votes[order], labels[order]
    # false negatives below a cut count by the inverse of their label's share, and so do false positives above
    wrong = np.concatenate([[0], np.cumsum(y)]) / y.sum() + (len(y) - y.sum() - np.concatenate([[0], np.cumsum(1 - y)])) / (len(y) - y.sum())
    edge = np.concatenate([[0.0], v, [1.0]])
    wrong[1:-1][v[1:] == v[:-1]] = np.inf
    at = np.flatnonzero(wrong == wrong.min())
    middle = float(np.mean([(edge[i] + edge[i + 1]) / 2 for i in (at[0], at[-1])]))
    return 12.0, middle


def _score(vote: float, slope: float, middle: float, cut: float) -> float:
    return float(1 / (1 + np.exp(-(slope * (vote - middle) + np.log(cut / (1 - cut))))))


def examples(docs: DataFrame, labels: DataFrame, label: str, of: int, most: int, most_bytes: int) -> tuple[list[bytes], list[int]]:
    """Texts and labels to learn from, in the order of their hash."""
    rows = labelled_texts(docs, labels.where(~held_out("doc_id", of)), label, most, most_bytes)
    got = sorted(rows.collect(), key=lambda r: (r["h"], r["doc_id"]))
    release(rows)
    return [r["text"].encode() for r in got], [r["y"] for r in got]


def document_frequencies(docs: DataFrame, known: np.ndarray) -> tuple[np.ndarray, int]:
    """(documents that have each of the terms, documents)."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n = Vocabulary(shared.value), 0
        df = np.zeros(len(words.hashes) + 1, np.int64)
        for part in in_parts(batches):
            df[:-1] += np.bincount(words.counts(*utf8(part.column("text")))[1], minlength=len(df) - 1)
            n += part.num_rows
        df[-1] = n
        own = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(df[own])], ["term", "df"])

    counted = docs.select("text").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(len(known) + 1, np.int64)
    out[counted["term"].to_numpy()] = counted["df"].to_numpy()
    return out[:-1], int(out[-1])


def score_toxicity(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, label: str = "toxic", of: int = 4, cut: float = CUT, most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id, held_out, score, predicted, nearest (labels and cosines of up to five examples)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select("doc_id", "text")
    texts, y = examples(docs, labels, label, of, most, most_bytes)
    data, at = joined(texts)
    known = np.unique(hashed(np.insert(data, at[1:-1], 32) if len(texts) > 1 else data)[1])
    index = Index(texts, y, known, *document_frequencies(docs, known))
    votes = np.array([index.vote(*x) for x in index.nearest(data, at, Vocabulary(known), unlike=[digest(t) for t in texts])])
    slope, middle = calibrate(votes, np.array(y, np.float64), cut)
    shared = spark.sparkContext.broadcast(vars(index))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index.__new__(Index)
        vars(index).update(shared.value)
        words = Vocabulary(index.known)
        for part in in_parts(batches):
            score, evidence = [], []
            for own, cosine in index.nearest(*utf8(part.column("text")), words):
                score.append(_score(index.vote(own, cosine), slope, middle, cut) if len(index.labels) else 0.0)
                evidence.append([{"label": int(index.labels[i]), "cosine": float(c)} for i, c in zip(own[:5], cosine[:5], strict=True)])
            score = np.array(score)
            near = pa.array(evidence, pa.list_(pa.struct([("label", pa.int32()), ("cosine", pa.float64())])))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score), pa.array((score >= cut).astype(np.int32)), near], ["doc_id", "score", "predicted", "nearest"])

    out = docs.mapInArrow(run, f"doc_id {kind}, score double, predicted int, nearest array<struct<label:int,cosine:double>>")
    return out.select("doc_id", held_out("doc_id", of).alias("held_out"), "score", "predicted", "nearest")
