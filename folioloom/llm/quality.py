"""Quality classifier by Bradley-Terry pairwise ranking.

A document's score is linear in features of its whole text. All pairs of a preferred and another labelled document
give the logistic loss of their feature differences, minimised by Newton steps; their mean weighs as much as `pairs`
pairs against the ridge. A pair's loss depends on two scores only, so documents are summed, by label, at nodes a
sixteenth apart, to the two nearest by distance, and pairs of nodes take the place of pairs of documents (error of a
probability: some 0.0001; scores beyond 500 count as 500). A quantile of the scores of all labelled documents, at the
share that isn't preferred, is the threshold; a logistic curve that has `cut` there makes scores from 0 to 1.

Features: shares of byte classes and of pairs of neighbouring classes, mean word length, share of distinct
words and of distinct lines, logarithm of the number of words. Null and empty texts have all features zero
and get a score like any other. All labelled documents are learned from, one for each id, that of the least text
hash; labels that are null or neither 0 nor 1 are left out, and of an id's labels the higher counts. Without a pair to learn from,
every score is the threshold, which accepts.

Rows that repeat get the same score, and so do texts that tie in all features. Texts of any length are read whole.
Other columns pass through, but for score and predicted, which are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, held_out, in_parts, release, utf8, written

#: What all pairs together weigh; nodes of scores in a unit, and the largest score that they tell apart.
PAIRS, NODES, FAR = 20_000, 16, 500
CUT = 0.7
CLASSES = 12
N_FEATURES = CLASSES * CLASSES + CLASSES + 4


def _classes() -> np.ndarray:
    """Byte classes: lower, upper, digit, space, line end, full stop, comma-like, bang, bar, other punctuation, high, control."""
    out = np.full(256, 11, np.uint8)
    for k, members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".", b",;:'\"-()", b"!?", b"|", b"#$%&*+/<=>@[\\]^_`{}~", bytes(range(128, 256)))):
        out[list(members)] = k
    return out


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(documents, N_FEATURES) of concatenated texts."""
    n, classes = len(at) - 1, _classes()[data]
    out = np.zeros((n, N_FEATURES), np.float32)
    length = np.diff(at)
    if len(data):
        doc = np.repeat(np.arange(n, dtype=np.int32), length)
        one = np.bincount(doc * CLASSES + classes, minlength=n * CLASSES).reshape(n, CLASSES)
        inner = doc[1:] == doc[:-1]
        pair = (doc[:-1] * (CLASSES * CLASSES) + classes[:-1] * np.int32(CLASSES) + classes[1:])[inner]
        two = np.bincount(pair, minlength=n * CLASSES * CLASSES).reshape(n, -1)
        scale = np.maximum(length, 1)[:, None]
        out[:, :CLASSES] = one / scale
        out[:, CLASSES : CLASSES + CLASSES * CLASSES] = np.sqrt(two / scale)
        raw = data.tobytes()
        for i in range(n):
            text = raw[at[i] : at[i + 1]]
            if words := text.split():
                lines = text.split(b"\n")
                out[i, -4:] = (len(text) - text.count(b" ")) / len(words) / 10, len(set(words)) / len(words), len(set(lines)) / len(lines), np.log1p(len(words)) / 10
    return out


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, ridge: float = 1.0, seed: int = 11, cut: float = CUT) -> dict:
    """Weights from drawn pairs of rows of x that differ in y, the threshold and the curve's slope: what `train` does
    with all pairs, for rows in memory. The queries don't use it."""
    mean, scale = x.mean(axis=0) if len(x) else np.zeros(N_FEATURES), x.std(axis=0) if len(x) else np.ones(N_FEATURES)
    scale = np.where(scale > 1e-6, scale, 1.0)
    model = {"mean": mean.astype(np.float64), "scale": scale.astype(np.float64), "w": np.zeros(x.shape[1]), "threshold": 0.0, "slope": 1.0, "cut": cut}
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return model
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    diff = (z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        step = np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff + ridge * np.eye(len(w)), diff.T @ (1 - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    s = z @ w
    model["w"], model["threshold"] = w, float(np.quantile(s, len(bad) / len(s)))
    gap = s[good].mean() - s[bad].mean()
    model["slope"] = float(4 / max(gap, 1e-3))
    return model


def apply(model: dict, x: np.ndarray) -> np.ndarray:
    s = ((x - model["mean"]) / model["scale"]) @ model["w"]
    odds = np.log(model["cut"] / (1 - model["cut"]))
    return 1 / (1 + np.exp(-np.clip(model["slope"] * (s - model["threshold"]) + odds, -30, 30)))


def _labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """y and features x of every labelled document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_parts(batches):
            x = features(*utf8(part.column("text")))
            rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), N_FEATURES).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("h"), rows], ["doc_id", "h", "x"])

    known = labels.where(F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.max("y").alias("y"))
    # features are shorter than texts, so they are made before documents meet their labels
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(run, f"doc_id {kind}, h long, x array<float>")
    return rows.join(known, "doc_id").groupBy("doc_id").agg(F.first("y").alias("y"), F.min_by("x", "h").alias("x")).select("y", "x")


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("y").to_numpy(), batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)


def _sums(rows: DataFrame, of: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, and by key the sum over all rows of the vectors that `of` gives of y and x with their keys."""

    def added(pairs: Iterator[tuple[list[int], np.ndarray]]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for keys, vectors in pairs:
            for k, v in zip(keys, vectors, strict=True):
                sums[k] = sums[k] + v if k in sums else v.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["k", "v"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = (of(*_rows(b)) for b in batches if b.num_rows)
        return added((keys.tolist(), vectors) for keys, vectors in got)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return added((b.column("k").to_pylist(), [np.frombuffer(v) for v in b.column("v").to_pylist()]) for b in batches)

    got = rows.mapInArrow(each, "k long, v binary").repartition("k").mapInArrow(again, "k long, v binary").collect()
    got = sorted((r.k, r.v) for r in got)
    return np.array([k for k, _ in got], np.int64), np.stack([np.frombuffer(v) for _, v in got]) if got else np.zeros((0, 1))


def _place(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(z @ w, -FAR, FAR) * NODES


def _by_node(y: np.ndarray, z: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (2 * node + y), and of each how many documents and the sum of z, shared between the nodes beside a score."""
    place = _place(z, w)
    low = np.floor(place)
    keys = np.concatenate([low, low + 1]).astype(np.int64) * 2 + np.tile(y, 2)
    part = np.concatenate([1 - (place - low), place - low])
    order = np.argsort(keys, kind="stable")
    own, start = np.unique(keys[order], return_index=True)
    rows = np.column_stack([np.ones(len(z)), z])[order % len(z)] * part[order, None]
    return own, np.add.reduceat(rows, start, axis=0)


def _pair_sums(nodes: np.ndarray, others: np.ndarray, rows: np.ndarray, curve: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over others of curve(node - other) * row, for each node."""
    return np.concatenate([curve((nodes[k : k + 256, None] - others) / NODES) @ rows for k in range(0, len(nodes), 256)])


def _kth(scores: DataFrame, k: int) -> float:
    """The value of rank k (from 0) of the column s; cells that hold it are counted, ever smaller ones."""
    while True:
        low, high, n = scores.agg(F.min("s"), F.max("s"), F.count("s")).first()
        if low == high:
            return low
        if n <= 10_000:
            return sorted(r[0] for r in scores.collect())[k]
        cell = F.least(F.floor((F.col("s") - low) / (high - low) * 4096), F.lit(4095))
        for own, count in sorted(tuple(r) for r in scores.groupBy(cell.alias("cell")).count().collect()):
            if k < count:
                break
            k -= count
        scores = scores.where(cell == own)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", pairs: int = PAIRS, ridge: float = 1.0, cut: float = CUT) -> dict:
    """Fits on all labelled documents and all pairs of them; labels is a frame of doc_id and the label, without held-out rows."""
    bounded_batches(docs.sparkSession)
    rows = written(_labelled(docs, labels, label), "quality-features")
    keys, sums = _sums(rows, lambda y, x: (np.arange(2), np.stack([np.concatenate([[(y == c).sum()], x[y == c].sum(axis=0), (x[y == c] ** 2).sum(axis=0)]) for c in (0, 1)])))
    model = {"mean": np.zeros(N_FEATURES), "scale": np.ones(N_FEATURES), "w": np.zeros(N_FEATURES), "threshold": 0.0, "slope": 1.0, "cut": cut}
    bad, good = (int(n) for n in sums[:, 0]) if len(keys) else (0, 0)
    if not bad or not good:
        release(rows)
        return model
    first, second = sums[:, 1 : N_FEATURES + 1], sums[:, N_FEATURES + 1 :]
    mean = first.sum(axis=0) / (good + bad)
    scale = np.sqrt(np.maximum(second.sum(axis=0) / (good + bad) - mean**2, 0))
    scale = np.where(scale > 1e-6, scale, 1.0)
    w, weight = np.zeros(N_FEATURES), pairs / good / bad
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    slope = lambda x: sigmoid(x) * sigmoid(-x)
    for _ in range(12):
        keys, sums = _sums(rows, lambda y, x, w=w: _by_node(y, (x - mean) / scale, w))
        (b, g), (at_b, at_g) = (sums[keys % 2 == c] for c in (0, 1)), (keys[keys % 2 == c] // 2 for c in (0, 1))
        lost = _pair_sums(at_g, at_b, b[:, 0], lambda x: sigmoid(-x)) @ g[:, 1:] - _pair_sums(at_b, at_g, g[:, 0], sigmoid) @ b[:, 1:]
        steep = [(at_b, _pair_sums(at_b, at_g, g[:, 0], slope)), (at_g, _pair_sums(at_g, at_b, b[:, 0], slope))]
        crossed = g[:, 1:].T @ _pair_sums(at_g, at_b, b[:, 1:], slope)

        def squares(y: np.ndarray, x: np.ndarray, w: np.ndarray = w, steep: list = steep) -> tuple[np.ndarray, np.ndarray]:
            z = (x - mean) / scale
            place = _place(z, w)
            d = np.where(y == 1, np.interp(place, *steep[1]), np.interp(place, *steep[0]))
            return np.zeros(1, np.int64), ((z * d[:, None]).T @ z).reshape(1, -1)

        own = _sums(rows, squares)[1].reshape(N_FEATURES, N_FEATURES)
        step = np.linalg.solve(weight * (own - crossed - crossed.T) + ridge * np.eye(N_FEATURES), weight * lost - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-4:
            break

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array((_rows(batch)[1] - mean) / scale @ w)], ["s"])

    scores = written(rows.mapInArrow(score, "s double"), "quality-scores")
    place = (good + bad - 1) * bad / (good + bad)
    k = int(place)
    low, high = _kth(scores, k), _kth(scores, min(k + 1, good + bad - 1))
    gap = float((first[1] / good - first[0] / bad) / scale @ w)
    release(rows, scores)
    return model | {"mean": mean, "scale": scale, "w": w, "threshold": low + (high - low) * (place - k), "slope": 4 / max(gap, 1e-3)}


def scored(docs: DataFrame, model: dict, keep: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """docs with score and predicted; with `keep`, only the rows and columns of docs whose scores it takes."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f.name for f in docs.schema if f.name not in ("score", "predicted")] if keep is None else docs.columns
    docs = docs.select(*(F.col(f"`{c}`") for c in names))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_parts(batches):
            score = apply(shared.value, features(*utf8(part.column("text"))))
            if keep is not None:
                yield part.filter(pa.array(keep(score)))
                continue
            predicted = (score >= shared.value["cut"]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score), pa.array(predicted)], [*names, "score", "predicted"])

    return docs.mapInArrow(run, types if keep is not None else f"{types}, score double, predicted int")


def labelled_for_training(labels: DataFrame, of: int = 4) -> DataFrame:
    return labels.where(~held_out("doc_id", of))


def score_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    model = train(docs, labelled_for_training(labels), **options)
    out = scored(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out("doc_id", 4).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs, with all their columns, that the classifier doesn't reject."""
    model = train(docs, labelled_for_training(labels), **options)
    cut = model["cut"]
    return scored(docs, model, keep=lambda score: score >= cut)
