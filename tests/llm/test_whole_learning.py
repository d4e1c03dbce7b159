"""What models learn comes from all documents to learn from."""

from collections import Counter

import numpy as np

from folioloom.llm import attention_lm, quality, toxicity
from folioloom.llm.queries import VOCABULARY


def test_common_words_of_all_documents(spark):
    """Words and what follows them are counted in every document to learn from, not in some."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)] + ["É", "ß"]
    p = 1 / np.arange(1, len(words) + 1)
    texts = [" ".join(rng.choice(words, 6, p=p / p.sum())) + f" own{i}" for i in range(6000)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    learned = [t.encode().lower().split() for t in (r.text for r in df.where(~attention_lm.held_out("doc_id", 7)).collect()) if t]
    n = Counter(w for t in learned for w in t)
    names = sorted((w for w in n if n[w] * attention_lm.RARE >= n.total()), key=lambda w: (-n[w], w))[: attention_lm.COMMON]
    number, after = {w: i for i, w in enumerate(names)}, np.zeros((len(names), len(names)))
    for t in learned:
        own = [number[w] for w in t if w in number]
        np.add.at(after, (own[:-1], own[1:]), 1)
    assert attention_lm.common_words(df, 7) == attention_lm.word_groups(names, after)


def test_every_window_is_drawn():
    got = list(attention_lm.draws(np.array([1] * 999 + [2]), 8, 256, np.random.default_rng(0)))
    times = np.zeros(1000)
    for own, n in got:
        times[own] += n
    assert times.sum() == 2048 and times[:999].min() >= 2 and times[999] >= 4


def test_model_of_many_tasks(spark):
    """Tokens that are too many for one task are all learned from, in tasks whose weights are averaged."""
    rng = np.random.default_rng(5)
    tokens = sorted({"".join(rng.choice(list("abcdexyz"), rng.integers(2, 6))).encode() for _ in range(3000)})
    rows = [(t, *(int(c == i % 3) for c in range(attention_lm.CONTEXTS))) for i, t in enumerate(tokens)]
    df = spark.createDataFrame(rows, "token binary, " + ", ".join(f"{c} long" for c in attention_lm._T)).repartition(3)
    table = attention_lm.ranks(VOCABULARY)
    cut, pairs = attention_lm.Windows(table), [(t, i % 3) for i, t in enumerate(tokens)]
    model = attention_lm.fit_all(df, len(rows), table, windows=1000, steps=100, batch=16, rounds=4)
    again = attention_lm.fit_all(df, len(rows), table, windows=1000, steps=100, batch=16, rounds=4)
    assert all(np.allclose(v, again.p[k], atol=1e-5) for k, v in model.p.items())
    windows, weight = attention_lm.windows_of(cut, [(t, c, 1) for t, c in pairs])
    start = attention_lm.begun(cut, windows, weight, 3)
    mean = lambda m: attention_lm.score_tokens(m, cut, pairs).mean()
    assert mean(model) > mean(start) + 0.2


def test_quality_learns_from_all_labels_and_pairs(spark):
    """More labelled documents than were once learned from: the gradient of the loss of all their pairs is zero."""
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 7000)
    texts = [" ".join(rng.choice(["Ab,", "cd.", "EF!", "12", "x|y", "\n"], 12, p=np.array([3 + 2 * k, 3, 2, 1, 2 - k, 1]) / (12 + k))) for k in y]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(k)) for i, k in enumerate(y)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    x = quality.features(*toxicity.joined([t.encode() for t in texts])).astype(np.float64)
    assert np.allclose(model["mean"], x.mean(axis=0), atol=1e-6)
    z = (x - model["mean"]) / model["scale"]
    s = z @ model["w"]
    good, bad = y == 1, y == 0
    lost = 1 / (1 + np.exp(s[good][:, None] - s[bad]))
    gradient = quality.PAIRS / good.sum() / bad.sum() * (lost.sum(axis=1) @ z[good] - lost.sum(axis=0) @ z[bad]) - model["w"]
    assert np.abs(gradient).max() < 1 and np.abs(model["w"]).max() > 0.1
    assert np.isclose(model["threshold"], np.quantile(s, bad.mean())) and np.isclose(model["slope"], 4 / (s[good].mean() - s[bad].mean()))


def test_a_rank_among_many(spark):
    values = np.concatenate([np.random.default_rng(7).normal(size=25_000), np.full(15_000, 0.25), [1e9]])
    df = spark.createDataFrame([(float(v),) for v in values], "s double")
    assert [quality._kth(df, k) for k in (0, 12_000, 16_000, 40_000)] == np.sort(values)[[0, 12_000, 16_000, 40_000]].tolist()
