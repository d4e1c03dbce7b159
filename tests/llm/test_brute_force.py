"""Operators against plain versions of their contracts on the smallest tables, and held-out accuracy."""

import hashlib
import os
import re
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from folioloom.llm import attention_lm, decontaminate, langid, mixing, quality, simhash, suffix_dedup, syncmers, toxicity
from folioloom.llm.queries import QUERIES, VOCABULARY

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id").reset_index(drop=True)


def by_id(spark, name):
    return QUERIES[name](spark, SF).toPandas().set_index("doc_id")


def test_mixing(spark, docs):
    got = by_id(spark, "op2_mixing").loc[docs.doc_id]
    size = np.array([len(WORD.findall(t or "")) for t in docs.text])
    assert (got["size"] == size).all() and (got.taken <= 3 * got["size"]).all()
    sums = got.assign(source=docs.source.to_numpy()).groupby("source").agg({"size": "sum", "taken": "sum", "target": "first", "source_size": "first"})
    assert (sums["size"] == sums.source_size).all() and (abs(sums.taken - sums.target) <= 0.5).all()
    assert abs(sums.target.sum() - size.sum()) < 1e-6 and (sums.target <= 3 * sums["size"] + 1e-6).all()
    assert got.equals(by_id(spark, "op2_mixing").loc[docs.doc_id])


def test_water_filling():
    assert mixing.water_fill([10, 100, 1000], [5, 2, 1], 1110, 3) == [30.0, 300.0, 780.0]
    assert mixing.water_fill([], [], 0, 3) == [] and mixing.water_fill([0, 5], [1, 1], 5, 3) == [0.0, 5.0]


def test_splitting_tree():
    tree = mixing.splitting_tree([100, 7, 0, 33], 9, 1)
    assert tree.shape == (9, 4) and tree.sum(axis=0).tolist() == [100, 7, 0, 33]
    assert (tree == mixing.splitting_tree([100, 7, 0, 33], 9, 1)).all()
    assert tree.sum(axis=1).max() - tree.sum(axis=1).min() <= 1 + 140 // 9 // 4


def test_mix_rows(spark):
    mixed = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    taken = by_id(spark, "op2_mixing").taken
    assert all(len(WORD.findall(t)) == n for t, n in zip(mixed.text, mixed.mix_words, strict=True))
    assert (mixed.groupby("doc_id").mix_words.sum() == taken[taken > 0].sort_index()).all()
    assert mixed.mix_shard.between(0, 63).all()


def test_draws_fill_the_leaves_of_the_tree(spark, docs):
    """The blocks that are drawn, counted one by one, are those of the splitting tree, shard by shard."""
    shards, blocks, seed = 5, 4, 7
    plan = mixing.plan_mix(spark.read.parquet(f"{SF}/documents.parquet").where("source in ('src0', 'src1', 'src2')"), shards=shards, blocks=blocks, seed=seed).collect()
    sources = sorted({r.source for r in plan})
    used = [{(d["block"], d["shard"]) for r in plan if r.source == s for d in r.draws} for s in sources]
    quotas = [max(b for b, _ in u) + 1 for u in used]
    assert all(len(u) == q for u, q in zip(used, quotas, strict=True))  # every block is met, and in one shard
    tree = mixing.splitting_tree(quotas, shards, seed)
    assert [[sum(k == s for _, s in u) for u in used] for k in range(shards)] == tree.tolist()
    whole = [r for r in plan if r.source == "src0"]
    rest = round(whole[0].target) % whole[0].source_size
    assert sum(d["words"] for r in whole for d in r.draws if d["pass"] == round(r.target) // r.source_size) == rest


def test_mix_of_repeated_and_null_rows(spark):
    """Rows that share an id are rows of their own; ids and sources that are null aren't empty ones; names may clash."""
    rows = [(1, "a b c d e f g", "x"), (1, "h i", "x"), (1, "a b c d e f g", "x"), (None, "k l m", "x"), (None, "n", None), (None, None, None), (2, "o p q r s", ""), (3, "t u", None), (4, "v w x y", "y")]
    names = ["_k", "_s", "_n", "_d", "h", "size", "row", "target", "mix_x", "mix_shard"]
    docs = spark.createDataFrame([(*r, *range(10)) for r in rows], "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    plan = mixing.plan_mix(docs).collect()
    assert len(plan) == len(rows) and {r.source for r in plan} == {None, "", "x", "y"}
    for s in (None, "", "x", "y"):
        own = [r for r in plan if r.source == s]
        assert sum(r["size"] for r in own) == own[0].source_size and 0 <= round(own[0].target) - sum(r.taken for r in own) <= 1
    out = mixing.mix(docs)
    assert out.columns == [*(c for c in docs.columns if c != "mix_shard"), "mix_shard", "mix_pass", "mix_order", "mix_words"]
    got = out.collect()
    assert all(len(r.text.split()) == r.mix_words and (r._k, r._d, r["size"], r.mix_x) == (0, 3, 5, 8) for r in got)
    assert sorted((str(r.doc_id), str(r.source), r.mix_words) for r in got) == sorted((str(r.doc_id), str(r.source), d["words"]) for r in plan for d in r.draws)
    mixed = mixing.mix(docs.limit(0))
    assert mixed.count() == 0 and mixed.columns == out.columns
    monkey, mixing.BROADCAST_SOURCES = mixing.BROADCAST_SOURCES, 0
    try:
        joined = mixing.plan_mix(docs).collect()
    finally:
        mixing.BROADCAST_SOURCES = monkey
    assert sorted(map(str, joined)) == sorted(map(str, plan))


def test_language(spark, docs):
    got = by_id(spark, "op3_langid").loc[docs.doc_id]
    held = got.held_out.to_numpy()
    assert held.sum() > 20 and (got.lang_pred.to_numpy() == docs.lang)[held].mean() > 0.9


def slow_code_length(text, counts, nodes):
    """Bits of a text by escapes with exclusion, symbol by symbol, from counts[order][context][byte]."""
    bits = 0.0
    for i, c in enumerate(text):
        before = bytes([10, 10, 10]) + text[:i]
        ctx = next(before[len(before) - o :] for o in (3, 2, 1, 0) if (o, int.from_bytes(before[len(before) - o :], "big")) in nodes)

        def p(ctx, c):
            own = counts[len(ctx)].get(ctx)
            below = (lambda b: p(ctx[1:], b)) if ctx else (lambda b: 1 / 256)
            if not own:
                return below(c)
            total, distinct = sum(own.values()), len(own)
            if c in own:
                return own[c] / (total + distinct if distinct < 256 else total)
            return distinct / (total + distinct) * below(c) / (1 - sum(below(b) for b in own))

        bits -= np.log2(max(p(ctx, c), 1e-12))
    return bits


def test_code_lengths_of_many_languages(docs):
    """Nine languages need two tables; code lengths are those of the trees, worked out symbol by symbol."""
    rng = np.random.default_rng(6)
    texts = [[bytes(rng.choice(list(b"abcdef gh"[k % 5 :]), 400).astype(np.uint8)) for _ in range(2)] for k in range(9)]
    grams = [langid.gram_counts(np.frombuffer(b"".join(t), np.uint8), np.array([0, 400, 800])) for t in texts]
    parts = langid.tables([f"l{k}" for k in range(9)], grams, 40)
    assert [len(p["langs"]) for p in parts] == [8, 1] and all(len(p["nodes"]) == 40 for p in parts)
    query = [b"abc defg", b"", b"hhh\xff zz", b"g"]
    data, at = np.frombuffer(b"".join(query), np.uint8), np.concatenate([[0], np.cumsum([len(q) for q in query])])
    k = 0
    for part in parts:
        tree = langid.Model.__new__(langid.Model)
        vars(tree).update(part)
        got = tree.code_lengths(tree.longest(), data, at)
        for j in range(len(part["langs"])):
            counts = [{} for _ in range(4)]
            for t in texts[k]:
                for i, c in enumerate(t):
                    before = bytes([10, 10, 10]) + t[:i]
                    for o in range(4):
                        counts[o].setdefault(before[len(before) - o :], Counter())[c] += 1
            want = [slow_code_length(q, counts, set(part["nodes"])) for q in query]
            assert np.allclose(got[:, j], want, atol=0.01)
            k += 1


def test_ranking_is_a_minimum(docs):
    """At the learned weights the gradient of the pairs' logistic loss, ridge included, is zero."""
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(300, quality.N_FEATURES)).astype(np.float32), rng.integers(0, 2, 300)
    x[:, 0] += y
    model = quality.fit(x, y, pairs=2000)
    z = (x - model["mean"]) / model["scale"]
    draw = np.random.default_rng(11)
    good, bad = draw.choice(np.flatnonzero(y == 1), 2000), draw.choice(np.flatnonzero(y == 0), 2000)
    diff = z[good] - z[bad]
    p = 1 / (1 + np.exp(-diff @ model["w"]))
    assert np.abs(diff.T @ (1 - p) - model["w"]).max() < 0.05
    assert ((z @ model["w"])[y == 1].mean() > (z @ model["w"])[y == 0].mean()) and np.mean(z @ model["w"] >= model["threshold"]) == pytest.approx((y == 1).mean(), abs=0.01)


def test_features_of_a_text():
    """Shares of byte classes and neighbours, word length and distinct shares, counted one by one."""
    texts = [b"Ab c, d.\nAb 12!", b"", "é x x\nx x".encode()]
    kinds = quality._classes()
    got = quality.features(*toxicity.joined(texts))
    for t, row in zip(texts, got, strict=True):
        if not t:
            assert (row == 0).all()
            continue
        one, two = Counter(int(kinds[b]) for b in t), Counter((int(kinds[a]), int(kinds[b])) for a, b in zip(t, t[1:], strict=False))
        want = [one[k] / len(t) for k in range(12)] + [np.sqrt(two[i, j] / len(t)) for i in range(12) for j in range(12)]
        words = t.split()
        want += [(len(t) - t.count(b" ")) / len(words) / 10, len(set(words)) / len(words), len(set(t.split(b"\n"))) / len(t.split(b"\n")), np.log1p(len(words)) / 10]
        assert np.allclose(row, want, atol=1e-6)


def removed(texts, window):
    count = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - window + 1):
            if count[t[i : i + window]] > 1:
                gone[i : i + window] = True
        yield gone


def test_suffix_dedup(spark, docs):
    got = by_id(spark, "op4_suffix_dedup").loc[docs.doc_id]
    texts = [(t or "").encode() for t in docs.text]
    for t, gone, row in zip(texts, removed(texts, 200), got.itertuples(), strict=True):
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        assert (row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256) == (len(t), gone.sum(), (np.diff(gone.astype(int), prepend=0) == 1).sum(), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("hot", [1, 10_000])
def test_suffix_dedup_of_made_up_repeats(spark, hot):
    rng = np.random.default_rng(5)
    word = lambda k: "".join(rng.choice(list("abé "), k))
    base = [word(700) for _ in range(6)]
    texts = ["ab" * 300, "x" * 1000, word(199), base[0], base[0], *(word(40) + base[i % 6][rng.integers(0, 200) : rng.integers(350, 700)] + word(60) for i in range(60)), *(base[1][:250] + word(30 + k) for k in range(30))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffix_dedup.dedup_digest(df, hot=hot).collect()}
    assert got == {i: int(g.sum()) for i, g in enumerate(removed([t.encode() for t in texts], 200))}


def test_syncmers(spark, docs):
    got = by_id(spark, "op5_syncmers").loc[docs.doc_id]
    texts = [t or "" for t in docs.text]
    for i, (t, row) in enumerate(zip(texts, got.itertuples(), strict=True)):
        edited = t[: len(t) - len(t) // 2] + texts[(i + 1) % len(texts)][: len(t) // 2]
        assert row.n_chars == len(t) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    mine = dict(zip(texts, got.fingerprint, strict=True))
    assert all(mine[t] == f for t, f in zip(texts, got.fingerprint, strict=True))
    assert got.near_edited.between(0, 1).all() and got.near_edited.mean() > 0.25 > 0.05 > got.near_next.mean()


def test_syncmers_over_many_parts(spark, docs):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    few, many = (syncmers.fingerprint_with_edits(df, part_bytes=n).toPandas().sort_values("doc_id").reset_index(drop=True) for n in (1 << 30, 20_000))
    assert few.equals(many)


def slow_sketch(text):
    """(hash, place) by slot, from the definition."""
    a, b, c, top = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, (1 << 64) - 1
    if 0 < len(text) < 16:
        x = xxhash.xxh64_intdigest(text)
        return {x >> 57: (x & 0xFFF, 0)}
    v = [int.from_bytes(text[i : i + 8], "little") * a & top for i in range(len(text) - 7)]
    v = [x ^ x >> 32 for x in v]
    h = [(x * b & top) >> 32 for x in v]
    out = {}
    for i in range(len(text) - 15):
        own = h[i : i + 9]
        if own[0] == min(own) or own[8] < min(own[:8]):
            m = ((v[i] * c & top) ^ v[i + 8]) * b & top
            m ^= m >> 29
            new = (m & (1 << 44) - 1, i, m)
            if new < out.get(m >> 57, (1 << 64,)):
                out[m >> 57] = new
    return {k: (m & 0xFFF, i // 16) for k, (_, i, m) in out.items()}


def slow_likeness(a, b):
    shifts = [a[k][1] - b[k][1] for k in a.keys() & b.keys() if a[k][0] == b[k][0]]
    filled = len(a.keys() | b.keys())
    return max((sum(s in (x, x + 1) for s in shifts) for x in shifts), default=0) / filled if filled else 1.0


def test_fingerprints_and_likeness(spark, docs):
    got = by_id(spark, "op5_syncmers").loc[docs.doc_id]
    texts = [t or "" for t in docs.text]
    sketch = [slow_sketch(t.encode()) for t in texts]
    for i, row in enumerate(got.itertuples()):
        after = texts[(i + 1) % len(texts)]
        half = len(texts[i]) // 2
        edited = slow_sketch((texts[i][: len(texts[i]) - half] + after[:half]).encode())
        for want, string in ((sketch[i], row.fingerprint), (edited, row.edited_fingerprint)):
            assert string == "".join("%03x%07x" % want[k] if k in want else "." * 10 for k in range(128))
        assert row.near_edited == pytest.approx(slow_likeness(sketch[i], edited))
        assert row.near_next == pytest.approx(slow_likeness(sketch[i], sketch[(i + 1) % len(texts)]))


@pytest.mark.parametrize("kind", ["string", "long", "int"])
def test_next_document_by_any_id(spark, kind):
    """Ids that are null, strings or repeat very often: next is by id, then by the text's hash, whatever the parts."""
    texts = [f"text number {i} " * (1 + i % 5) for i in range(300)]
    ids = [None if i % 3 == 0 else str(i % 7) if i % 2 else str(i) for i in range(300)]
    df = spark.createDataFrame([(None if x is None else x if kind == "string" else int(x), t) for x, t in zip(ids, texts, strict=True)], f"doc_id {kind}, text string")
    order = [(r.doc_id, r.text) for r in df.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()]
    want = Counter()
    for (x, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        want[x, hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()] += 1
    for size in (1 << 30, 500):
        got = syncmers.fingerprint_with_edits(df, part_bytes=size).collect()
        assert Counter((r.doc_id, r.edited_sha256) for r in got) == want


def test_shifts_of_long_texts():
    """A passage 100,000 bytes further on is one shift, and differs from its place 65,536 bytes before."""
    rng = np.random.default_rng(4)
    draw = lambda n: rng.integers(97, 123, n, dtype=np.uint8).tobytes()
    same = draw(3000)
    at, h = syncmers.sketches([same, draw(100_000) + same])
    assert h[1].max() > 4096 and syncmers.likeness((at[:1], h[:1]), (at[:1], h[:1] + 6250))[0] == 1.0


def test_syncmers_are_context_free():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 123, 4000, dtype=np.uint8)
    whole = set(syncmers.syncmers(data)[0].tolist())
    at = set((syncmers.syncmers(data[1000:2000].copy())[0] + 1000).tolist())
    assert at == {p for p in whole if 1000 <= p <= 2000 - syncmers.K}


def test_language_model(spark, docs):
    got = by_id(spark, "op6_attention_lm").loc[docs.doc_id]
    held = got.held_out.to_numpy()
    tokens = [[*WORD.findall((t or "").translate(LOWER)), None] for t in docs.text]
    c = Counter(w for ws, h in zip(tokens, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    base = [sum(np.log10((c[w] + 1) / (n + v + 1)) for w in ws) for ws in tokens]
    assert np.allclose(got.base_score, base) and (got.train_tokens == n).all()
    assert (got.n_known == [sum(c[w] > 0 for w in ws) for ws in tokens]).all() and (got.n_tokens == list(map(len, tokens))).all()
    assert (got.score < 0).all() and np.corrcoef(got.score, base)[0, 1] > 0.9


def plain_log_prob(model, ids, target):
    """Of the target after ids, with one query at a time and no mask: what comes later isn't there."""
    p, x = model.p, []
    for k, i in enumerate(ids):
        x.append(p["E"][i] + p["P"][k])
    x, size = np.array(x, np.float64), attention_lm.WIDTH // attention_lm.HEADS
    q, k, v = x[-1] @ p["Q"], x @ p["K"], x @ p["V"]
    o = []
    for h in range(attention_lm.HEADS):
        own = slice(h * size, (h + 1) * size)
        a = np.exp(k[:, own] @ q[own] / np.sqrt(size))
        o.append((a / a.sum()) @ v[:, own])
    y = x[-1] + np.concatenate(o) @ p["O"]
    y = y + np.maximum(y @ p["W1"] + p["b1"], 0) @ p["W2"] + p["b2"]
    z = y @ p["U"] + p["c"]
    return z[target] - np.log(np.exp(z - z.max()).sum()) - z.max()


def test_scores_from_the_definition(spark):
    """Counts, back-off and attention, worked out token by token with plain attention; each piece is scored once."""
    texts = ["the cat and the dog and the long verylongwordthatneedsseveralwindowsofpieces", "the dog sat", "", "A cat, the dog", "and the THE the sat on x", "zzz the unseenword"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in attention_lm.score_texts(df, VOCABULARY, steps=40, frequent=3).collect()}
    groups = attention_lm.common_words(df, 7)
    cut, held = attention_lm.Windows(attention_lm.ranks(VOCABULARY)), {i: r.held_out for i, r in got.items()}
    t, lines = Counter(), {i: list(zip(*attention_lm._tokens(x.encode(), groups), strict=True)) for i, x in enumerate(texts)}
    for i, line in lines.items():
        t.update(line if not held[i] else ())
    c, kinds, sums = Counter(), Counter(), Counter()
    for (w, k), n in t.items():
        c[w] += n
        kinds[k] += 1
        sums[k] += n
    model = attention_lm.fit(cut, [(w, k, 1) for w, k in t], 40, seed=3)
    spelled = {}
    for line in lines.values():
        for w, k in line:
            pieces = [(ids[: len(ids) - len(target) + j + 1], x) for ids, target in cut.of(w, k) for j, x in enumerate(target)]
            spelled[w, k] = sum(plain_log_prob(model, *p) for p in pieces) / np.log(10)
    n, v = sum(c.values()), len(c)
    for i, line in lines.items():
        want = 0.0
        for w, k in line:
            p = (c[w] + v * 10 ** spelled[w, k]) / (n + v)
            want += np.log10((t[w, k] + max(1, kinds[k]) * p) / (sums[k] + max(1, kinds[k])))
        assert got[i].score == pytest.approx(want, abs=1e-3) and got[i].train_tokens == n


def test_model_is_a_distribution():
    cut = attention_lm.Windows(attention_lm.ranks(VOCABULARY))
    model = attention_lm.fit(cut, [(b"the", 1, 5), (b"", 2, 3), (b"thing", 0, 2)], steps=20)
    ids = np.array([[cut.first_context, 40, 41]], np.int32)
    out = [model.log_probs(np.repeat(ids, cut.n + 2, 0), np.arange(cut.n + 2), np.full(cut.n + 2, 2), np.arange(cut.n + 2))]
    assert np.isclose(np.exp(out[0]).sum(), 1, atol=1e-4)
    assert all(sum(len(t) for _, t in cut.of(w, 1)) == len(cut.encoding._encode_single_piece(w)) + 1 for w in (b"x" * 500, b"thing"))


def test_gradients():
    cut = attention_lm.Windows(attention_lm.ranks(VOCABULARY))
    model = attention_lm.Model(cut.n + 2 + attention_lm.CONTEXTS, cut.n + 2)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    batch = attention_lm.padded([w for t in (b"the", b"", b"y" * 60) for w in cut.of(t, 1)])
    weight = np.ones(len(batch[1]))
    _, g = model.gradients(*batch, weight)
    for k, p in model.p.items():
        i = np.abs(g[k]).argmax()
        old, losses = p.flat[i], []
        for d in (1e-4, -1e-4):
            p.flat[i] = old + d
            losses.append(model.gradients(*batch, weight)[0])
        p.flat[i] = old
        assert g[k].flat[i] == pytest.approx((losses[0] - losses[1]) / 2e-4, rel=1e-3), k


def slow_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def test_simhash(spark, docs):
    got = by_id(spark, "op7_simhash").loc[docs.doc_id]
    fp = [slow_fingerprint(t) for t in docs.text]
    assert [f"{f:016x}" for f in fp] == got.fingerprint.tolist()
    root = list(range(len(fp)))
    for i in range(len(fp)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 4:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert [docs.doc_id[r] for r in root] == got.component_id.tolist()


@pytest.mark.parametrize("options", [{}, {"chunks": 4}, {"chunks": 5}, {"block": 16}, {"block": 16, "deep": 1}, {"block": 4, "deep": 0}, {"chunks": 5, "block": 4, "deep": 0}])
def test_links_of_dense_groups(spark, options):
    rng = np.random.default_rng(2)
    v = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    for _ in range(3):
        v = np.unique(np.concatenate([v, v[:100] ^ sum(np.uint64(1) << rng.integers(0, 64, len(v[:100]), dtype=np.uint64) for _ in range(2))]))
    df = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long")
    got = [(r.u, r.v) for r in simhash.links(df, **options).collect()]
    place = {int(x): i for i, x in enumerate(v.view(np.int64))}
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 4

    def roots(pairs):
        root = np.arange(len(v))
        for i, j in pairs:
            root[root == max(root[i], root[j])] = min(root[i], root[j])
        return root

    assert (roots((place[a], place[b]) for a, b in got) == roots(zip(*map(list, np.nonzero(near)), strict=True))).all()


def accuracy(spark, name, label, cut):
    got = by_id(spark, name)
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().set_index("doc_id")[label]
    got = got.join(lab, how="inner")
    held = got[got.held_out]
    assert ((held.score >= cut) == (held.predicted == 1)).all()
    return (held.predicted == held[label]).mean()


def test_classifiers(spark, monkeypatch):
    monkeypatch.setitem(globals(), "SF", "/root/testdata/sf0.01")
    assert accuracy(spark, "op9_quality", "quality", 0.7) > 0.9
    assert accuracy(spark, "op8_toxicity", "toxic", 0.3) > 0.9


@pytest.mark.parametrize("block,dense", [(4, 16), (64, 16), (16, 1), (8, 1000)])
def test_nearest_is_plain_cosine(docs, block, dense):
    """Every term of the examples is an axis; the nearest are those of a plain cosine of all pairs."""
    texts = [(t or "").encode() for t in docs.text]
    labels = [int(i % 5 == 0) for i in range(len(texts))]
    name = {x: int(toxicity.hashed(np.frombuffer(x, np.uint8))[1][0]) for t in texts for x in toxicity.terms(t)}
    assert len(set(name.values())) == len(name)
    df = Counter(x for t in texts for x in set(toxicity.terms(t)))
    axes = sorted({x for t in texts[:120] for x in toxicity.terms(t)}, key=name.get)
    known = np.array([name[x] for x in axes], np.uint64)
    index = toxicity.Index(texts[:120], labels[:120], known, np.array([df[x] for x in axes]), len(texts), block=block, dense=dense)
    axis = dict(zip(axes, index.axis, strict=True))
    ones = Counter(x for t, y in zip(texts[:120], labels[:120], strict=True) for x in set(toxicity.terms(t)) if y)
    rare = next(x for x in axes if ones[x] == 1 and sum(x in toxicity.terms(t) for t in texts[:120]) == 1)
    g2 = 2 * np.log(120 / 24) + 2 * 23 * np.log(23 * 120 / (119 * 24)) + 2 * 96 * np.log(96 * 120 / (119 * 96))
    assert axis[rare] == pytest.approx(np.log((len(texts) + 1) / (df[rare] + 1)) * max(toxicity.FLOOR, g2 / (2 * np.log(len(axes)))))

    def vector(t):
        w = {x: (1 + np.log(n)) * axis[x] for x, n in Counter(toxicity.terms(t)).items() if x in axis}
        size = np.sqrt(sum(v * v for v in w.values()))
        return {x: v / size for x, v in w.items()} if size else {}

    vectors = [vector(t) for t in texts]
    found = list(index.nearest(*toxicity.joined(texts), toxicity.Vocabulary(known)))
    for q in range(len(texts)):
        want = sorted((sum(v * d.get(x, 0) for x, v in vectors[q].items()) for d in vectors[:120]), reverse=True)[: toxicity.K]
        want = [c for c in want if c > 1e-6]
        assert np.allclose(found[q][1][: len(want)], want, atol=1e-5) and (found[q][1][len(want) :] < 1e-5).all()


def test_terms_by_hash():
    texts = [b"", b"one two", b"two", b" ", b"x" * 3_000_000 + b" one", "né É1 a-b".encode(), b"one"]
    first, h = toxicity.hashed(np.frombuffer(b"two one two", np.uint8))
    words = toxicity.Vocabulary(h)
    text, term, n = words.counts(*toxicity.joined(texts))
    one = words.numbers(h[1:2])[0]
    assert first.tolist() == [0, 4, 8] and sorted(zip(text.tolist(), (term == one).tolist(), n.tolist(), strict=True)) == [(1, False, 1), (1, True, 1), (2, False, 1), (4, True, 1), (6, True, 1)]


def test_toxicity_scores_are_votes(spark, docs):
    got = by_id(spark, "op8_toxicity").loc[docs.doc_id]
    assert got.score.between(0, 1).all() and got.score.round(6).nunique() > 20 and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_workers_without_the_package(tmp_path):
    """What travels to executors comes along whole: their Python has no path to the repository."""
    code = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp}").getOrCreate()
from folioloom.llm.queries import QUERIES, VOCABULARY
sys.path.pop(0)
for name in ("op8_toxicity", "op3_langid", "op9_quality", "op10_decontamination", "op1_url_filter"):
    assert QUERIES[name](s, "/root/testdata/sf0.001").toPandas() is not None, name
print("all done")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code.format(repo=repo, tmp=tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "all done" in out.stdout, out.stderr[-2000:]


def test_decontamination(spark, docs):
    got = QUERIES["op10_decontamination"](spark, SF).toPandas()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    flat = lambda t: " ".join(WORD.findall(t.translate(LOWER)))
    want = {(d, i) for d, t in zip(docs.doc_id, map(flat, docs.text), strict=True) for i, s in zip(items.item_id, map(flat, items.text), strict=True) if s in t}
    assert want and want == set(zip(got.doc_id, got.item_id, strict=True))
    one = got.iloc[0]
    raw = docs.set_index("doc_id").text[one.doc_id].encode()[one.start_byte : one.end_byte].decode()
    assert flat(raw) == flat(items.set_index("item_id").text[one.item_id])


def edit_distance_within(pattern, text):
    row = np.zeros(len(text) + 1, int)
    for c in pattern:
        new = np.empty_like(row)
        new[0] = row[0] + 1
        for j in range(1, len(row)):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != text[j - 1]))
        row = new
    return row.min()


def test_edited_items_are_found_within_the_budget():
    rng = np.random.default_rng(3)
    words = ["the", "other", "of", "ending", "tion", "shore", "and", "in", "blethe", "where"]
    draw = lambda n: " ".join(rng.choice(words, n)).encode()
    items = [(i, draw(30)[:95]) for i in range(8)]
    index = decontaminate.Index(items)
    texts = []
    for i, t in items:
        for edits in (0, 3, 7, 8, 15):
            b = bytearray(t)
            for p in rng.choice(len(b) - 1, edits, replace=False):
                b[p] = ord("z")
            texts.append(draw(40) + b" " + bytes(b) + b" " + draw(30))
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(list(map(len, texts)))])
    got = decontaminate.matches(index, data, at)
    for t, text in enumerate(texts):
        for i, item in items:
            best = edit_distance_within(item, text) if t // 5 == i else None
            if best is not None:
                assert ((t, i) in got) == (best <= int(decontaminate.RATE * len(item)))
                assert (t, i) not in got or got[t, i][0] == best


def test_repetitive_and_long_texts_take_bounded_memory():
    code = """
import resource, sys
sys.path.insert(0, {repo!r})
import numpy as np
from folioloom.llm import decontaminate as d
near = b"a" * 91 + b"bcdefghij"
index = d.Index([(1, b"a" * 100), (2, near), (3, b"the quick brown fox jumps over the lazy dog again and again")])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for text in (b"a" * 5_000_000, b"ab" * 2_500_000, b"a" * 4_500_000 + b" the quick brown fox jumps over the lazy dog again and again"):
    data = np.frombuffer(text, np.uint8)
    print(sorted((i, v) for (_, i), v in d.matches(index, data, np.array([0, len(data)])).items()))
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code.format(repo=repo)], capture_output=True, text=True, timeout=300)
    lines = out.stdout.splitlines()
    assert lines[0] == "[(0, [0, 0, 100, 1])]" and lines[1] == "[]", out
    assert eval(lines[2])[-1] == (2, [0, 4_500_001, 4_500_060, 1]) and int(lines[3]) < 700, lines


@pytest.mark.parametrize("sizes", [(1 << 22, 1 << 14, 1 << 21), (300, 64, 50)])
def test_decontamination_in_small_steps(monkeypatch, sizes):
    """Long texts, stretch by stretch and few q-grams at a time, give what the whole gives: every item within its budget."""
    for name, value in zip(("CHUNK", "LONGEST", "POSTINGS"), sizes, strict=True):
        monkeypatch.setattr(decontaminate, name, value)
    rng = np.random.default_rng(8)
    draw = lambda n: rng.choice(list(b"ab cde"), n).astype(np.uint8).tobytes()
    flat = lambda t: b" ".join(t.split())
    items = [(i, flat(draw(90))) for i in range(6)] + [(6, b"ab" * 40), (7, b"hello"), (8, b"")]
    texts = [flat(draw(250) + b" " + items[i][1] + b" " + draw(250) + items[(i + 1) % 7][1][:-3] + b"zzz" + draw(50)) for i in range(7)] + [b"xx hello xx"]
    index = decontaminate.Index(items, shortest=3)
    got = decontaminate.matches(index, np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    want = {(t, i) for t, text in enumerate(texts) for i, item in items if item and edit_distance_within(item, text) <= (int(decontaminate.RATE * len(item)) if len(item) >= decontaminate.EXACT else 0)}
    assert set(got) == want and (7, 7) in want and (0, 0) in want and (0, 1) in want


def test_links_of_isolated_pairs_in_a_full_shard(spark):
    """All agree on one chunk only, so that pairs meet in its shard alone; many more than 4096 rows reach a leaf there."""
    rng = np.random.default_rng(5)
    edges = np.linspace(0, 64, simhash.CHUNKS + 1).astype(int)
    half = rng.integers(0, 1 << 63, 7000, dtype=np.uint64) & ~np.uint64((1 << int(edges[1])) - 1)
    flips = sum(np.uint64(1) << rng.integers(s, e, len(half)).astype(np.uint64) for s, e in zip(edges[1:-1], edges[2:], strict=True))
    v = np.unique(np.concatenate([half, half ^ flips])).view(np.int64)
    df = spark.createDataFrame([(int(x),) for x in v], "fp long")
    got = {frozenset((r.u, r.v)) for r in simhash.links(df).collect()}
    missed = [1 for a, b in zip(half.view(np.int64).tolist(), (half ^ flips).view(np.int64).tolist(), strict=True) if frozenset((a, b)) not in got]
    assert not missed, len(missed)


@pytest.mark.parametrize("options", [{}, {"block": 64, "deep": 1}])
def test_links_over_the_border_of_shards(spark, options):
    """One bit differs in each chunk, so that a pair meets only where a ball of one bit reaches another shard."""
    rng = np.random.default_rng(6)
    edges = np.linspace(0, 64, simhash.CHUNKS + 1).astype(int)
    assert sum(simhash.radii(4, simhash.CHUNKS)) == 1
    half = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    flips = sum(np.uint64(1) << rng.integers(s, e, len(half)).astype(np.uint64) for s, e in zip(edges, edges[1:], strict=False))
    df = spark.createDataFrame([(int(x),) for x in np.unique(np.concatenate([half, half ^ flips])).view(np.int64)], "fp long")
    got = {frozenset((r.u, r.v)) for r in simhash.links(df, **options).collect()}
    assert got == {frozenset(x) for x in zip(half.view(np.int64).tolist(), (half ^ flips).view(np.int64).tolist(), strict=True)}


@pytest.mark.parametrize(("most", "chunks"), [(4, 4), (4, 5), (3, 4), (8, 4), (0, 4), (2, 6)])
def test_radii_leave_no_pair_out(most, chunks):
    """The nearest that all chunks can stay beyond their radius is farther than `most`."""
    near = simhash.radii(most, chunks)
    assert sum(r + 1 for r in near) > most
