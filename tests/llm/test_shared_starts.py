"""What windows of the language model share is worked out once, with the same results."""

import numpy as np

from folioloom.llm import attention_lm, common
from folioloom.llm.queries import VOCABULARY

CUT = attention_lm.Windows(attention_lm.ranks(VOCABULARY))
WORDS = [b"the", b"them", b"theme", b"themes", b"then", b"", b"x" * 60, b"x" * 59 + b"y", b"\x00", b"\x00\x00", b"the\x00"]


def test_starts_are_worked_out_once():
    windows = sorted(w for c in (0, 4) for t in WORDS for w in CUT.of(t, c))
    ids, row, place, target = attention_lm.padded(windows)
    size = np.array([len(i) for i, _ in windows])
    nodes = attention_lm.Nodes(ids, size)
    starts = {tuple(i[:k]) for i, _ in windows for k in range(1, len(i) + 1)}
    assert len(nodes.id) == len(starts) < sum(size) * 0.7
    assert len(nodes.node) == sum(map(len, starts))

    model = attention_lm.Model(CUT.n + 2 + attention_lm.CONTEXTS, CUT.n + 2)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    rng = np.random.default_rng(8)
    weight, got = rng.integers(1, 5, len(row)).astype(float), model.log_probs(ids, row, place, target)
    loss, g = model.gradients(ids, row, place, target, weight)
    want, sums = np.zeros(len(row)), {k: 0 for k in g}
    for r in range(len(ids)):  # each window by itself, which shares nothing
        own = row == r
        alone = (ids[r : r + 1, : size[r]], np.zeros(own.sum(), np.int64), place[own], target[own])
        want[own] = model.log_probs(*alone)
        for k, v in model.gradients(*alone, weight[own])[1].items():
            sums[k] = sums[k] + v * weight[own].sum() / weight.sum()
    assert np.allclose(got, want) and np.isclose(loss, -(want * weight).sum() / weight.sum())
    assert all(np.allclose(g[k], sums[k], atol=1e-9) for k in g)


def test_pieces_that_never_occur_share_an_output():
    tokens = [(t, c, 1) for t in WORDS[:6] for c in (0, 3)]
    model, known = attention_lm._fit(CUT, tokens, 30, 16, 3)
    assert model.p["U"].shape[1] == len(known) + 1 < 20
    whole, n = model.whole(), CUT.n + 2
    ids = np.array([[CUT.first_context, 40, 41]], np.int32)
    every = (np.repeat(ids, n, 0), np.arange(n), np.full(n, 2), np.arange(n))
    assert np.isclose(np.exp(model.log_probs(*every)).sum(), 1, atol=1e-4)
    assert np.allclose(model.log_probs(*every), whole.log_probs(*every), atol=1e-4)
    fitted = attention_lm.fit(CUT, tokens, 30, 16, 3)
    assert all(np.array_equal(v, fitted.p[k]) for k, v in whole.p.items())


def test_windows_of_all_lengths_in_order():
    pairs = [(t, c) for t in sorted([*WORDS, b"x" * 300, b"ab" * 7, b"qz" * 8]) for c in (0, 2)]
    lines, owner = attention_lm.lines_of(CUT, [t for t, _ in pairs], np.arange(len(pairs)), np.array([c for _, c in pairs]))
    want = [(i, w) for i, (t, c) in enumerate(pairs) for w in CUT.of(t, c)]
    assert owner.tolist() == [i for i, _ in want]
    for k, (_, (ids, target)) in enumerate(want):
        assert lines.line[k, : len(ids) + 1].tolist() == [*ids, target[-1]] and (lines.size[k], lines.targets[k]) == (len(ids), len(target))


def test_word_hashes_of_any_length():
    words = [b"a", b"", b"bc" * 9, b"d" * 140_000, b"\xff" * 300_000, *(f"w{i}".encode() for i in range(60_000)), b"a"]
    first, last, h = common.word_hashes(np.frombuffer(b" ".join(words), np.uint8))
    words = [w for w in words if w]
    assert (last - first).tolist() == [len(w) for w in words] and h[0] == h[-1] and len(set(h.tolist())) == len(words) - 1
    for i in (0, 1, 2, 3, 4, 50_000):
        v = 0
        for b in reversed(words[i]):
            v = (v * int(common._BASE) + b + 1) % 2**64
        v = (v ^ v >> 32) * int(common._MIX) % 2**64
        assert int(h[i]) == v ^ v >> 29
