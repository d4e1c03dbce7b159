"""Hidden losses over mapped layers, against numpy."""

import numpy as np
import pytest

from folioloom.functions.numeric import hidden_loss

TOKEN = "token int, batch int, layer int, hidden array<double>"


def test_mean_over_mapped_layers(spark):
    rng = np.random.default_rng(2)
    s = {(t, layer): rng.normal(size=6) for t in range(8) for layer in (0, 1, 5)}
    t = {(k, layer): rng.normal(size=6) for k in range(8) for layer in (0, 3)}
    s[2, 0] = np.zeros(6)
    mask = {k: int(k not in (1, 5)) for k in range(7)}  # token 7 has none
    layers = [(0, 0), (1, 3), (5, 3), (5, 3)]
    frame = lambda x: spark.createDataFrame([(k, k % 2, layer, v.tolist()) for (k, layer), v in x.items()], TOKEN)
    masks = spark.createDataFrame([(k, k % 2, m) for k, m in mask.items()], "token int, batch int, mask int")
    unit = lambda v: v / max(np.linalg.norm(v), 1e-12)
    kinds = {"normalized_mse": lambda a, b: ((unit(a) - unit(b)) ** 2).mean(), "cosine": lambda a, b: 1 - a @ b / max(np.linalg.norm(a), 1e-8) / max(np.linalg.norm(b), 1e-8)}
    for kind, f in kinds.items():
        for by, groups in (([], [range(8)]), (["batch"], [range(0, 8, 2), range(1, 8, 2)])):
            got = sorted(hidden_loss(frame(s), frame(t), layers, masks, kind, ["token", "batch"], by).collect(), key=lambda r: r[0] if by else 0)
            for row, tokens in zip(got, groups, strict=True):
                kept = [k for k in tokens if mask.get(k)]
                want = np.mean([np.mean([f(t[k, b], s[k, a]) for k in kept]) for a, b in layers])
                assert row.loss == pytest.approx(want)
    with pytest.raises(Exception, match="without a token: 1"):
        hidden_loss(frame(s), frame(t), [(0, 0), (9, 0)], masks, "cosine", ["token", "batch"]).collect()
    for bad in ({"layers": [], "kind": "cosine"}, {"layers": layers, "kind": "other"}):
        with pytest.raises(ValueError):
            hidden_loss(frame(s), frame(t), mask=masks, token=["token"], **bad)
