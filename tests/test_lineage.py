"""Chains of checkpoints by doubled links."""

import pytest

from folioloom.operators import lineage


def links(spark, pairs):
    return spark.createDataFrame(pairs, "checkpoint_id string, parent_id string")


def found(df):
    return sorted((r.depth, r.id) for r in df.collect())


def test_a_chain_of_ten_thousand(spark):
    chain = links(spark, [(str(k), str(k - 1) if k else None) for k in range(10_000)])
    assert found(lineage.ancestors(chain, "9999")) == [(d, str(9999 - d)) for d in range(10_000)]
    assert found(lineage.descendants(chain, "5000")) == [(d, str(5000 + d)) for d in range(5000)]


def test_cycles_are_errors_where_they_are_met(spark):
    pairs = [("a", "b"), ("b", "a"), ("x", "a"), ("1", None), ("2", "1"), ("self", "self")]
    for start in ("a", "x", "self"):
        with pytest.raises(ValueError, match="cycle"):
            lineage.ancestors(links(spark, pairs), start)
    for start in ("a", "self"):
        with pytest.raises(ValueError, match="comes from itself"):
            lineage.descendants(links(spark, pairs), start)
    assert found(lineage.ancestors(links(spark, pairs), "2")) == [(0, "2"), (1, "1")]
    assert found(lineage.descendants(links(spark, pairs), "1")) == [(0, "1"), (1, "2")]


def test_trees_and_odd_rows(spark):
    pairs = [(str(k), str(k // 2) if k > 1 else None) for k in range(1, 64)] + [("7", "3"), (None, "1"), ("lost", "gone")]
    assert found(lineage.ancestors(links(spark, pairs), "45")) == [(0, "45"), (1, "22"), (2, "11"), (3, "5"), (4, "2"), (5, "1")]
    want = [(d, str(k)) for d in range(4) for k in range(7 << d, (7 << d) + (1 << d))]
    assert found(lineage.descendants(links(spark, pairs), "7")) == sorted(want)
    assert found(lineage.ancestors(links(spark, pairs), "lost")) == [(0, "lost"), (1, "gone")]
    assert found(lineage.descendants(links(spark, []), "x")) == [(0, "x")]


def test_several_parents(spark):
    pairs = [("d", "b"), ("d", "c"), ("b", "a"), ("c", "a")]
    assert found(lineage.ancestors(links(spark, pairs), "d")) == [(0, "d"), (1, "b"), (1, "c"), (2, "a")]
    assert found(lineage.descendants(links(spark, pairs), "a")) == [(0, "a"), (1, "b"), (1, "c"), (2, "d")]
    with pytest.raises(ValueError, match="cycle"):
        lineage.ancestors(links(spark, [*pairs, ("a", "d")]), "d")
