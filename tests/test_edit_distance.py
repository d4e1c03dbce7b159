"""Edit distances against the table of all prefixes."""

import random

import pytest
from pyspark.sql import functions as F

from folioloom.functions import edit_distance as E
from tests.test_whole_texts import distance


def pairs(seed, alphabet, n, most):
    rnd = random.Random(seed)
    text = lambda: "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(most)))
    out = []
    for _ in range(n):
        a = text()
        b = list(a)
        for _ in range(rnd.randrange(6)):  # near ones as well as any
            k = rnd.randrange(len(b) + 1)
            b[k : k + rnd.randrange(3)] = text()[: rnd.randrange(3)]
        out.append((a, "".join(b) if rnd.random() < 0.5 else text()))
    return out


@pytest.mark.parametrize(("alphabet", "most", "n"), [("ab", 12, 400), ("abcdé日\U0001f600", 200, 60), ("ab ", 400, 12), ("xyz\x00é", 66, 100)])
def test_distances_are_those_of_the_table(alphabet, most, n):
    both = pairs(most, alphabet, n, most) + [("", ""), ("", "x"), ("x", ""), ("a" * 64, "a" * 64 + "b"), ("a" * 65, "b" * 65), ("a" * 128, "ba" * 64)]
    left, right = zip(*both, strict=True)
    want = [distance(a, b) for a, b in both]
    assert E.distances(left, right).tolist() == want
    assert [E.distance_of_long(*sorted(x, key=len)) for x in both] == want


def test_long_texts_take_the_other_way_and_agree(monkeypatch):
    both = pairs(3, "abé", 6, 700)
    left, right = zip(*both, strict=True)
    want = E.distances(left, right).tolist()
    monkeypatch.setattr(E, "WORDS", 1)
    monkeypatch.setattr(E, "AT_ONCE", 10)
    assert E.distances(left, right).tolist() == want
    assert E.distances(["x" * 50_000 + "tail"], ["x" * 50_000 + "Tails"]).tolist() == [2]


def test_columns(spark):
    both = [*pairs(5, "abé日", 40, 90), (None, None), (None, "ab")]
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(both)], "k int, a string, b string")
    got = {r.k: r.d for r in rows.select("k", E.edit_distance(F.col("a"), F.col("b")).alias("d")).collect()}
    assert got == {k: distance(a or "", b or "") for k, (a, b) in enumerate(both)}
    builtin = rows.where("a IS NOT NULL").select(F.levenshtein("a", "b").alias("x"), E.edit_distance(F.col("a"), F.col("b")).alias("y"))
    assert builtin.where("x <> y").count() == 0
