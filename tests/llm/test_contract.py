"""What the contract of the thin queries fixes."""

import tracemalloc

import numpy as np

from folioloom.llm.queries import QUERIES
from folioloom.llm.simhash import VantageTree

SCHEMA = "page_id long, url string, html string"


def test_each_url_rule_gives_the_word_of_the_contract(spark, tmp_path):
    urls = ["http://a.com/en/6", "http://example.com/en/7x", "http://a.net/de/1", "http://example.net/de/8", "http://example.net/de/7", "http://a.org/es/", "http://a.org/fr/", None]
    spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.rule, r.verdict) for r in QUERIES["op1_url_filter"](spark, str(tmp_path)).collect()}
    want = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("net/de/", "allow"), ("org/es/", "block"), (None, "allow"), (None, "allow")]
    assert [got[i] for i in range(len(urls))] == want


def test_routes_of_vantage_trees_take_little_of_the_driver():
    values = np.unique(np.random.default_rng(0).integers(0, 1 << 16, 20_000).astype(np.uint64))
    tree = VantageTree(values, 2)
    tracemalloc.start()
    first, leaf, home = tree.routes(16, 1)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 100e6
    own = leaf[home]
    for v in (0, 1, 777, 8191, 8192, 40_000, 65_535):
        assert leaf[first[v] : first[v + 1]].tolist() == sorted({own[v], *(own[v ^ (1 << b)] for b in range(16))})
