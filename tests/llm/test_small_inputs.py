"""Nulls, empty tables, repeated rows, extra columns and very long texts in every operator."""

import random

import pytest
from pyspark.sql import functions as F

from folioloom.llm import attention_lm, decontaminate, langid, mixing, quality, simhash, suffix_dedup, syncmers, toxicity, url_filter
from folioloom.llm.queries import VOCABULARY

LONG = " ".join(f"word{i % 977} tail" for i in range(60_000))
ROWS = [(1, "Hello there, old friend.", "en", "a"), (1, "Hello there, old friend.", "en", "a"), (2, None, None, None), (3, "", "en", "b"), (None, "no id here", "de", "b"), (4, LONG, "en", "a"), (5, "12 34 !!", "fr", None), (6, "Hello there, old friend.", "en", "c"), (7, "né À 日本 \x00 x", "fr", "c")]
SCHEMA = "doc_id long, text string, lang string, source string, score string, x int, hits int"


@pytest.fixture(params=["rows", "empty"])
def docs(spark, request):
    rows = [(*r, "own", 1, 2) for r in ROWS] if request.param == "rows" else []
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 1), (5, None, None), (None, 1, 1), (6, 1, 0), (6, 1, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog and runs away from the farm"), (2, None), (None, "text without an id that is long enough to match"), (3, "short"), (3, "short"), (4, "")], "item_id long, text string")


def n(docs):
    return docs.count()


def test_every_row_gets_a_result(spark, docs, labels):
    for out in (mixing.plan_mix(docs), langid.identify(docs), suffix_dedup.dedup_digest(docs), syncmers.fingerprint_with_edits(docs), attention_lm.score_texts(docs, VOCABULARY, steps=3), simhash.near_duplicates(docs), toxicity.score_toxicity(docs, labels), quality.score_quality(docs, labels)):
        rows = out.collect()
        assert len(rows) == n(docs), out.columns
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in docs.collect())


def test_no_labels_no_benchmark(spark, docs, labels, benchmark):
    none = labels.limit(0)
    assert quality.score_quality(docs, none).count() == n(docs)
    assert toxicity.score_toxicity(docs, none).where(F.col("score") != 0).count() == 0
    assert decontaminate.find(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.find(docs, benchmark).count() == 0


def test_stages_keep_columns(spark, docs, labels, benchmark):
    for out in (quality.keep_good(docs, labels), simhash.keep_one(docs), suffix_dedup.without_repeats(docs), decontaminate.keep_clean(docs, benchmark)):
        assert out.columns == docs.columns
        assert out.count() <= n(docs)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "mix_shard", "mix_pass", "mix_order", "mix_words"]
    mixed.collect()


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame([(*r, "own", 1, 2) for r in ROWS], SCHEMA)
    kept = [r.doc_id for r in simhash.keep_one(docs).collect()]
    assert kept.count(1) == 1 and 6 not in kept and 4 in kept
    assert (2 in kept) != (3 in kept)  # both are empty


def test_each_component_keeps_one_row(spark):
    """Ids that are null or repeat with other texts: a row goes only if its own component has a lesser one."""
    text = [" ".join(f"{w}{k}" for k in range(40)) for w in ("apple", "brick", "cloud", "drum")]
    rows = [(None, text[0]), (5, text[0]), (None, text[1]), (None, text[2]), (None, text[2]), (7, text[3]), (7, "entirely other words " + text[1][::-1]), (6, text[3]), (8, "one more"), (8, "and another text"), (8, "one more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()), key=str)
    want = [(5, text[0]), (None, text[1]), (None, text[2]), (6, text[3]), rows[6], rows[8], rows[9]]
    assert kept == sorted(want, key=str)


def test_one_row_of_each_and_clashing_names(spark):
    rows = [(1, "one two three four five", 1), (1, "one two three four five", 1), (1, "one two three four five", 2), (None, None, 3), (2, "", 4), (3, "six seven eight", 5)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, digest int, row string, rest string")
    got = sorted((r.doc_id, r.digest) for r in simhash.keep_one(docs).collect())
    assert [d for d, _ in got] == [1, 2, 3] and got[0][1] in (1, 2)
    assert simhash.keep_one(docs).columns == docs.columns
    empty = simhash.keep_one(docs.limit(0))
    assert empty.count() == 0


def test_undetermined_language(spark):
    docs = spark.createDataFrame([(*r, "own", 1, 2) for r in ROWS], SCHEMA)
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert {k for k, r in got.items() if r.lang_pred == "und"} == {2, 3, 5}


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://Example.COM:80/En/?q#f", "http://a.b.example.com/en/7x", "http://example.com/en/6", "http://xexample.net/de/8", "ftp://net", "http://net/de/", "http://[::1]/x", "http://é.org/es/ü"]
    rules = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "block"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
    df = spark.createDataFrame([(i, u, "x", "y", "z") for i, u in enumerate(urls)], "page_id int, url string, host string, _host string, row string")
    by_trie = {r.page_id: r for r in url_filter.judge_urls(df, [*rules, (None, "/", "block")]).collect()}
    by_nodes = {r.page_id: r for r in url_filter.judge_urls(df, rules, broadcast_chars=0).collect()}
    assert by_trie == by_nodes and by_trie[0]._host == "y" and by_trie[0].row == "z"
    assert [(by_trie[i].rule, by_trie[i].verdict) for i in (0, 4, 5, 6, 7, 8, 9, 11)] == [(None, "allow"), (None, "allow"), ("example.com/en/7", "allow"), ("com/en/", "block"), ("net/de/", "block"), (None, "allow"), ("net/de/", "block"), ("org/es/", "block")]
    assert (by_trie[4].host, by_trie[4].path) == ("example.com:80", "/En/") and by_trie[0].host == ""
    for many in (url_filter.BROADCAST_CHARS, 0):
        with pytest.raises(Exception, match="neither allow nor block|is neither"):
            url_filter.judge_urls(df, [("com", "/", "maybe")], broadcast_chars=many).collect()
        assert url_filter.judge_urls(df.limit(0), rules, broadcast_chars=many).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_both_forms_of_the_trie(spark, seed):
    rng = random.Random(seed)
    pick = lambda: ".".join(rng.choice("abc") for _ in range(rng.randrange(0, 4)))
    path = lambda: "".join(rng.choice(["/", "x", "xy", "/x/", "é"]) for _ in range(rng.randrange(0, 5)))
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((pick(), path()) for _ in range(60))}.values())
    urls = [f"http://{pick()}/{path()}" for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(df, rules).collect()}
    assert got == {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(df, rules, broadcast_chars=0).collect()}
    for i, u in enumerate(urls):
        host, _, rest = u[7:].partition("/")
        fits = [((len(h.split(".")) if h else 0, len(p)), h + p, v) for h, p, v in rules if ("." + host).endswith("." + h if h else "") and ("/" + rest).startswith(p)]
        assert got[i] == (max(fits)[1:] if fits else (None, "allow"))


def test_a_long_text_drops_no_other_label(spark):
    from folioloom.llm.common import labelled_texts

    sizes = {k: 40_000 if k % 3 == 0 else 100 for k in range(60)}
    docs = spark.createDataFrame([(k, "x" * n) for k, n in sizes.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in sizes], "doc_id long, quality int")
    got = {r.doc_id for r in labelled_texts(docs, labels, "quality", 60, 30_000).collect()}
    assert got == {k for k, n in sizes.items() if n == 100}
    assert labelled_texts(docs, labels, "quality", 60, 50).count() == 0
