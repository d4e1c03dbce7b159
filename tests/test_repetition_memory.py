"""Signs of loops hold the tokens of a few texts at a time, not those of a batch."""

import tracemalloc

import pandas as pd

from folioloom.functions import repetition


def test_tokens_of_a_batch_are_not_held_at_once():
    texts = pd.Series([" ".join(f"w{k} {j}x" for j in range(125)) for k in range(4000)] + ["no end " * 60, None])
    tracemalloc.start()
    got = repetition.signs_of.func(texts)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 60e6
    assert got.token_count.tolist() == [500] * 4000 + [120, 0]
    assert (got.ngram[4000]["n"], got.ngram[4000]["repeats"], got.same_token_run[4000], got.ngram[4001]["span"]) == (2, 60, 1, 0)


def test_batches_are_small(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    repetition.analysed(spark.createDataFrame([("a",)], "text string"))
    assert 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
