"""Signs of a decoding loop in generated text.

Token counts, runs of one token, repeated n-grams and compression ratios are worked out in one Arrow UDF over whole
texts: a batch's tokens become numbers, and for each n equality at distance n is one comparison of arrays.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType

from .text import TOKEN

# Fixed values of the classification.
LIMITS = {"same_token_run": 50, "ngram_span": 140, "entropy_repeats": 12, "entropy_span": 80, "entropy_compression": 0.25, "compression": 0.12, "compression_span": 35, "compression_tokens": 500, "char_run": 80, "leader_compression": 0.18}
NGRAM = StructType().add("repeats", IntegerType()).add("n", IntegerType()).add("span", IntegerType()).add("example", StringType())
SIGNS = StructType().add("token_count", IntegerType()).add("same_token_run", IntegerType()).add("ngram", NGRAM).add("compression", DoubleType()).add("char_run", IntegerType())
_SPACE = np.array([9, 10, 11, 12, 13, 32], np.uint32)
LEADERS = (".", "·", "—")
_TOKEN = re.compile(TOKEN, re.ASCII)  # as in the JVM, digits and white space are ASCII
LONGEST = 12


def loops(texts: list[list[str]], longest: int = LONGEST) -> tuple[list[tuple[int, int, int, str]], list[int]]:
    """For each list of tokens, (repeats, n, tokens covered, n-gram) of the n-gram whose repeats in a row cover most, of
    equals the shortest and first; and the longest run of one token."""
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), np.int64)
    size = np.array([len(t) for t in texts], np.int64)
    doc, first = np.repeat(np.arange(len(texts)), size), np.cumsum(size) - size
    best: list[tuple[int, int, int, str]] = [(0, 0, 0, "")] * len(texts)
    runs = np.minimum(size, 1)
    for n in range(1, min(longest, int(size.max(initial=0)) // 2) + 1):
        same = np.concatenate([[False], (ids[:-n] == ids[n:]) & (doc[:-n] == doc[n:]), [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        starts, stops = edge[::2], edge[1::2]
        if n == 1:
            np.maximum.at(runs, doc[starts], stops - starts + 1)
        # m places in a row make m // n + 1 repeats; the next one is looked for behind them
        free = 0
        for start, stop in zip(starts[stops - starts >= n].tolist(), stops[stops - starts >= n].tolist(), strict=True):
            start = max(start, free)
            repeats = (stop - start) // n + 1
            if repeats > 1:
                free, d = start + repeats * n, int(doc[start])
                if repeats * n > best[d][2]:
                    at = start - int(first[d])
                    best[d] = (repeats, n, repeats * n, " ".join(texts[d][at : at + n]))
    return best, runs.tolist()


def compression_ratio(text: str | None) -> float:
    raw = re.sub(r"\s+", " ", text or "").strip().encode(errors="ignore")
    return len(zlib.compress(raw)) / len(raw) if raw else 1.0


def char_run(text: str | None) -> int:
    """The longest run of ten or more of one character that is no ASCII white space, else 0."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) < 10:
        return 0
    edge = np.flatnonzero(np.concatenate([[True], points[1:] != points[:-1], [True]]))
    run = np.diff(edge)[~np.isin(points[edge[:-1]], _SPACE)]
    most = int(run.max(initial=0))
    return most if most >= 10 else 0


#: Rows of a batch of texts, and tokens that are held at a time beside those of one text.
ROWS, TOKENS = 500, 200_000


@F.pandas_udf(SIGNS)
def signs_of(text: pd.Series) -> pd.DataFrame:
    best, runs, counts, tokens, held = [], [], [], [], 0

    def judge() -> None:
        b, r = loops(tokens)
        best.extend(b)
        runs.extend(r)
        tokens.clear()

    for t in text:
        own = _TOKEN.findall(t) if t else []
        if tokens and held + len(own) > TOKENS:
            judge()
            held = 0
        tokens.append(own)
        counts.append(len(own))
        held += len(own)
    judge()
    ngram = [dict(zip(("repeats", "n", "span", "example"), x, strict=True)) for x in best]
    return pd.DataFrame({"token_count": counts, "same_token_run": runs, "ngram": ngram, "compression": [compression_ratio(t) for t in text], "char_run": [char_run(t) for t in text]})


def _bounded_batches(spark: SparkSession) -> None:
    """Batches hold whole texts, so they get few rows; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= ROWS:
        spark.conf.set(key, str(ROWS))


def analysed(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds token_count, char_count, same_token_run, ngram, compression, char_run and reasons."""
    _bounded_batches(df.sparkSession)
    whole = F.coalesce(text, F.lit(""))
    df = df.withColumn("signs", signs_of(text)).select(*(f"`{c}`" for c in df.columns), "signs.*", F.length(whole).alias("char_count"))
    x, col = LIMITS, F.col
    span, repeats = col("ngram.span"), col("ngram.repeats")
    signs = [
        (col("same_token_run") >= x["same_token_run"], "same_token_run"),
        (span >= x["ngram_span"], "repeated_ngram_span"),
        ((repeats >= x["entropy_repeats"]) & (span >= x["entropy_span"]) & (col("compression") <= x["entropy_compression"]), "low_entropy_repeated_ngram"),
        ((col("compression") <= x["compression"]) & (span >= x["compression_span"]) & (col("token_count") >= x["compression_tokens"]), "very_low_compression"),
        (col("char_run") >= x["char_run"], "char_run"),
    ]
    reasons = F.array_compact(F.array(*(F.when(sign, name) for sign, name in signs)))
    leader = col("ngram.example").isin(*LEADERS) & (span == col("same_token_run")) & (col("compression") > x["leader_compression"])
    return df.withColumn("reasons", F.when(leader, F.array().cast("array<string>")).otherwise(reasons))
