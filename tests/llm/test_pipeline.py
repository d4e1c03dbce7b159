"""The five stages one after the other against plain versions of each, on all that the one before kept."""

import numpy as np
import pytest

import corpus_pipeline
from folioloom.llm import decontaminate, mixing, quality

from .test_brute_force import SF, WORD, removed, slow_fingerprint


@pytest.fixture(scope="module")
def inputs(spark):
    docs = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    return docs, items


def plain(docs, items, good):
    docs = {i: x for i, x in docs.items() if i in good}
    fp = {i: slow_fingerprint(t) for i, (t, _) in docs.items()}
    left, out = sorted(docs), {}
    while left:  # one of each component, the least id
        first, seen, todo = left[0], set(), [left[0]]
        while todo:
            i = todo.pop()
            seen.add(i)
            todo += [j for j in left if j not in seen and j not in todo and (fp[i] ^ fp[j]).bit_count() <= 4]
        out[first] = docs[first]
        left = [i for i in left if i not in seen]
    ids = sorted(out)
    raw = [(out[i][0] or "").encode() for i in ids]
    kept = [np.frombuffer(t, np.uint8)[~g].tobytes().decode(errors="ignore") for t, g in zip(raw, removed(raw, 200), strict=True)]
    index = decontaminate.Index([(i, " ".join(t.lower().split()).encode()) for i, t in items if t])
    clean = {}
    for i, t in zip(ids, kept, strict=True):
        data = np.frombuffer(t.encode(), np.uint8)
        if not decontaminate.matches(index, data, np.array([0, len(data)])):
            clean[i] = (t, out[i][1])
    return clean


def test_stages_and_mix(spark, inputs):
    docs, items = inputs
    scores = quality.score_quality(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    want = plain(docs, items, {r.doc_id for r in scores.collect() if r.predicted})
    got = corpus_pipeline.run(spark, SF).collect()
    size = {i: len(WORD.findall(t)) for i, (t, _) in want.items()}
    sources = sorted({s for _, s in want.values()})
    total = [sum(size[i] for i, (_, s) in want.items() if s == x) for x in sources]
    target = mixing.water_fill(total, [(5, 2, 1)[k % 3] for k in range(len(sources))], sum(total), 3)
    words: dict[int, int] = {}
    for r in got:
        text = want[r.doc_id][0]
        assert text.startswith(r.text) and len(WORD.findall(r.text)) == r.mix_words and r.source == want[r.doc_id][1]
        words[r.doc_id] = words.get(r.doc_id, 0) + r.mix_words
    for x, t in zip(sources, target, strict=True):
        assert abs(sum(n for i, n in words.items() if want[i][1] == x) - t) <= 0.5
    for s, n, t in zip(sources, total, target, strict=True):
        whole = round(t) // n
        assert all(words.get(i, 0) >= whole * size[i] for i, (_, x) in want.items() if x == s)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "suffix_dedup", "decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for frame in (docs.limit(0), docs.limit(5)):
            out = stage(spark, frame, SF)
            assert out.columns == docs.columns and out.count() <= 5, name
