"""Queries over whole texts, which SQL can't follow, against plain Python on small tables."""

import re

import pytest

from folioloom.queries import QUERIES

SAME = "the same beginning of both texts, well beyond the first sixty-four characters: "
TURNS = [(1, 0, SAME + "yes", SAME + "no, not at all"), (2, 0, "日本語の本文", "日本の本"), (2, 2, "naïve café", "naive cafe"), (3, 0, "", "x"), (4, 2, "  same ", "same"), (5, 0, SAME * 9, SAME * 9 + "é")]
DOCS = [(1, "word " * 60 + r"<|sn|>then \( x^2 \) and \$ y \$ after <<<change_line_token_wrap>>>all"), (2, "日本 <|ln|>12,5 % \n\tend"), (3, ""), (4, r"open \( only"), (5, r"shut \) only " * 20)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("whole"))
    turns = [x for c, t, label, prediction in TURNS for x in ((c, t, "user", label), (c, t + 1, "assistant", prediction))]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{top}/conversations.parquet")
    spark.createDataFrame(DOCS, "doc_id long, text string").write.parquet(f"{top}/documents.parquet")
    return top


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def similarity(p, g):
    return max(0.0, 1 - distance(p, g) / max(len(p), len(g), 1))


def truth(p, g):
    return 1 - min(distance(p, g) / len(g), 1.0) if g else float(not p)


def test_rewards_of_whole_turns(spark, folder):
    got = {(r.conv_id, r.turn): (r.score, r.reward) for r in QUERIES["reward_score"](spark, folder).collect()}
    want = {(c, t): (pytest.approx(similarity(p, g), abs=1e-8), pytest.approx(truth(p, g), abs=1e-8)) for c, t, g, p in TURNS}
    assert got == want
    all_ = [similarity(p, g) for _, _, g, p in TURNS]
    (r,) = QUERIES["reward_summary"](spark, folder).collect()
    assert (r.n, r.least, r["mean"], r.most) == (len(all_), *(pytest.approx(x, abs=1e-8) for x in (min(all_), sum(all_) / len(all_), max(all_))))
    got = {r.id: r.score for r in QUERIES["score_predictions"](spark, folder).collect()}
    assert got == {f"{c}-{t}": pytest.approx(similarity(p.strip(), g.strip()), abs=1e-8) for c, t, g, p in TURNS}


def plain_clean(text):
    for token in ("<|ln|>", "<|pn|>", "<|sn|>", "<<<change_line_token_wrap>>>"):
        text = text.replace(token, "")
    text = re.sub(r"(?s)\\\(\s*(.*?)\s*\\\)", r"$\1$", text)
    text = re.sub(r"(?s)\\\$\s*(.*?)\s*\\\$", r"$\1$", text)
    return text.replace(r"\(", "").replace(r"\)", "").strip()


def test_clean_whole_texts(spark, folder):
    got = {r.doc_id: r.clean for r in QUERIES["clean_labels"](spark, folder).collect()}
    assert got == {i: plain_clean(r" <|ln|>\( a+b \)" + t + r"<|pn|>\(c\) \(") for i, t in DOCS}


def test_report_and_kinds_follow_the_text(spark, tmp_path):
    """Ids alone would give other rows: the loops, tables and formulas are in the texts."""
    prose = " ".join(f"word{k} of plain prose" for k in range(200))
    loop = " no end" * 75
    rows = [(1, prose, "web"), (2, prose + loop, "web"), (3, prose + " " + "ab " * 60, "web"), (4, prose + "!" * 90, "web"), (5, prose + "\nx\ty\nz\tw", "web"), (6, r"\[ x^2 \]", "web"), (7, r"x^2 + \alpha", "web"), (8, prose, "a table"), (9, None, "web"), (80, prose + " go on" * 80, "web"), (85, prose[:40], "web"), (91, prose, "web")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.span, set(r.reasons.split(";"))) for r in QUERIES["repetition_report"](spark, str(tmp_path)).collect()}
    assert {i: got[i][0] for i in got} == {2: 150, 3: 60, 4: 90, 80: 160}
    assert "repeated_ngram_span" in got[2][1] & got[80][1]
    assert "same_token_run" in got[3][1] and "char_run" in got[4][1]
    kinds = {r.kind: r.n for r in QUERIES["classify_text"](spark, str(tmp_path)).collect()}
    assert kinds == {"table": 4, "formula": 2, "text": 6}  # 1 and 91 end in a table; 5 holds one; the source of 8 tells
