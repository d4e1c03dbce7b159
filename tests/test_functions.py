import random

import pytest
from pyspark.sql import functions as F

from folioloom.functions import geometry, numeric, rewards, tables
from folioloom.functions import text as T
from folioloom.functions.repetition import analysed, loops
from folioloom.operators import select as S


def value(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


@pytest.mark.parametrize("label,clean", [(r"<|sn|>Let \( n \) be<|pn|> odd<|ln|>; then \$ n+2 \$ is\) too<<<change_line_token_wrap>>>.", "Let $n$ be odd; then $n+2$ is too."), (" 　 x\t\n", "x"), ("", "")])
def test_clean(spark, label, clean):
    assert value(spark, T.clean_label(F.lit(label))) == clean


@pytest.mark.parametrize("label,inner", [(r"\[ E = m c^2 \]", "E = m c^2"), (r"\[\frac{a}{b} <", r"\frac{a}{b} <"), ("$$ k $$", "k"), ("$w$", "w"), ("no formula", "no formula")])
def test_formula(spark, label, inner):
    assert value(spark, T.strip_formula_wrappers(F.lit(label))) == inner


@pytest.mark.parametrize("label,hint,kind", [(r"plain words and \(x\)", "", "text"), (r"\[ x \]", "", "formula"), ("a\tb\nc\td", "", "table"), ("x", "a table", "table"), ("x", "report_table_001", "text"), (None, None, "text")])
def test_classify(spark, label, hint, kind):
    assert value(spark, T.classify(F.lit(label).cast("string"), F.lit(hint).cast("string"))) == kind


def test_rewards(spark):
    f = lambda fn, p, g: value(spark, fn(F.lit(p).cast("string"), F.lit(g).cast("string")))
    assert f(rewards.truth_reward, "helo", "hello") == pytest.approx(0.8)
    assert f(rewards.truth_reward, "", "") == 1.0 and f(rewards.truth_reward, "x", "") == 0.0
    assert f(rewards.similarity, None, None) == 1.0
    assert f(rewards.similarity, "日本", "日") == pytest.approx(0.5)


def test_tables():
    html = '<table><tr><td rowspan="2">A</td><td colspan="2">a &amp; b</td></tr><tr><td>c</td><td></td></tr></table>'
    cells = tables.to_cells(html)
    assert cells == "<fcel>A<fcel>a & b<lcel><nl><ucel><fcel>c<ecel><nl>"
    assert tables.to_html(cells) == html
    assert tables.to_cells("") == "" and tables.to_cells(None) == ""
    assert tables.to_html("") == "<table></table>"
    assert tables.to_cells("<table><tr><td colspan='x'>q</td></tr></table>") == "<fcel>q<nl>"


def test_repeats(spark):
    assert loops([["a", "b"] * 3 + ["c"], ["x"] * 3, []]) == ([(3, 2, 6, "a b"), (3, 1, 3, "x"), (0, 0, 0, "")], [1, 3, 0])
    rows = {r.i: r for r in analysed(spark.createDataFrame([(1, "go " * 80), (2, None), (3, "+" * 90), (4, "a fine short text")], "i int, text string")).collect()}
    assert "same_token_run" in rows[1].reasons and rows[2].reasons == [] and "char_run" in rows[3].reasons and rows[4].reasons == []


def plain_loop(words, longest=12):
    best, run, longest_run = (0, 0, 0, ""), 0, 0
    for k, w in enumerate(words):
        run = run + 1 if k and w == words[k - 1] else 1
        longest_run = max(longest_run, run)
    for n in range(1, min(longest, len(words) // 2) + 1):
        i = 0
        while i + n <= len(words):
            times = 1
            while words[i + times * n : i + (times + 1) * n] == words[i : i + n]:
                times += 1
            if times > 1:
                if times * n > best[2]:
                    best = (times, n, times * n, " ".join(words[i : i + n]))
                i += times * n
            else:
                i += 1
    return best, longest_run


def test_repeats_of_many_lists_at_once():
    pick = random.Random(1)
    lists = [[pick.choice("abc"[: pick.randint(1, 3)]) for _ in range(pick.randint(0, 60))] for _ in range(500)]
    for k in range(0, 500, 25):
        assert list(zip(*loops(lists[k : k + 25]), strict=True)) == [plain_loop(w) for w in lists[k : k + 25]]


def test_geometry(spark):
    box = F.array(*(F.lit(x) for x in (0.0, 10.0, 999.9, 5000.0)))
    assert value(spark, geometry.box_text(box, F.lit(None).cast("string"), F.lit(90), F.lit(1000), F.lit(1000))) == "<|box_start|>0 10 999 1000<|box_end|><|ref_start|>unknown<|ref_end|><|rotate_right|>"
    assert value(spark, geometry.crop_box(F.array(*(F.lit(x) for x in (50.0, 5.0, 50.0, 900.0))), F.lit(40), F.lit(30))) == [39, 5, 40, 30]
    assert value(spark, geometry.scaled_if_normal(F.array(F.lit(0.5)), F.lit(10), F.lit(20))) == [0.0, 0.0, 1.0, 1.0]
    assert value(spark, geometry.aspect_ratio(F.lit(0), F.lit(3))) is None
    assert value(spark, S.image_problem(F.lit(300), F.lit(100), 3.0)) is None


def test_schedule(spark):
    rates = [numeric.warmup_hold_decay(F.lit(k), 10, 10, 10, 0.0, 1.0, 0.0) for k in (0, 5, 15, 25, 99)]
    assert [value(spark, r) for r in rates] == [0.0, 0.5, 1.0, 0.5, 0.0]


def test_media_tokens(spark):
    m = F.array(F.struct(F.lit("user").alias("role"), F.lit("<image>").alias("content")), F.struct(F.lit("assistant").alias("role"), F.lit("say <video>").alias("content")))
    got = value(spark, T.escape_media_tokens(m, "n1"))
    assert got[0].content == "<image>" and "<video>" not in got[1].content
    assert value(spark, T.restore_media_tokens(F.lit(got[1].content), "n1")) == "say <video>"
