"""Cleaning, classification and parsing of label text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal those of existing datasets.
NEWLINE_TOKENS = ("<|ln|>", "<|pn|>", "<|sn|>", "<<<change_line_token_wrap>>>")
TABLE_HINT = r"(?i)\b(table|tabular|tbl|cell|row|column|col)\b"
LATEX_SIGNAL = r"\\[a-zA-Z]+|[_^{}]"
BOX_TOKEN = r"<\|box_start\|>(\d+)\s+(\d+)\s+(\d+)\s+(\d+)<\|box_end\|><\|ref_start\|>([^<]+)<\|ref_end\|>(<\|rotate_(?:up|right|down|left)\|>)?"
ROTATIONS = {"<|rotate_up|>": 0, "<|rotate_right|>": 90, "<|rotate_down|>": 180, "<|rotate_left|>": 270}
TASK_PHRASES = (("layout", "Layout Detection"), ("table", "Table Recognition"), ("formula", "Formula Recognition"), ("text", "Text Recognition"))
TOKEN = r"\\[A-Za-z]+|[A-Za-z]+|\d+(?:\.\d+)?|[\u4e00-\u9fff]|[^\s]"
MEDIA_TOKENS = ("<image>", "<video>")
DISPLAY = r"(?s)^\s*(?:\\\[(.*?)\\\]|\$\$(.*?)\$\$)\s*$"


#: All of Unicode's White_Space.
WHITE = "".join(map(chr, (*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)))


def py_strip(c: Column) -> Column:
    """Strips all Unicode white space; only the ends are looked at."""
    return F.btrim(c, F.lit(WHITE))


def filled(c: Column) -> Column:
    """Whether a text has anything but white space."""
    return F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def _any_of(c: Column, marks: str) -> Column:
    """Whether a text has one of the marks; cheaper than a pattern, and so asked first."""
    out = c.contains(marks[0])
    for mark in marks[1:]:
        out = out | c.contains(mark)
    return out


def clean_label(c: Column) -> Column:
    """Newline tokens go, inline formulas get dollar signs, stray wrappers go, ends are stripped."""
    whole = c
    for token in NEWLINE_TOKENS:
        c = F.replace(c, F.lit(token), F.lit(""))
    c = F.regexp_replace(c, r"(?Us)\\\(\s*(.*?)\s*\\\)", r"\$$1\$")
    c = F.regexp_replace(c, r"(?Us)\\\$\s*(.*?)\s*\\\$", r"\$$1\$")
    c = F.replace(F.replace(c, F.lit(r"\("), F.lit("")), F.lit(r"\)"), F.lit(""))
    # All that goes has one of these marks, which few texts have.
    return py_strip(F.when(_any_of(whole, "<\\"), c).otherwise(whole))


def strip_formula_wrappers(c: Column) -> Column:
    """The formula inside of display or inline wrappers; wrappers without a partner are peeled off too."""

    def inside(c: Column) -> Column:
        inner = py_strip(F.concat(F.regexp_extract(c, DISPLAY, 1), F.regexp_extract(c, DISPLAY, 2)))
        inline = c.startswith("$") & c.endswith("$") & (F.regexp_count(c, F.lit(r"\$")) == 2)
        peeled = c
        for pattern in (r"^\\\[", r"\\\]$", r"^\$\$", r"\$\$$"):
            peeled = F.when(peeled.rlike(pattern), py_strip(F.regexp_replace(peeled, pattern, ""))).otherwise(peeled)
        return F.when(c.rlike(DISPLAY), inner).when(inline, py_strip(F.substr(c, F.lit(2), F.length(c) - 2))).otherwise(py_strip(peeled))

    # The clean label is made once.
    return F.get(F.transform(F.array(clean_label(c)), inside), F.lit(0))


def is_standalone_formula(label: Column) -> Column:
    rest = F.regexp_replace(F.regexp_replace(label, r"\\\((.*?)\\\)", ""), DISPLAY, "")
    few_words = (F.regexp_count(rest, F.lit("[A-Za-z]{2,}")) <= 2) & (F.regexp_count(rest, F.lit(r"[\u4e00-\u9fff]")) == 0)
    return label.rlike(DISPLAY) | (_any_of(label, "\\_^{}") & label.rlike(LATEX_SIGNAL) & few_words)


def looks_like_table(label: Column) -> Column:
    lines = F.filter(F.split(label, r"\r\n|[\n\r]"), lambda x: py_strip(x) != "")
    count = lambda mark: F.aggregate(lines, F.lit(0), lambda n, x: n + F.regexp_count(x, F.lit(mark)))
    ruled = (F.size(lines) >= 2) & ((count("\t") >= 2) | (count(r"\|") >= 4))
    return (label.contains("<") & label.rlike("(?i)<table|<tr|<td")) | (_any_of(label, "\t|") & ruled)


def classify(label: Column, *hints: Column) -> Column:
    """table, formula or text; hints are metadata in which a word may tell of a table."""
    hinted = F.lit(False)
    for h in hints:
        hinted = hinted | F.coalesce(h.cast("string").rlike(TABLE_HINT), F.lit(False))
    judged = lambda clean: F.when(looks_like_table(clean), "table").when(is_standalone_formula(clean), "formula").otherwise("text")
    # The clean label is made once, for the rows that no hint decides.
    return F.when(hinted, "table").otherwise(F.get(F.transform(F.array(clean_label(F.coalesce(label, F.lit("")))), judged), F.lit(0)))


def detect_task(message: Column) -> Column:
    out = F.lit("text")
    for task, phrase in reversed(TASK_PHRASES):
        out = F.when(message.contains(phrase), task).otherwise(out)
    return out


def parse_answer(task: Column, answer: Column) -> Column:
    """An assistant's answer without the wrappers of its task."""
    c = py_strip(answer)
    cut = lambda n: py_strip(F.substr(c, F.lit(n + 1), F.greatest(F.length(c) - 2 * n, F.lit(0))))
    double, single = c.startswith("$$") & c.endswith("$$"), c.startswith("$") & c.endswith("$")
    return F.when((task == "formula") & double, cut(2)).when((task == "formula") & single, cut(1)).otherwise(c)


def parse_boxes(text: Column, width: Column, height: Column) -> Column:
    """Box tokens as structs of bbox in pixels, label, rotation and reading order."""
    group = [F.regexp_extract_all(text, F.lit(BOX_TOKEN), F.lit(k)) for k in range(1, 7)]
    zipped = F.arrays_zip(*(g.alias(f"g{k}") for k, g in enumerate(group)))
    pixel = lambda x, size: x.cast("int") * size / F.lit(1000.0)
    rotation = F.create_map(*(F.lit(x) for kv in ROTATIONS.items() for x in kv))

    def element(x: Column, i: Column) -> Column:
        box = F.array(pixel(x["g0"], width), pixel(x["g1"], height), pixel(x["g2"], width), pixel(x["g3"], height))
        turn = F.coalesce(F.try_element_at(rotation, x["g5"]), F.lit(0))
        return F.struct(box.alias("bbox"), x["g4"].alias("label"), turn.alias("rotation"), (i + 1).alias("reading_order"))

    return F.transform(zipped, element)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def longest_token_run(tokens: Column) -> Column:
    """Length of the longest run of one token."""
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(a: Column, x: Column) -> Column:
        run = F.when(x == a["last"], a["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

    return F.aggregate(tokens, start, step, lambda a: a["best"])


def count_placeholders(text: Column, token: str = "<image>") -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(token), F.lit("")))) / len(token)).cast("int")


def has_media_token(text: Column) -> Column:
    out = F.lit(False)
    for token in MEDIA_TOKENS:
        out = out | text.contains(token)
    return out


def escape_media_tokens(messages: Column, nonce: str) -> Column:
    """Media tokens of all but user messages as sentinels; restore_media_tokens undoes it."""

    def one(m: Column) -> Column:
        c = m["content"]
        for token in MEDIA_TOKENS:
            c = F.replace(c, F.lit(token), F.lit(f"<|literal_{token[1:-1]}_{nonce}|>"))
        return F.struct(m["role"].alias("role"), F.when(m["role"] == "user", m["content"]).otherwise(c).alias("content"))

    return F.transform(messages, one)


def restore_media_tokens(text: Column, nonce: str) -> Column:
    for token in MEDIA_TOKENS:
        text = F.replace(text, F.lit(f"<|literal_{token[1:-1]}_{nonce}|>"), F.lit(token))
    return text


def truncated(text: Column, limit: int) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substr(text, F.lit(1), F.lit(max(0, limit - 3))), F.lit("..."))).otherwise(text)


def extension(name: Column, default: str = ".png") -> Column:
    found = F.lower(F.regexp_extract(name, r"(\.[A-Za-z0-9]+)$", 1))
    return F.when(found == "", default).otherwise(found)


def relative_path_ok(path: Column) -> Column:
    return F.coalesce((path != "") & ~path.startswith("/") & ~F.array_contains(F.split(path, "/"), ".."), F.lit(False))


def as_list(value: Column, kind: str) -> Column:
    """An array of `kind`: null as none, an array as it is, any other value as the only one."""
    return F.coalesce(value if kind.startswith("array") else F.when(value.isNotNull(), F.array(value)), F.array().cast(kind if kind.startswith("array") else f"array<{kind}>"))


def ordered_unique(values: Column) -> Column:
    """The different values of an array, each where it first stands."""
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != "")))


def first_positive(*values: Column) -> Column:
    """The first value that is a whole number above 0, or can be read as one."""
    number = lambda v: v.cast("string").try_cast("double").try_cast("int")
    return F.coalesce(*(F.when(number(v) > 0, number(v)) for v in values))
