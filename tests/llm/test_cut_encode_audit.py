"""Fill-in-middle, byte-level BPE and the divergence audit against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from folioloom.llm import byte_bpe, divergence, infilling
from folioloom.llm.queries import VOCABULARY

NAMES = "doc_id long, text string, lang string, source string, `row` string, ids int, output string, `n` int, `a.b` int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", 1, "mine", 2, 3) for r in rows], NAMES)


def random_texts(n, alphabet, most, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(most))) for _ in range(n)]


def utf8(texts):
    parts = [x.encode() for x in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)


# Fill-in-middle


def plain_infill(doc_id, text, seed="7", rate=100, spm=50, unit="line"):
    text = text or ""
    units = list(text) if unit == "char" else re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


CUT_ROWS = [(1, "one\ntwo\nthree\n"), (1, "one\ntwo\nthree\n"), (2, None), (3, ""), (None, "a\n\n\nb"), (4, "\n"), (5, "x<P>y"), (6, "ends <"), (7, "S>begins"), (8, "é\n日本\n\U0001f600 <\nM>"), (9, "line\n" * 40_000 + "end"), (-3, "a<S"), (10, "<M"), (11, "\r\n\r\n")]


@pytest.mark.parametrize(("rate", "spm", "unit"), [(100, 50, "line"), (60, 30, "char"), (0, 50, "line"), (100, 100, "line")])
def test_infill_is_the_plain_version_and_is_restored(spark, rate, spm, unit):
    rows = CUT_ROWS + [(100 + k, x) for k, x in enumerate(random_texts(300, "ab\n\n<PSM>é日", 40))]
    docs = frame(spark, [(*r, "en", "s") for r in rows])
    made = infilling.infill(docs, rate=rate, spm=spm, unit=unit)
    got = Counter((r.doc_id, r.units, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect())
    assert got == Counter((d, *plain_infill(d, t, "7", rate, spm, unit)) for d, t in rows)
    assert "a.b" in made.columns and "row" in made.columns
    back = Counter((r.doc_id, r.text) for r in infilling.restore(made).collect())
    assert back == Counter((d, t or "") for d, t in rows)


def test_infill_digest_and_empty_table(spark):
    out = {r.doc_id: r for r in infilling.infill_digest(frame(spark, [(*r, "en", "s") for r in CUT_ROWS])).collect()}
    for d, t in CUT_ROWS:
        n, form, before, middle, output = plain_infill(d, t)
        assert tuple(out[d])[1:] == (n, form, before, middle, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert infilling.infill_digest(frame(spark, [])).count() == 0


def test_restoring_needs_three_marks(spark):
    with pytest.raises(Exception, match="three marks"):
        infilling.restore(spark.createDataFrame([("<P>a<S>b", "psm")], "output string, form string")).collect()


# Byte-level BPE


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary(VOCABULARY)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


ODD = "'' strevmldll  \n\t\xa0　 a1é日́!?S9"


def same(vocabulary, library, texts):
    ids, offsets, tokens = byte_bpe.Encoder(vocabulary).batch(*utf8(texts))
    for k, text in enumerate(texts):
        own = ids[tokens[k] : tokens[k + 1]]
        assert own.tolist() == library.encode_ordinary(text), text
        data, before = byte_bpe.decoded(vocabulary, own, most=7)
        assert data.tobytes() == text.encode()
        assert offsets[tokens[k] : tokens[k + 1]].tolist() == before[:-1].tolist()


@pytest.mark.parametrize("seed", range(8))
def test_encoding_is_the_library_s(vocabulary, library, seed):
    same(vocabulary, library, random_texts(200, ODD, 40, seed))
    rnd = random.Random(seed)
    same(vocabulary, library, ["".join(chr(c) for c in (rnd.randrange(0x20, 0x110000) for _ in range(60)) if not 0xD800 <= c < 0xE000) for _ in range(50)])


def test_every_code_point_has_the_library_s_class(vocabulary, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    same(vocabulary, library, ["".join(f"{chr(c)}a {chr(c)}" for c in points[k : k + 5000]) for k in range(0, len(points), 5000)])


def test_long_slices_and_stretches(vocabulary, library, monkeypatch):
    same(vocabulary, library, ["a" * 5000, "".join(random_texts(1, "abcdefgh", 3000, 3)), "né" * 2000, " " * 3000 + "x", "\n" * 500, "", "x"])
    monkeypatch.setattr(byte_bpe, "STRETCH", 50)
    same(vocabulary, library, random_texts(60, ODD, 400, 5))
    monkeypatch.setattr(byte_bpe, "KEPT", 3)
    encoder = byte_bpe.Encoder(vocabulary)
    for text in random_texts(20, "ab cd ef", 60, 6):
        assert encoder.batch(*utf8([text]))[0].tolist() == library.encode_ordinary(text)


def test_scan_is_the_machine_run_step_by_step():
    symbols = np.random.default_rng(1).integers(0, 18, 5000)
    state, plain = byte_bpe.FREE, []
    for s in symbols.tolist():
        plain.append(state)
        state = byte_bpe.step(byte_bpe.FREE if s >= byte_bpe.FIRST else state, s % byte_bpe.FIRST)[0]
    assert byte_bpe.states_before(symbols.astype(np.uint16)).tolist() == plain


def test_encode_and_decode_frames(spark, library):
    rows = [(1, "Hello there, it's 2024!"), (1, "Hello there, it's 2024!"), (2, None), (3, ""), (None, "né À 日本 \x00 x"), (4, " ".join(f"word{k % 977}" for k in range(60_000)))]
    made = byte_bpe.encode(frame(spark, [(*r, "en", "s") for r in rows]), VOCABULARY)
    assert "a.b" in made.columns and made.columns.count("ids") == 1
    back = byte_bpe.decode(made, VOCABULARY)
    got = Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in back.collect())
    assert got == Counter((d, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for d, t in rows)
    digest = {r.doc_id: r for r in byte_bpe.encode_digest(frame(spark, [(*r, "en", "s") for r in rows]), VOCABULARY).collect()}
    for d, t in rows:
        ids = library.encode_ordinary(t or "")
        assert tuple(digest[d])[1:] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert byte_bpe.encode_digest(frame(spark, []), VOCABULARY).count() == 0


def test_unknown_ids_are_errors(spark):
    for ids in ([1, 60_000], [-1], [None, 5]):
        with pytest.raises(Exception, match="vocabulary|null"):
            byte_bpe.decode(spark.createDataFrame([(ids,)], "ids array<int>"), VOCABULARY).collect()


# Divergence


def plain_audit(rows, least, add=5, scale=10**9, most=50):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs, counts, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = term.findall((text or "").translate(lower))
        docs[lang].update(set(found))
        counts[lang, source].update(found)
        sources[lang].add(source)
    out = set()
    for lang, names in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def p(of, kept=kept):
            total = sum(of[t] for t in kept)
            return {t: 1 + scale * (of[t] + add) // (total + add * len(kept)) for t in kept}

        q = p(sum((counts[lang, s] for s in names), Counter()))
        own = {s: p(counts[lang, s]) for s in names}
        for s in names:
            pairs = [(sum(abs(own[s][t] - own[o][t]) for t in kept), o) for o in names if o != s]
            terms = [(own[s][t] - q[t], t) for t in kept if counts[lang, s][t] and own[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, most)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)}
    return out


def words(rnd, n):
    return " ".join(rnd.choice(["Alpha", "alpha", "beta2gamma", "né", "日本", "x'y", "Z", f"w{rnd.randrange(40)}v", "".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 4)))]) for _ in range(n))


@pytest.mark.parametrize(("least", "most", "seed"), [(1, 50, 1), (3, 4, 2), (2, 1, 3), (1000, 50, 4)])
def test_audit_is_the_plain_version(spark, least, most, seed):
    rnd = random.Random(seed)
    rows = [(k, rnd.choice([None, "", words(rnd, rnd.randrange(1, 30))]), rnd.choice(["en", "de", "", None]), rnd.choice(["a", "b", "c", "é", None, "a"])) for k in range(150)]
    rows += rows[:5] + [(900, "alpha beta " * 3000, "en", "a"), (901, "12 34", "xx", "only"), (902, None, "xx", "other"), (None, "lonely", "yy", None)]
    got = [tuple(r) for r in divergence.audit(frame(spark, rows), least=least, most=most).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain_audit(rows, least, most=most)


def test_audit_by_joins_that_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 3)
    rnd = random.Random(9)
    rows = [(k, words(rnd, 12), "en", rnd.choice("abcde")) for k in range(60)]
    assert {tuple(r) for r in divergence.audit(frame(spark, rows), least=2, most=5).collect()} == plain_audit(rows, 2, most=5)


def test_audit_of_nothing(spark):
    assert divergence.audit(frame(spark, [])).count() == 0


def test_probabilities_are_exact_beyond_longs(spark):
    n, total, v = 7_000_000_000_123, 90_000_000_000_456, 1_000_003
    df = spark.createDataFrame([(n, total, v)], "n long, total long, v long")
    assert df.select(divergence._p("n", "total", "v", 5, 10**9)).first()[0] == 1 + 10**9 * (n + 5) // (total + 5 * v)
