"""Golden pairs, an independent model in Python, and properties of the text correctors."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from vellum.functions import rules as R
from vellum.functions import text as T


def apply(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["y"] for r in df.select("i", fn(F.col("t")).alias("y")).orderBy("i").collect()]


def rule(*rules):
    return lambda c: R.apply_rules(c, rules)


GOLDEN = [
    (rule(R.I_TO_L), [("heIIo", "heIIo"), ("heIlo", "hello"), ("aIbIc", "alblc"), ("éIa", "éIa"), ("I am", "I am")]),
    (rule(R.ONE_TO_L), [("1ike", "like"), ("1st", "lst"), ("1a", "1a"), ("é1ike", "é1ike"), ("a1ike", "a1ike")]),
    (rule(R.PIPE_TO_L), [("a|b|c", "alblc"), ("a| b", "a| b"), ("A|b", "Alb")]),
    (rule(R.ZERO_TO_UPPER), [("A0B0C", "AOBOC"), ("a0B", "a0B")]),
    (rule(R.ZERO_TO_LOWER), [("f0x", "fox"), ("F0x", "F0x")]),
    (rule(R.RN_TO_M), [("morning", "moming"), ("returned", "retumed"), ("journey", "joumey"), ("born", "born"), ("rna", "rna")]),
    (rule(R.VV_TO_W), [("avvay", "away"), ("vvay", "vvay"), ("avvvvb", "awwb")]),
    (rule(R.II_TO_U), [("iinder", "under"), ("iii", "ui"), ("skiing", "skiing")]),
    (rule(*R.WORD_MISREADS), [("tbe Tbe tbe.", "the The the."), ("étbe tbeir", "étbe their"), ("Decernber nurnber", "December number"), ("xtbe", "xtbe")]),
    (rule(R.SPACE_BEFORE), [("a ,b\n.c  !", "a,b.c!"), ("a ?", "a?")]),
    (rule(R.SPACE_AFTER), [("U.S.A www.x.com", "U. S. A www. x. com"), ("a.é 1.2", "a.é 1.2")]),
    (rule(R.DEHYPHENATE), [("well-\n  known a-b", "wellknown a-b"), ("x-\n\ny", "xy")]),
    (rule(R.COLLAPSE_WS), [("a  \t b\n\n", "a b\n\n")]),
    (rule(R.DOTS), [("a....b...", "a...b...")]),
    (rule(R.H_PUNCT_RUN), [("a .;: b", "a   b"), ("a.. b", "a.. b")]),
    (rule(R.H_GARBAGE), [("a\n. , ; : - | !\nb", "a\nb"), ("..........", "\n"), ("..........\n", "\n"), ("a\n......\nb", "a\n......\nb")]),
    (rule(*R.H_LONG_S), [("fhe f hat f\nhis", "the that this"), ("fhere", "fhere")]),
    (rule(R.H_SELECT), [("seledled seledlion seledl", "selected selection seledl")]),
    (rule(R.H_QUOTES), [('""a"""', '"a"')]),
    (rule(R.H_DASHES), [("a---b--c------", "a--b--c--")]),
    (rule(R.M_SCORE), [("1 - 2 - 3", "1-2 - 3"), ("4-\n5", "4-5")]),
    (rule(R.M_I_BETWEEN, R.M_I_BEFORE), [("2I3 I25 I5 aI25", "213 125 I5 aI25")]),
    (rule(R.M_O_TO_0), [("1O2O3", "10203"), ("O1", "O1")]),
    (rule(R.M_DOLLAR), [("$ 5 $  x", "$5 $  x")]),
    (rule(R.M_PERCENT), [("5 % 7%", "5% 7%")]),
    (rule(*R.MODERN_WORDS), [("govemment Governrnent", "government Government")]),
    (T.fix_mojibake, [("cafÃ© Ã x", "café àx"), ("â\u0080\u0099", "’"), ("â€™", "â€™"), ("ï¬\u0083", "ffi")]),
    (T.split_ligatures, [("ﬁ ﬄ œuvre Ĳ", "fi ffl oeuvre IJ")]),
    (T.fold_punctuation, [("“a”—b…​·•«» ", '"a"--b....-"" ')]),
    (T.strip_controls, [("a\x00b\tc\nd\re\x85\x7f", "ab\tc\nd\re")]),
    (T.drop_garbage_runs, [("a￾￿b￾", "ab￾")]),
    (T.normal_form, [("é é", "é é"), ("plain", "plain"), ("", "")]),
    (T.fold_spaces, [("a  b　 c\t\n", "a b c\t\n")]),
    (T.strip, [(" \n a b \t ", "a b"), (" ", "")]),
    (T.collapse_blank, [("a\n\n\n\nb\n\nc", "a\n\nb\n\nc")]),
    (T.drop_garbage_lines, [("ok line\n12 34 56 78\n1886\n  \n.-", "ok line\n1886\n\n.-"), ("\n", "\n")]),
    (lambda c: T.drop_garbage_lines(c, 0.25, None), [("abc\n1886\n", "abc\n")]),
    (T.normalise_newlines, [("a\r\nb\rc\n", "a\nb\nc\n")]),
    (T.correct_page_text, [("tbe  rnan\n\n\n\n1886\nvvord ", "the rnan\n\nvvord")]),
]


@pytest.mark.parametrize("n", range(len(GOLDEN)))
def test_golden(spark, n):
    fn, pairs = GOLDEN[n]
    assert apply(spark, fn, [a for a, _ in pairs]) == [b for _, b in pairs]


def model_regex(text, era):
    for r in R.ERAS.get(era, R.GENERAL):
        text = re.sub(r.pattern, r.replacement, text)
    least, out = (0.20 if era == "historical" else 0.25), []
    for line in text.split("\n"):
        s = line.strip()
        if not s:
            out.append("")
        elif sum(c.isalpha() for c in s) / len(s) >= least or len(s) <= 5:
            out.append(line)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip()


def model_unicode(text):
    for table in (R.MOJIBAKE, R.LIGATURES, R.FOLDED):
        for a, b in table:
            text = text.replace(a, b)
    text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", "", text)
    text = re.sub("[�￾￿]{2,}", "", text)
    return re.sub(r"[^\S\n\r\t]+", " ", unicodedata.normalize("NFC", text))


def fuzz(seed, n=1500):
    rng = random.Random(seed)
    bits = ["tbe", "a", "I", "l", "1", "0", "O", "rn", "vv", "ii", "|", " ", "  ", "\n", "\n\n\n", ".", ",", ";", "-", "-\n", "...", "'", '"', "$", "%", "5",
            "fhe", "f his", "é", "ü", "Ã©", "Ã ", "â\u0080\u0099", "ﬁ", "“", " ", " ", "​", "é", "\x01", "￾￿", "\t", "seledled", "Have", "govemment", "x"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("era", ["general", "historical", "modern", "unheard of"])
def test_eras_equal_an_independent_model(spark, era):
    texts = [model_unicode(t) for t in fuzz(len(era))]
    assert apply(spark, lambda c: T.correct_regex(c, era), texts) == [model_regex(t, era) for t in texts]


def test_unicode_equals_an_independent_model(spark):
    texts = fuzz(99)
    got = apply(spark, T.correct_unicode, texts)
    assert got == [model_unicode(t) for t in texts]
    assert not any(re.search(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", t) for t in got)


def test_no_three_newlines_remain(spark):
    assert not any("\n\n\n" in t for t in apply(spark, lambda c: T.correct_regex(c, "modern"), fuzz(5, 400)))


def test_the_damaging_rule_can_be_left_out(spark):
    assert apply(spark, lambda c: T.correct_regex(c, "general", fix_rn=False), ["good morning"]) == ["good morning"]


def test_nulls_stay(spark):
    assert apply(spark, lambda c: T.correct_regex(T.correct_unicode(c)), [None, ""]) == [None, ""]


def test_rounding_is_that_of_python(spark):
    rng = random.Random(8)
    values = [0.25, 0.35, 0.45, 87.25, 87.35, 0.05, 12.0, 99.95, -0.25, -0.35, 0.0, -7.0, 1e11 + 0.25, 1e300, float("inf"), 2.0**52 + 1]
    values += [rng.uniform(-100, 100) for _ in range(500)] + [rng.randint(-4000, 4000) / 40 for _ in range(500)] + [rng.randint(0, 10**6) / 20 for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, float("nan"), None])], "i int, v double")
    for places in (1, 2, 4):
        got = [r["r"] for r in df.select("i", T.python_round(F.col("v"), places).alias("r")).orderBy("i").collect()]
        assert got == [round(v, places) for v in values] + [None, None]


def test_rounding_stays_in_the_engine(spark):
    plan = spark.range(1).select(T.python_round(F.col("id") / 3))._jdf.queryExecution().toString()
    assert "Python" not in plan and "pandas" not in plan


def test_only_unsettled_texts_reach_python(spark):
    settled = ["plain", "été", "Привет, мир: йё", "中文字", "한국어", "ελληνικά ώ", "日本語です"]
    unsettled = ["e\u0301", "\u1100\u1161", "\u212b", "か\u3099", "क\u093c", "\uf900"]
    for form in ("NFC", "NFD", "NFKC", "NFKD"):
        texts = settled + unsettled + [chr(c) for c in range(0x80, 0x3500, 7)] + [f"a{chr(c)}" for c in range(0x300, 0x3200, 5)]
        assert apply(spark, lambda c, f=form: T.normal_form(c, f), texts) == [unicodedata.normalize(form, t) for t in texts]
    needs = re.compile("[" + re.sub(r"\\x\{(\w+)\}", lambda m: re.escape(chr(int(m[1], 16))), T.unsettled_characters("NFC")) + "]")
    assert not any(needs.search(t) for t in settled[:5]) and all(needs.search(t) for t in unsettled)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert all(needs.search(c) for c in every if not unicodedata.is_normalized("NFC", c))


def test_words_of_one_replacement_are_one_rule():
    joined = R.joined_words(list(R.WORD_MISREADS))
    assert len(joined) < len(set(R.WORD_MISREADS)) and sum(r.pattern.count("|") + 1 for r in joined) == len({r for r in R.WORD_MISREADS if R.whole_word(r) != r.replacement})
    chain = [R.Rule("x", r"\ba\b", "b"), R.Rule("x", r"\bb\b", "c")]
    assert R.joined_words(chain) == chain
