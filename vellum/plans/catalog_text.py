"""Queries over single text rules and stages, on documents with injected noise.

Noise is SQL that both engines run, so both start from the same damaged text. Each query
returns, for each document, the hash and length of the corrected text and whether it changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions import rules as R
from vellum.functions import text as T
from vellum.plans.registry import query
from vellum.sources import files

#: What Python calls white space, for an engine whose classes are ASCII.
WS = r"\t\n\x0B\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
NOT_WORD = r"[^\p{L}\p{N}_]"


def _q(s: str) -> str:
    return s.replace("'", "''")


def sub(x: str, pattern: str, replacement: str, times: int = 1) -> str:
    for _ in range(times):
        x = f"regexp_replace({x}, '{_q(pattern)}', '{_q(replacement)}', 'g')"
    return x


def sub_word(x: str, word: str, replacement: str) -> str:
    return sub(x, rf"(^|{NOT_WORD}){word}($|{NOT_WORD})", rf"\1{replacement}\2", 2)


def replaced(x: str, *pairs: tuple[str, str]) -> str:
    for a, b in pairs:
        x = f"replace({x}, '{_q(a)}', '{_q(b)}')"
    return x


def sql_strip(x: str) -> str:
    return sub(x, rf"\A[{WS}]+|[{WS}]+\z", "")


def sql_garbage(x: str, least: float, short: int | None) -> str:
    s = sql_strip("l")
    exempt = "" if short is None else f" OR length({s}) <= {short}"
    letters = sub(s, r"\PL", "")
    keep = f"({s}) = '' OR length({letters})::DOUBLE / length({s}) >= {least}{exempt}"
    blank = f"CASE WHEN ({s}) = '' THEN '' ELSE l END"
    return f"array_to_string([{blank} for l in string_split({x}, chr(10)) if {keep}], chr(10))"


def sql_collapse(x: str) -> str:
    return sub(x, r"\n{3,}", "\n\n")


# --- one SQL expression for each rule -------------------------------------------------------

def _words_sql(x: str, rules) -> str:
    seen = set()
    for r in rules:
        word = r.pattern.replace("\\b", "")
        if word != r.replacement and r.pattern not in seen:
            x = sub_word(x, word, r.replacement)
        seen.add(r.pattern)
    return x


RULE_SQL = {
    R.I_TO_L: lambda x: sub(x, "([a-z])I([a-z])", r"\1l\2", 2),
    R.ONE_TO_L: lambda x: sub(x, f"(^|{NOT_WORD})1([a-z]{{2,}})", r"\1l\2"),
    R.PIPE_TO_L: lambda x: sub(x, r"([a-zA-Z])\|([a-zA-Z])", r"\1l\2", 2),
    R.ZERO_TO_UPPER: lambda x: sub(x, "([A-Z])0([A-Z])", r"\1O\2", 2),
    R.ZERO_TO_LOWER: lambda x: sub(x, "([a-z])0([a-z])", r"\1o\2", 2),
    R.RN_TO_M: lambda x: sub(x, "([a-z])rn([aeiouy])", r"\1m\2", 2),
    R.VV_TO_W: lambda x: sub(x, "([a-z])vv([a-z])", r"\1w\2", 2),
    R.II_TO_U: lambda x: sub(x, f"(^|{NOT_WORD})ii([a-z])", r"\1u\2"),
    R.SPACE_BEFORE: lambda x: sub(x, rf"[{WS}]+([.,;:!?])", r"\1"),
    R.SPACE_AFTER: lambda x: sub(x, "([.,;:!?])([A-Za-z])", r"\1 \2"),
    R.DEHYPHENATE: lambda x: sub(x, rf"-\n[{WS}]*", ""),
    R.COLLAPSE_WS: lambda x: sub(x, r"[ \t]{2,}", " "),
    R.DOTS: lambda x: sub(x, r"\.{4,}", "..."),
    R.H_PUNCT_RUN: lambda x: sub(x, "( )[.:;,]{2,}( )", r"\1 \2", 2),
    R.H_GARBAGE: lambda x: sub(x, rf"(?:\A|\n)[{WS}.,:;|!'\-]{{10,}}(?:\n|\z)", "\n"),
    R.H_SELECT: lambda x: sub(x, f"(^|{NOT_WORD})seledl(ed|ion|ing)", r"\1select\2"),
    R.H_QUOTES: lambda x: sub(x, '"{2,}', '"'),
    R.H_DASHES: lambda x: sub(x, "-{3,}", "--"),
    R.M_SCORE: lambda x: sub(x, rf"(\p{{Nd}})[{WS}]*-[{WS}]*(\p{{Nd}})", r"\1-\2"),
    R.M_I_BETWEEN: lambda x: sub(x, r"(\p{Nd})I(\p{Nd})", r"\1" + r"1\2", 2),
    R.M_I_BEFORE: lambda x: sub(x, rf"([{WS}])I(\p{{Nd}}{{2,}})", r"\1" + r"1\2"),
    R.M_O_TO_0: lambda x: sub(x, r"(\p{Nd})O(\p{Nd})", r"\1" + r"0\2", 2),
    R.M_DOLLAR: lambda x: sub(x, rf"\$[{WS}]+(\p{{Nd}})", r"$\1"),
    R.M_PERCENT: lambda x: sub(x, rf"(\p{{Nd}})[{WS}]+%", r"\1%"),
} | {
    r: lambda x, w=r.replacement[1:]: sub(x, rf"(^|{NOT_WORD})f[{WS}]?{w}($|{NOT_WORD})", rf"\1t{w}\2", 2)
    for r in R.H_LONG_S
}


def rules_sql(x: str, rules) -> str:
    seen = set()
    for r in rules:
        if r in RULE_SQL:
            x = RULE_SQL[r](x)
        else:
            word = r.pattern.replace("\\b", "")
            if word != r.replacement and r not in seen:
                x = sub_word(x, word, r.replacement)
            seen.add(r)
    return x


# --- noise ----------------------------------------------------------------------------------

def noise(*pairs: tuple[str, str], where: str | None = None, tail: str = "") -> str:
    x = replaced("text", *pairs)
    if where:
        x = f"CASE WHEN {where} THEN {x} ELSE text END"
    return f"concat({x}, '{_q(tail)}')" if tail else x


WORD_NOISE = noise(
    (" that ", " tbat "), (" the ", " tbe "), (" The ", " Tlie "), (" with ", " witb "), (" for ", " wilich "),
    tail=" Tbis, tbey bave nurnber Septernber; wbich otber Wben",
)
PUNCT_NOISE = noise((". ", " . "), (", ", ","), tail=" a ;b U.S.A www.x.com\n.end")
GARBAGE_TAIL = "\n......----''''\n12 34 56\n1886\n\n\n\n  \t \n- - - - - - - -\n...abc...\nend"
LETTER_NOISE = noise(
    ("ll", "lI"), ("oo", "0o"), ("m", "rn"), ("w", "vv"), ("of ", "iif "), tail=" 1ike a|b|c A0B 1st 0O 100"
)
MOJIBAKE_PAIRS = (("é", "Ã©"), ("ü", "Ã¼"), ("ö", "Ã¶"), ("ä", "Ã¤"), ("ñ", "Ã±"), ("ç", "Ã§"), ("è", "Ã¨"), ("à", "Ã "))
MODERN_TAIL = " 1 - 2 - 3 $ 5 7 % 1O1 2I3 I25 govemment Enviromnent managernent"
HISTORIC_TAIL = " fhe f hat fhis seledled seledling \"\"quoted\"\" --- ----- .. ;: end\n , . ; : - ' | ! . ,\nlast"


def text_query(name: str, noised: str, change, sql) -> None:
    """Register a query that applies ``change`` to noised text, and the SQL that must equal it.

    A tuple of changes is applied in turn, each over a column that holds the result of the one before.
    """
    steps = change if isinstance(change, tuple) else (change,)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = files.spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
        docs = texts.select("doc_id", F.expr(noised.replace("\\", "\\\\")).alias("x"))
        done = T.in_turn(docs, "y", "x", *steps)
        return done.select(
            "doc_id",
            F.sha2("y", 256).alias("text_sha256"),
            F.length("y").cast("long").alias("n_chars"),
            (F.col("x") != F.col("y")).alias("changed"),
        )

    query(
        name,
        f"""
WITH noised AS (SELECT doc_id, {noised} AS x FROM documents), done AS (SELECT doc_id, x, {sql("x")} AS y FROM noised)
SELECT doc_id, sha256(y) AS text_sha256, length(y)::BIGINT AS n_chars, x <> y AS changed FROM done
""",
    )(run)


def _rule(name: str, noised: str, *rules) -> None:
    text_query(name, noised, lambda c: R.apply_rules(c, rules), lambda x: rules_sql(x, rules))


# --- Unicode --------------------------------------------------------------------------------

def sql_mojibake(x: str) -> str:
    return replaced(x, *R.MOJIBAKE)


def sql_ligatures(x: str) -> str:
    return replaced(x, *R.LIGATURES)


def sql_fold(x: str) -> str:
    return replaced(x, *R.FOLDED)


def sql_controls(x: str) -> str:
    return sub(x, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]", "")


def sql_garbage_runs(x: str) -> str:
    return sub(x, r"[\x{fffd}\x{fffe}\x{ffff}]{2,}", "")


def sql_spaces(x: str) -> str:
    return sub(x, r"[\x0B\f \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+", " ")


def sql_unicode(x: str) -> str:
    for step in (sql_mojibake, sql_ligatures, sql_fold, sql_controls, sql_garbage_runs):
        x = step(x)
    return sql_spaces(f"nfc_normalize({x})")


UNI_TAIL = "â\u0080\u0099 â\u0080\u0094 Ã  Â£5 Â½ ï¬\u0081ne â€™"
text_query("uni_mojibake", noise(*MOJIBAKE_PAIRS, tail=UNI_TAIL), T.fix_mojibake, sql_mojibake)
text_query("uni_ligatures", noise(("fi", "ﬁ"), ("fl", "ﬂ"), ("ff", "ﬀ"), ("ae", "æ"), ("oe", "œ"), tail=" Œ Æ ĳ"), T.split_ligatures, sql_ligatures)
FOLD_NOISE = noise((" ", " "), (" and ", " — "), (",", "…"), (".", "”"), ("e", "e​"), tail="‘’‚“„«» – • · ­﻿")
text_query("uni_fold_punct", FOLD_NOISE, T.fold_punctuation, sql_fold)
text_query("uni_strip_ctrl", "replace(replace(text, 'e', concat('e', chr(1))), 'n', concat('n', chr(133)))", T.strip_controls, sql_controls)
text_query("uni_garbage_runs", noise(("e", "e￾￿"), ("a", "a￿")), T.drop_garbage_runs, sql_garbage_runs)
text_query("uni_nfc", noise(("é", "é"), ("ü", "ü"), ("ñ", "ñ")), T.normal_form, lambda x: f"nfc_normalize({x})")
text_query("uni_ws_fold", noise((" ", "  "), (".", ".  "), tail="\t 　x"), T.fold_spaces, sql_spaces)
STAGE_NOISE = noise(*MOJIBAKE_PAIRS[:4], ("fi", "ﬁ"), (", ", " — "), ("è", "è"), ("s ", "s​  "), tail=UNI_TAIL)
text_query("stage_unicode", STAGE_NOISE, (T.repair_characters, T.settle_characters), sql_unicode)

# --- era rules ------------------------------------------------------------------------------
_rule("rx_I_to_l", noise(("ll", "lI"), ("l", "I")), R.I_TO_L)
_rule("rx_1_to_l", noise((" l", " 1"), (" th", " 1th")), R.ONE_TO_L)
_rule("rx_pipe_to_l", noise(("l", "|"), tail=" a|b|c"), R.PIPE_TO_L)
_rule("rx_0_to_O", noise(("The", "TH0SE"), ("O", "A0B0C")), R.ZERO_TO_UPPER)
_rule("rx_0_to_o", noise(("o", "0")), R.ZERO_TO_LOWER)
_rule("rx_rn_to_m", noise(("m", "rn"), tail=" morning returned"), R.RN_TO_M)
_rule("rx_vv_to_w", noise(("w", "vv")), R.VV_TO_W)
_rule("rx_ii_to_u", noise((" u", " ii"), (" o", " ii"), tail=" iii"), R.II_TO_U)
_rule("rx_word_misreads", WORD_NOISE, *R.WORD_MISREADS)
_rule("rx_space_before_punct", PUNCT_NOISE, R.SPACE_BEFORE)
_rule("rx_space_after_punct", PUNCT_NOISE, R.SPACE_AFTER)
_rule("rx_dehyphenate", noise(("tion", "-\ntion"), ("ing", "-\n \ting")), R.DEHYPHENATE)
_rule("rx_collapse_ws", noise((" ", "  "), (".", ".\t\t")), R.COLLAPSE_WS)
_rule("rx_dots", noise((".", "....."), (",", "...")), R.DOTS)
_rule("rx_h_punct_run", noise((", ", " .;: "), tail=" .. ,, "), R.H_PUNCT_RUN)
_rule("rx_h_garbage_segment", noise((".\n", ".\n ,.;: -'|!.,\n"), tail=HISTORIC_TAIL), R.H_GARBAGE)
_rule("rx_h_long_s", noise((" the ", " fhe "), (" that ", " f\nhat "), (" this ", " fhis ")), *R.H_LONG_S)
_rule("rx_h_select", noise((" re", " seledled re"), tail=" seledlion seledl"), R.H_SELECT)
_rule("rx_h_quotes", noise((" the ", ' """the"" ')), R.H_QUOTES)
_rule("rx_h_dashes", noise((" and ", " ---- "), tail=" -- --- "), R.H_DASHES)
_rule("rx_m_score", noise((" and ", " 1 - 2 - 3 "), tail=" 4-\n5"), R.M_SCORE)
_rule("rx_m_I_to_1", noise((" and ", " 2I3I4 I25 I5 ")), R.M_I_BETWEEN, R.M_I_BEFORE)
_rule("rx_m_O_to_0", noise((" and ", " 1O2O3 ")), R.M_O_TO_0)
_rule("rx_m_dollar", noise((" and ", " $ 5 $  77 ")), R.M_DOLLAR)
_rule("rx_m_percent", noise((" and ", " 5 % 7\t% ")), R.M_PERCENT)
_rule("rx_m_words", noise((" and ", " govemment Enviromnent "), tail=MODERN_TAIL), *R.MODERN_WORDS)

# --- lines and whole stages -----------------------------------------------------------------
GARBAGE_NOISE = noise((".\n", ".\n12 34 56 ...\n1886\n  \n"), tail=GARBAGE_TAIL)
text_query("rx_garbage_lines", GARBAGE_NOISE, lambda c: T.drop_garbage_lines(c, 0.25), lambda x: sql_garbage(x, 0.25, 5))
text_query("ocr_garbage_lines", GARBAGE_NOISE, lambda c: T.drop_garbage_lines(c, 0.25, None), lambda x: sql_garbage(x, 0.25, None))
text_query("rx_collapse_blank", noise(("\n", "\n\n\n\n")), T.collapse_blank, sql_collapse)
text_query("rx_strip", "concat(chr(10), '  ', text, ' ', chr(9), chr(10))", T.strip, sql_strip)
text_query("norm_newlines", "replace(replace(text, chr(10), concat(chr(13), chr(10))), '. ', concat('.', chr(13)))", T.normalise_newlines, lambda x: sub(x, "\r\n?", "\n"))


def sql_regex(x: str, era: str) -> str:
    least = 0.20 if era == "historical" else 0.25
    return sql_strip(sql_collapse(sql_garbage(rules_sql(x, R.ERAS[era]), least, 5)))


def sql_page(x: str) -> str:
    return sql_strip(sql_collapse(sql_garbage(rules_sql(x, R.PAGE), 0.25, None)))


RX_NOISE = noise(
    (" that ", " tbat "), (" the ", " tbe "), ("ment", "rnent"), (". ", " . "), (", ", ","), ("tion", "-\ntion"),
    tail=" 1ike a|b" + MODERN_TAIL + HISTORIC_TAIL + GARBAGE_TAIL,
)
for _era in R.ERAS:
    text_query(f"stage_regex_{_era}", RX_NOISE, lambda c, e=_era: T.correct_regex(c, e), lambda x, e=_era: sql_regex(x, e))
text_query("stage_ocr_postprocess", RX_NOISE, T.correct_page_text, sql_page)
for _era in ("historical", "modern"):
    text_query(
        f"pipeline_skip_gpt_{_era}",
        RX_NOISE,
        (T.repair_characters, lambda c, e=_era: T.correct_regex(T.settle_characters(c), e)),
        lambda x, e=_era: sql_regex(sql_unicode(x), e),
    )
SLICE = (*R.WORD_MISREADS, R.SPACE_BEFORE, R.SPACE_AFTER, R.DEHYPHENATE, R.COLLAPSE_WS)
text_query(
    "slice_clean_lines",
    RX_NOISE,
    lambda c: T.strip(T.collapse_blank(T.drop_garbage_lines(R.apply_rules(c, SLICE)))),
    lambda x: sql_strip(sql_collapse(sql_garbage(rules_sql(x, SLICE), 0.25, 5))),
)
