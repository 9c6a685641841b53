"""Text correctors as column expressions: Unicode repair, era rules, line filters."""

from __future__ import annotations

import functools
import math
import re
import sys
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.rules import ERAS, FOLDED, LIGATURES, MOJIBAKE, PAGE, RN_TO_M, apply_rules

#: A run of white space, as Unicode has it, and the four separators U+001C to U+001F.
SPACES = r"[\s\x1c-\x1f]+"
#: The same characters, one by one.
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def _replace_all(col: Column, pairs) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, col)


def fix_mojibake(col: Column) -> Column:
    """Repair UTF-8 read as Latin-1, pair by pair in order."""
    return _replace_all(col, MOJIBAKE)


def split_ligatures(col: Column) -> Column:
    return _replace_all(col, LIGATURES)


def fold_punctuation(col: Column) -> Column:
    """Typographic punctuation and spaces to ASCII; invisible characters go.

    All one-to-one and one-to-none entries are a single ``translate``; no entry's result is
    another's key, so their order does not matter.
    """
    single = sorted((p for p in FOLDED if len(p[1]) <= 1), key=lambda p: not p[1])
    many = [p for p in FOLDED if len(p[1]) > 1]
    return F.translate(_replace_all(col, many), "".join(a for a, _ in single), "".join(b for _, b in single))


def strip_controls(col: Column) -> Column:
    """Drop C0 (but tab, newline and return), DEL and C1 characters."""
    return F.regexp_replace(col, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", "")


def drop_garbage_runs(col: Column) -> Column:
    return F.regexp_replace(col, "[\ufffd\ufffe\uffff]{2,}", "")


@functools.cache
def unsettled_characters(form: str, gap: int = 96) -> str:
    """Ranges, for a character class, that hold all characters without which a text is in a form.

    Ranges less than ``gap`` apart are one, so that the class has some dozens of them.

    Those that the form changes, those that it may move (combining ones), and those that may
    join what stands before them: every character but the first of some decomposition, and the
    Korean vowels and finals.
    """
    found = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if 0xD800 <= code < 0xE000:
            continue
        if unicodedata.combining(c) or not unicodedata.is_normalized(form, c):
            found.add(code)
        parts = unicodedata.decomposition(c)
        if parts and "<" not in parts:
            found.update(int(x, 16) for x in parts.split()[1:])
    ordered = sorted(found)
    ends = [i for i in range(len(ordered)) if i + 1 == len(ordered) or ordered[i + 1] > ordered[i] + gap]
    starts = [0, *(i + 1 for i in ends[:-1])]
    return "".join(f"\\x{{{ordered[a]:x}}}-\\x{{{ordered[b]:x}}}" for a, b in zip(starts, ends))


@functools.cache
def unsettled_class(form: str, gap: int = 16) -> str:
    """A character class of the JVM for :func:`unsettled_characters`, in groups of neighbouring ranges.

    The JVM asks range after range; most characters lie outside all groups, or in one.
    """
    ranges = re.findall(r"\\x\{(\w+)\}-\\x\{(\w+)\}", unsettled_characters(form, gap))
    size = math.isqrt(len(ranges)) + 1
    groups = [ranges[i : i + size] for i in range(0, len(ranges), size)]
    told = lambda a, b: f"\\x{{{a}}}-\\x{{{b}}}"
    inner = "".join(f"[{told(g[0][0], g[-1][1])}&&[{''.join(told(*r) for r in g)}]]" for g in groups)
    return f"[{told(ranges[0][0], ranges[-1][1])}&&[{inner}]]"


def normal_form(col: Column, form: str = "NFC") -> Column:
    """A Unicode normal form. Only texts that hold a character it could change reach Python.

    ``col`` is read in several places; where it is dear to compute, make it a column first.
    """

    @F.pandas_udf("string")
    def normalise(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize(form, t))

    needs = col.rlike(unsettled_class(form))
    return F.when(needs, normalise(F.when(needs, col))).otherwise(col)


def fold_spaces(col: Column) -> Column:
    """Runs of white space other than newline, return and tab become one space."""
    return F.regexp_replace(col, r"(?U)[^\S\n\r\t]+", " ")


def repair_characters(col: Column) -> Column:
    """The Unicode stage up to the normal form."""
    for step in (fix_mojibake, split_ligatures, fold_punctuation, strip_controls, drop_garbage_runs):
        col = step(col)
    return col


def settle_characters(col: Column, form: str = "NFC") -> Column:
    """The Unicode stage from the normal form on."""
    return fold_spaces(normal_form(col, form))


def correct_unicode(col: Column, form: str = "NFC") -> Column:
    """The whole Unicode stage, in its fixed order.

    On a DataFrame, :func:`in_turn` with the two halves computes the first one only once.
    """
    return settle_characters(repair_characters(col), form)


def in_turn(df: DataFrame, name: str, of: str, *steps) -> DataFrame:
    """Add column ``name``: the steps over column ``of``, each of whose results is a column before the next."""
    for step in steps:
        df, of = df.withColumn(name, step(F.col(of))), name
    return df


def strip(col: Column) -> Column:
    """Strip white space of any kind from both ends."""
    return F.trim(col, F.lit(WHITE))


def collapse_blank(col: Column) -> Column:
    """Three or more newlines become two."""
    return F.regexp_replace(col, r"\n{3,}", "\n\n")


def drop_garbage_lines(col: Column, least: float = 0.25, short: int | None = 5) -> Column:
    """Drop lines with too few letters, unless (given ``short``) that few characters long.

    Blank lines become empty; a line that stays is not stripped.
    """

    def keeps(line: Column) -> Column:
        s = line["s"]
        kept = s == "" if short is None else F.length(s) <= short
        return kept | (F.length(F.regexp_replace(s, r"\P{L}+", "")) / F.length(s) >= least)

    # inside a lambda nothing is shared, so the stripped line is made once and kept beside the line
    lines = F.transform(F.split(col, "\n", -1), lambda line: F.struct(line.alias("line"), strip(line).alias("s")))
    return F.array_join(F.transform(F.filter(lines, keeps), lambda x: F.when(x["s"] == "", "").otherwise(x["line"])), "\n")


def correct_regex(col: Column, era: str = "general", fix_rn: bool = True) -> Column:
    """The regex stage of an era; an unknown era is general.

    ``fix_rn`` off leaves out the rule that also damages real words ("morning").
    """
    rules = ERAS.get(era, ERAS["general"])
    if not fix_rn:
        rules = tuple(r for r in rules if r != RN_TO_M)
    least = 0.20 if era == "historical" else 0.25
    return strip(collapse_blank(drop_garbage_lines(apply_rules(col, rules), least)))


def correct_page_text(col: Column) -> Column:
    """The correction of recognised page text: its own rules, no leave for short lines."""
    return strip(collapse_blank(drop_garbage_lines(apply_rules(col, PAGE), 0.25, None)))


def normalise_newlines(col: Column) -> Column:
    return F.regexp_replace(col, "\r\n?", "\n")


def python_round(col: Column, places: int = 1) -> Column:
    """Round half to even on the exact binary value, as Python does; NaN becomes null.

    The scaled value is the rounded product and its exact error, which falls out of splitting
    the number into two halves of 26 bits; the error decides where the product looks like a tie.
    """
    scale, splitter = float(10**places), float((1 << 27) + 1)
    v = col.cast("double")
    high = v * splitter - (v * splitter - v)
    low = v - high
    product = v * scale
    error = (high * scale - product) + low * scale
    below = F.floor(product).cast("double")
    past = product - below
    even = below % 2 == 0
    up = (past > 0.5) | ((past == 0.5) & ((error > 0) | ((error == 0) & ~even)))
    rounded = F.when(up, below + 1).otherwise(below) / scale
    # from here on products are no longer exact to a half; such numbers stay as they are
    return F.when(F.isnan(v), None).when(F.abs(v) < float(1 << 52) / scale, rounded).otherwise(v)


def text_stages(era: str = "historical", skip_regex: bool = False, text_col: str = "text"):
    """The built-in correction stages, in order, as DataFrame transforms."""

    def unicode_stage(df: DataFrame) -> DataFrame:
        return in_turn(df, text_col, text_col, repair_characters, settle_characters)

    def regex_stage(df: DataFrame) -> DataFrame:
        return df.withColumn(text_col, correct_regex(F.col(text_col), era))

    return [("unicode", unicode_stage)] + ([] if skip_regex else [("regex", regex_stage)])
