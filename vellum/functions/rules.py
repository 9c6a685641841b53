"""Rule tables of the correctors, and how a rule becomes a column expression."""

from __future__ import annotations

import os
import re
from functools import reduce
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """A pattern and a replacement in the notation of Python's ``re``."""

    name: str
    pattern: str
    replacement: str


# Mojibake sequences and what they stand for, in order.
MOJIBAKE = (
    ("\u00e2\u0080\u0099", "\u2019"),
    ("\u00e2\u0080\u009c", "\u201c"),
    ("\u00e2\u0080\u009d", "\u201d"),
    ("\u00e2\u0080\u0093", "\u2013"),
    ("\u00e2\u0080\u0094", "\u2014"),
    ("\u00e2\u0080\u00a6", "\u2026"),
    ("Ã©", "é"),
    ("Ã¨", "è"),
    ("Ã ", "à"),
    ("Ã¢", "â"),
    ("Ã®", "î"),
    ("Ã´", "ô"),
    ("Ã¼", "ü"),
    ("Ã¶", "ö"),
    ("Ã¤", "ä"),
    ("Ã±", "ñ"),
    ("Ã§", "ç"),
    ("Â£", "£"),
    ("Â§", "§"),
    ("Â°", "°"),
    ("Â½", "½"),
    ("Â¼", "¼"),
    ("Â¾", "¾"),
    ("ï¬\u0081", "fi"),
    ("ï¬\u0082", "fl"),
    ("ï¬\u0080", "ff"),
    ("ï¬\u0083", "ffi"),
    ("ï¬\u0084", "ffl"),
)

# Ligatures and their letters.
LIGATURES = (
    ("\ufb01", "fi"),
    ("\ufb02", "fl"),
    ("\ufb00", "ff"),
    ("\ufb03", "ffi"),
    ("\ufb04", "ffl"),
    ("\u0132", "IJ"),
    ("\u0133", "ij"),
    ("\u0152", "OE"),
    ("\u0153", "oe"),
    ("\u00c6", "AE"),
    ("\u00e6", "ae"),
)

# Punctuation and spaces folded to ASCII; an empty value deletes.
FOLDED = (
    ("\u2018", "'"),
    ("\u2019", "'"),
    ("\u201a", "'"),
    ("\u201c", '"'),
    ("\u201d", '"'),
    ("\u201e", '"'),
    ("\u2013", "-"),
    ("\u2014", "--"),
    ("\u2026", "..."),
    ("\u00a0", " "),
    ("\u2002", " "),
    ("\u2003", " "),
    ("\u2009", " "),
    ("\u200a", " "),
    ("\u200b", ""),
    ("\u200c", ""),
    ("\u200d", ""),
    ("\ufeff", ""),
    ("\u00ad", ""),
    ("\ufffd", ""),
    ("\u00b7", "."),
    ("\u2022", "-"),
    ("\u00ab", '"'),
    ("\u00bb", '"'),
)


# Whole words and their corrections, in order.
WORD_MISREADS = (
    Rule("word_misreads", r"\btbe\b", "the"),
    Rule("word_misreads", r"\bTbe\b", "The"),
    Rule("word_misreads", r"\btlie\b", "the"),
    Rule("word_misreads", r"\bTlie\b", "The"),
    Rule("word_misreads", r"\btbe\b", "the"),
    Rule("word_misreads", r"\bTbe\b", "The"),
    Rule("word_misreads", r"\bwbich\b", "which"),
    Rule("word_misreads", r"\bwliich\b", "which"),
    Rule("word_misreads", r"\bwilich\b", "which"),
    Rule("word_misreads", r"\btbat\b", "that"),
    Rule("word_misreads", r"\bTbat\b", "That"),
    Rule("word_misreads", r"\btbis\b", "this"),
    Rule("word_misreads", r"\bTbis\b", "This"),
    Rule("word_misreads", r"\bwitb\b", "with"),
    Rule("word_misreads", r"\bbave\b", "have"),
    Rule("word_misreads", r"\bHave\b", "Have"),
    Rule("word_misreads", r"\bwben\b", "when"),
    Rule("word_misreads", r"\bWben\b", "When"),
    Rule("word_misreads", r"\btben\b", "then"),
    Rule("word_misreads", r"\bTben\b", "Then"),
    Rule("word_misreads", r"\btbey\b", "they"),
    Rule("word_misreads", r"\bTbey\b", "They"),
    Rule("word_misreads", r"\btbeir\b", "their"),
    Rule("word_misreads", r"\bTbeir\b", "Their"),
    Rule("word_misreads", r"\botber\b", "other"),
    Rule("word_misreads", r"\bOtber\b", "Other"),
    Rule("word_misreads", r"\bafter\b", "after"),
    Rule("word_misreads", r"\bnurnber\b", "number"),
    Rule("word_misreads", r"\bmernber\b", "member"),
    Rule("word_misreads", r"\bSepternber\b", "September"),
    Rule("word_misreads", r"\bNovernber\b", "November"),
    Rule("word_misreads", r"\bDecernber\b", "December"),
)
MODERN_WORDS = (
    Rule("m_words", r"\bgovemment\b", "government"),
    Rule("m_words", r"\bGovemment\b", "Government"),
    Rule("m_words", r"\bmanagernent\b", "management"),
    Rule("m_words", r"\bManagernent\b", "Management"),
    Rule("m_words", r"\bdeveloprnent\b", "development"),
    Rule("m_words", r"\bDeveloprnent\b", "Development"),
    Rule("m_words", r"\benviromnent\b", "environment"),
    Rule("m_words", r"\bEnviromnent\b", "Environment"),
    Rule("m_words", r"\bgovernrnent\b", "government"),
    Rule("m_words", r"\bGovernrnent\b", "Government"),
)
PAGE_WORDS = (
    Rule("page_words", r"\bTlie\b", "The"),
    Rule("page_words", r"\btlie\b", "the"),
    Rule("page_words", r"\bTbe\b", "The"),
    Rule("page_words", r"\btbe\b", "the"),
    Rule("page_words", r"\bwbich\b", "which"),
    Rule("page_words", r"\bwliich\b", "which"),
)

# Rules on characters, by name.
I_TO_L = Rule("I_to_l", r"(?<=[a-z])I(?=[a-z])", "l")
ONE_TO_L = Rule("1_to_l", r"\b1(?=[a-z]{2,})", "l")
PIPE_TO_L = Rule("pipe_to_l", r"(?<=[a-zA-Z])\|(?=[a-zA-Z])", "l")
ZERO_TO_UPPER = Rule("0_to_O", r"(?<=[A-Z])0(?=[A-Z])", "O")
ZERO_TO_LOWER = Rule("0_to_o", r"(?<=[a-z])0(?=[a-z])", "o")
RN_TO_M = Rule("rn_to_m", r"(?<=[a-z])rn(?=[aeiouy])", "m")
VV_TO_W = Rule("vv_to_w", r"(?<=[a-z])vv(?=[a-z])", "w")
II_TO_U = Rule("ii_to_u", r"\bii(?=[a-z])", "u")
SPACE_BEFORE = Rule("space_before_punct", r"\s+([.,;:!?])", r"\1")
SPACE_AFTER = Rule("space_after_punct", r"([.,;:!?])(?=[A-Za-z])", r"\1 ")
DEHYPHENATE = Rule("dehyphenate", r"-\n\s*", "")
COLLAPSE_WS = Rule("collapse_ws", r"[ \t]{2,}", " ")
DOTS = Rule("dots", r"\.{4,}", "...")
H_PUNCT_RUN = Rule("h_punct_run", r"(?<= )[.:;,]{2,}(?= )", " ")
H_GARBAGE = Rule("h_garbage_segment", r"(?:^|\n)[\s.,:;|!'\-]{10,}(?:\n|$)", "\n")
H_LONG_S = (
    Rule("h_long_s", r"\bf\s?he\b", "the"),
    Rule("h_long_s", r"\bf\s?hat\b", "that"),
    Rule("h_long_s", r"\bf\s?his\b", "this"),
)
H_SELECT = Rule("h_select", r"\bseledl(?=ed|ion|ing)", "select")
H_QUOTES = Rule("h_quotes", r'"{2,}', '"')
H_DASHES = Rule("h_dashes", r"-{3,}", "--")
M_SCORE = Rule("m_score", r"(\d)\s*-\s*(\d)", r"\1-\2")
M_I_BETWEEN = Rule("m_I_to_1", r"(?<=\d)I(?=\d)", "1")
M_I_BEFORE = Rule("m_I_to_1", r"(?<=\s)I(?=\d{2,})", "1")
M_O_TO_0 = Rule("m_O_to_0", r"(?<=\d)O(?=\d)", "0")
M_DOLLAR = Rule("m_dollar", r"\$\s+(\d)", r"$\1")
M_PERCENT = Rule("m_percent", r"(\d)\s+%", r"\1%")

GENERAL = (
    I_TO_L, ONE_TO_L, PIPE_TO_L, ZERO_TO_UPPER, ZERO_TO_LOWER, RN_TO_M, VV_TO_W, II_TO_U,
    *WORD_MISREADS,
    SPACE_BEFORE, SPACE_AFTER, DEHYPHENATE, COLLAPSE_WS, DOTS,
)
HISTORICAL = (H_PUNCT_RUN, H_GARBAGE, *H_LONG_S, H_SELECT, H_QUOTES, H_DASHES)
MODERN = (M_SCORE, M_I_BETWEEN, M_I_BEFORE, M_O_TO_0, M_DOLLAR, M_PERCENT, *MODERN_WORDS)
PAGE = (
    I_TO_L, ONE_TO_L, ZERO_TO_UPPER, ZERO_TO_LOWER, RN_TO_M, *PAGE_WORDS,
    SPACE_BEFORE, SPACE_AFTER, DEHYPHENATE, COLLAPSE_WS,
)
ERAS = {"general": GENERAL, "historical": GENERAL + HISTORICAL, "modern": GENERAL + MODERN}


def literal_first(pattern: str) -> str:
    """The same pattern with its leading look-behind or word boundary told after the letters it leads to.

    An engine tries a pattern at every character. To compare one letter costs little there, to look
    behind or to ask for a word boundary much.
    """
    found = re.fullmatch(r"(\(\?<=(\[[^\]]*\]|\\[sd])\)|(\\b))((?:\w|\\\|)+)((?![?*+{]).*)", pattern, re.DOTALL)
    if not found:
        return pattern
    before, letters, rest = found[2] or found[3], found[4], found[5]
    return f"{letters}(?<={before}{letters}){rest}"


def java_pattern(pattern: str) -> str:
    """The pattern for the JVM: Unicode classes, and an end anchor that allows one last newline."""
    pattern = literal_first(re.sub(r"\$\)$", r"(?=\\n?\\z))", pattern))
    return "(?U)" + pattern if re.search(r"\\[sdwb]", pattern) else pattern


def java_replacement(replacement: str) -> str:
    return re.sub(r"\\(\d)", r"$\1", replacement.replace("$", "\\$"))


def apply_rule(col: Column, rule: Rule) -> Column:
    """Replace every match of a rule, from left to right."""
    return F.regexp_replace(col, F.lit(java_pattern(rule.pattern)), F.lit(java_replacement(rule.replacement)))


def whole_word(rule: Rule) -> str | None:
    """The word that a rule replaces, if it is a rule on one whole word."""
    found = re.fullmatch(r"\\b(\w+)\\b", rule.pattern)
    return found[1] if found else None


def joined_words(chain: list[Rule]) -> list[Rule]:
    """Rules on whole words, with those of one replacement joined into one pattern.

    A match is a whole word, and what replaces it is made of word characters, so no other word
    of the text begins or ends elsewhere. If moreover no replacement is itself a word that a
    rule of the chain replaces, every word meets one rule at most and their order is free; else
    the chain stays as it is.
    """
    chain = [r for r in dict.fromkeys(chain) if whole_word(r) != r.replacement]
    replaced = {whole_word(r) for r in chain}
    if len(replaced) < len(chain) or any(r.replacement in replaced or not re.fullmatch(r"\w+", r.replacement) for r in chain):
        return chain
    by_result: dict[str, list[str]] = {}
    for r in chain:
        by_result.setdefault(r.replacement, []).append(whole_word(r))
    return [Rule(chain[0].name, rf"\b(?:{'|'.join(w)})\b", to) for to, w in by_result.items()]


def shared_changes(chain: list[Rule]) -> list[Rule]:
    """Word rules whose order is free, with those that change the same letters joined into one pattern.

    "tbe" and "wbich" both turn a "b" into an "h": the letters before and behind it are looked at
    only where there is a "b", and one pass does for all such words. A chain whose order matters
    (see :func:`joined_words`) and a word that only gains letters stay as they are.
    """
    joined = joined_words(chain)
    by_change: dict[tuple[str, str], dict[str, list[str]]] = {}
    for r in joined:
        words = re.fullmatch(r"\\b\(\?:((?:\w|\|)+)\)\\b", r.pattern)
        if words is None:
            return joined
        for word in words[1].split("|"):
            head = os.path.commonprefix([word, r.replacement])
            tail = os.path.commonprefix([word[len(head) :][::-1], r.replacement[len(head) :][::-1]])[::-1]
            old, new = (x[len(head) : len(x) - len(tail)] for x in (word, r.replacement))
            if not old:
                return joined
            by_change.setdefault((old, new), {}).setdefault(head, []).append(tail)
    return [
        Rule(
            chain[0].name,
            old + "(?:" + "|".join(rf"(?<=\b{head}{old})(?=(?:{'|'.join(tails)})\b)" for head, tails in heads.items()) + ")",
            new,
        )
        for (old, new), heads in by_change.items()
    ]


def apply_rules(col: Column, rules: tuple[Rule, ...]) -> Column:
    """Each rule over the result of the one before; rules that cannot change anything are left out.

    A word rule that has occurred before in its row of word rules, and one that replaces a word
    by itself, change nothing.
    """
    for words, group in groupby(rules, key=lambda r: whole_word(r) is not None):
        chain = list(group)
        col = reduce(apply_rule, shared_changes(chain) if words else chain, col)
    return col
