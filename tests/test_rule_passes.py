"""Passes of the rules over a text, and where a pattern begins."""

import random
import re

from vellum.functions import rules as R


def test_words_with_one_change_are_one_pass():
    changes = R.shared_changes(list(R.WORD_MISREADS))
    assert len(changes) <= 4
    rng = random.Random(3)
    words = [R.whole_word(r) for r in R.WORD_MISREADS] + ["tb", "e", "b", "rn", "li", "x", "é"]
    for _ in range(3000):
        text = want = "".join(rng.choice(words) + rng.choice(["", " ", ",", "_", "-", "\n"]) for _ in range(rng.randint(0, 9)))
        got = text
        for r in R.WORD_MISREADS:
            want = re.sub(r.pattern, r.replacement, want)
        for r in changes:
            got = re.sub(r.pattern, r.replacement, got)
        assert got == want, text


def test_words_that_only_gain_letters_and_chains_in_order_stay():
    gains = [R.Rule("x", r"\bwich\b", "which"), R.Rule("x", r"\btbe\b", "the")]
    assert R.shared_changes(gains) == R.joined_words(gains)
    chain = [R.Rule("x", r"\ba\b", "b"), R.Rule("x", r"\bb\b", "c")]
    assert R.shared_changes(chain) == chain


def test_patterns_begin_with_their_letters():
    led = [r for era in R.ERAS.values() for r in era if re.match(r"(\\b|\(\?<=.+\))\w", r.pattern) and not R.whole_word(r)]
    assert len(led) > 20
    for r in led:
        assert re.match(r"(\(\?U\))?\w", R.java_pattern(r.pattern)), r
    rng = random.Random(4)
    bits = ["I", "1", "0", "O", "rn", "vv", "v", "ii", "i", "|", "a", "B", "é", " ", "f", "he", "hat", "\n", "5", "seledl", "ed", "_", "u"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        for r in {r for era in R.ERAS.values() for r in era}:
            assert re.sub(R.literal_first(r.pattern), r.replacement, text) == re.sub(r.pattern, r.replacement, text), (r, text)
