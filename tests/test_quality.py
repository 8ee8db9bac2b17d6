"""Text-quality measures against a plain Python computation and hand-worked values."""

import math
import re
from collections import Counter

import pytest

from trustlens.functions.lexicons import LEXICON
from trustlens.functions.quality import char_entropy, text_quality_columns, with_text_quality

TEXTS = [
    "Rasanya lumayan, tempat bersih dan harga murah",
    "wqrtplkmn zzxcvbnhg mnbvcxqwr",
    "oooooooo eeeeeee iiiiii",
    "bcdfghjk lmnpqrst",
    "obstruabstri",
    "The quick brown fox jumps over a lazy dog 0123456789 !?@",
    "aab",
    "",
    "  \n ",
    None,
]


def measures(text):
    t = text or ""
    words = t.split()
    if not words:
        return 0.5, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0
    vowels = sum(ch in "aeiouAEIOU" for ch in t)
    consonants = sum(ch.isascii() and ch.isalpha() for ch in t) - vowels
    ratio = vowels / consonants if consonants else 0.0
    valid = sum(w.lower() in LEXICON for w in words) / len(words)
    mean = sum(map(len, words)) / len(words)
    entropy = -sum(n / len(t) * math.log2(n / len(t)) for n in Counter(t).values())
    repeated = sum(a == b and a.isalpha() for a, b in zip(t, t[1:], strict=False)) / len(t) if len(t) > 1 else 0.0
    cluster = sum(max(map(len, re.split("[^bcdfghjklmnpqrstvwxyz]", w.lower()))) for w in words) / len(words)
    flags = (ratio < 0.25 or ratio > 2.5, valid < 0.1, mean > 8, entropy > 4.5, repeated > 0.3, cluster > 4)
    pct = sum(w for w, f in zip((15, 30, 20, 10, 10, 15), flags, strict=True) if f)
    return ratio, valid, mean, entropy, repeated, cluster, pct / 100, int(pct > 40)


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    return df.withColumns(text_quality_columns("text")).orderBy("id").collect()


def test_against_plain_python(rows):
    for r in rows:
        got = (r.tq_vowel_ratio, r.tq_valid_word_ratio, r.tq_avg_word_length, r.tq_entropy,
               r.tq_repeated_ratio, r.tq_consonant_cluster, r.tq_gibberish_score, r.tq_is_gibberish)
        assert got == pytest.approx(measures(r.text), abs=1e-9), r.text


def test_every_flag_is_set_somewhere_and_not_everywhere(rows):
    for flag in ("tq_abnormal_vowel", "tq_low_valid_words", "tq_has_long_words", "tq_high_entropy",
                 "tq_has_repeated", "tq_long_consonant", "tq_is_gibberish"):
        assert {r[flag] for r in rows} == {0, 1}, flag


def test_worked_values(rows):
    r = rows[6]  # two vowels to one consonant, one repeat in three, H(1/3) = 0.9183
    assert (r.tq_vowel_ratio, r.tq_repeated_ratio) == (2.0, pytest.approx(1 / 3))
    assert r.tq_entropy == pytest.approx(0.9183, abs=1e-4)


def test_strict_thresholds(rows):
    assert rows[3].tq_avg_word_length == 8.0 and rows[3].tq_has_long_words == 0
    assert rows[4].tq_consonant_cluster == 4.0 and rows[4].tq_long_consonant == 0


def test_blank_rows(rows):
    # blank: score 0 by early return, although the low-valid-words flag is set
    for r in rows[7:]:
        assert (r.tq_vowel_ratio, r.tq_gibberish_score, r.tq_entropy, r.tq_low_valid_words) == (0.5, 0.0, 0.0, 1)


def test_entropy_of_many_distinct_characters(spark):
    texts = ["".join(chr(0x4E00 + i % 5000) for i in range(60_000)), "\U0001F600\U0001F600x\u0301\n\n", "$1\\1(.)", "z" * 200_000, "", " \n"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", char_entropy("t").alias("e")).collect()
    for r in rows:
        t = texts[r.i]
        want = -sum(n / len(t) * math.log2(n / len(t)) for n in Counter(t).values()) if t.strip() else 0.0
        assert r.e == pytest.approx(want, abs=1e-9)


def test_counts_run_once_and_treat_odd_characters_as_the_expressions_did(spark):
    texts = ["ini\x1cini ini", "a\x85ini ini", "\u212a\u212a X\u0130b", "\u3000INI\u00a0itu\u2028dan\u205f", "\U0001f600\U0001f600 bb", "x" * 3000, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = with_text_quality(df, "text").orderBy("id")
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    rows = out.collect()
    assert [round(r.tq_valid_word_ratio, 6) for r in rows] == [0.5, 0.5, 0, 1, 0, 0, 0]
    assert [round(r.tq_consonant_cluster, 6) for r in rows] == [1, 1, 1.5, 1, 1, 3000, 0]
    assert [round(r.tq_avg_word_length, 6) for r in rows] == [5, 4, 2.5, 3, 2, 3000, 0]
    assert [round(r.tq_entropy, 6) for r in rows][4:] == [1.521928, 0, 0]
    assert rows[2].tq_vowel_ratio == 0  # X, b


def test_repeated_letters_are_counted_with_the_characters(spark):
    texts = ["aab  11", "bb\u00e9\u00e9", "", "a", "aA", "\U00010428\U00010428\U0001f600\U0001f600", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    out = with_text_quality(df, "text").orderBy("id")
    assert "regexp_replace" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [round(r.tq_repeated_ratio, 6) for r in out.collect()] == [0.142857, 0.5, 0, 0, 0, 0.25, 0]
