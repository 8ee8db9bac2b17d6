"""Text-quality measures (D1-D14) as column expressions.

The counts behind the measures come from one Arrow function, which walks the
characters of a batch as arrays inside the executors' projection: no explode, no
shuffle. Costs are linear in the text length, whatever characters are used.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from trustlens.functions.lexicons import CONSONANTS, LEXICON, VOWELS
from trustlens.functions.text import col_of, is_blank

# --- fixed values: thresholds and weights of the gibberish score -------------
VOWEL_RATIO_MIN = 0.25
VOWEL_RATIO_MAX = 2.5
VALID_WORD_MIN = 0.1
LONG_WORD_MEAN = 8
ENTROPY_MAX = 4.5
REPEATED_MAX = 0.3
CLUSTER_MAX = 4
# weights in hundredths: abnormal vowel, low valid words, long words,
# high entropy, repeated characters, long consonant clusters
WEIGHTS_PCT = (15, 30, 20, 10, 10, 15)
GIBBERISH_FLAG_PCT = 40  # score > 0.40

# --- fixed values: blanks as in ``text.WS``, and those that only str.split() knows
BLANKS = "\t\n\x0b\f\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT_ONLY = "\x1c\x1d\x1e\x1f\x85"
LOWER_TO_CONSONANT = "\u212a"  # the Kelvin sign's lower case is k
VOWEL, CONSONANT, BLANK, RUN = 1, 2, 4, 8
CHUNK_CHARS = 1 << 20  # characters walked at once; a longer text goes alone


def _text(c):
    return F.coalesce(col_of(c), F.lit(""))


def _kinds() -> np.ndarray:
    """The kinds (bits) of every code point."""
    kinds = np.zeros(0x110000, np.uint8)
    for chars, kind in ((VOWELS, VOWEL), (CONSONANTS, CONSONANT), (BLANKS, BLANK), (CONSONANTS + LOWER_TO_CONSONANT, RUN)):
        kinds[[ord(ch) for ch in chars]] |= kind
    return kinds


def _starts(of: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where a run of true places begins; runs never cross the first place of a text."""
    out = of.copy()
    out[1:] &= ~of[:-1]
    out[first] = of[first]
    return out


def _within(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True places of each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[ends] - total[starts]


def count_texts(texts: list[str], lexicon: frozenset[str], table: np.ndarray) -> list[np.ndarray]:
    """Per text: vowels, consonants, words, characters in words, words of the lexicon in
    lower case, the sum over words of the longest consonant run, entropy in bits, letters
    that the same letter follows."""
    size = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    kinds, first = table[codes], starts[size > 0]
    letters = np.bincount(codes)
    used = np.flatnonzero(letters)
    letters[used] = np.arange(len(used))  # the place of each character among those used
    places = letters[codes]
    letter = np.array([unicodedata.category(chr(ch))[0] == "L" for ch in used], bool)
    again = np.zeros(len(codes), bool)
    again[:-1] = (codes[1:] == codes[:-1]) & letter[places[:-1]]
    again[ends[size > 0] - 1] = False  # the next letter is another text's
    entropy = np.zeros(len(texts))
    for i in np.flatnonzero(size):
        own = places[starts[i]:ends[i]]
        n = np.bincount(own) if len(own) >= len(used) else np.unique(own, return_counts=True)[1]
        share = n[n > 0] / len(own)
        entropy[i] = -(share * np.log2(share)).sum()
    solid = kinds & BLANK == 0
    words = _starts(solid, first)
    run = kinds & RUN != 0
    begins = np.flatnonzero(_starts(run, first))
    last = np.zeros(len(codes), bool)
    last[first - 1] = True  # the last place of each text, that of the last one at -1
    stops = np.flatnonzero(run & (last | ~np.concatenate([run[1:], [False]])))
    longest = np.zeros(len(texts), np.int64)
    if len(begins):
        word = np.cumsum(words)[begins]
        heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        total = np.concatenate([[0], np.cumsum(np.maximum.reduceat(stops - begins + 1, heads))])
        longest = total[np.searchsorted(begins[heads], ends)] - total[np.searchsorted(begins[heads], starts)]
    if np.isin(used, [ord(ch) for ch in SPLIT_ONLY]).any():
        cut = re.compile(f"[{BLANKS}]+").split
    else:
        cut = str.split
    hits = [sum(w in lexicon for w in cut(t.lower())) for t in texts]
    return [_within(kinds & VOWEL != 0, starts, ends), _within(kinds & CONSONANT != 0, starts, ends), _within(words, starts, ends),
            _within(solid, starts, ends), np.array(hits, np.int64), longest, entropy,
            _within(again, starts, ends)]


COUNTS = ("vowels", "consonants", "words", "chars", "hits", "clusters", "entropy", "repeats")


def text_counts(c: Column | str, lexicon=LEXICON) -> Column:
    """``count_texts`` as a struct column; null counts as ''."""
    lex = frozenset(w for w in lexicon if w)
    types = [pa.int64()] * 6 + [pa.float64(), pa.int64()]

    def run(texts: pa.Array) -> pa.Array:
        own = [b.decode("utf-8", "replace") for b in texts.cast(pa.binary()).to_pylist()]
        parts, chunk, size, table = [], [], 0, _kinds()
        for t in own:
            if chunk and size + len(t) > CHUNK_CHARS:
                parts.append(count_texts(chunk, lex, table))
                chunk, size = [], 0
            chunk.append(t)
            size += len(t)
        parts.append(count_texts(chunk, lex, table))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(x), kind) for x, kind in zip(zip(*parts), types, strict=True)], names=list(COUNTS))

    return F.arrow_udf(run, "vowels long, consonants long, words long, chars long, hits long, clusters long, entropy double, repeats long")(_text(c))


def vowel_ratio(c: Column | str, counts: Column | None = None) -> Column:
    """Vowels / consonants; 0.5 for blank text, 0 without consonants."""
    n = text_counts(c) if counts is None else counts
    return (F.when(is_blank(c), F.lit(0.5))
            .when(n["consonants"] == 0, F.lit(0.0))
            .otherwise(n["vowels"].cast("double") / n["consonants"]))


def abnormal_vowel(ratio: Column) -> Column:
    """D2 from a D1 column."""
    return ((ratio < VOWEL_RATIO_MIN) | (ratio > VOWEL_RATIO_MAX)).cast("int")


def _per_word(c: Column | str, n: Column, field: str) -> Column:
    return F.when(is_blank(c) | (n["words"] == 0), F.lit(0.0)).otherwise(n[field].cast("double") / n["words"])


def valid_word_ratio(c: Column | str, lexicon=LEXICON, counts: Column | None = None) -> Column:
    """D3: share of lower-cased words found in the lexicon; 0 for blank text."""
    return _per_word(c, text_counts(c, lexicon) if counts is None else counts, "hits")


def low_valid_words(ratio: Column) -> Column:
    """D4 from a D3 column."""
    return (ratio < VALID_WORD_MIN).cast("int")


def avg_word_length(c: Column | str, counts: Column | None = None) -> Column:
    """Mean word length = non-blank characters / words (words split on blanks)."""
    return _per_word(c, text_counts(c) if counts is None else counts, "chars")


def has_long_words(c: Column | str, mean_len: Column) -> Column:
    """D6 from a D5 column; 0 for blank text."""
    return F.when(is_blank(c), F.lit(0)).otherwise((mean_len > LONG_WORD_MEAN).cast("int"))


def char_entropy(c: Column | str, counts: Column | None = None) -> Column:
    """Shannon entropy (base 2) of the character distribution; 0 for blank text."""
    n = text_counts(c) if counts is None else counts
    return F.when(is_blank(c), F.lit(0.0)).otherwise(n["entropy"])


def high_entropy(ent: Column) -> Column:
    """D8 from a D7 column."""
    return (ent > ENTROPY_MAX).cast("int")


def repeated_ratio(c: Column | str, counts: Column | None = None) -> Column:
    """Letters equal to the previous character, over all characters."""
    length = F.length(_text(c))
    n = text_counts(c) if counts is None else counts
    return (F.when(is_blank(c) | (length <= 1), F.lit(0.0))
            .otherwise(n["repeats"].cast("double") / length))


def has_repeated(ratio: Column) -> Column:
    """D10 from a D9 column."""
    return (ratio > REPEATED_MAX).cast("int")


def consonant_cluster(c: Column | str, counts: Column | None = None) -> Column:
    """Mean over words of the longest consonant run in the word."""
    return _per_word(c, text_counts(c) if counts is None else counts, "clusters")


def long_consonant(score: Column) -> Column:
    """D12 from a D11 column."""
    return (score > CLUSTER_MAX).cast("int")


def gibberish_pct(c: Column | str, flags: list[Column]) -> Column:
    """D13 in integer hundredths: weighted flag sum; 0 for blank text."""
    total = None
    for w, f in zip(WEIGHTS_PCT, flags):
        term = f * F.lit(w)
        total = term if total is None else total + term
    return F.when(is_blank(c), F.lit(0)).otherwise(total)


def text_quality_columns(c: Column | str, lexicon=LEXICON, prefix: str = "tq_") -> dict[str, Column]:
    """The 14 quality columns, in the reference's order.

    Flags are derived from the ratio expressions; Spark's common-subexpression
    elimination evaluates each ratio once per row.
    """
    n = text_counts(c, lexicon)
    vr = vowel_ratio(c, n)
    vw = valid_word_ratio(c, lexicon, n)
    aw = avg_word_length(c, n)
    en = char_entropy(c, n)
    rr = repeated_ratio(c, n)
    cc = consonant_cluster(c, n)
    f_abn = abnormal_vowel(vr)
    f_low = low_valid_words(vw)
    f_long = has_long_words(c, aw)
    f_ent = high_entropy(en)
    f_rep = has_repeated(rr)
    f_clu = long_consonant(cc)
    pct = gibberish_pct(c, [f_abn, f_low, f_long, f_ent, f_rep, f_clu])
    return {
        prefix + "vowel_ratio": vr,
        prefix + "abnormal_vowel": f_abn,
        prefix + "valid_word_ratio": vw,
        prefix + "low_valid_words": f_low,
        prefix + "avg_word_length": aw,
        prefix + "has_long_words": f_long,
        prefix + "entropy": en,
        prefix + "high_entropy": f_ent,
        prefix + "repeated_ratio": rr,
        prefix + "has_repeated": f_rep,
        prefix + "consonant_cluster": cc,
        prefix + "long_consonant": f_clu,
        prefix + "gibberish_score": pct.cast("double") / 100.0,
        prefix + "is_gibberish": (pct > GIBBERISH_FLAG_PCT).cast("int"),
    }


def with_text_quality(df, c: str, lexicon=LEXICON, prefix: str = "tq_"):
    """D14 on a DataFrame in projections: the counts once per row, then the six
    base measures, then the flags from those columns, then the score.

    Each base measure feeds several flags; as separate projections Catalyst
    keeps them computed once (it does not collapse a projection whose
    expensive expressions the next one references more than once).
    """
    from pyspark.sql import functions as F  # noqa: F811
    p = prefix
    blank, n = "_tq_blank", F.col("_tq_counts")
    df = df.withColumn("_tq_counts", text_counts(c, lexicon))
    df = df.withColumns({
        blank: is_blank(c),
        p + "vowel_ratio": vowel_ratio(c, n),
        p + "valid_word_ratio": valid_word_ratio(c, lexicon, n),
        p + "avg_word_length": avg_word_length(c, n),
        p + "entropy": char_entropy(c, n),
        p + "repeated_ratio": repeated_ratio(c, n),
        p + "consonant_cluster": consonant_cluster(c, n),
    })
    df = df.withColumns({
        p + "abnormal_vowel": abnormal_vowel(F.col(p + "vowel_ratio")),
        p + "low_valid_words": low_valid_words(F.col(p + "valid_word_ratio")),
        p + "has_long_words": F.when(F.col(blank), F.lit(0)).otherwise(
            (F.col(p + "avg_word_length") > LONG_WORD_MEAN).cast("int")),
        p + "high_entropy": high_entropy(F.col(p + "entropy")),
        p + "has_repeated": has_repeated(F.col(p + "repeated_ratio")),
        p + "long_consonant": long_consonant(F.col(p + "consonant_cluster")),
    })
    total = None
    for w, f in zip(WEIGHTS_PCT, ("abnormal_vowel", "low_valid_words", "has_long_words",
                                  "high_entropy", "has_repeated", "long_consonant")):
        term = F.col(p + f) * F.lit(w)
        total = term if total is None else total + term
    pct = F.when(F.col(blank), F.lit(0)).otherwise(total)
    df = df.withColumn("_tq_pct", pct)
    df = df.withColumns({
        p + "gibberish_score": F.col("_tq_pct").cast("double") / 100.0,
        p + "is_gibberish": (F.col("_tq_pct") > GIBBERISH_FLAG_PCT).cast("int"),
    })
    return df.drop(blank, "_tq_pct", "_tq_counts")
