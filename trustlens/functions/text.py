"""Column expressions for text normalisation (C1-C10) and simple text counts.

Every function takes and returns a ``Column``; nothing here runs Python per
row. Regular expressions are written so Java (Spark) and RE2 (the SQL oracle)
read them the same way: Unicode classes ``\\p{L}``/``\\p{N}``/``\\p{Nd}``
instead of ``\\w``/``\\d``, whose meaning differs between engines.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace the way Python's str.split() sees it (ASCII space class plus the
# Unicode separators).
WS = r"[\s\p{Z}]"
WS_RUN = r"[\s\p{Z}]+"
URL_RE = r"http\S+|www\S+|https\S+"
MENTION_RE = r"@[\p{L}\p{N}_]+"
HASHTAG_RE = r"#[\p{L}\p{N}_]+"
TAG_RE = r"[@#][\p{L}\p{N}_]+"  # mentions and hashtags: neither can begin where the other was cut out
SYMBOL_RE = r"[^\p{L}\p{N}_\s]"
SYMBOL_RUN = r"[^\p{L}\p{N}_]++"  # symbols and blanks: \s holds no letter, number or _
DIGITS_RE = r"\p{Nd}+"
PUNCT_RE = r"""[.,;:!?"'()\\\-]"""


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """True for null or whitespace-only text (Python ``str(x).strip() == ''``)."""
    c = col_of(c)
    return c.isNull() | ~c.rlike(r"[^\s\p{Z}]")


def case_fold(c: Column | str) -> Column:
    """Lower case, null -> ''."""
    return F.lower(F.coalesce(col_of(c), F.lit("")))


def strip_urls(c: Column | str) -> Column:
    """C2."""
    return F.regexp_replace(col_of(c), URL_RE, "")


def strip_mentions(c: Column | str) -> Column:
    """C3."""
    return F.regexp_replace(col_of(c), MENTION_RE, "")


def strip_hashtags(c: Column | str) -> Column:
    """C4."""
    return F.regexp_replace(col_of(c), HASHTAG_RE, "")


def strip_symbols(c: Column | str) -> Column:
    """Punctuation and emoji become a blank."""
    return F.regexp_replace(col_of(c), SYMBOL_RE, " ")


def strip_digits(c: Column | str, replacement: str = "") -> Column:
    """Digit runs become ``replacement`` ('' in the cleaner, ' ' in the trainers)."""
    return F.regexp_replace(col_of(c), DIGITS_RE, replacement)


def collapse_ws(c: Column | str) -> Column:
    """Whitespace runs become one blank; ends trimmed."""
    return F.trim(F.regexp_replace(col_of(c), r"\s+", " "))


def cleanse(c: Column | str, digit_replacement: str = "") -> Column:
    """C8 = C2..C7 in the reference's order, on case-folded text.

    Where digits become nothing or a blank they can go first, and one pass then turns
    each run of symbols and blanks (C5, C7) into one blank."""
    s = strip_urls(c)
    s = F.regexp_replace(s, TAG_RE, "")  # C3, C4
    if digit_replacement in ("", " "):
        s = strip_digits(s, digit_replacement)
        return F.trim(F.regexp_replace(s, SYMBOL_RUN, " "))
    s = strip_symbols(s)
    s = strip_digits(s, digit_replacement)
    return collapse_ws(s)


def tokenize(c: Column | str) -> Column:
    """Whitespace split without empty tokens."""
    return F.filter(F.split(col_of(c), WS_RUN), lambda t: t != "")


def map_literal(table: Mapping[str, str]) -> Column:
    """A literal ``MAP<STRING,STRING>`` for small lookup tables (< 1,000 keys)."""
    items = []
    for k, v in table.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def look_up(table: Mapping[str, str]):
    """token -> value, or the token itself. The key test is a hash set; the map's
    linear search runs only on a hit."""
    m, keys = map_literal(table), list(table)
    return lambda t: F.when(t.isin(keys), F.try_element_at(m, t)).otherwise(t)


def normalize_slang(c: Column | str, table: Mapping[str, str]) -> Column:
    """C9 on a cleansed string: each token is looked up once, then the text is
    re-joined, so multi-word and empty replacements are re-tokenised by the caller."""
    mapped = F.transform(tokenize(c), look_up(table))
    return collapse_ws(F.array_join(mapped, " "))


def slang_tokens(c: Column | str, table: Mapping[str, str]) -> Column:
    """C9 + C10 on a cleansed string (words with one blank between): the words after
    look-up; replacements of several words are several tokens."""
    mapped = F.array_join(F.transform(F.split(col_of(c), " "), look_up(table)), " ")
    plain = all(v == " ".join(v.split()) for v in table.values())
    return F.filter(F.split(mapped, " "), lambda t: t != "") if plain else tokenize(mapped)


def remove_tokens(tokens: Column, words) -> Column:
    """C11 with a small literal word list (``IN`` over literals becomes a hash set)."""
    words = list(words)
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(words))


def map_tokens(tokens: Column, table: Mapping[str, str]) -> Column:
    """C12 with a small literal table: unknown tokens pass through."""
    if not table:
        return tokens
    return F.transform(tokens, look_up(table))


def word_count(c: Column | str) -> Column:
    """Number of whitespace-separated words."""
    return F.size(tokenize(F.coalesce(col_of(c), F.lit(""))))


def char_count(c: Column | str) -> Column:
    """Number of characters (code points)."""
    return F.length(F.coalesce(col_of(c), F.lit("")))


def count_matches(c: Column | str, pattern: str) -> Column:
    """Number of regex matches."""
    return F.regexp_count(F.coalesce(col_of(c), F.lit("")), F.lit(pattern))


def uppercase_word_count(c: Column | str) -> Column:
    """Words with a cased letter and no lower-case letter (Python ``isupper``)."""
    toks = tokenize(F.coalesce(col_of(c), F.lit("")))
    return F.size(F.filter(toks, lambda w: (w == F.upper(w)) & (w != F.lower(w))))
