"""Quality rules: one threshold table compiled into one Spark projection.

``measure`` derives per-text counts with built-in functions only (no Python,
no shuffle: every row is judged from its own text); ``verdict`` turns the rows
of ``RULES`` into one boolean expression. Null text has no words. Repeated
rows are judged each on its own; an empty table gives an empty result; extra
columns of the input are ignored, or kept by ``filter_quality``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

# The commonest function words of the four languages of the corpus.
STOP_WORDS = (
    "the and of to in is that it for on as are with be by this at or from was "
    "de la le et les des en un une du que qui est pour dans par sur au pas "
    "der die und das den von zu mit sich ist nicht ein eine auf dem des auch es "
    "el los las y por con para una se del como no su al"
).split()

# (name, numerator, denominator, lower bound, upper bound); None: no bound.
# A text fails a rule when numerator / denominator lies outside the bounds.
RULES = (
    ("length", "n_words", None, 50, None),
    ("repeat_words", "n_repeat_words", "n_words", None, 0.5),
    ("mean_word_chars", "word_chars", "n_words", 2.0, 12.0),
    ("symbols", "n_symbols", "n_words", None, 0.1),
    ("stop_words", "n_stop_words", "n_words", 0.06, None),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
)
BASE_RULES = ("length", "repeat_words")


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """The input with one struct column ``q`` of counts (all LONG).

    Windows of three words are compared by their 64-bit hashes within one text;
    texts without a repeated window take the cheap path (one distinct count).
    """
    src = F.col(f"`{text}`")
    one = (df.withColumn("__t", F.coalesce(src.cast("string"), F.lit("")))
             .withColumn("__w", F.array_remove(F.split("__t", SPACE + "+"), ""))
             .withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))))
    one = one.withColumn("__h", F.expr(
        "transform(slice(__w, 1, greatest(size(__w) - 2, 0)),"
        " (x, i) -> xxhash64(x, get(__w, i + 1), get(__w, i + 2)))"))
    # (hash, place) sorted by hash: a repeated window has an equal neighbour.
    one = one.withColumn("__s", F.expr(
        "CASE WHEN size(array_distinct(__h)) < size(__h)"
        " THEN sort_array(transform(__h, (x, i) -> named_struct('h', x, 'i', i))) END"))
    one = one.withColumn("__p", F.expr(
        "sort_array(transform(filter(__s, (e, k) -> coalesce(e.h = get(__s, k - 1).h, false)"
        " OR coalesce(e.h = get(__s, k + 1).h, false)), e -> e.i))"))
    repeat = F.expr("coalesce(aggregate(transform(__p, (x, k) ->"
                    " least(3, coalesce(get(__p, k + 1) - x, 3))), 0L, (a, x) -> a + x), 0L)")
    low = F.lower("__t")
    q = F.struct(
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("__t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
        F.size("__l").cast("long").alias("n_lines"),
        F.regexp_count(low, F.lit(r"(?<![\p{L}\p{N}])(?:" + "|".join(sorted(set(STOP_WORDS))) + r")(?![\p{L}\p{N}])"))
         .cast("long").alias("n_stop_words"),
    )
    return one.withColumn("q", q).drop("__t", "__w", "__l", "__h", "__s", "__p")


def _fails(rule, q: str) -> Column:
    _, num, den, low, high = rule
    n = F.col(f"{q}.{num}")
    d = F.col(f"{q}.{den}") if den else F.lit(1)
    bounds = []
    if low is not None:
        bounds.append(n < F.lit(low) * d)
    if high is not None:
        bounds.append(n > F.lit(high) * d)
    return reduce(lambda a, b: a | b, bounds)


def verdict(rules=RULES, q: str = "q") -> Column:
    """True when no rule fails."""
    return ~reduce(lambda a, b: a | b, [_fails(r, q) for r in rules])


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """key, the counts, ``base_failed`` and ``kept`` of every row."""
    m = measure(df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias(text)), text)
    base = ~verdict([r for r in rules if r[0] in BASE_RULES])
    return m.select(key, "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines",
                    "q.n_repeat_words", base.alias("base_failed"),
                    (~base & verdict(rules)).alias("kept"))


def filter_quality(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows whose text passes every rule, with their own columns."""
    m = measure(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"),
                          F.col(f"`{text}`").alias("__text")), "__text")
    # Through a generator: a filter right on the counts would be pushed below them and
    # compute each count anew for every rule.
    return m.select("__row", F.explode(F.array("q")).alias("q")).where(verdict(rules)).select("__row.*")


def _oracle() -> str:
    space = r"[\x20\x09-\x0D]"
    stop = "|".join(sorted(set(STOP_WORDS)))

    def fails(rule):
        _, num, den, low, high = rule
        d = den or "1"
        out = [f"{num} < {low!r}::DOUBLE * {d}"] if low is not None else []
        out += [f"{num} > {high!r}::DOUBLE * {d}"] if high is not None else []
        return " OR ".join(out)

    base = " OR ".join(fails(r) for r in RULES if r[0] in BASE_RULES)
    every = " OR ".join(fails(r) for r in RULES)
    return rf"""
WITH t AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT doc_id, i, word FROM (
    SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
    FROM (SELECT doc_id, list_filter(regexp_split_to_array(t, '{space}+'), lambda x: x <> '') AS ws FROM t))),
g AS MATERIALIZED (SELECT doc_id, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c
    FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g WHERE c IS NOT NULL),
p AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r WHERE n > 1) GROUP BY doc_id),
ws AS (SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars FROM w GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM t)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
s AS (SELECT doc_id, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
      len(list_filter(regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}]+'), lambda x: regexp_full_match(x, '{stop}'))) AS n_stop_words
      FROM t),
q AS (SELECT t.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, n_symbols,
      coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
      coalesce(n_lines, 0) AS n_lines, n_stop_words
      FROM t JOIN s USING (doc_id) LEFT JOIN ws USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN p USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({base}) AS base_failed, NOT ({every}) AS kept FROM q"""


ORACLE = _oracle()
