"""Review feature expressions (E1-E17 column parts, F1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trustlens.functions.lexicons import IMAGE_EMPTY_TOKENS
from trustlens.functions.text import WS_RUN, col_of, tokenize


def parse_image_urls(c: Column | str) -> Column:
    """Image list from JSON, a Python-style list, or ', ; |'-separated text.

    Order of attempts: a JSON or Python list (single quotes and bare None are
    made JSON first), a tuple, a quoted string, ',' (unless the text starts with http),
    ';', '|', else the single value. Items are trimmed, one pair of quotes is
    removed and blank / nan / none / null items are dropped.
    """
    s = F.trim(col_of(c).cast("string"))
    # a tuple is a list in round brackets, a quoted string a list of one
    listed = F.when(s.rlike(r"^\(.*\)$"), F.concat(F.lit("["), F.regexp_extract(s, r"(?s)^\((.*?),?\s*\)$", 1), F.lit("]"))) \
              .when(s.rlike(r"""^"([^"\\]|\\.)*"$|^'[^']*'$"""), F.concat(F.lit("["), s, F.lit("]"))).otherwise(s)
    looks_list = listed.startswith("[") & listed.endswith("]")
    as_json = F.regexp_replace(F.regexp_replace(listed, "'", '"'), r"\bNone\b", "null")
    parsed = F.coalesce(F.from_json(listed, "array<string>"), F.from_json(as_json, "array<string>"))
    by_sep = (F.when(s.contains(",") & ~s.startswith("http"), F.split(s, ","))
               .when(s.contains(";"), F.split(s, ";"))
               .when(s.contains("|"), F.split(s, r"\|"))
               .otherwise(F.array(s)))
    raw = F.when(s.isNull(), F.array().cast("array<string>")) \
           .when(looks_list & parsed.isNotNull(), parsed) \
           .otherwise(by_sep)

    def clean(x):
        t = F.trim(x)
        quoted = ((t.startswith('"') & t.endswith('"')) | (t.startswith("'") & t.endswith("'"))) \
            & (F.length(t) >= 2)
        return F.when(quoted, F.trim(F.regexp_extract(t, r"(?s)^.(.*).$", 1))).otherwise(t)

    items = F.transform(raw, clean)
    empty = list(IMAGE_EMPTY_TOKENS)
    return F.filter(items, lambda t: t.isNotNull() & (t != "") & ~F.lower(t).isin(empty))


def image_features(images: Column) -> dict[str, Column]:
    """Count, has-image flag, first image."""
    n = F.size(images)
    return {
        "n_images": n,
        "has_image": (n > 0).cast("int"),
        "first_image": F.try_element_at(images, F.lit(1)),
    }


def has_image_simple(c: Column | str) -> Column:
    """Non-blank and not the text 'nan'."""
    v = F.trim(col_of(c).cast("string"))
    return (v.isNotNull() & (v != "") & (F.lower(v) != "nan")).cast("int")


def any_not_null(cols: list[str]) -> Column:
    """Any cell of a column family is present."""
    if not cols:
        return F.lit(False)
    return F.coalesce(*[F.col(f"`{c}`") for c in cols]).isNotNull()


def detail_all_fives(c: Column | str) -> Column:
    """E17 (trainer variant): numbers split on blanks / commas; all exactly 5.0.

    A token counts as a number when it is digits with dots removed; a token
    that looks numeric but does not parse (``1.2.3``) makes the row 0.
    """
    s = F.regexp_replace(F.coalesce(col_of(c).cast("string"), F.lit("None")), ",", " ")
    toks = F.filter(F.split(s, WS_RUN), lambda t: F.regexp_replace(t, r"\.", "").rlike(r"^\p{Nd}+$"))
    all5 = F.forall(toks, lambda t: F.coalesce(t.try_cast("double") == 5.0, F.lit(False)))
    return ((F.size(toks) > 0) & all5).cast("int")


def detail_all_fives_strict(c: Column | str) -> Column:
    """F1 (labeller variant): parts split on ',' / ';'; every part truncates to 5;
    any part that is not a number makes it False."""
    s = F.regexp_replace(col_of(c).cast("string"), ";", ",")
    parts = F.filter(F.transform(F.split(s, ","), lambda p: F.trim(p)), lambda p: p != "")

    def is_five(p):
        # 5d and 5f are numbers to Spark only
        x = F.when(p.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), p.try_cast("double"))
        return F.coalesce((x >= 5.0) & (x < 6.0), F.lit(False))

    return F.coalesce((F.size(parts) > 0) & F.forall(parts, is_five), F.lit(False))


def stars_norm(stars: Column) -> Column:
    """E7."""
    return stars.cast("double") / 5.0


def reviewer_count_log(count: Column) -> Column:
    """ln(1 + x)."""
    return F.log1p(count.cast("double"))


def words(c: Column | str) -> Column:
    return tokenize(F.coalesce(col_of(c), F.lit("")))
