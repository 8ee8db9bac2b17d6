"""Text preprocessing on DataFrames.

The whole chain case-fold -> cleanse -> slang -> tokens -> stop words -> stems
is one projection when the lookup tables are small (literal maps and ``IN``
sets, evaluated in the executors' codegen'd projection). Large stem tables go
through a join on distinct tokens instead (see ``stem_tokens``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlens.functions import lexicons as L
from trustlens.functions import text as T


def drop_blank(df: DataFrame, col: str = "text") -> DataFrame:
    """Drop rows whose text is null or blank."""
    return df.where(~T.is_blank(col))


def blank_stats(df: DataFrame, col: str = "text") -> DataFrame:
    """B5 report: rows before, after and removed (one aggregate pass)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~T.is_blank(col)).alias("rows_after"),
        F.count_if(T.is_blank(col)).alias("rows_removed"),
    )


def split_blank(df: DataFrame, col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(valid, blank) rows."""
    blank = T.is_blank(col)
    return df.where(~blank), df.where(blank)


def preview(df: DataFrame, predicate: Column, cols: list[str], n: int = 5,
            order: str = "review_id") -> DataFrame:
    """The first n matching rows by id (the limit is the feature)."""
    return df.where(predicate).select(*cols).orderBy(order).limit(n)


def preprocess_column(c: Column | str, slang: Mapping[str, str] = L.SLANG,
                      stopwords=L.STOPWORDS_SAMPLE, stems: Mapping[str, str] | None = None,
                      digit_replacement: str = "") -> Column:
    """C13 as one Column: the preprocessed text (tokens joined by a blank)."""
    stems = L.STEMS_SAMPLE if stems is None else stems
    s = T.cleanse(T.case_fold(c), digit_replacement)
    # other digit replacements may leave blanks other than one between two words
    toks = T.slang_tokens(s, slang) if digit_replacement in ("", " ") else T.tokenize(T.normalize_slang(s, slang))
    toks = T.remove_tokens(toks, stopwords)
    toks = T.map_tokens(toks, stems)
    return F.array_join(toks, " ")


def preprocess(df: DataFrame, text_col: str = "text", out: str = "text_preprocessed",
               slang: Mapping[str, str] = L.SLANG, stopwords=L.STOPWORDS_SAMPLE,
               stems: Mapping[str, str] | DataFrame | None = None,
               digit_replacement: str = "", id_col: str = "review_id") -> DataFrame:
    """C13 on a DataFrame. ``stems`` may be a DataFrame ``(word, stem)`` of any
    size; then stemming is ``stem_tokens``' join."""
    if isinstance(stems, DataFrame):
        base = preprocess_column(text_col, slang, stopwords, {}, digit_replacement)
        df = df.withColumn("_toks", T.tokenize(base))
        df = stem_tokens(df, "_toks", stems, id_col=id_col, out="_stemmed")
        return df.withColumn(out, F.array_join("_stemmed", " ")).drop("_toks", "_stemmed")
    return df.withColumn(out, preprocess_column(text_col, slang, stopwords, stems,
                                                digit_replacement))


def remove_stopwords(df: DataFrame, tokens_col: str, words, out: str | None = None) -> DataFrame:
    """C11 with a given word list."""
    return df.withColumn(out or tokens_col, T.remove_tokens(F.col(tokens_col), words))


def stem_tokens(df: DataFrame, tokens_col: str, stem_table: Mapping[str, str] | DataFrame,
                id_col: str = "review_id", out: str | None = None) -> DataFrame:
    """Token -> stem through a lookup table; unknown tokens pass through.

    A dict (small, bounded) is inlined as a literal map. A DataFrame table of
    any size is joined: the distinct tokens of the input (deduplicated
    map-side, so a hot token costs one row per partition) are looked up once,
    and the resulting token -> stem pairs are joined back to the exploded
    tokens; AQE splits a hot token's partition (skew join). Tokens are
    regrouped per row in their original order and the row's columns are joined
    back on ``id_col``.
    """
    out = out or tokens_col
    if isinstance(stem_table, Mapping):
        return df.withColumn(out, T.map_tokens(F.col(tokens_col), stem_table))
    table = stem_table.toDF("word", "stem").dropDuplicates(["word"])
    exploded = df.select(id_col, F.posexplode(tokens_col).alias("pos", "tok"))
    seen = exploded.select(F.col("tok").alias("word")).distinct()
    found = seen.join(table, "word", "inner")
    mapped = (exploded.join(found, exploded.tok == found.word, "left")
                      .select(id_col, "pos", F.coalesce("stem", "tok").alias("tok")))
    regrouped = mapped.groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct("pos", "tok"))).alias("_pairs"))
    regrouped = regrouped.select(id_col, F.transform("_pairs", lambda p: p["tok"]).alias(out))
    base = df.drop(out) if out in df.columns and out != tokens_col else df
    if out == tokens_col:
        base = base.drop(tokens_col)
    return (base.join(regrouped, id_col, "left")
                .withColumn(out, F.coalesce(F.col(out), F.array().cast("array<string>"))))


def ensure_preprocessed(df: DataFrame, force: bool = False, text_col: str = "text",
                        out: str = "text_preprocessed", slang: Mapping[str, str] = L.SLANG_TRAINER,
                        digit_replacement: str = " ", stopwords=L.STOPWORDS_SAMPLE,
                        stems: Mapping[str, str] | None = None) -> DataFrame:
    """C14: preprocess only rows whose ``text_preprocessed`` is blank; with
    ``force`` the whole column is preprocessed again (the trainers' behaviour)."""
    if out not in df.columns:
        df = df.withColumn(out, F.lit(""))
    cur = F.coalesce(F.col(out).cast("string"), F.lit(""))
    fresh = preprocess_column(text_col, slang, stopwords, stems, digit_replacement)
    filled = F.when(T.is_blank(cur), fresh).otherwise(cur)
    if force:
        filled = preprocess_column(filled, slang, stopwords, stems, digit_replacement)
    return df.withColumn(out, filled)


def preprocess_job(df: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """Drop blank texts, keep ``text_original``, add ``text_preprocessed``."""
    kept = drop_blank(df, text_col).withColumn("text_original", F.col(text_col))
    return preprocess(kept, text_col, **kw)
