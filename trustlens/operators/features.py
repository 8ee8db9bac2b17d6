"""The trainers' feature table (E1-E19, D14 on the preprocessed text).

One projection per row plus the same-day count (group by day, joined back).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlens.functions import features as FE
from trustlens.functions import lexicons as L
from trustlens.functions import text as T
from trustlens.functions.quality import with_text_quality
from trustlens.operators.cleaning import ensure_preprocessed
from trustlens.operators.labeling import same_day_count
from trustlens.sources import schema as S

FEATURE_DEFAULTS = {
    "text_preprocessed": ("", "string"), "text": ("", "string"), "stars": (0, "string"),
    "reviewImageUrls": (None, "string"), "reviewerNumberOfReviews": (0, "string"),
    "isLocalGuide": (0, "string"), "reviewDetailedRating": ("", "string"),
    "publishedAtDate": (None, "string"),
}

# --- fixed values: pattern thresholds -----------------------------------------
SHORT_WORDS = 5
NEW_REVIEWER_MAX = 2
BURST_MIN = 5


def text_features(df: DataFrame, text_col: str = "text_preprocessed",
                  punct_col: str = "text") -> DataFrame:
    """E1-E6. ``punct_col`` is the text the '!', '?', punctuation and
    upper-case counts look at; the reference used the preprocessed text, where
    they are always 0 (pass ``punct_col='text_preprocessed'`` for that)."""
    wc = T.word_count(text_col)
    upper = T.uppercase_word_count(punct_col)
    n_words_punct = T.word_count(punct_col)
    return df.withColumns({
        "text_word_count": wc,
        "text_char_count": T.char_count(text_col),
        "avg_word_length": F.when(wc > 0, T.char_count(F.regexp_replace(
            F.coalesce(F.col(text_col), F.lit("")), T.WS, "")).cast("double") / wc)
            .otherwise(F.lit(0.0)),
        "exclamation_count": T.count_matches(punct_col, "!"),
        "question_count": T.count_matches(punct_col, r"\?"),
        "punctuation_count": T.count_matches(punct_col, T.PUNCT_RE),
        "uppercase_word_count": upper,
        "uppercase_word_ratio": upper.cast("double") / F.greatest(n_words_punct, F.lit(1)),
    })


def build_features(df: DataFrame, force_preprocess: bool = False, punct_col: str = "text",
                   null_day_count: int = 1, slang=L.SLANG_TRAINER,
                   digit_replacement: str = " ") -> DataFrame:
    """A7 + A9 + C14 + E1-E17 + D14 on a raw review table. The defaults are the
    trainers' slang table and digit rule; the scorers pass the predictors'."""
    df, _ = S.map_columns(df)
    df = S.ensure_columns(df, FEATURE_DEFAULTS)
    df = ensure_preprocessed(df, force=force_preprocess, slang=slang, digit_replacement=digit_replacement)
    df = text_features(df, "text_preprocessed", punct_col)
    stars = S.coerce_number("stars", as_int=False)
    reviewers = S.coerce_number("reviewerNumberOfReviews", as_int=False)
    images = FE.parse_image_urls("reviewImageUrls")
    ts = S.coerce_timestamp("publishedAtDate")
    df = df.withColumns({
        "stars": stars,
        "stars_norm": FE.stars_norm(stars),
        "reviewer_count": reviewers,
        "reviewer_count_log": FE.reviewer_count_log(reviewers),
        "is_local_guide": S.coerce_bool("isLocalGuide", L.LOCAL_GUIDE_TRUE_TRAINER,
                                        lower=True).cast("int"),
        "review_images_list": images,
        "detail_rating_all_5": FE.detail_all_fives("reviewDetailedRating"),
        "published_date": ts,
        "publish_hour": F.coalesce(F.hour(ts), F.lit(0)),
    })
    df = df.withColumns(FE.image_features(F.col("review_images_list")))
    df = same_day_count(df, "published_date", null_day_count=null_day_count)
    df = df.withColumns({
        "pattern_5star_short": ((F.col("stars") == 5) & (F.col("text_word_count") < SHORT_WORDS)
                                ).cast("int"),
        "pattern_5star_nophoto": ((F.col("stars") == 5) & (F.col("has_image") == 0)).cast("int"),
        "pattern_new_reviewer": (F.col("reviewer_count") <= NEW_REVIEWER_MAX).cast("int"),
        "pattern_same_day": (F.col("same_day_count") > BURST_MIN).cast("int"),
    })
    df = with_text_quality(df, "text_preprocessed")
    return S.fill_features(df, list(L.NUMERIC_FEATURES))


def numeric_features() -> list[str]:
    """The 18 + 14 numeric feature names in vector order."""
    return list(L.NUMERIC_FEATURES)
