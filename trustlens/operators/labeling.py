"""Heuristic labelling.

The labeller is a projection plus two aggregations:

* the same-day burst count is ``groupBy(day).count()`` joined back. The count
  table has one row per calendar day, so AQE turns the join into a broadcast
  from runtime statistics; a window partitioned by day would instead send a hot
  day (a third of all rows) to a single task. Map-side partial aggregation keeps
  the shuffle at one row per (partition, day).
* the photo-source choice (review photos, else place photo) is a one-row
  aggregate cross-joined back, so the plan stays lazy: no driver branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlens.functions import lexicons as L
from trustlens.functions.features import any_not_null, detail_all_fives_strict
from trustlens.functions.text import word_count
from trustlens.sources import schema as S

# --- fixed values: labelling points and thresholds ---------------------------
POINTS_FIVE_NO_TEXT = 3
POINTS_FIVE_SHORT = 2
SHORT_WORDS = 5
POINTS_NO_PHOTO = 1
POINTS_ALL_FIVES = 1
NEW_REVIEWER_MAX = 2
POINTS_NEW_REVIEWER = 2
POINTS_NOT_LOCAL = 1
POINTS_NO_CONTEXT = 1
BURST_MIN = 5          # same-day count > 5
POINTS_BURST = 2
FAKE_THRESHOLD = 4     # fake_score >= 4

IMAGE_FAMILY_KEYS = ("reviewimageurls", "reviewimageurl", "reviewphotos")
DETAIL_FAMILY_KEYS = ("reviewdetailedrating", "reviewdetailrating")
CONTEXT_FAMILY_KEYS = ("reviewcontext",)

LABELLER_DEFAULTS = {
    "nama": (None, "string"), "stars": (None, "string"), "text": (None, "string"),
    "reviewernumberofreview": (None, "string"), "imageUrl": (None, "string"),
    "title": (None, "string"), "islocalguid": (None, "string"),
    "reviewContext": (None, "string"), "reviewDetailRating": (None, "string"),
    "publishAt": (None, "string"), "publishAtDate": (None, "string"),
}


def prepare_for_labelling(raw: DataFrame) -> DataFrame:
    """A8 + A10 + A6 + A9 + B1-B3 + B7 + E1: the labeller's typed table."""
    df = S.apply_aliases(raw)
    df = S.concat_family(df, DETAIL_FAMILY_KEYS, "reviewDetailRating")
    df = S.concat_family(df, CONTEXT_FAMILY_KEYS, "reviewContext")
    df = S.normalize_headers(df)
    df = S.ensure_columns(df, LABELLER_DEFAULTS)
    img_cols = S.family_columns(df, *IMAGE_FAMILY_KEYS)
    return df.withColumns({
        "stars": S.coerce_number("stars"),
        "reviewernumberofreview": S.coerce_number("reviewernumberofreview"),
        "islocalguid": S.coerce_bool("islocalguid", L.LOCAL_GUIDE_TRUE_LABELLER),
        "publishAtDate": S.coerce_timestamp("publishAtDate"),
        "has_review_image": any_not_null(img_cols),
        "text": S.fill_text("text"),
    }).withColumn("text_len_words", word_count("text"))


def resolve_has_image(df: DataFrame, review_flag: str = "has_review_image",
                      place_col: str = "imageUrl") -> DataFrame:
    """Review photos if any row has one, else the place photo, else False.

    The data-set-wide choice is a one-row aggregate, broadcast back.
    """
    place = F.col(place_col)
    flags = df.agg(
        F.coalesce(F.max(F.col(review_flag).cast("int")), F.lit(0)).alias("_any_review"),
        F.coalesce(F.max(place.isNotNull().cast("int")), F.lit(0)).alias("_any_place"),
    )
    place_ok = place.isNotNull() & (F.trim(place.cast("string")) != "")
    return (df.crossJoin(F.broadcast(flags))
              .withColumn("has_image",
                          F.when(F.col("_any_review") == 1, F.col(review_flag))
                           .when(F.col("_any_place") == 1, place_ok)
                           .otherwise(F.lit(False)))
              .drop("_any_review", "_any_place"))


def day_counts(df: DataFrame, day_col: str = "publish_day") -> DataFrame:
    """Reviews per day (null days dropped, like a pandas group-by)."""
    return df.where(F.col(day_col).isNotNull()).groupBy(day_col).agg(
        F.count(F.lit(1)).cast("int").alias("same_day_count"))


def same_day_count(df: DataFrame, ts_col: str, null_day_count: int = 0,
                   day_col: str = "publish_day") -> DataFrame:
    """Add ``publish_day`` and the number of reviews on that day.

    Rows without a day get ``null_day_count`` (0 in the labeller, 1 in the
    trainers).
    """
    df = df.withColumn(day_col, F.to_date(F.col(ts_col)))
    # One row per calendar day: a century is under 40,000 rows, so the side to send has
    # a fixed bound and the review table with its texts is not shuffled on the day.
    counts = F.broadcast(day_counts(df, day_col))
    return (df.join(counts, day_col, "left")
              .withColumn("same_day_count",
                          F.when(F.col(day_col).isNull(), F.lit(null_day_count))
                           .otherwise(F.coalesce(F.col("same_day_count"), F.lit(null_day_count)))))


def _rule(cond: Column, points: int, reason: str) -> tuple[Column, Column]:
    cond = F.coalesce(cond, F.lit(False))
    return F.when(cond, F.lit(points)).otherwise(F.lit(0)), F.when(cond, F.lit(reason))


def fake_score_rules(df: DataFrame) -> list[tuple[Column, Column]]:
    """the six rules A-F as (points, reason) column pairs, in rule order."""
    stars = F.col("stars")
    n = F.col("text_len_words")
    ctx = F.col("reviewContext").cast("string")
    return [
        _rule((stars == 5) & (n == 0), POINTS_FIVE_NO_TEXT, L.REASON_FIVE_NO_TEXT),
        _rule((stars == 5) & (n > 0) & (n < SHORT_WORDS), POINTS_FIVE_SHORT, L.REASON_FIVE_SHORT),
        _rule(~F.col("has_image"), POINTS_NO_PHOTO, L.REASON_NO_PHOTO),
        _rule(detail_all_fives_strict("reviewDetailRating"), POINTS_ALL_FIVES, L.REASON_ALL_FIVES),
        _rule(F.col("reviewernumberofreview") <= NEW_REVIEWER_MAX, POINTS_NEW_REVIEWER,
              L.REASON_NEW_REVIEWER),
        _rule(~F.col("islocalguid"), POINTS_NOT_LOCAL, L.REASON_NOT_LOCAL),
        _rule(ctx.isNull() | (F.trim(ctx) == ""), POINTS_NO_CONTEXT, L.REASON_NO_CONTEXT),
    ]


def fake_score(df: DataFrame) -> DataFrame:
    """F2 + F3: ``fake_score`` and ``reasons_list`` (non-firing rules dropped)."""
    rules = fake_score_rules(df)
    score = sum((p for p, _ in rules[1:]), rules[0][0])
    reasons = F.filter(F.array(*[r for _, r in rules]), lambda x: x.isNotNull())
    return df.withColumns({"fake_score": score, "reasons_list": reasons})


def apply_burst_rule(df: DataFrame, min_count: int = BURST_MIN, points: int = POINTS_BURST
                     ) -> DataFrame:
    """a burst day (> min_count reviews) adds points and a reason."""
    hit = F.col("same_day_count") > min_count
    return df.withColumns({
        "fake_score": F.col("fake_score") + F.when(hit, F.lit(points)).otherwise(F.lit(0)),
        "reasons_list": F.when(hit, F.array_append("reasons_list", F.lit(L.REASON_BURST)))
                         .otherwise(F.col("reasons_list")),
    })


def label_by_threshold(df: DataFrame, threshold: int = FAKE_THRESHOLD) -> DataFrame:
    """F5."""
    return df.withColumn("label", F.when(F.col("fake_score") >= threshold, F.lit("FAKE"))
                                   .otherwise(F.lit("REAL")))


def reason_text(df: DataFrame) -> DataFrame:
    """F6."""
    return df.withColumn("reason", F.when(F.col("label") == "FAKE",
                                          F.array_join("reasons_list", "; "))
                                    .otherwise(F.lit(L.REASON_REAL)))


def label_reviews(raw: DataFrame, threshold: int = FAKE_THRESHOLD) -> DataFrame:
    """the whole labeller on a raw (all-text) review table."""
    df = prepare_for_labelling(raw)
    df = resolve_has_image(df)
    df = fake_score(df)
    df = same_day_count(df, "publishAtDate", null_day_count=0)
    df = apply_burst_rule(df)
    df = label_by_threshold(df, threshold)
    return reason_text(df)


def correct_labels(df: DataFrame, threshold: float = 0.7, label: str = "label",
                   flag: str = "tq_is_gibberish", score: str = "tq_gibberish_score"
                   ) -> DataFrame:
    """F8: gibberish rows (flag set and score > threshold) become FAKE.

    Scores are hundredths, so the comparison is made on integers.
    """
    pct = F.round(F.col(score) * 100).cast("int")
    hit = (F.col(flag) == 1) & (pct > int(round(threshold * 100)))
    return df.withColumns({
        "label_before": F.col(label),
        label: F.when(hit, F.lit("FAKE")).otherwise(F.col(label)),
    })


def correction_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """F8 report: FAKE before, after, and rows changed."""
    return df.agg(
        F.count_if(F.col("label_before") == "FAKE").alias("fake_before"),
        F.count_if(F.col(label) == "FAKE").alias("fake_after"),
        F.count_if(F.col("label_before") != F.col(label)).alias("changed"),
    )


def encode_label(df: DataFrame, scheme: str = "signed", label: str = "label", out: str = "y"
                 ) -> DataFrame:
    """FAKE = 1 / REAL = -1 ('signed'), or alphabetical 0/1 ('alphabet':
    FAKE = 0, REAL = 1)."""
    if scheme == "signed":
        y = F.when(F.col(label) == "FAKE", F.lit(1)).when(F.col(label) == "REAL", F.lit(-1))
    elif scheme == "alphabet":
        y = F.when(F.col(label) == "FAKE", F.lit(0)).when(F.col(label) == "REAL", F.lit(1))
    else:
        raise ValueError(scheme)
    return df.withColumn(out, y)


def stars_short_preview(df: DataFrame, n: int = 5) -> DataFrame:
    """B10 example: five-star reviews of at most three words."""
    return (df.where((F.col("stars") == 5) & (F.col("text_len_words") <= 3))
              .select("review_id", "title", "stars", "text", "text_len_words", "has_image")
              .orderBy("review_id").limit(n))
