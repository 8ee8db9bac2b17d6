"""Batch scoring (K1-K8): features -> model -> overrides -> summary.

Valid and blank texts are split (B6) so the same-day counts see valid rows
only, like the reference; blank rows get the blank rule and both parts are
unioned. Model tables are bounded (vocabulary, scaler, class statistics,
weights) and broadcast; the only shuffles are the same-day count and the
TF-IDF grouping on ``review_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlens.functions import lexicons as L
from trustlens.operators import vectorize as V
from trustlens.operators.cleaning import split_blank
from trustlens.operators.features import build_features

NB_OVERRIDE = 0.65
RF_OVERRIDE = 0.7


def scoring_features(raw: DataFrame) -> DataFrame:
    """The feature table with the predictors' slang table and digit rule. The input's
    own columns travel in the struct ``__raw`` and come out unchanged."""
    return build_features(raw.withColumn("__raw", F.struct(*[F.col(f"`{c}`") for c in raw.columns])),
                          slang=L.SLANG_PREDICTOR, digit_replacement="")


def _label(c):
    return F.when(c == 1, F.lit("FAKE")).otherwise(F.lit("REAL"))


def override_gibberish(df: DataFrame, threshold: float = NB_OVERRIDE,
                       score: str = "tq_gibberish_score", with_probs: bool = True,
                       decision: str | None = None, override_score: float = 1.0) -> DataFrame:
    """K4: gibberish score above the threshold -> FAKE, confidence = the score,
    probabilities 1 / 0. Scores are hundredths, so the test is on integers."""
    hit = F.round(F.col(score) * 100).cast("int") > int(round(threshold * 100))
    out = df.withColumns({
        "predicted_label": F.when(hit, F.lit("FAKE")).otherwise(F.col("predicted_label")),
        "confidence": F.when(hit, F.col(score)).otherwise(F.col("confidence")),
        "overridden": hit,
    })
    if with_probs:
        out = out.withColumns({
            "prob_fake": F.when(hit, F.lit(1.0)).otherwise(F.col("prob_fake")),
            "prob_real": F.when(hit, F.lit(0.0)).otherwise(F.col("prob_real"))})
    if decision:
        out = out.withColumn(decision, F.when(hit, F.lit(override_score)).otherwise(F.col(decision)))
    return out


def override_gibberish_flagged(df: DataFrame, threshold: float = RF_OVERRIDE,
                               score: str = "tq_gibberish_score", flag: str = "tq_is_gibberish"
                               ) -> DataFrame:
    """K5: flag set and score above the threshold turns REAL into FAKE and
    marks ``gibberish_override``."""
    hit = (F.col(flag) == 1) & (F.round(F.col(score) * 100).cast("int") > int(round(threshold * 100))) \
        & (F.col("predicted_label") == "REAL")
    return df.withColumns({
        "predicted_label": F.when(hit, F.lit("FAKE")).otherwise(F.col("predicted_label")),
        "gibberish_override": hit.cast("int"),
    })


def blank_rule(blank: DataFrame, with_probs: bool = True, decision: str | None = None,
               override_score: float = 1.0) -> DataFrame:
    """K6: blank texts are FAKE with confidence 1.0."""
    cols = {"predicted_label": F.lit("FAKE"), "confidence": F.lit(1.0), "overridden": F.lit(True)}
    if with_probs:
        cols.update({"prob_fake": F.lit(1.0), "prob_real": F.lit(0.0)})
    if decision:
        cols[decision] = F.lit(override_score)
    return blank.withColumns(cols)


def score_reviews_nb(raw: DataFrame, model, threshold: float = NB_OVERRIDE) -> DataFrame:
    """K1 + K4 + K6: NB scoring of a raw review table."""
    from trustlens.operators.bayes import predict_hybrid_nb
    from trustlens.session import ensure_checkpoint_dir
    # the text and the numeric half both read the feature table: build it once
    # and cut its lineage (written to the shared checkpoint folder)
    ensure_checkpoint_dir(raw.sparkSession)
    from trustlens.session import materialize
    # a text is blank if nothing is left of it after preprocessing
    feats = materialize(V.with_tokens(scoring_features(raw)), "score_features")
    valid, blank = split_blank(feats, "text_preprocessed")
    feats = valid
    p = predict_hybrid_nb(model, feats)
    p = p.withColumns({
        "predicted_label": _label(F.col("y_pred")),
        "confidence": F.greatest("prob_fake", "prob_real"),
    })
    p = override_gibberish(p, threshold)
    keep = ["__raw.*", "predicted_label", "confidence", "prob_fake", "prob_real",
            "tq_gibberish_score", "overridden"]
    b = blank_rule(blank).withColumn("tq_gibberish_score", F.lit(0.0))
    return p.select(*keep).unionByName(b.select(*keep))


def svm_confidence(score: str = "decision_score"):
    """K2: 1 / (1 + e^{-|s|})."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.abs(F.col(score))))


def score_reviews_svm(raw: DataFrame, vocab: DataFrame, scaler: DataFrame, cols: list[str],
                      model, threshold: float = NB_OVERRIDE,
                      override_score: float = 1.0) -> DataFrame:
    """K2 + K4 + K6: SVM scoring; overridden / blank rows get
    ``decision_score = override_score`` (+1.0: FAKE is the positive side)."""
    from trustlens.operators.svm import score_svm
    from trustlens.session import ensure_checkpoint_dir, materialize
    # both halves and the test for blanks read the feature table: built once
    ensure_checkpoint_dir(raw.sparkSession)
    valid, blank = split_blank(materialize(scoring_features(raw), "score_features"), "text_preprocessed")
    feats = V.with_tokens(valid)
    feats = V.scale(feats, scaler, cols, suffix="__s")
    feats = V.tfidf_vector(feats, vocab)
    feats = V.assemble(feats, ["text_features"] + [f"{c}__s" for c in cols])
    p = score_svm(feats, model)
    p = p.withColumns({"predicted_label": _label(F.col("y_pred")), "confidence": svm_confidence()})
    p = override_gibberish(p, threshold, with_probs=False, decision="decision_score",
                           override_score=override_score)
    keep = ["__raw.*", "predicted_label", "confidence", "decision_score", "overridden"]
    b = blank_rule(blank, with_probs=False, decision="decision_score", override_score=override_score)
    return p.select(*keep).unionByName(b.select(*keep))


def score_reviews_rf(raw: DataFrame, vocab: DataFrame, scaler: DataFrame, cols: list[str],
                     forest,
                     threshold: float = RF_OVERRIDE, blank_policy: str = "model") -> DataFrame:
    """K3 + K5: RF scoring by per-tree votes; confidence = winning share,
    decision_score = FAKE share - REAL share. ``blank_policy='model'`` scores
    blank texts with the model (the RF predictor's behaviour), 'fake' applies K6."""
    from trustlens.operators.forest import tree_vote_columns
    feats, blank = scoring_features(raw), None
    if blank_policy != "model":
        feats, blank = split_blank(feats, "text_preprocessed")
    feats = V.with_tokens(feats)
    feats = V.scale(feats, scaler, cols, suffix="__s")
    feats = V.tfidf_vector(feats, vocab)
    feats = V.assemble(feats, ["text_features"] + [f"{c}__s" for c in cols])
    scored = (tree_vote_columns(feats, forest)
              .withColumns({
                  "predicted_label": _label(F.col("voted")),
                  "confidence": F.greatest("share_fake", "share_real"),
                  "decision_score": F.col("share_fake") - F.col("share_real")}))
    scored = override_gibberish_flagged(scored, threshold)
    keep = ["__raw.*", "predicted_label", "confidence", "decision_score", "gibberish_override"]
    out = scored.select(*keep)
    if blank is not None:
        b = blank_rule(blank, with_probs=False, decision="decision_score").withColumn(
            "gibberish_override", F.lit(0))
        out = out.unionByName(b.select(*keep))
    return out


def overridden_rows(df: DataFrame, id_col: str = "review_id") -> DataFrame:
    """K8: the ids of the rows that a rule decided against the model."""
    flag = F.col("overridden") if "overridden" in df.columns else F.col("gibberish_override") == 1
    return df.where(flag).select(id_col)


def restore_order(df: DataFrame, id_col: str = "review_id") -> DataFrame:
    """K7: input order, applied at the sink only."""
    return df.orderBy(id_col)


def prediction_summary(df: DataFrame, high: float = 0.8, digits: int = 6) -> DataFrame:
    """K8: one row: rows, FAKE / REAL counts and shares, confidence mean,
    exact median, sample std, count above ``high``, overridden rows."""
    from trustlens.operators.profiling import exact_median
    from trustlens.session import materialize
    c = F.col("confidence")
    n = F.count(F.lit(1))
    # the scored rows are read more than once below: score them once
    keep = [x for x in ("predicted_label", "confidence", "overridden") if x in df.columns]
    df = materialize(df.select(*keep), "prediction_summary")
    agg = [
        n.alias("rows"),
        F.count_if(F.col("predicted_label") == "FAKE").alias("n_fake"),
        F.count_if(F.col("predicted_label") == "REAL").alias("n_real"),
        F.round(F.count_if(F.col("predicted_label") == "FAKE") * 100.0 / n, digits).alias("pct_fake"),
        F.round(F.avg(c), digits).alias("confidence_mean"),
        F.round(F.stddev_samp(c), digits).alias("confidence_std"),
        F.count_if(c > high).alias("n_high_confidence"),
    ]
    if "overridden" in df.columns:
        agg.append(F.count_if(F.col("overridden")).alias("n_overridden"))
    median = exact_median(df, "confidence").select(F.round("median", digits).alias("confidence_median"))
    return df.agg(*agg).crossJoin(F.broadcast(median))
