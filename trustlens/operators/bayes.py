"""Hybrid naive Bayes (J1-J6) as aggregations over long-form TF-IDF.

Classes are the signed labels FAKE = 1 and REAL = -1. Fitting is two
aggregations (per (class, term) sums, per class mean / variance); scoring is a
broadcast join of the (2 x vocabulary) log-probability table and one group-by
on ``review_id``. Nothing but the bounded model tables is broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALPHA = 1.0
TEXT_WEIGHT = 0.6
NUMERIC_WEIGHT = 0.4
VAR_EPS = 1e-9
LOG_EPS = 1e-12
CLASSES = (-1, 1)   # sorted, like numpy.unique


def class_priors(labels: DataFrame, y: str = "y") -> DataFrame:
    """Per class: n, prior n/N and ln(n/N) (unsmoothed)."""
    counts = labels.groupBy(y).agg(F.count(F.lit(1)).alias("n"))
    total = labels.agg(F.count(F.lit(1)).alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
                  .withColumn("prior", F.col("n") / F.col("_total"))
                  .withColumn("log_prior", F.log(F.col("n") / F.col("_total")))
                  .drop("_total"))


def fit_multinomial_nb(tfidf_long: DataFrame, labels: DataFrame, vocab: DataFrame,
                       alpha: float = ALPHA, id_col: str = "review_id", y: str = "y"
                       ) -> DataFrame:
    """``(y, term_id, log_prob)`` for every class and vocabulary term.

    log_prob = ln((sum_c,j + alpha) / (sum_c + alpha * V + 1e-12)), with V the
    vocabulary size; terms a class never saw get the alpha-only value.
    """
    classes = labels.select(y).distinct()
    sums = (tfidf_long.join(labels.select(id_col, y), id_col, "inner")
                      .groupBy(y, "term_id").agg(F.sum("tfidf").alias("wc")))
    grid = classes.crossJoin(F.broadcast(vocab.select("term_id")))   # classes x V, bounded
    v_size = vocab.agg(F.count(F.lit(1)).alias("_v"))
    full = grid.join(sums, [y, "term_id"], "left").fillna(0.0, ["wc"])
    totals = full.groupBy(y).agg(F.sum("wc").alias("_tot"))
    return (full.join(totals, y, "inner").crossJoin(F.broadcast(v_size))
                .withColumn("log_prob", F.log((F.col("wc") + alpha) /
                                              (F.col("_tot") + alpha * F.col("_v") + LOG_EPS)))
                .select(y, "term_id", "log_prob"))


def score_multinomial_nb(tfidf_long: DataFrame, log_prob: DataFrame, priors: DataFrame,
                         ids: DataFrame, id_col: str = "review_id", y: str = "y") -> DataFrame:
    """``(review_id, text_fake, text_real)`` = prior + sum_j x_j log p(j|c).

    Reviews without vocabulary terms keep the prior alone (left join).
    """
    lp = log_prob.groupBy("term_id").agg(
        F.max(F.when(F.col(y) == 1, F.col("log_prob"))).alias("lp_fake"),
        F.max(F.when(F.col(y) == -1, F.col("log_prob"))).alias("lp_real"))
    sums = (tfidf_long.join(F.broadcast(lp), "term_id", "inner")
                      .groupBy(id_col)
                      .agg(F.sum(F.col("tfidf") * F.col("lp_fake")).alias("_sf"),
                           F.sum(F.col("tfidf") * F.col("lp_real")).alias("_sr")))
    pr = priors.agg(F.max(F.when(F.col(y) == 1, F.col("log_prior"))).alias("_pf"),
                    F.max(F.when(F.col(y) == -1, F.col("log_prior"))).alias("_pr"))
    return (ids.select(id_col).join(sums, id_col, "left").crossJoin(F.broadcast(pr))
               .select(id_col,
                       (F.col("_pf") + F.coalesce(F.col("_sf"), F.lit(0.0))).alias("text_fake"),
                       (F.col("_pr") + F.coalesce(F.col("_sr"), F.lit(0.0))).alias("text_real")))


def fit_gaussian_nb(df: DataFrame, cols: list[str], y: str = "y") -> DataFrame:
    """One row per class: n, prior, ``mean__c`` and ``var__c`` (population
    variance + 1e-9)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs.append(F.avg(F.col(c).cast("double")).alias(f"mean__{c}"))
        aggs.append((F.var_pop(F.col(c).cast("double")) + VAR_EPS).alias(f"var__{c}"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return (df.groupBy(y).agg(*aggs).crossJoin(F.broadcast(total))
              .withColumn("prior", F.col("n") / F.col("_total")).drop("_total"))


def gaussian_wide(stats: DataFrame, cols: list[str], y: str = "y") -> DataFrame:
    """The two class rows of J3 folded into one row (fake__*, real__*)."""
    aggs = [F.max(F.when(F.col(y) == 1, F.col("prior"))).alias("fake__prior"),
            F.max(F.when(F.col(y) == -1, F.col("prior"))).alias("real__prior")]
    for c in cols:
        for side, v in (("fake", 1), ("real", -1)):
            aggs.append(F.max(F.when(F.col(y) == v, F.col(f"mean__{c}"))).alias(f"{side}__mean__{c}"))
            aggs.append(F.max(F.when(F.col(y) == v, F.col(f"var__{c}"))).alias(f"{side}__var__{c}"))
    return stats.agg(*aggs)


def score_gaussian_nb(df: DataFrame, stats: DataFrame, cols: list[str], y: str = "y"
                      ) -> DataFrame:
    """Adds ``num_fake`` / ``num_real`` log scores (one broadcast row)."""
    wide = gaussian_wide(stats, cols, y)
    out = df.crossJoin(F.broadcast(wide))

    def loglik(side: str):
        total = F.log(F.coalesce(F.col(f"{side}__prior"), F.lit(0.0)) + LOG_EPS)
        for c in cols:
            var = F.col(f"{side}__var__{c}")
            diff = F.col(c).cast("double") - F.col(f"{side}__mean__{c}")
            total = total + (-0.5 * F.log(2 * math.pi * var)) + (-0.5 * diff * diff / var)
        return total

    out = out.withColumns({"num_fake": loglik("fake"), "num_real": loglik("real")})
    return out.drop(*wide.columns)


def predict_component(fake: str, real: str, out: str) -> dict:
    """Argmax of two class scores; a tie goes to the first class (-1)."""
    return {out: F.when(F.col(fake) > F.col(real), F.lit(1)).otherwise(F.lit(-1))}


def hybrid_columns(text_w: float = TEXT_WEIGHT, num_w: float = NUMERIC_WEIGHT) -> dict:
    """Weighted log scores, stable softmax, argmax (tie -> REAL)."""
    cf = text_w * F.col("text_fake") + num_w * F.col("num_fake")
    cr = text_w * F.col("text_real") + num_w * F.col("num_real")
    m = F.greatest(cf, cr)
    ef = F.exp(cf - m)
    er = F.exp(cr - m)
    pf = ef / (ef + er)
    return {
        "prob_fake": pf,
        "prob_real": er / (ef + er),
        "y_pred": F.when(cf > cr, F.lit(1)).otherwise(F.lit(-1)),
    }


class HybridNBModel:
    """Fitted tables: vocabulary, scaler, text log-probs, priors, Gaussian stats."""

    def __init__(self, vocab, scaler, log_prob, priors, gauss, cols,
                 text_w=TEXT_WEIGHT, num_w=NUMERIC_WEIGHT):
        self.vocab, self.scaler, self.log_prob = vocab, scaler, log_prob
        self.priors, self.gauss, self.cols = priors, gauss, list(cols)
        self.text_w, self.num_w = text_w, num_w

    def tables(self) -> dict[str, DataFrame]:
        from trustlens.operators.vectorize import scaler_table
        return {"vocab": self.vocab, "scaler": scaler_table(self.scaler, self.cols),
                "nb_text": self.log_prob, "nb_prior": self.priors, "nb_numeric": self.gauss}


def fit_hybrid_nb(train: DataFrame, cols: list[str], k: int = 1000, alpha: float = ALPHA,
                  id_col: str = "review_id", y: str = "y", fit_on: DataFrame | None = None
                  ) -> HybridNBModel:
    """Fit vocabulary, scaler and both NB parts. ``fit_on`` (default: the
    training rows) is the table the vocabulary and scaler are fitted on; pass
    train + test for the reference's behaviour."""
    from trustlens.operators import vectorize as V
    from trustlens.session import materialize
    base = fit_on if fit_on is not None else train
    # the model's tables are bounded and read by every scoring plan: written once
    vocab = materialize(V.vocabulary(base, k, id_col), "nb_vocab")
    scaler = materialize(V.fit_scaler(base, cols), "nb_scaler")
    long = V.tfidf(train, vocab, id_col)
    labels = train.select(id_col, y)
    log_prob = fit_multinomial_nb(long, labels, vocab, alpha, id_col, y)
    priors = class_priors(labels, y)
    priors = materialize(priors, "nb_prior")
    gauss = materialize(fit_gaussian_nb(V.scale(train, scaler, cols), cols, y), "nb_numeric")
    return HybridNBModel(vocab, scaler, materialize(log_prob, "nb_text"), priors, gauss, cols)


def predict_hybrid_nb(model: HybridNBModel, df: DataFrame, id_col: str = "review_id"
                      ) -> DataFrame:
    """Score a tokenised feature table: adds text/num scores, probabilities, y_pred."""
    from trustlens.operators import vectorize as V
    long = V.tfidf(df, model.vocab, id_col)
    text = score_multinomial_nb(long, model.log_prob, model.priors, df, id_col)
    # The features themselves are needed later (overrides test the raw score): they
    # are put back after the scaled ones have been scored.
    raw = F.struct(*[F.col(c) for c in model.cols]).alias("__features")
    scaled = V.scale(df.select("*", raw), model.scaler, model.cols)
    num = score_gaussian_nb(scaled, model.gauss, model.cols)
    num = num.withColumns({c: F.col(f"__features.{c}") for c in model.cols}).drop("__features")
    return num.join(text, id_col, "inner").withColumns(hybrid_columns(model.text_w, model.num_w))
