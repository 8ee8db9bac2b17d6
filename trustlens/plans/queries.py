"""Registered queries: one callable per operator group, (spark, sf_dir) -> DataFrame.

Every query reads the driver tables (or tables Spark derives from them) whole:
no id subsets, prefixes or row caps. Limits appear only where the limit is the
operator (top-k report, fixed-size sample, previews). Doubles are rounded to 6
digits so the SQL oracle can compare values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustlens.functions import lexicons as L
from trustlens.functions.quality import with_text_quality
from trustlens.operators import cleaning as C
from trustlens.operators import evaluation as EV
from trustlens.operators import labeling as LB
from trustlens.operators import profiling as P
from trustlens.operators import sampling as SM
from trustlens.operators import vectorize as V
from trustlens.sources.adapters import read_table, reviews_raw, reviews_scraped

D = 6  # rounding digits for doubles


def _r(c, digits: int = D):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# --- shared derived tables ---------------------------------------------------------

def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return LB.label_reviews(reviews_scraped(spark, sf))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents")


def given_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews with a given label (labels table), id and label only."""
    return reviews_raw(spark, sf).where(F.col("label").isNotNull()).select("review_id", "label")


def orders_status(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a skewed three-class table for balancing (label = status)."""
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("review_id"), F.col("o_orderstatus").alias("label"))


def preprocessed_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """C15 on the review table: non-blank texts with ``text_preprocessed``."""
    return C.preprocess_job(reviews_raw(spark, sf).select("review_id", "text", "label"))


def tokens_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents, preprocessed and tokenised (I1-I5 input)."""
    d = documents(spark, sf).select(F.col("doc_id").alias("review_id"), "text")
    return V.with_tokens(C.preprocess(d, "text"))


# --- labelling and profiling (A, B, E13-E15, F, G) -----------------------------------

def q_label_distribution(spark, sf):
    return P.distribution(labelled(spark, sf), "label")


def q_label_reviews(spark, sf):
    return labelled(spark, sf).select(
        "review_id", "stars", F.col("reviewernumberofreview").alias("reviewer_reviews"),
        F.col("islocalguid").alias("is_local_guide"),
        F.date_format("publish_day", "yyyy-MM-dd").alias("publish_day"),
        "has_image", "text_len_words", "same_day_count", "fake_score", "label", "reason")


def q_fake_score_histogram(spark, sf):
    return P.score_histogram(labelled(spark, sf), "fake_score", LB.FAKE_THRESHOLD)


def q_stars_value_counts(spark, sf):
    return P.value_counts(labelled(spark, sf), "stars")


def q_distinct_titles(spark, sf):
    return P.distinct_values(labelled(spark, sf), "title")


def q_duplicate_titles(spark, sf):
    return P.duplicates(labelled(spark, sf), "title")


def q_text_length_histogram(spark, sf):
    return P.histogram(labelled(spark, sf), "text_len_words", 30, 0.0, 200.0).select(
        "bin", _r("bin_start").alias("bin_start"), _r("bin_end").alias("bin_end"), "count")


def q_photo_rate(spark, sf):
    return P.rate(labelled(spark, sf), "has_image")


def q_count_fake(spark, sf):
    return P.count_where(labelled(spark, sf), F.col("label") == "FAKE", "n_fake")


def q_class_counts(spark, sf):
    enc = LB.encode_label(labelled(spark, sf), "alphabet")
    return P.class_counts(enc, "y")


def q_five_star_short_preview(spark, sf):
    return LB.stars_short_preview(labelled(spark, sf), 5).drop("text")


def q_sample_labelled(spark, sf):
    return P.sample_n(labelled(spark, sf), 50, 42, "review_id",
                      ["review_id", "title", "stars", "fake_score", "label"])


def q_same_day_events(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    out = LB.same_day_count(ev, "ts", null_day_count=1)
    return out.select("event_id", F.date_format("publish_day", "yyyy-MM-dd").alias("publish_day"),
                      "same_day_count")


# --- text quality (D) ---------------------------------------------------------------

def tq_documents(spark, sf):
    d = documents(spark, sf).select("doc_id", "lang", "text")
    return with_text_quality(d, "text")


def q_text_quality(spark, sf):
    d = tq_documents(spark, sf)
    cols = [F.col("doc_id")]
    for name in L.TEXT_QUALITY_FEATURES:
        c = F.col(name)
        cols.append(_r(c).alias(name) if name in (
            "tq_vowel_ratio", "tq_valid_word_ratio", "tq_avg_word_length", "tq_entropy",
            "tq_repeated_ratio", "tq_consonant_cluster", "tq_gibberish_score") else c)
    return d.select(*cols)


def q_gibberish_stats(spark, sf):
    d = tq_documents(spark, sf)
    return d.groupBy("lang").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("tq_is_gibberish").cast("long").alias("flagged"),
        _r(F.avg("tq_gibberish_score")).alias("mean_score"))


def q_top_gibberish(spark, sf):
    d = tq_documents(spark, sf)
    return (d.orderBy(F.desc("tq_gibberish_score"), F.asc("doc_id")).limit(20)
             .select("doc_id", "lang", _r("tq_gibberish_score").alias("score"),
                     _r("tq_valid_word_ratio").alias("valid_word_ratio")))


def q_gibberish_compare(spark, sf):
    r = reviews_raw(spark, sf).select("review_id", "text")
    r = C.preprocess(r, "text")
    r = with_text_quality(r, "text", prefix="raw_")
    r = with_text_quality(r, "text_preprocessed", prefix="pre_")
    return r.select(
        "review_id",
        _r("raw_gibberish_score").alias("raw_score"),
        F.col("raw_is_gibberish").alias("raw_flag"),
        _r("pre_gibberish_score").alias("pre_score"),
        F.col("pre_is_gibberish").alias("pre_flag"))


# --- preprocessing (C) ---------------------------------------------------------------

def q_preprocess_reviews(spark, sf):
    return preprocessed_reviews(spark, sf).select("review_id", "text_preprocessed")


def q_preprocess_stats(spark, sf):
    return C.blank_stats(reviews_raw(spark, sf), "text")


# --- balancing and splits (H) --------------------------------------------------------

def q_class_profile_orders(spark, sf):
    return SM.class_profile(orders_status(spark, sf), "label")


def q_undersample_orders(spark, sf):
    return SM.undersample(orders_status(spark, sf)).select("review_id", "label", "copy_no")


def q_oversample_labels(spark, sf):
    return SM.oversample(given_labels(spark, sf)).select("review_id", "label", "copy_no")


def q_hybrid_labels(spark, sf):
    return SM.hybrid_balance(given_labels(spark, sf)).select("review_id", "label", "copy_no")


def q_balance_comparison(spark, sf):
    return SM.balance_comparison(given_labels(spark, sf))


def q_balance_status(spark, sf):
    return SM.balance_status(given_labels(spark, sf))


def q_shuffle_positions(spark, sf):
    return SM.shuffle_positions(given_labels(spark, sf)).select("review_id", "label", "position")


def q_split_exact(spark, sf):
    return SM.split_exact(given_labels(spark, sf)).select("review_id", "label", "set")


def q_split_stratified(spark, sf):
    return SM.split_stratified(given_labels(spark, sf)).select("review_id", "label", "set")


def q_split_validation(spark, sf):
    train = SM.split_exact(given_labels(spark, sf)).where(F.col("set") == "train").drop("rank")
    return SM.split_validation(train).select("review_id", "is_validation")


def q_bootstrap_bags(spark, sf):
    return SM.bootstrap_weights(given_labels(spark, sf), 30)


# --- vectorisation (I) ----------------------------------------------------------------

def q_term_stats(spark, sf):
    return V.term_stats(tokens_docs(spark, sf))


def q_vocabulary(spark, sf):
    return V.vocabulary(tokens_docs(spark, sf), V.MAX_FEATURES).withColumn("idf", _r("idf"))


def q_tfidf(spark, sf):
    # the tokens feed both the vocabulary and the weights: computed once,
    # lineage cut in the shared checkpoint folder
    from trustlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    from trustlens.session import materialize
    t = materialize(tokens_docs(spark, sf).select("review_id", "tokens"), "doc_tokens")
    return V.tfidf(t, V.vocabulary(t, V.MAX_FEATURES)).withColumn("tfidf", _r("tfidf"))


def q_term_frequency(spark, sf):
    # the tokens feed both the counts and the reviews' sizes: computed once
    from trustlens.session import ensure_checkpoint_dir, materialize
    ensure_checkpoint_dir(spark)
    return V.term_frequency(materialize(tokens_docs(spark, sf).select("review_id", "tokens"), "doc_tokens")).select(
        "review_id", "term", "tf_count", _r("tf").alias("tf"))


# --- naive Bayes on labelled documents (J1-J6), scaler (I7, I8), evaluation (L) ----------

def labelled_docs(spark, sf) -> DataFrame:
    """Documents with a given label (y: quality 0 -> FAKE = 1, 1 -> REAL = -1),
    preprocessed, tokenised, with the 14 quality features of the raw text."""
    lab = read_table(spark, sf, "labels").select(
        F.col("doc_id").alias("review_id"),
        F.when(F.col("quality") == 0, F.lit(1)).otherwise(F.lit(-1)).alias("y"))
    d = documents(spark, sf).select(F.col("doc_id").alias("review_id"), "text")
    d = d.join(lab, "review_id", "inner")
    d = with_text_quality(d, "text")
    return V.with_tokens(C.preprocess(d, "text"))


NB_COLS = list(L.TEXT_QUALITY_FEATURES)


def nb_split(spark, sf):
    """Labelled documents with their train / test set, checkpointed: the
    vocabulary, scaler, both NB fits and the scoring all read this table, so
    it is computed once and its lineage is cut (shared checkpoint folder)."""
    from trustlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    from trustlens.session import materialize
    return materialize(SM.split_exact(labelled_docs(spark, sf)).drop("rank"), "nb_docs")


def nb_model(spark, sf):
    from trustlens.operators.bayes import fit_hybrid_nb
    data = nb_split(spark, sf)
    train = data.where(F.col("set") == "train")
    return data, fit_hybrid_nb(train, NB_COLS, k=V.MAX_FEATURES)


def q_scaler_fit(spark, sf):
    data = nb_split(spark, sf).where(F.col("set") == "train")
    sc = V.scaler_table(V.fit_scaler(data, NB_COLS), NB_COLS)
    return sc.select("feature", _r("mean").alias("mean"), _r("scale").alias("scale"))


def q_nb_text_fit(spark, sf):
    _, m = nb_model(spark, sf)
    return m.log_prob.withColumn("log_prob", _r("log_prob"))


def q_nb_gaussian_fit(spark, sf):
    _, m = nb_model(spark, sf)
    stack = ", ".join(f"'{c}', `mean__{c}`, `var__{c}`" for c in NB_COLS)
    return m.gauss.selectExpr("y", "n", "prior",
                              f"stack({len(NB_COLS)}, {stack}) AS (feature, mean, var)").select(
        "y", "n", _r("prior").alias("prior"), "feature", _r("mean").alias("mean"),
        _r("var").alias("var"))


def nb_predictions(spark, sf):
    from trustlens.operators.bayes import predict_hybrid_nb
    data, m = nb_model(spark, sf)
    return predict_hybrid_nb(m, data)


def q_nb_predict(spark, sf):
    p = nb_predictions(spark, sf)
    return p.select("review_id", "set", "y", "y_pred", _r("prob_fake").alias("prob_fake"),
                    _r("prob_real").alias("prob_real"))


def q_nb_metrics(spark, sf):
    m = EV.metrics_by_set(nb_predictions(spark, sf))
    return m.select("set", "tp", "fp", "tn", "fn", *[_r(c).alias(c) for c in
                                                    ("accuracy", "precision", "recall", "f1")])


def _nb_labelled_preds(spark, sf):
    p = nb_predictions(spark, sf)
    return p.select(
        "review_id",
        F.when(F.col("y") == 1, "FAKE").otherwise("REAL").alias("label"),
        F.when(F.col("y_pred") == 1, "FAKE").otherwise("REAL").alias("predicted_label"))


def q_confusion_matrix(spark, sf):
    return EV.confusion_matrix(_nb_labelled_preds(spark, sf))


def q_classification_report(spark, sf):
    r = EV.classification_report(_nb_labelled_preds(spark, sf))
    return r.select("cls", "support", *[_r(c).alias(c) for c in ("precision", "recall", "f1")])


# --- trees, SVM, covariance on embeddings (J7, J10, J13-J15, J19, J22, J23) ----------------

EMB_DIM = 64


def embeddings_wide(spark, sf, dims: int = EMB_DIM) -> DataFrame:
    """Embeddings as numeric columns e0..e63 with y: label < 5 -> FAKE (1), else -1."""
    e = read_table(spark, sf, "embeddings")
    cols = [F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(dims)]
    return e.select(F.col("vec_id").alias("review_id"),
                    F.when(F.col("label") < 5, F.lit(1)).otherwise(F.lit(-1)).alias("y"), *cols)


def q_gini_by_lang(spark, sf):
    from trustlens.operators.forest import gini
    d = labelled_docs_plain(spark, sf)
    return gini(d, ["lang"]).withColumn("gini", _r("gini"))


def labelled_docs_plain(spark, sf):
    lab = read_table(spark, sf, "labels").select("doc_id", "quality")
    return documents(spark, sf).join(lab, "doc_id", "inner").select(
        "doc_id", "lang", F.when(F.col("quality") == 0, F.lit(1)).otherwise(F.lit(-1)).alias("y"))


def q_best_split(spark, sf):
    from trustlens.operators.forest import best_split, to_long
    w = embeddings_wide(spark, sf)
    long = to_long(w, "review_id", [f"e{i}" for i in range(EMB_DIM)]).withColumn("node", F.lit(0))
    return best_split(long, "node", 2).select(
        "node", "feature", _r("threshold").alias("threshold"), _r("gain").alias("gain"),
        "n_left", "n_right")


def q_covariance(spark, sf):
    from trustlens.operators.svm import covariance
    return covariance(embeddings_wide(spark, sf), [f"e{i}" for i in range(EMB_DIM)])


# --- fixed values: the weights the SVM checks use (w_j = ((j mod 7) - 3) / 10, b = 0.1)
SVM_B = 0.1


def svm_weights(dims: int = EMB_DIM):
    return [((j % 7) - 3) / 10.0 for j in range(dims)]


def emb_vectors(spark, sf):
    from trustlens.operators.vectorize import assemble
    w = embeddings_wide(spark, sf)
    return assemble(w, [f"e{i}" for i in range(EMB_DIM)])


def q_svm_loss_grad(spark, sf):
    """J7 at fixed weights: loss and gradient as a long table
    (component -2 = loss, -1 = bias gradient, 0.. = weight gradient)."""
    import numpy as np

    from trustlens.operators.svm import LAMBDA, hinge_sums
    w = np.array(svm_weights())
    sums = hinge_sums(emb_vectors(spark, sf), w, SVM_B)
    reg = LAMBDA * float(np.dot(w, w))
    wl = F.array(*[F.lit(float(x)) for x in w])
    grad = F.zip_with("sum_myx", wl,
                      lambda s, wj: F.lit(2 * LAMBDA) * wj - s / F.col("n"))
    head = sums.select(F.lit(-2).alias("component"), (F.col("hinge") / F.col("n") + reg).alias("value"))
    bias = sums.select(F.lit(-1).alias("component"), (-F.col("sum_my") / F.col("n")).alias("value"))
    comps = sums.select(F.posexplode(grad).alias("component", "value"))
    return head.unionByName(bias).unionByName(comps).withColumn("value", _r("value"))


def q_svm_score(spark, sf):
    import numpy as np

    from trustlens.operators.svm import LinearSVMModel, score_svm
    m = LinearSVMModel(np.array(svm_weights()), SVM_B, [])
    return score_svm(emb_vectors(spark, sf), m).select(
        "review_id", _r("decision_score").alias("decision_score"), "y_pred")


def q_forest_votes(spark, sf):
    """J19 + J22 + J23 (MLlib forest, rows and invariants only)."""
    from trustlens.operators.forest import fit_forest, tree_vote_columns
    d = emb_vectors(spark, sf)
    m = fit_forest(d, n_trees=30, max_depth=12)
    return tree_vote_columns(d, m).select("review_id", "voted", "votes", "share_fake",
                                          "share_real")


def q_nb_scoring(spark, sf):
    """K1 + K4 + K6: NB fitted on the given labels, scoring every review."""
    from trustlens.operators.bayes import fit_hybrid_nb
    from trustlens.operators.features import build_features
    from trustlens.operators.scoring import score_reviews_nb
    from trustlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    raw = reviews_raw(spark, sf)
    train = V.with_tokens(build_features(raw.where(F.col("label").isNotNull())))
    from trustlens.session import materialize
    train = materialize(LB.encode_label(train, "signed"), "review_train")
    model = fit_hybrid_nb(train, list(L.NUMERIC_FEATURES))
    out = score_reviews_nb(raw, model)
    return out.select("review_id", "predicted_label", _r("confidence").alias("confidence"),
                      _r("prob_fake").alias("prob_fake"), "overridden")


def q_prediction_summary(spark, sf):
    """K8 over the NB scoring job."""
    from trustlens.operators.scoring import prediction_summary
    return prediction_summary(q_nb_scoring(spark, sf))


# --- the trainers' feature table (E1-E19) ----------------------------------------------

def q_review_features(spark, sf):
    """E18 on the raw reviews: the 18 base numeric features (the 14 quality
    features of the same table are the ``text_quality`` operators)."""
    from trustlens.operators.features import build_features
    f = build_features(reviews_raw(spark, sf))
    cols = [F.col("review_id"), F.col("publish_hour")]
    for c in L.BASE_NUMERIC_FEATURES:
        cols.append(_r(c).alias(c) if c in ("avg_word_length", "uppercase_word_ratio", "stars_norm",
                                            "reviewer_count_log") else F.col(c))
    return f.select(*cols)


def q_image_features(spark, sf):
    """E10-E12 on the raw image field."""
    from trustlens.functions.features import has_image_simple, image_features, parse_image_urls
    r = reviews_raw(spark, sf).select("review_id", "reviewImageUrls")
    r = r.withColumn("images", parse_image_urls("reviewImageUrls"))
    return r.select("review_id", *[v.alias(k) for k, v in image_features(F.col("images")).items()],
                    has_image_simple("reviewImageUrls").alias("has_image_simple"))


# --- more operators: F8, G10, J8/J11, J9, J12, J20, J21, L6, L7, K2, K3 ---------------------

def q_label_correction(spark, sf):
    """F8 on labelled documents: gibberish (flag and score > 0.7) becomes FAKE."""
    d = labelled_docs_plain(spark, sf).join(
        documents(spark, sf).select("doc_id", "text"), "doc_id")
    d = with_text_quality(d, "text").withColumn(
        "label", F.when(F.col("y") == 1, F.lit("FAKE")).otherwise(F.lit("REAL")))
    return LB.correction_counts(LB.correct_labels(d, 0.7))


def q_confidence_stats(spark, sf):
    """G10 over SVM confidences 1 / (1 + e^-|s|) (K2) at the fixed weights."""
    from trustlens.operators.scoring import svm_confidence
    s = q_svm_score(spark, sf).withColumn("confidence", svm_confidence())
    return P.confidence_stats(s, "confidence", 0.8)


def _emb_split(spark, sf):
    from trustlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    from trustlens.session import materialize
    return materialize(SM.split_exact(emb_vectors(spark, sf)).drop("rank"), "emb_split")


def q_svm_gd_history(spark, sf):
    """J8 + J9 (validation cut) + J11: gradient descent with its own limits (2,000 steps,
    early stopping with patience 50); the loss history table."""
    from trustlens.operators.svm import fit_linear_svm
    d = _emb_split(spark, sf)
    train = SM.split_validation(d.where(F.col("set") == "train"))
    m = fit_linear_svm(train.where(~F.col("is_validation")), train.where(F.col("is_validation")))
    return m.loss_history(spark)


def q_linear_svc(spark, sf):
    """MLlib LinearSVC with the reference objective; test-set predictions."""
    from trustlens.operators.svm import fit_linear_svc
    d = _emb_split(spark, sf)
    m = fit_linear_svc(d.where(F.col("set") == "train"))
    return m.transform(d.where(F.col("set") == "test")).select("review_id", "y", "prediction")


def q_pca(spark, sf):
    """Centred two-component PCA of the embeddings."""
    from pyspark.ml.functions import vector_to_array
    from trustlens.operators.svm import fit_pca, project_pca
    d = emb_vectors(spark, sf)
    p = project_pca(d, fit_pca(d, 2))
    return p.select("review_id", "y", vector_to_array("pca").alias("pc"))


def _emb_rows(spark, sf):
    """review_id, y and the embedding as an array."""
    return embeddings_wide(spark, sf).select("review_id", "y", F.array(*[F.col(f"e{i}") for i in range(EMB_DIM)]).alias("feature_values"))


def q_oob_score(spark, sf):
    """J18 + J19 + J20: out-of-bag accuracy of 30 exact trees grown on their bags."""
    from trustlens.operators.forest import oob_score
    d = _emb_rows(spark, sf)
    return oob_score(d, SM.bootstrap_weights(d, 30), 30)


# --- fixed values: three trees as (node, feature, threshold, left, right, prediction)
GIVEN_TREES = (
    ((0, 3, 0.02, 1, 2, None), (1, 10, -0.05, 3, 4, None), (2, None, None, None, None, -1),
     (3, None, None, None, None, 1), (4, None, None, None, None, -1)),
    ((0, 46, -0.08, 1, 2, None), (1, None, None, None, None, 1), (2, 0, 0.1, 3, 4, None),
     (3, None, None, None, None, -1), (4, None, None, None, None, 1)),
    ((0, 7, 0.0, 1, 2, None), (1, None, None, None, None, -1), (2, None, None, None, None, 1)),
)


def q_given_forest(spark, sf):
    """J17 + J22 + J23: every embedding down three given trees, their vote and vote shares."""
    from trustlens.operators.forest import predict_forest
    nodes = spark.createDataFrame([(t, *n) for t, own in enumerate(GIVEN_TREES) for n in own],
                                  "tree int, node_id long, feature_id int, threshold double, left long, right long, prediction int")
    d = predict_forest(_emb_rows(spark, sf), nodes)
    return d.select("review_id", F.array_join("tree_predictions", ",").alias("tree_predictions"), "voted", "votes",
                    _r("share_fake").alias("share_fake"), _r("share_real").alias("share_real"))


def q_bagged_forest(spark, sf):
    """J16 + J18 + J19 + J22: exact trees grown together on their bags, the vote on every row."""
    from trustlens.operators.forest import fit_bagged_forest, predict_forest
    d = _emb_rows(spark, sf)
    nodes, _ = fit_bagged_forest(d, SM.bootstrap_weights(d, 30), 30)
    return predict_forest(d, nodes).select("review_id", "voted", "votes", "share_fake", "share_real")


def q_rf_importances(spark, sf):
    """J19 + J21: split-count importances of the MLlib forest, with names."""
    from trustlens.operators.forest import fit_forest, node_table, split_importances
    import uuid

    from trustlens.session import checkpoint_path
    d = emb_vectors(spark, sf)
    m = fit_forest(d)
    nodes = node_table(m, checkpoint_path(spark, f"rf_model_importances-{uuid.uuid4().hex}"), spark)
    names = spark.range(EMB_DIM).select(F.col("id").cast("int").alias("feature_id"),
                                        F.concat(F.lit("e"), F.col("id")).alias("name"))
    return split_importances(nodes, names)


def q_nb_overfit(spark, sf):
    """L6 + L7 on the NB documents model."""
    p = nb_predictions(spark, sf).withColumns({
        "y_text": F.when(F.col("text_fake") > F.col("text_real"), 1).otherwise(-1),
        "y_num": F.when(F.col("num_fake") > F.col("num_real"), 1).otherwise(-1)})
    acc = EV.component_accuracy(p)
    gap = EV.overfit_gap(EV.metrics_by_set(p))
    return acc.crossJoin(gap)


def q_cart(spark, sf):
    """J16 + J17: CART (depth 12, leaf >= 2) grown level-wise on the training
    embeddings, predictions for every row."""
    from trustlens.operators.forest import fit_cart, predict_cart
    split = SM.split_exact(_emb_rows(spark, sf)).drop("rank")
    nodes = fit_cart(split.where(F.col("set") == "train"))
    return predict_cart(split, nodes).drop("feature_values")


def _review_training(spark, sf, correct: bool = False):
    """Feature table of the reviews with a given label (gibberish among them made FAKE
    first if ``correct``, F8), vocabulary and scaler fitted on it, and assembled vectors
    (I6 + I8 + I9) for SVM / RF."""
    from trustlens.operators.features import build_features
    from trustlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    raw = reviews_raw(spark, sf)
    cols = list(L.NUMERIC_FEATURES)
    feats = V.with_tokens(build_features(raw.where(F.col("label").isNotNull())))
    from trustlens.session import materialize
    feats = LB.correct_labels(feats) if correct else feats
    feats = materialize(LB.encode_label(feats, "signed"), "review_train")
    # bounded model tables and the training vectors are read many times: written once
    vocab = materialize(V.vocabulary(feats, V.MAX_FEATURES), "review_vocab")
    scaler = materialize(V.fit_scaler(feats, cols), "review_scaler")
    x = V.scale(feats, scaler, cols, suffix="__s")
    x = V.tfidf_vector(x, vocab)
    x = V.assemble(x, ["text_features"] + [f"{c}__s" for c in cols])
    return raw, vocab, scaler, cols, materialize(x.select("review_id", "y", "features"), "review_vectors")


def q_svm_scoring(spark, sf):
    """K2 + K4 + K6: linear SVM on the labelled reviews, scoring every review. MLlib's
    optimiser brings the same objective to its minimum; gradient descent in full is
    ``svm_gd_history``'s subject."""
    from trustlens.operators.scoring import score_reviews_svm
    from trustlens.operators.svm import fit_linear_svc, linear_model
    raw, vocab, scaler, cols, x = _review_training(spark, sf)
    m = linear_model(fit_linear_svc(x))
    out = score_reviews_svm(raw, vocab, scaler, cols, m)
    return out.select("review_id", "predicted_label", _r("confidence").alias("confidence"),
                      _r("decision_score").alias("decision_score"), "overridden")


def q_rf_scoring(spark, sf):
    """K3 + K5: MLlib forest (30 trees, depth 12) on the labelled reviews after label
    correction, per-tree votes for every review, flagged gibberish override."""
    from trustlens.operators.forest import fit_forest
    from trustlens.operators.scoring import score_reviews_rf
    raw, vocab, scaler, cols, x = _review_training(spark, sf, correct=True)
    forest = fit_forest(x)
    out = score_reviews_rf(raw, vocab, scaler, cols, forest)
    return out.select("review_id", "predicted_label", _r("confidence").alias("confidence"),
                      _r("decision_score").alias("decision_score"), "gibberish_override")


def q_baselines(spark, sf):
    """J24 + I10 + L4: the labeller's baselines on heuristic labels (stratified
    80/20), the classification report of each model on the test part."""
    from trustlens.operators.forest import train_baselines
    d = labelled(spark, sf)
    d = d.withColumns({"has_image_i": F.col("has_image").cast("int"),
                       "islocalguid_i": F.col("islocalguid").cast("int")})
    d = LB.encode_label(d, "signed")
    from trustlens.session import materialize
    # read by every stage of three fits, and the predictions by every line of a report
    split = materialize(SM.split_stratified(d, "label").select(
        "label", "y", "set", "text", *L.LABELLER_NUMERIC_FEATURES), "baseline_rows")
    train, test = split.where(F.col("set") == "train"), split.where(F.col("set") == "test")
    models = train_baselines(train, "text", list(L.LABELLER_NUMERIC_FEATURES))
    # all models but the text-only one share every stage up to the classifier, and that
    # one's stages are among them: the test part's vectors are made once
    for stage in models["LinearSVC"].stages[:-1]:
        test = stage.transform(test)
    test = materialize(test.select("label", "text_features", "_features"), "baseline_vectors")
    out = None
    for name, m in models.items():
        p = m.stages[-1].transform(test).select("label", F.when(F.col("prediction") == 1.0, "FAKE").otherwise("REAL")
                                     .alias("predicted_label"))
        r = EV.classification_report(materialize(p, "baseline_predictions")).withColumn("model", F.lit(name))
        out = r if out is None else out.unionByName(r)
    return out


QUERIES = {
    "label_distribution": q_label_distribution,
    "label_reviews": q_label_reviews,
    "fake_score_histogram": q_fake_score_histogram,
    "stars_value_counts": q_stars_value_counts,
    "distinct_titles": q_distinct_titles,
    "duplicate_titles": q_duplicate_titles,
    "text_length_histogram": q_text_length_histogram,
    "photo_rate": q_photo_rate,
    "count_fake": q_count_fake,
    "class_counts": q_class_counts,
    "five_star_short_preview": q_five_star_short_preview,
    "sample_labelled": q_sample_labelled,
    "same_day_events": q_same_day_events,
    "text_quality": q_text_quality,
    "gibberish_stats": q_gibberish_stats,
    "top_gibberish": q_top_gibberish,
    "gibberish_compare": q_gibberish_compare,
    "preprocess_reviews": q_preprocess_reviews,
    "preprocess_stats": q_preprocess_stats,
    "class_profile_orders": q_class_profile_orders,
    "undersample_orders": q_undersample_orders,
    "oversample_labels": q_oversample_labels,
    "hybrid_labels": q_hybrid_labels,
    "balance_comparison": q_balance_comparison,
    "balance_status": q_balance_status,
    "shuffle_positions": q_shuffle_positions,
    "split_exact": q_split_exact,
    "split_stratified": q_split_stratified,
    "split_validation": q_split_validation,
    "bootstrap_bags": q_bootstrap_bags,
    "term_stats": q_term_stats,
    "vocabulary": q_vocabulary,
    "tfidf": q_tfidf,
    "term_frequency": q_term_frequency,
    "scaler_fit": q_scaler_fit,
    "nb_text_fit": q_nb_text_fit,
    "nb_gaussian_fit": q_nb_gaussian_fit,
    "nb_predict": q_nb_predict,
    "nb_metrics": q_nb_metrics,
    "confusion_matrix": q_confusion_matrix,
    "classification_report": q_classification_report,
    "gini_by_lang": q_gini_by_lang,
    "best_split": q_best_split,
    "covariance": q_covariance,
    "svm_loss_grad": q_svm_loss_grad,
    "svm_score": q_svm_score,
    "forest_votes": q_forest_votes,
    "nb_scoring": q_nb_scoring,
    "prediction_summary": q_prediction_summary,
    "review_features": q_review_features,
    "image_features": q_image_features,
    "label_correction": q_label_correction,
    "confidence_stats": q_confidence_stats,
    "svm_gd_history": q_svm_gd_history,
    "linear_svc": q_linear_svc,
    "pca": q_pca,
    "oob_score": q_oob_score,
    "given_forest": q_given_forest,
    "bagged_forest": q_bagged_forest,
    "rf_importances": q_rf_importances,
    "nb_overfit": q_nb_overfit,
    "cart": q_cart,
    "svm_scoring": q_svm_scoring,
    "rf_scoring": q_rf_scoring,
    "baselines": q_baselines,
}

