"""Findings of the first review: raw-score override, blank rule, null labels, number texts."""

import pytest
from pyspark.sql import functions as F

from trustlens.operators import sampling, scoring
from trustlens.sources.schema import coerce_number


def test_override_boundary(spark):
    rows = [(s, "REAL", 0.5, 0.5, 0.5) for s in (0.60, 0.65, 0.70, 0.75)]
    df = spark.createDataFrame(rows, "tq_gibberish_score double, predicted_label string, confidence double, prob_fake double, prob_real double")
    got = [r["overridden"] for r in scoring.override_gibberish(df).orderBy("tq_gibberish_score").collect()]
    assert got == [False, False, True, True]


def test_null_labels_are_ranked_and_split(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else None) for i in range(8)], "review_id long, label string")
    assert sampling.split_stratified(df).count() == 8


def test_number_texts(spark):
    df = spark.createDataFrame([(x,) for x in ("5d", "5f", "7", "4.9", " 3 ", None, "x", "1e2", "3000000000", "1e30")], "a string")
    assert [r[0] for r in df.select(coerce_number("a").alias("n")).collect()] == [0, 0, 7, 4, 3, 0, 0, 100, 3_000_000_000, 0]


def test_nb_predictions_keep_the_raw_features(spark):
    from trustlens.operators.bayes import fit_hybrid_nb, predict_hybrid_nb
    rows = [(i, ["good", "food"] if i % 2 else ["bad", "spam"], float(i), 1 if i % 2 else -1) for i in range(8)]
    df = spark.createDataFrame(rows, "review_id long, tokens array<string>, score double, y int")
    got = predict_hybrid_nb(fit_hybrid_nb(df, ["score"], k=10), df)
    assert sorted(r["score"] for r in got.select(F.col("score")).collect()) == [float(i) for i in range(8)]


def test_balancing_keeps_the_middle_class(spark):
    labels = ["a"] * 9 + ["b"] * 5 + ["c"] * 3 + [None]
    df = spark.createDataFrame(list(enumerate(labels)), "review_id long, label string")
    sizes = lambda d: {r["label"]: r["count"] for r in d.groupBy("label").count().collect()}
    assert sizes(sampling.undersample(df)) == {"a": 3, "b": 5, "c": 3, None: 1}
    assert sizes(sampling.oversample(df)) == {"a": 9, "b": 5, "c": 9, None: 1}
    assert sizes(sampling.hybrid_balance(df)) == {"a": 6, "b": 5, "c": 6, None: 1}


def test_comparison_gives_the_sizes_of_the_samples(spark):
    for labels in (["a"] * 9 + ["b"] * 5 + ["c"] * 3 + [None], ["a"] * 4, ["a"] * 3 + ["b"] * 2, []):
        df = spark.createDataFrame(list(enumerate(labels)), "review_id long, label string")
        got = {r["dataset"]: r["total"] for r in sampling.balance_comparison(df).collect()}
        assert got == {"Original": len(labels), "Undersampling": sampling.undersample(df).count(),
                       "Oversampling": sampling.oversample(df).count(),
                       "Kombinasi": sampling.hybrid_balance(df).count()}


def test_exact_median(spark):
    import random
    import statistics

    from trustlens.operators.profiling import exact_median
    r = random.Random(4)
    for values in ([], [2.0], [1.0, 4.0], [1.0] * 50 + [0.5] * 50, [r.random() for _ in range(5001)],
                   [round(r.random(), 1) for _ in range(4000)] + [None] * 9):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        here = [v for v in values if v is not None]
        assert exact_median(df, "x").first()[0] == (statistics.median(here) if here else None)


def test_image_texts(spark):
    from trustlens.functions.features import parse_image_urls
    cases = {'"http://x/a,b.jpg"': ["http://x/a,b.jpg"], "('u1', 'u2')": ["u1", "u2"], "('u1',)": ["u1"],
             "'a,b'": ["a,b"], "(a, b)": ["(a", "b)"], "null": []}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r.v: r.o for r in df.select("v", parse_image_urls("v").alias("o")).collect()} == cases


def test_strict_fives_take_plain_numbers_only(spark):
    from trustlens.functions.features import detail_all_fives_strict
    df = spark.createDataFrame([(x,) for x in ("5,5", "5.0;5", "5d", "5f,5", "5e0", "x", None)], "v string")
    assert [r[0] for r in df.select(detail_all_fives_strict("v")).collect()] == [True, True, False, False, True, False, False]


def test_covariance(spark):
    import numpy as np

    from trustlens.operators.svm import covariance
    x = np.random.default_rng(3).normal(size=(40, 3))
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["covariance"] for r in covariance(df, ["a", "b", "c"]).collect()}
    want = np.cov(x.T)
    assert got == {(p, q): round(want[i][j], 6) for i, p in enumerate("abc") for j, q in enumerate("abc") if i <= j}


def test_scoring_writes_every_column_and_blanks_follow_preprocessing(spark, tmp_path):
    from trustlens.functions import lexicons as L
    from trustlens.operators import vectorize as V
    from trustlens.operators.bayes import fit_hybrid_nb
    from trustlens.operators.features import build_features
    cols = "review_id long, text string, stars string, reviewerNumberOfReviews string, isLocalGuide string, publishedAtDate string, reviewImageUrls string, reviewDetailedRating string, reviewContext string, label string"
    text = {1: "makanan enak sekali", 2: "tempat kotor sekali", 3: "http://x.co/a", 4: "123 456", 5: None, 6: "bagus enak ramah"}
    raw = spark.createDataFrame([(i, t, "x" if i == 3 else "5", "3", "True", "2024-01-02T03:04:05.000Z", None, "5,5", None,
                                  "FAKE" if i % 2 else "REAL") for i, t in text.items()], cols)
    train = V.with_tokens(build_features(raw)).withColumn("y", F.when(F.col("label") == "FAKE", 1).otherwise(-1))
    out = scoring.score_reviews_nb(raw, fit_hybrid_nb(train, list(L.NUMERIC_FEATURES)))
    path = str(tmp_path / "scored")
    out.write.parquet(path)
    back = {r["review_id"]: r for r in spark.read.parquet(path).collect()}
    assert set(back) == set(text) and back[3]["stars"] == "x"
    assert {i for i, r in back.items() if r["overridden"]} == {3, 4, 5}
    assert {back[i]["predicted_label"] for i in (3, 4, 5)} == {"FAKE"}
    assert all(back[i]["confidence"] == 1.0 for i in (3, 4, 5))


REVIEW = ("review_id long, text string, stars string, reviewerNumberOfReviews string, isLocalGuide string, "
          "publishedAtDate string, reviewImageUrls string, reviewDetailedRating string, reviewContext string, label string")


def reviews(spark, texts):
    return spark.createDataFrame([(i, t, "5", "3", "True", "2024-01-02T03:04:05.000Z", None, "5,5", None,
                                   "FAKE" if i % 2 else "REAL") for i, t in texts.items()], REVIEW)


def test_date_spellings(spark):
    from trustlens.sources.schema import coerce_timestamp
    cases = {"2023/01/05": "2023-01-05 00:00:00", "Jan 5 2023": "2023-01-05 00:00:00", "5 January 2023": "2023-01-05 00:00:00",
             "01/02/2023": "2023-01-02 00:00:00", "25/02/2023 7:08": "2023-02-25 07:08:00", "2024-02-30": None,
             "2024-01-02T03:04:05.000Z": "2024-01-02 03:04:05", "Mar 1, 2024 23:59:01": "2024-03-01 23:59:01",
             "garbage": None, "": None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r.v: r.t for r in df.select("v", coerce_timestamp("v").cast("string").alias("t")).collect()} == cases


def test_scorers_use_the_predictors_preprocessing(spark):
    from trustlens.operators.features import build_features
    raw = reviews(spark, {1: "enak bgd a1b"}).withColumnRenamed("text", "textTranslated")
    one = lambda d: d.first()["text_preprocessed"].split()
    assert one(scoring.scoring_features(raw)) == ["enak", "banget", "ab"]
    assert one(build_features(raw)) == ["enak", "bgd", "a", "b"]


def test_svm_and_forest_bundles(spark, tmp_path):
    from trustlens.operators import vectorize as V
    from trustlens.operators.features import build_features
    from trustlens.operators.forest import fit_forest
    from trustlens.operators.svm import fit_linear_svc, linear_model
    from trustlens.sources import io
    texts = {i: ("makanan enak ramah" if i % 2 else "tempat kotor mahal") for i in range(1, 13)} | {13: "123", 14: None}
    raw, cols = reviews(spark, texts), ["text_word_count", "text_char_count"]
    feats = V.with_tokens(build_features(raw)).withColumn("y", F.when(F.col("label") == "FAKE", 1).otherwise(-1))
    vocab, scaler = V.vocabulary(feats, 10), V.fit_scaler(feats, cols)
    x = V.assemble(V.tfidf_vector(V.scale(feats, scaler, cols, suffix="__s"), vocab), ["text_features"] + [f"{c}__s" for c in cols])
    metrics = spark.createDataFrame([(0.75,)], "accuracy double")
    svm, forest = linear_model(fit_linear_svc(x)), fit_forest(x, n_trees=5)
    io.save_linear_svm(svm, vocab, scaler, cols, str(tmp_path / "svm"), metrics)
    io.save_forest(forest, vocab, scaler, cols, str(tmp_path / "rf"), metrics)
    info = io.model_info({"vocab": vocab, "scaler": V.scaler_table(scaler, cols), "metrics": metrics}).first()
    assert info["accuracy"] == 0.75 and info["n_numeric_features"] == 2

    def rows(scored, name):
        scored.write.parquet(str(tmp_path / name))  # every column can be written
        return {r["review_id"]: r for r in spark.read.parquet(str(tmp_path / name)).collect()}

    m, v, s, c = io.load_linear_svm(spark, str(tmp_path / "svm"))
    old = rows(scoring.score_reviews_svm(raw, vocab, scaler, cols, svm), "a")
    assert rows(scoring.score_reviews_svm(raw, v, s, c, m), "b") == old and set(old) == set(texts)
    assert {i for i, r in old.items() if r["overridden"]} == {13, 14} and old[14]["decision_score"] == 1.0
    assert all(old[i]["predicted_label"] == old[i]["label"] for i in range(1, 13))
    m, v, s, c = io.load_forest(spark, str(tmp_path / "rf"))
    for policy in ("model", "fake"):
        old = rows(scoring.score_reviews_rf(raw, vocab, scaler, cols, forest, blank_policy=policy), "c" + policy)
        assert rows(scoring.score_reviews_rf(raw, v, s, c, m, blank_policy=policy), "d" + policy) == old
        assert old[1]["stars"] == "5" and set(old) == set(texts)
    assert all(old[i]["predicted_label"] == "FAKE" for i in (13, 14))


def test_overridden_rows(spark):
    df = spark.createDataFrame([(1, 0), (2, 1)], "review_id long, gibberish_override int")
    assert [r[0] for r in scoring.overridden_rows(df).collect()] == [2]
    df = spark.createDataFrame([(1, True), (2, False)], "review_id long, overridden boolean")
    assert [r[0] for r in scoring.overridden_rows(df).collect()] == [1]


def test_covariance_in_blocks(spark):
    import numpy as np
    from trustlens.operators.svm import covariance
    r = np.random.default_rng(4)
    x = r.normal(size=(500, 40)) @ r.normal(size=(40, 40)) + 1e6
    cols = [f"c.{i}" for i in range(40)]
    df = spark.createDataFrame(x.tolist(), cols).repartition(5)
    got = {(r["col_a"], r["col_b"]): r["covariance"] for r in covariance(df, cols).collect()}
    want = np.cov(x.T)
    assert len(got) == 40 * 41 // 2
    assert all(got[cols[i], cols[j]] == pytest.approx(want[i, j], abs=2e-6) for i in range(40) for j in range(i, 40))
    holes = spark.createDataFrame([(1.0, 2.0, None), (3.0, None, None), (5.0, 9.0, 1.0), (None, 4.0, None)], "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["covariance"] for r in covariance(holes, ["a", "b", "c"]).collect()}
    assert got == {("a", "a"): 4.0, ("a", "b"): 14.0, ("a", "c"): None, ("b", "b"): 13.0, ("b", "c"): None, ("c", "c"): None}
    assert covariance(holes.limit(0), ["a", "b"]).count() == 0
