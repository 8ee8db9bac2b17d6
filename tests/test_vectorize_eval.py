"""Worked examples: TF, IDF, scaler, metrics (FIXTURES.md 3.2)."""

import math

import pytest
from pyspark.sql import functions as F

from trustlens.operators import evaluation as EV
from trustlens.operators import vectorize as V
from trustlens.operators.forest import gini


def test_tf_example(spark):
    df = V.with_tokens(spark.createDataFrame([(1, "makanan enak sekali makanan")],
                                             "review_id int, text_preprocessed string"))
    tf = {r.term: r.tf for r in V.term_frequency(df).collect()}
    assert tf["makanan"] == 0.5 and tf["enak"] == 0.25


def test_idf_and_negative_idf(spark):
    rows = [(i, "common rare" if i < 100 else "common") for i in range(1000)]
    df = V.with_tokens(spark.createDataFrame(rows, "review_id int, text_preprocessed string"))
    v = {r.term: r for r in V.vocabulary(df, 10).collect()}
    assert v["rare"].idf == pytest.approx(math.log(1000 / 101))
    assert v["common"].idf < 0          # term in every document
    assert v["common"].term_id == 0


def test_scaler_population_std(spark):
    df = spark.createDataFrame([(float(x), 7.0) for x in (1, 5, 10, 100, 500)], "a double, c double")
    r = V.fit_scaler(df, ["a", "c"]).first()
    assert r["mean__a"] == pytest.approx(123.2)
    assert r["scale__a"] == pytest.approx(191.9556, abs=1e-4)
    assert r["scale__c"] == 1.0         # constant feature


def test_metrics_worked_example(spark):
    counts = spark.createDataFrame([(85, 10, 90, 15)], "tp long, fp long, tn long, fn long")
    r = EV.metrics_from_counts(counts).first()
    assert r.accuracy == pytest.approx(0.875) and r.precision == pytest.approx(0.894737, abs=1e-6)
    assert r.recall == pytest.approx(0.85) and r.f1 == pytest.approx(0.871795, abs=1e-6)


BASELINE = [  # tp, fp, tn, fn, accuracy, precision, recall, f1
    (381, 69, 417, 118, 0.810152, 0.846667, 0.763527, 0.802950),
    (378, 62, 424, 121, 0.814213, 0.859091, 0.757515, 0.805112),
    (369, 57, 429, 130, 0.810152, 0.866197, 0.739479, 0.797838),
    (1518, 239, 1737, 445, 0.826352, 0.863973, 0.773306, 0.816129),
    (1576, 176, 1800, 387, 0.857070, 0.899543, 0.802853, 0.848452),
    (1494, 217, 1759, 469, 0.825844, 0.873174, 0.761080, 0.813283),
]


def test_baseline_metric_rows(spark):
    df = spark.createDataFrame([b[:4] for b in BASELINE], "tp long, fp long, tn long, fn long")
    got = EV.metrics_from_counts(df).collect()
    for r, b in zip(sorted(got, key=lambda r: (r.tp, r.fp)), sorted(BASELINE)):
        assert (r.accuracy, r.precision, r.recall, r.f1) == pytest.approx(b[4:], abs=1e-6)


def test_confusion_from_rows(spark):
    rows = [(1, 1)] * 3 + [(1, -1)] * 2 + [(-1, 1)] + [(-1, -1)] * 4
    df = spark.createDataFrame(rows, "y int, y_pred int")
    r = EV.confusion(df).first()
    assert (r.tp, r.fn, r.fp, r.tn) == (3, 2, 1, 4)


def test_gini_example(spark):
    df = spark.createDataFrame([(0, 1)] * 60 + [(0, -1)] * 40, "k int, y int")
    assert gini(df, ["k"]).first().gini == pytest.approx(0.48)


def test_tokens_are_made_once_for_counting(spark):
    df = spark.range(4).select(F.col("id").alias("review_id"), F.concat(F.lit("a b "), F.col("id")).alias("text_preprocessed"))
    plan = V.term_counts(V.with_tokens(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_term_frequency_of_repeated_null_and_empty_reviews(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", None]), (1, ["a"]), (None, ["a"]), (2, []), (3, None)], "review_id int, tokens array<string>")
    got = {(r.review_id, r.term, r.tf_count, r.tf) for r in V.term_frequency(df).collect()}
    assert got == {(1, "a", 3, 0.75), (1, "a", 3, 3.0), (1, "b", 1, 0.25), (1, "b", 1, 1.0), (1, None, 1, 0.25), (1, None, 1, 1.0)}
    stats = {r.term: (r.total, r.df) for r in V.term_stats(df).collect()}
    assert stats == {"a": (4, 2), "b": (1, 1), None: (1, 1)}
