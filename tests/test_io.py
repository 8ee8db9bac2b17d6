"""Scans and sinks: CSV reviews as text, model save / load round trip."""

import tempfile

import pytest


from trustlens.operators import bayes as B
from trustlens.operators import vectorize as V
from trustlens.sources import io as IO
from trustlens.sources import schema as S


def test_csv_reviews_stay_text_and_repair(spark):
    d = tempfile.mkdtemp(prefix="tl-csv-")
    with open(f"{d}/r.csv", "w", encoding="utf-8") as f:
        f.write('﻿ stars ,text,isLocalGuide\n5,"multi\nline, with comma",true\nx,ok,no\n')
    df = IO.read_reviews(spark, f"{d}/r.csv")
    df = S.normalize_headers(df)
    assert df.columns == ["stars", "text", "isLocalGuide"]
    rows = df.select(S.coerce_number("stars").alias("s"), "text").orderBy("s").collect()
    assert [r.s for r in rows] == [0, 5] and rows[1].text == "multi\nline, with comma"


def test_hybrid_nb_save_load_roundtrip(spark):
    rows = [(i, "enak mantap" if i % 2 else "buruk mahal kotor", 1 if i % 2 else -1, float(i % 5))
            for i in range(30)]
    df = V.with_tokens(spark.createDataFrame(rows, "review_id int, text_preprocessed string, y int, a double"))
    m = B.fit_hybrid_nb(df, ["a"])
    path = tempfile.mkdtemp(prefix="tl-model-")
    IO.save_hybrid_nb(m, path)
    m2 = IO.load_hybrid_nb(spark, path)
    a = {r.review_id: r.prob_fake for r in B.predict_hybrid_nb(m, df).collect()}
    b = {r.review_id: r.prob_fake for r in B.predict_hybrid_nb(m2, df).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)
    info = IO.model_info({"vocab": m2.vocab, "scaler": V.scaler_table(m2.scaler, m2.cols)}).first()
    assert info.vocab_size == 5 and info.n_numeric_features == 1


def test_summary_rows(spark):
    s = spark.createDataFrame([(10, 0.5)], "rows long, mean double")
    got = {r.metric: r.value for r in IO.summary_rows(s).collect()}
    assert got == {"rows": "10", "mean": "0.5"}
