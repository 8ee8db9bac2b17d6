"""Heuristic labelling rules (FIXTURES.md 3.3) and the same-day count."""

from pyspark.sql import functions as F

from trustlens.operators import labeling as LB

ROWS = [
    # stars, words, photo, detail, reviews, local, context, same_day -> score, label
    (5, 0, False, "5,5,5", 1, False, None, 6, 11, "FAKE"),
    (5, 4, True, "5,4,5", 10, True, "Dine in", 1, 2, "REAL"),
    (5, 5, False, None, 3, False, "", 1, 3, "REAL"),
    (4, 0, False, None, 2, False, "Dine in", 5, 4, "FAKE"),
    (3, 20, True, "5.9", 50, True, "Dine in", 6, 3, "REAL"),
]


def test_golden_rules(spark):
    df = spark.createDataFrame(
        [(i, r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7]) for i, r in enumerate(ROWS)],
        "id int, stars int, text_len_words int, has_image boolean, reviewDetailRating string, "
        "reviewernumberofreview int, islocalguid boolean, reviewContext string, same_day_count int")
    out = LB.reason_text(LB.label_by_threshold(LB.apply_burst_rule(LB.fake_score(df))))
    got = {r.id: (r.fake_score, r.label, r.reason) for r in out.collect()}
    for i, r in enumerate(ROWS):
        assert got[i][0] == r[8] and got[i][1] == r[9]
    assert got[1][2] == "Terlihat asli"
    assert got[0][2].startswith("Bintang 5 tanpa teks; Tidak ada foto reviewer")
    assert got[0][2].endswith("Banyak review di hari yg sama (>5)")


def test_same_day_nulls(spark):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-01 11:00:00"), (3, None)],
                               "id int, ts string").withColumn("ts", F.to_timestamp("ts"))
    lab = {r.id: r.same_day_count for r in LB.same_day_count(df, "ts", 0).collect()}
    feat = {r.id: r.same_day_count for r in LB.same_day_count(df, "ts", 1).collect()}
    assert lab == {1: 2, 2: 2, 3: 0} and feat == {1: 2, 2: 2, 3: 1}


def test_photo_source_fallback(spark):
    df = spark.createDataFrame([(1, False, "p.jpg"), (2, False, None)],
                               "id int, has_review_image boolean, imageUrl string")
    got = {r.id: r.has_image for r in LB.resolve_has_image(df).collect()}
    assert got == {1: True, 2: False}
    df2 = spark.createDataFrame([(1, True, None), (2, False, "p.jpg")],
                                "id int, has_review_image boolean, imageUrl string")
    got = {r.id: r.has_image for r in LB.resolve_has_image(df2).collect()}
    assert got == {1: True, 2: False}


def test_flagship_entry(spark):
    import __spark_entry__ as E
    rows = E.entry(spark).collect()
    assert {r.label for r in rows} <= {"FAKE", "REAL"}
    assert abs(sum(r.pct for r in rows) - 100.0) < 1e-6
