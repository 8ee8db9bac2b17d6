"""Balancing and splits: exact sizes, disjointness, determinism."""

from pyspark.sql import functions as F

from trustlens.operators import sampling as SM


def table(spark, n_real=4524, n_fake=2497, parts=8):
    return spark.range(n_real + n_fake, numPartitions=parts).select(
        F.col("id").alias("review_id"),
        F.when(F.col("id") < n_real, F.lit("REAL")).otherwise(F.lit("FAKE")).alias("label"))


def counts(df):
    return {r.label: r["count"] for r in df.groupBy("label").count().collect()}


def test_balancing_golden_sizes(spark):
    df = table(spark)
    assert counts(SM.undersample(df)) == {"REAL": 2497, "FAKE": 2497}
    assert counts(SM.oversample(df)) == {"REAL": 4524, "FAKE": 4524}
    assert counts(SM.hybrid_balance(df)) == {"REAL": 3510, "FAKE": 3510}
    comp = {r.dataset: r.total for r in SM.balance_comparison(df).collect()}
    assert comp == {"Original": 7021, "Undersampling": 4994, "Oversampling": 9048, "Kombinasi": 7020}


def test_undersample_without_replacement(spark):
    u = SM.undersample(table(spark))
    assert u.select("review_id").distinct().count() == u.count()


def test_oversample_keys_unique(spark):
    o = SM.oversample(table(spark))
    assert o.select("review_id", "copy_no").distinct().count() == o.count()


def test_split_exact_and_disjoint(spark):
    s = SM.split_exact(table(spark))
    c = {r.set: r["count"] for r in s.groupBy("set").count().collect()}
    assert c == {"train": int(7021 * 0.8), "test": 7021 - int(7021 * 0.8)}


def test_stratified_sizes(spark):
    s = SM.split_stratified(table(spark))
    c = {(r.label, r.set): r["count"] for r in s.groupBy("label", "set").count().collect()}
    assert c[("REAL", "test")] == round(4524 * 0.2) and c[("FAKE", "test")] == round(2497 * 0.2)


def test_partition_independence(spark):
    a = {r.review_id for r in SM.undersample(table(spark, parts=1)).collect()}
    b = {r.review_id for r in SM.undersample(table(spark, parts=16)).collect()}
    assert a == b


def test_balance_status_thresholds(spark):
    for real, fake, status in ((50, 50, "BALANCED"), (52, 48, "BALANCED"), (55, 45, "FAIR"),
                               (60, 40, "NOT BALANCED")):
        r = SM.balance_status(table(spark, real, fake)).first()
        assert r.status == status


def test_bootstrap_weights_sum(spark):
    b = SM.bootstrap_weights(table(spark, 300, 200), 4)
    sums = {r.tree: r.s for r in b.groupBy("tree").agg(F.sum("weight").alias("s")).collect()}
    assert sums == {0: 500, 1: 500, 2: 500, 3: 500}
