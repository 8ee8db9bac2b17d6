"""Text normalisation, image lists and rating parsers."""

from pyspark.sql import functions as F

from trustlens.functions import features as FE
from trustlens.functions import text as T
from trustlens.operators.cleaning import preprocess_column


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("o")).first().o


def test_cleanse_unicode_and_digits(spark):
    assert one(spark, lambda c: T.cleanse(T.case_fold(c)), "Café a1b 😀 @joe #tag http://x.y ok") == "café ab ok"
    assert one(spark, lambda c: T.cleanse(T.case_fold(c), " "), "a1b") == "a b"
    assert one(spark, lambda c: T.cleanse(T.case_fold(c)), "١٢٣abc") == "abc"


def test_slang_applied_once(spark):
    # iya -> ya stays although ya -> '' ; multi-word values are re-tokenised
    out = one(spark, lambda c: preprocess_column(c, stopwords=(), stems={}), "iya gpp ya bgt")
    assert out == "ya tidak apa apa banget"


def test_null_text_preprocess(spark):
    assert one(spark, lambda c: preprocess_column(c), None) == ""


def test_image_variants(spark):
    cases = {
        None: [], "[]": [], '["u1","u2"]': ["u1", "u2"], "['u1', 'u2']": ["u1", "u2"],
        "u1;u2": ["u1", "u2"], "u1|nan": ["u1"], "http://x.co/a.jpg": ["http://x.co/a.jpg"],
        "u1, u2,": ["u1", "u2"], "['a', None]": ["a"], "nan": [], "": [],
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.o for r in df.select("v", FE.parse_image_urls("v").alias("o")).collect()}
    for k, v in cases.items():
        assert got[k] == v, k


def test_detail_all_fives_variants(spark):
    trainer = {"5,5,5": 1, "5, 4, 5": 0, "": 0, None: 0, "5.0 5.0": 1, "1.2.3 5": 0}
    strict = {"5,5,5": True, "5, 4, 5": False, "": False, None: False, "5.9": True,
              "5.0 5.0": False, "5;5": True, "x,5": False}
    df = spark.createDataFrame([(k,) for k in trainer], "v string")
    got = {r.v: r.o for r in df.select("v", FE.detail_all_fives("v").alias("o")).collect()}
    assert got == trainer
    df = spark.createDataFrame([(k,) for k in strict], "v string")
    got = {r.v: r.o for r in df.select("v", FE.detail_all_fives_strict("v").alias("o")).collect()}
    assert got == strict


def test_word_and_uppercase_counts(spark):
    assert one(spark, T.word_count, "  a  b\tc\n") == 3
    assert one(spark, T.uppercase_word_count, "ABC Def GHI 123 X1") == 3
