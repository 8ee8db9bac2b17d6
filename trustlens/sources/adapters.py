"""The ``reviews_raw`` table derived from the driver's tables.

The reference reads a scraped review CSV that is not part of it. Tests and
registered queries therefore derive a review table from ``documents``,
``events`` and ``labels``: every document is one review, its event gives the
reviewer and time, and messy raw fields (bad numbers, odd booleans, five image
list syntaxes, unparseable dates) are produced by fixed rules on the id, so
every messy case appears at every scale.

Re-aimed from the survey's adapter: the review text is the **whole** document
text (the survey cut it to its first 3/20/40 words); nothing is truncated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: the adapter's raw-field variants ---------------------------
TEXT_SUFFIX = " http://x.co/a?b=1 @user1 #promo 123 wow!!"
IMAGE_VARIANTS = (None, "[]", '["u1","u2"]', "['u1', 'u2']", "u1;u2", "u1|nan",
                  "http://x.co/a.jpg", "u1, u2,")
DETAIL_VARIANTS = ("5,5,5", "5, 4, 5", "", None, "5.0 5.0")
CONTEXT_VARIANTS = (None, "", "Dine in")
LOCAL_GUIDE_VARIANTS = ("True", "false", "yes", None)
DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.000'Z'"
DETAIL_FAMILY = 3
IMAGE_FAMILY = 2


def _pick(key: Column, values) -> Column:
    expr = None
    for i, v in enumerate(values):
        val = F.lit(v).cast("string")
        expr = F.when(key == i, val) if expr is None else expr.when(key == i, val)
    return expr


# Tables whose rows carry long texts: per-row work on them is CPU-heavy.
TEXT_TABLES = ("documents", "pages", "conversations", "benchmark")


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy per-row work at least one partition per core.

    A scan is split by file and row group; a small file with one large row
    group of long texts is a single task. When the scan plans fewer partitions
    than the default parallelism, rows are spread round-robin. The check reads
    plan metadata only (no job); on large inputs the scan already has far more
    partitions than cores and nothing is shuffled.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        planned = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a Spark Connect session)
        return df
    return df.repartition(target) if planned < target else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw review fields as text, plus ``review_id`` and ``user_id``.

    documents LEFT JOIN events ON event_id = doc_id LEFT JOIN labels: the two joins
    share the key, so Spark shuffles each input once on the id.
    """
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = (d.join(e, d.doc_id == e.event_id, "left")
          .join(lab, "doc_id", "left"))
    i = F.col("doc_id")
    k = F.get_json_object("props", "$.k").try_cast("int")
    uid = F.col("user_id")
    ts = F.col("ts").cast("timestamp")
    shifted = F.timestamp_add("DAY", i, ts)
    raw = j.select(
        i.alias("review_id"),
        F.col("source").alias("title"),
        uid.alias("user_id"),
        F.when(i % 13 == 0, F.lit(None).cast("string"))
         .when(i % 11 == 0, F.lit(""))
         .when(i % 7 == 2, F.concat(F.col("text"), F.lit(TEXT_SUFFIX)))
         .otherwise(F.col("text")).alias("text"),
        F.when(i % 17 == 0, F.lit("x"))
         .when(k % 10 < 6, F.lit("5"))
         .otherwise((F.lit(1) + k % 4).cast("string")).alias("stars"),
        F.when(i % 9 == 0, F.lit("n/a"))
         .when(i % 4 == 0, F.lit("1"))
         .otherwise((uid % 40).cast("string")).alias("reviewerNumberOfReviews"),
        _pick(uid % 4, LOCAL_GUIDE_VARIANTS).alias("isLocalGuide"),
        F.when(i % 19 == 0, F.lit(None).cast("string"))
         .when(i % 23 == 0, F.lit("garbage"))
         .when(i % 6 == 0, F.date_format(shifted, DATE_FORMAT))
         .otherwise(F.date_format(ts, DATE_FORMAT)).alias("publishedAtDate"),
        _pick(i % 8, IMAGE_VARIANTS).alias("reviewImageUrls"),
        _pick(i % 5, DETAIL_VARIANTS).alias("reviewDetailedRating"),
        _pick(i % 3, CONTEXT_VARIANTS).alias("reviewContext"),
        F.when(F.col("quality") == 0, F.lit("FAKE"))
         .when(F.col("quality") == 1, F.lit("REAL")).alias("label"),
    )
    fam = {}
    for n in range(DETAIL_FAMILY):
        fam[f"reviewDetailedRating/{n}"] = F.try_element_at(
            F.split("reviewDetailedRating", ","), F.lit(n + 1))
    for n in range(IMAGE_FAMILY):
        fam[f"reviewImageUrls/{n}"] = F.try_element_at(
            F.split("reviewImageUrls", ","), F.lit(n + 1))
    return raw.withColumns(fam)


def reviews_scraped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table the way the labeller sees a scraped file: family columns
    only (``reviewDetailedRating/n``, ``reviewImageUrls/n``), the scraper's
    ``textTranslated`` name and a place photo column ``imageUrl``."""
    raw = reviews_raw(spark, sf_dir)
    return (raw.drop("reviewDetailedRating", "reviewImageUrls", "label")
               .withColumnRenamed("text", "textTranslated")
               .withColumn("imageUrl", F.concat(F.lit("http://x.co/p/"), F.col("title"))))
