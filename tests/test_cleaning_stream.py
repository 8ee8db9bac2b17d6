"""Join-based stemming for large tables, and the streaming daily counts."""

import os
import tempfile

from pyspark.sql import functions as F

from trustlens.operators.cleaning import preprocess, stem_tokens
from trustlens.streaming.scoring_stream import daily_counts


def test_stem_table_join_matches_literal_map(spark):
    df = spark.createDataFrame([(1, "makanannya enak sekali"), (2, "pelayanan pelayanan ramah"),
                                (3, None)], "review_id int, text string")
    table = {"makanannya": "makan", "pelayanan": "layan", "sekali": "kali"}
    stems_df = spark.createDataFrame(list(table.items()), "word string, stem string")
    a = {r.review_id: r.text_preprocessed for r in
         preprocess(df, stopwords=(), stems=table).collect()}
    b = {r.review_id: r.text_preprocessed for r in
         preprocess(df, stopwords=(), stems=stems_df).collect()}
    assert a == b == {1: "makan enak kali", 2: "layan layan ramah", 3: ""}


def test_stem_tokens_keeps_order(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b", "c"])], "review_id int, toks array<string>")
    t = spark.createDataFrame([("b", "B")], "word string, stem string")
    assert stem_tokens(df, "toks", t).first().toks == ["B", "a", "B", "c"]


def test_streaming_daily_counts(spark):
    src = tempfile.mkdtemp(prefix="tl-stream-src-")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("ts").cast("timestamp").alias("published_ts"))
    ev.write.mode("overwrite").parquet(os.path.join(src, "part"))
    stream = spark.readStream.schema(ev.schema).parquet(os.path.join(src, "part"))
    q = (daily_counts(stream).writeStream.outputMode("complete").format("memory")
         .queryName("tl_daily").option("checkpointLocation", tempfile.mkdtemp(prefix="tl-ck-"))
         .start())
    q.processAllAvailable()
    q.stop()
    got = {r.day.start.date(): r.same_day_count for r in spark.sql("SELECT * FROM tl_daily").collect()}
    want = {r.d: r.n for r in ev.groupBy(F.to_date("published_ts").alias("d"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want
