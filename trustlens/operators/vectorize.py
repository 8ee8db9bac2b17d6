"""TF-IDF in long form, the standard scaler, vector assembly.

Plan shape at scale
-------------------
Tokens are exploded once (``review_id``, ``term``). Term statistics are a
two-level aggregation: (review, term) counts, then per term ``sum`` and
``count`` -- hot terms collapse in the map-side partial aggregate. The
vocabulary is a global top-k (``TakeOrderedAndProject``: k rows per task, one
merge), so it is bounded by ``max_features``; only that table is broadcast.
TF-IDF keeps in-vocabulary tokens only (broadcast hash join on the k-row
vocabulary) before grouping, so the shuffle carries at most one row per
(review, vocabulary term). If the input is hash-partitioned on ``review_id``
the (review, term) grouping needs no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustlens.functions.text import tokenize

MAX_FEATURES = 1000


def with_tokens(df: DataFrame, text_col: str = "text_preprocessed", out: str = "tokens"
                ) -> DataFrame:
    """Whitespace tokens of the preprocessed text (Python ``str.split()``)."""
    return df.withColumn(out, tokenize(F.coalesce(F.col(text_col), F.lit(""))))


def exploded(df: DataFrame, *cols, tokens_col: str = "tokens") -> DataFrame:
    """The columns and one row per token (``term``).

    A plain ``explode`` lets the optimiser add a filter on the array's size and push it
    below the projection that makes the tokens, which then runs once for the filter and
    again for the rows; the outer one, with the places tested, is left as it is.
    """
    return (df.select(*cols, F.posexplode_outer(tokens_col).alias("_pos", "term"))
              .where(F.col("_pos").isNotNull()).drop("_pos"))


def term_counts(df: DataFrame, id_col: str = "review_id", tokens_col: str = "tokens"
                ) -> DataFrame:
    """(review, term, count) from a tokens column. Whole token lists are dealt by the
    review, which is fewer and shorter records than dealing their (review, term) rows."""
    return (exploded(df.select(id_col, tokens_col).repartition(id_col), id_col, tokens_col=tokens_col)
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf_count")))


def term_stats(df: DataFrame, id_col: str = "review_id", tokens_col: str = "tokens"
               ) -> DataFrame:
    """Per term, total occurrences and document frequency."""
    return term_counts(df, id_col, tokens_col).groupBy("term").agg(
        F.sum("tf_count").alias("total"), F.count(F.lit(1)).alias("df"))


def vocabulary(df: DataFrame, k: int = MAX_FEATURES, id_col: str = "review_id",
               tokens_col: str = "tokens") -> DataFrame:
    """I2 + I3: top-k terms by (count desc, term asc) with dense ids 0..k-1 and
    ``idf = ln(N / (df + 1))`` where N counts all rows, empty ones too."""
    stats = term_stats(df, id_col, tokens_col)
    top = stats.orderBy(F.desc("total"), F.asc("term")).limit(k)
    n_docs = df.agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(F.desc("total"), F.asc("term"))
    return (top.crossJoin(F.broadcast(n_docs))
               .withColumn("term_id", (F.row_number().over(w) - 1).cast("int"))
               .withColumn("idf", F.log(F.col("_n") / (F.col("df") + 1)))
               .select("term", "term_id", "total", "df", "idf"))


def term_frequency(df: DataFrame, id_col: str = "review_id", tokens_col: str = "tokens"
                   ) -> DataFrame:
    """I4: count / all words of the review (out-of-vocabulary words included). ``df`` is
    read twice; the counts stay where their review was dealt, and the reviews' sizes (a
    number each) are hashed beside them, so the counts are neither dealt again nor sorted."""
    n = df.select(id_col, F.size(tokens_col).alias("n_words"))
    return (term_counts(df, id_col, tokens_col).join(n.hint("shuffle_hash"), id_col, "inner")
            .withColumn("tf", F.col("tf_count") / F.col("n_words")))


def tfidf(df: DataFrame, vocab: DataFrame, id_col: str = "review_id",
          tokens_col: str = "tokens") -> DataFrame:
    """Long-form TF-IDF ``(review_id, term_id, tfidf)`` for vocabulary terms.

    The vocabulary has at most ``max_features`` rows (a proven bound), so it is
    broadcast; tokens outside it are dropped before the shuffle.
    """
    v = F.broadcast(vocab.select("term", "term_id", "idf"))
    toks = exploded(df, id_col, F.size(tokens_col).alias("n_words"), tokens_col=tokens_col)
    return (toks.join(v, "term", "inner")
                .groupBy(id_col, "term_id")
                .agg(F.count(F.lit(1)).alias("tf_count"), F.first("n_words").alias("n_words"),
                     F.first("idf").alias("idf"))
                .select(id_col, "term_id",
                        (F.col("tf_count") / F.col("n_words") * F.col("idf")).alias("tfidf")))


def tfidf_vector(df: DataFrame, vocab: DataFrame, tokens_col: str = "tokens",
                 out: str = "text_features") -> DataFrame:
    """TF-IDF as an MLlib vector (term counts by ``CountVectorizerModel``
    with the fixed vocabulary, times idf, divided by the word count).

    Only the vocabulary (bounded by ``max_features``) comes to the driver.
    """
    from pyspark.ml.feature import CountVectorizerModel
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = vocab.select("term", "term_id", "idf").orderBy("term_id").collect()
    terms = [r["term"] for r in rows]
    idf = [float(r["idf"]) for r in rows]
    if not terms:
        return df.withColumn(out, array_to_vector(F.array().cast("array<double>")))
    cv = CountVectorizerModel.from_vocabulary(terms, inputCol=tokens_col, outputCol="_tf")
    idf_arr = F.array(*[F.lit(x) for x in idf])
    n = F.greatest(F.size(tokens_col), F.lit(1)).cast("double")
    arr = F.zip_with(vector_to_array("_tf"), idf_arr, lambda c, w: c * w / n)
    return cv.transform(df).withColumn(out, array_to_vector(arr)).drop("_tf")


def fit_scaler(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with ``mean__<c>`` and ``scale__<c>`` (population std, 0 -> 1)."""
    aggs = []
    for c in cols:
        aggs.append(F.avg(F.col(c).cast("double")).alias(f"mean__{c}"))
        sd = F.stddev_pop(F.col(c).cast("double"))
        aggs.append(F.when((sd == 0) | sd.isNull(), F.lit(1.0)).otherwise(sd).alias(f"scale__{c}"))
    return df.agg(*aggs)


def scaler_table(scaler: DataFrame, cols: list[str]) -> DataFrame:
    """The scaler as a long model table (feature, mean, scale)."""
    stack = ", ".join(f"'{c}', `mean__{c}`, `scale__{c}`" for c in cols)
    return scaler.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, mean, scale)")


def scale(df: DataFrame, scaler: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """I8: ``(x - mean) / scale`` with the one-row scaler broadcast."""
    out = df.crossJoin(F.broadcast(scaler))
    out = out.withColumns({
        f"{c}{suffix}": (F.col(c).cast("double") - F.col(f"mean__{c}")) / F.col(f"scale__{c}")
        for c in cols})
    return out.drop(*[x for c in cols for x in (f"mean__{c}", f"scale__{c}")])


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Concatenate vector / numeric columns into one MLlib vector."""
    from pyspark.ml.feature import VectorAssembler
    # inputs are null-filled (B8); "error" also needs no vector-size metadata
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)


def baseline_text_stages(text_col: str = "text", vocab_size: int = 10000):
    """1-2-gram TF-IDF with L2 normalisation, as an MLlib ``Pipeline``.

    Unigrams and bigrams share one vocabulary (sklearn's ``ngram_range=(1, 2)``).
    Spark's IDF is ``ln((N+1)/(df+1))``; sklearn adds 1 to it, which is a
    different weighting: rows are checked on invariants, not values.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, NGram, Normalizer, RegexTokenizer, SQLTransformer
    from pyspark.ml.feature import CountVectorizer

    tok = RegexTokenizer(inputCol=text_col, outputCol="_uni", pattern=r"(?U)\b\w\w+\b",
                         gaps=False, toLowercase=True)
    bi = NGram(n=2, inputCol="_uni", outputCol="_bi")
    both = SQLTransformer(statement="SELECT *, concat(_uni, _bi) AS _grams FROM __THIS__")
    cv = CountVectorizer(inputCol="_grams", outputCol="_tf", vocabSize=vocab_size)
    idf = IDF(inputCol="_tf", outputCol="_tfidf")
    norm = Normalizer(inputCol="_tfidf", outputCol="text_features", p=2.0)
    return Pipeline(stages=[tok, bi, both, cv, idf, norm])
