"""Scans and sinks (A1-A5): review files, result tables, summaries, models.

CSV review files are read with every column as text (the schema repair in
``schema.py`` types them), multi-line quoted cells allowed. Model tables are
Parquet folders under one model directory, so a fitted model moves between
jobs without pickling and loads lazily.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_reviews(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A1: a review file or folder; CSV cells stay text."""
    if fmt == "csv":
        return (spark.read.option("header", True).option("multiLine", True)
                .option("escape", '"').option("inferSchema", False).csv(path))
    return spark.read.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """A2: labelled / preprocessed / balanced / scored tables."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def summary_rows(summary: DataFrame) -> DataFrame:
    """A3: a one-row summary as (metric, value) rows (values as text)."""
    cols = summary.columns
    stack = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    return summary.selectExpr(f"stack({len(cols)}, {stack}) AS (metric, value)")


def write_summary(summary: DataFrame, path: str) -> None:
    """A3: write a prediction summary as a small (metric, value) table."""
    write_table(summary_rows(summary).coalesce(1), path, "csv")


def save_model(tables: dict[str, DataFrame], path: str, params: dict | None = None) -> None:
    """A4: every model table as Parquet under ``path/<name>``, plus a params table."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    if params:
        spark = next(iter(tables.values())).sparkSession
        rows = [(k, str(v)) for k, v in params.items()]
        spark.createDataFrame(rows, "key string, value string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/params")


def load_model(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    """A5: the saved tables, read lazily."""
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}


def model_info(tables: dict[str, DataFrame]) -> DataFrame:
    """A5 info row: vocabulary size, numeric feature count and, where the tables have a
    one-row ``metrics``, its columns."""
    vocab = tables["vocab"].agg(F.count(F.lit(1)).alias("vocab_size"))
    feats = tables["scaler"].agg(F.count(F.lit(1)).alias("n_numeric_features"))
    info = vocab.crossJoin(feats)
    return info.crossJoin(F.broadcast(tables["metrics"])) if "metrics" in tables else info


def save_hybrid_nb(model, path: str, metrics: DataFrame | None = None) -> None:
    """A4 for the hybrid NB model (vocabulary, scaler, both NB parts, test metrics if given)."""
    save_model({"vocab": model.vocab, "scaler_wide": model.scaler, "nb_text": model.log_prob,
                "nb_prior": model.priors, "nb_numeric": model.gauss,
                **({"metrics": metrics} if metrics is not None else {})},
               path, {"cols": ",".join(model.cols), "text_weight": model.text_w,
                      "numeric_weight": model.num_w})


def load_hybrid_nb(spark: SparkSession, path: str):
    """A5 for the hybrid NB model."""
    from trustlens.operators.bayes import HybridNBModel
    t = load_model(spark, path, ["vocab", "scaler_wide", "nb_text", "nb_prior", "nb_numeric",
                                 "params"])
    params = {r["key"]: r["value"] for r in t["params"].collect()}   # a handful of rows
    return HybridNBModel(t["vocab"], t["scaler_wide"], t["nb_text"], t["nb_prior"],
                         t["nb_numeric"], params["cols"].split(","),
                         float(params["text_weight"]), float(params["numeric_weight"]))


def save_linear_svm(model, vocab: DataFrame, scaler: DataFrame, cols: list[str], path: str,
                    metrics: DataFrame | None = None) -> None:
    """A4 for the linear SVM: weights, vocabulary, scaler and (if given) test metrics."""
    tables = {"weights": model.weights_table(vocab.sparkSession), "vocab": vocab, "scaler_wide": scaler}
    save_model(tables | ({"metrics": metrics} if metrics is not None else {}), path, {"cols": ",".join(cols)})


def load_linear_svm(spark: SparkSession, path: str):
    """A5: (model, vocabulary, scaler, columns)."""
    from trustlens.operators.svm import LinearSVMModel
    t = load_model(spark, path, ["weights", "vocab", "scaler_wide", "params"])
    w = {r["feature_id"]: r["weight"] for r in t["weights"].collect()}   # one row per feature
    params = {r["key"]: r["value"] for r in t["params"].collect()}
    model = LinearSVMModel([w[i] for i in range(len(w) - 1)], w[-1], [])
    return model, t["vocab"], t["scaler_wide"], params["cols"].split(",")


def save_forest(model, vocab: DataFrame, scaler: DataFrame, cols: list[str], path: str,
                metrics: DataFrame | None = None) -> None:
    """A4 for the random forest: MLlib trees, vocabulary, scaler and (if given) test metrics."""
    model.write().overwrite().save(f"{path}/forest")
    tables = {"vocab": vocab, "scaler_wide": scaler}
    save_model(tables | ({"metrics": metrics} if metrics is not None else {}), path, {"cols": ",".join(cols)})


def load_forest(spark: SparkSession, path: str):
    """A5: (model, vocabulary, scaler, columns)."""
    from pyspark.ml.classification import RandomForestClassificationModel
    t = load_model(spark, path, ["vocab", "scaler_wide", "params"])
    params = {r["key"]: r["value"] for r in t["params"].collect()}
    return (RandomForestClassificationModel.load(f"{path}/forest"), t["vocab"], t["scaler_wide"],
            params["cols"].split(","))
