"""Linear SVM by batch gradient descent, MLlib LinearSVC, PCA, covariance.

Gradient descent reads its rows from blocks written once to the shared folder: each
block holds up to ``BLOCK_ROWS`` rows of one set (train or validation) as a matrix, in
compressed sparse rows where most entries are zero. A step is one pass over the blocks:
a block product gives the margins, another one ``sum(mask * y * x)``, and a task returns
one row a set. Nothing is densified, no row is handled on its own, and a lost executor
reads its blocks again. Most steps need no pass: a row's side of its margin cannot change
before the weights have moved by its distance from it, so the sums of all rows beyond a
radius are fixed until then, and the few rows within it come to the driver, which takes
steps on both until it leaves the radius. The weights (one double per feature, bounded by the vocabulary
size + 32) stay on the driver; every step plans from the same written table, so lineage
does not grow with the number of steps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNING_RATE = 0.01
LAMBDA = 0.01
MAX_ITER = 2000
TOL = 1e-6
PATIENCE = 50
BLOCK_ROWS = 4096
BLOCK_ENTRIES = 1 << 22   # stored numbers of a block (32 MB)
DIRECT_BLOCKS = 256       # blocks whose partial sums the driver adds up itself
NEAR_NUMBERS, NEAR_SHARE = 1 << 21, 8  # most numbers (rows * features; 16 MB) near their margin at the driver, and the part of all rows
NEAR_STEPS = 3            # steps of the last size that a radius must allow
RADII = 2.0 ** (np.arange(-80, 41) / 4)


def row_blocks(df: DataFrame, features: str = "features", y: str = "y", part: str | None = None,
               rows: int = BLOCK_ROWS) -> DataFrame:
    """(part, n, width, y, starts, places, numbers) of blocks of rows: the rows' labels, and
    their entries in compressed sparse rows; without ``starts`` the block is dense."""
    src = df.select((F.col(part).cast("string") if part else F.lit("")).alias("part"), F.col(y).cast("double").alias("y"),
                    F.unwrap_udt(features).alias("x"))

    def pack(of, y, size, places, counts, numbers):
        n, nnz = len(y), len(numbers)
        starts = np.concatenate([[0], np.cumsum(counts)]).astype("<i8")
        if 2 * nnz >= n * size:  # most entries are there
            full = np.zeros((n, size))
            full[np.repeat(np.arange(n), counts), places] = numbers
            cells = (None, None, full.tobytes())
        else:
            cells = (starts.tobytes(), places.astype("<i4").tobytes(), numbers.tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array([of]), pa.array([n], pa.int64()), pa.array([size], pa.int32()), pa.array([y.astype("<f8").tobytes()], pa.binary()),
             *[pa.array([c], pa.binary()) for c in cells]], names=["part", "n", "width", "y", "starts", "places", "numbers"])

    def run(batches):
        waiting: dict[str, list] = {}
        for batch in batches:
            for of, label, x in zip(batch["part"].to_pylist(), batch["y"].to_pylist(), batch["x"].to_pylist(), strict=True):
                numbers = np.array(x["values"], float)
                if x["type"]:
                    size, places = len(numbers), np.flatnonzero(numbers)
                    numbers = numbers[places]
                else:
                    size, places = x["size"], np.array(x["indices"], np.int64)
                own = waiting.setdefault(of, [0, []])
                own[0] += len(numbers)
                own[1].append((label, size, places, numbers))
                if len(own[1]) >= rows or own[0] >= BLOCK_ENTRIES:
                    yield block(of, own[1])
                    del waiting[of]
        for of, own in waiting.items():
            yield block(of, own[1])

    def block(of, own):
        y, size, places, numbers = zip(*own, strict=True)
        return pack(of, np.array(y), size[0], np.concatenate(places), [len(p) for p in places], np.concatenate(numbers))

    return src.mapInArrow(run, "part string, n long, width int, y binary, starts binary, places binary, numbers binary")


def _margins(r: dict, w: np.ndarray, b: float) -> tuple:
    """(y, margins, x or None, starts, places, numbers) of a block."""
    y, numbers = np.frombuffer(r["y"], "<f8"), np.frombuffer(r["numbers"], "<f8")
    if r["starts"] is None:
        x = numbers.reshape(r["n"], r["width"])
        return y, 1 - y * (x @ w + b), x, None, None, numbers
    starts, places = np.frombuffer(r["starts"], "<i8"), np.frombuffer(r["places"], "<i4")
    row = np.repeat(np.arange(r["n"]), np.diff(starts))
    return y, 1 - y * (np.bincount(row, numbers * w[places], r["n"]) + b), None, starts, places, numbers


def _pull(r: dict, pull: np.ndarray, x, starts, places, numbers) -> np.ndarray:
    """The block's rows, each times its ``pull``, added up."""
    if x is not None:
        return pull @ x
    return np.bincount(places, numbers * np.repeat(pull, np.diff(starts)), r["width"])


def _block_sums(r: dict, w: np.ndarray, b: float) -> tuple:
    y, margin, *cells = _margins(r, w, b)
    pull = np.where(margin > 0, y, 0.0)
    return r["n"], np.maximum(margin, 0).sum(), pull.sum(), _pull(r, pull, *cells)


def _distances(r: dict, margin: np.ndarray, x, starts, numbers) -> np.ndarray:
    """How far weights and bias must move before each row can reach its margin."""
    squares = (x * x).sum(axis=1) if x is not None else np.bincount(np.repeat(np.arange(r["n"]), np.diff(starts)), numbers * numbers, r["n"])
    return np.abs(margin) / np.sqrt(squares + 1)


def distance_counts(blocks: DataFrame, w: np.ndarray, b: float) -> DataFrame:
    """A row a task: the number of rows nearer to their margin than each of ``RADII``."""
    w = np.asarray(w, float)

    def run(batches):
        counts = np.zeros(len(RADII), np.int64)
        for batch in batches:
            for r in batch.to_pylist():
                _, margin, x, starts, _, numbers = _margins(r, w, b)
                far = np.sort(_distances(r, margin, x, starts, numbers))  # NaN last
                counts += r["n"] - (np.sum(~np.isnan(far)) - np.searchsorted(far[~np.isnan(far)], RADII))
        yield pa.RecordBatch.from_arrays([pa.array([counts.tolist()], pa.list_(pa.int64()))], names=["counts"])

    return blocks.mapInArrow(run, "counts array<long>")


def near_rows(blocks: DataFrame, w: np.ndarray, b: float, radius: float) -> DataFrame:
    """Of each block the rows nearer to their margin than ``radius``, as a block, and of
    the others their number (``others``), how many lie inside the margin (``inside``) and
    these rows' sum(y) and sum(y*x)."""
    w = np.asarray(w, float)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                y, margin, x, starts, places, numbers = _margins(r, w, b)
                near = ~(_distances(r, margin, x, starts, numbers) >= radius)
                pull = np.where((margin > 0) & ~near, y, 0.0)
                if x is not None:
                    cells = (None, None, x[near].tobytes())
                else:
                    size = np.diff(starts)
                    kept = np.repeat(near, size)
                    cells = (np.concatenate([[0], np.cumsum(size[near])]).astype("<i8").tobytes(), places[kept].tobytes(), numbers[kept].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["part"]]), pa.array([int(near.sum())], pa.int64()), pa.array([r["width"]], pa.int32()), pa.array([y[near].tobytes()], pa.binary()),
                     *[pa.array([c], pa.binary()) for c in cells], pa.array([int((~near).sum())], pa.int64()), pa.array([int(((margin > 0) & ~near).sum())], pa.int64()),
                     pa.array([float(pull.sum())]), pa.array([_pull(r, pull, x, starts, places, numbers).tolist()], pa.list_(pa.float64()))],
                    names=["part", "n", "width", "y", "starts", "places", "numbers", "others", "inside", "sum_my", "sum_myx"])

    return blocks.mapInArrow(run, "part string, n long, width int, y binary, starts binary, places binary, numbers binary, "
                                  "others long, inside long, sum_my double, sum_myx array<double>")


class _Steps:
    """Sums at given weights: from what is fixed within a radius and the rows near their
    margin, or by a pass over the blocks, which then looks for a radius."""

    def __init__(self, blocks: DataFrame, width: int, rows: int, direct: bool):
        self.blocks, self.direct = blocks, direct
        self.most = min(NEAR_NUMBERS // max(1, width), rows // NEAR_SHARE)
        self.at, self.radius, self.fixed, self.near = None, 0.0, {}, []
        self.passes = 0

    def sums(self, w: np.ndarray, b: float, step: float) -> dict:
        """``step``: how far the weights moved last."""
        point = np.append(w, b)
        if not self.radius or not np.linalg.norm(point - self.at) < 0.999 * self.radius:
            self.radius = 0.0
            if self.direct:
                self._look(w, b, step)
            if not self.radius:
                self.passes += 1
                return _step_sums(self.blocks, w, b, self.direct)
        out = {part: [n, inside - float(np.dot(w, myx)) - b * my, my, myx] for part, (n, inside, my, myx) in self.fixed.items()}
        for r in self.near:
            own = out[r["part"]]
            for i, v in enumerate(_block_sums(r, w, b)):
                own[i] = own[i] + v
        return out

    def _look(self, w: np.ndarray, b: float, step: float) -> None:
        self.passes += 1
        counts = np.sum([r["counts"] for r in distance_counts(self.blocks, w, b).collect()], axis=0)
        few = np.flatnonzero(counts <= self.most)
        if not len(few) or RADII[few[-1]] < NEAR_STEPS * step:
            return
        self.at, self.radius, self.fixed, self.near = np.append(w, b), float(RADII[few[-1]]), {}, []
        self.passes += 1
        for r in near_rows(self.blocks, w, b, self.radius).collect():
            own = self.fixed.setdefault(r["part"], [0, 0, 0.0, 0.0])
            for i, v in enumerate((r["others"], r["inside"], r["sum_my"], np.array(r["sum_myx"]))):
                own[i] = own[i] + v
            if r["n"]:
                self.near.append(r.asDict())


def block_sums(blocks: DataFrame, w: np.ndarray, b: float) -> DataFrame:
    """Per task and part: n, sum of hinge losses, sum(mask*y), sum(mask*y*x)."""
    w = np.asarray(w, float)

    def run(batches):
        sums: dict[str, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                own = sums.setdefault(r["part"], [0, 0.0, 0.0, 0.0])
                for i, v in enumerate(_block_sums(r, w, b)):
                    own[i] = own[i] + v
        for of, (n, hinge, my, myx) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([of]), pa.array([n], pa.int64()), pa.array([float(hinge)]), pa.array([float(my)]), pa.array([myx.tolist()], pa.list_(pa.float64()))],
                names=["part", "n", "hinge", "sum_my", "sum_myx"])

    return blocks.mapInArrow(run, "part string, n long, hinge double, sum_my double, sum_myx array<double>")


def total_sums(partial: DataFrame) -> DataFrame:
    """The tasks' sums added up, one row a part; the components meet by their number."""
    whole = partial.groupBy("part").agg(F.sum("n").alias("n"), F.sum("hinge").alias("hinge"), F.sum("sum_my").alias("sum_my"))
    parts = (partial.select("part", F.posexplode("sum_myx").alias("i", "v")).groupBy("part", "i").agg(F.sum("v").alias("v"))
             .groupBy("part").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("sum_myx")))
    return whole.join(parts, "part")


def hinge_sums(df: DataFrame, w: np.ndarray, b: float, features: str = "features",
               y: str = "y", group: str | None = None) -> DataFrame:
    """Per group (as ``part``): n, sum of hinge losses, sum(mask*y), sum(mask*y*x) as an array."""
    return total_sums(block_sums(row_blocks(df, features, y, group), w, b))


def hinge_loss_grad(df: DataFrame, w: np.ndarray, b: float, lam: float = LAMBDA,
                    features: str = "features", y: str = "y"):
    """(loss, grad_w, grad_b) for given weights over the whole table."""
    row = hinge_sums(df, w, b, features, y).first()
    n, w = row["n"], np.asarray(w, float)
    return (row["hinge"] / n + lam * float(np.dot(w, w)), 2 * lam * w - np.array(row["sum_myx"]) / n, -row["sum_my"] / n)


class LinearSVMModel:
    def __init__(self, w, b, history):
        self.w, self.b, self.history = np.asarray(w), float(b), history

    def loss_history(self, spark) -> DataFrame:
        """(iter, train_loss, val_loss)."""
        return spark.createDataFrame(self.history, "iter int, train_loss double, val_loss double")

    def weights_table(self, spark) -> DataFrame:
        rows = [(i, float(v)) for i, v in enumerate(self.w)] + [(-1, self.b)]
        return spark.createDataFrame(rows, "feature_id int, weight double")


def _step_sums(blocks: DataFrame, w: np.ndarray, b: float, direct: bool) -> dict:
    partial = block_sums(blocks, w, b)
    out: dict[str, list] = {}
    for r in (partial if direct else total_sums(partial)).collect():
        own = out.setdefault(r["part"], [0, 0.0, 0.0, 0.0])
        for i, v in enumerate((r["n"], r["hinge"], r["sum_my"], np.array(r["sum_myx"]))):
            own[i] = own[i] + v
    return out


def fit_linear_svm(train: DataFrame, val: DataFrame | None = None, lr: float = LEARNING_RATE,
                   lam: float = LAMBDA, max_iter: int = MAX_ITER, tol: float = TOL,
                   patience: int = PATIENCE, features: str = "features", y: str = "y",
                   direct_blocks: int = DIRECT_BLOCKS) -> LinearSVMModel:
    """Batch gradient descent with early stopping on the validation loss.

    A step takes its sums over train and validation together from ``_Steps``: without a
    pass while no row can have changed sides unseen. Up to ``direct_blocks`` blocks
    the tasks' sums (a row a task and set) come to the driver as they are; beyond, Spark
    adds them up first, in one pass a step.
    """
    from trustlens.session import materialize
    parts = train.select(features, y).withColumn("_set", F.lit("train"))
    if val is not None:
        parts = parts.unionByName(val.select(features, y).withColumn("_set", F.lit("val")))
    blocks = materialize(row_blocks(parts, features, y, "_set"), "svm-blocks")
    size = blocks.agg(F.count(F.lit(1)).alias("blocks"), F.max("width").alias("width"), F.count_if(F.col("part") == "train").alias("train"), F.sum("n").alias("rows")).first()
    if not size["train"]:
        raise ValueError("no training rows")
    direct = size["blocks"] <= direct_blocks
    if direct:  # a handful of tasks a step, however many files were written
        blocks = blocks.coalesce(max(1, train.sparkSession.sparkContext.defaultParallelism))
    steps, step = _Steps(blocks, size["width"], size["rows"], direct), 0.0
    w, b = np.zeros(size["width"]), 0.0
    best = (np.inf, w.copy(), b)
    bad, history, pending = 0, [], None
    # One set of sums per step: the train gradient at w and the validation loss at w, which is
    # the check of the previous step's update (measured right after each update).
    for it in range(1, max_iter + 2):
        sums = steps.sums(w, b, step)
        reg = lam * float(np.dot(w, w))
        if pending is not None:
            prev_it, prev_loss = pending
            val_loss = float(sums["val"][1] / sums["val"][0] + reg) if "val" in sums else None
            history.append((prev_it, prev_loss, val_loss))
            if val_loss is not None:
                if val_loss + tol < best[0]:
                    best, bad = (val_loss, w.copy(), b), 0
                else:
                    bad += 1
                if bad >= patience:
                    w, b = best[1], best[2]
                    break
        if it > max_iter:
            break
        n, hinge, my, myx = sums["train"]
        last = np.append(w, b)
        w = w - lr * (2 * lam * w - myx / n)
        b = b - lr * (-my / n)
        step = float(np.linalg.norm(np.append(w, b) - last))
        pending = (it, float(hinge / n + reg))
    return LinearSVMModel(w, b, history)


def dot(features: str, weights: Column) -> Column:
    """Product of a vector column with an array of weights, over its stored entries."""
    x = F.unwrap_udt(features)
    sparse = F.zip_with(x["indices"], x["values"], lambda i, v: v * F.get(weights, i))
    full = F.zip_with(x["values"], weights, lambda v, c: v * c)
    return F.aggregate(F.when(x["type"] == 0, sparse).otherwise(full), F.lit(0.0), lambda acc, v: acc + v)


def score_svm(df: DataFrame, model: LinearSVMModel, features: str = "features") -> DataFrame:
    """Decision value and label (score >= 0 is FAKE)."""
    spark = df.sparkSession
    wdf = spark.createDataFrame([([float(x) for x in model.w], float(model.b))], "_w array<double>, _b double")
    d = df.crossJoin(F.broadcast(wdf))  # one row
    d = d.withColumn("decision_score", dot(features, F.col("_w")) + F.col("_b")).drop("_w", "_b")
    return d.withColumn("y_pred", F.when(F.col("decision_score") >= 0, F.lit(1)).otherwise(F.lit(-1)))


def fit_linear_svc(df: DataFrame, lam: float = LAMBDA, max_iter: int = 100,
                   features: str = "features", y: str = "y"):
    """MLlib LinearSVC with the same objective (Spark penalises reg/2 |w|^2)."""
    from pyspark.ml.classification import LinearSVC
    d = df.withColumn("_label", (F.col(y) == 1).cast("double"))
    return LinearSVC(featuresCol=features, labelCol="_label", regParam=2 * lam,
                     standardization=False, maxIter=max_iter).fit(d)


def linear_model(svc) -> LinearSVMModel:
    """The weights of a fitted MLlib LinearSVC as this module's model."""
    return LinearSVMModel(svc.coefficients.toArray(), svc.intercept, [])


def fit_pca(df: DataFrame, k: int = 2, features: str = "features"):
    """Centre (no scaling) then PCA; returns (scaler_model, pca_model)."""
    from pyspark.ml.feature import PCA, StandardScaler
    sc = StandardScaler(inputCol=features, outputCol="_centred", withMean=True, withStd=False).fit(df)
    pca = PCA(k=k, inputCol="_centred", outputCol="pca").fit(sc.transform(df))
    return sc, pca


def project_pca(df: DataFrame, models) -> DataFrame:
    sc, pca = models
    return pca.transform(sc.transform(df)).drop("_centred")


def covariance(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Sample covariance for every ordered pair i <= j, long form.

    A null leaves its row out of the pairs of its column only; a pair with fewer than two
    rows is null, an empty table gives no rows. Columns are shifted by their means (one
    row at the driver), then each batch of rows adds one matrix product; a task returns a
    row a column, and these add up by column.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    n = len(cols)
    x = [F.col(f"`{c}`").cast("double") for c in cols]
    shift = np.array([m or 0.0 for m in df.agg(*[F.avg(c) for c in x]).first()])

    def run(batches):
        counts, sums, products = np.zeros((n, n)), np.zeros((n, n)), np.zeros((n, n))
        rows = 0
        for batch in batches:
            cells = batch["v"].flatten()
            there = cells.is_valid().to_numpy(zero_copy_only=False).reshape(-1, n)
            m = np.where(there, cells.to_numpy(zero_copy_only=False).reshape(-1, n) - shift, 0.0)
            there = there.astype(float)
            counts += there.T @ there
            sums += m.T @ there
            products += m.T @ m
            rows += len(m)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(n), pa.int32()), pa.array([np.concatenate([
                    counts[i, i:], sums[i, i:], sums[i:, i], products[i, i:]]) for i in range(n)], pa.list_(pa.float64()))],
                names=["i", "part"])

    parts = df.select(F.array(*x).alias("v")).mapInArrow(run, "i int, part array<double>")
    row = parts.groupBy("i").agg(vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("s"))
    cell = (row.select("i", "s", F.explode(F.sequence(F.lit(0), F.lit(n - 1) - F.col("i"))).alias("at"))
            .withColumn("size", F.lit(n) - F.col("i")))
    of = [F.get("s", F.col("at") + k * F.col("size")) for k in range(4)]
    cov = F.when(of[0] > 1, (of[3] - of[1] * of[2] / of[0]) / (of[0] - 1))
    names = F.array(*[F.lit(c) for c in cols])
    return cell.select(names[F.col("i")].alias("col_a"), names[F.col("i") + F.col("at")].alias("col_b"),
                       F.round(cov, digits).alias("covariance"))
