"""Gradient descent in blocks, exact splits over ranges, forests grown together, cutoffs by counts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustlens.operators import forest as FR
from trustlens.operators import sampling as SM
from trustlens.operators import svm as S

SEED = 11


def plain_descent(X, y, Xv, yv, lr, lam, iters, tol=1e-6, patience=50):
    """The training loop on arrays: (weights, bias, losses)."""
    w, b, best, bad, losses = np.zeros(X.shape[1]), 0.0, (np.inf, None, None), 0, []
    for _ in range(iters):
        m = 1 - y * (X @ w + b)
        losses.append(np.mean(np.maximum(m, 0)) + lam * w @ w)
        pull = np.where(m > 0, y, 0.0)
        w, b = w - lr * (2 * lam * w - pull @ X / len(y)), b + lr * pull.mean()
        v = np.mean(np.maximum(0, 1 - yv * (Xv @ w + b))) + lam * w @ w
        best, bad = ((v, w, b), 0) if v + tol < best[0] else (best, bad + 1)
        if bad >= patience:
            return best[1], best[2], losses
    return w, b, losses


def vectors(spark, X, y, sparse):
    from pyspark.ml.linalg import Vectors
    rows = [(i, int(y[i]), Vectors.sparse(X.shape[1], [(j, float(v)) for j, v in enumerate(x) if v]) if sparse else Vectors.dense(x.tolist()))
            for i, x in enumerate(X)]
    return spark.createDataFrame(rows, ["review_id", "y", "features"])


@pytest.mark.parametrize("sparse,direct,block", [(False, 256, 4096), (True, 0, 7), (True, 256, 7)])
def test_descent_stops_where_plain_descent_does(spark, sparse, direct, block, monkeypatch):
    monkeypatch.setattr(S.row_blocks, "__defaults__", (*S.row_blocks.__defaults__[:-1], block))
    r = np.random.default_rng(SEED)
    X = r.normal(size=(160, 12)) * (r.random((160, 12)) < (0.15 if sparse else 1))
    X[3] = 0
    y = np.where(X[:, 0] - X[:, 1] + r.normal(size=160) > 0, 1.0, -1.0)
    d = vectors(spark, X, y, sparse).repartition(3)
    steps = 60 if direct == 0 else 400
    m = S.fit_linear_svm(d.where("review_id >= 40"), d.where("review_id < 40"), lr=0.3, max_iter=steps, patience=8, direct_blocks=direct)
    w, b, losses = plain_descent(X[40:], y[40:], X[:40], y[:40], 0.3, 0.01, steps, patience=8)
    assert len(m.history) == len(losses) and np.allclose([h[1] for h in m.history], losses)
    assert np.allclose(m.w, w) and m.b == pytest.approx(b)
    if direct:
        assert len(losses) < steps  # it did stop early
    got = {r.review_id: r.decision_score for r in S.score_svm(d, m).collect()}
    assert np.allclose([got[i] for i in range(160)], X @ w + b)


def brute_split(X, y, weight, features, min_leaf):
    def gini(p, q):
        return 1 - (p / (p + q)) ** 2 - (q / (p + q)) ** 2 if p + q else 0.0
    tp, tq = weight[y == 1].sum(), weight[y != 1].sum()
    best = None
    for f in features:
        v = np.unique(X[weight > 0, f])
        for a, c in zip(v, v[1:], strict=False):
            left = X[:, f] <= a
            lp, lq = weight[left & (y == 1)].sum(), weight[left & (y != 1)].sum()
            n, nl = tp + tq, lp + lq
            gain = gini(tp, tq) - nl / n * gini(lp, lq) - (n - nl) / n * gini(tp - lp, tq - lq)
            if gain > 1e-12 and min(nl, n - nl) >= min_leaf and (best is None or gain > best[0] + 1e-12):
                best = (gain, f, 0.5 * (a + c))
    return best


def brute_tree(X, y, weight, tree, seed, width, some, depth, next_node):
    """Nodes in the order in which the library numbers them: level by level."""
    out, level = {}, [(0, weight)]
    next_node[0] = 1
    for d in range(depth + 1):
        below = []
        for node, w in level:
            p, q = w[y == 1].sum(), w[y != 1].sum()
            features = sorted(random.Random(f"{seed}:{tree}:{node}").sample(range(width), some))
            best = brute_split(X, y, w, features, 2) if d < depth and p and q and p + q >= 2 else None
            if best is None:
                out[node] = (None, 1 if p > q else -1)
                continue
            left = X[:, best[1]] <= best[2]
            out[node] = (best[1], best[2], next_node[0], next_node[0] + 1)
            below += [(next_node[0], np.where(left, w, 0)), (next_node[0] + 1, np.where(left, 0, w))]
            next_node[0] += 2
        level = below
    return out


def walk(tree, x):
    node = tree[0]
    while node[0] is not None:
        node = tree[node[2] if x[node[0]] <= node[1] else node[3]]
    return node[1]


def test_forest_grown_together_is_the_forest_grown_alone(spark):
    r = np.random.default_rng(SEED)
    X = np.round(r.normal(size=(90, 6)), 1)
    y = np.where(X[:, 0] - X[:, 3] + r.normal(size=90) > 0, 1, -1)
    df = spark.createDataFrame([(i, int(y[i]), X[i].tolist()) for i in range(90)], "review_id int, y int, feature_values array<double>")
    bags = SM.bootstrap_weights(df, 5).persist()
    weight = np.zeros((5, 90), int)
    for b in bags.collect():
        weight[b.tree, b.review_id] = b.weight
    nodes, oob = FR.fit_bagged_forest(df, bags, 5, max_depth=4, max_features="sqrt", seed=3)
    trees = [brute_tree(X, y, weight[t], t, 3, 6, 2, 4, [0]) for t in range(5)]
    got = {(n.tree, n.node_id): (None, n.prediction) if n.feature_id is None else (n.feature_id, pytest.approx(n.threshold), n.left, n.right)
           for n in nodes.collect()}
    assert got == {(t, k): v for t, own in enumerate(trees) for k, v in own.items()}
    hits = []
    for i in range(90):
        votes = [walk(trees[t], X[i]) for t in range(5) if not weight[t, i]]
        if votes:
            hits.append((1 if 2 * votes.count(1) > len(votes) else -1) == y[i])
    assert oob.first()[0] == pytest.approx(np.mean(hits))
    voted = {v.review_id: (v.tree_predictions, v.voted) for v in FR.predict_forest(df, nodes).collect()}
    for i in range(90):
        every = [walk(t, X[i]) for t in trees]
        assert voted[i] == (every, 1 if every.count(1) > 2 else -1)
    shares = {s.feature_id: s.importance for s in FR.split_importances(nodes).collect()}
    per = [[sum(n[0] == f for n in t.values()) for f in range(6)] for t in trees]
    want = sum(np.array(p) / max(1, sum(p)) for p in per) / 5
    assert shares == pytest.approx({f: w for f, w in enumerate(want / want.sum()) if w})


def test_split_of_one_feature_over_many_ranges(spark):
    """All rows in one node and one feature: the ranges' borders cut the group."""
    n = 3000
    df = spark.range(n).select(F.lit(0).alias("node"), F.lit(0).alias("feature"), (F.col("id") * 0.5).alias("value"),
                               F.when((F.col("id") < 1234) | (F.col("id") % 97 == 0), 1).otherwise(-1).alias("y"))
    r = FR.best_split(df.repartition(6)).first()
    y = np.array([1 if i < 1234 or i % 97 == 0 else -1 for i in range(n)])
    want = brute_split((np.arange(n) * 0.5)[:, None], y, np.ones(n, int), [0], 2)
    assert (r.threshold, r.n_left, r.n_right) == (want[2], 1234, n - 1234) and r.gain == pytest.approx(want[0])
    assert FR.best_split(df.where("false")).count() == 0


def test_trees_of_no_and_pure_rows(spark):
    schema = "review_id int, y int, feature_values array<double>"
    assert FR.fit_cart(spark.createDataFrame([], schema)).count() == 1  # one leaf
    one = FR.fit_cart(spark.createDataFrame([(1, 1, [1.0]), (2, 1, [None])], schema))
    assert [(n.node_id, n.prediction) for n in one.collect()] == [(0, 1)]
    same = spark.createDataFrame([(1, 1, [1.0]), (2, -1, [1.0]), (3, 1, [1.0])], schema)
    assert [n.prediction for n in FR.predict_cart(same, FR.fit_cart(same)).select(F.col("tree_prediction").alias("prediction")).collect()] == [1, 1, 1]


@pytest.mark.parametrize("few", [10_000, 1])
def test_cutoffs_are_the_sorted_ones(spark, few):
    data = [(i, random.Random(i).choice(["a", "b", "c", None]), "long text " * 5) for i in range(400)]
    df = spark.createDataFrame(data, "review_id int, label string, text string").repartition(5)
    key = SM.hash_key(1, "test", "review_id")
    counts = SM.class_counts(df, "label")
    ranks = {"a": 17, "b": counts["b"] + 3, "c": 0, None: counts[None] - 1}
    got = SM.first_of_class(df, "label", key, ["review_id"], ranks, counts, "inside", few)
    order = [(r.label, r.review_id) for r in df.withColumn("h", key).orderBy("h").collect()]
    want = {i for c, k in ranks.items() for i in [x for own, x in order if own == c][:k]}
    assert {r.review_id for r in got.where("inside").collect()} == want and got.count() == 400
    assert got.columns == ["review_id", "label", "text", "inside"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan  # the rows stay where they are


def test_cutoff_among_rows_that_share_an_id(spark):
    df = spark.createDataFrame([(7, "a", str(i)) for i in range(50)] + [(8, "a", "x"), (9, "b", "y")], "review_id int, label string, text string")
    counts = SM.class_counts(df, "label")
    for few in (10_000, 1):
        for k in (1, 20, 50):
            got = SM.first_of_class(df, "label", SM.hash_key(1, "t", "review_id"), ["review_id"], {"a": k, "b": 0}, counts, "inside", few)
            assert got.where("inside").count() == k and got.count() == 52
    assert SM.oversample(df).groupBy("label").count().where("count = 51").count() == 2
