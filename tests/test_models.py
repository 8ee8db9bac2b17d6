"""NB, split search and SVM steps against NumPy brute force of the definitions."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustlens.operators import bayes as B
from trustlens.operators import forest as FR
from trustlens.operators import svm as S
from trustlens.operators import vectorize as V

RNG = np.random.RandomState(7)
WORDS = ["enak", "mantap", "buruk", "mahal", "murah", "bersih", "kotor", "ramah", "lambat", "oke"]


def synth_rows(n=60):
    rows = []
    for i in range(n):
        y = 1 if i % 3 == 0 else -1
        k = RNG.randint(0, 8)
        toks = [WORDS[RNG.randint(0, 5) if y == 1 else RNG.randint(4, 10)] for _ in range(k)]
        rows.append((i, " ".join(toks), y, float(RNG.normal(y, 1.0)), float(RNG.normal(0, 2.0))))
    return rows


def numpy_nb(rows, k=1000, alpha=1.0):
    docs = [r[1].split() for r in rows]
    y = np.array([r[2] for r in rows])
    X = np.array([[r[3], r[4]] for r in rows])
    allw, dfc = Counter(), Counter()
    for d in docs:
        allw.update(d)
        dfc.update(set(d))
    vocab = sorted(allw, key=lambda w: (-allw[w], w))[:k]
    idx = {w: i for i, w in enumerate(vocab)}
    idf = np.array([math.log(len(docs) / (dfc[w] + 1)) for w in vocab])
    T = np.zeros((len(docs), len(vocab)))
    for i, d in enumerate(docs):
        for w, c in Counter(d).items():
            T[i, idx[w]] = c / len(d) * idf[idx[w]]
    mu, sd = X.mean(0), X.std(0)
    sd[sd == 0] = 1
    Z = (X - mu) / sd
    out = {}
    scores = np.zeros((len(docs), 2))
    for j, c in enumerate((-1, 1)):
        m = y == c
        wc = T[m].sum(0)
        lp = np.log((wc + alpha) / (wc.sum() + alpha * len(vocab) + 1e-12))
        text = np.log(m.mean()) + T @ lp
        mean, var = Z[m].mean(0), Z[m].var(0) + 1e-9
        num = np.log(m.mean() + 1e-12) + (-0.5 * np.log(2 * np.pi * var) - 0.5 * (Z - mean) ** 2 / var).sum(1)
        scores[:, j] = 0.6 * text + 0.4 * num
    p = np.exp(scores - scores.max(1, keepdims=True))
    p = p / p.sum(1, keepdims=True)
    for i, r in enumerate(rows):
        out[r[0]] = (p[i, 1], 1 if scores[i, 1] > scores[i, 0] else -1)
    return out


def test_hybrid_nb_matches_numpy(spark):
    rows = synth_rows()
    df = spark.createDataFrame(rows, "review_id int, text_preprocessed string, y int, a double, b double")
    df = V.with_tokens(df)
    model = B.fit_hybrid_nb(df, ["a", "b"])
    got = {r.review_id: (r.prob_fake, r.y_pred) for r in B.predict_hybrid_nb(model, df).collect()}
    want = numpy_nb(rows)
    for k, (pf, yp) in want.items():
        assert got[k][0] == pytest.approx(pf, abs=1e-9)
        assert got[k][1] == yp


def brute_best_split(X, y, min_leaf=2):
    n, m = X.shape

    def g(lbls):
        if len(lbls) == 0:
            return 0.0
        _, c = np.unique(lbls, return_counts=True)
        p = c / c.sum()
        return 1 - np.sum(p * p)

    parent = g(y)
    best = (0.0, None, None)
    for f in range(m):
        order = np.argsort(X[:, f], kind="stable")
        v, ys = X[order, f], y[order]
        for i in range(n - 1):
            if v[i] == v[i + 1]:
                continue
            t = 0.5 * (v[i] + v[i + 1])
            left, right = ys[: i + 1], ys[i + 1:]
            gain = parent - (len(left) / n) * g(left) - (len(right) / n) * g(right)
            if gain > best[0] + 1e-12 and len(left) >= min_leaf and len(right) >= min_leaf:
                best = (gain, f, t)
    return best


def test_best_split_matches_brute_force(spark):
    X = RNG.randint(0, 12, size=(80, 4)).astype(float)
    y = np.where(X[:, 2] + RNG.normal(0, 2, 80) > 6, 1, -1)
    rows = [(i, int(y[i]), *map(float, X[i])) for i in range(80)]
    df = spark.createDataFrame(rows, "review_id int, y int, f0 double, f1 double, f2 double, f3 double")
    long = FR.to_long(df, "review_id", ["f0", "f1", "f2", "f3"]).withColumn("node", F.lit(0))
    r = FR.best_split(long, "node", 2).first()
    gain, f, t = brute_best_split(X, y)
    assert (r.feature, r.threshold) == (f, t) and r.gain == pytest.approx(gain)


def test_split_gain_example(spark):
    rows = [(i, 1, 0.0) for i in range(50)] + [(50 + i, -1, 0.0) for i in range(20)] + \
           [(70 + i, 1, 1.0) for i in range(10)] + [(80 + i, -1, 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "review_id int, y int, f0 double")
    long = FR.to_long(df, "review_id", ["f0"]).withColumn("node", F.lit(0))
    r = FR.best_split(long, "node", 2).first()
    assert r.threshold == 0.5 and r.gain == pytest.approx(0.061, abs=5e-4)


def test_vote_tie_goes_to_smaller_label(spark):
    df = spark.createDataFrame([(1, 0, 1), (1, 1, -1), (2, 0, 1), (2, 1, 1), (2, 2, -1)],
                               "review_id int, tree int, prediction int")
    v = {r.review_id: r.voted for r in FR.vote(df).collect()}
    p = {r.review_id: (r.share_fake, r.share_real) for r in FR.vote_proba(df).collect()}
    assert v == {1: -1, 2: 1} and p[2] == pytest.approx((2 / 3, 1 / 3))


def numpy_svm(X, y, Xv, yv, lr, lam, iters, tol=1e-6, patience=50):
    w, b = np.zeros(X.shape[1]), 0.0
    best, bad, bw, bb = np.inf, 0, w.copy(), b
    for _ in range(iters):
        m = 1 - y * (X @ w + b)
        mask = (m > 0).astype(float)
        gw = 2 * lam * w - (mask * y) @ X / len(y)
        gb = -np.sum(mask * y) / len(y)
        w, b = w - lr * gw, b - lr * gb
        vl = np.mean(np.maximum(0, 1 - yv * (Xv @ w + b))) + lam * w @ w
        if vl + tol < best:
            best, bad, bw, bb = vl, 0, w.copy(), b
        else:
            bad += 1
        if bad >= patience:
            return bw, bb
    return w, b


def test_svm_steps_match_numpy(spark):
    X = RNG.normal(size=(120, 5))
    y = np.where(X[:, 0] - X[:, 1] > 0, 1.0, -1.0)
    rows = [(i, int(y[i]), *map(float, X[i])) for i in range(120)]
    df = spark.createDataFrame(rows, "review_id int, y int, a double, b double, c double, d double, e double")
    df = V.assemble(df, ["a", "b", "c", "d", "e"])
    tr, va = df.where("review_id >= 12"), df.where("review_id < 12")
    m = S.fit_linear_svm(tr, va, lr=0.5, lam=0.01, max_iter=5)
    w, b = numpy_svm(X[12:], y[12:], X[:12], y[:12], 0.5, 0.01, 5)
    assert np.allclose(m.w, w) and m.b == pytest.approx(b)
    loss, gw, gb = S.hinge_loss_grad(df, np.ones(5) * 0.1, 0.2, 0.01)
    mm = 1 - y * (X @ (np.ones(5) * 0.1) + 0.2)
    assert loss == pytest.approx(np.mean(np.maximum(0, mm)) + 0.01 * 0.05)


def py_cart(X, y, depth=0, max_depth=3, min_split=2, min_leaf=2):
    if depth >= max_depth or len(y) < min_split or len(np.unique(y)) == 1:
        return ("leaf", 1 if (y == 1).sum() > (y != 1).sum() else -1)
    gain, f, t = brute_best_split(X, y, min_leaf)
    if f is None:
        return ("leaf", 1 if (y == 1).sum() > (y != 1).sum() else -1)
    m = X[:, f] <= t
    return ("split", f, t, py_cart(X[m], y[m], depth + 1, max_depth, min_split, min_leaf),
            py_cart(X[~m], y[~m], depth + 1, max_depth, min_split, min_leaf))


def py_predict(tree, x):
    while tree[0] == "split":
        tree = tree[3] if x[tree[1]] <= tree[2] else tree[4]
    return tree[1]


def test_cart_and_predict_match_recursive(spark):
    X = RNG.randint(0, 10, size=(120, 3)).astype(float)
    y = np.where(X[:, 0] * 2 - X[:, 1] + RNG.normal(0, 3, 120) > 5, 1, -1)
    rows = [(i, int(y[i]), *map(float, X[i])) for i in range(120)]
    df = spark.createDataFrame(rows, "review_id int, y int, f0 double, f1 double, f2 double")
    feats = df.select("review_id", "y", F.array("f0", "f1", "f2").alias("feature_values"))
    nodes = FR.fit_cart(feats, max_depth=3)
    got = {r.review_id: r.tree_prediction for r in FR.predict_cart(feats, nodes, max_depth=3).collect()}
    tree = py_cart(X, y, max_depth=3)
    want = {i: py_predict(tree, X[i]) for i in range(120)}
    assert got == want


def test_vote_columns_match_long_votes(spark):
    X = RNG.normal(size=(80, 3))
    y = np.where(X[:, 0] > 0, 1, -1)
    rows = [(i, int(y[i]), *map(float, X[i])) for i in range(80)]
    df = V.assemble(spark.createDataFrame(rows, "review_id int, y int, a double, b double, c double"),
                    ["a", "b", "c"])
    m = FR.fit_forest(df, n_trees=5, max_depth=3)
    tp = FR.tree_predictions(df, m)
    long = {r.review_id: (r.voted, r.votes) for r in FR.vote(tp).collect()}
    wide = {r.review_id: (r.voted, r.votes) for r in FR.tree_vote_columns(df, m).collect()}
    assert long == wide


def test_baselines_fit_their_text_stages_once(spark):
    from trustlens.operators.forest import train_baselines
    rows = [(i, "good place to eat" if i % 2 else "bad food and noise", 1 if i % 2 else -1, float(i % 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "review_id int, text string, y int, stars double")
    models = train_baselines(df, "text", ["stars"])
    assert list(models) == ["LinearSVC", "RandomForest", "MultinomialNB"]
    for name, m in models.items():
        assert m.stages[3] is models["LinearSVC"].stages[3], name
        out = m.transform(df).select("y", "prediction").collect()
        assert all((r.prediction == 1.0) == (r.y == 1) for r in out), name


def test_svm_scoring_builds_the_feature_table_once(spark, monkeypatch):
    from trustlens import session
    from trustlens.plans.queries import QUERIES
    names, real = [], session.materialize
    monkeypatch.setattr(session, "materialize", lambda df, name: names.append(name) or real(df, name))
    QUERIES["svm_scoring"](spark, "/root/testdata/sf0.001")
    assert names.count("score_features") == 1
