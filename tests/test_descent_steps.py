"""Descent steps without a pass over the rows."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from trustlens.operators import svm as S


@pytest.mark.parametrize("sparse", [False, True])
def test_descent_passes_over_the_rows_a_few_times_only(spark, monkeypatch, sparse):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(600, 6)), 2) * (rng.random((600, 6)) < (0.3 if sparse else 1))
    y = np.where(x[:, 0] + 0.5 * rng.normal(size=600) > 0.2, 1, -1)
    rows = [(int(c), Vectors.sparse(6, {int(i): float(r[i]) for i in np.flatnonzero(r)}) if sparse else Vectors.dense(r)) for c, r in zip(y, x, strict=True)]
    d = spark.createDataFrame(rows, ["y", "features"])
    train, val = spark.createDataFrame(d.head(480), d.schema), spark.createDataFrame(d.tail(120), d.schema)
    made = []
    steps = S._Steps.__init__
    monkeypatch.setattr(S._Steps, "__init__", lambda self, *a: (steps(self, *a), made.append(self))[0])
    m = S.fit_linear_svm(train, val, lr=0.02, max_iter=120)
    w, b, losses = np.zeros(6), 0.0, []
    for _ in range(120):
        margin = 1 - y[:480] * (x[:480] @ w + b)
        loss = np.mean(np.maximum(margin, 0)) + S.LAMBDA * w @ w
        pull = np.where(margin > 0, y[:480], 0.0)
        w, b = w - 0.02 * (2 * S.LAMBDA * w - pull @ x[:480] / 480), b + 0.02 * pull.mean()
        losses.append((loss, np.mean(np.maximum(0, 1 - y[480:] * (x[480:] @ w + b))) + S.LAMBDA * w @ w))
    assert np.allclose([h[1:] for h in m.history], losses, rtol=0, atol=1e-12)
    assert made[0].passes < 40
