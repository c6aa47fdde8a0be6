"""Newton steps against the condition of the optimum and a plain descent."""

import random

import numpy as np
import pytest

from sparkhunt.operators import classify, newton


def drawn(seed, n, width):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        v = [rng.gauss(0, 1) * 10**i + 5 for i in range(width - 1)] + [7.0]
        rows.append((v, int(v[0] - v[1] / 10 + rng.gauss(0, 1) > 4.5)))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, list(map(float, v)), y, "x") for i, (v, y) in enumerate(rows)], "id long, features array<double>, label int, x string")


def plain(rows):
    """Weights on scaled features by many small descents."""
    x = np.array([v for v, _ in rows])
    y = np.array([t for _, t in rows], float)
    spread = x.std(axis=0, ddof=1)
    z = np.column_stack([np.ones(len(x)), (x - x.mean(axis=0)) / np.where(spread > 1e-12, spread, 1)])
    ridge = np.array([0.0] + [1.0] * x.shape[1])
    w = np.zeros(z.shape[1])
    rate = 1 / (0.25 * np.linalg.eigvalsh(z.T @ z).max() + 1)
    for _ in range(20_000):
        w -= rate * (z.T @ (1 / (1 + np.exp(-z @ w)) - y) + ridge * w)
    return w, z @ w


def test_weights_equal_a_plain_descent(spark):
    rows = drawn(1, 300, 4)
    model = newton.fit(table(spark, rows).repartition(5), "features", "label")
    weights, margins = plain(rows)
    assert model.weights == pytest.approx(weights, abs=1e-6)
    assert model.margins(np.array([v for v, _ in rows])) == pytest.approx(margins, abs=1e-5)


def test_order_and_partitions_do_not_matter(spark):
    rows = drawn(2, 200, 6)
    mixed = list(rows)
    random.Random(3).shuffle(mixed)
    one = newton.fit(table(spark, rows).coalesce(1), "features", "label")
    other = newton.fit(table(spark, mixed).repartition(7), "features", "label")
    assert one.weights == pytest.approx(other.weights, abs=1e-9)


def test_separable_single_class_and_empty(spark):
    apart = [([float(i)], int(i > 20)) for i in range(40)]
    test = table(spark, apart)
    out = classify.classify_logistic(test, test.drop("label")).collect()
    assert [r.prediction for r in sorted(out, key=lambda r: r.id)] == [y for _, y in apart]
    assert "x" in out[0].asDict()
    for label in (0, 1):
        single = test.selectExpr("id", "features", f"{label} as label")
        assert {r.prediction for r in classify.classify_logistic(single, test).collect()} == {label}
    two = test.selectExpr("id", "array(features[0], 1D) as features", "label")
    assert {r.prediction for r in classify.classify_logistic(two.limit(0), two).collect()} == {0}
    nulls = test.unionByName(spark.createDataFrame([(99, None, 1, "x"), (98, [1.0], None, "x")], test.schema))
    assert newton.fit(nulls, "features", "label").weights == pytest.approx(newton.fit(test, "features", "label").weights, abs=1e-9)
