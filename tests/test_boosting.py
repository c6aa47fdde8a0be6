"""Boosted trees against a plain fit that looks at every split of every node."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkhunt.operators import boosting


def plain_edges(column, bins):
    ordered = sorted(column)
    out, seen = [], set()
    for x in sorted(set(ordered)):
        share = sum(v < x for v in ordered) * bins // len(ordered)
        if share and share not in seen:
            out.append(x)
        seen.add(share)
    return out


def plain_fit(rows, rounds, depth, bins, rate=0.3, penalty=1.0):
    """Log odds of every row; splits by value, sums by math.fsum."""
    width = len(rows[0][0])
    edges = [plain_edges([v[f] for v, _ in rows], bins) for f in range(width)]
    margin = [0.0] * len(rows)
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g = [round((a - y) * 2**30) for a, (_, y) in zip(p, rows)]
        h = [round(max(a * (1 - a), 1e-16) * 2**30) for a in p]

        def score(some):
            return (sum(g[i] for i in some) / 2**30) ** 2 / (sum(h[i] for i in some) / 2**30 + penalty)

        def grow(some, level):
            best = (1e-6, None)
            for f in range(width) if level < depth else ():
                for cut in edges[f]:
                    left = [i for i in some if rows[i][0][f] < cut]
                    right = [i for i in some if not rows[i][0][f] < cut]
                    if min(sum(h[i] for i in left), sum(h[i] for i in right)) >= 2**30:
                        gain = 0.5 * (score(left) + score(right) - score(some))
                        if gain > best[0] + 1e-12:
                            best = gain, (left, right)
            if best[1]:
                for part in best[1]:
                    grow(part, level + 1)
            else:
                value = -rate * (sum(g[i] for i in some) / 2**30) / (sum(h[i] for i in some) / 2**30 + penalty)
                for i in some:
                    margin[i] += value

        grow(list(range(len(rows))), 0)
    return margin


def table(spark, rows):
    return spark.createDataFrame([(i, list(map(float, v)), y, "x") for i, (v, y) in enumerate(rows)], "id long, features array<double>, label int, margin string")


def sample(n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        v = [rng.randrange(6), rng.gauss(0, 1), rng.choice([0.0, -0.0, 1e-300, 5.0]), rng.random()]
        rows.append((v, int(v[1] + v[0] / 3 + rng.gauss(0, 0.5) > 1)))
    return rows


@pytest.mark.parametrize("bins, keep", [(256, 10), (4, 2)])
def test_log_odds_are_those_of_a_plain_fit(spark, bins, keep):
    rows = sample(160, bins)
    df = table(spark, rows).repartition(5)
    model = boosting.fit(df, "features", "label", 5, 3, bins=bins, keep_every=keep)
    got = {r.id: r.x for r in df.select("id", model.log_odds(F.col("features")).alias("x")).collect()}
    assert np.allclose([got[i] for i in range(len(rows))], plain_fit(rows, 5, 3, bins), atol=1e-9)
    assert len(model.trees) == 5


def test_the_model_does_not_depend_on_the_order_of_rows(spark):
    rows = sample(300, 1)
    models = [boosting.fit(table(spark, rows).repartition(n, F.xxhash64("id", F.lit(n))), "features", "label", 4, 4) for n in (1, 7)]
    for a, b in zip(models[0].trees, models[1].trees, strict=True):
        assert (a.feature == b.feature).all() and (a.bin == b.bin).all() and (a.value == b.value).all()


def test_it_learns_and_stops_where_nothing_is_gained(spark):
    rows = sample(600, 2)
    df = table(spark, rows)
    model = boosting.fit(df, "features", "label", 12, 4)
    right = df.select(((model.log_odds(F.col("features")) > 0).cast("int") == F.col("label")).cast("int").alias("r")).agg(F.avg("r")).first()[0]
    assert right > 0.9
    flat = boosting.fit(table(spark, [([1.0, 2.0], 1)] * 40), "features", "label", 2, 6)
    assert all((t.feature == -1).all() for t in flat.trees) and flat.trees[0].value[1] > 0
    empty = table(spark, rows).limit(0)
    assert boosting.fit(empty, "features", "label", 2, 2).trees == []
    assert empty.select(model.log_odds(F.col("features"))).collect() == []


def test_bins_are_stored_in_one_byte_where_that_holds_them():
    edges = lambda n: [np.arange(n, dtype=float)]
    values = np.array([[-1.0], [0.0], [254.5], [np.nan]])
    small, large = boosting.BoostedTrees(edges(255), 2), boosting.BoostedTrees(edges(256), 2)
    assert small.binned(values).dtype == np.uint8 and small.binned(values).ravel().tolist() == [0, 1, 255, 255]
    assert large.binned(values).dtype == np.uint16 and large.binned(values).ravel().tolist() == [0, 1, 255, 256]
