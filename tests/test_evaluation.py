import random
from collections import Counter
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest

from trailmart.operators import evaluation as V


@pytest.fixture(scope="module")
def pairs():
    dice = random.Random(8)
    y = [float(dice.choice([0, 0, 1, 2, 3, 5, 8])) for _ in range(300)]
    p = [round(max(0.0, v + dice.gauss(0, 1.5)), 1) for v in y]
    return y, p


def frame(spark, y, p):
    rows = [(i, "d", a, b) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "itemid bigint, date string, sales double, forecast double")


@pytest.fixture(scope="module")
def pred(spark, pairs):
    return frame(spark, *pairs).cache()


def test_metrics(spark, pred, pairs):
    y, p = map(np.array, pairs)
    m = V.forecast_metrics(pred).first()
    assert m.mae == pytest.approx(np.abs(y - p).mean())
    assert m.rmse == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert m.mape == pytest.approx((np.abs(y - p) / np.maximum(y, 1e-6)).mean() * 100)
    assert m.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert V.wmape(pred).first()[0] == pytest.approx(np.abs(y - p).sum() / y.sum())


def test_metrics_corner_cases(spark):
    assert V.wmape(frame(spark, [0.0, 0.0], [1.0, 2.0])).first()[0] is None
    m = V.forecast_metrics(frame(spark, [2.0, 2.0, 2.0], [1.0, 2.0, None])).first()
    assert (m.samples, m.r2) == (2, 0.0)


def test_histograms(pred, pairs):
    err = np.abs(np.subtract(*pairs))
    assert [r.n for r in V.abs_error_hist(pred).orderBy("bin").collect()] == list(np.histogram(err, bins=40)[0])
    rows = V.log_error_hist(pred).orderBy("bin").collect()
    edges = np.logspace(-3, np.log10(err.max() + 1), 60)
    assert [r.n for r in rows] == list(np.histogram(err, bins=edges)[0])
    assert rows[0].median_error == pytest.approx(np.median(err))


def matrix(df):
    return {(r.actual_bin, r.predicted_bin): r.n for r in df.collect()}


def test_tercile_matrix_drops_equal_edges(spark):
    y, p = [0.0] * 60 + [1.0, 2.0, 3.0], [float(i % 9) for i in range(63)]
    a = pd.qcut(y, 3, labels=False, duplicates="drop")
    b = pd.qcut(p, 3, labels=False, duplicates="drop")
    assert matrix(V.quantile_matrix(frame(spark, y, p), 3)) == Counter(zip(a.tolist(), b.tolist()))


def test_quartile_matrix_has_the_extra_bin(pred, pairs):
    y, p = pairs
    edges = np.quantile(y, [0, 0.25, 0.5, 0.75, 1])
    expected = Counter(zip((np.digitize(y, edges) - 1).tolist(), (np.digitize(p, edges) - 1).tolist()))
    got = matrix(V.quantile_matrix(pred, 4, edges_from="actual", closed="left"))
    assert got == expected
    assert any(a == 4 for a, _ in got)


def test_mape_by_bins(pred, pairs):
    y, p = map(np.array, pairs)
    bins = pd.qcut(p, 5, labels=False, duplicates="drop")
    right = {r.bin: r.mape for r in V.mape_by_quantile(pred).collect()}
    share = np.abs(y - p) / np.maximum(y, 1e-9)
    assert right == pytest.approx({b: share[bins == b].mean() * 100 for b in set(bins.tolist())})
    place = np.digitize(p, np.quantile(p, np.linspace(0, 1, 6))) - 1
    left = {r.bin: r.mape for r in V.mape_by_quantile(pred, closed="left").collect()}
    expected = {}
    for b in range(5):
        use = (place == b) & (y != 0)
        if (place == b).sum() >= 2 and use.any():
            expected[b] = (np.abs(y - p)[use] / y[use]).mean() * 100
    assert left == pytest.approx(expected)


def test_qq_points(spark):
    residual = [3.0, -1.0, 0.5, 2.0, -4.0]
    rows = V.qq_points(frame(spark, residual, [0.0] * 5)).orderBy("position").collect()
    n, norm = 5, NormalDist()
    last = 0.5 ** (1 / n)
    medians = [1 - last] + [(i - 0.3175) / (n + 0.365) for i in range(2, n)] + [last]
    x = [norm.inv_cdf(m) for m in medians]
    assert [r.theoretical for r in rows] == pytest.approx(x)
    assert [r.ordered for r in rows] == sorted(residual)
    slope, intercept = np.polyfit(x, sorted(residual), 1)
    assert [r.fitted for r in rows] == pytest.approx([intercept + slope * v for v in x])
