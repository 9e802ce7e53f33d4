"""Kernels over many series at once, and scans over arrays, against one series and one value at a time."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from thicket.functions import arrays as A
from thicket.functions import stats as S
from thicket.operators import trends as T


def series(n=271, m=20, seed=1):
    return 6000 + 1500 * np.sin(np.arange(n) * 2 * np.pi / 23) + np.random.default_rng(seed).normal(0, 900, (m, n))


def each(kernel, y):
    return np.array([kernel(row) for row in y])


@pytest.mark.parametrize("n", [9, 23, 60, 271])
def test_rows_match_one_series(n):
    y, x = series(n), S.with_trend(n)
    close = lambda a, b: np.testing.assert_allclose(a, b, rtol=1e-8, atol=1e-8)
    close(S.recursive_residual_rows(y, x), each(lambda v: S.recursive_residuals(v, x), y))
    close(S.hansen_rows(y), each(S.hansen_stat, y))
    close(S.hp_rows(100, y), each(lambda v: S.hp_filter(100, v), y))
    close(S.trend_rows(y), each(lambda v: S.long_stats(v)[0], y))
    close(S.harmonic_rows(23, 3, y), each(lambda v: S.harmonic_decomposition(23, 3, v), y))
    if n >= 23:
        close(S.deseasonalize_rows(23, y), each(lambda v: S.deseasonalize(23, v), y))
        close(S.mosum_rows(y, x, 0.25), each(lambda v: S.mosum(v, x, 0.25), y))
    if n >= 60:
        close(S.short_stat_rows(30, 10, y), each(lambda v: S.short_stat_all(30, 10, v), y))


def test_design_that_is_singular_at_first():
    """A cofactor that is constant for some periods, as no rain is, leaves the first fits without a unique solution."""
    y = series(80)
    x = np.column_stack([S.with_trend(80), np.r_[np.zeros(7), np.random.default_rng(2).normal(size=73)]])
    np.testing.assert_allclose(S.recursive_residual_rows(y, x), each(lambda v: S.recursive_residuals(v, x), y), rtol=1e-6, atol=1e-6)


def test_smoothing_is_linear_and_exact():
    """The equations of the penalised trend hold; ten times the periods take about ten times as long."""
    y = series(3650, 4)
    z = S.hp_rows(1600, y)
    second = np.diff(z, 2, axis=1)
    rest = z + 1600 * (np.pad(second, ((0, 0), (2, 0)))[:, :] - 2 * np.pad(second, ((0, 0), (1, 1))) + np.pad(second, ((0, 0), (0, 2)))) - y
    assert np.abs(rest).max() < 1e-5
    began = time.time()
    S.hp_rows(1600, series(20_000, 2))
    assert time.time() - began < 5


def test_break_process_is_fast():
    y, x = series(271, 500), S.with_trend(271)
    S.mosum_rows(y[:2], x, 0.25)
    began = time.time()
    S.mosum_rows(y, x, 0.25)
    assert (time.time() - began) / 500 < 1e-3


def test_singular_and_short():
    assert np.isnan(S.hansen_rows(np.zeros((2, 100)))).all()
    for kernel in (lambda y: S.hp_rows(100, y), lambda y: S.deseasonalize_rows(23, y), lambda y: S.short_stat_rows(30, 10, y), lambda y: S.mosum_rows(y, S.with_trend(3), 0.25), lambda y: S.harmonic_rows(23, 3, y)):
        with pytest.raises(ValueError):
            kernel(np.ones((2, 3)))


def test_columns_of_many_lengths(spark):
    """Series of several lengths in one batch, nulls, holes and series that a kernel rejects."""
    rows = [(k, series(n, 1, k)[0].tolist()) for k, n in enumerate([271, 60, 271, 5, 60, 23])] + [(6, None), (7, []), (8, [1.0, None, 3.0] * 20), (9, [0.0] * 100), (10, [1.0])]
    df = spark.createDataFrame(rows, "k int, y array<double>").coalesce(1)
    y = F.col("y")
    out = {r.k: r for r in df.select("k", T.stability(y).alias("a"), T.stability_rows(y).alias("b"), T.long_trend(y).alias("long"), T.short_drop(y, 30, 10).alias("short"), T.mosum_process(y).alias("breaks"), T.hp_trend(y, 100.0).alias("hp")).collect()}
    for k, values in rows:
        r = out[k]
        if values is None or None in values or len(values) < 2:
            assert (r.b, r.short, r.breaks, r.hp) == (None,) * 4
            continue
        want = S.hansen_stat(values)
        assert (r.a, r.b) == ((None, None) if want is None else (pytest.approx(want), pytest.approx(want)))
        assert r.long == pytest.approx(S.long_stats(values)[0])
        assert r.short == (pytest.approx(S.short_stat(30, 10, values)) if len(values) >= 39 else None)
        assert r.hp == (pytest.approx(S.hp_filter(100, values).tolist()) if len(values) >= 9 else None)
        if len(values) > 20 and k != 9:
            assert r.breaks == pytest.approx(S.mosum(values, S.with_trend(len(values)), 0.25).tolist())


def test_stability_finds_a_break():
    y = series(271, 1)[0]
    broken = np.r_[y[:135], y[135:] / 2]
    assert S.hansen_rows(broken[None])[0] > S.hansen_rows(y[None])[0]
    assert T.telescope(y, np.ones(271), 700, 970, 970, 10, 30)["long"][0] == pytest.approx(S.long_stats(y)[0])  # constant rain is ignored


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 130, 1000])
def test_scans(spark, n):
    rng = np.random.default_rng(n)
    y = rng.integers(-9, 10, n).astype(float)
    df = spark.createDataFrame([(y.tolist(),)], "y array<double>")
    r = df.select(
        A.running("y", F.array_min).alias("low"), A.running("y", F.array_max).alias("high"), A.running_sum("y").alias("total"),
        A.fill_forward("y", lambda x: x > 0, -1.0).alias("filled"), *[A.moving_average("y", w).alias(f"w{w}") for w in (1, 2, 10, 64)],
    ).first()
    assert r.low == np.minimum.accumulate(y).tolist() and r.high == np.maximum.accumulate(y).tolist() and r.total == np.cumsum(y).tolist()
    last, want = -1.0, []
    for x in y:
        last = last if x > 0 else x
        want.append(last)
    assert r.filled == want
    for w in (1, 2, 10, 64):
        assert r[f"w{w}"] == pytest.approx(S.moving_average(w, y).tolist())


def test_scans_of_nulls(spark):
    df = spark.createDataFrame([([None, 3.0, None, 1.0],), (None,)], "y array<double>")
    rows = df.select(A.running("y", F.array_min).alias("a"), A.fill_forward("y", None, None).alias("b")).collect()
    assert [tuple(r) for r in rows] == [([None, 3.0, 3.0, 1.0], [None, 3.0, 3.0, 1.0]), (None, None)]
    scanned = df.select(T.stability_rows(A.fill_forward("y", None, 0.0)).alias("a"))
    assert scanned.count() == 2 and scanned.collect()[1].a is None
