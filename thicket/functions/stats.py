"""Numeric kernels on numpy arrays: regression, stability and break statistics, filters, logistic regression.

Kernels named ``..._rows`` take series of equal length as the rows of a matrix and work on all of them at once.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Critical values of the recursive MOSUM test (Chu et al. 1995), by window share, then significance level: fixed values.
LEVELS = (0.2, 0.15, 0.1, 0.05, 0.025, 0.01)
CRITICAL = {
    0.05: (3.2165, 3.3185, 3.4554, 3.6622, 3.8632, 4.1009),
    0.1: (2.9795, 3.0894, 3.2368, 3.4681, 3.6707, 3.9397),
    0.15: (2.8289, 2.9479, 3.1028, 3.3382, 3.5598, 3.8143),
    0.2: (2.7099, 2.8303, 2.9874, 3.2351, 3.4604, 3.7337),
    0.25: (2.6061, 2.7325, 2.8985, 3.1531, 3.3845, 3.6626),
    0.3: (2.5111, 2.6418, 2.8134, 3.0728, 3.3102, 3.5907),
    0.35: (2.4283, 2.5609, 2.7327, 3.0043, 3.2461, 3.5333),
    0.4: (2.3464, 2.4840, 2.6605, 2.9333, 3.1823, 3.4895),
    0.45: (2.2686, 2.4083, 2.5899, 2.8743, 3.1229, 3.4123),
    0.5: (2.2255, 2.3668, 2.5505, 2.8334, 3.0737, 3.3912),
}


def critical_value(window: float, level: float) -> float:
    return CRITICAL[window][LEVELS.index(level)]


def is_singular(matrix: np.ndarray) -> bool:
    """A determinant that is not positive."""
    return not np.linalg.det(matrix) > 0


def with_trend(n: int) -> np.ndarray:
    """Constant and time step 1 .. n."""
    return np.column_stack([np.ones(n), np.arange(1.0, n + 1)])


def residuals(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    return y - x @ np.linalg.solve(x.T @ x, x.T @ y)


def hansen_stat(ts) -> float | None:
    """Hansen's (1992) test of parameter stability in a trend regression; None where its matrix is singular.

    With the first-order conditions f_t stacked in F and their running sums in S: trace((T F F')^-1 S S').
    """
    y = np.asarray(ts, dtype=float)
    t = np.arange(1.0, len(y) + 1)
    e = residuals(y, with_trend(len(y)))
    f = np.vstack([e * t, e, e * e - np.mean(e * e)])
    s = np.cumsum(f, axis=1)
    scaled = len(y) * (f @ f.T)
    return None if is_singular(scaled) else float(np.trace(np.linalg.solve(scaled, s @ s.T)))


def trend_characteristics(y, x: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """OLS coefficients and t-statistics; None for a singular design."""
    y = np.asarray(y, dtype=float)
    xtx = x.T @ x
    if is_singular(xtx):
        return None
    inverse = np.linalg.inv(xtx)
    coefs = inverse @ (x.T @ y)
    rest = y - x @ coefs
    with np.errstate(all="ignore"):
        mse = rest @ rest / (len(y) - x.shape[1])
        return coefs, coefs / np.sqrt(mse * np.diag(inverse))


def long_stats(ts, *cofactors) -> tuple[float, float] | None:
    """Trend coefficient and its t-statistic, beside a constant and the cofactors that are not constant."""
    y = np.asarray(ts, dtype=float)
    others = [np.asarray(c, dtype=float) for c in cofactors]
    x = np.column_stack([with_trend(len(y)), *[c for c in others if len(np.unique(c)) != 1]])
    found = trend_characteristics(y, x)
    return None if found is None else (float(found[0][1]), float(found[1][1]))


def windowed_trend(size: int, ts) -> np.ndarray:
    """Slopes of all windows of ``size`` values."""
    y = np.asarray(ts, dtype=float)
    t = np.arange(size) - (size - 1) / 2
    return np.lib.stride_tricks.sliding_window_view(y, size) @ (t / (t @ t)) if len(y) >= size else np.zeros(0)


def moving_average(size: int, ts) -> np.ndarray:
    y = np.asarray(ts, dtype=float)
    return np.lib.stride_tricks.sliding_window_view(y, size).mean(axis=1) if len(y) >= size else np.zeros(0)


def short_stat_all(long_block: int, short_block: int, ts) -> np.ndarray:
    """Running minima of smoothed window slopes."""
    return np.minimum.accumulate(moving_average(short_block, windowed_trend(long_block, ts)))


def short_stat(long_block: int, short_block: int, ts) -> float:
    return float(short_stat_all(long_block, short_block, ts)[-1])


def telescoping_trends(values, rain, start: int, first: int, last: int, window: int = 10, long_block: int = 30) -> dict[str, list]:
    """Trend statistics of every prefix that ends at period ``first`` .. ``last`` of a series from ``start``.

    Series end, short, long, t-statistic and break by prefix. A series that ends early is padded with its last value,
    and so is the rain. Singular regressions give None.
    """
    y, r = np.asarray(values, dtype=float), np.asarray(rain, dtype=float)
    longest = last - start + 1
    y = np.concatenate([y[:longest], np.full(max(0, longest - len(y)), y[-1])])
    r = np.concatenate([r, np.full(max(0, longest - len(r)), r[-1])])
    sizes = range(first - start + 1, longest + 1)
    short = short_stat_all(long_block, window, y)
    short = short[max(0, len(short) - len(sizes)) :]
    longs = [long_stats(y[:n], r[:n]) for n in sizes]
    return {
        "end": [start + n - 1 for n in sizes],
        "short": [float(x) for x in short],
        "long": [None if x is None else x[0] for x in longs],
        "t_stat": [None if x is None else x[1] for x in longs],
        "break": [hansen_stat(y[:n]) for n in sizes],
    }


# --- filters ---


def deseasonalize(freq: int, ts) -> np.ndarray:
    """The series less its seasonal means, plus its mean."""
    y = np.asarray(ts, dtype=float)
    if freq <= 1 or len(y) < freq:
        raise ValueError("a season needs two periods or more, and the series one season")
    at = np.arange(len(y)) % freq
    return y - (np.bincount(at, y) / np.bincount(at))[at] + y.mean()


def harmonics(freq: int, k: int, n: int) -> np.ndarray:
    t = np.arange(1.0, n + 1)
    return np.column_stack([f(2 * np.pi * j * t / freq) for j in range(1, k + 1) for f in (np.cos, np.sin)])


def harmonic_decomposition(freq: int, k: int, ts) -> np.ndarray:
    """The series less its fit on k harmonics and a constant, plus its mean."""
    y = np.asarray(ts, dtype=float)
    return residuals(y, np.column_stack([np.ones(len(y)), harmonics(freq, k, len(y))])) + y.mean()


def hp_matrix(n: int) -> np.ndarray:
    """Penalty of squared second differences: D'D."""
    if n < 9:
        raise ValueError("nine periods at least")
    d = np.diff(np.eye(n), 2, axis=0)
    return d.T @ d


def hp_filter(penalty: float, ts) -> np.ndarray:
    y = np.asarray(ts, dtype=float)
    return np.linalg.solve(penalty * hp_matrix(len(y)) + np.eye(len(y)), y)


def interpolate(a: float, b: float, n: int) -> list[float]:
    """n values from a towards b, without b, in 32 bits."""
    return [float(np.float32(a + i * (b - a) / n)) for i in range(n)]


def bad_ends(bad: set, flags) -> set[int]:
    """Indices of the unbroken runs of bad flags at either end."""
    q, out = list(flags), set()
    for order in (range(len(q)), range(len(q) - 1, -1, -1)):
        for i in order:
            if q[i] not in bad:
                break
            out.add(i)
    return out


def neutralize_ends(bad: set, flags, values) -> list[float]:
    """Bad ends take the mean (32 bits) of the values whose flag is not bad."""
    ends = bad_ends(bad, flags)
    if not ends:
        return list(values)
    fine = [v for q, v in zip(flags, values, strict=True) if q not in bad]
    mean = float(np.float32(np.mean(fine))) if fine else None
    return [mean if i in ends else v for i, v in enumerate(values)]


def make_reliable(good: set, bad: set, values, flags) -> list[float] | None:
    """Bad ends neutralised and bad stretches inside interpolated; None if no flag is good, as it is if all are."""
    seen = set(flags)
    if not seen & good:
        return None
    if not seen - good:
        return list(values)
    ends = bad_ends(bad, flags)
    fixed = neutralize_ends(bad, flags, values)
    fine = [i for i, q in enumerate(flags) if i in ends or q not in bad]
    out: list[float] = []
    for left, right in zip(fine, fine[1:], strict=False):
        out += [fixed[left]] if right == left + 1 else interpolate(fixed[left], fixed[right], right - left)
    return [*out, fixed[fine[-1]]]


# --- structural breaks (recursive MOSUM) ---


def _ols(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(x, y, rcond=None)[0]


def recursive_residual(y, x, at: int) -> float:
    """Scaled error of predicting observation ``at`` from the observations before the one before it."""
    y, x = np.asarray(y, dtype=float), np.asarray(x, dtype=float)
    past_x, past_y = x[: at - 1], y[: at - 1]
    spread = x[at] @ np.linalg.pinv(past_x.T @ past_x) @ x[at]
    return float((y[at] - x[at] @ _ols(past_y, past_x)) / np.sqrt(1 + spread))


def recursive_residuals(y, x) -> np.ndarray:
    x = np.asarray(x, dtype=float)
    return np.array([recursive_residual(y, x, i) for i in range(x.shape[1] + 1, len(x))])


def recursive_sd(y, x) -> float:
    r, (n, k) = recursive_residuals(y, x), np.shape(x)
    return float(np.sqrt(((r - r.mean()) ** 2).sum() / (n - k)))


def mosum(y, x, window: float) -> np.ndarray:
    """The empirical fluctuation process: moving sums of recursive residuals, scaled."""
    if window not in CRITICAL:
        raise ValueError(f"no critical values for window {window}")
    n, k = np.shape(x)
    size = int(np.floor((n - k) * window))
    r = recursive_residuals(y, x)
    return np.lib.stride_tricks.sliding_window_view(r, size).sum(axis=1) / (np.sqrt(size) * recursive_sd(y, x))


def mosum_statistic(process) -> float:
    return float(abs(np.min(process)))


def break_index(y, x, window: float, level: float) -> int | None:
    """The period of the first significant fall; None without one."""
    n, k = np.shape(x)
    low = np.flatnonzero(mosum(y, x, window) <= -critical_value(window, level))
    return int(np.floor(n * window) + k + low[0]) if len(low) else None


def piecewise_fit(y, x, at: int) -> np.ndarray:
    y, x = np.asarray(y, dtype=float), np.asarray(x, dtype=float)
    return np.concatenate([x[:at] @ _ols(y[:at], x[:at]), x[at:] @ _ols(y[at:], x[at:])])


def break_magnitude(y, x, at: int) -> float:
    y, x = np.asarray(y, dtype=float), np.asarray(x, dtype=float)
    alpha, beta = _ols(y[:at], x[:at]) - _ols(y[at:], x[at:])
    return float(alpha + beta * at)


def mosum_prediction(y, x, window: float, level: float) -> tuple[int | None, np.ndarray]:
    at = break_index(y, x, window, level)
    y, x = np.asarray(y, dtype=float), np.asarray(x, dtype=float)
    return at, (x @ _ols(y, x) if at is None else piecewise_fit(y, x, at))


def downshift_magnitude(y, x, window: float, level: float) -> float | None:
    at, fitted = mosum_prediction(y, x, window, level)
    return None if at is None else float(fitted[at - 1] - fitted[at])


# --- series of equal length at once ---


def trend_rows(y: np.ndarray) -> np.ndarray:
    """Slopes of whole series."""
    t = np.arange(y.shape[1]) - (y.shape[1] - 1) / 2
    if y.shape[1] < 2:
        raise ValueError("two periods at least")
    return y @ (t / (t @ t))


def hansen_rows(y: np.ndarray) -> np.ndarray:
    """``hansen_stat`` of each row; NaN where its matrix is singular.

    Time is centred, which changes neither the statistic nor the sign of the determinant.
    """
    n = y.shape[1]
    t = np.arange(n) - (n - 1) / 2
    if n < 2:
        return np.full(len(y), np.nan)
    e = y - y.mean(axis=1, keepdims=True)
    e -= (e @ (t / (t @ t)))[:, None] * t
    square = e * e
    f = np.stack([e * t, e, square - square.mean(axis=1, keepdims=True)], axis=1)
    s = np.cumsum(f, axis=2)
    scaled, sums = n * (f @ f.transpose(0, 2, 1)), s @ s.transpose(0, 2, 1)
    with np.errstate(all="ignore"):
        fine = np.linalg.det(scaled) > 0
    found = np.trace(np.linalg.solve(np.where(fine[:, None, None], scaled, np.eye(3)), sums), axis1=1, axis2=2)
    return np.where(fine, found, np.nan)


def short_stat_rows(long_block: int, short_block: int, y: np.ndarray) -> np.ndarray:
    """Running minima of smoothed window slopes, of each row; slopes and means from running sums."""
    n = y.shape[1]
    if n < long_block + short_block - 1:
        raise ValueError("too short")
    y = y - y.mean(axis=1, keepdims=True)
    none = np.zeros((len(y), 1))
    plain = np.cumsum(np.hstack([none, y]), axis=1)
    by_time = np.cumsum(np.hstack([none, y * np.arange(n)]), axis=1)
    t = np.arange(long_block) - (long_block - 1) / 2
    centre = np.arange(n - long_block + 1) + (long_block - 1) / 2
    slopes = (by_time[:, long_block:] - by_time[:, :-long_block] - centre * (plain[:, long_block:] - plain[:, :-long_block])) / (t @ t)
    upto = np.cumsum(np.hstack([none, slopes]), axis=1)
    return np.minimum.accumulate((upto[:, short_block:] - upto[:, :-short_block]) / short_block, axis=1)


def deseasonalize_rows(freq: int, y: np.ndarray) -> np.ndarray:
    n = y.shape[1]
    if freq <= 1 or n < freq:
        raise ValueError("a season needs two periods or more, and the series one season")
    at = np.arange(n) % freq
    means = np.stack([y[:, k::freq].mean(axis=1) for k in range(freq)], axis=1)
    return y - means[:, at] + y.mean(axis=1, keepdims=True)


def harmonic_rows(freq: int, k: int, y: np.ndarray) -> np.ndarray:
    x = np.column_stack([np.ones(y.shape[1]), harmonics(freq, k, y.shape[1])])
    if y.shape[1] < x.shape[1]:
        raise ValueError("fewer periods than coefficients")
    return y - (y @ x) @ np.linalg.inv(x.T @ x) @ x.T + y.mean(axis=1, keepdims=True)


@lru_cache(maxsize=64)
def _hp_factors(penalty: float, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """L D L' of I + penalty * D'D, whose rows have two numbers left of the diagonal: these two of L, and D."""
    diagonal, one, two = np.full(n, 6.0), np.full(n, -4.0), np.ones(n)
    diagonal[[0, -1]], diagonal[[1, -2]], one[[1, -1]] = 1.0, 5.0, -2.0
    diagonal, one, two = 1 + penalty * diagonal, penalty * one, penalty * two
    d, l1, l2 = np.empty(n), np.zeros(n), np.zeros(n)
    for i in range(n):
        l2[i] = two[i] / d[i - 2] if i > 1 else 0.0
        l1[i] = (one[i] - (l2[i] * d[i - 2] * l1[i - 1] if i > 1 else 0.0)) / d[i - 1] if i else 0.0
        d[i] = diagonal[i] - (l1[i] ** 2 * d[i - 1] if i else 0.0) - (l2[i] ** 2 * d[i - 2] if i > 1 else 0.0)
    return d, l1, l2


def hp_rows(penalty: float, y: np.ndarray) -> np.ndarray:
    """``hp_filter`` of each row by a banded factorisation, which all rows share: linear in their length."""
    n = y.shape[1]
    if n < 9:
        raise ValueError("nine periods at least")
    d, l1, l2 = _hp_factors(float(penalty), n)
    z = np.ascontiguousarray(y.T)
    for i in range(1, n):
        z[i] -= l1[i] * z[i - 1] + (l2[i] * z[i - 2] if i > 1 else 0.0)
    z /= d[:, None]
    for i in range(n - 2, -1, -1):
        z[i] -= l1[i + 1] * z[i + 1] + (l2[i + 2] * z[i + 2] if i + 2 < n else 0.0)
    return z.T


def recursive_residual_rows(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """``recursive_residuals`` of each row, beside a design that all rows share.

    A least-squares fit takes up one observation at a time: the inverse gets a rank-one update, the coefficients a step
    along the gain. As long as the first observations leave the design singular, they are fitted afresh.
    """
    (m, n), k = y.shape, x.shape[1]
    out, inverse, beta = np.empty((m, max(0, n - k - 1))), None, None
    for at in range(k + 1, n):
        past, now = at - 1, x[at]
        if inverse is not None:
            seen = x[past - 1]
            gain = inverse @ seen
            gain /= 1 + seen @ gain
            beta += np.outer(y[:, past - 1] - beta @ seen, gain)
            inverse -= np.outer(gain, seen @ inverse)
            spread, fitted = now @ inverse @ now, beta @ now
        else:
            regular = np.linalg.matrix_rank(x[:past]) == k
            whole = (np.linalg.inv if regular else np.linalg.pinv)(x[:past].T @ x[:past])
            first = y[:, :past] @ (x[:past] @ whole if regular else np.linalg.pinv(x[:past]).T)
            spread, fitted = now @ whole @ now, first @ now
            if regular:
                inverse, beta = whole, first
        out[:, at - k - 1] = (y[:, at] - fitted) / np.sqrt(1 + spread)
    return out


def mosum_rows(y: np.ndarray, x: np.ndarray, window: float) -> np.ndarray:
    """``mosum`` of each row."""
    if window not in CRITICAL:
        raise ValueError(f"no critical values for window {window}")
    n, k = x.shape
    size = int(np.floor((n - k) * window))
    r = recursive_residual_rows(y, x)
    if not 0 < size <= r.shape[1]:
        raise ValueError("too short")
    sd = np.sqrt(((r - r.mean(axis=1, keepdims=True)) ** 2).sum(axis=1) / (n - k))
    upto = np.cumsum(np.hstack([np.zeros((len(r), 1)), r]), axis=1)
    with np.errstate(all="ignore"):
        return (upto[:, size:] - upto[:, :-size]) / (np.sqrt(size) * sd)[:, None]


# --- logistic regression ---


def logistic(x):
    with np.errstate(all="ignore"):
        e = np.exp(x)
        return e / (e + 1)


def newton_step(beta: np.ndarray, labels: np.ndarray, features: np.ndarray, ridge: float, accumulate: bool = True) -> np.ndarray:
    """A Newton-Raphson step with a ridge, corrected to the ridge's first order.

    With ``accumulate`` every ridge is added to what earlier ones left in the information matrix: r, then r + 1.1 r,
    then 2.1 r + 0.9 r. Without, each is added to the bare matrix.
    """
    p = logistic(features @ beta)
    return newton_sums(features.T @ (labels - p), (features * (p * (1 - p))[:, None]).T @ features, ridge, accumulate)


def newton_sums(score: np.ndarray, info: np.ndarray, ridge: float, accumulate: bool = True) -> np.ndarray:
    """``newton_step`` from the score and the information matrix."""
    held = 0.0

    def solved(r: float) -> np.ndarray:
        nonlocal held
        held = held + r if accumulate else r
        return np.linalg.solve(info + held * np.eye(len(info)), score)

    step = ridge / 10
    plain, upper, lower = solved(ridge), solved(ridge + step), solved(ridge - step)
    return plain + (lower - upper) * ridge / (2 * step)


def logistic_fit(labels, features, ridge: float = 1e-8, threshold: float = 1e-6, max_iter: int = 500, accumulate: bool = True) -> np.ndarray:
    y, x = np.asarray(labels, dtype=float), np.asarray(features, dtype=float)
    beta = np.zeros(x.shape[1])
    for _ in range(max_iter):
        step = newton_step(beta, y, x, ridge, accumulate)
        beta = beta + step
        if np.linalg.norm(step) < threshold:
            break
    return beta


def log_likelihood(beta, labels, features) -> float:
    p = logistic(np.asarray(features, dtype=float) @ np.asarray(beta, dtype=float))
    y = np.asarray(labels, dtype=float)
    return float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())
