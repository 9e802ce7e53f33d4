"""Trend statistics of every prefix of a series, and other series kernels, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import periods as P
from ..functions import stats as S
from ..schema import KEYS, RunParams


def _solve(xtx: np.ndarray, xty: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Batched normal equations: coefficients, inverses and whether each is regular (its determinant positive)."""
    with np.errstate(all="ignore"):
        regular = np.linalg.det(xtx) > 0
    safe = np.where(regular[:, None, None], xtx, np.eye(xtx.shape[1]))
    inverse = np.linalg.inv(safe)
    return (inverse @ xty[:, :, None])[:, :, 0], inverse, regular


def prefix_trends(values: np.ndarray, rain: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """Trend coefficient, t-statistic and stability statistic of all prefixes at once; NaN where singular.

    Moments of the prefixes are running sums, so no prefix is summed again; a prefix over which the rain is constant
    leaves it out.
    """
    y, r = np.asarray(values, dtype=float), np.asarray(rain, dtype=float)
    n, t = sizes.astype(float), np.arange(1.0, len(y) + 1)
    inside = t[None, :] <= n[:, None]

    def regress(x: np.ndarray):
        xtx = np.cumsum(x[:, :, None] * x[:, None, :], axis=0)[sizes - 1]
        xty = np.cumsum(x * y[:, None], axis=0)[sizes - 1]
        beta, inverse, regular = _solve(xtx, xty)
        rest = np.where(inside, y - beta @ x.T, 0.0)
        with np.errstate(all="ignore"):
            mse = (rest * rest).sum(axis=1) / (n - x.shape[1])
            t_stat = beta[:, 1] / np.sqrt(mse * inverse[:, 1, 1])
        return np.where(regular, beta[:, 1], np.nan), np.where(regular, t_stat, np.nan), rest, regular

    one = np.ones_like(t)
    slope2, t2, rest, regular = regress(np.column_stack([one, t]))
    slope3, t3, _, _ = regress(np.column_stack([one, t, r]))
    constant = (np.maximum.accumulate(r) == np.minimum.accumulate(r))[sizes - 1]
    square = np.where(inside, rest * rest - ((rest * rest).sum(axis=1) / n)[:, None], 0.0)
    f = np.stack([rest * t, rest, square], axis=1)
    s = np.where(inside[:, None, :], np.cumsum(f, axis=2), 0.0)
    ff, ss = n[:, None, None] * (f @ f.transpose(0, 2, 1)), s @ s.transpose(0, 2, 1)
    with np.errstate(all="ignore"):
        stable = regular & (np.linalg.det(ff) > 0)
    hansen = np.trace(np.linalg.solve(np.where(stable[:, None, None], ff, np.eye(3)), ss), axis1=1, axis2=2)
    return {"long": np.where(constant, slope2, slope3), "t_stat": np.where(constant, t2, t3), "break": np.where(stable, hansen, np.nan)}


def telescope(values, rain, start: int, first: int, last: int, short_block: int, long_block: int) -> dict[str, list]:
    """As ``stats.telescoping_trends``, all prefixes at once."""
    y, r = np.asarray(values, dtype=float), np.asarray(rain, dtype=float)
    longest = last - start + 1
    y = np.concatenate([y[:longest], np.full(max(0, longest - len(y)), y[-1])])
    r = np.concatenate([r[:longest], np.full(max(0, longest - len(r)), r[-1])])
    sizes = np.arange(first - start + 1, longest + 1)
    short = S.short_stat_all(long_block, short_block, y)
    out = {k: [None if np.isnan(x) else float(x) for x in v] for k, v in prefix_trends(y, r, sizes).items()}
    return {"end": [int(start + n - 1) for n in sizes], "short": [float(x) for x in short[max(0, len(short) - len(sizes)) :]], **out}


def analyze_trends(df: DataFrame, params: RunParams, keys: list[str] = KEYS) -> DataFrame:
    """Trend series of each pixel (start_idx, ndvi, precl) from the end of training to the end of estimation:
    ``start_idx, end_idx, short, long, t_stat, break``. Filters belong before it: a batch UDF stops pushdown."""
    first, last = P.period_of(params.est_start, params.t_res), P.period_of(params.est_end or params.est_start, params.t_res)
    rows = df.select(*keys, "start_idx", A.fill_forward("ndvi", params.nodata, None).alias("ndvi"), "precl")
    schema = ", ".join([f"{k} {df.schema[k].dataType.simpleString()}" for k in keys]) + ", start_idx int, end_idx int, short array<double>, `long` array<double>, t_stat array<double>, `break` array<double>"
    short_block, long_block = params.short_block, params.long_block

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [telescope(np.array(v, dtype=float), p, int(s), first, last, short_block, long_block) for v, p, s in zip(batch["ndvi"], batch["precl"], batch["start_idx"], strict=True)]
            out = batch[keys].copy()
            out["start_idx"] = first
            out["end_idx"] = [max(f["end"]) for f in found]
            for name in ("short", "long", "t_stat", "break"):
                out[name] = [f[name] for f in found]
            yield out

    return rows.mapInPandas(run, schema)


def stacked(column: Column, kernel: Callable[[np.ndarray], np.ndarray], scalar: bool = False) -> Column:
    """A kernel over an array column in Arrow batches: it gets all series of a length as the rows of one matrix, and gives
    as many rows, or numbers (``scalar``). Nulls, series with nulls, and lengths that the kernel rejects, give null; so
    does NaN where a number is asked."""

    @F.pandas_udf("double" if scalar else "array<double>")
    def run(series: pd.Series) -> pd.Series:
        out = np.full(len(series), None, dtype=object)
        lengths = np.array([-1 if x is None else len(x) for x in series])
        for n in np.unique(lengths[lengths >= 0]):
            at = np.flatnonzero(lengths == n)
            rows = np.stack([np.asarray(series.iloc[k], dtype=float) for k in at])
            whole = ~np.isnan(rows).any(axis=1)
            try:
                found = kernel(rows[whole])
            except ValueError:
                continue
            for k, x in zip(at[whole], found, strict=True):
                out[k] = x if not scalar else None if np.isnan(x) else float(x)
        return pd.Series(out, dtype="float64") if scalar else pd.Series(out)

    return run(column)


def deseasonalized(column: Column, freq: int) -> Column:
    return stacked(column, lambda y: S.deseasonalize_rows(freq, y))


def harmonic_trend(column: Column, freq: int, k: int = 3) -> Column:
    return stacked(column, lambda y: S.harmonic_rows(freq, k, y))


def hp_trend(column: Column, penalty: float) -> Column:
    return stacked(column, lambda y: S.hp_rows(penalty, y))


def mosum_process(column: Column, window: float = 0.25) -> Column:
    return stacked(column, lambda y: S.mosum_rows(y, S.with_trend(y.shape[1]), window))


def short_drop(column: Column, long_block: int, short_block: int) -> Column:
    return stacked(column, lambda y: S.short_stat_rows(long_block, short_block, y)[:, -1], scalar=True)


def long_trend(column: Column) -> Column:
    """Slope of a whole series by one fold; null for fewer than two values."""

    def slope(y: Column) -> Column:
        n = F.size(y)
        zero = F.struct(F.lit(0.0).alias("i"), F.lit(0.0).alias("s"))
        step = lambda acc, v: F.struct((acc["i"] + 1).alias("i"), (acc["s"] + v * (acc["i"] - (n - 1) / 2)).alias("s"))
        return F.when(n > 1, F.aggregate(y, zero, step, lambda acc: acc["s"] * 12 / (n.cast("double") * n * n - n)))

    return A.let(column, slope)


def stability(column: Column) -> Column:
    """``stats.hansen_stat`` by two folds: least squares from two running sums, then the running sums of the three
    first-order conditions with the six moments of each, and the trace from a 3 x 3 inverse. Null where singular.

    Time is centred, which changes neither the statistic nor the sign of the determinant.
    """
    pairs = [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]
    zero = F.lit(0.0)

    def fitted(y: Column) -> Column:
        n = F.size(y).cast("double")
        start = F.struct(*[zero.alias(c) for c in ("i", "s", "ts", "ss")])

        def step(acc: Column, v: Column) -> Column:
            t = acc["i"] - (n - 1) / 2
            return F.struct((acc["i"] + 1).alias("i"), (acc["s"] + v).alias("s"), (acc["ts"] + t * v).alias("ts"), (acc["ss"] + v * v).alias("ss"))

        return F.aggregate(y, start, step, lambda acc: F.struct(n.alias("n"), (acc["s"] / n).alias("mean"), (acc["ts"] * 12 / (n * n * n - n)).alias("slope")))

    def residuals(y: Column, fit: Column) -> Column:
        return F.transform(y, lambda v, i: v - fit["mean"] - fit["slope"] * (i - (fit["n"] - 1) / 2))

    def moments(e: Column, n: Column) -> Column:
        mse = A.total(F.transform(e, lambda v: v * v)) / n
        start = F.struct(*[zero.alias(c) for c in ("i", "s0", "s1", "s2", *[f"{m}{a}{b}" for m in "fs" for a, b in pairs])])

        def conditions(acc: Column, v: Column, mean: Column) -> list[Column]:
            return [v * (acc["i"] - (n - 1) / 2), v, v * v - mean]

        def step(mean: Column):
            def one(acc: Column, v: Column) -> Column:
                f = conditions(acc, v, mean)
                s = [acc[f"s{k}"] + f[k] for k in range(3)]
                return F.struct(
                    (acc["i"] + 1).alias("i"), *[s[k].alias(f"s{k}") for k in range(3)],
                    *[(acc[f"f{a}{b}"] + f[a] * f[b]).alias(f"f{a}{b}") for a, b in pairs], *[(acc[f"s{a}{b}"] + s[a] * s[b]).alias(f"s{a}{b}") for a, b in pairs],
                )

            return one

        return A.let(mse, lambda mean: F.aggregate(e, start, step(mean)))

    def trace(m: Column, n: Column) -> Column:
        f = lambda a, b: m[f"f{min(a, b)}{max(a, b)}"]
        s = lambda a, b: m[f"s{min(a, b)}{max(a, b)}"]

        def cofactor(a: int, b: int) -> Column:
            (p, q), (r, t) = [k for k in range(3) if k != a], [k for k in range(3) if k != b]
            return (f(p, r) * f(q, t) - f(p, t) * f(q, r)) * (-1.0 if (a + b) % 2 else 1.0)

        det = f(0, 0) * cofactor(0, 0) + f(0, 1) * cofactor(0, 1) + f(0, 2) * cofactor(0, 2)
        top = sum(((cofactor(a, b) * s(a, b)) * (1.0 if a == b else 2.0) for a, b in pairs), zero)
        return F.when(det > 0, top / (det * n))

    def whole(y: Column) -> Column:
        return A.let(fitted(y), lambda fit: A.let(moments(residuals(y, fit), fit["n"]), lambda m: trace(m, fit["n"])))

    return F.when(F.size(column) > 1, A.let(column, whole))


def stability_rows(column: Column) -> Column:
    """``stability`` in Arrow batches, all series of a length at once."""
    return stacked(column, S.hansen_rows, scalar=True)
