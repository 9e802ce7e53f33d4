"""Series as array columns: built-in higher-order functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once. Inside a lambda an expression is computed for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _indices(size: Column) -> Column:
    return F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))


STRETCH = 64  # values that a fold gathers before it puts them aside


def scan(series, join: Callable[[Column, Column], Column], start=None, kind: str = "double") -> Column:
    """What ``join`` makes of the value before (at first ``start``) and each value, in turn: prefix sums, minima, last good
    values.

    One fold that carries the last value. An array that grew by one at each step would be copied as often; so values
    gather in short stretches, and only these are put aside, which keeps the cost linear in the series.
    """
    zero = F.struct(F.array().cast(f"array<array<{kind}>>").alias("out"), F.array().cast(f"array<{kind}>").alias("now"), _lit(start).cast(kind).alias("last"))

    def step(acc: Column, x: Column) -> Column:
        value, full = join(acc["last"], x).cast(kind), F.size(acc["now"]) >= STRETCH
        out = F.when(full, F.concat(acc["out"], F.array(acc["now"]))).otherwise(acc["out"])
        now = F.when(full, F.array(value)).otherwise(F.concat(acc["now"], F.array(value)))
        return F.struct(out.alias("out"), now.alias("now"), value.alias("last"))

    return F.aggregate(_c(series), zero, step, lambda acc: F.flatten(F.concat(acc["out"], F.array(acc["now"]))))


def fill_forward(series, bad: Callable[[Column], Column] | float | None, default: float | None = None, kind: str = "double") -> Column:
    """Bad values take the last good value before them, or ``default``. ``bad``: a test, a value, or None for nulls."""
    test = bad if callable(bad) else (lambda x: x.isNull()) if bad is None else (lambda x: x == F.lit(bad))
    return scan(series, lambda last, x: F.when(F.coalesce(test(x), F.lit(False)), last).otherwise(x.cast(kind)), default, kind)


def running(series, pick: Callable[..., Column], kind: str = "double") -> Column:
    """Prefix maxima (``F.array_max``) or minima (``F.array_min``); nulls are passed over."""
    return scan(series, {"array_max": F.greatest, "array_min": F.least}[pick.__name__], None, kind)


def running_sum(series) -> Column:
    return scan(series, lambda last, x: last + x, 0.0)


def total(series) -> Column:
    return F.aggregate(_c(series), F.lit(0.0), lambda a, x: a + x)


def average(series) -> Column:
    return let(_c(series), lambda s: total(s) / F.size(s))


def moving_sum(series, window: int) -> Column:
    """Sums of all whole windows, from sums of 1, 2, 4 ... values: the window's length counts by its digits only.

    Store it before a Python function takes it: Spark finds no such function whose argument has a lambda inside another.
    """

    def step(state: Column, digit: Column) -> Column:
        """``sums`` of 2**k values from each place on, and ``out`` of the window's lower digits, taken on by one digit."""
        sums, out = state["sums"], state["out"]
        more = lambda values, by: F.transform(values, lambda x, i: x + F.coalesce(F.get(sums, i + by), F.lit(0.0)))
        return F.struct(F.when(digit["last"], sums).otherwise(more(sums, digit["back"])).alias("sums"), F.when(digit["set"], more(out, digit["done"])).otherwise(out).alias("out"))

    s, n = F.transform(_c(series), lambda x: x.cast("double")), window.bit_length()
    digits = [F.struct(F.lit(1 << k).alias("back"), F.lit(window & ((1 << k) - 1)).alias("done"), F.lit(bool(window >> k & 1)).alias("set"), F.lit(k == n - 1).alias("last")) for k in range(n)]
    start = F.struct(s.alias("sums"), F.transform(s, lambda x: F.lit(0.0)).alias("out"))
    return F.aggregate(F.array(*digits), start, step, lambda state: F.slice(state["out"], 1, F.greatest(F.size(state["out"]) - (window - 1), F.lit(0))))


def moving_average(series, window: int) -> Column:
    """Means of all whole windows: size - window + 1 values."""
    return F.transform(moving_sum(series, window), lambda x: x / window)


def trailing_average(series, window: int) -> Column:
    """Means of up to ``window`` values that end at each; every mean is rounded to 32 bits."""

    def mean(s: Column, i: Column) -> Column:
        return average(F.slice(s, F.greatest(i + 2 - window, F.lit(1)), F.least(F.lit(window), i + 1))).cast("float").cast("double")

    return let(_c(series), lambda s: F.transform(s, lambda x, i: mean(s, i)))


def windows(series, size: int) -> Column:
    return let(_c(series), lambda s: F.transform(_indices(F.size(s) - (size - 1)), lambda i: F.slice(s, i, size)))


def round_half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def clean_probabilities(series, nodata: float = -9999.0) -> Column:
    """Forward fill (leading holes 0; nulls and NaN are nodata), trailing mean of 3, running maximum, whole percent."""
    s = F.transform(_c(series), lambda x: F.coalesce(F.nanvl(x.cast("double"), F.lit(nodata)), F.lit(nodata)))
    smooth = trailing_average(fill_forward(s, nodata, 0.0), 3)
    return F.transform(running(smooth, F.array_max), lambda x: round_half_up(x * 100).cast("int"))


def first_index(series, test: Callable[[Column], Column]) -> Column:
    """Index from 0 of the first value that passes; null if none does."""
    at = F.transform(_c(series), lambda x, i: F.when(test(x), i))
    return F.array_min(at)


def first_hit(series, threshold) -> Column:
    return first_index(series, lambda x: x >= threshold)


def positions(series, test: Callable[[Column], Column]) -> Column:
    return F.filter(F.transform(_c(series), lambda x, i: F.when(test(x), i)), lambda i: i.isNotNull())


def replace_value(series, value, new) -> Column:
    """Replaces ``value`` (None: nulls)."""
    return F.transform(_c(series), lambda x: F.when(x.isNull() if value is None else x == F.lit(value), F.lit(new)).otherwise(x))


def nulls_to_nodata(series, nodata: float = -9999.0) -> Column:
    return replace_value(series, None, nodata)


def scale(series, factor) -> Column:
    return F.transform(_c(series), lambda x: x * factor)


def multiply(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x * y)


def dot(a, b) -> Column:
    return F.aggregate(multiply(a, b), F.lit(0.0), lambda s, x: s + x)


def weighted_mean(values, weights) -> Column:
    return dot(values, weights) / total(weights)


def unweave(series) -> Column:
    """Values at even and at odd indices."""
    s = _c(series)
    return F.struct(F.filter(s, lambda x, i: i % 2 == 0).alias("even"), F.filter(s, lambda x, i: i % 2 == 1).alias("odd"))


def trim(start, series, bottom, top) -> Column:
    """Values of periods bottom .. top - 1."""
    s, at = _c(series), _c(start)
    lo, hi = F.greatest(_c(bottom), at), F.least(_c(top), at + F.size(s))
    return F.slice(s, F.greatest(lo - at + 1, F.lit(1)), F.greatest(hi - lo, F.lit(0)))


def align(*pairs) -> Column:
    """(start, series) pairs cut to their common periods: ``struct<start, s0, s1, ...>``; empty where they share none."""
    starts, series = [_c(p[0]) for p in pairs], [_c(p[1]) for p in pairs]
    low = F.greatest(*starts) if len(starts) > 1 else starts[0]
    ends = [a + F.size(s) for a, s in zip(starts, series, strict=True)]
    high = F.least(*ends) if len(ends) > 1 else ends[0]
    n = F.greatest(high - low, F.lit(0))
    return F.struct(low.alias("start"), *[F.when(n > 0, F.slice(s, low - a + 1, n)).otherwise(F.slice(s, 1, 0)).alias(f"s{k}") for k, (a, s) in enumerate(zip(starts, series, strict=True))])


def expand_sparse(entries, start, length, fill) -> Column:
    """An array of (idx, value) structs as a dense series of ``length`` from ``start``; indices are distinct, and those
    outside do not count."""
    m = F.map_from_entries(F.filter(_c(entries), lambda e: (e["idx"] >= start) & (e["idx"] < start + length)))
    return let(m, lambda held: F.transform(F.sequence(_lit(start), _lit(start) + _lit(length) - 1), lambda p: F.coalesce(F.try_element_at(held, p), F.lit(fill))))


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def pad_with_last(series, size) -> Column:
    s = _c(series)
    return F.concat(s, F.array_repeat(F.element_at(s, -1), F.greatest(_lit(size) - F.size(s), F.lit(0))))


def prefixes(series, first, last) -> Column:
    """Prefixes of lengths first .. last, padded with the last value."""
    return let(_c(series), lambda s: F.transform(F.sequence(_lit(first), _lit(last)), lambda n: pad_with_last(F.slice(s, 1, F.least(n, F.size(s))), n)))


def mask(flags, series, test: Callable[[Column], Column]) -> Column:
    """``series`` with nulls where the flag passes ``test``."""
    return F.zip_with(_c(flags), _c(series), lambda q, x: F.when(~test(q), x))


def reliable_share(flags, good: list) -> Column:
    return (F.size(F.filter(_c(flags), lambda q: q.isin(good))) / F.size(_c(flags))).cast("float")


def is_constant(series) -> Column:
    return F.size(F.array_distinct(_c(series))) == 1


def all_unique(series) -> Column:
    return F.size(F.array_distinct(_c(series))) == F.size(_c(series))


def has_nulls(series) -> Column:
    return F.exists(_c(series), lambda x: x.isNull())


def all_nulls(series) -> Column:
    return F.forall(_c(series), lambda x: x.isNull())


def all_equal(series, value) -> Column:
    return F.forall(_c(series), lambda x: x == F.lit(value))


def rest(series) -> Column:
    s = _c(series)
    return F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0)))


def revolve(series) -> Column:
    """All rotations."""
    return let(_c(series), lambda s: F.transform(s, lambda x, i: F.concat(F.slice(s, i + 1, F.size(s)), F.slice(s, 1, i))))


def outer_product(a, b) -> Column:
    return F.flatten(F.transform(_c(a), lambda x: F.transform(_c(b), lambda y: x * y)))


def insert_at(series, at: int, new) -> Column:
    s = _c(series)
    return F.concat(F.slice(s, 1, at), _c(new), F.slice(s, at + 1, F.size(s)))


def insert_into(value, at: int, size: int, new) -> Column:
    """``new`` inside ``size`` copies of ``value``, from index ``at`` on."""
    n = _c(new)
    return F.concat(F.array_repeat(F.lit(value), at), n, F.array_repeat(F.lit(value), F.lit(size - at) - F.size(n)))


def by_key(mapping) -> Column:
    """Values of a map in the order of its keys."""
    m = _c(mapping)
    return F.transform(F.array_sort(F.map_keys(m)), lambda k: m[k])


def pg_array(series) -> Column:
    """A series as a quoted PostgreSQL array."""
    return F.concat(F.lit('"{'), F.array_join(F.transform(_c(series), lambda x: x.cast("string")), ","), F.lit('}"'))


def from_pg_array(text, kind: str = "int") -> Column:
    return F.split(F.regexp_replace(_c(text), r'["{}]', ""), ",").cast(f"array<{kind}>")


def row_col(idx, rows: int, cols: int) -> Column:
    """Row and column of a row-major index; null outside the grid."""
    i = _c(idx)
    return F.when((i >= 0) & (i < rows * cols), F.struct(F.floor(i / cols).cast("int").alias("row"), (i % cols).cast("int").alias("col")))


def row_col_index(rows: int, cols: int, row, col) -> Column:
    at = _c(col) + _c(row) * cols
    return F.when((at >= 0) & (at < rows * cols), at)


def stretch(start, series, from_res: str, to_res: str, aligned: bool = False) -> Column:
    """A series at a finer or coarser resolution: ``struct<start, series>``.

    Values stand for all days of their period; each new period takes the mean of its own number of days, rounded to
    32 bits, until days run out. Days before the first value of a first period that begins earlier are taken from the
    following ones, as many again (``aligned``: they are left out instead, so that days keep their dates).
    """
    from . import periods as P

    s, at = _c(series), _c(start)
    days = F.flatten(F.transform(s, lambda x, i: F.array_repeat(x.cast("double"), P.period_span(at + i, from_res))))
    first = P.shift_resolution(at, from_res, to_res)
    end = P.shift_resolution(at + F.size(s), from_res, to_res)
    offset = P.date_offset(to_res, first, from_res, at)

    def mean(days: Column, p: Column) -> Column:
        begun = F.datediff(P.period_start(p, to_res), P.period_start(first, to_res))
        span = P.period_span(p, to_res)
        if aligned:
            lo, hi = F.greatest(begun - offset, F.lit(0)), F.least(begun - offset + span, F.size(days))
        else:
            lo, hi = begun + offset, F.least(begun + offset + span, F.size(days))
        return F.when(hi > lo, average(F.slice(days, lo + 1, F.greatest(hi - lo, F.lit(0)))).cast("float").cast("double"))

    new = F.when(end > first, F.sequence(first, end - 1)).otherwise(F.array().cast("array<int>"))
    means = let(days, lambda held: F.transform(new, lambda p: mean(held, p)))
    return F.struct(first.alias("start"), F.filter(means, lambda x: x.isNotNull()).alias("series"))


def maps_overlap(a, b) -> Column:
    """Whether two maps share a key."""
    return F.arrays_overlap(F.map_keys(_c(a)), F.map_keys(_c(b)))


def merge_maps(a, b) -> Column:
    """Both maps' entries; a shared key raises."""
    shared = F.coalesce(maps_overlap(a, b), F.lit(False))
    checked = F.when(shared, F.raise_error(F.lit("maps share a key")).cast("boolean")).otherwise(F.lit(True))
    return F.when(checked, F.map_concat(_c(a), F.map_filter(_c(b), lambda k, v: ~F.array_contains(F.map_keys(_c(a)), k))))


def trim_fires(start, fires, est_start: int, est_end: int) -> Column:
    """Fire values of periods est_start .. est_end; a fire series that begins later raises."""
    late = F.raise_error(F.lit("fires begin after the estimation")).cast("int")
    at = F.when(_c(start) <= est_start, _c(start)).otherwise(late)
    return trim(at, fires, F.lit(est_start), F.lit(est_end + 1))
