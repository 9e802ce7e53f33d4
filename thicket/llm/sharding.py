"""Histogram sort: exact byte counts below probe keys, refined until splitters balance, then one exchange.

Rows are ordered by (hash of the text, id, row), so equal texts lie next to each other. A first pass writes a
table of keys only (two longs and a size a row). Each round then counts rows and bytes between all probes,
without moving rows, and narrows the interval of every splitter that is still further from its target than
the tolerance. The rows move once, by the splitters found.

Only rows that are alike in text and id need the third key. Where so many are that a splitter falls among them, the
rows are written with a number each (which must not change between passes) and split by it, too.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_name, materialize

LOW, HIGH = -(1 << 63), (1 << 63) - 1
SPAN = 1 << 64


KEYS = 3


def _join(*key: int) -> int:
    """Signed longs as one position on the line of keys."""
    at = 0
    for k in key:
        at = at * SPAN + (k - LOW)
    return at


def _split(at: int) -> tuple[int, ...]:
    return tuple(at // SPAN ** (KEYS - 1 - k) % SPAN + LOW for k in range(KEYS))


def _at_most(probes: list[tuple[int, ...]], keys: list[Column]) -> Column:
    """How many probes (ascending tuples) are <= the keys: a binary search that walks constant arrays."""
    if not probes:
        return F.lit(0)
    n = len(probes)
    arrays = [F.from_json(F.lit(str([p[k] for p in probes])), "array<bigint>") for k in range(len(keys))]
    steps = F.array(*[F.lit(1 << s) for s in range(n.bit_length() - 1, -1, -1)])

    def walk(at: Column, step: Column) -> Column:
        to = F.least(at + step, F.lit(n))
        below = F.lit(True)
        for array, key in zip(reversed(arrays), reversed(keys), strict=True):
            probe = F.element_at(array, to)
            below = (probe < key) | ((probe == key) & below)
        return F.when((at + step <= n) & below, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), walk)


def splitters(keys: DataFrame, n_parts: int, tolerance: float, probes_each: int) -> tuple[list[tuple[int, ...]], list[int], bool]:
    """Splitters of ``keys`` (h, i, r, size) into ``n_parts`` ranges of near equal bytes.

    Returns the keys at which parts 1.. begin, the exact row counts below them, and whether a splitter missed its target
    because more than one row has the key it fell on.
    A splitter is final when the bytes below it miss its target by at most ``tolerance`` of a part, or when no
    row lies between the two nearest boundaries; then the nearer boundary is taken. What comes to the driver
    is a row for each gap between probes: at most ``n_parts * (probes_each + 1)``, whatever the input.
    """
    head = keys.agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")).first()
    total, n_rows = head["b"] or 0, head["n"]
    if not n_rows:
        return [], [], False
    share, alike = total / n_parts, False
    first, end = _join(head["lo"], LOW, LOW), _join(head["hi"], HIGH, HIGH) + 1
    below = {first: (0, 0), end: (total, n_rows)}  # key -> exact bytes and rows before it
    gaps = {k: (first, end) for k in range(1, n_parts)}
    done: dict[int, int] = {}
    while gaps:
        wanted: set[int] = set()
        for lo, hi in set(gaps.values()):
            step = max(1, (hi - lo) // (probes_each + 1))
            wanted.update(lo + step * j for j in range(1, probes_each + 1) if lo + step * j < hi)
        probes = sorted(wanted | {x for g in gaps.values() for x in g})
        bin_of = _at_most([_split(min(p, _join(HIGH, HIGH, HIGH))) for p in probes], [F.col(x) for x in "hir"])
        seen = (
            keys.groupBy(bin_of.alias("bin"))
            .agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"), *[f(x).alias(f"{x}{k}") for x in "hir" for k, f in enumerate((F.min, F.max))])
            .collect()
        )
        bins = {r["bin"]: r for r in seen}
        bytes_, rows = 0, 0
        edges: list[tuple[int, int]] = []  # boundaries, and the bytes before each
        tight: dict[int, tuple[int, int]] = {}  # first key of a gap -> where its rows really lie
        for k in range(len(probes) + 1):
            if k:
                below[probes[k - 1]] = (bytes_, rows)
                edges.append((probes[k - 1], bytes_))
            if k in bins:
                r = bins[k]
                bytes_, rows = bytes_ + r["b"], rows + r["n"]
                low, high, one = [], [], True  # a later key bounds the rows where those before it are single
                for x in "hir":
                    low.append(r[f"{x}0"] if one else LOW)
                    high.append(r[f"{x}1"] if one else HIGH)
                    one = one and low[-1] == high[-1]
                lo, hi = _join(*low), _join(*high) + 1
                if k:
                    tight[probes[k - 1]] = (max(lo, probes[k - 1]), hi)
        totals = [b for _, b in edges]
        for k in list(gaps):
            target = share * k
            at = bisect_left(totals, target)
            near = [edges[j] for j in (at - 1, at) if 0 <= j < len(edges)]
            best, has = min(near, key=lambda e: abs(e[1] - target))
            if abs(has - target) <= tolerance * share:
                done[k] = best
                del gaps[k]
                continue
            left = edges[max(0, at - 1)][0]
            lo, hi = tight.get(left, (left, left))
            below.setdefault(lo, below[left])
            if hi not in below:
                nxt = next((e for e in edges if e[0] >= hi), (end, total))
                below[hi] = below[nxt[0]]
            if hi - lo <= 1:  # one key: nothing to refine
                done[k] = min((lo, hi), key=lambda x: abs(below[x][0] - target))
                alike |= below[hi][1] - below[lo][1] > 1
                del gaps[k]
            else:
                gaps[k] = (lo, hi)
    cut = [min(done[k], _join(HIGH, HIGH, HIGH)) for k in range(1, n_parts)]
    for j in range(1, len(cut)):
        cut[j] = max(cut[j], cut[j - 1])
    return [_split(c) for c in cut], [below[c][1] if c in below else n_rows for c in cut], alike


def shard_by_bytes(
    df: DataFrame,
    text: str = "text",
    order: str = "doc_id",
    n_shards: int = 40,
    row_overhead: int = 16,
    tolerance: float = 0.005,
    probes_each: int = 63,
    bucket_bytes: int = 8 << 20,
    most_buckets: int = 16384,
) -> DataFrame:
    """All rows of ``df`` with ``shard`` (0 .. n_shards - 1), ``slot`` (gapless from 0 in a shard) and ``row_bytes``.

    Size of a row: UTF-8 bytes of its text plus ``row_overhead``. Shards are ranges of one order, cut so that
    their sizes miss the mean by at most ``tolerance`` where rows are small enough (else by half a row or so).
    Each shard is cut again into buckets of about ``bucket_bytes`` (larger ones where that would make more than
    ``most_buckets``), so that the exchange has more tasks than shards and slots are numbered without bringing a
    shard into one task: a bucket's first slot is the exact count below its splitter. A text with a third of all rows is cut by ``order`` like any other range.

    A null text has only the overhead and counts as equal to other nulls; a null ``order`` sorts first; rows that
    are alike in both keys keep separate slots in any order and are split like others; an empty table gives no rows.
    Columns of ``df`` stay; a clash with an added name gets an underscore.
    """
    names = {x: free_name(df, x) for x in ("shard", "slot", "row_bytes", "h__", "i__", "r__", "bucket__")}
    three = [names[x] for x in ("h__", "i__", "r__")]
    keyed = df.withColumns({
        names["h__"]: F.xxhash64(F.col(text)),
        names["i__"]: F.coalesce(F.col(order).cast("long"), F.lit(LOW)),
        names["row_bytes"]: F.coalesce(F.octet_length(text).cast("long"), F.lit(0)) + row_overhead,
    })
    found, before, alike, cuts = [], [], True, 1
    for row in (F.lit(0).cast("long"), F.monotonically_increasing_id()):
        numbered = keyed.withColumn(names["r__"], row)
        if found:
            numbered = materialize(numbered, "shard-rows")
        keys = materialize(numbered.select(*[F.col(x).alias(k) for x, k in zip(three, "hir", strict=True)], F.col(names["row_bytes"]).alias("size")), "shard-keys")
        total = keys.agg(F.sum("size")).first()[0] or 0
        cuts = max(1, min(-(-total // (n_shards * bucket_bytes)), most_buckets // n_shards))
        each = max(3, min(probes_each, (1 << 17) // (n_shards * cuts)))  # probes travel in the plan, their counts to the driver
        found, before, alike = splitters(keys, n_shards * cuts, tolerance, each)
        if not alike:
            break
    starts = [0, *before]  # exact rows before each bucket
    base = [starts[k - k % cuts] for k in range(len(starts))]
    first_slot = F.from_json(F.lit(str([s - b for s, b in zip(starts, base, strict=True)])), "array<bigint>")
    placed = numbered.withColumn(names["bucket__"], _at_most(found, [F.col(x) for x in three]))
    placed = placed.repartitionById(len(starts), F.col(names["bucket__"]))  # the exchange: a task for each bucket
    in_bucket = Window.partitionBy(names["bucket__"]).orderBy(*three)
    return placed.withColumns({
        names["shard"]: F.floor(F.col(names["bucket__"]) / cuts).cast("int"),
        names["slot"]: F.element_at(first_slot, F.col(names["bucket__"]) + 1) + F.row_number().over(in_bucket) - 1,
    }).drop(*three, names["bucket__"])


def op8(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in 40 shards of near equal bytes. A null text has 16 bytes and the checksum of an empty one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = shard_by_bytes(docs)
    return out.select(
        "doc_id",
        F.col("row_bytes").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
