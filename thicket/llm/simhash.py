"""SimHash near-duplicates: bit-sliced comparison inside exact candidate groups, then connected components.

Fingerprints within ``radius`` bits agree in one of ``radius + 1`` groups of bits, so each fingerprint is
compared only where such a group is equal. A set of equal bits that too many fingerprints share is split by the
same argument on the remaining bits, which loses no pair and ends by itself: fingerprints are distinct, so few
remain once few bits do. Inside a set, fingerprints are stored as bit planes; 64 distances are counted at a time
with carry-save counters, and words of 64 are abandoned once all their distances exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
SEED = 42


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of a UTF-8 text: A-Z lowered, words split at ASCII white space, a bit set where over
    half of the shingles' XXH64 (repeats included) have it set."""
    words = text.lower().split() if text else []  # bytes: lowers A-Z only, splits at 0x20 and 0x09-0x0D only
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    elif shingle == 3:
        hashes = [xxhash.xxh64_intdigest(b"%b %b %b" % t, SEED) for t in zip(words, words[1:], words[2:])]
    else:
        hashes = [xxhash.xxh64_intdigest(b" ".join(t), SEED) for t in zip(*(words[k:] for k in range(shingle)))]
    return set_fingerprint(np.array(hashes, dtype="<u8"))


def set_fingerprint(hashes: np.ndarray) -> int:
    """Signed 64-bit SimHash of 64-bit hashes: a bit set where over half of them have it set; 0 for none."""
    n, counts = len(hashes), np.zeros(64, dtype=np.int64)
    for lo in range(0, n, 16384):
        counts += np.unpackbits(hashes[lo : lo + 16384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"].astype("Int64"), "fp": np.array([fingerprint(None if t is None else bytes(t), shingle) for t in batch["text"]], dtype=np.int64)})

    return run


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 rows, one a bit; word w of a row holds that bit of fingerprints 64 w .. 64 w + 63."""
    n = -(-len(fps) // 64) * 64
    bits = np.zeros((n, 64), dtype=np.uint8)
    bits[: len(fps)] = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _distances_within(planes: np.ndarray, fps: np.ndarray, query: np.ndarray, word: np.ndarray, valid: np.ndarray, radius: int, stride: int = 8):
    """For pairs of a query and a word of 64 fingerprints: the pairs that have any within ``radius``, and which.

    The counters of a word hold its 64 distances in binary, one word a digit; a carry out of the last is kept.
    """
    digits = [np.zeros(len(query), dtype=np.uint64) for _ in range(max(1, radius.bit_length()))]
    over = ~valid
    for b in range(64):
        carry = planes[b][word] ^ (np.uint64(0) - ((fps[query] >> np.uint64(b)) & np.uint64(1)))
        for k, digit in enumerate(digits):
            digits[k], carry = digit ^ carry, digit & carry
        over |= carry
        if b % stride == stride - 1:
            alive = over != ONES
            if alive.mean() < 0.75:
                query, word, over, digits = query[alive], word[alive], over[alive], [d[alive] for d in digits]
                if not len(query):
                    break
    above, equal = np.zeros_like(over), np.full_like(over, ONES)
    for k in range(len(digits) - 1, -1, -1):
        bit = ONES if radius >> k & 1 else np.uint64(0)
        above |= equal & digits[k] & ~bit
        equal &= ~(digits[k] ^ bit)
    near = ~(over | above)
    hit = near != 0
    return query[hit], word[hit], near[hit]


def close_pairs(fps: np.ndarray, starts: np.ndarray, ends: np.ndarray, radius: int, chunk: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i < j of the same group (``starts[i] <= j < ends[i]``, groups lie together) at most ``radius`` bits apart."""
    planes, fps = bit_planes(fps), fps.astype(np.uint64)
    at = np.arange(len(fps))
    first, last = (at + 1) // 64, (ends - 1) // 64
    n_words = np.where(at + 1 < ends, last - first + 1, 0)
    upto = np.cumsum(n_words)
    lo = 0
    while lo < len(fps):
        base = upto[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, base + chunk, "right")))
        n = n_words[lo:hi]
        query = np.repeat(at[lo:hi], n)
        word = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[lo:hi], n)
        if len(query):
            low = np.clip(query + 1 - 64 * word, 0, 63).astype(np.uint64)
            high = np.clip(64 * (word + 1) - ends[query], 0, 63).astype(np.uint64)
            valid = (ONES << low) & (ONES >> high)
            query, word, near = _distances_within(planes, fps, query, word, valid, radius)
            if len(query):
                w, bit = np.nonzero(np.unpackbits(near.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                yield query[w], 64 * word[w] + bit
        lo = hi


def hook(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (each position's smallest known companion) after joining i with j."""
    while True:
        a, b = labels[i], labels[j]
        differ = a != b
        if not differ.any():
            return labels
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels = jumped


def _links(radius: int):
    """For mapInPandas over rows sorted by (mask, part): a spanning forest of the links inside each group."""

    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        fp, mask, part = (rows[c].to_numpy() for c in ("fp", "mask", "part"))
        new = np.concatenate([[True], (mask[1:] != mask[:-1]) | (part[1:] != part[:-1])])
        begin = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        ends = np.concatenate([begin[1:], [len(fp)]])[group]
        labels = np.arange(len(fp))
        for i, j in close_pairs(fp, begin[group], ends, radius):
            labels = hook(labels, i, j)
        child = np.flatnonzero(labels != np.arange(len(fp)))
        return pd.DataFrame({"a": fp[child], "b": fp[labels[child]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # rows of a group that may go on
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            same = (batch["mask"] == batch["mask"].iloc[-1]) & (batch["part"] == batch["part"].iloc[-1])
            if same.all():
                continue
            cut = int(np.flatnonzero(~same.to_numpy())[-1]) + 1
            held[-1] = batch.iloc[:cut]
            yield linked(pd.concat(held, ignore_index=True))
            held = [batch.iloc[cut:]]
        if held:
            yield linked(pd.concat(held, ignore_index=True))

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _finer(mask: int, groups: int) -> list[int]:
    """``mask`` joined with each of ``groups`` near equal parts of the bits outside it."""
    rest = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(rest) * k // groups for k in range(groups + 1)]
    return [mask | sum(1 << b for b in rest[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def link(fps: DataFrame, radius: int = 3, most: int = 32768) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) that leave the same components as all pairs
    within ``radius``. Sets of more than ``most`` are split by further bits."""
    spark, found, masks, rows = fps.sparkSession, None, _finer(0, radius + 1), fps.select("fp")
    rows = rows.withColumn("mask", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])))
    while True:
        rows = rows.withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
        large = materialize(rows.groupBy("mask", "part").count().where(F.col("count") > most).select("mask", "part"), "simhash-large")
        split = bool(large.take(1))
        few = rows.join(large, ["mask", "part"], "left_anti") if split else rows
        near = few.repartition("mask", "part").sortWithinPartitions("mask", "part", "fp").mapInPandas(_links(radius), "a long, b long")
        found = near if found is None else found.unionByName(near)
        if not split:
            return found
        masks = [r["mask"] & int(ONES) for r in large.select("mask").distinct().collect()]  # at most (radius + 1) ** level
        children = spark.createDataFrame([(_signed(m), _signed(c)) for m in masks for c in _finer(m, radius + 1)], "mask long, child long")
        rows = rows.join(large, ["mask", "part"], "left_semi").join(children, "mask")
        rows = materialize(rows.select("fp", F.col("child").alias("mask")), "simhash-split")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links`` (a, b) but the roots; a root is its component's smallest node.

    Alternates large-star and small-star steps until nothing changes. A step is a minimum by node and a join
    on the node, so the neighbours of a node are never gathered; each round is written to the shared folder.
    """

    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        around = both(e) if large else e
        least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        met = around.join(least, "a")
        if large:
            return met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))

    def tidy(e: DataFrame) -> DataFrame:
        return e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    edges = materialize(tidy(links), "links")
    before = state(edges)
    while before[0]:
        edges = materialize(tidy(star(tidy(star(edges, True)), False)), "stars")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, most: int = 32768) -> DataFrame:
    """A row for each row of ``df``: ``key, fp`` (signed long) and ``component``, the smallest key reachable over links
    of at most ``radius`` differing bits.

    Equal fingerprints are one node, however many rows have them. Null and wordless texts have fingerprint 0 and
    link like any other. Null keys never are the smallest (a component of null keys has none); repeated rows stay;
    other columns are ignored; an empty table gives no rows.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))
    docs = materialize(rows.mapInPandas(_fingerprints(shingle), "key long, fp long"), "simhash")
    fps = materialize(docs.groupBy("fp").agg(F.min("key").alias("least")), "simhash-distinct")
    roots = components(link(fps, radius, most))
    placed = fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component"))
    nodes = materialize(placed.join(smallest, "root").select("fp", "component"), "simhash-components")
    return docs.join(nodes, "fp").select("key", "fp", "component")


def op9(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and the components that links of at most 3 bits make of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = near_duplicates(docs)
    return out.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
