"""Mixing sources to target weights, in fixed-length blocks of words.

The documents of a source, in a pseudorandom order, form one stream of words that is cut into blocks: of one length for
all sources that fill 64 of them, and shorter ones, 64 or so, where a source is small, as a target is met to a block. Every
output shard draws multinomial counts of blocks by source, weighted by what the sources owe to their
targets: what the sources owe to a range of shards is drawn for its first half, the rest falls to the second,
down to a single shard. A draw is seeded by its range, so the task that makes a shard's slots finds the shard's counts
by itself. The draws of a source number its slots, and a slot is mapped to a block by a pseudorandom permutation
of the source's block indices, another one each time the indices are used up. Slots and blocks meet in a join
by block index.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_name, materialize

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[float], total: float, most: float = 3.0) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; the excess goes to the others by weight."""
    out, capped = [0.0] * len(sizes), [False] * len(sizes)
    while True:
        left = total - sum(x for x, c in zip(out, capped, strict=True) if c)
        weight = sum(w for w, c in zip(weights, capped, strict=True) if not c)
        over = False
        for k, (size, w) in enumerate(zip(sizes, weights, strict=True)):
            if not capped[k]:
                out[k] = left * w / weight if weight else 0.0
                over |= out[k] > most * size
        if not over:
            return out
        for k, size in enumerate(sizes):
            if not capped[k] and out[k] > most * size:
                out[k], capped[k] = most * float(size), True


def draw(owed: np.ndarray, need: int, key: tuple[int, ...]) -> np.ndarray:
    """``need`` blocks by source: multinomial, with chances in proportion to what is owed. A draw beyond what is
    owed is drawn again among the others."""
    rng = np.random.Generator(np.random.PCG64(key))
    got, need = np.zeros_like(owed), min(need, int(owed.sum()))
    while need:
        rest = owed - got
        more = np.minimum(rng.multinomial(need, rest / rest.sum()), rest)
        got += more
        need -= int(more.sum())
    return got


class ShardCounts:
    """Blocks by source of every output shard, found shard by shard; sums over shards are what is owed."""

    def __init__(self, owed: np.ndarray, shard_blocks: int, seed: int):
        self.owed, self.shard_blocks, self.seed = np.asarray(owed, dtype=np.int64), shard_blocks, seed
        self.shards = -(-int(self.owed.sum()) // shard_blocks)
        self.path: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # ranges around the last shard: first, end, blocks before, blocks in

    def of(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """Blocks by source before the shard, and in it."""
        while self.path and not self.path[-1][0] <= shard < self.path[-1][1]:
            self.path.pop()
        if not self.path:
            self.path.append((0, self.shards, np.zeros_like(self.owed), self.owed))
        while True:
            lo, hi, before, inside = self.path[-1]
            if hi - lo == 1:
                return before, inside
            mid = (lo + hi) // 2
            left = draw(inside, (mid - lo) * self.shard_blocks, (self.seed, lo, hi))
            self.path.append((lo, mid, before, left) if shard < mid else (mid, hi, before + left, inside - left))


def _mixed(x: np.ndarray, key: np.ndarray) -> np.ndarray:
    x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0 .. n-1 for each key: a four-round Feistel network over the next even
    number of bits, walked until the result is below n. Elementwise over equal-length arrays."""
    n, key = n.astype(np.uint64), key.astype(np.uint64)
    half = np.maximum(np.uint64(1), (np.ceil(np.log2(np.maximum(n, 2).astype(float)) / 2)).astype(np.uint64))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64).copy(), np.arange(len(index))
    while len(todo):
        x, h, m, k = out[todo], half[todo], mask[todo], key[todo]
        left, right = x >> h, x & m
        for turn in range(4):
            left, right = right, left ^ (_mixed(right + np.uint64(turn << 56), k) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def _slots(owed: np.ndarray, blocks: np.ndarray, shard_blocks: int, seed: int):
    """For mapInPandas over output shards: source, block, epoch and shard of each slot."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = ShardCounts(owed, shard_blocks, seed)
        for batch in batches:
            for s in batch["id"].tolist():
                before, inside = counts.of(s)
                source = np.repeat(np.arange(len(owed)), inside)
                own = np.arange(len(source)) - np.repeat(np.cumsum(inside) - inside, inside) + before[source]
                n = blocks[source]
                epoch = own // n
                key = _mixed(((source.astype(np.uint64) << np.uint64(32)) | epoch.astype(np.uint64)), np.full(len(source), seed, dtype=np.uint64))
                yield pd.DataFrame({"source_no": source.astype(np.int32), "block": permute(own % n, n, key), "epoch": epoch.astype(np.int32), "shard": np.full(len(source), s)})

    return run


def measure(df: DataFrame, text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


class Mix:
    """What ``mix`` returns: ``documents`` (one row a document), ``pieces`` (document spans by block), ``slots`` (the
    blocks of the mix, by output shard) and ``sources`` (names, numbers, sizes, targets)."""

    def __init__(self, documents: DataFrame, pieces: DataFrame, slots: DataFrame, sources: DataFrame):
        self.documents, self.pieces, self.slots, self.sources = documents, pieces, slots, sources

    def spans(self) -> DataFrame:
        """The mix itself: for each use of a block, the spans of documents in it (doc_row, start, words, shard, epoch)."""
        slots = self.slots.hint("merge")  # the plan knows how many shards there are, not how many slots: never broadcast
        return slots.join(self.pieces, ["source_no", "block"])


def mix(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    most: float = 3.0,
    block_words: int = 128,
    least_blocks: int = 64,
    shard_blocks: int = 4096,
    rows_each: int = 4096,
    seed: int = 20240229,
) -> Mix:
    """Mixes all rows of ``df``; the total is 100 % of all words.

    Sources in order of code points, null last, get ``weights`` in turn. A block is of ``block_words``, or of fewer in a source
    that would not fill ``least_blocks`` of them, so that it is no more than about a sixty-fourth of its source. Every block of a source is used as
    often as any other or once more, so no document is taken more than ``most`` times. A null text has no
    words; a source without words has target 0; rows that repeat are documents of their own; an empty table gives empty
    results. One row a source comes to the driver and goes to the tasks (a mix names its sources); the counts by shard
    are drawn in the tasks. Rows alike in key, text and source are one row with a count until they have their
    places. Prefix sums over a source run in buckets of about ``rows_each`` of those, so neither a source with a third of
    all rows nor a row that often repeated meets in one task.
    """
    spark = df.sparkSession
    base = df.select(F.col(key).alias("doc"), F.col(source).alias("source"), measure(df, text).alias("size"), F.xxhash64(F.col(text)).alias("h2"))
    sized = materialize(base.groupBy("doc", "source", "size", "h2").agg(F.count(F.lit(1)).alias("alike")), "mix-sizes")
    found = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("alike")).alias("size"), F.count(F.lit(1)).alias("n")).collect()
    found = sorted(found, key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    sizes = [int(r["size"]) for r in found]
    total = sum(sizes)
    aims = targets(sizes, [weights[k % len(weights)] for k in range(len(found))], float(total), most)
    lengths = [min(block_words, max(1, s // least_blocks)) for s in sizes]
    blocks = np.array([max(1, -(-s // n)) for s, n in zip(sizes, lengths, strict=True)] or [1], dtype=np.int64)
    owed = np.array([min(round(a * b / s), int(most * b)) if s else 0 for a, b, s in zip(aims, blocks.tolist(), sizes, strict=False)], dtype=np.int64)
    names = spark.createDataFrame(
        [(r["source"], k, sizes[k], aims[k], max(1, -(-r["n"] // rows_each)), lengths[k]) for k, r in enumerate(found)],
        "source_name string, source_no int, source_size long, target double, buckets int, block_words int",
    )
    docs = sized.join(names, F.col("source").eqNullSafe(F.col("source_name"))).drop("source_name", "source")
    docs = docs.withColumn("h", F.xxhash64("doc", "h2", F.lit(seed)))
    docs = docs.withColumns({"bucket": F.pmod(F.col("h"), F.col("buckets")).cast("int"), "words": F.col("size") * F.col("alike")})
    per = docs.groupBy("source_no", "bucket").agg(F.sum("words").alias("words"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.withColumn("first", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    inside = Window.partitionBy("source_no", "bucket").orderBy("h", "doc", "h2", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumns({"within": F.coalesce(F.sum("words").over(inside), F.lit(0)), "turn": F.count(F.lit(1)).over(inside)})
    placed = placed.join(offsets, ["source_no", "bucket"]).select("*", F.explode(F.sequence(F.lit(1).cast("long"), "alike")).alias("copy"))
    placed = placed.withColumns({"at": F.col("first") + F.col("within") + (F.col("copy") - 1) * F.col("size"), "doc_row": F.concat_ws("-", "source_no", "bucket", "turn", "copy")})
    documents = materialize(placed.select("doc_row", "doc", "h2", "copy", "size", "source_no", "source_size", "target", "block_words", "at"), "mix-documents")
    length = F.col("block_words")
    first, last = F.floor(F.col("at") / length), F.floor((F.col("at") + F.col("size") - 1) / length)
    pieces = documents.where("size > 0").select("doc_row", "source_no", "at", "size", "block_words", F.explode(F.sequence(first, last)).alias("block"))
    low, high = F.greatest("at", F.col("block") * length), F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * length)
    pieces = pieces.select("source_no", "block", "doc_row", (low - F.col("at")).alias("start"), (high - low).alias("words"))
    n_shards = ShardCounts(owed, shard_blocks, seed).shards
    slots = spark.range(0, n_shards, 1, max(1, min(spark.sparkContext.defaultParallelism * 4, n_shards // 5 + 1))).mapInPandas(_slots(owed, blocks, shard_blocks, seed), "source_no int, block long, epoch int, shard long")
    return Mix(documents, pieces, slots, names)


def taken_words(mixed: Mix) -> DataFrame:
    """``mixed.documents`` with ``taken``: the words the mix takes of each, repeats counted."""
    uses = mixed.spans().groupBy("doc_row").agg(F.sum("words").alias("taken"))
    return mixed.documents.join(uses, "doc_row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _cut(columns: list[str], text: str, taken: str, spans: str):
    """For mapInPandas: each document's text cut to the words in its spans (start, words), runs on lines of their own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for whole, n, some in zip(batch[text], batch[taken], batch[spans], strict=True):
                runs: list[list[int]] = []
                for start, words in sorted((int(x["start"]), int(x["words"])) for x in some):
                    if runs and runs[-1][1] == start:
                        runs[-1][1] += words
                    else:
                        runs.append([start, start + words])
                if runs == [[0, int(n)]]:
                    texts.append(whole)
                    continue
                at = [m.span() for m in _WORD.finditer(whole)]
                texts.append("\n".join(whole[at[a][0] : at[b - 1][1]] for a, b in runs))
            yield batch[columns].assign(**{text: texts})

    return run


def mix_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix as documents: a row of ``df``'s columns for each document and use, with the words taken in that use.

    A document whose blocks are used twice comes twice; one that is used in part comes with that part of its text.
    Rows that repeat a key, a text and a source are told apart by number. Documents without words are not in a mix.
    """
    mixed = mix(df, key, text, source, **options)
    uses = mixed.spans().groupBy("doc_row", "epoch").agg(F.collect_list(F.struct("start", "words")).alias("spans"))
    rows = mixed.documents.where("size > 0").select("doc", "h2", "source_no", "copy", "doc_row", "size")
    sources = mixed.sources.select("source_no", "source_name")
    uses = rows.join(sources, "source_no").join(uses, "doc_row")
    h, copy, size, spans, to_doc, to_h, to_copy, to_source = (free_name(df, f"mix_{x}") for x in ("h", "copy", "size", "spans", "to_doc", "to_h", "to_copy", "to_source"))
    uses = uses.select(F.col("doc").alias(to_doc), F.col("h2").alias(to_h), F.col("source_name").alias(to_source), F.col("copy").alias(to_copy), F.col("size").alias(size), F.col("spans").alias(spans))
    own = df.withColumn(h, F.xxhash64(F.col(text)))
    same = F.col(key).eqNullSafe(F.col(to_doc)) & (F.col(h) == F.col(to_h)) & F.col(source).eqNullSafe(F.col(to_source))
    if mixed.documents.where("copy > 1").take(1):  # only then do rows need numbers, for which texts move once more
        alike = Window.partitionBy(F.col(key), F.col(h), F.col(source)).orderBy(F.xxhash64(*df.columns))
        own = own.withColumn(copy, F.row_number().over(alike))
        same = same & (F.col(copy) == F.col(to_copy))
    return own.join(uses, same).select(*df.columns, size, spans).mapInPandas(_cut(df.columns, text, size, spans), df.schema)


def op6(spark, sf_dir: str) -> DataFrame:
    """Of all ``documents``: size, source and target, and the words the mix takes. Null texts have no words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return taken_words(mix(docs)).select(F.col("doc").alias("doc_id"), "size", F.col("source_size").cast("long").alias("source_size"), "target", "taken")
