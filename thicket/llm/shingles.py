"""Near copies by SimHash of 5-word shingles: bit-sliced comparison inside exact candidate sets, links confirmed.

Two sets of Jaccard similarity 4/5 or more share one of their first ``n - ceil(4 n / 5) + 1`` shingles in any order that
is the same for all sets. So fingerprints are compared only among documents that share such a shingle, and whose set
sizes allow the similarity. The comparison is that of ``simhash``: bit planes, carry-save counters, blocks abandoned
beyond ``RADIUS``. That radius is wide: at similarity 4/5 a bit differs with a chance of about 0.15 (0.19 in the
smallest sets), so that more than 28 of 64 do so in fewer than one pair of a million. What is within the
radius is a link if the whole sets are similar. The order puts shingles last that are of common classes, which keeps sets of
candidates small. Shingles fall into classes by their hashes, and all of all texts are counted by class; what is common
changes the time, never the result.

Texts that share a passage and little else lie within that radius often enough. So a sketch goes with every set, the least
shingle of each of some equal ranges of hashes: two sets agree in as many of them as their similarity says, give or take
little. A pair whose sketches agree in fewer than any similarity of 4/5 leaves likely (five standard deviations) is none.

Edited copies of one text may be thousands, most of them just not similar enough, and their pairs too many to be written
down. So documents are gathered into families first: each is tied to the smallest set, of about the same size, that
shares one of its first shingles, lies within the radius and has a sketch like that of sets of similarity 3/5 (four
standard deviations below), which is less than a pair needs. A family is compared all with all inside tasks, in blocks of bounded size, and only links leave them.
Pairs of different families that share a shingle of both prefixes, and whose sketches allow it, join their families; what
leaves a task is which families are joined, at most a row for each that it has, and not the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_name, materialize
from .simhash import SEED, close_pairs, components, hook, set_fingerprint

WORDS = 5
RADIUS = 28
COMMON, SHARE = 5, 1_000  # a common class has so many more shingles than the median one, and one more for each so many texts
CLASSES, SPAN = 1 << 20, 1 << 12  # classes of shingles, and those whose counts travel together
FIRST = 4  # shingles of a document by which it finds its family: the least hashes, common or not
MOST = 32_768  # rows of a set of candidates that one task compares; larger sets are compared in blocks
BLOCK, LARGEST = 1 << 19, 1 << 22  # shingles of a family's documents in a block: of a small family, and of any
BINS, FINE = 64, 256  # ranges of a sketch: of one that travels, and of one made in a task
PAIRS = 1 << 18  # sketches compared at a time


def shingle_set(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct XXH64 of the shingles, words as in ``simhash.fingerprint``; a shorter text is one shingle."""
    w = text.lower().split() if text else []
    if not w:
        return np.zeros(0, dtype=np.int64)
    shingles = {b" ".join(w)} if len(w) <= words else set(map(b" ".join, zip(*(w[k:] for k in range(words)))))
    return np.unique(np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype=np.uint64).view(np.int64))


def class_of(shingles: np.ndarray) -> np.ndarray:
    return shingles & (CLASSES - 1)


def prefix(shingles: np.ndarray, common: np.ndarray, classes: np.ndarray | None = None) -> np.ndarray:
    """The shingles of which any set of similarity 4/5 or more has one, rare ones first; ``common``, sorted, are classes where
    those of the shingles are given, else shingles."""
    n = len(shingles)
    if len(common):
        names = shingles if classes is None else classes
        at = np.minimum(np.searchsorted(common, names), len(common) - 1)
        shingles = shingles[np.argsort(common[at] == names, kind="stable")]
    return shingles[: n - (4 * n + 4) // 5 + 1] if n else shingles


def sketch(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """A byte for each equal range of hashes, of the least shingle (sorted) there; 0 where there is none."""
    edges = np.linspace(-(2.0**63), 2.0**63, bins + 1)[:-1].astype(np.int64)
    at = np.searchsorted(shingles, edges)
    ends = np.append(at[1:], len(shingles))
    if not len(shingles):
        return np.zeros(bins, dtype=np.uint8)
    least = shingles[np.minimum(at, len(shingles) - 1)].view(np.uint64)
    return np.where(ends > at, least % np.uint64(255) + np.uint64(1), np.uint64(0)).astype(np.uint8)


def agreement(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In how many ranges pairs of sketches agree, and in how many either has a shingle."""
    return ((a == b) & (a > 0)).sum(axis=1), ((a > 0) | (b > 0)).sum(axis=1)


def likely(sketches: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs may have a similarity of 4/5: their share of agreements is less than five standard deviations below."""
    out = np.zeros(len(i), dtype=bool)
    for lo in range(0, len(i), PAIRS):
        same, n = agreement(sketches[i[lo : lo + PAIRS]], sketches[j[lo : lo + PAIRS]])
        out[lo : lo + PAIRS] = same >= 0.8 * n - 2 * np.sqrt(n)
    return out


def _tied(a: str, b: str) -> Column:
    """Whether sketches may be of sets of similarity 3/5: of long texts two of five ranges agree, of short ones fewer."""

    @F.pandas_udf("boolean")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=bool)
        same, n = agreement(*(np.frombuffer(b"".join(map(bytes, z)), dtype=np.uint8).reshape(len(z), -1) for z in (x, y)))
        return pd.Series(same >= 0.6 * n - 1.6 * np.sqrt(n))

    return run(a, b)


def _common(df: DataFrame, text: str) -> np.ndarray:
    """Sorted classes of common shingles, from counts of all shingles of all texts, copies too.

    A task counts into one array and sends it by spans, so what travels does not depend on how many different shingles there
    are. Long texts fill all classes alike, so a class counts by what it has beyond the median of its span.
    """
    least = max(COMMON, df.count() // SHARE)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(CLASSES, dtype=np.int64)
        for batch in batches:
            for t in batch["text"]:
                np.add.at(counts, class_of(shingle_set(None if t is None else bytes(t))), 1)
        spans = counts.reshape(-1, SPAN)
        some = np.flatnonzero(spans.any(axis=1))
        yield pd.DataFrame({"span": some, "counts": [(x.astype(np.uint8) if x.max() < 256 else x).tobytes() for x in spans[some]]})

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for span, counts in zip(batch["span"], batch["counts"], strict=True):
                held = sums.setdefault(span, np.zeros(SPAN, dtype=np.int64))
                held += np.frombuffer(counts, dtype=np.uint8 if len(counts) == SPAN else np.int64)
        for span, counts in sums.items():
            yield pd.DataFrame({"class": span * SPAN + np.flatnonzero(counts >= np.median(counts) + least)})

    parts = df.select(F.col(text).cast("binary").alias("text")).mapInPandas(counted, "span long, counts binary")
    rows = parts.repartition("span").mapInPandas(summed, "class long").toPandas()
    return np.sort(rows["class"].to_numpy(dtype=np.int64))


def _signature(common: np.ndarray):
    @F.pandas_udf("struct<node:long,n:int,fp:long,sketch:binary,heads:array<long>,prefix:array<long>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        nodes, sizes, fps, sketches, heads, prefixes = [], [], [], [], [], []
        for t in texts:
            s = shingle_set(None if t is None else bytes(t))
            nodes.append(xxhash.xxh64_intdigest(s.tobytes(), SEED))
            sizes.append(len(s))
            fps.append(set_fingerprint(s))
            sketches.append(sketch(s).tobytes())
            heads.append(s[:FIRST])
            prefixes.append(prefix(s, common, class_of(s)))
        return pd.DataFrame({"node": np.array(nodes, dtype=np.uint64).view(np.int64), "n": np.array(sizes, dtype=np.int32), "fp": np.array(fps, dtype=np.int64), "sketch": sketches, "heads": heads, "prefix": prefixes})

    return run


def _by_group(work: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame]):
    """For mapInPandas over rows sorted by (shingle, block, n): ``work`` gets whole groups and the group of each row."""

    def changes(rows: pd.DataFrame) -> np.ndarray:
        s, b = rows["shingle"].to_numpy(), rows["block"].to_numpy()
        return np.concatenate([[False], (s[1:] != s[:-1]) | (b[1:] != b[:-1])])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, last = [], None  # rows of the group that may go on, and which it is
        for batch in batches:
            if not len(batch):
                continue
            cuts = np.flatnonzero(changes(batch))
            first, end = (tuple(batch[["shingle", "block"]].iloc[k]) for k in (0, -1))
            if held and first != last:
                cuts = np.concatenate([[0], cuts])
            if len(cuts):
                held.append(batch.iloc[: cuts[-1]])
                rows = pd.concat(held, ignore_index=True)
                if len(rows):
                    yield work(rows, np.cumsum(changes(rows)))
                held = []
            held.append(batch.iloc[cuts[-1] if len(cuts) else 0 :])
            last = end
        if held:
            rows = pd.concat(held, ignore_index=True)
            yield work(rows, np.cumsum(changes(rows)))

    return run


def _apart(rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
    """Families of a group that a pair joins: of documents within the radius, whose sizes, places and sketches allow a
    similarity of 4/5. Each is named once, with the smallest family it is joined to, however many pairs do so."""
    family, n, at = (rows[c].to_numpy(dtype=np.int64) for c in ("family", "n", "at"))
    names, own = np.unique(family, return_inverse=True)
    joined = np.arange(len(names))
    line = (group.astype(np.int64) << 32) + n  # ascending
    ends = np.searchsorted(line, (group.astype(np.int64) << 32) + 5 * n // 4, "right")
    sketches = np.frombuffer(b"".join(map(bytes, rows["sketch"])), dtype=np.uint8).reshape(len(rows), -1)
    for i, j in close_pairs(rows["fp"].to_numpy(dtype=np.int64), np.searchsorted(group, group), ends, RADIUS):
        take = (joined[own[i]] != joined[own[j]]) & (9 * np.minimum(n[i] - at[i], n[j] - at[j]) >= 4 * (n[i] + n[j]))  # both have at most so many from here on
        i, j = i[take], j[take]
        take = likely(sketches, i, j)
        joined = hook(joined, own[i[take]], own[j[take]])
    others = np.flatnonzero(joined != np.arange(len(names)))
    return pd.DataFrame({"a": names[joined[others]], "b": names[others]})


def _inside(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Of two blocks of a family, or one with itself: a spanning forest of the links between them. ``key``: group, i, j.

    Candidates are within the radius and of like sketches; a document's shingles are marked, and the marked ones of each
    candidate counted.
    """
    two = key[1] != key[2]
    rows = rows.sort_values(["n", "node"], ignore_index=True)
    node, n, block = (rows[c].to_numpy(dtype=np.int64) for c in ("node", "n", "block"))
    sets = [shingle_set(None if t is None else bytes(t)) for t in rows["text"]]
    sketches = np.stack([sketch(x, FINE) for x in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    del sets
    ids = np.split(ids, np.cumsum(n)[:-1])
    marked, labels, found = np.zeros(int(n.sum()) + 1, dtype=bool), list(range(len(rows))), []

    def label(k: int) -> int:
        while labels[k] != k:
            labels[k] = labels[labels[k]]
            k = labels[k]
        return k

    ends = np.searchsorted(n, 5 * n // 4, "right")
    for left, right in close_pairs(rows["fp"].to_numpy(dtype=np.int64), np.zeros(len(rows), dtype=np.int64), ends, RADIUS):
        if two:
            across = block[left] != block[right]
            left, right = left[across], right[across]
        fine = likely(sketches, left, right)
        left, right = left[fine], right[fine]
        if not len(left):
            continue
        order = np.argsort(left, kind="stable")
        left, right = left[order], right[order]
        cuts = np.flatnonzero(np.diff(left, prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(left)], strict=True):
            i = int(left[lo])
            marked[ids[i]] = True
            for j in right[lo:hi].tolist():
                if label(i) != label(j):
                    both = int(np.count_nonzero(marked[ids[j]]))
                    if 5 * both >= 4 * (n[i] + n[j] - both):
                        labels[label(j)] = label(i)
                        found.append((node[i], node[j]))
            marked[ids[i]] = False
    return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def _met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For mapInPandas over rows sorted by meeting (group, i, j): the links of blocks of families. Rows are gathered until
    their meeting is whole."""
    names, held, last = ["node", "n", "fp", "text", "block"], [], None
    for batch in batches:
        for row, key in zip(zip(*(batch[c] for c in names), strict=True), zip(*(batch[c].tolist() for c in ("group", "i", "j")), strict=True), strict=True):
            if held and key != last:
                yield _inside(last, pd.DataFrame(held, columns=names))
                held = []
            held.append(row)
            last = key
    if held:
        yield _inside(last, pd.DataFrame(held, columns=names))


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _star_pairs(nodes: DataFrame) -> DataFrame:
    """Each node with the smallest set of about its size that shares one of its first shingles, if within the radius and of
    like sketch.
    Centres are minima, taken before rows move, and joined back, so a shingle that many documents share is met in no
    one task."""
    size = F.ln(F.greatest("n", F.lit(1))) / F.ln(F.lit(1.25))
    bands = F.array(2 * F.floor(size), 2 * F.floor(size + 0.5) + 1)  # two rows of bands, so that no edge parts similar sizes
    heads = nodes.select("node", "n", "fp", "sketch", F.explode("heads").alias("shingle"), bands.alias("bands")).withColumn("band", F.explode("bands")).drop("bands")
    centres = heads.groupBy("shingle", "band").agg(F.min(F.struct("n", "node", "fp", "sketch")).alias("centre"), F.count(F.lit(1)).alias("many")).where("many > 1").drop("many")
    met = heads.join(centres, ["shingle", "band"]).where((F.col("node") != F.col("centre.node")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("centre.fp"))) <= RADIUS))
    return materialize(met.where(_tied("sketch", "centre.sketch")).select(*_pair("node", "centre.node")).distinct(), "near-stars")


def _other_pairs(nodes: DataFrame, families: DataFrame, most: int) -> DataFrame:
    """Families ``a, b`` that pairs join, which share a shingle of both prefixes and lie within the radius; the components are
    those that all such pairs leave."""
    opened = nodes.select("node", "prefix").join(families, "node", "left").select("node", F.coalesce("family", "node").alias("family"), F.explode("prefix").alias("shingle"))
    inside = Window.partitionBy("shingle")
    seen = opened.withColumns({"least": F.min("family").over(inside), "largest": F.max("family").over(inside), "many": F.count(F.lit(1)).over(inside)})
    mixed = materialize(seen.where("least <> largest").select("node", "family", "shingle", "many"), "near-mixed")
    blocks = F.ceil(F.col("many") / most)
    own = F.pmod(F.xxhash64("node"), blocks)
    others = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda k: F.least(k, own) * blocks + F.greatest(k, own))  # a block meets each other one
    dealt = mixed.join(nodes.select("node", "n", "fp", "sketch", "prefix"), "node").select("node", "family", "n", "fp", "sketch", (F.array_position("prefix", F.col("shingle")) - 1).alias("at"), "shingle", F.explode(others).alias("block"))
    return dealt.repartition("shingle", "block").sortWithinPartitions("shingle", "block", "n", "node").mapInPandas(_by_group(_apart), "a long, b long").distinct()


def _families(tied: DataFrame) -> DataFrame:
    """``node, family`` from nodes and roots, roots among them."""
    return tied.select("node", F.col("root").alias("family")).unionByName(tied.select(F.col("root").alias("node"), F.col("root").alias("family")).distinct())


def near_copies(df: DataFrame, key: str = "doc_id", text: str = "text", most: int = MOST, block: int = BLOCK) -> DataFrame:
    """A row for each row of ``df``: ``key, text_hash`` and ``root``, one for all rows reachable over links of similarity
    4/5 or more.

    Equal sets of shingles are one node, however many rows have them. Wordless and null texts are alike and like
    nothing else. Repeated rows stay; null keys are keys like others here; other columns are ignored; an empty table
    gives no rows. Sets of candidates of more than ``most`` rows, and families of more than ``block`` shingles, are
    compared in blocks; a family's blocks grow with the root of its size, to eight times ``block``.
    """
    common = _common(df, text)
    texts = df.select(F.xxhash64(text).alias("text_hash"), F.col(text).cast("binary").alias("text"))
    signed = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), _signature(common)(F.col(text).cast("binary")).alias("sig"))
    rows = materialize(signed.select("key", "text_hash", "sig.*", F.monotonically_increasing_id().alias("rid")), "near-rows")
    first = rows.groupBy("node").agg(F.min("rid").alias("rid")).select("rid")
    nodes = materialize(rows.select("node", "n", "fp", "sketch", "text_hash", "heads", "prefix", "rid").join(first, "rid", "left_semi").drop("rid"), "near-nodes")
    stars = _star_pairs(nodes)
    families = materialize(_families(components(stars)), "near-families")
    pairs = materialize(_other_pairs(nodes, families, most), "near-pairs")
    families = materialize(_families(components(stars.unionByName(pairs))), "near-families")  # so many pairs are compared together
    members = families.join(nodes.select("node", "n"), "node")
    whole = F.sum("n")
    blocks = members.groupBy("family").agg(F.ceil(whole / F.least(F.greatest(F.sqrt(whole * block), F.lit(block)), F.lit(block * (LARGEST // BLOCK)))).alias("blocks"))
    members = members.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    within = members.select("node", "family", "block", each).select("node", F.struct(F.col("family").alias("group"), "block", F.least("other", "block").alias("i"), F.greatest("other", "block").alias("j")).alias("meet"))
    meets = within.groupBy("node").agg(F.collect_list("meet").alias("meets"))
    asked = materialize(nodes.select("node", "n", "fp", "text_hash").join(meets, "node"), "near-asked")
    found = texts.groupBy("text_hash").agg(F.first("text").alias("text")).join(asked, "text_hash")  # copies meet before they move
    dealt = found.select("node", "n", "fp", "text", F.explode("meets").alias("meet")).select("node", "n", "fp", "text", "meet.*")
    links = materialize(dealt.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j").mapInPandas(_met, "a long, b long"), "near-links")
    roots = materialize(components(links), "near-roots")
    return rows.join(roots, "node", "left").select("key", "text_hash", F.coalesce("root", "node").alias("root"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one row of each group of near copies: that of the smallest key, null keys last; ties by the hash of the
    text. Of rows alike in key and text the one with the smallest hash of all columns stays."""
    placed = materialize(near_copies(df, key, text), "near-components")
    counted = placed.groupBy("root", "key", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    least = counted.groupBy("root").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "text_hash", "copies")).alias("at"))
    k, h, c = (free_name(df, x) for x in ("kept_key", "kept_hash", "kept_copies"))
    kept = materialize(least.select(F.col("at.key").alias(k), F.col("at.text_hash").alias(h), F.col("at.copies").alias(c)), "near-kept")

    def chosen(some: DataFrame) -> DataFrame:
        return df.join(some.select(k, h), F.col(key).eqNullSafe(F.col(k)) & (F.xxhash64(text) == F.col(h)), "left_semi")

    repeated = kept.where(F.col(c) > 1)
    if not repeated.take(1):
        return chosen(kept)
    turn = Window.partitionBy(F.col(key), F.xxhash64(text)).orderBy(F.xxhash64(*df.columns))
    one = chosen(repeated).withColumn(c, F.row_number().over(turn)).where(F.col(c) == 1).drop(c)
    return chosen(kept.where(F.col(c) == 1)).unionByName(one)
