"""Cross-tokenizer alignment: groups of tokens of two tokenizers over the same bytes, and their links.

Both token lists cover a text's bytes, so both are intervals. Those of B stand in a static index (starts, ends and how far
ends have reached); each token of A stabs it by bisection and gets the tokens of B that overlap it. A gap between two
tokens of A that no token of B spans is a boundary of groups.

Few tokens of either vocabulary go on from a mark to white space (those that do end with a carriage return), so a text is
cut before all its other white space, and both token lists end at each cut. The different chunks of a batch of texts are
encoded once each and aligned all at once; the numbers of chunks add up to those of their text.

Corpus counts need one exchange. A task deals its documents to blocks of bounded size and passes on, for each block, its
distinct pairs with the number of documents that hold them; what a block needs to know comes back to it as one row a
pair. So a pair that all documents hold travels once a block, not once a document.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .packing import _byte_letters

WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # Unicode's White_Space: fixed values
LONG = 256  # characters of a chunk from which on the tokenizer itself encodes it, in a time about linear
AT_ONCE = 8192  # chunks encoded at a time
BLOCK = 4 << 20  # characters from which on a block is closed
PACK = 1 << 20  # ids of B are below


class IntervalIndex:
    """Static intervals [start, end), sorted by start, whose overlaps with a query are found by bisection.

    ``reach`` is the furthest end so far: all intervals before the first one whose reach exceeds a query's start end
    before it. Where intervals overlap each other, those between are tested one by one.
    """

    def __init__(self, starts: np.ndarray, ends: np.ndarray):
        order = np.argsort(starts, kind="stable")
        self.at, self.starts, self.ends = order, starts[order], ends[order]
        self.reach = np.maximum.accumulate(self.ends) if len(ends) else self.ends

    def overlaps(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, interval) that share a byte."""
        lo = np.searchsorted(self.reach, starts, "right")
        n = np.maximum(np.searchsorted(self.starts, ends, "left") - lo, 0)
        query = np.repeat(np.arange(len(starts)), n)
        found = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        hit = self.ends[found] > starts[query]
        return query[hit], self.at[found[hit]]

    def spans(self, places: np.ndarray) -> np.ndarray:
        """Whether an interval lies on both sides of each place."""
        lo = np.searchsorted(self.reach, places, "right")
        return lo < np.searchsorted(self.starts, places, "left")


class Aligned(NamedTuple):
    a: np.ndarray  # ids
    b: np.ndarray
    cuts_a: np.ndarray  # tokens of A before the end of each group
    cuts_b: np.ndarray
    left: np.ndarray  # links: positions of tokens of A and of B
    right: np.ndarray

    def groups(self) -> Iterator[tuple[list[int], list[int]]]:
        i = j = 0
        for m, n in zip(self.cuts_a.tolist(), self.cuts_b.tolist(), strict=True):
            yield self.a[i:m].tolist(), self.b[j:n].tolist()
            i, j = m, n


def align_tokens(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> Aligned:
    """Groups and links of two token lists with as many bytes in all; no token is of zero bytes."""
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    index = IntervalIndex(ends_b - sizes_b, ends_b)
    left, right = index.overlaps(ends_a - sizes_a, ends_a)
    last = np.flatnonzero(~index.spans(ends_a))
    return Aligned(a, b, last + 1, np.searchsorted(ends_b, ends_a[last]) + 1, left, right)


class Batch(NamedTuple):
    """Of a batch of texts: numbers of tokens of A and B, groups and links of each (zeros where it has no tokens), the digest
    of its groups, and its distinct id pairs (id of A * PACK + id of B), by text, with how often each is linked."""

    numbers: np.ndarray
    digests: list[str]
    text_of: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def _written(found: Aligned, tokens: np.ndarray, numbers: np.ndarray) -> list[str]:
    """The groups of each of several texts aligned together; ``tokens``: how many of A and of B each has; ``numbers``: ids
    written out, with each of the marks behind them."""
    n_a, n_b = len(found.a), len(found.b)
    last_a, last_b = np.zeros(n_a, dtype=np.int8), np.zeros(n_b, dtype=np.int8)
    last_a[found.cuts_a - 1], last_b[found.cuts_b - 1] = 1, 2
    sizes_a, sizes_b = np.diff(found.cuts_a, prepend=0), np.diff(found.cuts_b, prepend=0)
    out = np.empty(n_a + n_b, dtype=object)
    out[np.arange(n_a) + np.repeat(found.cuts_b - sizes_b, sizes_a)] = numbers[last_a, found.a]
    out[np.arange(n_b) + np.repeat(found.cuts_a, sizes_b)] = numbers[last_b, found.b]
    ends, out = np.cumsum(tokens.sum(axis=1)).tolist(), out.tolist()
    return ["".join(out[lo:hi]) for lo, hi in zip([0, *ends], ends, strict=False)]


def _fast(path: str):
    """The vocabulary of a byte-level BPE file as ranks, where its merges stand in the order of ids; else None."""
    import public_tokenizers
    import tiktoken

    with open(path) as f:
        whole = json.load(f)
    vocabulary, merges, split = whole["model"].get("vocab"), whole["model"].get("merges") or [], whole.get("pre_tokenizer") or {}
    byte = {c: bytes([k]) for k, c in enumerate(_byte_letters())}
    ids = [vocabulary.get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in merges]
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not ids or None in ids or ids != sorted(set(ids)) or not set(byte) <= set(vocabulary):
        return None
    merged = set(ids)
    ranks = {b"".join([byte[c] for c in t]): k for t, k in vocabulary.items() if t in byte or k in merged}
    if max(ranks[x] for x in ranks if len(x) == 1) > ids[0]:
        return None
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Aligner:
    """Aligns a byte-level BPE (A) of a space and a text with a piece model (B) of the text."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True  # their strings are text
        self.fast = _fast(path_a)
        byte = {c: bytes([k]) for k, c in enumerate(_byte_letters())}
        self.bytes_a = [b"".join([byte.get(c, c.encode()) for c in self.a.id_to_token(k) or ""]) for k in range(self.a.get_vocab_size())]
        self.bytes_b = [self._piece(k) for k in range(self.b.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        self.space = self.b.piece_to_id("▁")
        # Chunks stand alone if no piece goes on from a mark, or from a space that is no part of the text, to their first character.
        joins = re.compile(f"[^{WHITE}]([{WHITE}])| (?! )([{WHITE}])")
        plain = [x.decode() for k, x in enumerate(self.bytes_b) if not (self.b.is_byte(k) or self.b.is_control(k) or self.b.is_unknown(k))]
        joined = {c for x in plain for pair in joins.findall(x) for c in pair if c}
        self.cut = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])" + "".join(f"(?!{re.escape(c)})" for c in sorted(joined)))
        self.written = np.array([[f"{k}{end}" for k in range(max(len(self.bytes_a), len(self.bytes_b)))] for end in ",|;"], dtype=object)

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()

    def _slow(self, part: str) -> list[int]:
        return self.a.encode(part, add_special_tokens=False).ids

    def encode(self, parts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Both token lists of each part; None where either does not give its bytes back.

        The piece model puts a space before a text: a part's first space is left to it, and taken off where there is none.
        """
        fast = self.fast.encode_ordinary if self.fast else self._slow
        ids_a = [fast(p) if len(p) <= LONG else self._slow(p) for p in parts]
        ids_b = self.b.encode([p[1:] if p[0] == " " else p for p in parts])
        for k, p in enumerate(parts):
            if p == " ":
                ids_b[k] = [self.space]
            elif p[0] != " ":
                ids_b[k] = ids_b[k][1:] if ids_b[k][:1] == [self.space] else []
        both = list(zip(ids_a, ids_b, strict=True))
        if self._bytes(ids_a, self.bytes_a) == "".join(parts).encode() == self._bytes(ids_b, self.bytes_b) and all(ids_b):
            lengths = [len(p.encode()) for p in parts]
            if all(np.array_equal(self._sizes(x, size), lengths) for x, size in ((ids_a, self.size_a), (ids_b, self.size_b))):
                return both
        return [x if self._bytes(x[:1], self.bytes_a) == p.encode() == self._bytes(x[1:], self.bytes_b) else None for p, x in zip(parts, both, strict=True)]

    @staticmethod
    def _bytes(ids: list[list[int]] | tuple[list[int], ...], table: list[bytes]) -> bytes:
        return b"".join([table[k] for x in ids for k in x])

    @staticmethod
    def _sizes(ids: list[list[int]], sizes: np.ndarray) -> np.ndarray:
        """Bytes of each list of ids; none is empty."""
        flat = sizes[np.fromiter(chain.from_iterable(ids), dtype=np.int64)]
        return np.add.reduceat(flat, np.cumsum([0, *map(len, ids[:-1])]))

    def together(self, encoded: list[tuple[list[int], list[int]]]) -> Aligned:
        a, b = (np.fromiter(chain.from_iterable([x[side] for x in encoded]), dtype=np.int64) for side in (0, 1))
        return align_tokens(a, b, self.size_a[a], self.size_b[b])

    def align(self, text: str) -> Aligned | None:
        """A whole text at once."""
        found = self.encode([" " + text])
        return None if found[0] is None else self.together(found)

    def batch(self, texts: list[str | None]) -> Batch:
        place: dict[str, int] = {}  # of each different chunk
        held = [[place.setdefault(p, len(place)) for p in self.cut.split(" " + t)] if t else [] for t in texts]
        parts = list(place)
        # Chunks: their numbers, the text of their groups, their links.
        numbers, written, links, fine = np.zeros((len(parts), 4), dtype=np.int64), [""] * len(parts), [np.zeros(0, dtype=np.int64)], np.zeros(len(parts), dtype=bool)
        for lo in range(0, len(parts), AT_ONCE):
            encoded = self.encode(parts[lo : lo + AT_ONCE])
            at = [lo + k for k, x in enumerate(encoded) if x is not None]
            if not at:
                continue
            known = [x for x in encoded if x is not None]
            tokens, found = np.array([[len(a), len(b)] for a, b in known]), self.together(known)
            upto = np.cumsum(tokens[:, 0])
            groups, last = np.searchsorted(found.cuts_a, upto, "right"), np.searchsorted(found.left, upto, "left")  # links lie in the order of A
            numbers[at] = np.column_stack([tokens, np.diff(groups, prepend=0), np.diff(last, prepend=0)])
            fine[at] = True
            for k, x in zip(at, _written(found, tokens, self.written), strict=True):
                written[k] = x
            links.append(found.a[found.left] * PACK + found.b[found.right])
        links, first = np.concatenate(links), np.cumsum(numbers[:, 3]) - numbers[:, 3]
        # Texts: sums over their chunks, and their links by id pair.
        whole = [bool(x) and bool(fine[x].all()) for x in held]
        digests = [hashlib.sha256("".join([written[k] for k in x])[:-1].encode()).hexdigest() if ok else "" for x, ok in zip(held, whole, strict=True)]
        lengths = np.array([len(x) if ok else 0 for x, ok in zip(held, whole, strict=True)], dtype=np.int64)
        part = np.fromiter(chain.from_iterable([x for x, ok in zip(held, whole, strict=True) if ok]), dtype=np.int64, count=int(lengths.sum()))
        text = np.repeat(np.arange(len(texts)), lengths)
        sums = np.stack([np.bincount(text, numbers[part, k], minlength=len(texts)) for k in range(4)], axis=1).astype(np.int64)
        once, times = np.unique(text * max(1, len(parts)) + part, return_counts=True)
        text, part = np.divmod(once, max(1, len(parts)))
        n = numbers[part, 3]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[part], n)
        key, times = (np.repeat(text, n) << 40) + links[at], np.repeat(times, n)
        order = np.argsort(key, kind="stable")
        key = key[order]
        begin = np.flatnonzero(np.diff(key, prepend=-1))
        return Batch(sums, digests, key[begin] >> 40, key[begin] & ((1 << 40) - 1), np.add.reduceat(times[order], begin) if len(begin) else times)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str | None = None, path_b: str | None = None) -> Aligner:
    """One for each worker process; without paths, the public byte-level BPE and piece model."""
    import public_tokenizers

    paths = path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model")
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


def groups(df: DataFrame, text: str = "text", name: str = "groups", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``df`` with ``name``: an array of groups, each ``a`` and ``b``, the token ids of both sides; null where there are no
    tokens. Nothing is shuffled."""
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    @F.arrow_udf("array<struct<a:array<int>,b:array<int>>>")
    def run(texts: pa.Array) -> pa.Array:
        with_ = aligner(path_a, path_b)
        found = [with_.align(t) if t else None for t in texts.to_pylist()]
        return pa.array([None if x is None else [{"a": a, "b": b} for a, b in x.groups()] for x in found], kind)

    return df.withColumn(name, run(F.col(text)))


DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
HELD = f"block long, {DIGEST}, pairs binary, times binary, docs binary"


def _blocks(path_a: str | None, path_b: str | None, block: int):
    """For mapInPandas: a row a document, with its pairs as places in its block's list and how often it links each; and a
    row a block (without counts) with that list and the documents that hold each. A block is of whole batches."""
    names = [x.split()[0] for x in HELD.split(", ")]

    def closed(number: int, docs: list, batches: list[Batch]) -> pd.DataFrame:
        list_, at = np.unique(np.concatenate([x.pairs for x in batches]), return_inverse=True)
        held, rows, lo = np.bincount(at, minlength=len(list_)), [], 0
        for keys, x in zip(docs, batches, strict=True):
            ends = lo + np.searchsorted(x.text_of, np.arange(len(keys)), "right")
            begins, times = np.concatenate([[lo], ends[:-1]]), x.times.astype("<i4")
            for key, counts, sha, i, j in zip(keys, x.numbers.tolist(), x.digests, begins.tolist(), ends.tolist(), strict=True):
                rows.append((number, key, *counts, sha, at[i:j].astype("<i4").tobytes(), times[i - lo : j - lo].tobytes(), None))
            lo += len(x.pairs)
        rows.append((number, *[None] * 6, list_.tobytes(), None, held.astype(np.int64).tobytes()))
        return pd.DataFrame(rows, columns=names, dtype=object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with_, number, size = aligner(path_a, path_b), TaskContext.get().partitionId() << 32, 0
        docs: list[list] = []
        held: list[Batch] = []
        for batch in batches:
            texts = [None if pd.isna(t) else t for t in batch["text"]]
            docs.append([None if pd.isna(k) else int(k) for k in batch["doc_id"]])
            held.append(with_.batch(texts))
            size += sum(len(t) for t in texts if t)
            if size >= block:
                yield closed(number, docs, held)
                docs, held, size, number = [], [], 0, number + 1
        if held:
            yield closed(number, docs, held)

    return run


def _open(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For mapInPandas: a row for each pair of a block."""
    for batch in batches:
        for block, pairs, docs in zip(batch["block"], batch["pairs"], batch["docs"], strict=True):
            pair = np.frombuffer(pairs, dtype=np.int64)
            yield pd.DataFrame({"block": np.full(len(pair), block), "at": np.arange(len(pair), dtype=np.int32), "a": (pair // PACK).astype(np.int32), "b": (pair % PACK).astype(np.int32), "docs": np.frombuffer(docs, dtype=np.int64)})


def _summed(key, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """For cogroups of a block's documents and what is known of its pairs."""
    counts, best = np.zeros(len(known), dtype=np.int64), np.zeros(len(known), dtype=bool)
    counts[known["at"].to_numpy()], best[known["at"].to_numpy()] = known["count"].to_numpy(), known["best"].to_numpy()
    out = {"n_best": [], "count_sum": []}
    for at, times in zip(rows["pairs"], rows["times"], strict=True):
        at, times = np.frombuffer(at, dtype="<i4"), np.frombuffer(times, dtype="<i4").astype(np.int64)
        out["n_best"].append(int(times[best[at]].sum()))
        out["count_sum"].append(int((times * counts[at]).sum()))
    return rows[[x.split()[0] for x in DIGEST.split(", ")]].assign(**out)


def pair_counts(opened: DataFrame) -> DataFrame:
    """``a, b, count`` (documents that hold the pair linked) and ``best``: whether it is the highest of its ``a``."""
    counts = opened.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    counts = materialize(counts, "align-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align(df: DataFrame, key: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None, block: int = BLOCK) -> DataFrame:
    """A row for each row of ``df``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``count_sum`` adds, over the links, in how many rows of the corpus their id pair is linked; ``n_best`` are the links
    whose pair is in as many as any of its A id. The digest is of the groups as ``a1,a2|b1;a3|b2,b3``.
    Texts that are null or empty, or that a tokenizer does not give back byte by byte, have no tokens: zeros and ''. A
    null key stays null; repeated rows are documents of their own; other columns are ignored; an empty table gives no rows.
    """
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    held = materialize(rows.mapInPandas(_blocks(path_a, path_b, block), HELD), "align-blocks")
    opened = materialize(held.where("docs is not null").select("block", "pairs", "docs").mapInPandas(_open, "block long, at int, a int, b int, docs long"), "align-pairs")
    known = opened.join(pair_counts(opened), ["a", "b"]).select("block", "at", "count", "best")
    docs = held.where("docs is null").drop("docs")
    schema = DIGEST + ", n_best long, count_sum long"
    return docs.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(_summed, schema).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12(spark, sf_dir: str) -> DataFrame:
    """Two public tokenizers aligned over every text of ``documents``."""
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
