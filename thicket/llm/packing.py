"""Bounded-space online packing of token sequences.

Every partition keeps a fixed number of open windows. A document goes, whole if it can, to the open window it
fits best; when it fits none, the fullest window is emitted and a new one opened. What is still open when a
partition ends is merged with the leftovers of other partitions, some of them at a time, until one is left.
"""

from __future__ import annotations

import re
import struct
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, part long, open boolean"
NAMES = [x.split()[0] for x in PIECE.split(", ")]
_ODD = re.compile("[\x1c-\x1f]")  # str.split() takes these for white space, the tokenizer does not
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII punctuation but the apostrophe, which begins tokens of its own


def pack_ids(*ids: int) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte: itself where it prints, else one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in prints else next(others)) for b in range(256)]


class WordTokenizer(dict):
    """Ids of whole texts as little-endian unsigned 32-bit bytes, for a tokenizer that drops white space.

    Such a tokenizer never joins what white space separates, so each word is encoded once and kept here, at most
    ``most`` words and as many stems (a word in lower case without the marks at its end), none over 64 characters.
    A stem of Latin letters goes to the vocabulary's merges at once; other words take the tokenizer's whole way, and so do
    whole texts where a tokenizer is of another kind. ``plain_specials``: strings such as an end mark are ordinary text;
    else they have their own ids, as the tokenizer reads them by itself.
    """

    def __init__(self, path: str, plain_specials: bool = False, most: int = 200_000):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = plain_specials
        self.merges, self.letters, self.most = self.model.model, _byte_letters(), most
        self.stems: dict[str, bytes] = {}
        self.ends: dict[str, bytes] = {}
        spaced = any(re.search(r"\s", t.content) for t in self.model.get_added_tokens_decoder().values())
        probe = " Once, (upon) a\ntime  Étés don't x1 "
        self.by_word = not spaced and self.direct(probe) == b"".join(map(self.__getitem__, probe.split()))

    def direct(self, text: str) -> bytes:
        return pack_ids(*self.model.encode(text, add_special_tokens=False).ids)

    def __missing__(self, word: str) -> bytes:
        if len(word) > 64:
            return self.direct(word)
        if len(self) >= self.most:
            self.clear()
        lower = word.lower()
        stem, end = lower.rstrip(MARKS), b""
        if not stem or len(stem) < len(lower) and not stem[-1].isalpha():
            stem = lower
        elif len(stem) < len(lower):  # the marks after a letter are one token run
            tail = lower[len(stem) :]
            end = self.ends.get(tail)
            if end is None:
                if len(self.ends) >= self.most:
                    self.ends.clear()
                end = self.ends[tail] = self.direct(tail)
        ids = self.stems.get(stem)
        if ids is None:
            if len(self.stems) >= self.most:
                self.stems.clear()
            mapped = stem
            if not stem.isascii() and stem.isalpha() and max(stem) < "\u0250":
                mapped = "".join([self.letters[b] for b in stem.encode()])
            elif not (stem.isascii() and stem.isalpha()):
                out = self[word] = self.direct(word)
                return out
            ids = self.stems[stem] = pack_ids(*[t.id for t in self.merges.tokenize(mapped)])
        out = self[word] = ids + end
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.split())) if self.by_word and not _ODD.search(text) else self.direct(text)


_tokenizers: dict[tuple[str, bool], WordTokenizer] = {}


def tokenizer(path: str | None, plain_specials: bool = False) -> WordTokenizer:
    """One for each worker process, path and setting; without a path, the public 49k word BPE."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    if (path, plain_specials) not in _tokenizers:
        _tokenizers[path, plain_specials] = WordTokenizer(path, plain_specials)
    return _tokenizers[path, plain_specials]


class Packer:
    """Open windows over pieces (doc_id, start, ids, doc_tokens); emitted windows are lists of pieces.

    ``gap``: a window that would be emitted with more unused room than that is first filled with the head of the
    piece at hand, whose rest goes on.
    """

    def __init__(self, size: int, windows: int, gap: int):
        self.size, self.windows, self.gap = size, windows, gap
        self.free: list[tuple[int, int]] = []  # (unused room, window), ascending
        self.open: dict[int, list] = {}
        self.next = 0
        self.full: list[list] = []

    def add(self, doc, start: int, ids: bytes, total: int) -> None:
        n = len(ids) // 4
        if n > self.size:  # windows of its own, and a rest; each id is copied once
            whole = (n - 1) // self.size * self.size
            self.full += [[(doc, start + k, ids[4 * k : 4 * (k + self.size)], total)] for k in range(0, whole, self.size)]
            ids, start, n = ids[4 * whole :], start + whole, n - whole
        while True:
            at = bisect_left(self.free, (n, -1))
            if at < len(self.free):
                room, window = self.free.pop(at)
                self.open[window].append((doc, start, ids, total))
                if room > n:
                    insort(self.free, (room - n, window))
                else:
                    self.full.append(self.open.pop(window))
                return
            if len(self.free) < self.windows:
                self.open[self.next] = []
                insort(self.free, (self.size, self.next))
                self.next += 1
                continue
            room, window = self.free.pop(0)
            if room > self.gap:
                self.open[window].append((doc, start, ids[: 4 * room], total))
                ids, start, n = ids[4 * room :], start + room, n - room
            self.full.append(self.open.pop(window))

    def taken(self) -> list[list]:
        out, self.full = self.full, []
        return out

    def left(self) -> list[list]:
        """The open windows, fullest first."""
        return [self.open[w] for _, w in self.free]


def pour(windows: list[list], size: int) -> tuple[list[list], list]:
    """Pieces of all windows poured one after another into full windows; the last, not full, comes second."""
    full, now, room = [], [], size
    for doc, start, ids, total in (p for w in windows for p in w):
        at = 0
        while at < len(ids):
            put = ids[at : at + 4 * room]
            now.append((doc, start + at // 4, put, total))
            at, room = at + len(put), room - len(put) // 4
            if not room:
                full.append(now)
                now, room = [], size
    return full, now


class _Rows:
    """Windows as rows of ``PIECE``, in frames of bounded size."""

    def __init__(self, level: int, part: int):
        self.base, self.count, self.part, self.rows, self.bytes = (level << 56) + (part << 28), 0, part, [], 0

    def put(self, window: list, is_open: bool) -> None:
        at = 0
        for doc, start, ids, total in window:
            n = len(ids) // 4
            self.rows.append((doc, start, n, ids, total, self.base + self.count, at, self.part, is_open))
            at += n
            self.bytes += len(ids)
        self.count += 1

    def frames(self, least: int) -> Iterator[pd.DataFrame]:
        if self.rows and self.bytes >= least:
            out = pd.DataFrame(self.rows, columns=NAMES)
            self.rows, self.bytes = [], 0
            yield out.astype({"doc_id": "Int64"})


def _tokenize_and_pack(path: str | None, plain_specials: bool, end_id: int, size: int, windows: int, gap: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, packer = tokenizer(path, plain_specials), Packer(size, windows, gap)
        rows = _Rows(0, TaskContext.get().partitionId())
        for batch in batches:
            docs = [None if pd.isna(x) else int(x) for x in batch["doc_id"]]
            texts = ["" if x is None else x for x in batch["text"]]
            at = 0
            while at < len(texts):  # some texts at a time, about 1 MB
                to, chars = at, 0
                while to < len(texts) and (to == at or chars < 1_000_000):
                    chars += len(texts[to])
                    to += 1
                for doc, text in zip(docs[at:to], texts[at:to], strict=True):
                    ids = model.encode(text) + end
                    packer.add(doc, 0, ids, len(ids) // 4)
                for window in packer.taken():
                    rows.put(window, False)
                    yield from rows.frames(4 << 20)
                at = to
        for window in packer.left():
            rows.put(window, True)
        yield from rows.frames(0)

    return run


def _merge(size: int, windows: int, gap: int, level: int):
    def run(key, batch: pd.DataFrame) -> pd.DataFrame:
        packer, rows = Packer(size, windows, gap), _Rows(level, int(key[0]))
        batch = batch.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True])
        for doc, start, ids, total in zip(batch["doc_id"], batch["start"], batch["ids"], batch["doc_tokens"], strict=True):
            packer.add(None if pd.isna(doc) else int(doc), int(start), bytes(ids), int(total))
        full, last = pour(packer.left(), size)
        for window in packer.taken() + full:
            rows.put(window, False)
        if last:
            rows.put(last, True)
        return next(rows.frames(0), pd.DataFrame(columns=NAMES))

    return run


def pack(df: DataFrame, doc: str = "doc_id", text: str = "text", path: str | None = None, plain_specials: bool = False, end_id: int = 2, size: int = 4096, windows: int = 64, gap: int = 16, fan_in: int = 16) -> DataFrame:
    """Packs all texts of ``df`` into sequences of at most ``size`` tokens.

    Returns a row a piece: ``doc_id, start`` (its document's tokens before it), ``length, ids`` (little-endian
    unsigned 32-bit), ``doc_tokens, sequence_id, offset``. A document is its text's ids, then ``end_id``; a null
    text is empty. Documents longer than ``size`` fill sequences of their own, and their rest is placed like a
    short document. Sequences are emitted with at most ``gap`` tokens unused; only the very last may have more.
    A null id stays null; repeated rows are documents of their own; other columns are ignored; an empty table
    gives no rows. Strings of special tokens have their own ids unless ``plain_specials``. A partition holds ``windows`` windows at a time; a merge task, those of ``fan_in`` partitions.
    """
    rows = df.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = materialize(rows.mapInPandas(_tokenize_and_pack(path, plain_specials, end_id, size, windows, gap), PIECE), "packed")
    done, left, level = out.where("not open"), out.where("open"), 0
    parts = (out.where("open").agg(F.max("part")).first()[0] or 0) + 1
    while True:
        level, parts = level + 1, -(-parts // fan_in)
        merged = left.withColumn("part", F.floor(F.col("part") / fan_in)).groupBy("part").applyInPandas(_merge(size, windows, gap, level), PIECE)
        if parts == 1:
            return done.unionByName(merged).drop("part", "open")
        merged = materialize(merged, "packed-left")
        done, left = done.unionByName(merged.where("not open")), merged.where("open")


def op10(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` packed by the production settings; a row a piece, with a checksum of its ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = pack(docs)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
