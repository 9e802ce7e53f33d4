"""Spelling variants: words one edit apart, found by their rarest bigrams, and the frequent form each of them leads to.

One edit spoils at most two of a word's bigrams. So two words one edit apart share one of their three rarest bigrams (in
one order for all words: rare ones first, by the number of words that have them), at the same place or one place on.
That bigram is whole, so the edit lies right of it, or left of it: everything on its other side is alike. And of the
side with the edit, the first or the last half is alike. A word is thus met only where its rare bigram, what lies on one
side of it, and half of what lies on the other are equal, and where lengths are equal or differ by one. Rare bigrams
keep the meetings few, the halves keep them few when words are many; neither loses a pair. Who meets is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
RARE = 3  # bigrams of a word by which it is met: two that an edit may spoil, and one more
MOST_HELD = 300_000  # words that a task counts before it passes them on
ROWS = 10_000  # of a batch passed on
SEED = 42


def _counts(least: int, drop: int | None):
    run, schema = re.compile("[a-zÀ-ÿ]{%d,}" % least), pa.schema([("word", pa.string()), ("n", pa.int64())])

    def passed(held: Counter) -> Iterator[pa.RecordBatch]:
        words, ns = list(held.keys()), list(held.values())
        for lo in range(0, len(words), ROWS):
            yield pa.RecordBatch.from_pydict({"word": words[lo : lo + ROWS], "n": ns[lo : lo + ROWS]}, schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch["key"].to_pylist(), batch["text"], strict=True):
                if not text.is_valid:
                    continue
                found = Counter(run.findall(text.as_py().translate(LOWER).decode()))
                if drop:
                    salt = zlib.crc32(b"%b:" % (key or "").encode())
                    for word in [w for w in found if zlib.crc32(w.encode(), salt) % drop == 0]:
                        at = zlib.crc32(word.encode(), salt) % len(word)
                        n, short = found.pop(word), word[:at] + word[at + 1 :]
                        if len(short) >= least:
                            held[short] += n
                held.update(found)
                if len(held) > MOST_HELD:
                    yield from passed(held)
                    held = Counter()
        yield from passed(held)

    return count


def word_counts(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 7, times: int = 2, drop: int | None = None) -> DataFrame:
    """``word, n``: the words (maximal runs of Latin letters to U+00FF, only A-Z lowered) of at least ``least`` code points
    and ``times`` occurrences in all texts.

    With ``drop``, a run whose CRC-32 of ``<key>:<run>`` it divides loses the code point at that number modulo the run's
    length first. Null texts have no words; a null key is empty before the colon; repeated rows count again; other
    columns are ignored; an empty table gives no rows.
    """
    rows = df.select(F.col(key).cast("string").alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(_counts(least, drop), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def bigram_ranks(words: DataFrame) -> dict[str, int]:
    """Bigrams in the order of the number of words that have them, rarest first.

    Words are of 26 + 64 letters, so these are at most 8100 whatever the corpus.
    """
    grams = F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))
    counts = words.select(F.explode(F.array_distinct(grams)).alias("gram")).groupBy("gram").count()
    return {r["gram"]: k for k, r in enumerate(counts.orderBy("count", "gram").collect())}


def rare_bigrams(word: str, ranks: dict[str, int]) -> list[int]:
    """Places of the ``RARE`` rarest bigrams; of the last of them all places, where a word repeats it."""
    order = sorted((ranks[word[k : k + 2]], k) for k in range(len(word) - 1))
    return [k for rank, k in order if rank <= order[min(RARE, len(order)) - 1][0]]


def meeting_keys(word: str, ranks: dict[str, int]) -> tuple[list[str], list[str]]:
    """Where a word meets those of its length or one letter more, and where it meets those of one letter less."""
    own, longer, n = set(), set(), len(word)
    for p in rare_bigrams(word, ranks):
        for keys, size in ((own, n), (longer, n - 1)):
            left, right = p - (n - size), size - p - 2  # letters beside the bigram, of the shorter word of a pair
            if right >= 0:  # the edit lies right of the bigram, in the second half there or in the first
                half = right // 2
                keys.add(f"{size}>{p}>{word[: p + 2 + half]}")
                keys.add(f"{size}>{p}<{word[: p + 2]}<{word[n - (right - half) :]}")
            if left >= 0:  # the edit lies left of it
                half = left // 2
                keys.add(f"{size}<{left}>{word[:half]}>{word[p:]}")
                keys.add(f"{size}<{left}<{word[p - (left - half) :]}")
    return list(own), list(longer)


def _meetings(ranks: dict[str, int]):
    schema = pa.schema([("key", pa.int64()), ("longer", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in schema.names}
            for word, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist(), strict=True):
                for longer, keys in enumerate(meeting_keys(word, ranks)):
                    out["key"] += [xxhash.xxh64_intdigest(key, SEED) - (1 << 63) for key in keys]
                    out["longer"] += [bool(longer)] * len(keys)
                    out["word"] += [word] * len(keys)
                    out["n"] += [n] * len(keys)
            yield pa.RecordBatch.from_pydict(out, schema)

    return run


def near_words(words: DataFrame) -> DataFrame:
    """All pairs ``a, a_n, b, b_n`` of ``words`` (word, n; distinct) that one inserted, deleted or replaced code point parts.

    Each pair comes once. Words are of the letters that ``word_counts`` gives, two code points at least.
    """
    rows = materialize(words.mapInArrow(_meetings(bigram_ranks(words)), "key long, longer boolean, word string, n long"), "variant-keys")
    one = rows.where("not longer").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    other = rows.select("key", "longer", F.col("word").alias("b"), F.col("n").alias("b_n"))
    met = one.join(other, "key").where((F.col("longer") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def group_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each of ``words`` (word, n; distinct).

    The form is the near word of largest n (ties: the smallest word), if that is ``ratio`` times the word's or more. The
    root is where forms end. As n grows ``ratio``-fold from form to form, few steps reach it: each doubles the way.
    """
    words = materialize(words.select("word", "n"), "variant-words")
    pairs = materialize(near_words(words), "variant-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    large = F.coalesce(-F.col("best.m") >= ratio * F.col("n"), F.lit(False))
    placed = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(large, F.col("best.near")).alias("form"), F.when(large, -F.col("best.m")).alias("form_n"))
    placed = materialize(placed, "variant-forms")
    ways = placed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = materialize(ways.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-ways")
        ways = longer.select("word", "root")
        if not longer.where("moved").take(1):
            break
    out = placed.join(ways, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13(spark, sf_dir: str) -> DataFrame:
    """Variants among the words of all ``documents``, a letter dropped from one run of 31."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return group_variants(word_counts(docs, drop=31))


# CRC-32 from its definition, and near words by what is left when a code point is deleted.
OP13_SQL = r"""
WITH RECURSIVE tbl AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
many AS (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 7 GROUP BY 1, 2),
hashed AS (SELECT run, times, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(doc_id || ':' || run))), lambda i: CAST('0x' || substr(hex(doc_id || ':' || run), 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h FROM many, tbl),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed) WHERE length(word) >= 7 GROUP BY 1 HAVING sum(times) >= 2),
cut AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words),
parts AS (SELECT word, n, p, substr(word, 1, p - 1) AS l, substr(word, p + 1) AS r FROM cut),
pairs AS (SELECT DISTINCT a.word AS a, a.n AS a_n, b.word AS b, b.n AS b_n FROM parts a JOIN words b ON b.word = a.l || a.r UNION SELECT a.word, a.n, b.word, b.n FROM parts a JOIN parts b ON a.p = b.p AND a.l = b.l AND a.r = b.r AND a.word < b.word),
near AS (SELECT a AS word, b AS other, b_n AS m FROM pairs UNION ALL SELECT b, a, a_n FROM pairs),
best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY 1),
top AS (SELECT b.word, min(other) AS other FROM best b JOIN near x ON x.word = b.word AND x.m = b.m GROUP BY 1),
forms AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n FROM words w LEFT JOIN best USING (word) LEFT JOIN top USING (word)),
ways AS (SELECT word, word AS root FROM forms UNION ALL SELECT ways.word, form FROM ways JOIN forms ON forms.word = ways.root WHERE form IS NOT NULL),
roots AS (SELECT ways.word, ways.root FROM ways JOIN forms ON forms.word = ways.root AND form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN roots r ON r.word = f.word
"""
