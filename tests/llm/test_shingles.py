"""Near copies of the pipeline's stage against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from thicket.llm import shingles, simhash

from .test_formats import documents, empty, odd


def plain_set(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return not a | b or len(a & b) / len(a | b) >= 0.8


def brute_roots(texts):
    sets = [plain_set(t) for t in texts]
    links = [(i, j) for j in range(len(sets)) for i in range(j) if alike(sets[i], sets[j])]
    return simhash.hook(np.arange(len(sets)), *(np.array([p[k] for p in links], dtype=int) for k in (0, 1)))


def corpus():
    """Random texts, edited copies of all distances, a chain, a common passage, short texts."""
    rng = np.random.default_rng(4)
    vocab = [f"w{k}" for k in range(5000)]
    words = lambda n: list(rng.choice(vocab, n))
    passage, texts = words(40), []
    for k in range(60):
        base = words(int(rng.integers(20, 300)))
        if k % 3 == 0:
            base[5:5] = passage
        texts.append(base)
        for _ in range(3):
            copy = list(base)
            for at in rng.integers(0, len(copy), int(rng.integers(0, max(2, len(copy) // 30)))):
                copy[at] = "edit"
            texts.append(copy[: len(copy) - int(rng.integers(0, 4))])
    chain = words(200)
    for k in range(8):
        texts.append(chain[10 * k :] + words(10 * k))
    texts += [["one"], ["ONE"], ["a", "b"], [], ["a", "b", "c", "d", "e", "f"]]
    return [" ".join(t) for t in texts]


def test_near_copies_by_brute_force(spark, monkeypatch):
    texts = corpus()
    roots = brute_roots(texts)
    want = sorted(set(roots.tolist()))
    df = documents(spark, [(k, t, "s") for k, t in enumerate(texts)]).repartition(5)
    for least in (2, 10**9):  # many common shingles, none
        monkeypatch.setattr(shingles, "COMMON", least)
        kept = corpus_pipeline.near_dedup(spark, df, None)
        assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == want


def test_prefix_and_similarity():
    assert len(shingles.shingle_set(b"A b c d e f a b c d e")) == 6 and len(shingles.shingle_set(b"")) == 0
    for n in range(1, 40):
        s = np.arange(n)
        assert len(shingles.prefix(s, np.array([0, 1]))) == n - -(-4 * n // 5) + 1
    assert shingles.prefix(np.arange(10), np.array([0, 1])).tolist() == [2, 3, 4]


def test_common_shingles_are_counted_over_all_texts(spark):
    """A passage in 300 of 12 000 texts is common however they are dealt, though none of every second text, by hash, has it."""
    texts = spark.range(12_000).select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("own"), "id")
    texts = texts.select("id", F.concat_ws(" ", *[F.concat("own", F.lit(f"_{k}")) for k in range(8)]).alias("text"), F.concat_ws(" ", "own", F.lit("a passage that very many of them have")).alias("other"))
    having = texts.where(F.pmod(F.xxhash64("other"), F.lit(2)) == 1).limit(300).select("id", "other")
    df = texts.select("id", "text").join(having, "id", "left").select(F.col("id").alias("doc_id"), F.coalesce("other", "text").alias("text"))
    shared = shingles.shingle_set(b"a passage that very many of them have")
    for parts in (1, 9):
        dealt = df.repartition(parts, "doc_id").cache()
        assert dealt.where(F.col("text").contains("passage")).count() == 300
        sign = shingles._signature(shingles._common(dealt, "text"))
        rows = dealt.select(F.col("text").contains("passage").alias("has"), sign(F.col("text").cast("binary")).alias("sig")).select("has", "sig.prefix").collect()
        assert sum(r.has for r in rows) == 300
        mine = [r.prefix for r in rows if r.has]
        assert all(x[0] not in shared for x in mine)
        dealt.unpersist()


@pytest.mark.parametrize(("most", "block", "families"), [(7, 1 << 19, False), (32768, 300, True), (32768, 1 << 19, True)])
def test_either_step(spark, monkeypatch, most, block, families):
    """Pairs of candidates without families, and families, in blocks and whole, find what brute force does."""
    texts = corpus()
    want = sorted(set(brute_roots(texts).tolist()))
    df = documents(spark, [(k, t, "s") for k, t in enumerate(texts)])
    if not families:
        monkeypatch.setattr(shingles, "_star_pairs", lambda nodes: nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false"))
    placed = shingles.near_copies(df, most=most, block=block).groupBy("root").agg(F.min("key").alias("k"))
    assert sorted(r.k for r in placed.collect()) == want


def test_radius_loses_no_link():
    """Bits that differ between sets of similarity 4/5 and just above, small and large."""
    rng, far = np.random.default_rng(5), []
    for n in (4, 5, 9, 20, 50, 200, 1000):
        for _ in range(400):
            a = rng.integers(-(2**63), 2**63, n)
            b = np.concatenate([a, rng.integers(-(2**63), 2**63, n // 4)]) if rng.random() < 0.5 else np.concatenate([a[: n - n // 9], rng.integers(-(2**63), 2**63, n // 9)])
            far.append(int(np.bitwise_count(np.uint64((simhash.set_fingerprint(a) ^ simhash.set_fingerprint(b)) & (2**64 - 1)))))
    assert max(far) <= shingles.RADIUS - 3


def test_near_copies_odd_rows(spark):
    df, rows = odd(spark)
    kept = shingles.keep_one(df)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "2", "4", "None"]
    alone = shingles.keep_one(documents(spark, [(None, "a b", "s"), (None, "a b", "t"), (None, "a b", "t")])).collect()
    assert len(alone) == 1
    assert shingles.keep_one(empty(spark)).count() == 0


def test_sketches():
    """Sketches agree as sets are alike; none of similarity 4/5 is ruled out, nearly all of 1/5 are."""
    rng = np.random.default_rng(8)
    new = lambda n: rng.integers(-(2**63), 2**63, n)
    for n in (1, 4, 9, 30, 200, 1000):
        pairs = []
        for _ in range(300):
            a = new(n)
            pairs.append((np.unique(a), np.unique(np.concatenate([a, new(n // 4)]))))
        for bins in (shingles.BINS, shingles.FINE):
            both = np.array([[shingles.sketch(x, bins) for x in p] for p in pairs]).reshape(-1, bins)
            at = np.arange(0, len(both), 2)
            assert shingles.likely(both, at, at + 1).all()
    other = [np.unique(np.concatenate([shared, new(200)])) for shared in [new(100)] for _ in range(400)]
    both = np.stack([shingles.sketch(x) for x in other])
    i, j = np.triu_indices(400, 1)
    assert shingles.likely(both, i, j).mean() < 0.01
    same, n = shingles.agreement(np.stack([shingles.sketch(np.zeros(0, dtype=np.int64))]), both[:1])
    assert same[0] == 0 and n[0] >= shingles.BINS - 6


@pytest.mark.parametrize("known", [True, False])
def test_a_shared_passage_makes_no_family(spark, monkeypatch, known):
    """Texts that share a third of their words and nothing else, whether or not the sample knows the passage as common; a few
    of them have near copies."""
    rng = np.random.default_rng(9)
    count = 4000 if known else 600
    words = lambda n: [f"w{k}" for k in rng.integers(0, 10**6, n)]
    passage, texts = words(100), []
    for k in range(count):
        base = words(100) + passage + words(100)
        texts.append(" ".join(base))
        if k % 100 == 0:
            base[3] = "edit"
            texts.append(" ".join(base))
    if not known:
        monkeypatch.setattr(shingles, "COMMON", 10**9)
    sizes, pairs = [], []
    stars, others = shingles._star_pairs, shingles._other_pairs
    monkeypatch.setattr(shingles, "_star_pairs", lambda nodes: (lambda found: sizes.append(found) or found)(stars(nodes)))
    monkeypatch.setattr(shingles, "_other_pairs", lambda *a: (lambda found: pairs.append(found) or found)(others(*a)))
    df = documents(spark, [(k, t, "s") for k, t in enumerate(texts)]).repartition(4)
    placed = shingles.near_copies(df).collect()
    alike_ = {}
    for r in placed:
        alike_.setdefault(r.root, []).append(r.key)
    assert sorted(map(sorted, (x for x in alike_.values() if len(x) > 1))) == [[k, k + 1] for k in range(0, len(texts), 101)]
    families = simhash.components(sizes[0]).groupBy("root").count().agg(F.max("count")).first()[0]
    assert families <= 4 and pairs[0].count() <= count // 10


def test_joined_families_grow_with_the_texts(spark, monkeypatch):
    """Copies with an edit each, without families at first: nearly every two are a pair, and what joins them is linear."""
    rng = np.random.default_rng(12)
    base, texts = [f"w{k}" for k in range(60)], []
    for k in range(400):
        copy = list(base)
        copy[int(rng.integers(60))] = f"edit{k}"
        texts.append(" ".join(copy))
    monkeypatch.setattr(shingles, "_star_pairs", lambda nodes: nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false"))
    joined, others = [], shingles._other_pairs
    monkeypatch.setattr(shingles, "_other_pairs", lambda *a: (lambda found: joined.append(found) or found)(others(*a)))
    df = documents(spark, [(k, t, "s") for k, t in enumerate(texts)])
    placed = shingles.near_copies(df).groupBy("root").agg(F.min("key").alias("k"))
    assert sorted(r.k for r in placed.collect()) == sorted(set(brute_roots(texts).tolist()))
    longest = 56 - -(-4 * 56 // 5) + 1  # shingles of a prefix, each a group that a text is in
    assert joined[0].count() <= longest * len(texts)
