"""Languages, quality, fingerprints, SimHash, neighbours and the pipeline: brute force, held-out accuracy, odd rows."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from thicket.llm import fingerprint, langid, quality, simhash, vptree
from thicket.llm.queries import ORACLES, QUERIES

from .test_formats import documents, empty, odd
from .test_shingles import brute_roots

SF = "/root/testdata/sf0.01"
TABLES = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@TABLES
def test_language_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op1_language_id"](spark, SF).join(truth, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == truth.count() and np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(spark):
    df, rows = odd(spark)
    model = langid.train(documents(spark, [(k, t, "s") for k, t in enumerate(["the cat and the dog", "a the of and", None, "12 3"])]).withColumn("lang", F.when(F.col("doc_id") == 1, "fr").otherwise(F.col("lang"))), n_landmarks=4)
    assert model.languages == ("en", "fr")
    out = langid.identify(df, model)
    assert out.columns == [*df.columns, "lang_pred_", "lang_score"] and out.count() == len(rows)
    got = {(r.doc_id, r.text): r for r in out.collect()}
    assert got[2, None].lang_pred_ == "und" and got[3, ""].lang_pred_ == "und" and got[2, None].lang_score == 0
    none = langid.train(empty(spark))
    assert none.score(["some text"])[0] == ["und"] and none.score(["some text"])[1] == [0.0] and langid.identify(empty(spark), none).count() == 0


def test_letters(spark):
    """Only the Unicode categories L* are letters."""
    for t in ("²", "½", "①", "Ⅷ", "12 3", "_", "\u0301", "", None):
        assert not langid.has_letter(t)
    for t in ("a", "é", "ª", "漢", "1а", "ʰ"):
        assert langid.has_letter(t)
    rows = [(1, "²", "s"), (2, "½ ①", "s"), (3, "Ⅷ", "s"), (4, "a", "s")]
    model = langid.train(documents(spark, [(k, "the cat", "s") for k in range(4)]))
    assert [r.lang_pred for r in langid.identify(documents(spark, rows), model).orderBy("doc_id").collect()] == ["und", "und", "und", "en"]


def test_training_rows(spark):
    """A repeated key teaches once, and the least of its sets; the most frequent languages are learned."""
    rows = [(1, t, "s") for t in ("the cat", "a dog", "one horse")] * 3 + [(2, "le chat", "s"), (3, "la vache", "s")]
    df = documents(spark, rows).withColumn("lang", F.when(F.col("doc_id") == 1, "en").otherwise("fr"))
    sets = langid._collect_sets(iter([__import__("pandas").DataFrame({"lang": ["en"] * 3, "h": [1] * 3, "text": ["the cat", "a dog", "one horse"]})]))
    least = min(bytes(b) for b in next(sets)["bits"])
    models = [langid.train(df.repartition(k)) for k in (1, 5)]
    assert (models[0].weights == models[1].weights).all() and models[0].languages == ("en", "fr")
    seen = np.flatnonzero(np.unpackbits(np.frombuffer(least, dtype=np.uint8)))
    assert (models[0].weights[seen] != 0).any(axis=1).all()
    assert langid.train(df, most_languages=1).languages == ("en",)


def brute_grams(text):
    """Buckets of every n-gram, one by one."""
    plain = bytes(b | 32 if chr(b).isascii() and chr(b).isalpha() else b if b >= 128 else 32 for b in text.encode())
    out = set()
    for n in range(1, 5):
        for k in range(len(plain) - n + 1):
            x = (int.from_bytes(plain[k : k + n], "big") + n * 0x3C6EF372) * 2654435761 % 2**32
            out.add((x ^ x >> 15) * 2246822519 % 2**32 >> 17)
    return out


def test_language_scores_by_brute_force():
    """The folded score is that of the kernel written out: landmarks, whitening, ridge regression and the regression's output."""
    words = {"en": "the cat sat on a mat and the dog ate it", "fr": "le chat est sur la table et une vache", "de": "der hund und die katze sind im haus"}
    rng = np.random.default_rng(3)
    texts = [(" ".join(rng.choice(w.split(), 6)), k) for k, w in words.items() for _ in range(12)]
    n_marks, ridge, seed = 9, 0.1, 4
    model = langid.fit([langid.gram_buckets(t) for t, _ in texts], [y for _, y in texts], n_marks, ridge, seed)
    kernel = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    sets = [brute_grams(t) for t, _ in texts]
    assert [sorted(s) for s in sets] == [langid.gram_buckets(t).tolist() for t, _ in texts]
    names = sorted(words)
    shuffled = np.random.default_rng(seed).permutation(len(texts)).tolist()
    by = {k: [i for i in shuffled if texts[i][1] == k] for k in names}
    marks = [i for t in range(12) for i in shuffled if by[texts[i][1]].index(i) == t][:n_marks]
    inner = np.array([[kernel(sets[i], sets[j]) for j in marks] for i in marks])
    values, vectors = np.linalg.eigh(inner)
    root = vectors @ np.diag(values**-0.5)
    x = np.array([[kernel(s, sets[j]) for j in marks] for s in sets]) @ root
    y = np.array([[1.0 if t[1] == k else -1.0 for k in names] for t in texts])
    beta = np.linalg.solve(x.T @ x + ridge * np.eye(x.shape[1]), x.T @ y)  # languages are equally frequent here
    for text in ("the hund sat sur la table", "une katze", "it", *[t for t, _ in texts[:5]]):
        f = np.array([kernel(brute_grams(text), sets[j]) for j in marks]) @ root @ beta
        p = np.exp(4 * f) / np.exp(4 * f).sum()
        got = model.score([text])
        assert got[0] == [names[int(f.argmax())]] and got[1][0] == pytest.approx(p.max(), abs=1e-4) and got[2][0] == pytest.approx(f.max(), abs=1e-4)


def test_language_model_fits():
    texts = [("the cat sat on the mat", "en"), ("le chat est sur la table", "fr"), ("der hund und die katze", "de"), ("a dog and a cat", "en"), ("une table et un chat", "fr"), ("das ist die katze", "de")]
    sets = [langid.gram_buckets(t) for t, _ in texts]
    model = langid.fit(sets, [y for _, y in texts], 6, 0.01, 1)
    names, scores, outputs = model.score([t for t, _ in texts])
    assert names == [y for _, y in texts] and (scores > 0.5).all() and (outputs > 0).all()
    assert langid.gram_buckets("abc" * 1000, chunk=64).tolist() == langid.gram_buckets("abc" * 1000).tolist()


@TABLES
def test_quality_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op2_quality"](spark, SF).join(truth, "doc_id").where("held_out").collect()
    assert np.mean([r.quality == r.predicted for r in rows]) > 0.95


def test_gradient_by_differences():
    """Every weight's gradient against central differences of the mean log loss."""
    rng = np.random.default_rng(1)
    bags = [rng.normal(0, 1, (int(n), quality.N_FEATURES)) for n in rng.integers(1, 6, 5)]
    x, starts, y = np.concatenate(bags), np.cumsum([0, *[len(b) for b in bags[:-1]]]), np.array([1.0, 0, 1, 0, 0])
    w = {"encode": rng.normal(0, 0.1, (quality.N_FEATURES, 4)), "encode_bias": rng.normal(0, 1, 4), "tan": rng.normal(0, 1, (4, 3)), "gate": rng.normal(0, 1, (4, 3)), "attend": rng.normal(0, 1, 3), "out": rng.normal(0, 1, 4), "bias": rng.normal(0, 1, 1)}
    model = quality.AttentionModel(rng.normal(0, 0.1, quality.N_FEATURES), rng.uniform(0.5, 1, quality.N_FEATURES), w)

    def loss():
        p = model.forward(x, starts)["score"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = model.gradients(x, starts, y)
    assert set(grads) == set(w)
    for name, weights in w.items():
        flat, slope = weights.reshape(-1), np.asarray(grads[name]).reshape(-1)
        for k in range(0, len(flat), max(1, len(flat) // 40)):
            kept = flat[k]
            flat[k] = kept + 1e-5
            up = loss()
            flat[k] = kept - 1e-5
            down = loss()
            flat[k] = kept
            assert slope[k] == pytest.approx((up - down) / 2e-5, abs=1e-7, rel=1e-4)


def test_score_by_brute_force():
    """Attention and score of one document, passage by passage."""
    rng = np.random.default_rng(2)
    model = quality.fit([rng.normal(0, 1, (3, quality.N_FEATURES)).astype(np.float32) for _ in range(8)], np.arange(8) % 2.0, epochs=2)
    bag, w = rng.normal(0, 1, (5, quality.N_FEATURES)), model.weights
    e, hs = [], []
    for passage in bag:
        h = np.tanh(((passage - model.mean) * model.scale) @ w["encode"] + w["encode_bias"])
        e.append(float(sum(w["attend"][k] * np.tanh(h @ w["tan"][:, k]) / (1 + np.exp(-(h @ w["gate"][:, k]))) for k in range(len(w["attend"])))))
        hs.append(h)
    a = np.exp(e) / np.exp(e).sum()
    z = sum(x * h for x, h in zip(a, hs, strict=True))
    assert model.score([bag])[0] == pytest.approx(1 / (1 + np.exp(-(z @ w["out"] + w["bias"][0]))), abs=1e-5)


def test_quality_sample(spark):
    """The sample is bounded in passages; repeated keys and labels give the same model however rows are dealt."""
    rows = [(k, f"word{k} " * 200, "s") for k in range(30)] + [(3, "other text", "s"), (3, "third", "s")]
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)] + [(3, 0)], "doc_id long, quality int")
    models = [quality.train(documents(spark, rows).repartition(n), labels) for n in (1, 4)]
    assert all((models[0].weights[k] == models[1].weights[k]).all() for k in models[0].weights)
    seen, fit = [], quality.fit
    quality.fit = lambda bags, *a, **b: seen.append(sum(map(len, bags))) or fit(bags, *a, epochs=1, **b)
    try:
        quality.train(documents(spark, rows), labels, most_passages=20)
    finally:
        quality.fit = fit
    assert 15 <= seen[0] <= 20
    assert quality.rate(documents(spark, rows), quality.train(empty(spark), labels)).where("quality_score = 0.5").count() == len(rows)


def test_attention_learns():
    rng = np.random.default_rng(0)
    good = [rng.normal(0, 1, (3, quality.N_FEATURES)).astype(np.float32) for _ in range(40)]
    bad = [np.concatenate([g[:2], g[2:] + 3]) for g in good]  # one passage of three tells
    model = quality.fit(good + bad, np.array([1.0] * 40 + [0.0] * 40), epochs=30)
    scores = model.score(good + bad)
    assert (scores[:40] > 0.5).mean() > 0.95 and (scores[40:] < 0.5).mean() > 0.95
    x = np.concatenate(bad[:5])
    weights = model.forward(x, np.arange(0, 15, 3))["attention"]
    assert weights.reshape(5, 3).sum(axis=1) == pytest.approx(np.ones(5), rel=1e-5)


def test_quality_odd_rows(spark):
    df, rows = odd(spark)
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (77, 1), (3, None)], "doc_id long, quality int")
    out = quality.rate(df, quality.train(df, labels))
    assert out.columns == [*df.columns, "quality_score_"] and out.count() == len(rows)
    assert all(0 <= r.quality_score_ <= 1 for r in out.collect())
    assert quality.rate(empty(spark), quality.train(empty(spark), labels)).count() == 0
    long = ("word " * 3000).encode()
    assert np.allclose(quality.document_features(long.decode(), chunk=1024), quality.passage_features(long))


# --- fingerprints ---


def jaccard(a, b):
    a, b = (Counter(x.lower().split()) or Counter([""]) for x in (a, b))
    return sum((a & b).values()) / sum((a | b).values())


def test_fingerprints(spark):
    rng = np.random.default_rng(2)
    vocab = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(vocab[: 20 + 10 * (k % 25)], int(rng.integers(1, 200)))) for k in range(200)]
    rows = [(3 * k + 1, t, "s") for k, t in enumerate(texts)]
    out = {r.doc_id: r for r in fingerprint.fingerprints_with_next(documents(spark, rows).repartition(5), rows_each=17).collect()}
    far = []
    for k, (i, t, _) in enumerate(rows):
        nxt = texts[(k + 1) % len(texts)]
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        assert out[i].n_chars == len(t) and out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        far += [out[i].near_edited - jaccard(t, edited), out[i].near_next - jaccard(t, nxt)]
    assert abs(np.mean(far)) < 0.03 and np.std(far) < 0.09
    for k in range(len(rows) - 1):
        a, b = out[rows[k][0]].signature, out[rows[k + 1][0]].signature
        assert out[rows[k][0]].near_next == np.mean([x == y for x, y in zip(a, b, strict=True)])


def test_fingerprints_odd_rows(spark):
    df, rows = odd(spark)
    out = fingerprint.fingerprints_with_next(df, samples=8).collect()
    assert len(out) == len(rows)
    same = {tuple(r.signature) for r in out if r.n_chars == 5}
    assert len({tuple(r.signature) for r in out if r.doc_id == 5}) == 1 and len(same) == 2  # those of "a b c" and of "other"
    assert fingerprint.fingerprints_with_next(empty(spark), samples=8).count() == 0
    alone = fingerprint.fingerprints_with_next(documents(spark, [(1, "one text here", "s")]), samples=8).first()
    assert alone.near_next == 1.0


def plain_signature(text, samples):
    """Consistent weighted sampling written out: for each sample, the word and grid point of the least value."""
    r_table, c_table = fingerprint._tables()
    n = fingerprint.CELLS
    counts = Counter(text.lower().split()) or Counter([""])
    xx = lambda data, seed=42: xxhash.xxh64_intdigest(data, seed)
    out = []
    for k in range(samples):
        best = None
        for word, w in counts.items():
            h = xx((k % 2).to_bytes(4, "little"), xx((k // 2).to_bytes(4, "little"), xx(xx(word.encode()).to_bytes(8, "little"))))
            again = xx(h.to_bytes(8, "little"))

            def draw(table, bits, fine):
                top = bits >> 22
                at = n + 1 + (bits >> 16 & n - 1) if fine(top) else top
                part = (bits & 65535) / 65536 if fine(top) else (bits & 4194303) / 4194304
                return table[at] + (table[at + 1] - table[at]) * part

            r = draw(r_table, h & 0xFFFFFFFF, lambda top: top >= n - n // 64)
            c = draw(c_table, h >> 32, lambda top: top < n // 64)  # its logarithm
            b = (again >> 32) / 2**32
            t = int(np.floor(np.log(w) / r + b))
            value = int((c - r * (t - b) - r + 128) * 8388608), ((again & 0xFFFFFFFF) + t * 2654435761) & 0xFFFFFFFF
            best = value if best is None or value < best else best
        out.append(best[1])
    return out


def test_signature_written_out(spark):
    texts = ["the cat sat on the mat the end", "one", "", "a a a a b b c", "The CAT sat"]
    out = {r.doc_id: r for r in fingerprint.fingerprints_with_next(documents(spark, [(k, t, "s") for k, t in enumerate(texts)]), samples=32).collect()}
    for k, t in enumerate(texts):
        assert out[k].signature == plain_signature(t, 32)


def test_gamma_quantiles():
    p = np.array([0.01, 0.5, 0.99])
    x = fingerprint.gamma_quantiles(p)
    assert 1 - np.exp(-x) * (1 + x) == pytest.approx(p)


# --- SimHash ---


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_by_definition():
    for t in ("", None, "One", "one two", "A b C", "a b c d e f É x\x1cy", "\t\n", "A B c d " * 50):
        assert simhash.fingerprint(None if t is None else t.encode()) & (1 << 64) - 1 == plain_fingerprint(t)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 6])
def test_close_pairs(radius):
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2**63, 500).astype(np.uint64)
    fp[300:400] = fp[0] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    starts = np.where(np.arange(500) < 330, 0, 330)
    ends = np.where(np.arange(500) < 330, 330, 500)
    got = {p for i, j in simhash.close_pairs(fp, starts, ends, radius, chunk=100) for p in zip(i.tolist(), j.tolist(), strict=True)}
    d = np.bitwise_count(fp[:, None] ^ fp[None, :])
    assert got == {(i, j) for i, j in zip(*np.nonzero(d <= radius), strict=True) if i < j and starts[i] == starts[j]}


def brute_components(fps, radius=3):
    d = np.bitwise_count(fps[:, None] ^ fps[None, :])
    return simhash.hook(np.arange(len(fps)), *np.nonzero(d <= radius))


@pytest.mark.parametrize("most", [32768, 150])
def test_components(spark, most):
    """Random, near and chained fingerprints, with sets split or whole."""
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    near = base[0] ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64))
    chain = [base[1]]
    for k in range(20):
        chain.append(chain[-1] ^ np.uint64(0b111 << (3 * k)))
    fps = np.unique(np.concatenate([base, near, np.array(chain)]).view(np.int64))
    df = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    got = {r.node: r.root for r in simhash.components(simhash.link(df, 3, most)).collect()}
    labels = brute_components(fps.view(np.uint64))
    assert all(got.get(int(x), int(x)) == int(fps[labels[k]]) for k, x in enumerate(fps))


@TABLES
def test_simhash_query(spark):
    rows = QUERIES["op9_simhash"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    ids = sorted(texts)
    fps = np.array([plain_fingerprint(texts[i]) for i in ids], dtype=np.uint64)
    labels = brute_components(fps)
    for r in rows:
        k = ids.index(r.doc_id)
        assert r.fingerprint == f"{int(fps[k]):016x}" and r.component_id == ids[labels[k]]


def test_simhash_odd_rows(spark):
    df, rows = odd(spark)
    out = simhash.near_duplicates(df).collect()
    assert len(out) == len(rows)
    assert {r.component for r in out if r.fp == 0} == {2}
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.near_duplicates(documents(spark, [(None, "a", "s")])).first().component is None


# --- neighbours ---


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_nearest_exact(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    x[500:700] = x[0]  # ties
    df = vectors(spark, [(k, v.tolist()) for k, v in enumerate(x)])
    asked = df.where("vec_id % 50 = 0")
    out = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in vptree.nearest(df, asked, shard_rows=200, leaf=16).collect()}
    d = x.astype(float)
    for q in range(0, 900, 50):
        norms = np.sqrt(vptree.row_sums(d * d))
        score = vptree.row_sums(d * d[q]) / (norms * norms[q])
        best = sorted((k for k in range(900) if k != q), key=lambda k: (-score[k], k))[:5]
        assert [out[q, r + 1][0] for r in range(5)] == best
        assert [out[q, r + 1][1] for r in range(5)] == [score[k] for k in best]
    again = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in vptree.nearest(df, asked, shard_rows=90, leaf=16, sample=320, region_rows=50).collect()}
    assert again == out


def test_nearest_prunes_clusters(spark):
    """On clustered vectors queries go to few regions and meet few rows of them; factor 1 stays exact, more is measured."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(64, 16))
    x = centres[rng.integers(0, 64, 6000)] + 0.05 * rng.normal(size=(6000, 16))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    asked = np.arange(0, 6000, 50)
    cosine = unit[asked] @ unit.T
    cosine[np.arange(len(asked)), asked] = -2
    want = {int(q): set(np.argsort(-c)[:5].tolist()) for q, c in zip(asked, cosine, strict=True)}
    df = vectors(spark, [(k, v.tolist()) for k, v in enumerate(x)]).withColumn("embedding", F.col("embedding").cast("array<double>"))
    sent, recall = {}, {}
    for factor in (1.0, 3.0):
        seen, old = {}, vptree.materialize
        vptree.materialize = lambda df, name, seen=seen, old=old: seen.setdefault(name, old(df, name))
        try:
            got = vptree.nearest(df, df.where("vec_id % 50 = 0"), sample=1024, region_rows=200, factor=factor).collect()
        finally:
            vptree.materialize = old
        sent[factor] = seen["nearest-sent"].count()
        recall[factor] = np.mean([r.vec_id in want[r.query_id] for r in got])
        assert len(got) == 5 * len(asked)
    assert recall[1.0] == 1 and sent[1.0] < 0.5 * len(asked) * 15 and sent[3.0] <= sent[1.0] and recall[3.0] >= 0.9
    tree = vptree.VPTree(np.arange(6000), x, leaf=64)
    shares = [tree.search(asked, x[asked], 5, f).compared / (6000 * len(asked)) for f in (1.0, 2.0, 4.0)]
    assert shares[0] < 0.5 and shares == sorted(shares, reverse=True)


def test_nearest_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (7, [2.0, 0.0]), (7, [2.0, 0.0]), (8, [float("inf"), 1.0]), (50, [1.0, 1.0])]
    df = vectors(spark, rows).withColumns({"id": F.lit(1), "shard": F.lit(2), "dim": F.lit(3), "rank": F.lit(4)})
    out = vptree.nearest(df, df.where("vec_id % 50 = 0")).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [7, 7, 50, 50], 50: [0, 7, 7]}
    assert vptree.nearest(df.where("false"), df.where("false")).count() == 0


# --- queries and pipeline ---


@TABLES
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("conversations", "pages", "embeddings", "documents"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    out = con.execute(ORACLES[name])
    at = [[c[0] for c in out.description].index(n) for n in names]
    want = sorted(tuple(repr(r[k]) for k in at) for r in out.fetchall())
    assert sorted(tuple(repr(r[n]) for n in names) for r in df.collect()) == want


@TABLES
def test_pipeline(spark):
    """Stage by stage: what each keeps, and that the mix and the packing hold all of it."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality", "simhash_dedup", "mixing", "packing"]
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], sf).cache())
    start, lang, good, one, mixed, packed = seen
    assert all(x.columns == docs.columns for x in (lang, good, one, mixed))
    assert lang.count() >= 0.97 * start.count()
    dropped = {r.doc_id for r in lang.collect()} - {r.doc_id for r in good.collect()}
    known = [labels[i] for i in dropped if i in labels]
    assert known and np.mean(known) < 0.3
    texts = {r.doc_id: r.text for r in good.collect()}
    ids = sorted(texts)
    roots = brute_roots([texts[i] for i in ids])
    assert sorted(r.doc_id for r in one.collect()) == sorted({ids[k] for k in roots})
    words = lambda df: df.agg(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0]
    assert abs(words(mixed) - words(one)) < 0.02 * words(one)
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in one.collect()}
    assert packed.agg(F.sum("length")).first()[0] == sum(len(b) // 4 + 1 for b in (__import__("thicket.llm.packing", fromlist=["x"]).tokenizer(None).encode(r.text) for r in mixed.collect()))


def test_pipeline_language_stage(spark):
    """Texts of no known language and wrongly declared ones go; others stay, whatever their label."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {k: docs.where(F.col("lang") == k).orderBy("doc_id").first().text for k in ("en", "de")}
    rows = [(-1, text["en"], "de"), (-2, text["en"], None), (-3, text["de"], "xx"), (-4, "½ 12", "en"), (-5, None, None), (-6, "これは日本語の文章です。" * 20, "en"), (-7, "xkcd qwrtz plmkn bvcxz jjjw vvvq kkkx " * 9, None), (-8, text["en"], "en")]
    more = spark.createDataFrame([(i, t, y, "s", 0) for i, t, y in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumn("language", F.lit(1))
    given = docs.withColumn("language", F.lit(1)).unionByName(more, allowMissingColumns=True).select(*more.columns)
    kept = corpus_pipeline.language_id(spark, given, SF)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert kept.columns == given.columns and {i for i in ids if i < 0} == {-2, -3, -8}
    assert len([i for i in ids if i >= 0]) >= 0.985 * docs.count()


def test_pipeline_odd_rows(spark, tmp_path):
    """Each stage on nulls, empty and long texts, repeated rows, clashing names and no rows."""
    df, rows = odd(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (None, 1)], "doc_id long, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, str(tmp_path))
        assert name == "packing" or out.columns == df.columns
        found = sorted(str(r.doc_id) for r in out.collect())
        if name == "simhash_dedup":
            assert found == ["1", "1", "2", "4", "None"]  # "a b c", "other", the empty ones, the long one, "x y"
        elif name == "mixing":
            assert set(found) <= {"1", "4", "5", "None"} and all(r.text.split() for r in out.collect())
        elif name == "packing":
            assert set(found) == {str(r[0]) for r in rows}
        else:
            assert "4" in found and (name == "quality" or "2" not in found and "6" not in found)  # texts without a letter have no language
        assert stage(spark, df.where("false"), str(tmp_path)).count() == 0
    assert corpus_pipeline.quality_filter(spark, df, str(tmp_path)).columns == df.columns
