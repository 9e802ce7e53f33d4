"""Chats, archives, sharding, mixing and packing: round trips, brute force, and odd rows."""

import hashlib
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from thicket.llm import chat, mixing, packing, sharding, warc
from thicket.llm.common import fresh_path, materialize

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)


def odd(spark):
    """Nulls everywhere, empty, long, tied and repeated rows, and columns whose names clash with added ones."""
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, None, None), (None, "x y", "s"), (3, "", "t"), (4, "word " * 60000, "t"), (5, "a b c", "s"), (None, None, None), (1, "other", "s"), (6, " \t\n", "é")]
    extra = {c: F.lit(7) for c in ("shard", "slot", "row_bytes", "h__", "bucket", "extra", "key", "mix_h", "kept_key", "lang_pred", "quality_score", "size", "at", "fp", "part", "open")}
    return documents(spark, rows).withColumns(extra), rows


def empty(spark):
    return documents(spark, [(1, "a", "s")]).where("false")


# --- chats ---

TURNS = "conv_id long, turn long, role string, text string"


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant\nok", "\\", "\\<|", "<\\|im_end|>", "", "<", "|>", "<|", "é\n\\n", "a" * 100000]
    rows = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(nasty)]
    rows += [(2, 0, "user\n<|x", None), (None, 0, "user", "q"), (None, 1, "assistant", "a"), (3, None, None, None), (4, 1, "user", "tie"), (4, 1, "assistant", "tie"), (4, 1, "user", "tie")]
    df = spark.createDataFrame(rows, TURNS).withColumns({"turns": F.lit(1), "segments": F.lit(2)})
    out = {r.conv_id: r for r in chat.format_chats(df).withColumns({"back": chat.parse_turns(F.col("formatted")), "loss": chat.loss_text(F.col("segments"))}).collect()}
    assert [(t.role, t.text) for t in out[1].back] == [(r[2], r[3]) for r in rows[:10]]
    assert out[1].loss == "".join(t for t in nasty[1::2]) and out[1].valid and out[1].complete
    assert [(t.role, t.text) for t in out[2].back] == [("user\n<|x", "")] and not out[2].valid
    assert out[None].complete and not out[3].valid
    assert [t.role for t in out[4].back] == ["assistant", "user", "user"] and out[4].n_turns == 3
    assert "".join(s.text for s in out[1].segments) == out[1].formatted
    assert chat.format_chats(df.where("false")).count() == 0


def test_chat_states(spark):
    orders = {"system user assistant": (True, True), "user": (True, False), "assistant": (False, False), "user assistant tool assistant": (True, True), "user user": (False, False), "system": (True, False)}
    rows = [(k, t, r, "x") for k, o in enumerate(orders) for t, r in enumerate(o.split())]
    got = {r.conv_id: (r.valid, r.complete) for r in chat.format_chats(spark.createDataFrame(rows, TURNS)).collect()}
    assert [got[k] for k in range(len(orders))] == list(orders.values())


# --- archives ---


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_warc_round_trip(spark):
    long, big = "é" * 50000, "z" * 1000
    rows = [(1, "http://a", "<p>\r\n\r\nWARC/1.1\r\n"), (2, None, None), (3, "x y\n", long), (4, "u", big), (7, "u", big), (5, "v", big), (6, "w", "z" * 999), (8, "w", "z" * 999), (None, "n", "null id"), (9, "d", "d"), (9, "d", "d")]
    path = fresh_path(spark, "t-warc")
    warc.write_warc(pages(spark, rows).withColumn("digest", F.lit(1)), path, segment_bytes=700, chunk_bytes=256)
    out = warc.resolve_revisits(warc.read_warc(spark, path)).collect()
    assert len(out) == len(rows) and all(r.problem is None for r in out)
    got = defaultdict(list)
    for r in out:
        got[r.page_id].append(r)
    for i, _, html in rows:
        data = (html or "").encode()
        for r in got[i]:
            assert r.payload_bytes == len(data) and r.digest == hashlib.sha1(data).hexdigest()
            assert r.payload is None if r.type == "revisit" else bytes(r.payload) == data
    assert {i: (got[i][0].type, got[i][0].refers_to) for i in (4, 5, 7, 6, 8)} == {4: ("revisit", 7), 5: ("revisit", 7), 7: ("response", None), 6: ("response", None), 8: ("response", None)}


def test_warc_ties_and_empty(spark):
    path = fresh_path(spark, "t-warc")
    warc.write_warc(pages(spark, [(1, "u", "y" * 2000)] * 3), path)
    types = sorted(r.type for r in warc.read_warc(spark, path).collect())
    assert types == ["response", "revisit", "revisit"]
    none = fresh_path(spark, "t-warc")
    warc.write_warc(pages(spark, [(1, "u", "y")]).where("false"), none)
    assert warc.read_warc(spark, none).count() == 0


def test_warc_whatever_the_split(spark, tmp_path):
    """Copies find their response though the second scan is split otherwise than the first."""
    rows = [(k, f"u{k}", f"{k % 20} " * 700) for k in range(200)] + [(900, "u", "r" * 1500)] * 7 + [(None, None, "n" * 1500)] * 2
    pages(spark, rows).repartition(9).write.parquet(str(tmp_path / "pages"))
    path, splits = fresh_path(spark, "t-warc"), []

    def split_otherwise(df, name):
        out = materialize(df, name)
        splits.append(spark.read.parquet(str(tmp_path / "pages")).rdd.getNumPartitions())
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        splits.append(spark.read.parquet(str(tmp_path / "pages")).rdd.getNumPartitions())
        return out

    old, warc.materialize = warc.materialize, split_otherwise
    try:
        warc.write_warc(spark.read.parquet(str(tmp_path / "pages")), path)
    finally:
        warc.materialize = old
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert splits[0] != splits[1]
    out = warc.resolve_revisits(warc.sound(warc.read_warc(spark, path))).collect()
    assert len(out) == len({r.id for r in out}) == len(rows)
    kinds = lambda some: [sum(r.type == t for r in some) for t in ("response", "revisit")]
    plain = [r for r in out if r.page_id is not None and r.page_id < 200]
    assert kinds(plain) == [20, 180] and all(r.refers_to == 180 + r.page_id % 20 for r in plain if r.type == "revisit")
    assert kinds([r for r in out if r.page_id == 900]) == [1, 6] and kinds([r for r in out if r.page_id is None]) == [1, 1]
    assert all(r.payload is not None for r in out if r.type == "response")


def test_warc_problems(spark):
    path = fresh_path(spark, "t-warc")
    records = warc.warc_records(pages(spark, [(1, "u", "q" * 5000)]), segment_bytes=1000)
    lost = records.where(~F.col("record").contains("WARC-Segment-Number: 3\r"))
    lost.write.option("lineSep", "\r\n\r\n").text(path)
    assert warc.read_warc(spark, path).first().problem == "segments are missing"
    with pytest.raises(Exception, match="segments are missing"):
        warc.sound(warc.read_warc(spark, path)).collect()
    with pytest.raises(ValueError):
        warc.dechunk(b"5\r\nabc")
    assert warc.dechunk(b"3\r\nabc\r\n0\r\n\r\n") == b"abc"


# --- shards ---


def check_shards(rows, n):
    by = defaultdict(list)
    for r in rows:
        by[r["s"]].append(r["l"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(n))


def test_sharding(spark):
    rng = np.random.default_rng(4)
    rows = [(int(k), "w " * int(n), "s") for k, n in enumerate(rng.integers(0, 400, 3000))] + [(3000 + k, "hot text " * 20, "s") for k in range(1500)]
    out = sharding.shard_by_bytes(documents(spark, rows), n_shards=20, bucket_bytes=5000).select(F.col("shard").alias("s"), F.col("slot").alias("l"), "row_bytes", "doc_id", "text").collect()
    assert sorted(r.doc_id for r in out) == list(range(4500))
    check_shards(out, 20)
    sums = defaultdict(int)
    for r in out:
        sums[r.s] += r.row_bytes
        assert r.row_bytes == len(r.text.encode()) + 16
    mean = sum(sums.values()) / 20
    assert len(sums) == 20 and max(abs(x - mean) for x in sums.values()) < 0.08 * mean


def test_sharding_odd_rows(spark):
    df, rows = odd(spark)
    out = sharding.shard_by_bytes(df, n_shards=5)
    got = out.select(F.col("shard_").alias("s"), F.col("slot_").alias("l"), "shard", "row_bytes_").collect()
    assert len(got) == len(rows) and {r.shard for r in got} == {7}
    check_shards(got, 5)
    assert sharding.shard_by_bytes(empty(spark)).count() == 0
    assert sharding.shard_by_bytes(documents(spark, [(1, "a", "s")])).first().slot == 0


def test_sharding_equal_rows(spark):
    """400 rows alike in text and id among 500: shards are as even as rows allow."""
    rows = [(7, "the same text", "s")] * 400 + [(100 + k, f"text number {k}", "s") for k in range(100)]
    out = sharding.shard_by_bytes(documents(spark, rows).repartition(4), n_shards=10).select(F.col("shard").alias("s"), F.col("slot").alias("l"), "row_bytes").collect()
    assert len(out) == 500
    check_shards(out, 10)
    sums = [sum(r.row_bytes for r in out if r.s == k) for k in range(10)]
    assert max(sums) - min(sums) <= 3 * max(r.row_bytes for r in out)


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_splitters_against_a_sorted_list(spark, parts):
    rng = np.random.default_rng(parts)
    rows = [(int(h), int(i), 0, int(s)) for h, i, s in zip(rng.integers(-5, 5, 900) * 2**60, rng.integers(-3, 60, 900), rng.integers(1, 200, 900), strict=True)]
    found, before, alike = sharding.splitters(spark.createDataFrame(rows, "h long, i long, r long, size long"), parts, 0.0, 5)
    line = sorted(r[:3] for r in rows)
    assert len(found) == parts - 1 and before == [sum(x < cut for x in line) for cut in found]
    total, below = sum(r[3] for r in rows), 0
    edges = [0]
    for key in sorted(set(line)):
        below += sum(r[3] for r in rows if r[:3] == key)
        edges.append(below)
    for k, cut in enumerate(found, 1):
        target, got = total * k / parts, sum(r[3] for r in rows if r[:3] < cut)
        assert abs(got - target) == pytest.approx(min(abs(e - target) for e in edges))
    assert not alike or len(set(line)) < len(line)


# --- mixing ---


def test_targets():
    assert mixing.targets([100, 100], [1, 3], 200) == [50, 150]
    got = mixing.targets([10, 100, 890], [10, 1, 1], 1000)
    assert got[0] == 30 and sum(got) == pytest.approx(1000) and got[1] == 300 and got[2] == pytest.approx(670)
    assert mixing.targets([0, 0], [1, 2], 0) == [0, 0] and mixing.targets([], [], 0) == []


def test_permutation_and_counts():
    for n in (1, 2, 3, 17, 1000):
        p = mixing.permute(np.arange(n), np.full(n, n), np.full(n, 9))
        assert sorted(p) == list(range(n))
    owed = np.array([5, 0, 900, 70_000])
    counts = mixing.ShardCounts(owed, 64, 1)
    found = [counts.of(k) for k in range(counts.shards)]
    drawn = np.array([inside for _, inside in found])
    assert drawn.sum(axis=0).tolist() == owed.tolist() and set(drawn.sum(axis=1)[:-1]) == {64}
    assert np.array_equal(np.array([before for before, _ in found]), np.cumsum(drawn, axis=0) - drawn)
    for k in (700, 3, counts.shards - 1):  # any shard by itself
        assert all(np.array_equal(a, b) for a, b in zip(mixing.ShardCounts(owed, 64, 1).of(k), found[k], strict=True))
    assert abs(drawn[:, 2].mean() - 64 * 900 / owed.sum()) < 0.1 and drawn[:, 2].std() < 2
    assert mixing.ShardCounts(np.zeros(0), 64, 1).shards == 0
    huge = mixing.ShardCounts(np.array([10**12, 3 * 10**12]), 4096, 1)  # as many blocks as 100 TB have, and more
    before, inside = huge.of(huge.shards // 3)
    assert inside.sum() == 4096 and abs(before[0] / before.sum() - 0.25) < 0.001


def test_mixing_against_brute_force(spark):
    rng = np.random.default_rng(6)
    names = ["a", "b", "é", None]
    rows = [(k, "w " * int(n), names[min(3, k % 7)]) for k, n in enumerate(rng.integers(0, 300, 800))]
    df = documents(spark, rows)
    mixed = mixing.mix(df, rows_each=50, shard_blocks=32)
    got = {r.doc: r for r in mixing.taken_words(mixed).collect()}
    again = {r.doc: r.taken for r in mixing.taken_words(mixing.mix(df.repartition(3), rows_each=50, shard_blocks=32)).collect()}
    assert {k: r.taken for k, r in got.items()} == again
    sizes, taken = defaultdict(int), defaultdict(int)
    for k, t, s in rows:
        n = len(t.split())
        assert got[k].size == n and got[k].taken <= 3 * n
        sizes[s] += n
        taken[s] += got[k].taken
    order = ["a", "b", "é", None]
    aims = mixing.targets([sizes[s] for s in order], [1, 2, 3, 1], sum(sizes.values()))
    for s, a in zip(order, aims, strict=True):
        assert abs(taken[s] - a) <= 2 * 128 and got[next(k for k, _, x in rows if x == s)].target == a
    # every span from the slots themselves, one by one
    pieces = defaultdict(list)
    for p in mixed.pieces.collect():
        pieces[p.source_no, p.block].append(p)
    by = defaultdict(int)
    for s in mixed.slots.collect():
        for p in pieces[s.source_no, s.block]:
            by[p.doc_row] += p.words
    assert {r.doc: by.get(r.doc_row, 0) for r in mixed.documents.collect()} == {k: r.taken for k, r in got.items()}


def test_small_sources_meet_their_targets(spark):
    """Forty sources of about 200 words, and one of 30 000."""
    rng = np.random.default_rng(3)
    rows = [(100 * k + i, " ".join(["w"] * int(n)), f"s{k:02}") for k in range(40) for i, n in enumerate(rng.integers(1, 80, 5))]
    rows += [(9000 + i, "x " * 300, "t") for i in range(100)]
    out = mixing.taken_words(mixing.mix(documents(spark, rows))).collect()
    taken, aims = defaultdict(int), {}
    for r in out:
        taken[r.source_no] += r.taken
        aims[r.source_no] = r.target
        assert r.taken <= 3 * r.size
    assert len(aims) == 41 and all(abs(taken[k] - a) <= 0.05 * a for k, a in aims.items())


def test_mixing_odd_rows(spark):
    df, rows = odd(spark)
    out = mixing.taken_words(mixing.mix(df)).collect()
    assert len(out) == len(rows) and all(r.taken <= 3 * r.size for r in out)
    docs = mixing.mix_documents(df)
    assert docs.columns == df.columns and docs.count() > 0
    many = [(1, "a b c", "s")] * 300 + [(1, "a b c", "t")] * 3 + [(None, "d e", None)] * 200
    mixed = mixing.taken_words(mixing.mix(documents(spark, many), rows_each=10)).collect()
    assert len(mixed) == 503 and sum(r.taken for r in mixed) > 0 and len({r.doc_row for r in mixed}) == 503
    assert {r.source for r in mixing.mix_documents(documents(spark, many)).collect()} == {"s", "t", None}
    assert all(r.text for r in docs.select("text").collect())
    assert mixing.taken_words(mixing.mix(empty(spark))).count() == 0 and mixing.mix_documents(empty(spark)).count() == 0


# --- packing ---


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = np.random.default_rng(8)
    vocab = ["alpha", "Beta,", "gamma.", "don't", "x1y", "É", "İx", "Σας", "a..b", "\x1c", "<|endoftext|>", "ﬁ", "é"]
    rows = [(k, " ".join(rng.choice(vocab, int(n))), "s") for k, n in enumerate([0, 1, 3, 20000, *rng.integers(1, 900, 60)])]
    out = packing.pack(documents(spark, rows).repartition(6), fan_in=2, windows=3).collect()
    want = {k: [*model.encode(t, add_special_tokens=False).ids, 2] for k, t, _ in rows}
    got, fill = defaultdict(dict), defaultdict(list)
    for p in out:
        ids = np.frombuffer(bytes(p.ids), dtype="<u4")
        assert len(ids) == p.length and p.doc_tokens == len(want[p.doc_id])
        for j, x in enumerate(ids):
            assert got[p.doc_id].setdefault(p.start + j, int(x)) == int(x)
        fill[p.sequence_id].append((p.offset, p.length))
    assert {k: [v[j] for j in range(len(v))] for k, v in got.items()} == want
    totals = []
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
        totals.append(at)
    assert sum(t < 4096 - 16 for t in totals) <= 1


def test_special_strings():
    """As an untouched tokenizer reads them; as text where asked for."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, text = Tokenizer.from_file(path), "hello <|endoftext|> world, <|startoftext|>x<|endoftext|>! <|ENDOFTEXT|>"
    ids = np.frombuffer(packing.tokenizer(None).encode(text), "<u4").tolist()
    assert ids == plain.encode(text, add_special_tokens=False).ids and 49407 in ids
    plain.encode_special_tokens = True
    assert np.frombuffer(packing.tokenizer(None, True).encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_long_document_is_linear():
    ids, packer = np.arange(16_000_001, dtype="<u4").tobytes(), packing.Packer(4096, 3, 16)
    began = time.time()
    packer.add(1, 0, ids, len(ids) // 4)
    full, last = packing.pour([*packer.taken(), *packer.left()], 4096)
    assert time.time() - began < 5 and len(full) == 16_000_001 // 4096 and len(last[0][2]) == 4 * (16_000_001 % 4096)
    assert b"".join(p[2] for w in full + [last] for p in w) == ids


def test_packing_odd_rows(spark):
    df, rows = odd(spark)
    out = packing.pack(df).collect()
    assert sum(p.length for p in out if p.doc_id is None) == sum(len(packing.tokenizer(None).encode(t or "")) // 4 + 1 for i, t, _ in rows if i is None)
    assert packing.pack(empty(spark)).count() == 0
    assert zlib.crc32(bytes(packing.pack(documents(spark, [(1, None, None)])).first().ids)) == zlib.crc32(np.array([2], "<u4").tobytes())
