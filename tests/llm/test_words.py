"""License scans, token alignment and spelling variants: brute force, and odd rows."""

import hashlib
import itertools
import random
import re
import re._parser as parser
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from thicket.llm import alignment, licenses, variants

from .test_formats import documents, empty, odd

# --- licenses ---


def expanded(tree, most=4000):
    """Texts that a pattern matches: every choice, least and next repeats."""
    out = [""]
    for op, value in tree:
        op = str(op)
        if op == "LITERAL":
            new = [chr(value)]
        elif op == "NOT_LITERAL":
            new = ["zz"]
        elif op == "SUBPATTERN":
            new = expanded(value[3])
        elif op == "BRANCH":
            new = [t for branch in value[1] for t in expanded(branch)]
        elif op == "MAX_REPEAT":
            low, high, sub = value
            new = ["".join(x) for n in {low, min(high, low + 1)} for x in itertools.product(expanded(sub), repeat=n)]
        else:
            new = [chr(v) for kind, v in value if str(kind) == "LITERAL"]
        out = [a + b for a in out for b in new][:most]
    return out


def test_rules_are_found_by_their_keywords():
    rules = licenses.parse_rules()
    assert len(rules) > 300
    for r in rules:
        for t in expanded(parser.parse(r.pattern)):
            words = re.findall("/([^ ]+) ", t)
            assert re.fullmatch(r.pattern, t) and all(set(words) & set(k) for k in r.keywords), (r, t)
            n, found = licenses.detect(" ".join(words).upper().encode())
            assert n == len(words)
            assert any(a == 0 and b == n and x.priority >= r.priority for a, b, x in found), (r.label, t, [(a, b, x.label) for a, b, x in found])


def brute_detect(text):
    """Every rule at every word, by words; who lies in whom, pair by pair."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    marked = "".join(f"/{w} " for w in words)
    spans = []
    for r in licenses.parse_rules():
        for m in re.finditer(r.pattern, marked):
            first = marked[: m.start()].count("/")
            spans.append((first, first + m[0].count("/"), r))

    def beats(y, x):
        inside = y[0] <= x[0] and y[1] >= x[1]
        wider = y[0] < x[0] or y[1] > x[1]
        return inside and (y[2].priority > x[2].priority or y[2].priority == x[2].priority and (wider or y[2].number < x[2].number))

    return len(words), sorted((x[0], x[1], x[2].number) for x in spans if x[2].base or not any(beats(y, x) for y in spans))


def test_scan_against_brute_force(spark):
    rng, said = random.Random(3), []
    phrases = [" ".join(re.findall("/([^ ]+) ", rng.choice(expanded(parser.parse(r.pattern))))) for r in licenses.parse_rules()]
    for _ in range(60):
        parts = [rng.choice([rng.choice(phrases), "and the or", "GNU (General) public-license!", "cc by cc by", "mit mit license license", "é licenseé", "2.0"]) for _ in range(rng.randint(0, 12))]
        said.append(rng.choice([" ", "\n", ", "]).join(parts))
    said += [None, "", "mit license" * 3, "MIT LICENSE mit-license MIT\x00LICENSE"]
    df = documents(spark, [(k, t, "s") for k, t in enumerate(said)])
    for r in licenses.scan(df, name="found").collect():
        n, want = brute_detect(said[r.doc_id])
        assert r.found.n_words == n and sorted((d.first, d.last + 1, d.rule) for d in r.found.detections) == want


def test_scan_odd_rows(spark):
    df, rows = odd(spark)
    out = licenses.scan(df, name="found")
    assert out.columns == [*df.columns, "found"] and out.count() == len(rows)
    got = {(r.doc_id, r.text): r.found for r in out.collect()}
    assert got[2, None].n_words == 0 and got[2, None].detections == [] and got[4, "word " * 60000].n_words == 60000
    assert licenses.scan(empty(spark)).count() == 0


def test_many_detections_are_linear():
    text = b"released under the MIT License, " * 60_000
    began = time.time()
    n, found = licenses.detect(text)
    assert n == 300_000 and len(found) == 120_000 and time.time() - began < 20


# --- alignment ---

TEXTS = [
    "Hello, world! It's a  test.\n\n\tindented\r\n ends ", "a", " ", "\n", "é ñ 日本語 テキスト", "<|endoftext|> </s> <s> <0x0A>", "a▁b", "x\u0000y", "1 23 456.7", "🎉 👨‍👩‍👧 ok", "a\x1c b!\x1c", "a \r\n b;\r\nc",
    "the quick brown fox jumps over the lazy dog", "the quick brown fox", "THE the The", "nowhitespace" * 200, "  x", "x  ", "don't we'll I'm", None, "", "the quick brown fox",
]


def brute_tokens(text):
    """Tokens of both with their bytes, whole texts at once."""
    with_ = alignment.aligner()
    if not text:
        return None
    a, b = with_.a.encode(" " + text, add_special_tokens=False).ids, with_.b.encode(text)
    bytes_a, bytes_b = [with_.bytes_a[k] for k in a], [with_.bytes_b[k] for k in b]
    whole = (" " + text).encode()
    return (a, b, bytes_a, bytes_b) if b"".join(bytes_a) == whole == b"".join(bytes_b) else None


def brute_align(text):
    found = brute_tokens(text)
    if found is None:
        return None
    a, b, bytes_a, bytes_b = found
    spans = [[(sum(map(len, x[:k])), sum(map(len, x[: k + 1]))) for k in range(len(x))] for x in (bytes_a, bytes_b)]
    links = [(a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (p, q) in enumerate(spans[1]) if max(s, p) < min(e, q)]
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups = [[[x[k] for k, (s, e) in enumerate(sp) if lo <= s and e <= hi] for x, sp in zip((a, b), spans, strict=True)] for lo, hi in zip([0, *cuts], cuts, strict=False)]
    return len(a), len(b), groups, links


@pytest.mark.parametrize("block", [1 << 22, 40])
def test_alignment_against_brute_force(spark, block):
    rng = random.Random(7)
    texts = TEXTS + ["".join(rng.choice(" \n\tab.é1'!\x1c\r;)the") for _ in range(rng.randint(1, 60))) for _ in range(150)]
    want = [brute_align(t) for t in texts]
    holds, most = Counter(), defaultdict(int)
    for x in want:
        holds.update(set(x[3]) if x else ())
    for (a, _), n in holds.items():
        most[a] = max(most[a], n)
    df = documents(spark, [(k, t, "s") for k, t in enumerate(texts)]).repartition(3)
    got = {r.doc_id: r for r in alignment.align(df, block=block).collect()}
    assert len(got) == len(texts) and want[6] is None
    for k, x in enumerate(want):
        if x is None:
            assert got[k][1:] == (0, 0, 0, 0, 0, 0, "")
            continue
        n_a, n_b, groups, links = x
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        best = sum(holds[p] == most[p[0]] for p in links)
        assert got[k][1:] == (n_a, n_b, len(groups), len(links), best, sum(holds[p] for p in links), hashlib.sha256(text.encode()).hexdigest()), texts[k]


def test_groups(spark):
    df = documents(spark, [(k, t, "s") for k, t in enumerate(TEXTS)])
    for r in alignment.groups(df).collect():
        want = brute_align(r.text)
        assert r.groups == want if want is None else [[g.a, g.b] for g in r.groups] == want[2]


def test_interval_index():
    rng = np.random.default_rng(2)
    for _ in range(50):
        starts, at = rng.integers(0, 60, 20), rng.integers(0, 60, 15)
        ends, till = starts + rng.integers(1, 12, 20), at + rng.integers(1, 12, 15)  # intervals that overlap each other
        index = alignment.IntervalIndex(starts, ends)
        got = sorted(zip(*(x.tolist() for x in index.overlaps(at, till)), strict=True))
        assert got == [(i, j) for i in range(15) for j in range(20) if max(at[i], starts[j]) < min(till[i], ends[j])]


def test_alignment_odd_rows(spark):
    df, rows = odd(spark)
    out = alignment.align(df).collect()
    assert len(out) == len(rows) and sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows)
    one = [r for r in out if r.doc_id == 1 and r.n_groups == 3]
    assert len(one) == 2 and one[0] == one[1]
    assert alignment.align(empty(spark)).count() == 0


# --- variants ---


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute_variants(counts, ratio=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    forms = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v.encode()), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), counts[forms[w]] if forms[w] else None))
    return sorted(out)


def test_variants_against_brute_force(spark):
    rng, counts = random.Random(5), {}
    for size in (7, 8, 9, 12, 30):
        for _ in range(30):
            word = "".join(rng.choice("abé") for _ in range(size)) if rng.random() < 0.5 else "an" * (size // 2) + rng.choice("xyz")
            for _ in range(6):
                counts[word] = rng.choice([2, 3, 20, 25, 200, 250, 2500])
                k = rng.randrange(len(word))
                word = rng.choice([word[:k] + rng.choice("abéz") + word[k:], word[:k] + word[k + 1 :], word[:k] + rng.choice("abéz") + word[k + 1 :]])
                if len(word) < 7:
                    break
    out = variants.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3))
    assert sorted(tuple(r) for r in out.collect()) == brute_variants(counts)


def test_rare_bigrams_meet():
    """Every two words one edit apart share a key, whatever the order of bigrams."""
    rng = random.Random(6)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(2, 12)))
        k, c = rng.randrange(len(a) + 1), rng.choice("abc")
        b = rng.choice([a[:k] + c + a[k:], a[:k] + c + a[k + 1 :]])
        grams = {w[k : k + 2] for w in (a, b) for k in range(len(w) - 1)}
        ranks = dict(zip(rng.sample(sorted(grams), len(grams)), range(len(grams)), strict=True))
        if a == b or not one_edit(a, b) or min(len(a), len(b)) < 4:
            continue
        (own_a, long_a), (own_b, long_b) = variants.meeting_keys(a, ranks), variants.meeting_keys(b, ranks)
        assert set(own_a) & set(own_b) if len(a) == len(b) else set(own_a) & set(long_b) or set(own_b) & set(long_a), (a, b)


def test_word_counts(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["Straßen", "ÀÉÎÕÜÀÉ", "letters7", "abcdefgh", "ABCDEFGH", "short", "x×÷yzab"]) for _ in range(400)) for _ in range(20)]
    want: Counter = Counter()
    for k, t in enumerate(texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{k}:{run}".encode())
            run = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            want[run] += len(run) >= 7
    got = variants.word_counts(documents(spark, [(k, t, "s") for k, t in enumerate(texts)]), drop=31)
    assert {r.word: r.n for r in got.collect()} == {w: n for w, n in want.items() if n >= 2}


def test_variants_odd_rows(spark):
    df, _ = odd(spark)
    assert variants.group_variants(variants.word_counts(df)).count() == 0
    twice = documents(spark, [(None, "letters LETTERS", "s"), (1, None, "s"), (1, "lettters lettters", "s"), (1, "lettters lettters", "s")])
    rows = sorted(tuple(r) for r in variants.group_variants(variants.word_counts(twice), ratio=2).collect())
    assert rows == [("letters", "lettters", "lettters", 2, 1, 4), ("lettters", None, "lettters", 4, 1, None)]
    assert variants.group_variants(variants.word_counts(empty(spark))).count() == 0
