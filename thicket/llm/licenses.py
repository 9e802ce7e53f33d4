"""License scans: ordered signature rules over words, gated by keywords, overlaps resolved by priority and containment.

A text's words (letters, digits and all that is not ASCII, A-Z lowered) are written as ``/word ...`` each, so that a rule
is an ordinary regular expression whose matches begin and end with words. A rule is tried only where its keywords occur.
A detection falls if it lies inside one of its priority or a higher one (of like spans and priorities, the first rule's
stays). Base phrases always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name
from .license_rules import KINDS, RULES

# To lower case, and every byte that is no part of a word to a blank.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
FOUND = "struct<n_words:long,detections:array<struct<label:string,rule:int,base:boolean,first:long,last:long,score:double>>>"


class Rule(NamedTuple):
    number: int
    kind: str
    label: str
    keywords: tuple[tuple[str, ...], ...]  # a word of each is in every text that the rule matches
    pattern: str  # over words as ``/word ``

    @property
    def base(self) -> bool:
        return self.kind == "B"

    @property
    def priority(self) -> int:
        return KINDS[self.kind][0]

    @property
    def score(self) -> float:
        return KINDS[self.kind][1]


def over_words(pattern: str) -> str:
    """A pattern whose letters are words as one over ``/word /word ``; it has neither captures nor looks around."""
    put = {"(": "(?:", "~": "(?:/[^ ]+ )", " ": ""}
    parts = re.findall(r"\{[\d,]+\}|[a-z0-9]+|.", pattern)
    return "".join(p if p[0] == "{" else f"(?:/{p} )" if p[0].isalnum() else put.get(p, p) for p in parts)


@cache
def parse_rules(text: str = RULES) -> tuple[Rule, ...]:
    lines = [line.split(None, 3) for line in text.splitlines() if line.strip()]
    return tuple(Rule(k, kind, label, tuple(tuple(k.split("/")) for k in keywords.split("+")), over_words(pattern)) for k, (kind, label, keywords, pattern) in enumerate(lines))


@cache
def _gates(text: str) -> tuple[frozenset[bytes], list[tuple[list[set[bytes]], Rule, re.Pattern]]]:
    """All keywords; rules, compiled, with the keywords that each needs."""
    rules = [([{w.encode() for w in k} for k in r.keywords], r, re.compile(r.pattern.encode())) for r in parse_rules(text)]
    return frozenset().union(*(k for needs, _, _ in rules for k in needs)), rules


def resolve(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections (first word, word behind the last, rule) that stay, in order of place."""
    ends, kept = dict.fromkeys(sorted({p for p, _ in KINDS.values()}), -1), []  # by priority: how far those of it or above reach
    for first, end, rule in sorted(found, key=lambda x: (x[0], -x[1], -x[2].priority, x[2].number)):
        if ends[rule.priority] < end or rule.base:
            kept.append((first, end, rule))
        for p in ends:
            if p <= rule.priority:
                ends[p] = max(ends[p], end)
    return kept


def detect(text: bytes | None, rules: str = RULES) -> tuple[int, list[tuple[int, int, Rule]]]:
    """Number of words, and the detections that stay."""
    words = (text or b"").translate(WORDS).split()
    keywords, gated = _gates(rules)
    has = keywords.intersection(words)
    tried = [(rule, pattern) for needs, rule, pattern in gated if all(k & has for k in needs)] if has else []
    if not tried:
        return len(words), []
    marked = b"/" + b" /".join(words) + b" " if words else b""
    spans = sorted((m.start(), m.end(), rule.number, rule) for rule, pattern in tried for m in pattern.finditer(marked))
    found, at, before = [], 0, 0
    for start, end, _, rule in spans:  # words are counted on from one span to the next
        before, at = before + marked.count(b"/", at, start), start
        found.append((before, before + marked.count(b"/", start, end), rule))
    return len(words), resolve(found)


def _scan(rules: str):
    kind = pa.struct([("n_words", pa.int64()), ("detections", pa.list_(pa.struct([("label", pa.string()), ("rule", pa.int32()), ("base", pa.bool_()), ("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())])))])

    @F.arrow_udf(FOUND)
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            n, found = detect(text.as_py(), rules)
            out.append({"n_words": n, "detections": [{"label": r.label, "rule": r.number, "base": r.base, "first": a, "last": b - 1, "score": r.score} for a, b, r in found]})
        return pa.array(out, kind)

    return run


def scan(df: DataFrame, text: str = "text", name: str = "licenses", rules: str = RULES) -> DataFrame:
    """``df`` with ``name``: a struct of ``n_words`` and ``detections`` (label, rule, base, first and last word from 0, score),
    by place.

    Null texts are empty. Rows stay as they are, repeated ones too; a column of ``df`` called ``name`` is refused by
    Spark as ambiguous, so give a free one; an empty table gives no rows. Nothing is shuffled.
    """
    return df.withColumn(name, _scan(rules)(F.col(text).cast("binary")))


def label_text(detections: Column) -> Column:
    """Distinct labels in order, comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(detections, lambda d: d["label"]))), ",")


def op11(spark, sf_dir: str) -> DataFrame:
    """Licenses in every text of ``documents``: base phrases and the rules' detections; the score is that of the surest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    name = free_name(docs, "licenses")
    found = F.col(f"{name}.detections")
    starts = F.transform(F.filter(found, lambda d: d["base"]), lambda d: d["first"])
    return scan(docs, name=name).select(
        "doc_id", F.col(f"{name}.n_words").alias("n_words"), F.size(starts).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        label_text(F.filter(found, lambda d: d["base"])).alias("base_labels"), label_text(found).alias("labels"),
        F.coalesce(F.array_max(F.transform(found, lambda d: d["score"])), F.lit(0.0)).alias("score"),
    )


def _sql() -> str:
    """Every rule tried on every text, whatever its keywords."""
    rules = ", ".join(f"({r.number}, '{r.label}', {r.base}, {r.priority}, {r.score}::DOUBLE, '{r.pattern}')" for r in parse_rules())
    return rf"""WITH rules(rule, label, base, priority, score, pattern) AS (VALUES {rules}),
words AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
marked AS (SELECT k, doc_id, len(w) AS n_words, coalesce(array_to_string(list_transform(w, lambda x: '/' || x || ' '), ''), '') AS t FROM words),
met AS (SELECT k, t, rule, label, base, priority, score, string_split_regex(t, pattern) AS around, regexp_extract_all(t, pattern) AS found FROM marked, rules WHERE regexp_matches(t, pattern)),
each AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM met),
placed AS (SELECT k, rule, label, base, priority, score, array_to_string(around[1:i], '') || array_to_string(found[1:i - 1], '') AS before, found[i] AS hit FROM each),
spans AS (SELECT k, rule, label, base, priority, score, length(before) - length(replace(before, '/', '')) AS a, length(before) - length(replace(before, '/', '')) + length(hit) - length(replace(hit, '/', '')) AS b FROM placed),
kept AS (SELECT * FROM spans x WHERE base OR NOT EXISTS (SELECT 1 FROM spans y WHERE y.k = x.k AND y.a <= x.a AND y.b >= x.b AND (y.priority > x.priority OR y.priority = x.priority AND (y.a < x.a OR y.b > x.b OR y.rule < x.rule)))),
docs AS (SELECT k, count(*) FILTER (base) AS n_base, min(a) FILTER (base) AS first_word, max(a) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM kept GROUP BY k)
SELECT doc_id, n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score FROM marked LEFT JOIN docs USING (k)"""


OP11_SQL = _sql()
