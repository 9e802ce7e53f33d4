"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

For each sample and term, gamma variates r and c and a uniform b come from hashes of the pair. A term of weight
w is placed on a grid of log-weights of step r, shifted by b, and the term whose c falls lowest against its
grid point is the sample: two texts agree in it with a chance equal to the generalised Jaccard similarity
sum(min(w)) / sum(max(w)) of their words. Terms are lower-case words, weighted by how often they occur.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SPLIT = r"[\x09-\x0D\x20]+"
EACH = 2  # samples computed side by side; more would make a method that the JVM does not compile
CELLS = 1024  # of the quantile tables
LOW32 = 4294967295


def words(text: Column) -> Column:
    """Lower-case words of a text; a text without words has the empty word alone, which no other text has."""
    found = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPLIT), "")
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("")))


def gamma_quantiles(p: np.ndarray) -> np.ndarray:
    """Where the distribution function of Gamma(2, 1), 1 - exp(-x) (1 + x), reaches ``p``: bisection."""
    lo, hi = np.zeros_like(p), np.full_like(p, 64.0)
    for _ in range(80):
        mid = (lo + hi) / 2
        below = -np.expm1(-mid) - mid * np.exp(-mid) < p
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
    return (lo + hi) / 2


def _tables() -> tuple[list[float], list[float]]:
    """Cell edges of r and of ln c over a uniform: CELLS cells, then CELLS finer ones that stand for the 1/64 of all
    draws in which r is large, or c small (there lie the samples that win)."""
    edge = np.arange(CELLS + 1) / CELLS
    inside = 1e-9 + edge * (1 - 2e-9)
    r = np.concatenate([gamma_quantiles(inside), gamma_quantiles(np.minimum(1 - (1 - edge) / 64, 1 - 1e-9))])
    c = np.concatenate([gamma_quantiles(inside), gamma_quantiles(np.maximum(edge / 64, 1e-9))])
    return r.tolist(), np.log(c).tolist()


def _draw(table: str, bits: str, fine: str) -> str:
    """SQL for a value of ``table`` at 32 random ``bits``: linear inside a cell; ``fine`` says when the finer cells hold."""
    top = f"shiftright({bits}, 22)"
    at = f"if({fine.format(top=top)}, {CELLS + 1} + (shiftright({bits}, 16) & {CELLS - 1}), {top})"
    part = f"if({fine.format(top=top)}, ({bits} & 65535) / 65536D, ({bits} & 4194303) / 4194304D)"
    low, high = f"{table}[cast({at} as int)]", f"{table}[cast({at} as int) + 1]"
    return f"{low} + ({high} - {low}) * ({part})"


def signatures(df: DataFrame, keys: list[str], texts: dict[str, Column], carry: list[str], samples: int = 64) -> DataFrame:
    """``keys`` (which tell the rows of ``df`` apart, none null), the longs ``carry``, and for each of ``texts`` an array
    of ``samples`` longs below 2**32 under its name.

    If ``df`` is partitioned by one of ``keys``, no row is exchanged: words are counted, sampled and reduced in
    the task that has the text. Weights are exact counts over whole texts. What is carried travels as rows
    of one value beside the words, so that the grouping keys stay few.
    """
    if samples % EACH:
        raise ValueError(f"samples must be a multiple of {EACH}")
    names, groups = list(texts), samples // EACH
    each = [F.struct(F.lit(k).alias("kind"), F.lit(0).alias("slot"), words(texts[n]).alias("words")) for k, n in enumerate(names)]
    each += [F.struct(F.lit(-1).alias("kind"), F.lit(k + 1).alias("slot"), F.array(F.col(c).cast("string")).alias("words")) for k, c in enumerate(carry)]
    terms = df.select(*keys, F.explode(F.array(*each)).alias("t")).select(*keys, F.col("t.kind").alias("kind"), F.col("t.slot").alias("slot"), F.explode("t.words").alias("word"))
    term = F.when(F.col("slot") == 0, F.xxhash64("word")).otherwise(F.col("word").cast("long"))
    counted = terms.groupBy(*keys, "slot", term.alias("term")).agg(*[F.count_if(F.col("kind") == k).alias(f"w{k}") for k in range(len(names))])
    logs = [F.ln(F.col(f"w{k}").cast("double")).alias(f"l{k}") for k in range(len(names))]  # null where the text has no such term
    own = F.when(F.col("slot") == 0, F.array(*[F.lit(g) for g in range(groups)])).otherwise(F.array(F.lit(groups - 1) + F.col("slot")))
    spread = counted.select(*keys, "slot", "term", *logs, F.explode(own).alias("g"))
    hashed = spread.select("*", *[F.expr(f"xxhash64(term, g, {j})").alias(f"h{j}") for j in range(EACH)])
    hashed = hashed.select("*", *[F.expr(f"xxhash64(h{j})").alias(f"k{j}") for j in range(EACH)])
    r_table, c_table = (f"from_json('{t}', 'array<double>')" for t in _tables())
    drawn = hashed.select(
        *keys,
        "g",
        "slot",
        "term",
        *[f"l{k}" for k in range(len(names))],
        *[F.expr(_draw(r_table, f"(h{j} & {LOW32})", f"{{top}} >= {CELLS - CELLS // 64}")).alias(f"r{j}") for j in range(EACH)],
        *[F.expr(_draw(c_table, f"shiftrightunsigned(h{j}, 32)", f"{{top}} < {CELLS // 64}")).alias(f"c{j}") for j in range(EACH)],
        *[F.expr(f"shiftrightunsigned(k{j}, 32) * {2.0**-32!r}D").alias(f"b{j}") for j in range(EACH)],
        *[F.expr(f"k{j} & {LOW32}").alias(f"k{j}") for j in range(EACH)],
    )
    pairs = [(k, j) for k in range(len(names)) for j in range(EACH)]
    placed = drawn.select("*", *[F.expr(f"floor(l{k} / r{j} + b{j})").alias(f"t{k}_{j}") for k, j in pairs])
    # one long: 31 bits of log a, which is above -128, then 32 bits that name the term and its grid point
    score = "shiftleft(cast((c{j} - r{j} * (t{k}_{j} - b{j}) - r{j} + 128D) * 8388608D as bigint), 32) | ((k{j} + t{k}_{j} * 2654435761L) & 4294967295L)"
    scored = placed.select(*keys, "g", *[F.expr(f"if(slot = 0, {score.format(k=k, j=j)}, term)").alias(f"s{k}_{j}") for k, j in pairs])
    least = scored.groupBy(*keys, "g").agg(*[F.min(f"s{k}_{j}").alias(f"s{k}_{j}") for k, j in pairs])
    parts = F.struct("g", *[F.array(*[F.col(f"s{k}_{j}") for j in range(EACH)]).alias(f"p{k}") for k in range(len(names))])
    whole = least.groupBy(*keys).agg(F.array_sort(F.collect_list(parts)).alias("parts"))
    signed = [F.transform(F.flatten(F.slice(F.col(f"parts.p{k}"), 1, groups)), lambda x: x.bitwiseAND(F.lit(LOW32))).alias(n) for k, n in enumerate(names)]
    return whole.select(*keys, *[F.col("parts.p0")[groups + k][0].alias(c) for k, c in enumerate(carry)], *signed)


def likeness(a: Column, b: Column) -> Column:
    """The share of samples in which two signatures agree."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + x) / F.size(a)


def as_text(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def with_next(df: DataFrame, order: str, columns: list[str], rows_each: int = 1024, most_parts: int = 65536) -> DataFrame:
    """``columns`` of ``df`` dealt into ranges of ``order``, each range with a copy of the first row of the next one (the
    last range: of the first), so that every row has the row after it in its own task.

    Adds ``bucket``, ``key`` (``order``, nulls as the smallest long) and ``extra`` (true for the copies). A first pass reads
    ``order`` only; at most ``most_parts`` cuts come to the driver.
    """
    low = -(1 << 63)
    key = F.coalesce(F.col(order).cast("long"), F.lit(low))
    ids = df.select(key.alias("k"))
    head = ids.agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("k")).first()
    parts = max(1, min(most_parts, -(-head["n"] // rows_each)))
    cuts: list[int] = []
    if parts > 1:
        found = ids.agg(F.percentile_approx("k", [p / parts for p in range(1, parts)], 4 * parts).alias("c")).first()["c"]
        cuts = sorted({c for c in found if c > head["k"]})  # values that occur: each is the first key of its range
    literal, n = F.from_json(F.lit(str(cuts)), "array<bigint>"), len(cuts)
    steps = F.array(*[F.lit(1 << s) for s in range(max(1, n.bit_length()) - 1, -1, -1)])
    bucket = F.lit(0)
    if cuts:
        bucket = F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s <= n) & (F.element_at(literal, F.least(at + s, F.lit(n))) <= F.col("key")), at + s).otherwise(at))
    first = F.when(F.col("bucket") == 0, F.col("key") == F.lit(head["k"]))
    if cuts:
        first = first.otherwise(F.element_at(literal, F.greatest("bucket", F.lit(1))) == F.col("key"))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("extra"))
    before = F.struct(F.when(F.col("bucket") == 0, n).otherwise(F.col("bucket") - 1).alias("bucket"), F.lit(True).alias("extra"))
    dealt = df.select(*[c for c in columns], key.alias("key")).withColumn("bucket", bucket.cast("int"))
    dealt = dealt.select(*columns, "key", F.explode(F.when(F.coalesce(first, F.lit(False)), F.array(own, before)).otherwise(F.array(own))).alias("at"))
    return dealt.select(*columns, "key", F.col("at.bucket").alias("bucket"), F.col("at.extra").alias("extra")).repartition(n + 1, "bucket")


def fingerprints_with_next(df: DataFrame, key: str = "doc_id", text: str = "text", samples: int = 64, rows_each: int = 1024) -> DataFrame:
    """For each row of ``df``: ``doc_id, n_chars``, the SHA-256 of its edited text, the signatures of text and edited
    text, and the likeness of the text's to the edited text's and to the next row's.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next text in
    ascending order of ``key`` (after the last: the first). Null keys come first and rows that tie are ordered by a
    hash of their text; a null text is empty; texts without words are alike to each other and to no other text;
    repeated rows stay; other columns are ignored; an empty table gives no rows. Texts are exchanged once, and
    everything else happens in the task that holds about ``rows_each`` of them.
    """
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    near = with_next(rows, "doc_id", ["doc_id", "text"], rows_each)
    in_order = Window.partitionBy("bucket").orderBy("extra", "key", F.xxhash64("text"))
    near = near.withColumns({"turn": F.row_number().over(in_order), "next": F.coalesce(F.lead("text").over(in_order), F.lit("")), "n_chars": F.char_length("text").cast("long")})
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next", half))
    near = near.withColumn("edited", edited).withColumn("sha", F.sha2(F.col("edited").cast("binary"), 256))
    digest = [F.conv(F.substring("sha", 16 * k + 1, 16), 16, -10).cast("long").alias(f"sha{k}") for k in range(4)]
    near = near.select("bucket", "turn", F.col("extra").cast("long").alias("extra"), "doc_id", "n_chars", *digest, "text", "edited")
    carry = ["extra", "doc_id", "n_chars", *[f"sha{k}" for k in range(4)]]
    signed = signatures(near, ["bucket", "turn"], {"signature": F.col("text"), "edited_signature": F.col("edited")}, carry, samples)
    after = F.lead("signature").over(Window.partitionBy("bucket").orderBy("turn"))
    return signed.withColumn("next_signature", after).where("extra = 0").select(
        "doc_id",
        "n_chars",
        F.concat(*[F.lower(F.lpad(F.hex(f"sha{k}"), 16, "0")) for k in range(4)]).alias("edited_sha256"),
        "signature",
        "edited_signature",
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )


def op4(spark, sf_dir: str) -> DataFrame:
    """Signatures of every text of ``documents`` and of its edited text, and how alike they and the next document's are."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = fingerprints_with_next(docs)
    return out.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("signature")).alias("fingerprint"), as_text(F.col("edited_signature")).alias("edited_fingerprint"), "near_edited", "near_next")
