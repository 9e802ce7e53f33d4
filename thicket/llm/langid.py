"""Language identification with string kernels: blended-spectrum presence kernels, Nystroem landmarks, and
one-versus-rest kernel ridge regression.

A text is the set of its hashed byte n-grams, n = 1 .. 4, over the whole text. The kernel of two texts is the size
of their common set over the geometric mean of their sizes. Landmarks from the training rows span the feature
space; the regression is solved there. Scoring multiplies a batch of presence rows with the landmarks' presence
and the coefficients; as matrix products are associative, the last two are multiplied once, after training.

N-grams share 32 768 buckets. Ordinary texts fill a part of them (6 720 n-grams of 134 kB of prose: 6 071 buckets);
the set of a text with 180 000 different n-grams is full, and then tells its language no more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

BITS = 15
BUCKETS = 1 << BITS
LONGEST = 4
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else (b if 97 <= b <= 122 or b >= 128 else 32) for b in range(256))


def has_letter(text: str | None) -> bool:
    """Whether a text has a character of a Unicode category L*: neither marks nor digits of any kind, as in 2, ½ and Ⅷ."""
    return text is not None and any(map(str.isalpha, text))


def gram_buckets(text: str, chunk: int = 1 << 20) -> np.ndarray:
    """Sorted buckets of the n-grams of a text: ASCII letters lowered, other ASCII characters blank."""
    data = text.encode("utf-8", "surrogatepass").translate(_PLAIN)
    seen = np.zeros(BUCKETS, dtype=bool)
    for lo in range(0, max(1, len(data)), chunk):
        code = np.frombuffer(data[lo : lo + chunk + LONGEST - 1], dtype=np.uint8).astype(np.uint32)
        part = code
        for n in range(1, LONGEST + 1):
            if n > 1:
                if len(code) < n:
                    break
                part = (part[:-1] << np.uint32(8)) | code[n - 1 :]
            mixed = (part + np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(2654435761)
            seen[(mixed ^ (mixed >> np.uint32(15))) * np.uint32(2246822519) >> np.uint32(32 - BITS)] = True
    return np.flatnonzero(seen)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # BUCKETS x languages: landmark presence times ridge coefficients

    def score(self, texts: list[str], batch: int = 64) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language, its score (softmax over the one-versus-rest outputs) and the output itself for each text. An output
        is near 1 where the regression takes the text for one of the language, near -1 where not."""
        names, scores, outputs = [], np.zeros(len(texts)), np.full(len(texts), -1.0)
        rows = np.zeros((batch, BUCKETS), dtype=np.float32)
        for lo in range(0, len(texts), batch):
            some = texts[lo : lo + batch]
            sets = [gram_buckets(t) if has_letter(t) else None for t in some]
            for k, s in enumerate(sets):
                if s is not None:
                    rows[k, s] = 1.0
            out = rows[: len(some)] @ self.weights
            for k, s in enumerate(sets):
                if s is None or not self.languages:
                    names.append("und")
                    continue
                rows[k, s] = 0.0
                f = out[k] / np.sqrt(len(s))
                p = np.exp(4.0 * (f - f.max()))
                at = int(np.argmax(f))
                names.append(self.languages[at])
                scores[lo + k], outputs[lo + k] = p[at] / p.sum(), f[at]
        return names, scores, outputs


def fit(sets: list[np.ndarray], labels: list[str], n_landmarks: int, ridge: float, seed: int) -> LanguageModel:
    """Kernel ridge regression on Nystroem features. Landmarks are drawn evenly over the languages."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS, 1), dtype=np.float32))
    y = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    shuffled = rng.permutation(len(y))
    turn = np.empty(len(y), dtype=int)
    for k in range(len(languages)):
        own = shuffled[y[shuffled] == k]
        turn[own] = np.arange(len(own))
    marks = shuffled[np.argsort(turn[shuffled], kind="stable")][:n_landmarks]

    def presence(which: np.ndarray) -> np.ndarray:
        rows = np.zeros((len(which), BUCKETS), dtype=np.float32)
        for k, i in enumerate(which):
            rows[k, sets[i]] = 1.0 / np.sqrt(max(1, len(sets[i])))
        return rows

    landmarks = presence(marks)
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(float))
    keep = values > 1e-8 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    features = np.concatenate([(presence(np.arange(lo, min(lo + 128, len(y)))) @ landmarks.T).astype(float) @ whiten for lo in range(0, len(y), 128)])
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    balance = 1.0 / np.bincount(y, minlength=len(languages))[y]  # languages weigh alike, however many rows they have
    balance *= len(y) / balance.sum()
    weighed = features * balance[:, None]
    solved = np.linalg.solve(features.T @ weighed + ridge * np.eye(features.shape[1]), weighed.T @ target)
    return LanguageModel(languages, (landmarks.T @ (whiten @ solved)).astype(np.float32))


def _collect_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        batch, bits = batch[[has_letter(t) for t in batch["text"]]], []
        for text in batch["text"]:
            seen = np.zeros(BUCKETS, dtype=bool)
            seen[gram_buckets(text)] = True
            bits.append(np.packbits(seen).tobytes())
        yield pd.DataFrame({"lang": batch["lang"], "h": batch["h"], "bits": bits})


def train(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = 500, most_languages: int = 64, n_landmarks: int = 256, ridge: float = 0.1, seed: int = 11) -> LanguageModel:
    """Learns from at most ``per_language`` rows of each language, those with the smallest hash of their key, and from
    the ``most_languages`` most frequent languages (ties by name); other ones are not known.

    Only their n-gram sets (4 kB each, whatever the text's length) come to the driver. Rows without a
    language, or whose text is null or has no letter, teach nothing; a repeated key teaches once a language (the least of
    its sets); without any rows the model knows no language.
    """
    base = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(1 << 30)).alias("h"))
    counts = {r["lang"]: r["n"] for r in base.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()}
    if not counts:
        return fit([], [], n_landmarks, ridge, seed)
    # a threshold on the hash leaves about 1.2 x per_language rows of a language; the driver keeps the smallest
    limit = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(int(min(1.0, 1.2 * per_language / n) * (1 << 30))))])
    some = base.where(F.col("h") < F.element_at(limit, F.col("lang")))
    found = some.mapInPandas(_collect_sets, "lang string, h long, bits binary").groupBy("lang", "h").agg(F.min("bits").alias("bits")).collect()
    by: dict[str, list] = {}
    for r in sorted(found, key=lambda r: (r["lang"], r["h"])):
        by.setdefault(r["lang"], []).append(bytes(r["bits"]))
    sets, labels = [], []
    for k, rows_ in by.items():
        for bits in rows_[:per_language]:
            sets.append(np.flatnonzero(np.unpackbits(np.frombuffer(bits, dtype=np.uint8))))
            labels.append(k)
    return fit(sets, labels, n_landmarks, ridge, seed)


def languages(df: DataFrame, model: LanguageModel, text: str = "text", name: str = "language") -> DataFrame:
    """``df`` with a struct ``name``: ``pred`` (``und`` where the text is null or has no letter), ``score`` (0 to 1; 0 for
    ``und``) and ``output``, that of the language's regression (-1 for ``und``).

    Only the text is looked at, and all of it; texts go to Python and no other column does. Repeated rows stay; a
    column that has the name is replaced; an empty table gives no rows."""

    @F.pandas_udf("struct<pred:string,score:double,output:double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        names, scores, outputs = model.score(["" if t is None else t for t in texts])
        return pd.DataFrame({"pred": names, "score": scores, "output": outputs})

    return df.withColumn(name, run(F.col(text)))


def identify(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``lang_score`` as in ``languages``; a clash of names gets an underscore."""
    name, pred, score = (free_name(df, x) for x in ("language", "lang_pred", "lang_score"))
    found = languages(df, model, text, name)
    return found.select(*df.columns, F.col(name)["pred"].alias(pred), F.col(name)["score"].alias(score))


def fold(key: str, n: int) -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def learn_documents(docs: DataFrame) -> LanguageModel:
    """The model of the documents outside the held-out fold."""
    return train(docs.where(fold("doc_id", 5) != 0))


def op1(spark, sf_dir: str) -> DataFrame:
    """The language of every whole text of ``documents``. Null and letterless texts are ``und`` with score 0."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = identify(docs.select("doc_id", "text"), learn_documents(docs))
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
