"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 512 bytes; all of them are encoded. Gated attention weights, learned from
document labels alone, say how much each passage counts; the weighted mean of the encodings is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize
from .langid import fold

PASSAGE = 512
GRAMS = 192
MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
N_CLASSES = 7 + len(MARKS)
N_FEATURES = N_CLASSES + GRAMS + 5


def _classes() -> np.ndarray:
    """A class for each byte: lower, upper, digit, blank, line end, non-ASCII, other control; then each mark."""
    out = np.full(256, 6, dtype=np.int64)
    out[97:123], out[65:91], out[48:58], out[[32, 9]], out[[10, 13]], out[128:] = 0, 1, 2, 3, 4, 5
    for k, c in enumerate(MARKS):
        out[c] = 7 + k
    return out


CLASSES = _classes()


def passage_features(data: bytes) -> np.ndarray:
    """A row for each 512 bytes of ``data`` (one for no data): how often byte classes and hashed trigrams inside
    the passage occur, and how varied the trigrams are."""
    b = np.frombuffer(data, dtype=np.uint8)
    n = max(1, -(-len(b) // PASSAGE))
    row = np.arange(len(b)) // PASSAGE
    sizes = np.full(n, PASSAGE, dtype=np.float32)
    sizes[-1] = len(b) - (n - 1) * PASSAGE
    classes = np.bincount(row * N_CLASSES + CLASSES[b], minlength=n * N_CLASSES).reshape(n, N_CLASSES).astype(np.float32)
    grams = np.zeros((n, GRAMS), dtype=np.float32)
    if len(b) >= 3:
        code = b.astype(np.uint32)
        code = (code[:-2] << np.uint32(16)) | (code[1:-1] << np.uint32(8)) | code[2:]
        inside = np.arange(len(code)) % PASSAGE < PASSAGE - 2
        bucket = (code * np.uint32(2654435761) >> np.uint32(8)) % np.uint32(GRAMS)
        grams = np.bincount(row[:-2][inside] * GRAMS + bucket[inside], minlength=n * GRAMS).reshape(n, GRAMS).astype(np.float32)
    total = np.maximum(1.0, grams.sum(axis=1, keepdims=True))
    share = grams / total
    entropy = -(share * np.log(np.maximum(share, 1e-9))).sum(axis=1)
    letters = np.maximum(1.0, classes[:, 0] + classes[:, 1])
    extra = np.stack([(grams > 0).mean(axis=1), entropy / np.log(GRAMS), share.max(axis=1), np.log1p(sizes) / np.log(PASSAGE), classes[:, 1] / letters], axis=1)
    return np.concatenate([np.sqrt(classes / np.maximum(1.0, sizes)[:, None]), np.sqrt(share), extra], axis=1).astype(np.float32)


def document_features(text: str | None, chunk: int = 8192 * PASSAGE) -> np.ndarray:
    data = (text or "").encode("utf-8", "surrogatepass")
    return np.concatenate([passage_features(data[lo : lo + chunk]) for lo in range(0, max(1, len(data)), chunk)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass
class AttentionModel:
    """``mean`` and ``scale`` of the features, and the weights by name."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """``x``: passages of all documents one after another; ``starts``: the first passage of each document."""
        w = self.weights
        h = np.tanh((x - self.mean) * self.scale @ w["encode"] + w["encode_bias"])
        tan, gate = np.tanh(h @ w["tan"]), _sigmoid(h @ w["gate"])
        e = (tan * gate) @ w["attend"]
        n = np.diff(np.append(starts, len(x)))
        weight = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), n))
        weight /= np.repeat(np.add.reduceat(weight, starts), n)
        z = np.add.reduceat(h * weight[:, None], starts, axis=0)
        return {"h": h, "tan": tan, "gate": gate, "attention": weight, "z": z, "n": n, "score": _sigmoid(z @ w["out"] + w["bias"][0])}

    def gradients(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss of labels ``y``, by weight: back through attention and encoder."""
        w, f = self.weights, self.forward(x, starts)
        d_logit = (f["score"] - y) / len(y)
        d_z = np.repeat(d_logit[:, None] * w["out"], f["n"], axis=0)
        pull = (d_z * f["h"]).sum(axis=1)
        mean_pull = np.add.reduceat(pull * f["attention"], starts)
        d_e = f["attention"] * (pull - np.repeat(mean_pull, f["n"]))
        d_a = d_e[:, None] * w["attend"]
        d_tan, d_gate = d_a * f["gate"] * (1 - f["tan"] ** 2), d_a * f["tan"] * f["gate"] * (1 - f["gate"])
        d_h = d_z * f["attention"][:, None] + d_tan @ w["tan"].T + d_gate @ w["gate"].T
        d_in = d_h * (1 - f["h"] ** 2)
        return {
            "encode": ((x - self.mean) * self.scale).T @ d_in, "encode_bias": d_in.sum(axis=0), "tan": f["h"].T @ d_tan, "gate": f["h"].T @ d_gate,
            "attend": (f["tan"] * f["gate"]).T @ d_e, "out": f["z"].T @ d_logit, "bias": d_logit.sum(keepdims=True),
        }

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.zeros(0)
        starts = np.cumsum([0, *[len(b) for b in bags[:-1]]])
        return self.forward(np.concatenate(bags), starts)["score"].astype(float)


def fit(bags: list[np.ndarray], labels: np.ndarray, encoded: int = 32, attended: int = 16, epochs: int = 40, batch: int = 64, rate: float = 3e-3, decay: float = 1e-4, seed: int = 5) -> AttentionModel:
    """Minimises the log loss of document labels by Adam. Without any document every score is 0.5."""
    rng, nothing = np.random.default_rng(seed), not bags
    if nothing:
        bags, labels, epochs = [np.zeros((1, N_FEATURES), dtype=np.float32)], np.array([1.0]), 0
    every = np.concatenate(bags)
    mean, scale = every.mean(axis=0), 1.0 / (every.std(axis=0) + 0.02)
    init = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
    w = {"encode": init(N_FEATURES, encoded), "encode_bias": np.zeros(encoded), "tan": init(encoded, attended), "gate": init(encoded, attended), "attend": init(attended, 1)[:, 0], "out": init(encoded, 1)[:, 0], "bias": np.zeros(1)}
    w = {k: v.astype(np.float32) * (k != "out" or not nothing) for k, v in w.items()}
    model = AttentionModel(mean, scale.astype(np.float32), w)
    m, v, step = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), batch):
            some = [bags[i] for i in order[lo : lo + batch]]
            y = labels[order[lo : lo + batch]].astype(np.float32)
            x = np.concatenate(some)
            grads = model.gradients(x, np.cumsum([0, *[len(b) for b in some[:-1]]]), y)
            step += 1
            for k, g in grads.items():
                g = g + decay * w[k]
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                w[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def _collect_bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch[["h", "label"]].assign(bag=[document_features(t).tobytes() for t in batch["text"]])


def train(rows: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", most: int = 3000, most_bytes: int = 1 << 20, most_passages: int = 1 << 17, seed: int = 5) -> AttentionModel:
    """Learns from at most about ``most`` labelled rows, chosen by a hash of their key.

    Three documented bounds make the sample: ``most`` rows, ``most_bytes`` of a text in it, and ``most_passages`` in all
    (of N_FEATURES floats each, which is what comes to the driver: 124 MB); rows come in the order of the hash until one
    more would exceed the last. What is left out teaches nothing and is scored like any other.
    Null labels and labels without a document teach nothing; of repeated labels of a key the largest counts, of repeated
    documents that with the smallest hash of its text.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("label_key")).agg(F.max(F.col(label).cast("int")).alias("label"))
    n = known.count()
    limit = int(min(1.0, most / max(1, n)) * (1 << 30))
    known = known.withColumn("h", F.pmod(F.xxhash64("label_key", F.lit(seed)), F.lit(1 << 30))).where(F.col("h") < limit)
    known = materialize(known, "quality-labels")  # small, and known to be: no text is shuffled to meet it
    texts = rows.select(F.col(key).cast("long").alias("label_key"), F.col(text).alias("text")).where(F.coalesce(F.octet_length("text"), F.lit(0)) <= most_bytes)
    one = F.min(F.struct(F.xxhash64("text"), "text", "h", "label")).alias("one")
    sample = materialize(texts.join(known, "label_key").groupBy("label_key").agg(one).select("label_key", "one.h", "one.label", "one.text"), "quality-sample")
    sizes = sample.select("h", "label_key", F.greatest(F.lit(1), F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / PASSAGE)).alias("n")).collect()
    held, last = 0, -1
    for h, _, passages in sorted(tuple(r) for r in sizes):
        held += passages
        if held > most_passages:
            break
        last = h
    some = sample.where(F.col("h") <= last).select("h", "label", "text")
    found = sorted(some.mapInPandas(_collect_bags, "h long, label int, bag binary").collect(), key=lambda r: (r["h"], bytes(r["bag"])))
    bags = [np.frombuffer(r["bag"], dtype=np.float32).reshape(-1, N_FEATURES) for r in found]
    return fit(bags, np.array([float(r["label"] == 1) for r in found]), seed=seed)


def rate(df: DataFrame, model: AttentionModel, text: str = "text", name: str | None = None) -> DataFrame:
    """``df`` with ``name`` (``quality_score`` if none is given; a clash of it gets an underscore), the chance of label 1.

    Only the text is looked at, and all of it (texts go to Python and no other column does); a null text is empty, and an
    empty text is one empty passage. Repeated rows stay; an empty table gives no rows."""
    name = name or free_name(df, "quality_score")

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        scores, bags, held = [], [], 0
        for t in texts:
            bags.append(document_features(t))
            held += len(bags[-1])
            if held >= 2048:  # passages
                scores.append(model.score(bags))
                bags, held = [], 0
        scores.append(model.score(bags))
        return pd.Series(np.concatenate(scores))

    return df.withColumn(name, run(F.col(text)))


def learn_documents(docs: DataFrame, labels: DataFrame) -> AttentionModel:
    """The model of the labelled documents outside the held-out fold."""
    return train(docs.where(fold("doc_id", 3) != 1), labels.where(fold("doc_id", 3) != 1))


def op2(spark, sf_dir: str) -> DataFrame:
    """The quality of every whole text of ``documents``. A null text is scored as an empty one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = learn_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    scored = rate(docs, model, name="score")
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
