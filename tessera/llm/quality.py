"""Operator 6, quality classifier: naive Bayes support vectors.

Word 1- and 2-gram indicators are hashed into a fixed number of features and
scaled by their class log-count ratios, counted over all labelled rows. A linear
hinge-loss model is fitted on a bounded sample by dual coordinate descent, and a
logistic curve over margins of rows that the fit did not see turns margins into scores.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, staged

BITS = 18                 # 2**BITS features
SAMPLE = 16_000           # rows that the fit reads, about (chosen by a hash of doc_id)
HELD = 5                  # one row in HELD is held out
TOKEN = re.compile(r"\w+|[^\w\s]+")
REPEAT = 0x9E3779B1       # stands for "the same word again"
KEPT_TOKENS = 400_000
PART = 1 << 12            # features per counted block


class TokenHashes(dict):
    """Token -> 32-bit hash; forgets all when it has grown to a fixed size."""

    def __missing__(self, token: str) -> int:
        if len(self) >= KEPT_TOKENS:
            self.clear()
        h = zlib.crc32(token.encode("utf-8", "surrogatepass"))
        if len(token) <= 64:
            self[token] = h
        return h


HASHES = TokenHashes()


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Sorted distinct feature numbers of the word 1- and 2-grams of a text (none: an empty array)."""
    toks = TOKEN.findall((text or "").lower())
    if not toks:
        return np.zeros(0, np.int32)
    h = np.fromiter(map(HASHES.__getitem__, toks), np.uint64, len(toks))
    pair = np.where(h[1:] == h[:-1], np.uint64(REPEAT), h[1:] * np.uint64(0x9E3779B97F4A7C15) + h[:-1] * np.uint64(0xC2B2AE3D27D4EB4F))
    both = np.concatenate([h * np.uint64(0xD6E8FEB86659FD93), pair * np.uint64(0xA0761D6478BD642F)])
    if (pair[1:][pair[:-1] == REPEAT] == REPEAT).any():              # the same word three times in a row
        both = np.append(both, np.uint64(REPEAT << 32))
    return np.unique((both >> np.uint64(64 - bits)).astype(np.int32))


def _counts_and_sample(batches, bits):
    """Per task: class counts of all features (dense blocks), and the features of the sampled rows."""
    counts = np.zeros((2, 1 << bits), np.int64)
    rows = [0, 0]
    for b in batches:
        kind, lab, data = [], [], []
        for text, y, taken in zip(b.column("text").to_pylist(), b.column("label").to_pylist(), b.column("taken").to_pylist()):
            f = features(text, bits)
            counts[y][f] += 1
            rows[y] += 1
            if taken is not None:
                kind.append(-1 - taken)
                lab.append(y)
                data.append(f.tobytes())
            if len(data) == 256:
                yield _batch(kind, lab, data)
                kind, lab, data = [], [], []
        yield _batch(kind, lab, data)
    for y in (0, 1):
        if rows[y]:
            blocks = counts[y].reshape(-1, min(PART, 1 << bits))
            yield _batch(list(range(len(blocks))), [y] * len(blocks), [x.tobytes() for x in blocks])
            yield _batch([len(blocks)], [y], [np.array([rows[y]], np.int64).tobytes()])


def _batch(kind, lab, data):
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int64()), pa.array(lab, pa.int32()), pa.array(data, pa.binary())],
                                      ["kind", "label", "data"])


def _sums(batches):
    """Sums the count blocks of a partition, one block in memory for each number and class."""
    total: dict = {}
    for b in batches:
        for k, y, d in zip(*(b.column(c).to_pylist() for c in ("kind", "label", "data"))):
            x = np.frombuffer(d, np.int64)
            total[k, y] = total[k, y] + x if (k, y) in total else x
    yield _batch([k for k, _ in total], [y for _, y in total], [x.tobytes() for x in total.values()])


def hinge_fit(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = 1.0, epochs: int = 15,
              seed: int = 42) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2/2 + cost * sum of hinge losses, by dual coordinate descent.

    Row i has value ratio[j] at its features j and 1 for the bias. Rows are scaled to unit length.
    """
    w, bias = np.zeros(len(ratio)), 0.0
    values = []
    for f in rows:
        v = ratio[f]
        values.append(v / max(np.sqrt(v @ v + 1.0), 1e-12))
    flat = np.array([1.0 / max(np.sqrt(ratio[f] @ ratio[f] + 1.0), 1e-12) for f in rows])
    square = np.array([v @ v for v in values]) + flat * flat
    sign, alpha, rng = np.where(y > 0, 1.0, -1.0), np.zeros(len(rows)), np.random.default_rng(seed)
    # the rarer class weighs as much as the other
    share = max(1, int((y > 0).sum())), max(1, int((y == 0).sum()))
    limit = np.where(y > 0, cost * len(y) / (2 * share[0]), cost * len(y) / (2 * share[1]))
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            f, v = rows[i], values[i]
            g = sign[i] * (w[f] @ v + bias * flat[i]) - 1.0
            a = min(max(alpha[i] - g / square[i], 0.0), limit[i])
            step = (a - alpha[i]) * sign[i]
            if step:
                w[f] += step * v
                bias += step * flat[i]
                moved = max(moved, abs(step))
                alpha[i] = a
        if moved < 1e-3:
            break
    return w * ratio, bias


def margin(f: np.ndarray, weights: np.ndarray, ratio_square: np.ndarray, bias: float) -> float:
    return (float(weights[f].sum()) + bias) / np.sqrt(float(ratio_square[f].sum()) + 1.0)


def logistic_fit(m: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Platt's curve 1 / (1 + exp(-(a m + b))) by Newton steps on smoothed targets."""
    pos, neg = float((y > 0).sum()), float((y == 0).sum())
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, float(np.log((pos + 1) / (neg + 1)))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g = np.array([((p - t) * m).sum() + 1e-3 * a, (p - t).sum()])
        v = np.maximum(p * (1 - p), 1e-6)
        h = np.array([[(v * m * m).sum() + 1e-3, (v * m).sum()], [(v * m).sum(), v.sum() + 1e-6]])
        d = np.linalg.solve(h, g)
        size = np.abs(d).max()
        if size > 5:
            d *= 5 / size
        a, b = a - d[0], b - d[1]
        if size < 1e-6:
            break
    return float(a), float(b)


class Model:
    """Feature weights of a fixed size (2**bits), ready to be sent to every task."""

    def __init__(self, weights, ratio_square, bias, a, b, bits):
        self.weights, self.square = weights.astype(np.float32), ratio_square.astype(np.float32)
        self.bias, self.a, self.b, self.bits = bias, a, b, bits

    def score(self, text: str | None) -> float:
        m = margin(features(text, self.bits), self.weights, self.square, self.bias)
        return float(1 / (1 + np.exp(-np.clip(self.a * m + self.b, -500, 500))))


def held_out(id_col="doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("long").cast("string")), F.lit(HELD)) == 0


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", bits: int = BITS, sample: int = SAMPLE) -> Model:
    """Fits the model on the rows of ``docs`` that ``labels`` marks 0 or 1, except held-out ones.

    The counts cover all such rows; the fit reads about ``sample`` of them. An id
    labelled more than once takes its smallest label; null ids and labels are no
    labels. Without rows of both classes every score is the share of label 1
    (0.5 without any row).
    """
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
             .where(~held_out()))
    n = marks.count()
    # a hash of doc_id chooses about `sample` rows; one in four of them calibrates the scores
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    taken = F.when(draw < int(sample / max(n, 1) * (1 << 30)), F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)))
    # labels grow with the documents: both sides are sorted and merged at every size
    marked = (documents(docs).where(F.col("doc_id").isNotNull() & ~held_out()).join(marks.hint("merge"), "doc_id")
              .withColumn("taken", taken.cast("long")).select("text", "label", "taken"))
    found = staged(marked.mapInArrow(lambda b: _counts_and_sample(b, bits), "kind long, label int, data binary"), "counted")
    sums = found.where("kind >= 0").repartition("kind").mapInArrow(_sums, "kind long, label int, data binary").toPandas()
    counts, rows, width = np.zeros((2, 1 << bits)), [0, 0], min(PART, 1 << bits)
    for k, y, d in zip(sums["kind"], sums["label"], sums["data"]):        # at most 2 * 2**bits numbers
        x = np.frombuffer(d, np.int64)
        if k == (1 << bits) // width:
            rows[y] = int(x[0])
        else:
            counts[y, k * width:(k + 1) * width] = x
    if not all(rows):
        flat = np.zeros(1 << bits)
        p = rows[1] / sum(rows) if sum(rows) else 0.5
        p = min(max(p, 1e-6), 1 - 1e-6)
        return Model(flat, flat, 0.0, 1.0, float(np.log(p / (1 - p))), bits)
    p, q = counts[1] + 1, counts[0] + 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    ratio[(counts[0] + counts[1]) == 0] = 0.0

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["kind", "label", "data"])
        feats = [np.frombuffer(d, np.int32) for d in pdf["data"]]
        y, fold = pdf["label"].to_numpy(), -1 - pdf["kind"].to_numpy()
        apart = fold == 0
        if len(set(y[~apart])) < 2 or len(set(y[apart])) < 2:      # too few rows to keep some apart
            apart = np.zeros(len(y), bool)
        use = np.flatnonzero(~apart)
        w, bias = hinge_fit([feats[i] for i in use], y[use], ratio)
        judge = np.flatnonzero(apart) if apart.any() else use
        m = np.array([margin(feats[i], w, ratio * ratio, bias) for i in judge])
        a, b = logistic_fit(m, y[judge])
        return pd.DataFrame({"weights": [w.tobytes()], "bias": [bias], "a": [a], "b": [b]})

    row = (found.where("kind < 0").groupBy(F.lit(0).alias("all"))
           .applyInPandas(lambda pdf: fit(pdf[["kind", "label", "data"]]), "weights binary, bias double, a double, b double")).first()
    if row is None:                                  # no row was drawn: the ratios alone
        return Model(ratio, np.ones_like(ratio), 0.0, 1.0, 0.0, bits)
    return Model(np.frombuffer(bytes(row["weights"])), ratio * ratio, row["bias"], row["a"], row["b"], bits)


def score_udf(spark, model: Model):
    """A column function text -> score; the model (2 * 4 * 2**bits bytes) is broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([m.score(t) for t in text], dtype="float64")

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, bits: int = BITS, sample: int = SAMPLE) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Only texts are inputs of a score; a null text counts as empty and gets the
    score of a text without words. A null doc_id is not held out. Rows with
    equal ids each get a row; other columns are left behind.
    """
    score = score_udf(docs.sparkSession, train(docs, labels, bits=bits, sample=sample))
    return (documents(docs).withColumn("score", score("text"))
            .select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with their columns as they are."""
    score = score_udf(docs.sparkSession, train(docs, labels))
    return docs.where(score(F.col("text").cast("string")) >= threshold)
