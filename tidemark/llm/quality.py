"""Quality classifier by positive-unlabelled learning.

Every whole text becomes a short vector of byte-class shares, word and line statistics. A small network is fitted with
the non-negative unbiased risk: trusted positives, unlabelled web text, and a class prior estimated from how often a
labelled-versus-unlabelled classifier recognises held-back positives. Rows labelled negative are never used.

The fit takes at most FIT_ROWS positives and FIT_ROWS unlabelled documents, those with the smallest hashed ids, each id once
(with its smallest vector where ids repeat); scoring covers all rows. Rows and labels without an id are scored but not
learned from. Null and empty texts have the vector of an empty text. Without any trusted positive every score is the default
prior, and keep_good() keeps every document. Ties at the threshold are kept; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, cut, table

FIT_ROWS, HIDDEN, EPOCHS, BATCH, RATE, DEFAULT_PRIOR, THRESHOLD = 20_000, 24, 60, 512, 0.01, 0.5, 0.7
HELD_MOD, HELD = 4, 2


def _classes() -> np.ndarray:
    """Class of each byte value: lower, upper, digit, blank, line break, each frequent mark by itself, other marks, rest."""
    kinds = np.full(256, 5)
    kinds[97:123], kinds[65:91], kinds[48:58] = 0, 1, 2
    kinds[[32, 9]], kinds[[10, 13]], kinds[128:] = 3, 4, 6
    for i, c in enumerate(b"|#$%&*!.,?-_/=<>()\"';:@"):
        kinds[c] = 7 + i
    return kinds


KINDS = _classes()
N_KINDS = int(KINDS.max()) + 1
WIDTH = N_KINDS + 13


def features(text: str | None) -> np.ndarray:
    """WIDTH floats of one text; a null text is an empty one."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    size = max(1, len(raw))
    shares = np.bincount(KINDS, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), N_KINDS) / size
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    counts = Counter(words)
    top = counts.most_common(3)
    line_chars = max(1, sum(map(len, lines)))
    repeated = sum(len(k) * (c - 1) for k, c in Counter(lines).items())
    out = np.empty(WIDTH, np.float32)
    out[:N_KINDS] = np.sqrt(shares)
    out[N_KINDS:] = (
        np.log1p(len(words)),
        np.log1p(len(text)),
        lengths.mean(),
        lengths.std(),
        np.log1p(lengths.max()),
        len(counts) / n,
        sum(map(eq, words, words[1:])) / n,
        top[0][1] / n if top else 0,
        sum(c for _, c in top) / n,
        np.log1p(len(lines)),
        repeated / line_chars,
        sum(map(str.isupper, words)) / n,
        sum(map(str.isalpha, words)) / n,
    )
    return out


def vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, x): x holds the features as little-endian floats."""

    def run(batches):
        for b in batches:
            x = [features(t).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.binary())], names=["id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, x binary")


class Net:
    """One hidden layer, trained by Adam on a loss whose slope by the score is given for each row."""

    def __init__(self, width: int, seed: int):
        rng = np.random.default_rng(seed)
        self.p = [rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        self.m, self.v, self.t = [np.zeros_like(a) for a in self.p], [np.zeros_like(a) for a in self.p], 0

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3][0]

    def update(self, x: np.ndarray, slope: np.ndarray, rate: float) -> None:
        h = np.tanh(x @ self.p[0] + self.p[1])
        back = slope[:, None] * self.p[2] * (1 - h * h)
        grads = [x.T @ back, back.sum(0), h.T @ slope, np.array([slope.sum()])]
        self.t += 1
        for i, g in enumerate(grads):
            g = g + 1e-4 * self.p[i] * (i % 2 == 0)
            self.m[i] = 0.9 * self.m[i] + 0.1 * g
            self.v[i] = 0.999 * self.v[i] + 0.001 * g * g
            self.p[i] -= rate * (self.m[i] / (1 - 0.9**self.t)) / (np.sqrt(self.v[i] / (1 - 0.999**self.t)) + 1e-8)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def estimate_prior(pos: np.ndarray, unl: np.ndarray, seed: int = 7) -> float:
    """Share of positives among the unlabelled: a classifier of labelled against unlabelled rows is fitted on half of
    each; the odds that it gives unlabelled rows, over the odds that it gives held-back positives, average to the prior."""
    net, half_p, half_u, rng = Net(pos.shape[1], seed), len(pos) // 2, len(unl) // 2, np.random.default_rng(seed)
    if not half_p or not half_u:
        return DEFAULT_PRIOR
    for _ in range(EPOCHS // 3):
        for _ in range(max(1, half_p // BATCH)):
            xp, xu = pos[rng.integers(0, half_p, BATCH)], unl[rng.integers(0, half_u, BATCH)]
            x, y = np.vstack([xp, xu]), np.repeat([1.0, 0.0], BATCH)
            net.update(x, (sigmoid(net.score(x)) - y) / BATCH, RATE)
    gp, gu = net.score(pos[half_p:]), net.score(unl[half_u:])
    # where positives lie, the density of the unlabelled over that of the positives is about the prior: take its median
    usual = np.median(np.exp(-np.clip(gp, -20, 20)))
    odds = np.clip(np.exp(np.clip(gu, -20, 20)) * usual, 0, 1)
    return float(np.clip(odds.mean(), 0.05, 0.98))


def fit(pos: np.ndarray, unl: np.ndarray, prior: float | None = None, seed: int = 11) -> dict:
    """Non-negative risk: prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)), logistic loss. Where the second part of a
    batch turns negative, the step goes the other way, as the method prescribes."""
    mean, std = unl.mean(0), unl.std(0) + 1e-3
    pos, unl = np.clip((pos - mean) / std, -8, 8), np.clip((unl - mean) / std, -8, 8)
    prior = estimate_prior(pos, unl) if prior is None else prior
    net, rng = Net(pos.shape[1], seed), np.random.default_rng(seed)
    steps = max(8, max(len(pos), len(unl)) // BATCH)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        for _ in range(steps):
            xp, xu = pos[rng.integers(0, len(pos), BATCH)], unl[rng.integers(0, len(unl), BATCH)]
            zp, zu = net.score(xp), net.score(xu)
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            slope_u, slope_p_neg = sigmoid(zu) / BATCH, -prior * sigmoid(zp) / BATCH
            slope_p = -prior * (1 - sigmoid(zp)) / BATCH
            if negative >= 0:
                net.update(np.vstack([xp, xu]), np.concatenate([slope_p + slope_p_neg, slope_u]), rate)
            else:
                net.update(np.vstack([xp, xu]), -np.concatenate([slope_p_neg, slope_u]), rate)
    return {"mean": mean, "std": std, "net": net.p, "prior": prior}


def predict(model: dict | None, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(x), DEFAULT_PRIOR)
    w, b, v, c = model["net"]
    x = np.clip((x - model["mean"]) / model["std"], -8, 8)
    return sigmoid(np.tanh(x @ w + b) @ v + c[0])


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> dict | None:
    """Model from docs and labels (doc_id, quality): trusted are ids labelled 1 outside the held-out part. The ids are chosen
    first, so features are worked out for the chosen documents alone."""
    trusted = labels.where((F.col("quality") == 1) & (crc_mod(F.col("doc_id"), HELD_MOD) != HELD)).select(F.col("doc_id").cast("long").alias("id")).distinct()
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).where(F.col("id").isNotNull() & (crc_mod(F.col("id"), HELD_MOD) != HELD)).distinct()

    def sample(of: DataFrame) -> DataFrame:
        return of.orderBy(F.xxhash64("id"), "id").limit(fit_rows)

    chosen = [cut(sample(x)).withColumn("positive", F.lit(p)) for x, p in ((ids.join(trusted, "id", "left_semi"), True), (ids, False))]
    kinds = chosen[0].unionByName(chosen[1]).groupBy("id").agg(F.collect_set("positive").alias("kinds"))  # at most 2 * fit_rows ids, two kinds each
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(kinds.withColumnRenamed("id", "_id")), F.col("doc_id") == F.col("_id"), "left_semi")
    vecs = vectors(mine).groupBy("id").agg(F.min("x").alias("x"))
    rows = vecs.join(F.broadcast(kinds), "id").select("id", "x", F.explode("kinds").alias("positive")).toArrow()
    every = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(-1, WIDTH).astype(np.float64)
    ids, is_pos = np.array(rows["id"].to_pylist(), np.int64), np.array(rows["positive"].to_pylist(), bool)
    order = np.argsort(ids, kind="stable")
    pos, unl = every[order][is_pos[order]], every[order][~is_pos[order]]
    rng = np.random.default_rng(3)
    return fit(rng.permutation(pos), rng.permutation(unl)) if len(pos) and len(unl) else None


def scored(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, score), one per input row."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(predict(model, matrix(b.column(1))))], names=["id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, score double")


def matrix(texts) -> np.ndarray:
    return np.array([features(t) for t in texts.to_pylist()], np.float32).reshape(-1, WIDTH)


def op8_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scored(docs, learn(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(crc_mod(F.col("id"), HELD_MOD) == HELD, F.lit(False))
    return out.select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that score under THRESHOLD; all columns as they were. The texts are scored where they are read,
    so they are not shuffled. Where nothing can be learned, nothing is rejected."""
    model, at = learn(docs, labels), docs.columns.index("text")
    if model is None:
        return docs

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(predict(model, matrix(b.column(at))) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
