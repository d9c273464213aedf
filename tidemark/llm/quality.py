"""A quality classifier learned from positive and unlabelled documents.

Features are hashed n-grams of a text's shape: letters are classes, punctuation and symbols stand for
themselves, so that the form of a text counts and not its language. A logistic model minimises the
non-negative unbiased risk: prior * loss of positives as positive, plus the larger of zero and the loss
of unlabelled text as negative less prior * loss of positives as negative. Where that difference turns
negative its gradient is taken back, as the non-negative estimator demands.

A model fitted on a bounded sample is the start. Then every task goes on from it over all of its texts as
unlabelled ones, batch by batch beside the sampled positives, and the tasks' models are averaged by their texts.
The class prior is estimated from positives and unlabelled text alone: no share of unlabelled text above a
score can be less than the prior times the share of positives above it, so the least quotient of the two
bounds it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import id_remainder, map_texts, slices

#: Hashed features; lengths of shape n-grams; positives and unlabelled documents of the sample that the
#: classifier is fitted on, as expected; descent steps, their size, and the weight of the penalty.
DIM, ORDERS, POSITIVES, UNLABELLED, STEPS, RATE, PENALTY = 1024, (1, 2, 3), 4000, 8000, 600, 0.05, 1e-4

#: Bins of each of the two shares that tell repeated words.
BINS = 12

#: Batches of the pass over all texts, and its step size.
BATCH, PASS_RATE = 512, 0.002

#: Score from which a document counts as good.
THRESHOLD = 0.3


def shape_table() -> np.ndarray:
    """Bytes to shapes: lower-case letters and other characters' bytes 1, capitals 2, digits 3, space 4, line breaks 5; others from 6 on."""
    table = np.zeros(256, np.uint64)
    for b in range(256):
        table[b] = 1 if 97 <= b <= 122 or b >= 128 else 2 if 65 <= b <= 90 else 3 if 48 <= b <= 57 else 4 if b in (9, 32) else 5 if b in (10, 13) else 6 + b
    return table


SHAPES = shape_table()


#: Bytes of a text that are worked on at a time; memory doesn't grow with longer texts.
PART = 1 << 20
WORD = re.compile(rb"[^ \t\n\r\f\v]+")


def repeated(text: bytes) -> tuple[int, int, int]:
    """A text's words, those that equal the word before, and the sum over each 200 words of the distinct ones."""
    words = iter(text.split()) if len(text) <= PART else (m.group() for m in WORD.finditer(text))
    total = again = fresh = 0
    last = None
    while block := list(islice(words, 200)):
        again += (last == block[0]) + sum(map(eq, block, block[1:]))
        fresh += len(set(block))
        total, last = total + len(block), block[-1]
    return total, again, fresh


def repetition(texts: list[bytes]) -> np.ndarray:
    """Bins of the share of words that equal the word before, and of the share of distinct words among each 200 words."""
    out = np.zeros((len(texts), 2 * BINS), np.float32)
    for row, text in zip(out, texts, strict=True):
        total, again, fresh = repeated(text)
        if total > 1:
            row[min(BINS - 1, int(again / (total - 1) * BINS))] = 1
            row[BINS + min(BINS - 1, int(fresh / total * BINS))] = 1
    return out


def shape_counts(bodies: list[bytes], dim: int, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """How often each text has each hashed n-gram of character shapes."""
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    flat = SHAPES[np.frombuffer(b"".join(bodies), np.uint8)]
    owner = np.repeat(np.arange(len(bodies)), sizes)
    counts = np.zeros((len(bodies), dim))
    for n in orders:
        code = np.full(max(0, len(flat) - n + 1), n, np.uint64)
        for i in range(n):
            code = (code << np.uint64(8)) + flat[i : i + len(code)]
        inside = owner[: len(code)] == owner[n - 1 :] if len(code) else np.empty(0, bool)
        slot = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(dim)
        counts += np.bincount(owner[: len(code)][inside] * dim + slot[inside].astype(np.int64), minlength=len(bodies) * dim).reshape(-1, dim)
    return counts


def features(texts: list[bytes | None], dim: int = DIM) -> np.ndarray:
    """One row for each text: square roots of the shares of its hashed shape n-grams, bins of repetition, a constant. Null and empty texts have the constant alone.
    Texts longer than PART are counted by parts, whose counts add up to the whole text's."""
    bodies = [t or b"" for t in texts]
    counts = shape_counts([t if len(t) <= PART else b"" for t in bodies], dim)
    for row, text in zip(counts, bodies, strict=True):
        for at in range(0, len(text), PART) if len(text) > PART else ():
            for n in ORDERS:
                row += shape_counts([text[at : at + PART + n - 1]], dim, (n,))[0]
    total = counts.sum(axis=1, keepdims=True)
    return np.hstack([np.sqrt(counts / np.where(total > 0, total, 1)), repetition(bodies), np.ones((len(bodies), 1))]).astype(np.float32)


@dataclass
class QualityModel:
    """weights: of the standardised features, the constant last."""

    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        z = ((features(texts, len(self.weights) - 1 - 2 * BINS) - self.mean) / self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def risk_slope(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """The slope of the non-negative risk of weights over positives and unlabelled rows; where the part of the
    unlabelled rows turns negative, that part's slope turned round."""
    zp, zu = p @ w, u @ w
    of_unlabelled = (u.T @ sigmoid(zu)) / len(u)
    if np.logaddexp(0, zu).mean() >= prior * np.logaddexp(0, zp).mean():
        # Of positives the two losses' slopes add up to a constant.
        return of_unlabelled - prior * p.mean(axis=0)
    return prior * (p.T @ sigmoid(zp)) / len(p) - of_unlabelled


@dataclass
class Adam:
    w: np.ndarray

    def __post_init__(self):
        self.m, self.v = np.zeros((2, len(self.w)), np.float32)
        self.t = 0

    def step(self, slope: np.ndarray, rate: float) -> None:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * slope
        self.v = 0.999 * self.v + 0.001 * slope * slope
        self.w = self.w - rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def penalised(slope: np.ndarray, w: np.ndarray, penalty: float) -> np.ndarray:
    return slope + penalty * np.r_[w[:-1], 0]


def standard(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and scales of the features; the constant stays."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 0.003)
    mean[-1], scale[-1] = 0, 1
    return mean, scale


def fit_pu(x: np.ndarray, positives: int, prior: float, steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> QualityModel:
    """Minimises the non-negative risk with the logistic loss by Adam over the whole sample: `positives` rows of positives, then unlabelled ones. Standardises x in place."""
    mean, scale = standard(x)
    x -= mean
    x /= scale
    adam = Adam(np.zeros(x.shape[1], np.float32))
    for t in range(1, steps + 1):
        adam.step(penalised(risk_slope(adam.w, x[:positives], x[positives:], prior), adam.w, penalty), rate * (1 - 0.9 * t / steps))
    return QualityModel(adam.w.astype(np.float32), mean, scale, prior)


def class_prior(x: np.ndarray, positives: int, least: float = 0.2, steps: int = 200) -> float:
    """The share of positives among unlabelled rows (x: `positives` rows of positives, then unlabelled ones), kept within
    0.05 and 0.95: the least quotient of the shares of both above a score, for the upper scores with `least` of the
    positives at least. The scores are of a classifier fitted on the other half of the rows."""
    p, u = x[:positives], x[positives:]
    if min(len(p), len(u)) < 4:
        return 0.5
    model = fit_pu(np.vstack([p[::2], u[::2]]), len(p[::2]), 0.5, steps)
    zp, zu = (np.sort(((rows - model.mean) / model.scale) @ model.weights) for rows in (p[1::2], u[1::2]))
    cuts = np.quantile(zp, np.linspace(0.02, 1 - least, 40))
    above = lambda z: 1 - np.searchsorted(z, cuts) / len(z)
    return float(np.clip((above(zu) / above(zp)).min(), 0.05, 0.95))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    dim: int = DIM,
) -> QualityModel:
    """Learns from the rows of `labels` with label 1 and from all of `docs` as unlabelled text.

    The expected size of the sample of the start is bounded by `positives` and `unlabelled`; rows are chosen by a
    hash of id and text, so rows of one id don't come all or none. Null, empty and blank texts are unlabelled
    texts like others, and very long texts count whole. Without labels, or without documents of label 1 or
    any others in the sample, every score is 0.5.
    """
    keys = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col)).alias("__label"))
    zero = np.zeros(dim + 2 * BINS + 1, np.float32)
    untrained = QualityModel(zero, zero, zero + 1, 0.5)
    if keys.where(F.col("__label") == 1).isEmpty():
        return untrained
    n_docs = docs.count()

    def chosen(seed: int, most: int, of: int):
        uniform = F.pmod(F.xxhash64(F.coalesce(F.col("__id").cast("string"), F.lit("")), F.coalesce(F.col("__body"), F.lit("")), F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        return uniform < min(1.0, most / max(1, of))

    bodies = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__body"))
    good = keys.where(F.col("__label") == 1).select("__id")
    n_good = bodies.groupBy("__id").agg(F.count("*").alias("n")).join(good, "__id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    picked = bodies.where(chosen(10, positives, n_good)).join(good, "__id")
    sample = bodies.where(chosen(11, unlabelled, n_docs)).withColumn("kind", F.lit(0)).union(picked.withColumn("kind", F.lit(1)))

    def start():
        return lambda texts: [pa.array([x.tobytes() for x in np.rint(features(texts, dim)[:, :-1] * 255).astype(np.uint8)], pa.binary())]

    rows = map_texts(sample, ["kind"], "__body", [T.StructField("x", T.BinaryType())], start).toArrow()
    kind = rows.column("kind").to_numpy()
    width = dim + 2 * BINS
    bodies = rows.column("x").to_pylist()
    x = np.ones((len(kind), width + 1), np.float32)
    for row, at in zip(x, np.argsort(-kind, kind="stable").tolist(), strict=True):
        row[:width] = np.frombuffer(bodies[at], np.uint8)
    x[:, :width] /= 255
    good = int(kind.sum())
    if not 0 < good < len(kind):
        return untrained
    prior = class_prior(x, good)
    kept = x[:good].copy()
    return passed_over(bodies_of(docs, text_col), fit_pu(x, good, prior), kept, dim)


def bodies_of(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").cast("binary").alias("__body"))


def passed_over(docs: DataFrame, start: QualityModel, positives: np.ndarray, dim: int, penalty: float = PENALTY) -> QualityModel:
    """The model after one pass over all texts as unlabelled ones, from `start` in each task and averaged by their numbers."""
    shared = docs.sparkSession.sparkContext.broadcast((start, ((positives - start.mean) / start.scale).astype(np.float16)))

    def run(batches):
        model, p = shared.value
        p, adam, n = p.astype(np.float32), Adam(model.weights), 0
        waiting: list[np.ndarray] = []

        def step(u):
            # A part of the positives for each batch, in turn.
            mine = p[np.arange(adam.t * BATCH, adam.t * BATCH + min(BATCH, len(p))) % len(p)]
            adam.step(penalised(risk_slope(adam.w, mine, u, model.prior), adam.w, penalty), PASS_RATE)

        for batch in batches:
            for lo, hi in slices(np.asarray(pc.binary_length(batch.column(0)).fill_null(0))):
                rows = (features(batch.column(0).slice(lo, hi - lo).to_pylist(), dim) - model.mean) / model.scale
                n += len(rows)
                waiting.append(rows)
                if sum(map(len, waiting)) >= BATCH:
                    step(np.vstack(waiting))
                    waiting = []
        if waiting:
            step(np.vstack(waiting))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(adam.w)), pa.int32()), pa.array(np.full(len(adam.w), n)), pa.array(adam.w.astype(np.float64))], names=["at", "n", "w"])

    means = docs.mapInArrow(run, "at int, n long, w double").groupBy("at").agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w"))
    weights = start.weights.copy()
    for r in means.collect():  # a row for each feature
        weights[r["at"]] = r["w"]
    return QualityModel(weights, start.mean, start.scale, start.prior)


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of `docs`: its id, `score` (0 to 1) and `predicted` (1 from `threshold` on).

    Null and empty texts get the score of a text without features. Very long texts count whole. Repeated rows
    stay, an empty table gives an empty result, and other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        held = shared.value

        def work(texts):
            s = held.score(texts).astype(np.float64)
            return [pa.array(s), pa.array((s >= threshold).astype(np.int32))]

        return work

    return map_texts(docs, [id_col], text_col, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], start)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5, held_fold: int = 0) -> DataFrame:
    """score() with a model that learns labels only outside the held-out fold, and `held_out`."""
    model = fit(docs, labels.where(id_remainder(id_col, folds) != held_fold), id_col, text_col, label_col)
    return score(docs, model, id_col, text_col).withColumn("held_out", id_remainder(id_col, folds) == held_fold)
