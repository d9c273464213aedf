"""A toxicity classifier of subword bags: averaged embeddings into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams between its boundaries, and itself. N-grams are hashed to rows of an embedding
table, so a misspelling that no training text has still shares most of its rows with the word it stands for. The rows of a
window of words are averaged, and a softmax of two classes is linear in the average.

A text is as toxic as its most toxic window, so an insult counts alike in short and long texts. Labels are of whole texts:
training begins with a text's average over all windows, then goes on with the window that a text's label is most likely due
to, which is chosen anew in each epoch, and a random one of texts of label 0. A logistic curve over texts that training left
out turns the highest window's log odds into the score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import id_remainder, map_texts, pieces

#: Rows and width of the embedding table, lengths of n-grams, words of a window, and the most characters of a word; longer
#: ones, which no language has, are cut into several.
ROWS, WIDTH, ORDERS, WINDOW, LONGEST = 1 << 18, 12, (3, 4, 5, 6), 8, 64

#: Expected documents of each label in the sample that is learned from, and the most words of one of them; of a longer text
#: windows are drawn evenly over its length.
POSITIVES, NEGATIVES, MOST_WORDS = 2500, 5000, 2048

#: Epochs over whole texts and over chosen windows, windows of a step, the step size, what averages are multiplied with, and
#: one text in this many is left for the curve.
WHOLE, CHOSEN, BATCH, RATE, SCALE, LEFT_OUT = 1, 6, 48, 0.3, 8.0, 5

#: Texts that a row's n-grams must occur in to be trained; rarer ones stay zero, as they tell single texts apart.
LEAST_TEXTS = 10

#: Words whose sums a worker remembers.
REMEMBERED = 300_000

#: Score from which a document counts as toxic.
THRESHOLD = 0.3

#: Characters taken off both ends of a word.
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words_of(text: bytes | None) -> Iterator[list[str]]:
    """A text's words in lower case without marks at their ends, in parts."""
    for part in pieces(text or b""):
        found = [w.strip(EDGES) for w in part.decode("utf-8", "replace").lower().split()]
        if max(map(len, found), default=0) > LONGEST:
            found = [w[i : i + LONGEST] for w in found for i in range(0, len(w), LONGEST)]
        yield [w for w in found if w]


def subwords(words: list[str], rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """The table rows of all words, one after another, and how many each word has (one at least)."""
    marked = [f"<{w}>" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), sizes)
    found, owners = [np.fromiter((zlib.crc32(m.encode("utf-8", "surrogatepass")) % rows for m in marked), np.int64, len(marked))], [np.arange(len(marked))]
    for n in ORDERS:
        code = np.full(max(0, len(codes) - n + 1), n, np.uint64)
        for i in range(n):
            code = (code ^ codes[i : i + len(code)]) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        inside = owner[: len(code)] == owner[n - 1 :] if len(code) else np.empty(0, bool)
        found.append(((code >> np.uint64(20)) % np.uint64(rows)).astype(np.int64)[inside])
        owners.append(owner[: len(code)][inside])
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(found)[order], np.bincount(np.concatenate(owners), minlength=len(marked))


def window_starts(n: int, window: int = WINDOW) -> np.ndarray:
    """Where the windows of n words begin: every half window, and the last one at the end."""
    return np.unique(np.r_[np.arange(0, max(1, n - window + 1), window // 2), max(0, n - window)])


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + sizes[i]] for all i, one after another."""
    ends = np.cumsum(sizes)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


def summed(values: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct groups, and the sums of their rows of values."""
    order = np.argsort(groups, kind="stable")
    held = groups[order]
    first = np.flatnonzero(np.r_[True, held[1:] != held[:-1]])
    return held[first], np.add.reduceat(values[order], first)


def runs_of(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of values; zero for an empty run."""
    out = np.zeros((len(sizes), *values.shape[1:]), values.dtype)
    held = sizes > 0
    if len(values):
        out[held] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[held])
    return out


def rows_in_texts(ids: np.ndarray, sizes: np.ndarray, texts: list[np.ndarray], rows: int) -> np.ndarray:
    """How many texts, given as their words' numbers, hold each row."""
    starts, count = np.cumsum(sizes) - sizes, np.zeros(rows, np.int64)
    for words in texts:
        used = np.unique(words)
        count[np.unique(gathered(ids, starts[used], sizes[used]))] += 1
    return count


class Trainer:
    """The embedding table and the softmax while they are trained; rows that no training word has stay zero."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, trained: np.ndarray, width: int = WIDTH, seed: int = 11):
        """ids, sizes: subwords() of the vocabulary; trained: which rows of the table are."""
        rows = len(trained)
        self.totals = sizes
        owner = np.repeat(np.arange(len(sizes)), sizes)[trained[ids]]
        self.ids, self.sizes = ids[trained[ids]], np.bincount(owner, minlength=len(sizes))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.table, self.table_squares = np.zeros((rows, width), np.float32), np.zeros(rows, np.float32)
        side = np.random.default_rng(seed).choice([-1.0, 1.0], width) / np.sqrt(width)
        self.out, self.bias = np.stack([-side, side], axis=1).astype(np.float32), np.zeros(2, np.float32)
        self.out_squares, self.bias_squares = np.zeros_like(self.out), np.zeros_like(self.bias)

    def step(self, words: np.ndarray, sizes: np.ndarray, labels: np.ndarray, weights: np.ndarray, rate: float) -> None:
        """One step of descent over bags of words (vocabulary numbers, and how many each bag has), by Adagrad."""
        used, at = np.unique(words, return_inverse=True)
        rows, n_rows = gathered(self.ids, self.starts[used], self.sizes[used]), self.sizes[used]
        vectors = runs_of(self.table[rows], n_rows)
        firsts, bag = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
        totals = np.add.reduceat(self.totals[used][at], firsts).astype(np.float32)
        mean = SCALE * np.add.reduceat(vectors[at], firsts) / totals[:, None]
        logits = mean @ self.out + self.bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = (p - np.eye(2, dtype=np.float32)[labels]) * weights[:, None]
        of_rows = (SCALE * (slope @ self.out.T) / totals[:, None]).astype(np.float32)
        of_words = summed(of_rows[bag], at)[1]
        touched, g = summed(np.repeat(of_words, n_rows, axis=0), rows)
        self.table_squares[touched] += (g * g).mean(axis=1)
        self.table[touched] -= rate * g / np.sqrt(self.table_squares[touched] + 1e-8)[:, None]
        for held, squares, h in ((self.out, self.out_squares, mean.T @ slope / len(sizes)), (self.bias, self.bias_squares, slope.mean(axis=0))):
            squares += h * h
            held -= 0.1 * rate * h / np.sqrt(squares + 1e-8)

    def row_odds(self) -> np.ndarray:
        """What each row adds to the log odds of label 1, before it is divided by a bag's rows."""
        return SCALE * (self.table @ (self.out[:, 1] - self.out[:, 0]))


@dataclass
class ToxicityModel:
    """odds: of each row of the table; bias of the log odds; curve: slope and offset of the score's logistic curve."""

    odds: np.ndarray
    bias: float
    curve: tuple[float, float]

    def word_sums(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The sum of each word's row odds, and how many rows it has."""
        ids, sizes = subwords(words, len(self.odds))
        return np.add.reduceat(self.odds[ids], np.cumsum(sizes) - sizes), sizes

    def score(self, odds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * odds + self.curve[1], -30, 30)))


def highest(sums: np.ndarray, sizes: np.ndarray, bias: float) -> float:
    """The highest log odds of a text's windows, from its words' sums and rows; the bias of a text without words."""
    if not len(sums):
        return bias
    starts = window_starts(len(sums))
    total, rows = (np.r_[0.0, np.cumsum(x, dtype=np.float64)] for x in (sums, sizes))
    ends = np.minimum(starts + WINDOW, len(sums))
    return float(((total[ends] - total[starts]) / (rows[ends] - rows[starts])).max() + bias)


def curve_of(x: np.ndarray, y: np.ndarray, weights: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope (not negative) and offset of the logistic curve through weighted labels, by Newton's steps with a small penalty."""
    a, b = 1.0, 0.0
    design = np.stack([x, np.ones_like(x)], axis=1)
    weights = weights / weights.mean()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        slope = design.T @ (weights * (p - y)) + 0.1 * np.array([a - 1, b])
        bend = (design * (weights * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -2, 2))
    return max(a, 0.0), b


def train(texts: Iterable[list[str]], labels: np.ndarray, prior_weights: np.ndarray, rows: int = ROWS, seed: int = 11) -> ToxicityModel:
    """A model of texts, given as their words (one at least), and their labels. prior_weights: how many documents each text stands for."""
    random = np.random.default_rng(seed)
    number: dict[str, int] = {}
    bags = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)) for words in texts]
    ids, sizes = subwords(list(number), rows)
    place = random.permutation(len(bags))
    kept, left = np.sort(place[len(place) // LEFT_OUT :]), place[: len(place) // LEFT_OUT]
    trainer = Trainer(ids, sizes, rows_in_texts(ids, sizes, [bags[i] for i in kept], rows) >= LEAST_TEXTS, seed=seed)
    flat = np.concatenate(bags)
    per_text = [window_starts(len(b), WINDOW) for b in bags]
    first = np.cumsum([len(x) for x in per_text]) - [len(x) for x in per_text]
    ends = np.cumsum([len(b) for b in bags])
    starts = np.concatenate([x + (end - len(b)) for x, end, b in zip(per_text, ends, bags, strict=True)])
    of_text = np.repeat(np.arange(len(bags)), [len(x) for x in per_text])
    stops = np.minimum(starts + WINDOW, ends[of_text])
    balance = np.where(labels == 1, 1.0, (labels[kept] == 1).sum() / max(1, (labels[kept] == 0).sum())).astype(np.float32)

    def epoch(chosen: list[np.ndarray], of: np.ndarray, batch: int, rate: float) -> None:
        order = random.permutation(len(chosen))
        for lo in range(0, len(order), batch):
            held = order[lo : lo + batch]
            trainer.step(np.concatenate([chosen[i] for i in held]), np.array([len(chosen[i]) for i in held]), labels[of[held]], balance[of[held]], rate)

    def odds_of_windows() -> np.ndarray:
        sums = np.add.reduceat(trainer.row_odds()[ids], np.cumsum(sizes) - sizes)
        total, n = (np.r_[0.0, np.cumsum(x[flat], dtype=np.float64)] for x in (sums, sizes))
        return (total[stops] - total[starts]) / (n[stops] - n[starts])

    for t in range(WHOLE):
        epoch([bags[i] for i in kept], kept, BATCH, RATE / (1 + t))
    for t in range(CHOSEN):
        odds = odds_of_windows()
        tops = np.lexsort((-odds, of_text))[first]
        some = first[kept] + (random.random(len(kept)) * np.bincount(of_text)[kept]).astype(np.int64)
        picks = np.unique(np.r_[tops[kept], some[labels[kept] == 0]])
        epoch([flat[starts[w] : stops[w]] for w in picks], of_text[picks], BATCH, RATE / (1 + t))
    bias = float(trainer.bias[1] - trainer.bias[0])
    model = ToxicityModel(trainer.row_odds().astype(np.float32), bias, (1.0, 0.0))
    if len(set(labels[left].tolist())) == 2:
        model.curve = curve_of(np.maximum.reduceat(odds_of_windows(), first)[left] + bias, labels[left].astype(np.float64), prior_weights[left])
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    rows: int = ROWS,
) -> ToxicityModel:
    """Learns from the texts that `labels` has an id and a label of.

    The sample is bounded: `positives` and `negatives` documents are expected of the two labels, chosen by a hash of id and
    text, and MOST_WORDS words of a text. Of ids with both labels 1 counts; null ids and labels, and texts without words, are
    left out. Without a text of each label every score is the share of label 1 among the labelled, or 0 if none is.
    """
    keys = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("__label"))
    bodies = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__body"))
    # Counted by id first, so an id that many rows share is one row of the join.
    per_id = bodies.where(F.col("__id").isNotNull()).groupBy("__id").agg(F.count("*").alias("n"))
    n = {r["__label"]: r["n"] for r in per_id.join(keys, "__id").groupBy("__label").agg(F.sum("n").alias("n")).collect()}
    share = {k: min(1.0, most / n[k]) if n.get(k) else 0.0 for k, most in ((1, positives), (0, negatives))}
    uniform = F.pmod(F.xxhash64(F.col("__id").cast("string"), F.coalesce("__body", F.lit("")), F.lit(23)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    # Rows that no label could choose go before the join.
    likely = bodies.withColumn("__u", uniform).where(F.col("__u") < max(share.values()))
    picked = likely.join(keys, "__id").where(F.col("__u") < F.when(F.col("__label") == 1, share[1]).otherwise(share[0]))

    def start():
        def drawn(text: bytes | None) -> str:
            words = [w for part in words_of(text) for w in part]
            if len(words) > MOST_WORDS:
                at = np.linspace(0, len(words) - WINDOW, MOST_WORDS // WINDOW).astype(int)
                words = [w for i in at for w in words[i : i + WINDOW]]
            return " ".join(words)

        return lambda texts: [pa.array([drawn(t) for t in texts], pa.string())]

    sample = map_texts(picked, ["__label"], "__body", [T.StructField("words", T.StringType())], start).toArrow()
    texts, marks = sample.column("words").to_pylist(), sample.column("__label").to_pylist()
    pairs = sorted((t, m) for t, m in zip(texts, marks, strict=True) if t)  # in no order of tasks
    mark = np.array([m for _, m in pairs], np.int64)
    if len(set(mark.tolist()) & {0, 1}) < 2:
        total = sum(n.values())
        part = n.get(1, 0) / total if total else 0.0
        return ToxicityModel(np.zeros(rows, np.float32), 0.0, (0.0, float(np.log(part / (1 - part))) if 0 < part < 1 else (30.0 if part else -30.0)))
    weight = np.where(mark == 1, n[1] / (mark == 1).sum(), n[0] / (mark == 0).sum())
    return train((t.split(" ") for t, _ in pairs), mark, weight, rows)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of `docs`: its id, `score` (0 to 1) and `predicted` (1 from `threshold` on).

    Null, empty and blank texts, and those of marks alone, have the score of a text without words. Very long texts count
    whole, in parts. Repeated rows stay, equal texts have equal scores, an empty table gives an empty result, and other
    columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        held = shared.value
        sums: dict[str, float] = {}
        sizes: dict[str, int] = {}

        def odds(text: bytes | None) -> float:
            found = []
            for words in words_of(text):
                if len(sums) > REMEMBERED:
                    sums.clear()
                    sizes.clear()
                new = [w for w in set(words) if w not in sums]
                if new:
                    s, n = held.word_sums(new)
                    sums.update(zip(new, s.tolist(), strict=True))
                    sizes.update(zip(new, n.tolist(), strict=True))
                found.append((np.fromiter(map(sums.__getitem__, words), np.float32, len(words)), np.fromiter(map(sizes.__getitem__, words), np.int32, len(words))))
            return highest(np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]), held.bias)

        def work(texts):
            s = held.score(np.array([odds(t) for t in texts], np.float64))
            return [pa.array(s), pa.array((s >= threshold).astype(np.int32))]

        return work

    return map_texts(docs, [id_col], text_col, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], start)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 4, held_fold: int = 2) -> DataFrame:
    """score() with a model that learns labels only outside the held-out fold, and `held_out`."""
    model = fit(docs, labels.where(id_remainder(id_col, folds) != held_fold), id_col, text_col, label_col)
    return score(docs, model, id_col, text_col).withColumn("held_out", id_remainder(id_col, folds) == held_fold)
