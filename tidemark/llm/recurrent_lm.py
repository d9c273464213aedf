"""A gated recurrent language model over words, trained and applied in numpy inside Spark tasks.

Vocabulary and counts come from all training texts. The output is factored into classes: the most
frequent words fill classes by frequency, in which a softmax chooses the word; the other words fall
into classes by their first two bytes, in which the word's smoothed share of the corpus counts is used,
with one more type for unseen words. So the model is a distribution over the same types as the unigram
base, of any vocabulary size.

Training is truncated backpropagation through windows of words with the state carried from window to
window, from a text's first word to its end. It is one pass over every word of every training text, cut
into rounds by a hash of the text: in a round, tasks train on their own texts from common weights, which
are averaged after it. Scoring carries the state from a text's first word to its end, over whole texts.

Texts run through lanes side by side; a lane that ends its text takes the next one. So a task holds the
texts of its lanes and a bounded supply of further ones, and its memory doesn't depend on how much the
lengths of texts differ.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ARROW_ROWS, id_remainder, shared_checkpoint, slices

#: Words with their own output, words of a class, classes of the other words, units, and numbers that
#: describe an input word.
HEAD, CLASS_WORDS, TAIL_CLASSES, UNITS, INPUT = 512, 16, 32, 16, 8

#: Words whose counts each worker holds at most; the counts of the others are joined.
KNOWN = 200_000

#: Step sizes of the rounds of training, words of a window, lanes, and least updates of a task and
#: round; a task of fewer goes over its texts again.
RATES, WINDOW, LANES, LEAST_UPDATES = (0.01, 0.006, 0.003), 24, 256, 40

#: Smoothing of counts, words of the supply that lanes draw from, lanes and words of a window of
#: scoring, words of a count table, and bytes of a text that are split at once.
SMOOTH, SUPPLY, SCORE_LANES, SCORE_WINDOW, TABLE_WORDS, PIECE = 0.1, 1_500_000, 512, 48, 1_000_000, 1 << 22

#: The end of a text; no word is empty.
END = b""

#: Floats of a block in which weights are averaged, and groups of the first averaging step.
BLOCK, FIRST_GROUPS = 8192, 32

#: What separates words.
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces(text: bytes | None) -> Iterator[bytes]:
    """A text cut at spaces into pieces of about PIECE bytes."""
    text, at = text or b"", 0
    while len(text) - at > PIECE and (cut := SPACE.search(text, at + PIECE)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts (binary), A-Z in lower case, and how many each text has."""
    bare = pc.ascii_trim_whitespace(pc.ascii_lower(texts.view(pa.string()).fill_null("")))
    lists = pc.ascii_split_whitespace(bare)
    words, ends = lists.flatten(), np.asarray(lists.offsets).astype(np.int64)
    full = np.asarray(pc.binary_length(words)) > 0
    if not full.all():
        # A blank text comes as one empty word.
        words, ends = words.filter(pa.array(full)), np.r_[0, np.cumsum(full)][ends - ends[0]]
    return words, np.diff(ends)


def text_slices(texts: pa.Array) -> Iterator[tuple[int, int, pa.Array]]:
    """Slices of about PIECE bytes: the number of the first text, how many there are, and the texts; of a longer text its pieces."""
    for lo, hi in slices(np.asarray(pc.binary_length(texts).fill_null(0)), PIECE):
        part = texts.slice(lo, hi - lo)
        yield lo, hi - lo, pa.array(list(pieces(part[0].as_py())), pa.binary()) if hi - lo == 1 else part


def with_ends(values: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """Values of texts of these sizes with an end behind each text."""
    out = np.full(len(values) + len(sizes), end, values.dtype)
    out[np.arange(len(values)) + np.repeat(np.arange(len(sizes)), sizes)] = values
    return out


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[:2]) % TAIL_CLASSES


def tail_classes() -> np.ndarray:
    """The class of a word by its first two bytes, and by its only byte in the last column."""
    return np.array([[tail_class(bytes([a, b]) if b < 256 else bytes([a])) for b in range(257)] for a in range(256)], np.int16)


def count_words(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n) over all texts, ends included; tasks add up before the shuffle."""

    def run(batches):
        def added(parts):
            return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        held, rows, texts = [], 0, 0
        for batch in batches:
            for _, n, part in text_slices(batch.column(0)):
                found = split_words(part)[0].value_counts()
                held.append(pa.table({"word": found.field(0).view(pa.binary()), "n": found.field(1)}))
                rows, texts = rows + len(found), texts + n
                if rows > TABLE_WORDS:
                    held = [added(held)]
                    rows = held[0].num_rows
                    if rows > TABLE_WORDS // 2:
                        yield from held[0].to_batches()
                        held, rows = [], 0
        if texts:
            held.append(pa.table({"word": pa.array([END], pa.binary()), "n": pa.array([texts], pa.int64())}))
            yield from added(held).to_batches()

    bodies = docs.select(F.col(text_col).cast("string").cast("binary").alias("t"))
    return bodies.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Counts of all training words together, of tail classes, and of the most frequent words."""

    tokens: int
    types: int
    words: list[bytes]
    counts: np.ndarray
    tail_tokens: np.ndarray
    tail_types: np.ndarray

    def __post_init__(self):
        self.words = pa.array(self.words, pa.binary()).view(pa.string())
        self.head = min(HEAD, len(self.words))
        self.head_classes = -(-self.head // CLASS_WORDS)
        self.tails = tail_classes() + np.int16(self.head)
        self.log_count = np.log10(self.counts + SMOOTH)
        self.base_norm = np.log10(self.tokens + SMOOTH * (self.types + 1))
        self.tail_norm = np.log10(self.tail_tokens + SMOOTH * (self.tail_types + 1))
        self.end = pc.index(self.words, pa.scalar("")).as_py()
        # The start of a text reads as the end of another.
        self.first = self.end if 0 <= self.end < self.head else self.head + tail_class(END)

    def slots(self, words: pa.Array, among: int | None = None) -> np.ndarray:
        """The places of words among the first held ones; -1: not there."""
        return np.asarray(pc.index_in(words, value_set=self.words.slice(0, among)).fill_null(-1))

    def symbols(self, words: pa.Array, slots: np.ndarray) -> np.ndarray:
        """Symbols of words with these slots."""
        if not len(words):
            return np.empty(0, np.int16)
        places = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)
        start, size = places[:-1], np.diff(places)
        second = np.where(size > 1, data[np.minimum(start + 1, len(data) - 1)], np.int16(256))
        return np.where((slots >= 0) & (slots < self.head), slots, self.tails[data[start], second]).astype(np.int16)

    def read(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The symbols of each text and its end."""
        for _, n, part in text_slices(texts):
            words, sizes = split_words(part)
            sizes = sizes if n > 1 else sizes.sum(keepdims=True)
            symbols = with_ends(self.symbols(words, self.slots(words, self.head)), sizes, self.first)
            yield from np.split(symbols, np.cumsum(sizes + 1)[:-1])

    def look_up(self, texts: pa.Array) -> Iterator[tuple]:
        """Of each text and its end: symbols, held words, their sum of log counts, what tail words' shares of their classes add, and the words that aren't held."""
        for _, n, part in text_slices(texts):
            words, sizes = split_words(part)
            sizes = sizes if n > 1 else sizes.sum(keepdims=True)
            slots = self.slots(words)
            symbols = with_ends(self.symbols(words, slots), sizes, self.first)
            away = slots < 0
            rare = words.filter(pa.array(away)).view(pa.binary())
            cuts = np.r_[0, np.cumsum(sizes)]
            cuts = np.r_[0, np.cumsum(away)][cuts]
            slots = with_ends(slots, sizes, self.end)
            starts = np.cumsum(sizes + 1) - sizes - 1
            logs = np.where(slots >= 0, self.log_count[slots], 0.0) if len(self.log_count) else np.zeros(len(slots))
            tails = np.where(symbols >= self.head, logs - self.tail_norm[np.maximum(symbols - self.head, 0)], 0.0)
            held, sums, tail_sums = (np.add.reduceat(x, starts) for x in ((slots >= 0).astype(np.int64), logs, tails))
            for i, text in enumerate(np.split(symbols, starts[1:])):
                lost = pa.ListArray.from_arrays(pa.array([0, cuts[i + 1] - cuts[i]], pa.int32()), rare.slice(cuts[i], cuts[i + 1] - cuts[i]))
                yield text, int(held[i]), float(sums[i]), float(tail_sums[i]), lost if self.end >= 0 else pa.array([[*lost[0].as_py(), END]], pa.list_(pa.binary()))


def held_words(counts: DataFrame, known: int = KNOWN) -> Column:
    """Whether a row of a (word, n) table is among those that workers hold, `known` at most: levels of n from
    the greatest on, and of the first level that is too large as many hash buckets of words as fit."""
    level, bucket = F.floor(F.log2("n") * 32).cast("int"), F.pmod(F.xxhash64("word"), F.lit(1024)).cast("int")
    levels = sorted(((r["level"], r["count"]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)
    held, least = 0, None
    for at, size in levels:
        if held + size > known:
            buckets, room = counts.where(level == at).groupBy(bucket.alias("bucket")).count().orderBy("bucket").collect(), known - held
            sizes = np.cumsum([r["count"] for r in buckets])
            last = buckets[int((sizes <= room).sum()) - 1]["bucket"] if sizes[0] <= room else -1
            return (level > at) | ((level == at) & (bucket <= last))
        held, least = held + size, at
    return level >= least if levels else F.lit(True)


def vocabulary(counts: DataFrame, held: Column) -> Vocabulary:
    """The vocabulary of a (word, n) table, of whose rows it holds some."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = counts.where(held).toPandas().sort_values(["n", "word"], ascending=[False, True])
    tails = counts.groupBy((F.crc32(F.substring("word", 1, 2)) % TAIL_CLASSES).cast("int").alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    tokens, types = np.zeros((2, TAIL_CLASSES), np.int64)
    for r in tails:
        tokens[r["c"]], types[r["c"]] = r["n"], r["v"]
    for w, n in zip(top["word"][:HEAD], top["n"][:HEAD], strict=True):
        tokens[tail_class(w)] -= n
        types[tail_class(w)] -= 1
    return Vocabulary(int(total["n"]), int(total["v"]), [bytes(w) for w in top["word"]], top["n"].to_numpy(np.int64), tokens, types)


def exponentials(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replaces v by exp(v - top), where top is zero for values near it and each row's greatest else; the rows' sums and the logs of the sums of exp(v)."""
    top = None
    if v.max() > 60 or v.min() < -60:
        top = v.max(axis=1, keepdims=True)
        v -= top
    np.exp(v, out=v)
    sums = v @ np.ones(v.shape[1], np.float32)
    return sums, np.log(sums) if top is None else np.log(sums) + top[:, 0]


class Network:
    """Weights: what describes a symbol, its gates, the gates of the state, classes and words, the last two with a bias as last column.

    States and gates are kept feature by lane, so that each gate is one block of memory.
    """

    def __init__(self, vocab: Vocabulary, weights: np.ndarray | None = None):
        self.head, self.head_classes = vocab.head, vocab.head_classes
        classes, h = self.head_classes + TAIL_CLASSES, UNITS
        self.shapes = {"seen": (self.head + TAIL_CLASSES, INPUT), "into": (3 * h, INPUT), "state": (3 * h, h), "to_class": (classes, h + 1), "to_word": (self.head, h + 1)}
        size = sum(int(np.prod(s)) for s in self.shapes.values())
        self.flat = np.zeros(size, np.float32) if weights is None else weights.copy()
        self.views()
        if weights is None:
            rng = np.random.default_rng(1)
            for name, scale in (("seen", 1.0), ("into", 0.2), ("state", 0.15), ("to_class", 0.1), ("to_word", 0.1)):
                getattr(self, name)[...] = rng.normal(0, scale, self.shapes[name])
            self.seen[:, 0] = 1
            n = vocab.counts[: self.head] + SMOOTH
            mass = np.bincount(np.arange(self.head) // CLASS_WORDS, weights=n, minlength=self.head_classes)
            self.to_word[:, h] = np.log(n / np.repeat(mass, CLASS_WORDS)[: self.head])
            mass = np.r_[mass, np.maximum(vocab.tail_tokens + SMOOTH * (vocab.tail_types + 1), SMOOTH)]
            self.to_class[:, h] = np.log(mass / mass.sum())

    def views(self) -> None:
        at = 0
        for name, shape in self.shapes.items():
            n = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + n].reshape(shape))
            at += n

    def slopes(self) -> Network:
        """Zeros in the form of this network."""
        other = Network.__new__(Network)
        other.shapes, other.flat = self.shapes, np.zeros_like(self.flat)
        other.views()
        return other

    def forward(self, symbols: np.ndarray, fresh: list[list[int]], state: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """States (time, feature, lane) after each of the symbols (time, lane); those of the lanes `fresh` at a time are cleared before it."""
        h, (steps, lanes) = UNITS, symbols.shape
        seen = self.seen[symbols.ravel()]
        x = (self.into @ seen.T).reshape(3 * h, steps, lanes)
        g, out = np.empty((3 * h, lanes), np.float32), np.empty((steps, h, lanes), np.float32)
        if keep is not None:
            before, new, inner = np.empty((3, steps, h, lanes), np.float32)
            gates = np.empty((steps, 2 * h, lanes), np.float32)
            keep.update(seen=seen, before=before, gates=gates, new=new, inner=inner)
        for t in range(steps):
            if fresh[t]:
                state = state.copy()
                state[:, fresh[t]] = 0
            np.matmul(self.state, state, out=g)
            both = np.add(x[: 2 * h, t], g[: 2 * h], out=None if keep is None else gates[t])
            np.tanh(both, out=both)
            both += 1
            both *= 0.5
            now = np.multiply(both[h:], g[2 * h :])
            now += x[2 * h :, t]
            now = np.tanh(now, out=now if keep is None else new[t])
            if keep is not None:
                before[t], inner[t] = state, g[2 * h :]
            state = np.subtract(state, now, out=out[t])
            state *= both[:h]
            state += now
        return out

    def class_of(self, targets: np.ndarray) -> np.ndarray:
        return np.where(targets < self.head, targets // CLASS_WORDS, targets - self.head + self.head_classes)

    def outputs(self, states: np.ndarray, targets: np.ndarray, grad: Network | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each target (of a tail word: of its class) by its state, whose last column is one; the loss's slope by state."""
        rows = np.arange(len(targets))
        classes = self.class_of(targets)
        v = states @ self.to_class.T
        logp = v[rows, classes]
        sums, logs = exponentials(v)
        logp -= logs
        slope = None
        if grad is not None:
            v[rows, classes] -= sums
            part = 1 / sums[:, None]
            grad.to_class += v.T @ (states * part)
            slope = v @ self.to_class
            slope *= part
        at = np.flatnonzero(targets < self.head)
        at = at[np.argsort(classes[at].astype(np.int16), kind="stable")]
        edges = np.searchsorted(classes[at], np.arange(self.head_classes + 1)).tolist()
        s, y, found = states[at], targets[at] % CLASS_WORDS, np.empty(len(at), np.float32)
        back = None if grad is None else np.empty_like(s)
        for c, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
            if lo == hi:
                continue
            words = slice(c * CLASS_WORDS, min(self.head, (c + 1) * CLASS_WORDS))
            v = s[lo:hi] @ self.to_word[words].T
            best = v[rows[: hi - lo], y[lo:hi]]
            sums, logs = exponentials(v)
            found[lo:hi] = best - logs
            if grad is not None:
                v[rows[: hi - lo], y[lo:hi]] -= sums
                v /= sums[:, None]
                grad.to_word[words] += v.T @ s[lo:hi]
                np.matmul(v, self.to_word[words], out=back[lo:hi])
        logp[at] += found
        if grad is not None:
            slope[at] += back
        return logp, slope

    def step(self, w: Window, state: np.ndarray, grad: Network) -> tuple[np.ndarray, float]:
        """One window: sets `grad` to the mean loss's slope, cut off at the window's start; the last state and the loss."""
        h, (steps, lanes) = UNITS, w.inputs.shape
        keep: dict = {}
        states = self.forward(w.inputs, w.fresh, state, keep)
        grad.flat[:] = 0
        logp, slope = self.outputs(w.flat(states), w.live_targets(), grad)
        if w.live is None:
            ahead = slope[:, :h].reshape(steps, lanes, h)
        else:
            ahead = np.zeros((steps, lanes, h), np.float32)
            ahead[w.live] = slope[:, :h]
        ahead = np.ascontiguousarray(ahead.transpose(0, 2, 1))
        before, new, inner, z, r = keep["before"], keep["new"], keep["inner"], keep["gates"][:, :h], keep["gates"][:, h:]
        # Gates are (1 + tanh) / 2, so their slope is 2 z (1 - z).
        keep_z = 1 - z
        by_new = keep_z * (1 - new * new)
        by_z = 2 * (before - new) * (z * keep_z)
        by_r = 2 * inner * (r * (1 - r))
        slopes = np.empty((3 * h, steps, lanes), np.float32)
        back, dg = np.zeros((h, lanes), np.float32), np.empty((3 * h, lanes), np.float32)
        turned = np.ascontiguousarray(self.state.T)
        for t in range(steps - 1, -1, -1):
            d = ahead[t]
            d += back
            dn = d * by_new[t]
            np.multiply(d, by_z[t], out=dg[:h])
            np.multiply(dn, by_r[t], out=dg[h : 2 * h])
            np.multiply(dn, r[t], out=dg[2 * h :])
            slopes[: 2 * h, t], slopes[2 * h :, t] = dg[: 2 * h], dn
            grad.state += dg @ before[t].T
            np.matmul(turned, dg, out=back)
            d *= z[t]
            back += d
            if w.fresh[t]:
                back[:, w.fresh[t]] = 0
        rows = slopes.reshape(3 * h, -1)
        grad.into += rows @ keep["seen"]
        of_seen = rows.T @ self.into
        flat = w.inputs.ravel()
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        starts = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        grad.seen[flat[starts]] += np.add.reduceat(of_seen[order], starts, axis=0)
        grad.flat /= len(logp)
        return states[-1], -float(logp.sum()) / len(logp)


@dataclass
class Window:
    """Words of lanes side by side: inputs and targets (time, lane), where they are words (None: everywhere), the
    lanes that start a text by time, the lanes of the window before that go on, and the parts of texts as
    (key, place in the lane-major order, end of the text)."""

    inputs: np.ndarray
    targets: np.ndarray
    live: np.ndarray | None
    fresh: list[list[int]]
    onward: list[int]
    parts: list[tuple]

    def carried(self, state: np.ndarray) -> np.ndarray:
        """The state of the window before for this window's lanes; new ones have none."""
        if len(self.onward) == state.shape[1] == self.inputs.shape[1]:
            return state
        out = np.zeros((UNITS, self.inputs.shape[1]), np.float32)
        out[:, : len(self.onward)] = state[:, self.onward]
        return out

    def flat(self, states: np.ndarray) -> np.ndarray:
        """States of the words as rows, with a last column of ones."""
        steps, h, lanes = states.shape
        out = np.ones((steps, lanes, h + 1), np.float32)
        out[:, :, :h] = states.transpose(0, 2, 1)
        return out.reshape(-1, h + 1) if self.live is None else out[self.live]

    def live_targets(self) -> np.ndarray:
        return self.targets.ravel() if self.live is None else self.targets[self.live]


def lane_windows(texts: Iterable[tuple], first: int, lanes: int, window: int, supply: int = SUPPLY) -> Iterator[Window]:
    """Windows over all of the texts, (key, symbols) each. A lane that ends its text goes on with the longest of
    the supply, which is filled up to `supply` words with the lanes' texts included."""
    source, heap, cur = iter(texts), [], []
    held, number, onward = 0, 0, []

    def taken():
        nonlocal held, number, source
        while source is not None and held < supply:
            item = next(source, None)
            if item is None:
                source = None
                break
            text = np.concatenate([[first], item[1]], dtype=np.int16)
            heapq.heappush(heap, (-len(text), number, item[0], text))
            held, number = held + len(text), number + 1
        return heapq.heappop(heap)[2:] if heap else None

    while True:
        while len(cur) < lanes and (text := taken()):
            cur.append([*text, 0])
        if not cur:
            return
        inputs, targets = np.full((2, len(cur), window), first, np.int16)
        live, full = np.ones((len(cur), window), bool), True
        fresh: list[list[int]] = [[] for _ in range(window)]
        parts, next_on = [], []
        for row, lane in enumerate(cur):
            at = 0
            while True:
                key, text, place = lane
                n = min(window - at, len(text) - 1 - place)
                inputs[row, at : at + n] = text[place : place + n]
                targets[row, at : at + n] = text[place + 1 : place + 1 + n]
                if not place:
                    fresh[at].append(row)
                ends = place + n == len(text) - 1
                parts.append((key, row * window + at, ends))
                at += n
                lane[2] = place + n
                if ends:
                    held -= len(text)
                    more = taken()
                    if more is None:
                        live[row, at:], full = False, full and at == window
                        lane[1] = None
                        break
                    lane[:] = [*more, 0]
                if at == window:
                    break
            if lane[1] is not None:
                next_on.append(row)
        yield Window(np.ascontiguousarray(inputs.T), np.ascontiguousarray(targets.T), None if full else live.T, fresh, onward, parts)
        cur, onward = [cur[i] for i in next_on], next_on


def train_task(net: Network, texts: Iterable[np.ndarray], first: int, rate: float) -> int:
    """Adam over the windows of all texts, again from the start until LEAST_UPDATES are made; the words of the texts."""
    grad, kept, size = net.slopes(), [], 0
    m, v = np.zeros((2, len(net.flat)), np.float32)

    def noted():
        nonlocal size
        for text in texts:
            size += len(text)
            # So few words can't make LEAST_UPDATES, and then are gone over again.
            if size <= LEAST_UPDATES * LANES * WINDOW:
                kept.append((None, text))
            yield None, text

    t, source = 0, noted()
    while t < LEAST_UPDATES:
        state, before = np.zeros((UNITS, 0), np.float32), t
        for w in lane_windows(source, first, LANES, WINDOW):
            state, _ = net.step(w, w.carried(state), grad)
            t += 1
            norm = float(np.linalg.norm(grad.flat))
            if norm > 1:
                grad.flat /= norm
            m *= 0.9
            m += 0.1 * grad.flat
            np.square(grad.flat, out=grad.flat)
            v *= 0.99
            v += 0.01 * grad.flat
            change = np.sqrt(v)
            change *= 1 / np.sqrt(1 - 0.99**t)
            change += 1e-6
            np.divide(m, change, out=change)
            change *= rate / (1 - 0.9**t)
            net.flat -= change
        if t == before:
            break
        source = kept
    return size


def averaged(parts: DataFrame, by: list[str]) -> DataFrame:
    """Weighted means of the blocks of each key."""

    def mean(table: pa.Table) -> pa.Table:
        w = table.column("weight").to_numpy()
        blocks = np.stack([np.frombuffer(b, np.float32) for b in table.column("block").to_pylist()])
        out = (w[:, None] * blocks).sum(axis=0) / w.sum()
        keys = {k: [table.column(k)[0].as_py()] for k in ("part", "at")}
        return pa.table({**keys, "weight": [float(w.sum())], "block": [out.astype(np.float32).tobytes()]}, schema=table.schema)

    return parts.groupBy(*by).applyInArrow(mean, parts.schema)


def train(docs: DataFrame, vocab: Vocabulary, text_col: str, rates: tuple[float, ...] = RATES) -> np.ndarray:
    """Weights after one pass over all texts, in as many rounds as there are step sizes; without training rows, the first ones."""
    spark = docs.sparkSession
    net = Network(vocab)
    if not vocab.tokens:
        return net.flat
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    shared_vocab = spark.sparkContext.broadcast(vocab)
    weights = net.flat
    for k, rate in enumerate(rates):
        shared = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, rate=rate):
            from pyspark import TaskContext

            voc, local = shared_vocab.value, Network(shared_vocab.value, shared.value)
            weight = train_task(local, (text for batch in batches for text in voc.read(batch.column(0))), voc.first, rate)
            if weight:
                part = TaskContext.get().partitionId() % FIRST_GROUPS
                blocks = [local.flat[i : i + BLOCK].tobytes() for i in range(0, len(local.flat), BLOCK)]
                n = len(blocks)
                yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([float(weight)] * n), pa.array(blocks, pa.binary())], names=["part", "at", "weight", "block"])

        turn = docs.where(F.pmod(F.xxhash64(body), F.lit(len(rates))) == k).select(body.cast("binary").alias("t"))
        parts = turn.mapInArrow(run, "part int, at int, weight double, block binary")
        blocks = averaged(averaged(parts, ["part", "at"]), ["at"]).orderBy("at").collect()
        if blocks:
            weights = np.concatenate([np.frombuffer(b["block"], np.float32) for b in blocks])
    return weights


def text_scores(net: Network, texts: Iterable[tuple], first: int) -> Iterator[tuple]:
    """(key, natural log probability) of each text's symbols, with the state carried to its end; texts come as (key, symbols)."""
    state, sums = np.zeros((UNITS, 0), np.float32), {}
    for w in lane_windows(texts, first, SCORE_LANES, SCORE_WINDOW):
        states = net.forward(w.inputs, w.fresh, w.carried(state))
        state = states[-1]
        found, _ = net.outputs(w.flat(states), w.live_targets())
        logp = np.zeros(w.inputs.shape)
        logp[slice(None) if w.live is None else w.live] = found.reshape(logp.shape) if w.live is None else found
        keys, starts, ends = zip(*w.parts, strict=True)
        for key, s, end in zip(keys, np.add.reduceat(logp.T.ravel(), starts).tolist(), ends, strict=True):
            s += sums.pop(key, 0.0)
            if end:
                yield key, s
            else:
                sums[key] = s


def score(docs: DataFrame, vocab: Vocabulary, weights: np.ndarray, rest: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids and scores of all rows; `rest` has the (word, n) that the vocabulary doesn't hold."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((vocab, weights))
    picked = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), F.col(text_col).cast("string").cast("binary").alias("t"))
    schema = T.StructType(
        [
            picked.schema["row"],
            picked.schema[id_col],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_held", T.LongType()),
            T.StructField("counts_sum", T.DoubleType()),
            T.StructField("model_sum", T.DoubleType()),
            T.StructField("rare", T.ArrayType(T.BinaryType())),
        ]
    )

    def run(batches):
        voc, w = shared.value
        net = Network(voc, w)
        log10 = np.log(10)
        waiting: dict = {}

        def texts():
            for batch in batches:
                for i, (symbols, held, sums, tails, rare) in enumerate(voc.look_up(batch.column(2))):
                    row = batch.column(0)[i].as_py()
                    ident = pa.concat_arrays([batch.column(1).slice(i, 1)])
                    waiting[row] = (ident, len(symbols), held, sums, tails, pa.concat_arrays([rare]))
                    yield row, symbols

        def block(done):
            rows, scores = zip(*done, strict=True)
            ids, n, known, sums, tails, rare = zip(*(waiting.pop(row) for row in rows), strict=True)
            model = np.array(scores) / log10 + np.array(tails)
            arrays = [pa.array(rows), pa.concat_arrays(ids), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(sums, pa.float64()), pa.array(model), pa.concat_arrays(rare)]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        done = []
        for found in text_scores(net, texts(), voc.first):
            done.append(found)
            if len(done) == ARROW_ROWS:
                yield block(done)
                done = []
        if done:
            yield block(done)

    read = shared_checkpoint(picked.mapInArrow(run, schema))
    rare = read.select("row", F.explode("rare").alias("word")).join(rest, "word", "left")
    joined = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))).alias("rare_sum"), F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).alias("rare_known"))
    more = F.coalesce("rare_sum", F.lit(0.0))
    return read.join(joined, "row", "left").select(
        id_col,
        "n_tokens",
        (F.col("n_held") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("counts_sum") + more - F.col("n_tokens") * F.lit(float(vocab.base_norm))).alias("base_score"),
        (F.col("model_sum") + more).alias("score"),
    )


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, held_fold: int = 0, known: int = KNOWN, rates: tuple[float, ...] = RATES) -> DataFrame:
    """One row for each row of `docs`: its id, `held_out`, `n_tokens` (words and the end), `n_known`,
    `train_tokens`, `base_score` (unigram) and `score` (the model), both log10 probabilities.

    Rows outside the held-out fold are learned from. A null or empty text is an end alone. Without
    training rows both scores are those of an empty vocabulary. Very long texts are split by pieces and run
    through one lane each, so a task holds their symbols and their rare words. Repeated rows stay. Words of equal
    count come in the order of their bytes; where not all of one count fit `known`, a hash chooses. Other
    columns are not read. `known` bounds the words that workers hold; other words' counts are joined.
    """
    train_docs = docs.where(id_remainder(id_col, folds) != held_fold)
    counts = shared_checkpoint(count_words(train_docs, text_col))
    held = held_words(counts, known)
    vocab = vocabulary(counts, held)
    weights = train(train_docs, vocab, text_col, rates)
    return score(docs, vocab, weights, counts.where(~held), id_col, text_col).withColumn("held_out", id_remainder(id_col, folds) == held_fold)
