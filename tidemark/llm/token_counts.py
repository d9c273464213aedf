"""Token counts by a transducer compiled from a BPE vocabulary.

A state stands for what the bytes of a word read so far leave open: for each suffix that begins some
token, the last token before that suffix and how many tokens lie before it, relative to the count of
the whole prefix. A transition is annotated with the change of the token count; at a word's end the
state's own annotation accounts for the last byte becoming a word-end symbol. States and transitions
are compiled when a text first needs them; beyond a bound all but those in use are forgotten.

The symbols of a slice of texts are cut into equal chunks, which run in lockstep. A chunk's state map
gives the exit state and the count for an entry state. The map of a chunk with a word end is constant. That
of a chunk within a long word is kept for the entries that can occur: those that the chunk before exits
with, until no map of a chunk leads out of the entries of the next. A parallel prefix scan then composes the
maps in as many steps as the number of chunks has binary digits, which gives each chunk its entry.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import map_texts
from tidemark.llm.word_bpe import WordBpe, load, normalise

#: States that a worker keeps at most.
STATE_MEMORY = 120_000

#: Chunks that run in lockstep at most, and their least length.
LANES, LEAST_CHUNK = 8192, 256

WORD_END, FINAL = 10, 256
START, SKIP = 0, 1


class Grammar:
    """A trie of the tokens that BPE can yield, and which two tokens may stand side by side."""

    def __init__(self, bpe: WordBpe):
        n = len(bpe.tokens)
        self.rank = np.full(n, -1, np.int64)
        self.left, self.right = np.zeros((2, n), np.int64)
        self.pair: dict[int, int] = {}
        for key, rank in zip(bpe.keys.tolist(), bpe.ranks.tolist(), strict=True):
            made = int(bpe.merged[rank])
            self.rank[made], self.left[made], self.right[made] = rank, key >> 32, key & 0xFFFFFFFF
            self.pair[key] = rank
        self.rank, self.left, self.right = self.rank.tolist(), self.left.tolist(), self.right.tolist()
        symbol = {int(t): s for s, t in enumerate([*bpe.plain, *bpe.final])}
        spelled: dict[int, tuple[int, ...]] = {t: (s,) for t, s in symbol.items()}
        for t in np.argsort(self.rank, kind="stable").tolist():
            if self.rank[t] >= 0:
                spelled[t] = spelled[self.left[t]] + spelled[self.right[t]]
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        self.inner: list[bool] = [False]
        for t, symbols in spelled.items():
            # A token whose halves don't stay apart until its own merge is never made.
            if self.rank[t] >= 0 and not self.beside(self.left[t], self.right[t], self.rank[t]):
                continue
            node = 0
            for s in symbols:
                self.inner[node] = True
                key = node << 9 | s
                nxt = self.child.get(key)
                if nxt is None:
                    nxt = self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = nxt
            self.token[node] = t
        self.known: dict[int, bool] = {}

    def beside(self, a: int, b: int, until: int) -> bool:
        """Whether a and b stay apart in their joint text until the merge of rank `until`: takes back
        the merges at the seam, latest first; no pair across it may come before the merge taken back."""
        pair, rank = self.pair, self.rank
        limit = until
        while True:
            if pair.get(a << 32 | b, limit) < limit:
                return False
            if rank[a] > rank[b]:
                limit, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                # Of equal pairs the left one is merged first, so one across the seam wins.
                limit, b = rank[b] + 1, self.left[b]
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        key = a << 32 | b
        out = self.known.get(key)
        if out is None:
            out = self.known[key] = self.beside(a, b, 1 << 40)
        return out


class Transducer:
    """Compiled states: `move` and `emit` by state and byte class."""

    def __init__(self, bpe: WordBpe, memory: int = STATE_MEMORY):
        self.bpe, self.grammar, self.memory = bpe, Grammar(bpe), memory
        self.classes = np.full(256, -1, np.int64)
        self.symbols: list[int] = []
        self.reset()

    def reset(self) -> None:
        width = max(32, len(self.symbols))
        self.move = np.full((1024, width), -1, np.int32)
        self.emit = np.zeros((1024, width), np.int16)
        self.state_of: dict[tuple, int] = {}
        self.chains: list[tuple] = []
        self.closing: list[int] = []
        self.grammar.known.clear()
        self.state((((0, -1, 0),), 0))
        self.state(((), 0))  # SKIP: waits for a word end
        if self.classes[WORD_END] >= 0:
            self.wait()

    def wait(self) -> None:
        self.move[SKIP], self.emit[SKIP] = SKIP, 0
        self.move[SKIP, self.classes[WORD_END]] = START

    def state(self, key: tuple) -> int:
        at = self.state_of.get(key)
        if at is None:
            at = self.state_of[key] = len(self.chains)
            self.chains.append(key[0])
            self.closing.append(key[1])
            if at >= len(self.move):
                self.move = np.concatenate([self.move, np.full_like(self.move, -1)])
                self.emit = np.concatenate([self.emit, np.zeros_like(self.emit)])
        return at

    def admit(self, found: np.ndarray) -> None:
        """Gives each new byte a class."""
        for b in found.tolist():
            if self.classes[b] < 0:
                self.classes[b] = len(self.symbols)
                self.symbols.append(b)
        if len(self.symbols) > self.move.shape[1]:
            more = (len(self.move), len(self.symbols) + 16 - self.move.shape[1])
            self.move = np.concatenate([self.move, np.full(more, -1, np.int32)], axis=1)
            self.emit = np.concatenate([self.emit, np.zeros(more, np.int16)], axis=1)
        self.wait()

    def compile(self, at: int, cls: int) -> None:
        byte = self.symbols[cls]
        if byte == WORD_END:
            self.move[at, cls], self.emit[at, cls] = START, self.closing[at]
            return
        g, chain = self.grammar, self.chains[at]
        child, token = g.child, g.token
        last = gain = closing = None
        kept = []
        for node, before, count in chain:
            nxt = child.get(node << 9 | byte)
            if nxt is not None:
                t = token[nxt]
                if last is None and t >= 0 and (before < 0 or g.fits(before, t)):
                    last, gain = t, count + 1
                if g.inner[nxt]:
                    kept.append((nxt, before, count))
            end = child.get(node << 9 | byte | FINAL)
            if closing is None and end is not None and (t := token[end]) >= 0 and (before < 0 or g.fits(before, t)):
                closing = count + 1
        key = (tuple((n, b, c - gain) for n, b, c in kept) + ((0, last, 0),), closing - gain)
        self.emit[at, cls] = gain
        self.move[at, cls] = self.state(key)

    def renew(self, *held: np.ndarray) -> list[np.ndarray]:
        """Forgets all states but those held, which get new numbers."""
        old = np.unique(np.concatenate([np.array([START, SKIP]), *held]))
        keys = [(self.chains[i], self.closing[i]) for i in old.tolist()]
        self.reset()
        new = np.array([self.state(key) for key in keys], np.int64)
        return [new[np.searchsorted(old, x)] for x in held]

    def step(self, states: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = self.move.shape[1]
        at = states * width + classes
        moved = self.move.ravel().take(at)
        if moved.min(initial=0) < 0:
            for x in np.unique(at[moved < 0]).tolist():
                self.compile(x // width, x % width)
            moved = self.move.ravel().take(at)
        return moved.astype(np.int64), self.emit.ravel().take(at)

    def lockstep(self, by_step: np.ndarray, lanes: np.ndarray, states: np.ndarray, *held: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """The exits and counts of the chunks `lanes` from `states`, and `held`, states that stay known."""
        count = np.zeros(len(lanes), np.int64)
        for row in by_step[:, lanes]:
            if len(self.chains) > self.memory:
                states, *held = self.renew(states, *held)
            states, emitted = self.step(states, row)
            count += emitted
        return states, count, list(held)

    def within_words(self, by_step: np.ndarray, inner: np.ndarray, exits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The exits of all chunks and the counts of the chunks `inner`, which have no word end; `exits` has those of the others."""
        inside = np.zeros(by_step.shape[1] + 1, bool)
        inside[inner] = True
        # Entries of the maps: what the chunk before exits with, or else a word's start as a first guess.
        lane, entry = inner, np.where(inside[inner - 1], START, exits[inner - 1])
        lanes, entries, leaves, counts = (np.empty(0, np.int64) for _ in range(4))
        while len(lane):
            leave, count, (entry, entries, leaves, exits) = self.lockstep(by_step, lane, entry, entry, entries, leaves, exits)
            lanes, entries, leaves, counts = np.r_[lanes, lane], np.r_[entries, entry], np.r_[leaves, leave], np.r_[counts, count]
            ahead = inside[lane + 1]
            wanted = np.unique(np.stack([lane[ahead] + 1, leave[ahead]]), axis=1)
            fresh = ~np.isin(wanted[0] << 32 | wanted[1], lanes << 32 | entries)
            lane, entry = wanted[:, fresh]
        order = np.lexsort((entries, lanes))
        lanes, entries, leaves, counts = lanes[order], entries[order], leaves[order], counts[order]
        first = np.searchsorted(lanes, inner)
        place = np.arange(len(lanes)) - np.repeat(first, np.diff(np.r_[first, len(lanes)]))
        keys = lanes << 32 | entries
        # Maps between places of entries; a chunk behind a known exit has the constant map of its true entry.
        maps = np.zeros((len(inner), int(place.max()) + 1), np.int64)
        onward = inside[lanes + 1]
        target = place[np.searchsorted(keys, (lanes[onward] + 1) << 32 | leaves[onward])]
        maps[np.searchsorted(inner, lanes[onward]), place[onward]] = target
        begins = ~inside[inner - 1]
        known = place[np.searchsorted(keys, inner[begins] << 32 | exits[inner[begins] - 1])]
        true = np.zeros(len(inner), np.int64)
        true[begins] = known
        maps[begins] = maps[begins, known][:, None]
        reach = 1
        while reach < len(inner):
            maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], axis=1)
            reach *= 2
        follows = np.flatnonzero(~begins)
        true[follows] = maps[follows - 1, 0]
        exits[inner] = leaves[first + true]
        return exits, counts[first + true]

    def run(self, stream: np.ndarray) -> np.ndarray:
        """The emissions of `stream`, in which every word is followed by WORD_END, by byte; those of a chunk without a word end stand at its last byte."""
        n = len(stream)
        self.admit(np.flatnonzero(np.bincount(stream, minlength=256)))
        lanes = max(1, min(LANES, n // LEAST_CHUNK))
        length = -(-n // lanes)
        padded = np.full(lanes * length, self.classes[WORD_END], np.int64)
        padded[:n] = self.classes[stream]
        by_step = np.ascontiguousarray(padded.reshape(lanes, length).T)
        out = np.zeros((length, lanes), np.int32)
        exits = np.full(lanes, SKIP, np.int64)
        exits[0] = START
        for t in range(length):
            if len(self.chains) > self.memory:
                (exits,) = self.renew(exits)
            exits, out[t] = self.step(exits, by_step[t])
        ends = by_step == self.classes[WORD_END]
        inner = np.flatnonzero(~ends.any(axis=0))
        inner = inner[inner > 0]
        if len(inner):
            exits, out[-1, inner] = self.within_words(by_step, inner, exits)
        # What is before the first word end of a chunk runs from the exit of the chunk before.
        lane = np.setdiff1d(np.arange(1, lanes), inner)
        fragment, at = ends.argmax(axis=0)[lane] + 1, exits[lane - 1]
        for t in range(int(fragment.max(initial=0))):
            if len(self.chains) > self.memory:
                (at,) = self.renew(at)
            on = fragment > t
            lane, at, fragment = lane[on], at[on], fragment[on]
            at, out[t, lane] = self.step(at, by_step[t, lane])
        return out.T.reshape(-1)[:n]

    def count(self, texts: list[bytes | None]) -> np.ndarray:
        """Tokens of each text; none for null."""
        parts: list[str] = []
        extra = np.zeros(len(texts), np.int64)
        ends = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            size = 0
            if text:
                segments = self.bpe.segments(text.decode("utf-8", "replace"))
                extra[i] = len(segments) // 2
                for segment in segments[::2]:
                    if words := self.bpe.words(normalise(segment)):
                        part = "\n".join(words).encode() + b"\n"
                        parts.append(part)
                        size += len(part)
            ends[i + 1] = ends[i] + size
        if not parts:
            return extra
        total = np.r_[0, np.cumsum(self.run(np.frombuffer(b"".join(parts), np.uint8)), dtype=np.int64)]
        return total[ends[1:]] - total[ends[:-1]] + extra


@functools.lru_cache(maxsize=2)
def transducer(path: str, memory: int) -> Transducer:
    return Transducer(load(path), memory)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, memory: int = STATE_MEMORY) -> DataFrame:
    """One row for each row of `docs`: its id, `n_bytes` (UTF-8), `n_tokens` of the whole text and
    `over_limit` (more than `limit` tokens).

    A null or empty text has no bytes and no tokens. A very long text, or one long word, is cut into chunks
    like many short ones. Repeated rows and ids stay, equal counts need no order, and an empty table gives an
    empty result; other columns are not read. `memory` bounds the states that a worker keeps, but for those
    in use by its chunks; it bounds nothing that is counted.
    """

    def start():
        machine = transducer(path, memory)

        def work(texts):
            n = machine.count(texts)
            return [pa.array([len(t or b"") for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)]

        return work

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    return map_texts(docs, [id_col], text_col, fields, start, limit=4 << 20)
