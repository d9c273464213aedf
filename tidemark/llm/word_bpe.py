"""BPE encoding and decoding in batched numpy merge rounds, for tokenizers with word-end symbols.

The symbols of all new words of a slice of texts stand in one flat array. A merge round finds the
rank of every adjacent pair by binary search over the sorted pair keys, takes the lowest rank of each
word and merges all its occurrences from left to right; words without a known pair leave the array.
A worker remembers the words it has encoded, up to a bound, after which it starts anew.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_texts

#: Words that a worker remembers at most.
WORD_MEMORY = 100_000

#: Letters and, of normalised text in Latin script, all characters: for these a pattern without
#: Unicode properties, which is several times as fast, finds the same pieces.
LATIN_LETTERS = r"a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
LATIN = re.compile(rf"[\x00-\x7f{LATIN_LETTERS}]*")

#: Characters at which str.split() cuts though they aren't white space of Unicode.
FALSE_SPACE = re.compile("[\x1c-\x1f]")

NO_RANK = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the others take the code points from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


@dataclass
class WordBpe:
    """Tables of a word-level BPE tokenizer: see load()."""

    pieces: regex.Pattern
    latin: re.Pattern
    specials: regex.Pattern | None
    special_ids: dict[str, int]
    tokens: list[str]
    plain: np.ndarray
    final: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray

    def segments(self, text: str) -> list[str]:
        """The text between special tokens at even places, special tokens at odd places."""
        return self.specials.split(text) if self.specials and "<" in text else [text]

    def words(self, text: str) -> list[str]:
        """Pieces of normalised text that holds no special token."""
        return (self.latin if LATIN.fullmatch(text) else self.pieces).findall(text)

    def rank_pairs(self, symbols: np.ndarray, owner: np.ndarray, rank: np.ndarray, at: np.ndarray) -> None:
        """Sets the ranks of the pairs that begin at the places `at`."""
        rank[at] = NO_RANK
        at = at[at + 1 < len(symbols)]
        at = at[owner[at] == owner[at + 1]]
        key = (symbols[at] << 32) | symbols[at + 1]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[place] == key
        rank[at[known]] = self.ranks[place[known]]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and the number of ids of each; words aren't empty."""
        n = len(words)
        if not n:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        sizes = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes) - 1
        symbols = self.plain[flat].astype(np.int64)
        symbols[ends] = self.final[flat[ends]]
        owner = np.repeat(np.arange(n), sizes)
        rank = np.full(len(symbols), NO_RANK, np.int32)
        self.rank_pairs(symbols, owner, rank, np.arange(len(symbols)))
        done_owner, done_symbols = [], []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(symbols)]))
            over = lowest == NO_RANK
            if over.any():
                done_owner.append(owner[over])
                done_symbols.append(symbols[over])
            chosen = np.flatnonzero((rank == lowest) & ~over)
            # Of overlapping pairs (a run of one symbol) every second is merged, from the left.
            if len(chosen):
                new_run = np.r_[True, np.diff(chosen) != 1]
                first = np.maximum.accumulate(np.where(new_run, np.arange(len(chosen)), 0))
                chosen = chosen[(np.arange(len(chosen)) - first) % 2 == 0]
                symbols[chosen] = self.merged[lowest[chosen]]
            stay = ~over
            stay[chosen + 1] = False
            place = np.cumsum(stay) - 1
            # Only pairs that touch a merged symbol have a new rank.
            touched = place[chosen]
            symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
            self.rank_pairs(symbols, owner, rank, np.r_[touched, touched[touched > 0] - 1])
        owner, symbols = np.concatenate(done_owner), np.concatenate(done_symbols)
        order = np.argsort(owner, kind="stable")
        return symbols[order].astype(np.int32), np.bincount(owner, minlength=n)


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """Reads a tokenizers JSON file: BPE with a word-end suffix over byte symbols, special tokens
    matched in the raw text, pieces cut by one pattern, no decoder. A path, or the name of a file of the
    installed public vocabularies."""
    if os.path.dirname(path) == "":
        import public_tokenizers

        path = public_tokenizers.path(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    vocab, suffix = model["vocab"], model["end_of_word_suffix"]
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    # The file's white space is Unicode's White_Space; here it is spelled out.
    pattern = split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
    special_ids = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*vocab.values(), *special_ids.values()]) + 1
    tokens = [""] * size
    for token, i in [*vocab.items(), *special_ids.items()]:
        tokens[i] = token
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    left, right, merged = (np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in merges), strict=True))
    keys = (left << 32) | right
    order = np.argsort(keys)
    symbols = byte_symbols()
    return WordBpe(
        pieces=regex.compile(pattern),
        latin=re.compile(pattern.replace(r"\p{White_Space}", r" \t-\r").replace(r"\p{L}", LATIN_LETTERS).replace(r"\p{N}", "0-9")),
        specials=regex.compile("(" + "|".join(map(regex.escape, sorted(special_ids, key=len, reverse=True))) + ")") if special_ids else None,
        special_ids=special_ids,
        tokens=tokens,
        plain=np.array([vocab[c] for c in symbols], np.int64),
        final=np.array([vocab[c + suffix] for c in symbols], np.int64),
        keys=keys[order],
        ranks=order.astype(np.int32),
        merged=merged,
    )


def normalise(text: str) -> str:
    if text.isascii():
        return text.lower()
    # Lower-casing by character: the last letter of a word gets no form of its own.
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Encoder:
    """Encodes slices of texts; remembers runs of text without white space, up to a bound. A special
    token has the key of its string behind a space, which no such run holds."""

    def __init__(self, bpe: WordBpe, memory: int = WORD_MEMORY):
        self.bpe, self.memory = bpe, memory
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.start = np.zeros(1, np.int64)

    def runs(self, text: bytes) -> list[str]:
        out: list[str] = []
        for k, segment in enumerate(self.bpe.segments(text.decode("utf-8", "replace"))):
            if k % 2:
                out.append(f" {segment}")
            elif FALSE_SPACE.search(segment):
                out.extend(regex.split(r"\p{White_Space}+", normalise(segment)))
            else:
                out.extend(normalise(segment).split())
        return out

    def learn(self, runs: list[str]) -> None:
        new = list(set(runs).difference(self.slot))
        if not new:
            return
        pieces: list[bytes] = []
        ends = [0]
        special: list[tuple[int, int]] = []
        for r in new:
            if r[:1] == " ":
                special.append((len(ends) - 1, self.bpe.special_ids[r[1:]]))
            else:
                pieces.extend([p.encode() for p in self.bpe.words(r)])
            ends.append(len(pieces))
        ids, sizes = self.bpe.encode_words(pieces)
        starts = np.r_[0, np.cumsum(sizes)][ends]
        if special:
            at, values = np.array(special).T
            ids = np.insert(ids, starts[at], values).astype(np.int32)
            starts = starts + np.r_[0, np.cumsum(np.bincount(at, minlength=len(new)))]
        first = len(self.slot)
        self.slot.update(zip(new, range(first, first + len(new)), strict=True))
        self.start = np.concatenate([self.start, self.start[-1] + starts[1:]])
        self.ids = np.concatenate([self.ids, ids])

    def __call__(self, texts: list[bytes | None]) -> pa.Array:
        """A list of ids for each text; null is encoded as the empty text."""
        if len(self.slot) > self.memory:
            self.forget()
        runs: list[str] = []
        ends = [0]
        for text in texts:
            if text:
                runs.extend(self.runs(text))
            ends.append(len(runs))
        self.learn(runs)
        at = np.fromiter(map(self.slot.__getitem__, runs), np.int64, len(runs))
        sizes = self.start[at + 1] - self.start[at]
        before = np.r_[0, np.cumsum(sizes)]
        take = np.repeat(self.start[at] - before[:-1], sizes) + np.arange(before[-1])
        return pa.ListArray.from_arrays(pa.array(before[ends].astype(np.int32)), pa.array(self.ids[take]))


class Decoder:
    """Lists of ids to the tokens' strings joined by a space; ids outside the vocabulary are left out."""

    def __init__(self, bpe: WordBpe):
        self.tokens, self.strings = bpe.tokens, pa.array(bpe.tokens)

    def __call__(self, ids: pa.Array) -> pa.Array:
        flat = ids.flatten()
        known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(self.tokens)))
        if flat.null_count or pc.all(known).as_py() is False:
            return pa.array([None if x is None else " ".join(self.tokens[i] for i in x if i is not None and 0 <= i < len(self.tokens)) for x in ids.to_pylist()], pa.string())
        lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), pc.take(self.strings, flat))
        return pc.if_else(pc.is_valid(ids), pc.binary_join(lists, " "), pa.scalar(None, pa.string()))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", memory: int = WORD_MEMORY, decoded: bool = False) -> DataFrame:
    """One row for each row of `docs`: its id and `ids`, the token ids of its whole text; if asked, `decoded`, what
    decode() makes of them, in the same pass.

    A null or empty text has no ids, and a very long one all of its ids in one row. Repeated rows and ids stay.
    Of pairs of equal rank in a word the left one is merged first. Special tokens' strings in a text become
    their ids; nothing is added, cut or padded. An empty table gives an empty result. Other columns are not read.
    """
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType(), True))] + [T.StructField("decoded", T.StringType())] * decoded

    def start():
        encoder, decoder = Encoder(load(path), memory), Decoder(load(path)) if decoded else None

        def work(texts):
            ids = encoder(texts)
            return [ids, decoder(ids)] if decoded else [ids]

        return work

    return map_texts(docs, [id_col], text_col, fields, start)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row for each row: its id and `text`, the tokens of `ids` joined by a space, as a tokenizer
    without decoder has it. Null ids give a null text; ids outside the vocabulary are left out. Very long lists
    stay whole, repeated rows stay, and an empty table gives an empty result."""
    picked = encoded.select(id_col, F.col(ids_col).alias("__ids"))
    schema = T.StructType([picked.schema[id_col], T.StructField("text", T.StringType())])

    def run(batches):
        decoder = Decoder(load(path))
        for batch in batches:
            for lo in range(0, len(batch), 64):  # long texts: a string array has 2 GB at most
                part = batch.slice(lo, 64)
                yield pa.RecordBatch.from_arrays([part.column(0), decoder(part.column(1))], names=schema.names)

    return picked.mapInArrow(run, schema)
