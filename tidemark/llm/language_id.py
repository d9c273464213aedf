"""Language identification with a bit-sliced Bloom filter of n-grams.

The filter is one array of language bitmasks: an n-gram's probes, combined by AND, return all languages
that contain it. A text's n-grams are counted per language, the counts are corrected for the filter's
false positives, and the language with the most corrected hits wins.

Fitting: n-grams are counted per language over a sample of labelled documents, whose expected size is
bounded. A language contains an n-gram if a share of its documents have it and its rate there isn't far
below the highest rate in any language: large corpora hold strays of other languages, which aren't theirs.
All such n-grams are in the filter; its slots are counted out for a set rate of false positives, and its
masks are put together by slot in Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import id_remainder, map_texts, shared_checkpoint, slices

#: Bytes of an n-gram; labelled documents of a language that are sampled, as expected; share of a language's
#: documents that have an n-gram of it, and few documents that do for small samples; least share of the
#: highest rate; rate of false positives; probes; most languages, and most slots.
GRAM, DOCS_PER_LANGUAGE, LEAST_DOCS, FEW_DOCS, LEAST_SHARE, FALSE_RATE, PROBES, MOST_LANGUAGES, MOST_SLOTS = 4, 4000, 0.005, 3, 0.01, 0.002, 3, 1024, 1 << 24

UNDETERMINED = "und"

ASCII_LETTER = re.compile(rb"[A-Za-z]")
#: ASCII letters and bytes of other characters stay; the rest is a space.
LETTERS = bytes(c if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


#: Bytes of a text that are worked on at a time; memory doesn't grow with longer texts.
PART = 1 << 20
#: A place to cut a text at: spaces are no part of words, whose letters may decide each other's lower case.
SPACES = re.compile(rb"[ \t\n\r\f\v]")


def parts(text: bytes) -> Iterator[bytes]:
    """A text cut before a space behind each PART bytes; without one in as many bytes more, before a character."""
    at = 0
    while len(text) - at > 2 * PART:
        found = SPACES.search(text, at + PART, at + 2 * PART)
        cut = found.start() if found else at + 2 * PART
        while not found and text[cut] & 0xC0 == 0x80 and cut > at + PART:
            cut -= 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def has_letter(text: bytes) -> bool:
    return any(map(part_has_letter, parts(text)))


def part_has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or (not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace")))


def letters(text: bytes) -> bytes:
    """Lower case, runs of other characters as one space, with a space on either side."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return b" " + b" ".join(text.lower().translate(LETTERS).split()) + b" "


def codes_by_part(text: bytes) -> Iterator[np.ndarray]:
    """The n-grams of letters(text), each once, a part of the text at a time."""
    space, kept = True, b""
    for part in parts(text):
        clean = letters(part)[1:-1]
        if clean:
            kept += b" " * (space or LETTERS[part[0]] == 32) + clean
        space = LETTERS[part[-1]] == 32 if clean else space or bool(part)
        if len(kept) >= GRAM:
            yield gram_codes([kept])[0]
            kept = kept[len(kept) - GRAM + 1 :]
    yield gram_codes([kept + b" "])[0]


def gram_codes(texts: list[bytes], n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts as numbers (n is 8 at most), and how many each text has; a shorter text is padded."""
    padded = [t if len(t) >= n else t.ljust(n) for t in texts]
    flat = np.frombuffer(b"".join(padded), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    codes = np.zeros(max(0, len(flat) - n + 1), np.uint64)
    for i in range(n):
        codes = codes << np.uint64(8) | flat[i : len(codes) + i]
    inside = np.ones(len(flat), bool)
    for i in range(1, n):
        inside[np.cumsum(sizes) - i] = False
    return codes[inside[: len(codes)]], sizes - n + 1


def counted_codes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The different n-grams of a text and how often it has them."""
    if len(text) <= 2 * PART:
        return np.unique(gram_codes([letters(text)])[0], return_counts=True)
    codes, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    for part in codes_by_part(text):
        more, n = np.unique(part, return_counts=True)
        codes, at = np.unique(np.concatenate([codes, more]), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([counts, n])).astype(np.int64)
    return codes, counts


def probes(codes: np.ndarray, slots: int, count: int) -> list[np.ndarray]:
    """Slots of each n-gram; `slots` is a power of two."""
    bits = np.uint64(64 - slots.bit_length() + 1)
    multipliers = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
    return [((codes * np.uint64(m)) ^ (codes >> np.uint64(7))) * np.uint64(m) >> bits for m in multipliers[:count]]


@dataclass
class LanguageFilter:
    """languages, sorted; masks: one row for each slot, one 64-bit word for every 64 languages."""

    languages: list[str]
    masks: np.ndarray
    count: int
    fallback: str

    def __post_init__(self):
        bits = np.arange(len(self.languages))
        filled = np.array([(self.masks[:, b // 64] >> np.uint64(b % 64) & np.uint64(1)).mean() for b in bits.tolist()])
        self.false_rate = np.minimum(filled**self.count, 0.99)

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        return self.measure(texts)[:2]

    def tally(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many n-grams of each text each language's filter has."""
        starts, n_lang = np.cumsum(sizes) - sizes, len(self.languages)
        hits = np.empty((len(sizes), n_lang))
        slots = [p.astype(np.int64) for p in probes(codes, len(self.masks), self.count)]
        for word in range(self.masks.shape[1]):
            mask = self.masks[slots[0], word]
            for p in slots[1:]:
                mask &= self.masks[p, word]
            for b in range(word * 64, min(n_lang, word * 64 + 64)):
                hits[:, b] = np.add.reduceat((mask >> np.uint64(b % 64) & np.uint64(1)).astype(np.int32), starts)
        return hits

    def measure(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Names and scores, and the winner's corrected hits as a share of the text's own n-grams."""
        n_lang = len(self.languages)
        known = [t is not None and n_lang > 0 and has_letter(t) for t in texts]
        names, (scores, coverage) = [UNDETERMINED] * len(texts), np.zeros((2, len(texts)))
        at = np.flatnonzero(known)
        if not len(at):
            return names, scores, coverage
        hits, sizes = np.zeros((len(at), n_lang)), np.zeros(len(at), np.int64)
        short = np.array([len(texts[i]) <= 2 * PART for i in at])
        if short.any():
            codes, sizes[short] = gram_codes([letters(texts[i]) for i in at[short]])
            hits[short] = self.tally(codes, sizes[short])
        for row in np.flatnonzero(~short):
            for codes in codes_by_part(texts[at[row]]):
                sizes[row] += len(codes)
                hits[row] += self.tally(codes, np.array([len(codes)]))[0]
        corrected = np.maximum(0, (hits - sizes[:, None] * self.false_rate) / (1 - self.false_rate))
        best, total = corrected.argmax(axis=1), corrected.sum(axis=1)
        share = corrected[np.arange(len(at)), best] / np.where(total > 0, total, 1)
        for i, b, s, t in zip(at.tolist(), best.tolist(), share.tolist(), total.tolist(), strict=True):
            names[i], scores[i] = (self.languages[b], s) if t > 0 else (self.fallback, 0.0)
        coverage[at] = corrected[np.arange(len(at)), best] / sizes
        return names, np.minimum(scores, 1.0), coverage


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE,
    least_docs: float = LEAST_DOCS,
    least_share: float = LEAST_SHARE,
    false_rate: float = FALSE_RATE,
    count: int = PROBES,
) -> LanguageFilter:
    """A filter for the non-null languages of `docs`, MOST_LANGUAGES at most: more raise an error. The sample of a
    language is chosen by a hash of id and text at a rate that makes its expected size `docs_per_language`
    at most. No labelled text gives a filter without languages."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__body"), F.col(lang_col).cast("string").alias("__lang"))
    sizes = {r["__lang"]: r["count"] for r in labelled.groupBy("__lang").count().limit(MOST_LANGUAGES + 1).collect()}
    languages = sorted(sizes)
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in column {lang_col}")
    fallback = max(languages, key=lambda k: (sizes[k], k), default=UNDETERMINED)
    uniform = F.pmod(F.xxhash64(F.coalesce(F.col("__id").cast("string"), F.lit("")), F.col("__body"), F.lit(6)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rates = docs.sparkSession.createDataFrame([(k, b, min(1.0, docs_per_language / sizes[k])) for b, k in enumerate(languages)], "__lang string, bit int, rate double")
    sample = labelled.join(F.broadcast(rates), "__lang").where(uniform < F.col("rate")).select("bit", F.col("__body").cast("string").cast("binary").alias("__body"))

    def tally(batches):
        for batch in batches:
            for lo, hi in slices(np.asarray(pc.binary_length(batch.column(1)))):
                bits, found = np.asarray(batch.column(0).slice(lo, hi - lo)), [gram_codes([letters(t)])[0] for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                each = [np.unique(codes, return_counts=True) for codes in found]
                for b in np.unique(bits).tolist():
                    mine = [each[i] for i in np.flatnonzero(bits == b).tolist()]
                    codes, at, docs_ = np.unique(np.concatenate([c for c, _ in mine]), return_inverse=True, return_counts=True)
                    n = np.bincount(at, weights=np.concatenate([k for _, k in mine]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), b, np.int32)), pa.array(codes.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(docs_.astype(np.int64))], names=["bit", "code", "n", "docs"])

    grams = shared_checkpoint(sample.mapInArrow(tally, "bit int, code long, n long, docs long").groupBy("bit", "code").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    totals = grams.groupBy("bit").agg(F.sum("n").alias("total")).join(sample.groupBy("bit").agg(F.count("*").alias("texts")), "bit")
    enough = F.greatest(F.col("texts") * least_docs, F.least(F.lit(float(FEW_DOCS)), F.col("texts") / 20))
    rated = grams.join(F.broadcast(totals), "bit").withColumn("rate", F.col("n") / F.col("total"))
    top = rated.groupBy("code").agg(F.max("rate").alias("most"), F.collect_list(F.struct("bit", "rate", (F.col("docs") >= enough).alias("enough"))).alias("each"))
    kept = top.select("code", "most", F.explode("each").alias("e")).where(F.col("e.enough") & (F.col("e.rate") >= F.col("most") * least_share)).select("code", "e.bit")
    kept = shared_checkpoint(kept)
    most = max((r["count"] for r in kept.groupBy("bit").count().collect()), default=0)
    # Of `most` n-grams, each with `count` probes, this many slots have a share of false_rate ** (1 / count) filled.
    wanted = -count * most / np.log1p(-(false_rate ** (1 / count)))
    slots = min(MOST_SLOTS, 1 << int(np.ceil(np.log2(max(1024, wanted)))))

    def place(batches):
        for batch in batches:
            bits, codes = np.asarray(batch.column(1)).astype(np.int64), np.asarray(batch.column(0)).view(np.uint64)
            at = np.concatenate([p.astype(np.int64) for p in probes(codes, slots, count)])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.tile(bits // 64, count)), pa.array(np.tile(np.left_shift(np.int64(1), bits % 64), count))], names=["slot", "word", "mask"])

    # As many rows as the filter has words, at most.
    masked = kept.select("code", "bit").mapInArrow(place, "slot long, word long, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    masks = np.zeros((slots, max(1, -(-len(languages) // 64))), np.uint64)
    masks[masked.column("slot").to_numpy(), masked.column("word").to_numpy()] = masked.column("mask").to_numpy().view(np.uint64)
    return LanguageFilter(languages, masks, count, fallback)


def predict(docs: DataFrame, model: LanguageFilter, id_col: str = "doc_id", text_col: str = "text", coverage: bool = False) -> DataFrame:
    """One row for each row of `docs`: its id, `lang_pred` and `score`, the winner's share of all
    languages' corrected hits; if asked, `coverage` as well, the winner's corrected hits as a share of
    the text's own n-grams.

    `und` and 0 if the text is null or has no letter, or no language was learned; the most frequent
    language and 0 if no n-gram is known. Equal counts go to the first language in order. Very long texts count
    whole. Repeated rows stay, an empty table gives an empty result, and other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if coverage:
        fields.append(T.StructField("coverage", T.DoubleType()))

    def start():
        filter_ = shared.value

        def work(texts):
            names, *shares = filter_.measure(texts)
            return [pa.array(names, pa.string()), *map(pa.array, shares[: len(fields) - 1])]

        return work

    return map_texts(docs, [id_col], text_col, fields, start)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held_fold: int = 1) -> DataFrame:
    """predict() with a filter fitted on the rows outside the held-out fold, and `held_out`."""
    held = id_remainder(id_col, folds) == held_fold
    model = fit(docs.where(~held), id_col, text_col, lang_col)
    return predict(docs, model, id_col, text_col).withColumn("held_out", id_remainder(id_col, folds) == held_fold)
