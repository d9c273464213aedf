"""The training-data operators against brute force, round trips and held-out accuracy, and their edge cases."""

import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from compare import assert_same, database
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import chat_format, common, decontaminate, language_id, quality, recurrent_lm, sharding, simhash_dedup, token_counts, topk_search, word_bpe
from tidemark.llm.queries import ORACLES, QUERIES, WORD_BPE

LONG = "the long text goes on, " * 4000
ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, LONG),
    (6, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (6, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (7, "ÉCOLE Σίσυφος ΑΣ it's <|endoftext|> 12 !!! \x1c\x85 日本語 \x00"),
    (None, "a row without id"),
    (8, "a" * 5000),
]
CLASHING = ["row", "fp", "key", "n", "span", "item", "score", "shard", "t", "size", "hash", "u", "v", "ids", "place"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns with names that operators use."""
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    return df.withColumns({c: F.lit("x") for c in CLASHING} | {"lang": F.when(F.col("doc_id") < 4, "en"), "source": F.lit(None).cast("string")})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def spaced(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(t))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, sf):
    assert_same(QUERIES[name](spark, sf), database(sf), ORACLES[name])


# 1 LM scoring


def test_lm_base_score_is_exact_and_model_beats_it_held_out(docs):
    got = recurrent_lm.score_documents(docs, known=500).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    train = Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 10:
            train.update([*spaced(t), None])
    n, v = sum(train.values()), len(train)
    assert len(got) == len(texts)
    for r in got:
        tokens = [*spaced(texts[r.doc_id]), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(train[w] > 0 for w in tokens), n)
        assert math.isclose(r.base_score, sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens), rel_tol=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def vocabulary(texts, known=None):
    """The vocabulary of texts, of whose words it holds the `known` most frequent ones."""
    counts = Counter(w for t in texts for w in [*spaced(t), ""])
    top = sorted(((w.encode(), n) for w, n in counts.items()), key=lambda x: (-x[1], x[0]))
    tokens, types = np.zeros((2, recurrent_lm.TAIL_CLASSES), np.int64)
    for w, n in top[recurrent_lm.HEAD :]:
        tokens[recurrent_lm.tail_class(w)] += n
        types[recurrent_lm.tail_class(w)] += 1
    return recurrent_lm.Vocabulary(sum(counts.values()), len(counts), [w for w, _ in top[:known]], np.array([n for _, n in top[:known]], np.int64), tokens, types)


def plain_score(net, voc, counts, text):
    """log10 probability of a text, one word after the other, by the definition of the unit and of the classes."""
    sigmoid = lambda x: 1 / (1 + np.exp(-2 * x.astype(np.float64)))  # noqa: E731  weights are of half the usual input
    h, slot = recurrent_lm.UNITS, {w: i for i, w in enumerate(voc.words.view(pa.binary()).to_pylist()[: voc.head])}
    symbol = lambda w: slot.get(w, voc.head + zlib.crc32(w[:2]) % recurrent_lm.TAIL_CLASSES)
    state, last, total = np.zeros(h), symbol(b""), 0.0
    for word in [*(w.encode() for w in spaced(text)), b""]:
        x, g = net.into @ net.seen[last], net.state @ state
        z, r = sigmoid(x[:h] + g[:h]), sigmoid(x[h : 2 * h] + g[h : 2 * h])
        state = z * state + (1 - z) * np.tanh(x[2 * h :] + r * g[2 * h :])
        one = np.r_[state, 1]
        last = symbol(word)
        logits = net.to_class @ one
        in_head = last < voc.head
        c = last // recurrent_lm.CLASS_WORDS if in_head else voc.head_classes + last - voc.head
        total += (logits[c] - np.log(np.exp(logits).sum())) / np.log(10)
        if in_head:
            lo = c * recurrent_lm.CLASS_WORDS
            words = net.to_word[lo : lo + recurrent_lm.CLASS_WORDS] @ one
            total += (words[last - lo] - np.log(np.exp(words).sum())) / np.log(10)
        else:
            k = last - voc.head
            total += np.log10((counts[word] + 0.1) / (voc.tail_tokens[k] + 0.1 * (voc.tail_types[k] + 1)))
    return total


def test_lm_score_equals_a_plain_loop_for_head_tail_rare_and_unseen_words(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choice(words, n, p=np.arange(3000, 0, -1) / (3000 * 3001 / 2))) for n in (4000, 900, 3000, 1, 40)] + ["", "W5 never seen w2999"]
    counts = Counter(w.encode() for t in texts[:-1] for w in [*spaced(t), ""])
    voc = vocabulary(texts[:-1], known=1500)
    assert voc.head == recurrent_lm.HEAD < 1500 < len(counts)
    net = recurrent_lm.Network(voc)
    held = set(voc.words.view(pa.binary()).to_pylist())
    rest = spark.createDataFrame([(bytearray(w), n) for w, n in counts.items() if w not in held], "word binary, n long")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in recurrent_lm.score(docs, voc, net.flat, rest).collect():
        assert math.isclose(r.score, plain_score(net, voc, counts, texts[r.doc_id]), rel_tol=1e-4)


def test_lm_probabilities_add_up_to_one():
    voc = vocabulary(["a b c a b", "b c d e f g"])
    net = recurrent_lm.Network(voc)
    state = np.random.default_rng(0).normal(size=(1, recurrent_lm.UNITS + 1)).astype(np.float32)
    state[:, -1] = 1
    every = np.arange(voc.head + recurrent_lm.TAIL_CLASSES)
    logp, _ = net.outputs(np.repeat(state, len(every), axis=0), every)
    assert math.isclose(float(np.exp(logp).sum()), 1, rel_tol=1e-4)


def test_lm_gradient_is_that_of_the_loss():
    net = recurrent_lm.Network(voc := vocabulary(["a b c a b", "b c d e f g"]))
    texts = [(0, np.array([0, 1, 2, 0], np.int16)), (1, np.array([1, 3], np.int16))]
    (w,) = recurrent_lm.lane_windows(texts, voc.first, 2, 4)
    state = np.random.default_rng(1).normal(size=(recurrent_lm.UNITS, 2)).astype(np.float32)
    w.fresh[0] = []  # the first state is carried from before

    def loss():
        logp, _ = net.outputs(w.flat(net.forward(w.inputs, w.fresh, state)), w.live_targets())
        return -float(logp.astype(np.float64).mean())

    grad = net.slopes()
    net.step(w, state, grad)
    for name in net.shapes:
        part, slope = getattr(net, name).reshape(-1), getattr(grad, name).reshape(-1)
        for i in np.argsort(-np.abs(slope))[:8:2]:
            was = part[i]
            part[i] = was + 1e-2
            up = loss()
            part[i] = was - 1e-2
            down = loss()
            part[i] = was
            assert abs((up - down) / 2e-2 - slope[i]) < 1e-3 + 0.05 * abs(slope[i])


def test_lm_trains_on_every_part_of_a_text(spark):
    """A word at the start, within or at the end of a text changes what is learned."""
    voc = vocabulary(["a b c d e f g " * 200])

    def learned(at):
        words = ["abcdefg"[i * i % 7] for i in range(3000)]
        words[at] = "d"  # squares modulo 7 are never 3
        return recurrent_lm.train(spark.createDataFrame([(" ".join(words),)], "text string"), voc, text_col="text", rates=(0.01,))

    first, within, last = (learned(at) for at in (0, 1500, 2999))
    assert not np.array_equal(first, within) and not np.array_equal(within, last)


def test_lm_lanes_hold_every_word_once_and_in_order():
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 999, n).astype(np.int16) for n in (700, 1, 3, 48, 24, 25, 5000, *rng.integers(1, 90, 300))]
    seen = defaultdict(list)
    for w in recurrent_lm.lane_windows(enumerate(texts), 7, 16, 24, supply=2000):
        flat, inputs, live = w.targets.T.ravel(), w.inputs.T.ravel(), None if w.live is None else w.live.T.ravel()
        starts = [at for _, at, _ in w.parts] + [len(flat)]
        for (key, at, _), end in zip(w.parts, starts[1:], strict=True):
            on = slice(at, end) if live is None else np.flatnonzero(live[at:end]) + at
            assert inputs[on][0] == (texts[key][len(seen[key]) - 1] if seen[key] else 7)
            assert (at // 24 in w.fresh[at % 24]) == (not seen[key])
            seen[key] += flat[on].tolist()
    assert all(seen[i] == t.tolist() for i, t in enumerate(texts))


def test_lm_memory_follows_the_words_held_and_not_the_longest_text():
    voc = vocabulary(["a b c d e f g"])
    net, rng = recurrent_lm.Network(voc), np.random.default_rng(0)
    texts = [(i, rng.integers(0, 5, n).astype(np.int16)) for i, n in enumerate([500_000, *[50] * 600])]
    tracemalloc.start()
    scores = dict(recurrent_lm.text_scores(net, texts, voc.first))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(scores) == 601 and peak < 100e6


def test_lm_pieces_of_a_text_have_its_words(monkeypatch):
    text = b"Ab  cd\tefg " + b"x" * 50 + b" y \x1c\x85 z" * 5
    for size in (1, 3, 8, 1000):
        monkeypatch.setattr(recurrent_lm, "PIECE", size)
        assert [w for p in recurrent_lm.pieces(text) for w in p.split()] == text.split()
        texts = [text, None, b"", b" \n", b"one", text * 3, b"\xff x"]
        found = [(n, *recurrent_lm.split_words(part)) for _, n, part in recurrent_lm.text_slices(pa.array(texts, pa.binary()))]
        assert [w for _, words, _ in found for w in words.view(pa.binary()).to_pylist()] == [w for x in texts for w in (x or b"").lower().split()]
        assert [int(k) for n, _, sizes in found for k in (sizes if n > 1 else [sizes.sum()])] == [len((x or b"").split()) for x in texts]
    assert list(recurrent_lm.pieces(None)) == [b""]


def test_lm_holds_the_most_frequent_words_and_some_of_equal_ones(spark):
    counts = spark.createDataFrame([(bytearray(b"%d" % i), 100 if i < 10 else 5) for i in range(3000)], "word binary, n long")
    for known, least in ((1000, 900), (10, 10), (5000, 3000), (5, 1)):
        held = counts.where(recurrent_lm.held_words(counts, known)).collect()
        assert least <= len(held) <= known
        assert sum(r.n == 100 for r in held) == min(10, len(held))


def test_lm_edge_cases(odd, none):
    got = recurrent_lm.score_documents(odd).collect()
    assert len(got) == len(ODD) and all(math.isfinite(r.score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (2, 3, 4)} == {1}
    assert recurrent_lm.score_documents(none).collect() == []


# 2 Decontamination


def brute_hits(texts, items, span=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        m = min(span, len(w))
        for k in range(len(w) - m + 1 if w else 0):
            windows[tuple(w[k : k + m])].add(str(i))
    lengths = {len(k) for k in windows}
    out = []
    for i, t in texts:
        w = words(t)
        hit, found = set(), set()
        for m in lengths:
            for k in range(len(w) - m + 1):
                if (g := windows.get(tuple(w[k : k + m]))) is not None:
                    hit |= set(range(k, k + m))
                    found |= g
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def hits(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in df.collect()), key=str)


def test_decontamination_equals_brute_force_with_short_and_repeated_items(spark, odd):
    items = [(1, "brown fox JUMPS over"), (2, "the long text goes on the long text goes on the long"), (3, None), (4, "??"), (5, "today"), (6, "brown fox jumps over"), (7, "a b c d e f g h i j k"), (1, "it s")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("span", F.lit(1))
    assert hits(decontaminate.decontaminate(odd, bench)) == brute_hits(ODD, items)


def test_decontamination_of_random_words(spark):
    rng = np.random.default_rng(3)
    text = lambda n: " ".join(rng.choice(list("abc"), n))
    docs = [(i, text(60)) for i in range(40)]
    items = [(i, text(int(rng.integers(1, 14)))) for i in range(40)] + [(99, docs[0][1][40:90])]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert hits(decontaminate.decontaminate(a, b)) == brute_hits(docs, items)


def test_decontamination_of_empty_tables(odd, none):
    items = none.select(F.col("doc_id").alias("item_id"), "text")
    assert {r.n_hit for r in decontaminate.decontaminate(odd, items).collect()} == {0}
    assert decontaminate.decontaminate(none, odd.select(F.col("doc_id").alias("item_id"), "text")).collect() == []


# 3 Chat formatting


def test_chat_round_trip_and_mask(spark):
    nasty = ["<|turn|>x<|says|>", "\\<|", "<\\|", "<\\\\|end|>", "|>", "<", "\\", "", None, "\\### Assistant: </turn> ok", "a\nb", "日本🙂"]
    rows = [(c, t, role, nasty[(c * 5 + t) % len(nasty)]) for c in range(12) for t, role in enumerate(["system", "user", "user", "assistant", "assistant", None, "as<|and|>"])]
    rows += [(None, 1, "assistant", "null id"), (50, None, "assistant", "b"), (50, None, "assistant", "a"), (50, None, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    made = chat_format.format_conversations(df)
    back = {r.conv_id: r for r in chat_format.read_back(made).collect()}
    for c in {r[0] for r in rows}:
        want = sorted(((t is not None, t or 0, role or "", text or "") for cc, t, role, text in rows if cc == c))
        assert [(t.role, t.text) for t in back[c].turns] == [x[2:] for x in want]
        assert list(back[c].learned_texts) == [x[3] for x in want if x[2] == "assistant"]
    assert back[0].formatted.count("<|turn|>user<|says|>") == 1
    assert chat_format.format_conversations(df.limit(0)).collect() == []


def test_many_turns_of_one_conversation(spark):
    turns = spark.range(20_000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("<|end|> é "), F.col("id").cast("string")).alias("text")
    )
    begun = time.monotonic()
    row = chat_format.read_back(chat_format.format_conversations(turns.withColumns({c: F.lit("x") for c in ("blocks", "opens", "steps", "chunks", "starts", "parts", "formatted")}))).first()
    assert time.monotonic() - begun < 20
    assert row.learned_texts == [f"<|end|> é {i}" for i in range(20_000) if i % 3]
    assert [t.text for t in row.turns] == [f"<|end|> é {i}" for i in range(20_000)]


# 4 Sharding


def test_shards_are_near_equal_gapless_and_keep_small_groups(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "x" * int(rng.integers(1, 400))) for i in range(3000)] + [(10_000 + i, f"copy {i % 300}") for i in range(900)] + [(20_000 + i, "hot " * 40) for i in range(2500)] + [(None, None)] * 400
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in CLASHING})
    got = sharding.shard_by_bytes(df, 16).collect()
    assert len(got) == len(rows)
    load, slots, where = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        where[r.text_crc32].add(r.shard)
    mean = sum(load.values()) / 16
    assert len(load) == 16 and all(abs(x - mean) < 0.05 * mean for x in load.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(where[zlib.crc32(f"copy {i}".encode())]) == 1 for i in range(300))
    assert len(where[zlib.crc32(b"hot " * 40)]) > 1
    assert {r["size"] for r in got if r.doc_id is None} == {1}


def test_sharding_edge_cases(odd, none):
    got = sharding.shard_by_bytes(odd, 4).collect()
    assert len(got) == len(ODD) and {r.shard for r in got} <= set(range(4))
    assert sharding.shard_by_bytes(none, 4).collect() == []
    with pytest.raises(ValueError, match="positive"):
        sharding.shard_by_bytes(odd, 0)


# 5 Top-k search


@pytest.mark.parametrize("group_rows", [100_000, 7])
def test_topk_equals_brute_force_with_ties_and_bad_vectors(spark, group_rows):
    rng = np.random.default_rng(2)
    good = [(i, [float(x) for x in rng.integers(-2, 3, 8) / 8]) for i in range(300)]
    bad = [(1000, None), (1020, [None] + [0.1] * 7), (1040, [float("nan")] * 8), (1060, [float("inf")] * 8), (1080, []), (1100, [0.5, 0.5]), (None, [0.1] * 8)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>").withColumns({c: F.lit("x") for c in CLASHING})
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk_search.top_k(df, F.col("vec_id") % 20 == 0, 20, group_rows=group_rows).collect()]
    vec = {i: [math.floor(64 * x) for x in e] for i, e in good}
    want = []
    for q in [i for i in vec if i % 20 == 0]:
        ranked = sorted((-sum(a * b for a, b in zip(vec[q], vec[c], strict=True)), c) for c in vec if c != q)[:20]
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(ranked)]
    assert sorted(got) == sorted(want)


def test_topk_with_few_candidates_and_none(spark):
    few = spark.createDataFrame([(20, [1.0]), (1, [2.0]), (3, [-1.0])], "vec_id long, embedding array<float>")
    got = topk_search.top_k(few, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 8192), (3, -4096)]
    assert topk_search.top_k(few.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_bounds_hold_at_each_resolution():
    rng = np.random.default_rng(5)
    q, x = rng.normal(size=(20, 64)), rng.normal(size=(30, 64))
    last = None
    for n in topk_search.resolutions(64):
        bound = topk_search.bounding(q, n) @ topk_search.bounding(x, n).T
        assert (bound >= q @ x.T).all()
        assert last is None or (bound <= last + 1e-4).all()
        last = bound


def test_clustered_vectors_are_pruned_and_the_best_stay():
    """Of vectors around few centres, nearly all pairs go by their bounds, and the floor goes from block to block."""
    rng = np.random.default_rng(6)
    centres = np.repeat(rng.normal(0, 40, (16, 8)), 8, axis=1)
    x = np.floor(centres[rng.integers(0, 16, 20_000)] + rng.normal(0, 3, (20_000, 64)))
    ids = np.arange(len(x))
    best = topk_search.Best(ids[::100], x[::100], 20)
    for lo in range(0, len(x), 4000):
        best.see(ids[lo : lo + 4000], x[lo : lo + 4000])
    assert best.left[-1] < 0.1 * best.left[0] == 0.1 * 200 * 20_000
    scores = x[::100] @ x.T
    want = [(100 * r, int(c), int(scores[r, c])) for r in range(200) for c in [c for c in np.lexsort((ids, -scores[r])) if c != 100 * r][:20]]
    assert sorted(best.rows()) == sorted(want)


# 6 Language ID


def test_language_held_out_accuracy(docs):
    got = language_id.identify(docs).join(docs.select("doc_id", F.col("lang").alias("truth")), "doc_id").where("held_out").collect()
    assert len(got) > 30 and sum(r.lang_pred == r.truth for r in got) / len(got) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edge_cases(odd, none, spark):
    model = language_id.fit(spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, "x", None)], "doc_id long, text string, lang string"))
    got = {r.doc_id: r for r in language_id.predict(odd, model).collect()}
    assert [got[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and got[1].lang_pred == "en"
    digits = spark.createDataFrame([(1, "12 !!"), (2, "ß"), (3, "der hund")], "doc_id long, text string")
    assert [r.lang_pred for r in language_id.predict(digits, model).orderBy("doc_id").collect()] == ["und", "en", "de"]
    assert language_id.identify(none).collect() == []
    assert {r.lang_pred for r in language_id.predict(odd, language_id.fit(none)).collect()} == {"und"}


def test_more_languages_than_bits_of_a_word(spark):
    words = ["".join(chr(97 + (i * 7 + j * 3) % 26) for j in range(6)) for i in range(26)]
    names = [f"l{i:03d}" for i in range(70)]
    rows = [(i, " ".join([words[i % 26] * (1 + i // 26)] * 5), n) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df)
    assert model.masks.shape[1] == 2 and model.languages == names
    assert language_id.predict(df, model).count() == 70


def test_language_equals_exact_sets_of_ngrams(spark):
    """The filter's decision against sets of each language's n-grams, without a filter or sampling."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    train = [r for r in docs.where("lang IS NOT NULL AND text IS NOT NULL").collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    grams = lambda t: [b[i : i + 4] for b in [language_id.letters(t.encode()).ljust(4)] for i in range(len(b) - 3)]
    n, having, texts = defaultdict(Counter), defaultdict(Counter), Counter(r.lang for r in train)
    for r in train:
        n[r.lang].update(grams(r.text))
        having[r.lang].update(set(grams(r.text)))
    rate = {lang: {g: k / n[lang].total() for g, k in n[lang].items()} for lang in texts}
    most = {g: max(rate[lang].get(g, 0) for lang in texts) for lang in texts for g in rate[lang]}
    own = {lang: {g for g, k in rate[lang].items() if k >= 0.01 * most[g] and having[lang][g] >= max(0.005 * texts[lang], min(3, texts[lang] / 20))} for lang in texts}
    got, same, close = {r.doc_id: r for r in language_id.identify(docs).collect()}, 0, 0
    known = [r for r in docs.collect() if r.text and language_id.has_letter(r.text.encode())]
    for r in known:
        hits = {lang: sum(g in own[lang] for g in grams(r.text)) for lang in sorted(texts)}
        best = max(hits, key=lambda lang: hits[lang])
        same += got[r.doc_id].lang_pred == best
        close += abs(got[r.doc_id].score - hits[best] / max(1, sum(hits.values()))) < 0.03
    assert same >= 0.998 * len(known) and close >= 0.99 * len(known)


def test_too_many_languages_are_an_error(spark):
    df = spark.range(1100).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError, match="languages"):
        language_id.fit(df)


# 7 Token counts, 9 BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(WORD_BPE))


def fuzz(n=1500):
    rng = np.random.default_rng(7)
    alphabet = list("abcABC 'sStTdDlLmMrReEvV12ⅣΣσςİıßẞÉé​\x00\x1c\x1d\x85\xa0 　!?#日本हिन्दी²½_\n\t🙂") + ["<|endoftext|>", "<|startoftext|>", "<|", "the ", "ing", "'ll"]
    return ["".join(rng.choice(alphabet, int(rng.integers(0, 40)))) for _ in range(n)] + ["aaaaaaa aaaaaaaaaa", "<|ENDOFTEXT|>", "th" * 3000 + " x", "x'S it's 'll'll '' 's's"]


def test_encoding_decoding_and_counts_equal_the_library(library):
    bpe = word_bpe.load(WORD_BPE)
    texts = fuzz()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    encoder = word_bpe.Encoder(bpe, memory=3000)
    machine = token_counts.Transducer(bpe, memory=2000)
    for lo in range(0, len(texts), 200):
        part = [t.encode() for t in texts[lo : lo + 200]]
        assert encoder(part).to_pylist() == want[lo : lo + 200]
        assert machine.count(part).tolist() == [len(w) for w in want[lo : lo + 200]]


def test_encode_and_decode_frames(spark, odd, none, library):
    ids = word_bpe.encode(odd, WORD_BPE)
    got = word_bpe.decode(ids, WORD_BPE).collect()
    want = [library.encode(t or "", add_special_tokens=False).ids for _, t in ODD]
    assert sorted((r.doc_id or 0, list(r.ids)) for r in ids.collect()) == sorted((i or 0, w) for (i, _), w in zip(ODD, want, strict=True))
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted((i or 0, library.decode(w, skip_special_tokens=False)) for (i, _), w in zip(ODD, want, strict=True))
    assert word_bpe.encode(none, WORD_BPE).collect() == []
    odd_ids = spark.createDataFrame([(1, None), (2, []), (3, [320, -1, 10**9, None, 320])], "doc_id long, ids array<int>")
    a = library.id_to_token(320)
    assert {r.doc_id: r.text for r in word_bpe.decode(odd_ids, WORD_BPE).collect()} == {1: None, 2: "", 3: f"{a} {a}"}


@pytest.mark.parametrize("word", ["a" * 300_000, "ab" * 60_000, "".join(random.Random(1).choices("abcdefgh", k=120_000)), "".join(random.Random(2).choices("aab", k=120_000))], ids=len)
def test_one_long_word_is_counted_in_chunks_and_few_states(word):
    """Chunks without a word end have maps, which are composed; states stay within the bound and those in use."""
    bpe, memory = word_bpe.load(WORD_BPE), 3000
    machine = token_counts.Transducer(bpe, memory)
    text = f"{word} and {word[:5000]} end".encode()
    expected = int(bpe.encode_words(text.split())[1].sum())
    assert machine.count([text, b"", None, text[:7000]]).tolist() == [expected, 0, 0, int(bpe.encode_words([text[:7000]])[1].sum())]
    assert len(machine.chains) <= memory + 2 * token_counts.LANES


def test_count_frames(odd, none, library):
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(odd, WORD_BPE).collect())
    want = []
    for i, t in ODD:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i or 0, len((t or "").encode()), n, n > 2048))
    assert got == sorted(want)
    assert token_counts.count_tokens(none, WORD_BPE).collect() == []


# 8 SimHash


def brute_print(t):
    w = spaced(t)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, ids, bits=2):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


def test_simhash_of_documents_equals_brute_force(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in rows]
    want = dict(zip([r.doc_id for r in rows], zip(prints, brute_components(prints, [r.doc_id for r in rows]), strict=True), strict=True))
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash_dedup.near_duplicates(docs).collect()}
    assert got == want


@pytest.mark.parametrize(("bits", "list_limit"), [(2, 64), (2, 1), (1, 1), (0, 64)])
def test_links_connect_what_is_near(spark, bits, list_limit):
    rng = np.random.default_rng(9)
    seeds = [int(x) for x in rng.integers(0, 1 << 62, 12)]
    prints = sorted({s ^ sum(1 << int(b) for b in rng.integers(0, 64, 6)[: rng.integers(0, 6)]) for s in seeds for _ in range(25)})
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    edges = simhash_dedup.links(df, bits, list_limit)
    assert all(((r.u ^ r.v) % (1 << 64)).bit_count() <= bits for r in edges.collect())
    roots = {r.node: r.root for r in simhash_dedup.components(edges).collect()}
    want = brute_components([s % (1 << 64) for s in signed], signed, bits)
    assert [roots.get(s, s) for s in signed] == want


def test_components_of_a_long_path(spark):
    path = spark.range(200).select((F.col("id") * 7 % 1000 + F.col("id") * 1000).alias("u"), ((F.col("id") + 1) * 7 % 1000 + (F.col("id") + 1) * 1000).alias("v"))
    got = simhash_dedup.components(path).collect()
    assert len(got) == 201 and {r.root for r in got} == {0}


def test_simhash_edge_cases(odd, none):
    got = sorted((r.doc_id or 0, r.component_id) for r in simhash_dedup.near_duplicates(odd).collect())
    assert got == [(0, None), (1, 1), (2, 2), (3, 2), (4, 2), (5, 5), (6, 1), (6, 1), (7, 7), (8, 8)]
    assert simhash_dedup.near_duplicates(none).collect() == []
    with pytest.raises(ValueError, match="two"):
        simhash_dedup.links(none, bits=3)


def jaccard(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()} for w in (spaced(a), spaced(b))]
    return len(sets[0] & sets[1]) / max(1, len(sets[0] | sets[1]))


def test_similar_texts_equal_brute_force(spark):
    """Chains of near copies, unrelated texts that share a passage, copies, and short texts."""
    rng = np.random.default_rng(8)
    words = np.array([f"w{i}" for i in range(900)])
    passage, texts = list(rng.choice(words, 40)), ["", None, "one", "One", "two words", "one two three four five", "ONE two  three four five"]
    for _ in range(12):
        text = list(rng.choice(words, 120))
        for _ in range(12):
            texts.append(" ".join(text))
            text[rng.integers(0, 120)] = "new"
        texts.append(" ".join(passage + list(rng.choice(words, 60))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash_dedup.similar_texts(docs).collect()}
    least = {i: i for i in range(len(texts))}
    blank = lambda i: not spaced(texts[i])
    for i in least:
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8 or blank(i) and blank(j):
                old, new = sorted((least[i], least[j]), reverse=True)
                least = {k: new if c == old else c for k, c in least.items()}
    assert got == least


def test_lists_of_any_batches():
    """All nodes of lists of two or more with their least node, however batches cut the lists."""
    sizes = (1, 3, 9, 1, 1, 4, 30)
    keys, nodes = np.repeat(np.arange(7), sizes), np.concatenate([np.arange(n) * 7 + 2 for n in sizes])
    want = sorted((k, 2, i * 7 + 2) for k, n in enumerate(sizes) if n > 1 for i in range(n))
    for size in (1, 2, 3, 5, 100):
        batches = (pa.record_batch({"key": keys[i : i + size], "node": nodes[i : i + size]}) for i in range(0, len(keys), size))
        assert sorted(r for b in simhash_dedup.list_rows(batches) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)) == want


def test_a_large_group_of_near_copies_takes_few_pairs(spark, monkeypatch):
    """Of 1,500 near copies of a text, many of which aren't similar to the first, each meets few others, and all are one component."""
    rng = np.random.default_rng(9)
    base, words = [f"w{i}" for i in range(200)], []
    for _ in range(1500):
        text = list(base)
        for at in rng.integers(0, 200, rng.integers(0, 4)):
            text[at] = f"x{rng.integers(0, 10**9)}"
        words.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    pairs, whole = [], simhash_dedup.tallied
    monkeypatch.setattr(simhash_dedup, "tallied", lambda p, *a: pairs.append(p.count()) or whole(p, *a))
    got = simhash_dedup.similar_texts(docs).collect()
    assert len(got) == 1500 and sum(r.component_id == 0 for r in got) > 1400
    assert sum(pairs) < 60_000


# 10 Quality


def test_quality_ranks_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r.score for r in got if r.quality == 1], [r.score for r in got if r.quality == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.9 and np.mean([s >= 0.3 for s in good]) > 0.95


def test_quality_edge_cases(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (3, None)], "doc_id long, quality int").withColumn("text", F.lit("x"))
    got = quality.classify(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert {r.score for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(none, labels).collect() == []


def test_non_negative_risk_separates_classes():
    rng = np.random.default_rng(4)
    one = lambda m, n: np.hstack([rng.normal(m, 1, (n, 2)), np.ones((n, 1))]).astype(np.float32)
    model = quality.fit_pu(np.vstack([one(2, 300), one(2, 300), one(-2, 300)]), 300, 0.5)
    z = lambda x: ((x - model.mean) / model.scale) @ model.weights
    assert (z(one(2, 200)) > 0).mean() > 0.95 and (z(one(-2, 200)) < 0).mean() > 0.95


def plain_features(text, dim=quality.DIM):
    """Features of a text, one n-gram and word at a time."""
    data, counts = (text or "").encode(), np.zeros(dim)
    shape = [1 if 97 <= b <= 122 or b >= 128 else 2 if 65 <= b <= 90 else 3 if 48 <= b <= 57 else 4 if b in (9, 32) else 5 if b in (10, 13) else 6 + b for b in data]
    for n in (1, 2, 3):
        for i in range(len(shape) - n + 1):
            code = n
            for x in shape[i : i + n]:
                code = (code << 8) + x
            counts[(code * 0x9E3779B97F4A7C15 % 2**64 >> 40) % dim] += 1
    words, bins = data.split(), np.zeros(2 * quality.BINS)
    if len(words) > 1:
        again = sum(a == b for a, b in zip(words, words[1:], strict=False)) / (len(words) - 1)
        fresh = sum(len(set(words[i : i + 200])) for i in range(0, len(words), 200)) / len(words)
        bins[min(quality.BINS - 1, int(again * quality.BINS))] = 1
        bins[quality.BINS + min(quality.BINS - 1, int(fresh * quality.BINS))] = 1
    return np.r_[np.sqrt(counts / max(1, counts.sum())), bins, 1]


def test_quality_features_and_scores_equal_plain_loops(docs):
    texts = [r.text for r in docs.limit(25).collect()] + ["", None, "a", "the the the the", "It's 12 !! " * 300]
    want = np.array([plain_features(t) for t in texts])
    assert np.allclose(quality.features([t if t is None else t.encode() for t in texts]), want, atol=1e-6)
    rng = np.random.default_rng(0)
    model = quality.QualityModel(rng.normal(0, 1, want.shape[1]), rng.normal(0, 0.1, want.shape[1]), np.full(want.shape[1], 0.5), 0.5)
    z = ((want - model.mean) / model.scale) @ model.weights
    assert np.allclose(model.score([t if t is None else t.encode() for t in texts]), 1 / (1 + np.exp(-np.clip(z, -30, 30))), atol=1e-5)


def test_quality_slope_is_that_of_the_non_negative_risk():
    """Against differences of the risk, where it is as it stands, and turned round where its unlabelled part is negative."""
    rng = np.random.default_rng(1)
    p, u = rng.normal(0.5, 1, (40, 5)), rng.normal(-0.2, 1, (70, 5))
    for prior in (0.3, 0.9):
        for w in (rng.normal(0, 1, 5), np.array([-3.0, -3, 0, 0, -2])):
            loss = lambda v, x: np.logaddexp(0, -x @ v).mean()  # noqa: E731  of x as positive; of -x as negative
            rest = lambda v: loss(v, -u) - prior * loss(v, -p)
            risk = (lambda v: prior * loss(v, p) + rest(v)) if rest(w) >= 0 else (lambda v: -rest(v))
            steps = np.eye(5) * 1e-5
            want = [(risk(w + d) - risk(w - d)) / 2e-5 for d in steps]
            assert np.allclose(quality.risk_slope(w, p, u, prior), want, atol=1e-5)


@pytest.mark.parametrize("share", [0.2, 0.5, 0.85])
def test_class_prior_comes_from_positives_and_unlabelled_rows(share):
    rng = np.random.default_rng(2)
    p, good, bad = rng.normal(1.5, 1, (3000, 4)), rng.normal(1.5, 1, (int(8000 * share), 4)), rng.normal(-1.5, 1, (8000 - int(8000 * share), 4))
    x = np.hstack([np.vstack([p, good, bad]), np.ones((11000, 1))]).astype(np.float32)
    assert abs(quality.class_prior(x, 3000) - share) < 0.06


def test_quality_learns_from_all_unlabelled_rows(spark):
    """A kind of text that is in no sample of 200 unlabelled rows, but in all of them, changes the model."""
    rows = [(i, f"Good text number {i % 7}, it is well written.") for i in range(300)] + [(300 + i, "bad!!! bad!!! $$$ ### bad") for i in range(300)]
    labels = spark.createDataFrame([(i, 1) for i in range(0, 300, 3)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    first = quality.fit(docs, labels, unlabelled=50)
    other = quality.fit(docs.union(spark.createDataFrame([(10**6 + i, "@@@@ %%%% ^^^^ ~~~~") for i in range(40)], docs.schema)).repartition(4), labels, unlabelled=50)
    odd, good = b"@@@@ %%%% ^^^^ ~~~~", b"Good text number 3, it is well written."
    assert other.score([odd])[0] < 0.3 < other.score([good])[0] and other.score([odd])[0] < first.score([odd])[0] + 0.3


def test_digest_queries_describe_operator_output(spark, sf, docs, library):
    got = {r.doc_id: r for r in QUERIES["op9_word_bpe"](spark, sf).collect()}
    for r in docs.limit(20).collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_quality_sample_is_bounded_for_rows_of_one_id(spark, monkeypatch):
    """Of 2,000 rows of a labelled id and 2,000 without id about `positives` and `unlabelled` are drawn."""
    rows = [(i, f"text {i} {k} of many words") for i in (7, None) for k in range(2000)]
    docs = spark.createDataFrame([*rows, (8, "another")], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, quality int")
    drawn = []
    whole = quality.class_prior
    monkeypatch.setattr(quality, "class_prior", lambda x, good: drawn.append((good, len(x) - good)) or whole(x, good))
    quality.fit(docs, labels, positives=100, unlabelled=200)
    assert 40 < drawn[0][0] < 180 and 120 < drawn[0][1] < 300


# What operators share, and very long texts


def test_skew_join_equals_a_join_with_hot_keys(spark):
    """A key with most of the rows is joined by broadcast, others as usual; null keys match nothing."""
    left = spark.createDataFrame([(7, i) for i in range(3000)] + [(i, -i) for i in range(300)] + [(None, 1)], "k long, v long")
    right = spark.createDataFrame([(i, f"x{i}") for i in range(0, 300, 2)] + [(7, "hot"), (None, "no")], "k long, w string")
    want = sorted(map(tuple, left.join(right, "k").select("k", "v", "w").collect()))
    for parts, few in ((10, 0), (1000, 0), (10, 10_000)):
        assert sorted(map(tuple, common.skew_join(left, right, "k", hot_parts=parts, few=few).select("k", "v", "w").collect())) == want
    assert common.skew_join(left.limit(0), right, "k").collect() == []


def test_a_bitmap_says_no_only_to_what_isnt_there(spark):
    df = spark.range(20_000).select("id", F.xxhash64("id").alias("h"), F.lit("x").alias("bits"))
    some = df.where("id % 100 = 3").select(F.col("h").alias("any"))
    got = common.maybe_among(df, F.col("h"), some)
    assert got.columns == [*df.columns, "__maybe"]
    yes = {r.id for r in got.where("__maybe").collect()}
    assert {i for i in range(20_000) if i % 100 == 3} <= yes and len(yes) < 260
    assert common.maybe_among(df, F.col("h"), some.limit(0)).where("__maybe").isEmpty()


def test_a_text_of_millions_of_bytes(spark, library):
    """Beside short ones, with every operator on texts; each takes it whole."""
    rng = np.random.default_rng(0)
    words = np.array([f"wort{i} und" for i in range(2000)] + ["der hund", "die katze", "ist"])
    long = " ".join(rng.choice(words, 300_000))
    item = " ".join(long.split()[-12:])
    docs = spark.createDataFrame([(1, long), (2, "short text"), (3, long), (4, None)], "doc_id long, text string")
    n = len(long.split())
    found = {r.doc_id: r for r in decontaminate.decontaminate(docs, spark.createDataFrame([("i", item)], "item_id string, text string")).collect()}
    assert found[1].n_words == n and found[1].n_hit >= 12 and found[1].item_ids == ["i"]
    assert {r.doc_id: r.component_id for r in simhash_dedup.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1, 4: 4}
    assert {r.doc_id: r.component_id for r in simhash_dedup.similar_texts(docs).collect()} == {1: 1, 2: 2, 3: 1, 4: 4}
    model = language_id.fit(docs.withColumn("lang", F.when(F.col("doc_id") == 1, "de").when(F.col("doc_id") == 2, "en")))
    assert {r.doc_id: r.lang_pred for r in language_id.predict(docs, model).collect()} == {1: "de", 2: "en", 3: "de", 4: "und"}
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    assert len(scores) == 4 and abs(scores[1] - scores[3]) < 1e-6
    placed = sharding.shard_by_bytes(docs, 4).collect()
    assert sorted(r.size for r in placed) == sorted([len(long) + 1, len(long) + 1, 11, 1])
    ids = {r.doc_id: r.ids for r in word_bpe.encode(docs, WORD_BPE).collect()}
    assert ids[1] == ids[3] == library.encode(long, add_special_tokens=False).ids
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, WORD_BPE).collect()} == {k: len(v) for k, v in ids.items()}
    held = {r.doc_id: r.n_tokens for r in recurrent_lm.score_documents(docs, rates=(0.01,)).collect()}
    assert held == {1: n + 1, 2: 3, 3: n + 1, 4: 1}
