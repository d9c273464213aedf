"""Toxicity, importance resampling and turn repair against brute force, held-out labels and edge cases."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import assert_same, database
from pyspark.sql import functions as F

from tidemark.llm import common, resampling, simhash_dedup, toxicity, turn_repair
from tidemark.llm.queries import ORACLES, QUERIES

LONG = "the long text goes on, " * 4000
ODD = [(1, "The quick brown fox jumps over the lazy dog " * 3), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, "one two " * 12), (6, "one two " * 12), (7, "ÉCOLE Σίσυφος it's !!! 日本語"), (None, "a row without id " * 6), (8, "a" * 5000)]
CLASHING = ["rank", "score", "weight", "n_features", "place", "part", "chunk", "conv", "n", "predicted"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumns({c: F.lit("x") for c in CLASHING})


def column(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


@pytest.mark.parametrize("name", ["op12_importance_resampling", "op13_turn_repair"])
def test_query_matches_sql(name, spark, sf):
    assert_same(QUERIES[name](spark, sf), database(sf), ORACLES[name])


# Resampling


def plain_resample(docs, target, orders=1, n=10_000, percent=10, least=20):
    import re

    def features(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % n for k in range(1, orders + 1) for i in range(len(w) - k + 1)]

    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(features(x)[1])
    for x in target:
        t.update(features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    rows = []
    for i, x in docs:
        words, f = features(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + n) / ((s[b] + 1) * (big_t + n)))) for b in f)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], -math.inf if r[0] is None else r[0], r[1], r[2]))
    drawn = [(*r[:4], k + 1) for k, r in enumerate(able[: len(able) * percent // 100])]
    return sorted(drawn + [(*r[:4], None) for r in rows if not any(r is a for a in able[: len(drawn)])], key=str)


@pytest.mark.parametrize(("orders", "percent"), [(1, 50), (2, 30), (3, 0), (1, 100)])
def test_resampling_equals_plain_loops(spark, odd, orders, percent):
    target = ["the quick fox jumps over the fence and the long text", None, ""]
    got = resampling.resample(odd, spark.createDataFrame([(t,) for t in target], "text string"), orders=orders, percent=percent)
    assert column(got, *got.columns) == plain_resample(ODD, target, orders, percent=percent)


def test_resampling_of_nothing(spark, odd):
    none = odd.where("false")
    assert resampling.resample(none, odd).collect() == []
    assert {r["rank"] for r in resampling.resample(odd, none).collect()} == {None}


def test_long_texts_are_read_in_parts():
    text = ("Some words, and MORE " * 200_000).encode()
    parts = list(resampling.buckets(text, 3, 10_000))
    words = text.translate(resampling.WORD_BYTES).split()
    assert len(parts) > 6
    whole = Counter(zlib.crc32(b" ".join(words[i : i + k])) % 10_000 for k in (1, 2, 3) for i in range(len(words) - k + 1))
    assert Counter(np.concatenate(parts).tolist()) == whole
    assert b"".join(common.pieces(text, 1000)) == text


@pytest.mark.parametrize("scores", [list(range(1000)), [5] * 1000, [0] * 900 + [9] * 100, [random.Random(3).randrange(40) for _ in range(1000)]])
@pytest.mark.parametrize("k", [1, 100, 999, 1000])
def test_a_bracket_holds_the_cutoff(spark, scores, k):
    df = spark.createDataFrame([(s,) for s in scores], "score long")
    low, high, above = resampling.bracket(df, k, half_width=0.001, accuracy=20)
    cut = sorted(scores, reverse=True)[k - 1]
    assert low <= cut <= high
    assert above == sum(s > high for s in scores) < k


def test_ranks_of_a_key_that_all_rows_share(spark):
    df = spark.range(5000).select(F.lit(1).alias("score"), "id")
    got = common.ranked(df, [F.col("score").desc(), F.col("id")])
    assert got.where("rank <> id + 1").count() == 0
    assert common.ranked(df.where("false"), [F.col("id")]).collect() == []


# Turn repair


def plain_audit(codes):
    """All audits by states, the cheapest and then the least of each."""
    goes = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def put(d, k, v):
        d[k] = min(d.get(k, v), v)

    def inserted(d):
        d = dict(d)
        for _ in range(3):
            for k, (c, a) in list(d.items()):
                for t, z in goes[k].items():
                    if t != "s":
                        put(d, z, (c + 2, a + "I"))
        return d

    held = {0: (0, "")}
    for code in codes:
        new = {}
        for k, (c, a) in inserted(held).items():
            put(new, k, (c + 3, a + "D"))
            for t, z in goes[k].items() if code != "d" else ():
                if code.lower() == t or t != "s":
                    put(new, z, (c + code.isupper() + 2 * (code.lower() != t), a + ("K" if code.lower() == t else "R")))
        held = new
    held = inserted(held)
    return min(v for k, v in held.items() if k in (0, 3))


def test_alignment_finds_the_least_audit():
    codes = ["".join(c) for n in range(4) for c in itertools.product("suaxSUd", repeat=n)]
    codes += ["".join(random.Random(i).choices("suaxUAd" if i % 2 else "uauauaUAsd", k=i % 13)) for i in range(400)]
    for c in codes:
        ways = turn_repair.transfer(c)
        assert min(w for w in (ways[0], ways[3]) if w is not None) == plain_audit(c)


@pytest.mark.parametrize("cuts", [1, 3])
def test_chunks_compose(cuts):
    r = random.Random(cuts)
    for _ in range(150):
        codes = "".join(r.choices("uauauauaUAsxd", k=r.randrange(1, 20)))
        at = [0, *sorted(r.randrange(len(codes) + 1) for _ in range(cuts)), len(codes)]
        ways = turn_repair.transfer("")
        for lo, hi in itertools.pairwise(at):
            ways = turn_repair.composed(ways, turn_repair.transfer(codes[lo:hi]))
        assert min(w for w in (ways[0], ways[3]) if w is not None) == plain_audit(codes)


def test_band_leaves_out_dear_lengths():
    assert turn_repair.align("uauaua", "ua" * 20, 3) is None
    assert turn_repair.align("uauaua", "ua" * 3, 0) == (0, "KKKKKK")


def plain_repair(turns):
    """Faults, cost, audit and digest of one conversation's turns (turn, role, text) in order."""
    seen, codes, n = set(), "", Counter()
    for _, role, text in turns:
        bare = text.rstrip(turn_repair.SPACE)
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        n[kind] += 1
        i = role[:1] if role[:1] in ("s", "u", "a") and role else "x"
        codes += "d" if kind in ("blank", "duplicate") else i.upper() if kind else i
    cost, audit = plain_audit(codes)
    out, i, length = [], 0, len(audit) - audit.count("D")
    for edit in audit:
        name = "system" if length % 2 and not out else ("user", "assistant")[(len(out) + length) % 2]
        if edit == "I":
            out.append(f"{name}:")
            continue
        _, role, text = turns[i]
        i += 1
        if edit != "D":
            out.append(f"{role if edit == 'K' else name}:{text}")
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    wrong = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
    return gaps, n["blank"], n["duplicate"], n["truncated"], wrong, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def made_turns(seed):
    r = random.Random(seed)
    rows = []
    for conv in [*range(12), None]:
        for turn in range(r.choice([0, 1, 3, 8, 60])):
            text = r.choice(["Fine. ", "Cut off", "", " \n", "Why?\t", "Same.", f"Text {turn}!", LONG + "."])
            rows.append((conv, r.choice([turn, turn, turn, None, 2 * turn]), r.choice(["user", "assistant", "system", "tool", ""]), text))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_repair_equals_plain_loops(spark, seed):
    rows = made_turns(seed)
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("place", "chunk", "audit", "part", "first", "digest", "cost")})
    got = {r["conv"]: tuple(r)[1:] for r in turn_repair.repair(df.select("conv", "turn", "role", "text")).select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    want = {}
    for conv in {c for c, *_ in rows}:
        turns = sorted(((t, r, x) for c, t, r, x in rows if c == conv), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        want[conv] = plain_repair(turns)
    assert got == want


def test_a_long_conversation_takes_many_chunks(spark):
    turns = spark.range(9000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("Turn "), F.col("id").cast("string"), F.lit(".")).alias("text")
    )
    got = turn_repair.repair_damaged(turns).collect()
    damaged = sorted(tuple(r) for r in turn_repair.damaged(turns, "conv_id", "turn", "role", "text").select("turn", "role", "text").collect())
    assert [tuple(r)[1:] for r in got] == [plain_repair(damaged)]


def test_damage_and_nulls(spark):
    kind = lambda c, t: zlib.crc32(f"{c}:{t}".encode()) % 20
    rows = [(c, t, None if t % 3 == 0 else "assistant", None if t % 4 == 0 else "Yes. No!") for c in range(40) for t in range(3)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("conv", "kind", "copy", "tie")})
    want = []
    for c, t, role, text in rows:
        k, role, text = kind(" " if c is None else c, " " if t is None else t), role or " ", text or " "
        want += {0: []}.get(k, [(c, t, "user" if k == 4 else role, "" if k == 1 else text.replace(".", "").replace("!", "") if k == 2 else text)] * (2 if k == 3 else 1))
    made = turn_repair.damaged(df, "conv_id", "turn", "role", "text")
    assert column(made, "conv", "turn", "role", "text") == sorted(want, key=str)
    got = turn_repair.repair_damaged(df)
    assert sorted(str(r.conv_id) for r in got.select("conv_id").collect()) == sorted(map(str, [*range(40), None]))
    gone = next(c for c in itertools.count() if kind(c, 0) == 0)
    lost = turn_repair.repair_damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], df.select("conv_id", "turn", "role", "text").schema)).collect()
    assert [tuple(r) for r in lost] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert turn_repair.repair_damaged(df.where("false")).collect() == []


# Toxicity


def insulted(n, words, seed):
    r = random.Random(seed)
    plain = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randrange(3, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        text = r.choices(plain, k=r.randrange(20, 200))
        if i % 4 == 0:
            text[r.randrange(len(text))] = r.choice(words)
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    return rows


@pytest.fixture(scope="module")
def insults(spark):
    rows = insulted(1200, ["blockhead", "numbskull", "dunderhead", "nincompoop"], 1)
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return rows, docs, labels


def test_toxic_documents_are_found_outside_the_fit(insults):
    rows, docs, labels = insults
    got = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    assert len(got) == len(rows)
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert {i for i in got if got[i].held_out} == {i for i in got if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(p == y for p, y in held) >= 0.97 * len(held)


def test_misspellings_share_vectors(spark, insults):
    _, docs, labels = insults
    model = toxicity.fit(docs, labels)
    clean = "nothing here is said of anyone and so it may well stay as it is for ever"
    texts = [clean, clean + " you numbskulll of mine", clean + " what a bblockhead", clean + " NINCOMPOOPS!", LONG + " dunderhead " + LONG]
    got = dict(toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).select("doc_id", "predicted").collect())
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1}


def test_toxicity_of_odd_rows(spark, odd, insults):
    model = toxicity.fit(insults[1], insults[2])
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD)
    assert all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3, 4)}) == 1
    assert len({r.score for r in got if r.doc_id == 6}) == 1
    assert toxicity.score(odd.where("false"), model).collect() == []


def test_toxicity_without_labels(spark, odd):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.classify(odd, labels).collect()} == {0}
    assert {round(r.score, 3) for r in toxicity.score(odd, toxicity.fit(odd, spark.createDataFrame([(1, 1), (5, 1)], labels.schema))).collect()} == {1.0}
    assert toxicity.classify(odd.where("false"), labels).collect() == []


def test_gradient_of_a_step():
    """A step at a tiny rate moves the loss as its slope says."""
    ids, sizes = toxicity.subwords(["alpha", "beta", "gamma"], 64)
    t = toxicity.Trainer(ids, sizes, np.ones(64, bool), 4)
    t.table[:] = np.random.default_rng(0).normal(size=t.table.shape) * 0.1
    words, lengths, labels = np.array([0, 1, 1, 2, 0]), np.array([2, 3]), np.array([1, 0])

    def loss():
        total, at = 0.0, 0
        for n, y in zip(lengths, labels, strict=True):
            rows = np.concatenate([ids[(np.cumsum(sizes) - sizes)[w] :][: sizes[w]] for w in words[at : at + n]])
            z = toxicity.SCALE * t.table[rows].mean(axis=0) @ t.out + t.bias
            total, at = total - (z - np.logaddexp(*z))[y], at + n
        return total

    before = [loss()]
    for _ in range(3):
        t.step(words, lengths, labels, np.ones(2, np.float32), 1e-3)
        before.append(loss())
    assert before == sorted(before, reverse=True)


def test_long_words_and_texts_in_parts():
    text = ("word " * 300_000 + "x" * 1000).encode()
    found = [w for part in toxicity.words_of(text) for w in part]
    assert len(found) == 300_000 + math.ceil(1000 / toxicity.LONGEST)
    ids, sizes = toxicity.subwords(["ab", "word"])
    # <ab> has two of 3, one of 4; <word> four of 3, three of 4, two of 5, one of 6; and each itself.
    assert sizes.tolist() == [4, 11]
    assert len(ids) == 15


# Near duplicates


def pages(n, own, seed=5, size=120):
    """Pages of one template of `size` words, of which each has `own` places filled with its own words."""
    r = random.Random(seed)
    template = [f"w{i}" for i in range(size)]
    out = []
    for k in range(n):
        words = list(template)
        for j, at in enumerate(r.sample(range(5, size - 5, 5), own)):
            words[at] = f"own{k}x{j}"
        out.append(" ".join(words))
    return out


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def plain_components(texts, similarity=0.8):
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def test_pages_below_the_threshold_make_few_pairs(spark, monkeypatch):
    """2,000 pages of one template, none similar enough: fewer than 20 pairs a page, in all rounds."""
    texts = pages(2000, 3, size=160)
    some = [shingles(t) for t in texts[:60]]
    near = [len(a & b) / len(a | b) for a, b in itertools.combinations(some, 2)]
    assert 0.66 < min(near) and sum(x >= 0.8 for x in near) < 5
    made = []
    plain = simhash_dedup.tallied
    monkeypatch.setattr(simhash_dedup, "tallied", lambda pairs, classes, least: made.append(pairs.count()) or plain(pairs, classes, least))
    met = simhash_dedup.met_in_blocks
    monkeypatch.setattr(simhash_dedup, "met_in_blocks", lambda *a: made.append((out := met(*a).checkpoint()).count()) or out)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    simhash_dedup.similar_texts(docs).count()
    assert sum(made) < 20 * 2000


def test_groups_near_the_threshold_equal_brute_force(spark):
    """Pages of which some are similar and most are just not; blocks find what lists do."""
    texts = pages(150, 3, 1) + pages(150, 4, 2) + pages(60, 2, 3)
    got = dict(simhash_dedup.similar_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    want = plain_components(texts)
    together = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if want[i] == want[j]]
    assert all(want[i] == want[j] for i, j in itertools.combinations(range(len(texts)), 2) if got[i] == got[j])
    assert sum(got[i] == got[j] for i, j in together) >= 0.98 * len(together)


@pytest.mark.parametrize("most_bits", [1 << 17, 0])
def test_sets_compare_alike_as_bits_and_one_by_one(monkeypatch, most_bits):
    monkeypatch.setattr(simhash_dedup, "MOST_BITS", most_bits)
    r = np.random.default_rng(3)
    x, y = ([np.unique(r.integers(0, 60, r.integers(0, 60)).astype(np.uint64)) for _ in range(n)] for n in (9, 7))
    at, to = (a.ravel() for a in np.meshgrid(range(9), range(7), indexing="ij"))
    want = [len(set(x[i]) & set(y[j])) >= 0.5 * len(set(x[i]) | set(y[j])) for i, j in zip(at, to, strict=True)]
    assert simhash_dedup.similar_pairs(x, y, at, to, 0.5).tolist() == want


@pytest.mark.parametrize("edits", [1, 2, 3, 4])
def test_near_copies_are_found_in_each_band_of_similarity(spark, edits):
    """Thousands of planted pairs: nine tenths and more of those of 0.8 and more are one group."""
    r = random.Random(edits)
    rows = []
    for k in range(600):
        words = [f"t{k}w{r.randrange(10_000)}" for _ in range(r.choice([45, 90, 200]))]
        other = list(words)
        for at in r.sample(range(2, len(words) - 2), max(1, edits * len(words) // 100)):
            other[at] = f"new{at}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    got = dict(simhash_dedup.similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    alike = [k for k in range(600) if len(a := shingles(rows[2 * k][1])) and len(a & (b := shingles(rows[2 * k + 1][1]))) >= 0.8 * len(a | b)]
    assert all((got[2 * k] == got[2 * k + 1]) <= (k in alike) for k in range(600))
    if alike:
        assert sum(got[2 * k] == got[2 * k + 1] for k in alike) >= 0.9 * len(alike)


@pytest.mark.parametrize("edits", [2, 3])
def test_no_pair_of_the_threshold_is_left_out(spark, edits):
    """600 planted pairs, short ones of four and five shingles, and lone texts among them: all pairs of 0.8 and more are one group."""
    r = random.Random(10 + edits)
    rows = []
    for k in range(600):
        words = [f"t{k}w{r.randrange(10_000)}" for _ in range(8 if k % 4 == 0 else r.choice([45, 90, 200]))]
        other = list(words)
        for at in [] if k % 4 == 0 else r.sample(range(2, len(words) - 2), max(1, edits * len(words) // 100)):
            other[at] = f"new{at}"
        rows += [" ".join(words), " ".join([*other, f"t{k}"]), " ".join(f"lone{r.randrange(10**9)}" for _ in range(60))]
    got = dict(simhash_dedup.similar_texts(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect())
    alike = [k for k in range(600) if len((a := shingles(rows[3 * k])) & (b := shingles(rows[3 * k + 1]))) >= 0.8 * len(a | b)]
    assert len(alike) > 100
    assert [k for k in range(600) if got[3 * k] == got[3 * k + 1]] == alike
    assert all(got[i] == i for i in range(2, 1800, 3))


def test_prefixes_of_similar_sets_meet_in_any_order():
    """The lemma of the second round: sets of 0.8 and more share a shingle of their prefixes, whatever is known to be frequent."""
    r = np.random.default_rng(6)
    for n in (1, 2, 4, 5, 9, 40, 200):
        for _ in range(60):
            both = np.unique(r.integers(0, 2**63, 2 * n, np.uint64))
            x, y = both[:n], np.sort(np.r_[both[: n - n // 9], both[n : n + n // 9]])
            frequent = r.choice(both, r.integers(0, len(both)), replace=False)
            places = np.argsort(frequent, kind="stable")
            a, b = (simhash_dedup.prefix(s, frequent[places], places, 0.8) for s in (x, y))
            assert len(np.intersect1d(a, b)) or len(np.intersect1d(x, y)) < 0.8 * len(np.union1d(x, y))


def test_no_similar_sets_are_told_apart_by_their_prefixes(spark):
    """The lemma of may_be_similar(): the shingles that two prefixes have in common bound the similarity from above."""
    r = np.random.default_rng(8)
    rows = []
    for n in (1, 2, 4, 5, 9, 40, 200):
        for _ in range(80):
            pool = np.unique(r.integers(0, 2**63, 2 * n + 2, np.uint64))
            x = np.sort(r.permutation(pool)[:n])
            y = np.sort(np.r_[r.permutation(x)[: n - r.integers(0, n // 5 + 1)], np.setdiff1d(pool, x)[: r.integers(0, n // 5 + 1)]])
            frequent = r.choice(pool, r.integers(0, len(pool)), replace=False)
            places = np.argsort(frequent, kind="stable")
            a, b = (simhash_dedup.prefix(s, frequent[places], places, 0.8) for s in (x, y))
            alike = len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y))
            rows.append((len(np.intersect1d(a, b)), len(x), len(y), bool(alike)))
    table = spark.createDataFrame(rows, "common long, size_u long, size_v long, alike boolean")
    may = simhash_dedup.may_be_similar(F.col("common"), F.col("size_u"), F.col("size_v"), 0.8)
    assert sum(r[3] for r in rows) > 100 and table.where("alike").where(~may).isEmpty()
    assert not table.where("size_u = 200 AND NOT alike").where(~may).isEmpty()


def test_texts_that_share_a_passage_alone_are_not_compared(spark, monkeypatch):
    """Passages of a few texts each meet in prefixes; the texts' sets are read for none of these pairs, but for a similar one."""
    r = random.Random(12)
    shared = [" ".join(f"p{k}w{i}" for i in range(12)) for k in range(30)]
    texts = [" ".join([*(f"t{n}w{i}" for i in range(40)), shared[n % 30], *(f"t{n}w{i}" for i in range(40, 90))]) for n in range(300)]
    words = texts[7].split()
    words[r.randrange(60, 80)] = "other"
    texts.append(" ".join(words))
    made = []
    plain = simhash_dedup.verified
    monkeypatch.setattr(simhash_dedup, "verified", lambda pairs, sets, similarity: made.append(pairs.count()) or plain(pairs, sets, similarity))
    got = dict(simhash_dedup.similar_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    assert {i: c for i, c in got.items() if i != c} == {300: 7}
    assert sum(made) < 10


def test_lists_of_two_parts_are_kept_whole_however_batches_cut_them(spark):
    """Rows of lists whose nodes are of different parts, with the part of the most nodes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    lists = {1: [1, 1, 1, 1, 2], 2: [1] * 9, 3: [5], 4: [7, 8, 8], 5: [9, 9, 9, 9, 9, 9, 9, 3]}
    nodes = [(10 * k + i, part, 0, int(k).to_bytes(8, "little")) for k, parts in lists.items() for i, part in enumerate(parts)]
    try:
        got = simhash_dedup.open_lists(spark.createDataFrame(nodes, "node long, part long, hood long, prefix binary")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = [(k, 10 * k + i, part, max(set(parts), key=parts.count)) for k, parts in lists.items() for i, part in enumerate(parts) if len(set(parts)) > 1]
    assert sorted((r.key, r.node, r.part, r.main) for r in got) == sorted(want)


def test_prefixes_are_not_kept_on_disk(spark, monkeypatch):
    """What near-duplicates checkpoint of unrelated texts is less than their prefixes, a fifth of their shingles, would take once."""
    from pathlib import Path

    r = random.Random(5)
    texts = [" ".join(f"w{r.randrange(10**9)}" for _ in range(1500)) for _ in range(300)]
    files = lambda: {f: f.stat().st_size for f in Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).rglob("part-*")}
    seen, plain = {}, simhash_dedup.shared_checkpoint

    def seeing(df):
        out = plain(df)
        seen.update(files())
        return out

    before = files()
    monkeypatch.setattr(simhash_dedup, "shared_checkpoint", seeing)
    got = dict(simhash_dedup.similar_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    assert all(i == c for i, c in got.items()) and len(got) == 300
    assert 0 < sum(size for f, size in seen.items() if f not in before) < 8 * 0.2 * 1500 * 300


def test_large_neighbourhoods_are_dealt_once(spark):
    """A neighbourhood of 600 nodes that meets 40 small ones and itself makes a few rows a node; all similar pairs are found."""
    r = np.random.default_rng(3)
    base = np.unique(r.integers(0, 2**62, 60).astype(np.uint64))
    rows = []
    for node in range(800):
        hashes = np.unique(np.r_[r.choice(base, 54 if node % 100 else 60, replace=False), r.integers(0, 2**62, 3).astype(np.uint64)])
        rows.append((node, node // 3, 0 if node < 600 else 1000 + (node - 600) // 5, hashes.tobytes()))
    nodes = spark.createDataFrame(rows, "node long, part long, hood long, hashes binary")
    met = [(0, 0), *((0, 1000 + k) for k in range(20)), *((1000 + k, 0) for k in range(20, 40))]
    dense = spark.createDataFrame(met, "a long, b long")
    assert simhash_dedup.dealt(dense, nodes).count() <= 3 * 800
    got = {(p.u, p.v) for p in simhash_dedup.met_in_blocks(dense, nodes, 0.8).collect()}
    sets = [set(np.frombuffer(x[3], np.uint64).tolist()) for x in rows]
    want = {(u, v) for u in range(600) for v in range(u + 1, 800) if u // 3 != v // 3 and len(sets[u] & sets[v]) >= 0.8 * len(sets[u] | sets[v])}
    assert got == want and len(want) > 100


def test_parts_of_a_neighbourhood_meet_all_that_pass(spark, monkeypatch):
    """However few nodes a task holds and a block has, the pairs are the same."""
    r = np.random.default_rng(4)
    base = np.arange(50, dtype=np.uint64)
    rows = [(node, node, node % 3, np.sort(r.choice(base, r.integers(38, 50), replace=False)).tobytes()) for node in range(90)]
    nodes = spark.createDataFrame(rows, "node long, part long, hood long, hashes binary")
    dense = spark.createDataFrame([(0, 0), (0, 1), (1, 2)], "a long, b long")
    whole = {tuple(p) for p in simhash_dedup.met_in_blocks(dense, nodes, 0.8).collect()}
    monkeypatch.setattr(simhash_dedup, "HELD", 8)
    monkeypatch.setattr(simhash_dedup, "BLOCK", 3)
    assert {tuple(p) for p in simhash_dedup.met_in_blocks(dense, nodes, 0.8).collect()} == whole
    sets = [set(np.frombuffer(x[3], np.uint64).tolist()) for x in rows]
    meet = {(0, 0), (0, 1), (1, 2)}
    assert whole == {(u, v) for u in range(90) for v in range(u + 1, 90) if tuple(sorted((u % 3, v % 3))) in meet and len(sets[u] & sets[v]) >= 0.8 * len(sets[u] | sets[v])}


def test_keys_grow_with_the_nodes():
    """Unrelated nodes share one in 64 of their keys at most; longer keys are the shorter ones with bits of one more byte."""
    most = {1: 0, 1 << 18: 0, (1 << 18) + 1: 1, 1 << 20: 2, 3_000_000: 4, 1 << 26: 8, 1 << 30: 8}
    assert {n: simhash_dedup.more_bits(n) for n in most} == most
    prints = np.random.default_rng(1).integers(0, 256, (50, simhash_dedup.WIDE)).astype(np.uint8)
    short, long = simhash_dedup.wide_keys(prints), simhash_dedup.wide_keys(prints, 5)
    assert (long >> 5 == short).all() and len(np.unique(long & 31)) == 32
    other = prints.copy()
    other[:, 17] ^= 255
    apart = simhash_dedup.wide_keys(prints, 8) != simhash_dedup.wide_keys(other, 8)
    assert apart[:, ::64].all() and (simhash_dedup.wide_keys(prints)[:, ::64] == simhash_dedup.wide_keys(other)[:, ::64]).all()


def test_copies_post_their_prefix_once(spark, monkeypatch):
    """A text that occurs in many rows and tasks is one node of its lists."""
    nodes = spark.createDataFrame([(k, k, k, 0, 100 + k) for k in range(3)], "node long, part long, size long, hood long, code long")
    rows = [(7, 100), (8, 100)] * 9 + [(7, 101)] * 2 + [(8, 102), (9, 102), (9, 102)]
    got = simhash_dedup.open_lists(nodes, spark.createDataFrame(rows, "key long, code long").repartition(3)).collect()
    assert sorted((r.key, r.node) for r in got) == [(7, 0), (7, 1), (8, 0), (8, 2)]
    monkeypatch.setattr(simhash_dedup, "CODES_HELD", 2)
    told, prefixes = set(), [np.array([7, 2**64 - 1], np.uint64), np.empty(0, np.uint64), np.array([9], np.uint64)]
    assert [x.to_pylist() for x in simhash_dedup.postings(told, [1, 2, 3], prefixes)] == [[7, -1, 9], [1, 1, 3]]
    assert [x.to_pylist() for x in simhash_dedup.postings(told, [1, 2, 3], prefixes)] == [[9], [3]]
    assert [x.to_pylist() for x in simhash_dedup.postings(told, [1, 2], prefixes[:2])] == [[], []]


def test_files_of_tables_that_are_no_longer_used_go(spark):
    """Shuffle files are deleted while the session goes on."""
    import time
    from pathlib import Path

    from tidemark.llm.common import freed, shared_checkpoint

    files = lambda: set(Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*.data"))
    before = files()
    rows = shared_checkpoint(spark.range(10_000).repartition(3))
    made = files() - before
    freed(spark)
    until = time.time() + 10
    while made & files() and time.time() < until:
        time.sleep(0.2)
    assert made and not made & files() and rows.count() == 10_000
