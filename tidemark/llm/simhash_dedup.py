"""SimHash near-duplicates by an inverted index over byte positions, with count filtering.

Fingerprints of 64 bits that differ in at most two bits share at least six of their eight positional
bytes, so of four fixed blocks of two bytes at least two agree. The index therefore keeps, for each
distinct fingerprint, a posting for each of the six pairs of blocks. Within a posting list a pair's
shared positional bytes are tallied; pairs with six or more are verified by their differing bits.

A posting list longer than `list_limit` is not paired. Its fingerprints are linked exactly, in linear
size, by another property: two fingerprints differ in at most two bits if and only if they have a
common neighbour, a value at most one bit away from both. Each emits its 65 neighbours and is linked
to the least fingerprint at each; those links are real ones and connect the same components.

similar_texts() finds texts of a given similarity: groups in the same manner, with wider fingerprints, and then all that these
left out, by prefixes of the texts' sets of shingles, in which no pair can be missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import freed, map_texts, maybe_among, shared_checkpoint, skew_join, tuned

#: Shingle length in words, seed of the hash, most differing bits, and longest posting list that is paired.
SHINGLE, SEED, BITS, LIST_LIMIT = 3, 42, 2, 64

#: For similar_texts(): shingle length in words, least similarity, bytes of a fingerprint (a multiple of eight),
#: least positional bytes that a pair shares, and distances of the second and third byte of a key from its first.
WIDE_SHINGLE, SIMILARITY, WIDE, LEAST_SHARED, SHAPES = 5, 0.8, 64, 8, ((1, 3), (11, 28), (6, 37))

#: Nodes up to which keys of three bytes do; beyond, keys also have bits of the byte at this distance from the first.
FEW_NODES, FOURTH = 1 << 18, 17

#: Most differing bits of a pair that is verified: of pairs of similarity 0.8 the 512 bits differ in 78 on average, with a
#: deviation of 8.1. Then nodes of a block, of the blocks that a task holds, about, and the share of two neighbourhoods' pairs
#: from which on they meet in blocks.
MOST_DIFFERENT, BLOCK, HELD, DENSE = 106, 256, 1024, 0.1

#: Bytes of shingle hashes of a block, about, and distinct shingles of two blocks up to which their sets are compared as bits.
BLOCK_BYTES, MOST_BITS = 1 << 24, 1 << 17

#: One text of so many tells which shingles are frequent, from this count on; so many of them are known to the workers at most.
#: They only order the shingles of a text, so the result doesn't depend on them.
TOLD_BY, FREQUENT, MOST_FREQUENT = 16, 3, 200_000

STIR = np.uint64(0x9E3779B97F4A7C15)

#: Texts of a task whose copies are told while their prefixes are posted; copies beyond are told behind the shuffle.
CODES_HELD = 100_000

#: Classes of texts from which on disk is freed between the steps of similar_texts().
MANY = 20_000

#: Shingles of a text that are hashed at once, so that memory doesn't grow with the text.
PART = 4096

BLOCK_PAIRS = [(a, b) for a in range(4) for b in range(a + 1, 4)]

#: Rounds of the component search; each at least halves what is left of a path, so none needs more.
ROUNDS = 100

#: Links of a task in the component search.
EDGES_A_TASK = 200_000


def simhash(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a text as a signed 64-bit number; bit i is set in over half the hashes."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, PART):
        part = words[lo : lo + PART + shingle - 1]
        shingles = zip(*(part[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
        rows = np.array([digest(join(x), seed) for x in shingles], np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """One row for each row of `docs`: its id and `fp` (long). Null and empty texts have fingerprint 0."""
    return map_texts(docs, [id_col], text_col, [T.StructField("fp", T.LongType())], lambda: lambda texts: [pa.array([simhash(t or b"", shingle, seed) for t in texts], pa.int64())])


def links(distinct: DataFrame, bits: int = BITS, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Links (u, v), u < v, that connect the distinct fingerprints `fp` within `bits` (2 at most)
    differing bits: all pairs of short posting lists, a connected set of them for long ones."""
    if not 0 <= bits <= 2:
        raise ValueError("the index guarantees matches up to two differing bits")
    block = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF) for i in range(4)]
    keys = [F.lit(n << 32).bitwiseOR(F.shiftleft(block[a], 16)).bitwiseOR(block[b]) for n, (a, b) in enumerate(BLOCK_PAIRS)]
    postings = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    lists = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    listed = postings.join(lists, "key")
    short = listed.where(F.col("n") <= list_limit)
    differ = F.col("u").bitwiseXOR(F.col("v"))
    same = [F.shiftrightunsigned(differ, 8 * i).bitwiseAND(0xFF) == 0 for i in range(8)]
    tally = sum((s.cast("int") for s in same[1:]), same[0].cast("int"))
    # A pair meets in several lists; the first one counts.
    first = F.coalesce(*(F.when(same[2 * a] & same[2 * a + 1] & same[2 * b] & same[2 * b + 1], F.lit(n)) for n, (a, b) in enumerate(BLOCK_PAIRS)))
    pairs = (
        short.select("key", F.col("fp").alias("u"))
        .join(short.select("key", F.col("fp").alias("v")), "key")
        .where(F.col("u") < F.col("v"))
        .where((tally >= 8 - bits) & (first == F.shiftrightunsigned("key", 32)) & (F.bit_count(differ) <= bits))
        .select("u", "v")
    )
    if bits < 2:
        # Neighbours one bit away (bits = 1) are met by pairing with the values themselves.
        reach = F.when(F.lit(bits) == 1, F.array("fp", *(F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)))).otherwise(F.array("fp"))
        members = listed.where(F.col("n") > list_limit).select("fp").distinct()
        near = members.select(F.col("fp").alias("v"), F.explode(reach).alias("u")).where("u < v")
        return pairs.union(near.join(members.select(F.col("fp").alias("u")), "u", "left_semi").select("u", "v"))
    neighbours = F.array("fp", *(F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)))
    members = listed.where(F.col("n") > list_limit).select("fp").distinct()
    near = members.select("fp", F.explode(neighbours).alias("at"))
    hubs = near.groupBy("at").agg(F.min("fp").alias("u"), F.count("*").alias("n")).where("n > 1").select("at", "u")
    stars = near.join(hubs, "at").where("u < fp").select("u", F.col("fp").alias("v")).distinct()
    return pairs.union(stars)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that links (u, v) reach from each node that has one.

    Alternates two steps until nothing changes: every node's larger neighbours, then its smaller ones,
    are linked to the least of its neighbours and itself. Each round is written to the checkpoint folder.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))

    def state(pairs: DataFrame) -> Row:
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = shared_checkpoint(edges.where("u <> v").select("u", "v").distinct())
    now = state(edges)
    for _ in range(ROUNDS):
        # Few links need few tasks, whatever the session's number of shuffle partitions: each task leaves files in each shuffle.
        fit = lambda df, parts=-(-max(1, now[0]) // EDGES_A_TASK): df.coalesce(parts)
        edges = fit(edges)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = fit(skew_join(both, fit(least(both)), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")).distinct()
        down = fit(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        mins = fit(least(down))
        small = down.join(mins, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(mins.select("u", F.col("m").alias("v")))
        edges = shared_checkpoint(fit(fit(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))).distinct()))
        before, now = now, state(edges)
        if before == now:
            break
    else:
        raise RuntimeError(f"components not found in {ROUNDS} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED, bits: int = BITS, list_limit: int = LIST_LIMIT) -> DataFrame:
    """One row for each row of `docs`: its id, `fp` (long) and `component_id`, the least id that links
    reach, its own included.

    Null, empty and blank texts have fingerprint 0 and are linked to each other and to what is near 0.
    Rows of one text or one id stay, each with its component. A null id has no part in the least id; a
    component of null ids alone has a null id. An empty table gives an empty result. Other columns are
    not read.
    """
    prints = shared_checkpoint(fingerprints(docs, id_col, text_col, shingle, seed))
    distinct = prints.groupBy("fp").agg(F.min(id_col).alias("least_id"))
    roots = components(links(distinct.select("fp"), bits, list_limit))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "component_id")
    return skew_join(prints, classes, "fp").select(id_col, "fp", "component_id")


def shingle_hashes(text: bytes | None, shingle: int) -> np.ndarray:
    """The distinct hashes of a text's shingles of words, sorted; of fewer words, of all of them; none of a text without words."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < shingle:
        words = [b" ".join(words)] * shingle
    codes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out = np.zeros(len(codes) - shingle + 1, np.uint64)
    for i in range(shingle):
        out = (out ^ codes[i : i + len(out)]) * STIR
        out ^= out >> np.uint64(29)
    return np.unique(out)


def wide_print(hashes: np.ndarray) -> bytes:
    """The SimHash of WIDE bytes of distinct shingle hashes; each has WIDE / 8 numbers by splitmix steps."""
    ones = np.zeros(8 * WIDE, np.int64)
    seeds = np.arange(1, WIDE // 8 + 1, dtype=np.uint64) * STIR
    for lo in range(0, len(hashes), 255):
        z = hashes[lo : lo + 255, None] + seeds
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
        # At most 255 rows, so bytes hold their sums.
        ones += np.add.reduce(np.unpackbits(z.view(np.uint8), axis=1), axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes)).tobytes()


def more_bits(nodes: int) -> int:
    """Bits of a fourth byte that the keys of so many nodes have, 8 at most: unrelated nodes share a key with one in 64 of
    their keys at most, so the lists grow as the nodes do and not with their square."""
    return min(8, (max(1, -(-nodes // FEW_NODES)) - 1).bit_length())


def wide_keys(prints: np.ndarray, more: int = 0) -> np.ndarray:
    """The keys of fingerprints (rows of WIDE bytes): for each shape and each first position, the bytes at three positions, and
    `more` bits of a fourth one."""
    at = np.arange(WIDE)
    x = prints.astype(np.int64)
    rest = x[:, (at + FOURTH) % WIDE] >> (8 - more)
    triples = [(x << 16) | (x[:, (at + a) % WIDE] << 8) | x[:, (at + b) % WIDE] | ((k * WIDE + at) << 24) for k, (a, b) in enumerate(SHAPES)]
    return np.hstack([(t << more) | rest for t in triples])


def list_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, hub, node) of all nodes of lists of two or more, the hub among them; batches are sorted by key and node.
    Holds a batch and one row more."""
    key, hub, told = None, None, True
    for batch in batches:
        keys, nodes = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        if not len(keys):
            continue
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        hubs = np.repeat(nodes[starts], sizes)
        keep = np.repeat(sizes > 1, sizes)
        if keys[0] == key:
            # The first list goes on from the batch before, whose hub may be alone so far.
            hubs[: sizes[0]], keep[: sizes[0]] = hub, True
            if not told:
                yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([hub]), pa.array([hub])], names=["key", "hub", "node"])
        told = bool(keep[-1])
        key, hub = keys[-1], hubs[-1]
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (keys, hubs, nodes)], names=["key", "hub", "node"])


def listed(classes: DataFrame) -> DataFrame:
    """The posting lists of `fp` with two nodes or more, as (key, hub, node); the hub is a list's least node."""
    more = more_bits(classes.count())

    def post(batches):
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.slice(lo, 512)
                keys = wide_keys(np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(-1, WIDE), more)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(np.asarray(part.column(0)), keys.shape[1]))], names=["key", "node"])

    postings = classes.select("node", "fp").mapInArrow(post, "key long, node long")
    return postings.repartition("key").sortWithinPartitions("key", "node").mapInArrow(list_rows, "key long, hub long, node long")


def centred(lists: DataFrame) -> DataFrame:
    """`lists` with the hub of each list anew, as (key, hub, weight, node): the node that meets the most others over all of its
    lists, its `weight`. In a group of copies of one text that is the text itself, or what is nearest to it, so that most of the
    group is similar to its hub though two copies need not be similar to each other. Of equals the least node."""
    sized = lists.select("key", "node", F.count("*").over(Window.partitionBy("key")).alias("n"))
    weighed = sized.select("key", "node", F.sum("n").over(Window.partitionBy("node")).alias("weight"))
    top = F.max(F.struct("weight", (-F.col("node")).alias("node"))).over(Window.partitionBy("key"))
    return weighed.withColumn("top", top).select("key", (-F.col("top.node")).alias("hub"), "top.weight", "node")


def frequent_shingles(bodies: DataFrame, shingle: int) -> np.ndarray:
    """Hashes of frequent shingles, the most frequent last, as one of TOLD_BY texts has them. bodies: text_hash, __body."""

    def hashed(batches):
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(text.as_py(), shingle).view(np.int64))], names=["h"])

    some = bodies.where(F.pmod("text_hash", F.lit(TOLD_BY)) == 0).select(F.col("__body").cast("binary"))
    counts = some.mapInArrow(hashed, "h long").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= FREQUENT)
    found = counts.orderBy(F.desc("n"), "h").limit(MOST_FREQUENT).select("h").toPandas()["h"]
    return found.to_numpy(np.int64).view(np.uint64)[::-1].copy()


def prefix(hashes: np.ndarray, by_hash: np.ndarray, places: np.ndarray, similarity: float) -> np.ndarray:
    """The shingles of a set by which it meets every set of this Jaccard similarity: in one order of all shingles, of n the first
    n - ceil(similarity * n) + 1. Two such sets have ceil(similarity * n) in common at least, for the n of either, so the rest of
    neither can hold all of them. Frequent shingles come last; by_hash has their hashes sorted, `places` their places."""
    if not len(hashes):
        return hashes
    most = len(hashes) - int(np.ceil(similarity * len(hashes) - 1e-9)) + 1
    at = np.zeros(len(hashes), np.int64)
    if len(by_hash):
        near = np.minimum(np.searchsorted(by_hash, hashes), len(by_hash) - 1)
        at = np.where(by_hash[near] == hashes, places[near] + 1, 0)
    # hashes are sorted, so equals of a place come in the order of their hashes.
    return hashes[np.argsort(at, kind="stable")[:most]]


def may_be_similar(common: Column, size_u: Column, size_v: Column, similarity: float) -> Column:
    """Whether two sets of these sizes whose prefixes have `common` shingles in common can have this Jaccard similarity; never
    false of two that have it. Of the prefixes that which ends first in the order of all shingles has all common shingles up
    to its end in the other one too, so the sets have no more in common than `common` and what is left of the one behind its prefix."""
    larger = F.greatest(size_u, size_v)
    fits = F.least(size_u, size_v) >= similarity * larger - 1e-9
    return fits & (common + F.ceil(similarity * larger - 1e-9) - 1 >= similarity / (1 + similarity) * (size_u + size_v) - 1e-9)


def unlike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two columns of numbers, sorted, without those that equal the row before."""
    last = None
    for batch in batches:
        if len(batch):
            x, y = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            keep = np.r_[(x[0], y[0]) != last, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
            last = (x[-1], y[-1])
            yield batch.filter(pa.array(keep))


def postings(told: set[int], codes: list[int], prefixes: list[np.ndarray]) -> list[pa.Array]:
    """Key and code of each shingle of these texts' prefixes, but for texts of codes that are `told`, which gets the new ones."""
    new = []
    for i, code in enumerate(codes):
        if code not in told:
            new.append(i)
            if len(told) < CODES_HELD:
                told.add(code)
    keys = np.concatenate([np.empty(0, np.int64), *(prefixes[i].view(np.int64) for i in new)])
    return [pa.array(keys), pa.array(np.repeat(np.array([codes[i] for i in new], np.int64), [len(prefixes[i]) for i in new]))]


def open_lists(nodes: DataFrame, posted: DataFrame | None = None) -> DataFrame:
    """The lists of prefixes in which two parts or more meet, as (key, node, part, hood, main); `main` is the part of the most nodes.
    nodes: node, part, hood, and their prefix; or else code, by which `posted` has (key, code), copies as often as they occur.

    What is shuffled of each shingle is its hash and a code alone; of lists of two codes or more, few, parts are told then."""

    def post(batches):
        told = set()
        for batch in batches:
            made = postings(told, batch.column(0).to_pylist(), [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(made, names=["key", "code"])

    if posted is None:
        nodes = nodes.withColumn("code", F.col("node"))
        posted = nodes.select("code", "prefix").mapInArrow(post, "key long, code long")
    met = posted.repartition("key").sortWithinPartitions("key", "code").mapInArrow(lambda batches: list_rows(unlike(batches)), "key long, hub long, code long")
    kept = met.select("key", "code").join(nodes.select("code", "node", "part", "hood"), "code")
    of_key, of_part = Window.partitionBy("key"), Window.partitionBy("key", "part")
    sized = kept.withColumn("n", F.count("*").over(of_part))
    told = sized.withColumns({"top": F.max(F.struct("n", "part")).over(of_key), "several": F.min("part").over(of_key) < F.max("part").over(of_key)})
    return told.where("several").select("key", "node", "part", "hood", F.col("top.part").alias("main"))


def likely(x: np.ndarray, y: np.ndarray, least: int) -> np.ndarray:
    """Which fingerprints of x and y (rows of WIDE bytes, broadcast) share `least` positional bytes and differ in few bits."""
    return ((x == y).sum(axis=-1) >= least) & (np.bitwise_count((x ^ y).view(np.uint64)).sum(axis=-1) <= MOST_DIFFERENT)


def prints_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDE)


def similar_pairs(x: list[np.ndarray], y: list[np.ndarray], at: np.ndarray, to: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs (x[at], y[to]) of sets of sorted hashes have at least this Jaccard similarity."""
    sizes_x, sizes_y = (np.array([len(h) for h in sets]) for sets in (x, y))
    common = np.zeros(len(at), np.int64)
    words, where = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    if len(words) <= MOST_BITS:
        width = -(-max(1, len(words)) // 64)
        bits = np.zeros((len(x) + len(y), width * 64), bool)
        bits[np.repeat(np.arange(len(x) + len(y)), np.r_[sizes_x, sizes_y]), where] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        for i in np.unique(at):
            mine = np.flatnonzero(at == i)
            common[mine] = np.bitwise_count(packed[i] & packed[len(x) + to[mine]]).sum(axis=1)
    else:
        for k, (i, j) in enumerate(zip(at, to, strict=True)):
            common[k] = len(np.intersect1d(x[i], y[j], assume_unique=True))
    return common >= similarity * (sizes_x[at] + sizes_y[to] - common)


def sizes_fit(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of these sizes can have this Jaccard similarity."""
    return np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-9


def dealt(dense: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows by which neighbourhoods meet in met_in_blocks(), as (a, i, side, node, part, hashes). Of two neighbourhoods the
    larger is `a`, of equals the least; its nodes are dealt to parts `i` once, whatever number of others they meet. The
    other's nodes go to each part."""
    parts = F.greatest(F.lit(1), F.ceil(F.count("*") / HELD), F.ceil(F.sum(F.length("hashes")) / BLOCK_BYTES)).cast("int")
    sizes = nodes.groupBy("hood").agg(parts.alias("k"), F.count("*").alias("n"))
    of = lambda name: sizes.select(F.col("hood").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("k", "n")))
    larger = F.when(F.col("n_a") >= F.col("n_b"), F.struct(F.col("a"), F.col("b"), F.col("k_a").alias("k"))).otherwise(F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("k_b").alias("k")))
    ordered = dense.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(of("a"), "a").join(of("b"), "b").select(larger.alias("x")).select("x.*")
    kept = ["node", "part", "hashes"]
    left = nodes.join(ordered.select("a", "k").distinct(), F.col("hood") == F.col("a")).select("a", F.pmod(F.xxhash64("node"), F.col("k")).cast("int").alias("i"), F.lit(0).alias("side"), *kept)
    right = nodes.join(ordered, F.col("hood") == F.col("b")).select("a", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("i"), F.lit(1).alias("side"), *kept)
    return left.union(right)


def met_in_blocks(dense: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v), u < v, of different parts and of at least this similarity between the neighbourhoods `a` and `b` of each
    row of `dense` (a may be b). nodes: node, hashes, part, hood.

    A task holds a part of a neighbourhood, of about HELD nodes and BLOCK_BYTES, in blocks of BLOCK, and the nodes of all
    neighbourhoods that it meets pass by in such blocks. Sets of two blocks are compared as arrays where their sizes fit. So n
    nodes make n * n / HELD rows, and similar pairs alone leave a task.
    """

    def compare(batches):
        def pairs(x, y):
            (u, p), (v, q) = ([np.array(c, np.int64) for c in side[:2]] for side in (x, y))
            n, m = (np.array([len(h) for h in side[2]]) for side in (x, y))
            at, to = np.nonzero(sizes_fit(n[:, None], m[None, :], similarity) & (p[:, None] != q[None, :]))
            if len(at):
                fit = similar_pairs(x[2], y[2], at, to, similarity)
                at, to = at[fit], to[fit]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u[at], v[to])), pa.array(np.maximum(u[at], v[to]))], names=["u", "v"])

        full = lambda block: len(block[0]) >= BLOCK or 8 * sum(map(len, block[2])) >= BLOCK_BYTES
        now, held, passing = None, [], ([], [], [])
        for batch in batches:
            for a, i, side, node, part, hashes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (a, i) or passing[0] and full(passing):
                    for block in held if passing[0] else ():
                        yield from pairs(block, passing)
                    now, held, passing = (a, i), held if now == (a, i) else [], ([], [], [])
                if side == 0 and (not held or full(held[-1])):
                    held.append(([], [], []))
                for column, value in zip(passing if side else held[-1], (node, part, np.frombuffer(hashes, np.uint64)), strict=True):
                    column.append(value)
        for block in held if passing[0] else ():
            yield from pairs(block, passing)

    rows = dealt(dense, nodes).repartition("a", "i").sortWithinPartitions("a", "i", "side")
    return rows.mapInArrow(compare, "u long, v long").distinct()


def tallied(pairs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """The pairs (u, v) whose fingerprints share `least` positional bytes or more, and differ in few bits."""

    def count(batches):
        for batch in batches:
            yield batch.select([0, 1]).filter(pa.array(likely(prints_of(batch.column(2)), prints_of(batch.column(3)), least)))

    of = lambda name: classes.select(F.col("node").alias(name), F.col("fp").alias(f"fp_{name}"))
    met = skew_join(pairs.join(of("v"), "v"), of("u"), "u", keys=pairs.select("u"))
    return met.select("u", "v", "fp_u", "fp_v").mapInArrow(count, "u long, v long")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose sets of shingle hashes, (node, hashes), have at least this Jaccard similarity."""

    def compare(batches):
        held, x = None, None
        for batch in batches:
            keep = []
            for u, a, b in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)), strict=True):
                if u != held:
                    held, x = u, np.frombuffer(a, np.uint64)
                y = np.frombuffer(b, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= similarity * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    of = lambda name: sets.select(F.col("node").alias(name), F.col("hashes").alias(f"set_{name}"))
    met = skew_join(pairs.join(of("v"), "v"), of("u"), "u", keys=pairs.select("u"))
    return met.select("u", "v", "set_u", "set_v").mapInArrow(compare, "u long, v long")


def similar_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = WIDE_SHINGLE,
    similarity: float = SIMILARITY,
    least_shared: int = LEAST_SHARED,
) -> DataFrame:
    """One row for each row of `docs`: its id and `component_id`, the least id that links reach, its own included.

    Two texts are linked if their sets of `shingle`-word shingles have a Jaccard similarity of `similarity` or more, all of
    them. The work has two rounds. The first finds groups cheaply: a SimHash of WIDE bytes over those sets, an inverted index
    over triples of its byte positions, and each node with the heaviest hub of its lists, which centred() finds, verified on
    whole texts where `least_shared` bytes agree and few bits differ. It is likely, not certain, that texts meet there.

    The second round makes it certain: prefix() has the shingles by which a text meets every text of that similarity, so
    two such texts share a list of open_lists() or are in one component by then. All pairs of different components in a list are
    verified where their sizes fit. Nodes that meet in many lists, as pages of one template do which are just not
    similar enough, are compared in blocks, of which similar pairs alone are written. So no link between components
    is lost, while a large group of near copies costs few pairs a text. Texts of the same words in lower case are one
    class from the start, so copies cost a row each.

    Null, empty and blank texts are one class. Very long texts count whole. Rows of one text or id stay, each with
    its component; ties need no order. A null id has no part in the least id. An empty table gives an
    empty result. Other columns are not read.
    """
    tuned(docs.sparkSession)
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bodies = docs.select(F.col(id_col), body.alias("__body"), F.xxhash64(body).alias("text_hash"))
    binary, long = (lambda *names, kind=kind: [T.StructField(c, kind) for c in names] for kind in (T.BinaryType(), T.LongType()))
    frequent = frequent_shingles(bodies.select("text_hash", "__body"), shingle)
    places = np.argsort(frequent, kind="stable")
    order = docs.sparkSession.sparkContext.broadcast((frequent[places], places))

    def digest_of(text):
        return xxhash.xxh3_128_digest(b" ".join((text or b"").lower().split()))

    code_of = lambda digest: int.from_bytes(digest[:8], "little", signed=True)

    def printed(texts):
        digests, sets = [digest_of(t) for t in texts], [shingle_hashes(t, shingle) for t in texts]
        numbers = ([code_of(d) for d in digests], [len(h) for h in sets])
        return [pa.array(digests, pa.binary()), pa.array([wide_print(h) for h in sets], pa.binary()), *(pa.array(x, pa.int64()) for x in numbers)]

    def posting():
        (by_hash, places), told = order.value, set()
        return lambda texts: postings(told, [code_of(digest_of(t)) for t in texts], [prefix(shingle_hashes(t, shingle), by_hash, places, similarity) for t in texts])

    prints = shared_checkpoint(map_texts(bodies, [id_col, "text_hash"], "__body", [*binary("digest", "fp"), *long("code", "size")], lambda: printed))
    grouped = prints.groupBy("digest").agg(F.min(id_col).alias("least_id"), *(F.min_by(c, "text_hash").alias(c) for c in ("fp", "code", "size")), F.min("text_hash").alias("text_hash"))
    classes = shared_checkpoint(grouped.withColumn("node", F.monotonically_increasing_id()))
    free = (lambda: freed(docs.sparkSession)) if classes.count() >= MANY else (lambda: None)
    lists = shared_checkpoint(centred(shared_checkpoint(listed(classes))))
    free()

    def sets_of(nodes: DataFrame) -> DataFrame:
        """The sets of shingle hashes of some nodes, from their whole texts."""
        wanted = nodes.join(classes, "node").select("node", "text_hash")
        few = maybe_among(bodies.select("text_hash", "__body"), F.col("text_hash"), wanted.select("text_hash")).where("__maybe")
        texts = few.groupBy("text_hash").agg(F.first("__body").alias("__body")).join(wanted, "text_hash")
        hashed = lambda: lambda texts: [pa.array([shingle_hashes(t, shingle).tobytes() for t in texts], pa.binary())]
        return shared_checkpoint(map_texts(texts, ["node"], "__body", binary("hashes"), hashed))

    def linked(pairs: DataFrame) -> DataFrame:
        return shared_checkpoint(verified(pairs, sets_of(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()), similarity))

    heaviest = F.max_by("hub", F.struct("weight", (-F.col("hub")).alias("hub")))
    tried = shared_checkpoint(lists.where("hub <> node").groupBy(F.col("node").alias("v")).agg(heaviest.alias("u")).select("u", "v"))
    links_ = linked(shared_checkpoint(tallied(tried, classes, least_shared)))
    roots = components(links_)
    # Neighbourhoods: nodes of one heaviest hub. Where two of them meet in many lists, pairs are found in blocks.
    hoods = lists.groupBy("node").agg(heaviest.alias("hood"))
    sorted_in = classes.select("node", "code", "size").join(roots.withColumnRenamed("root", "part"), "node", "left").join(hoods, "node", "left")
    nodes = shared_checkpoint(sorted_in.select("node", "code", "size", *(F.coalesce(c, "node").alias(c) for c in ("part", "hood"))))
    free()
    # Prefixes are made from the texts where they are posted, since they are a fifth of all shingles and not kept.
    posted = map_texts(bodies, [], "__body", long("key", "code"), posting)
    open_ = shared_checkpoint(open_lists(nodes, posted))
    free()
    if not open_.isEmpty():
        sizes = nodes.groupBy("hood").agg(F.count("*").alias("n"))
        per_list = open_.groupBy("key", "hood").agg(F.count("*").alias("n"))
        combos = shared_checkpoint(
            per_list.select("key", F.col("hood").alias("a"), F.col("n").alias("n_a")).join(per_list.select("key", F.col("hood").alias("b"), F.col("n").alias("n_b")), "key").where("a <= b")
        )
        of = lambda name: sizes.select(F.col("hood").alias(name), F.col("n").alias(f"n_{name}"))
        meetings = combos.groupBy("a", "b").agg(F.sum(F.col("n_a") * F.col("n_b")).alias("meetings")).join(of("a"), "a").join(of("b"), "b")
        dense = shared_checkpoint(meetings.where((F.col("meetings") >= DENSE * F.col("n_a") * F.col("n_b")) & (F.col("n_a") * F.col("n_b") >= BLOCK)).select("a", "b", "n_a", "n_b"))
        few = combos.select("key", "a", "b").join(dense.select("a", "b"), ["a", "b"], "left_anti")
        both = few.select("a", "b", "key").union(few.where("a <> b").select(F.col("b"), F.col("a"), "key"))
        # In a list the main component's nodes aren't paired with each other, but all others with every node of another part, each
        # pair once. So a pair's rows are the shingles that its prefixes have in common.
        other = open_.where("part <> main").select("key", F.col("hood").alias("a"), F.col("node").alias("u"), F.col("part").alias("u_part"))
        every = open_.select("key", F.col("hood").alias("b"), F.col("node").alias("v"), "part", "main")
        crossing = other.join(both, ["key", "a"]).join(every, ["key", "b"]).where("u_part <> part AND (part = main OR u < v)")
        met = crossing.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.count("*").alias("common"))
        size = lambda name: nodes.select(F.col("node").alias(name), F.col("size").alias(f"size_{name}"))
        fitting = may_be_similar(F.col("common"), F.col("size_u"), F.col("size_v"), similarity)
        last = met.join(size("u"), "u").join(size("v"), "v").where(fitting).select("u", "v")
        last = shared_checkpoint(last)
        free()
        found = linked(last)
        free()
        if not dense.isEmpty():
            # Those that share no list with another part have nothing to find.
            theirs = open_.select("node", "part", "hood").distinct().join(dense.select(F.explode(F.array("a", "b")).alias("hood")).distinct(), "hood", "left_semi")
            theirs = shared_checkpoint(theirs.join(sets_of(theirs.select("node")), "node").select("node", "hashes", "part", "hood"))
            found = found.union(shared_checkpoint(met_in_blocks(dense, theirs, similarity)))
        roots = roots if found.isEmpty() else components(links_.union(found))
    rooted = classes.select("digest", "least_id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return skew_join(prints.select(id_col, "digest"), rooted.join(named, "root").select("digest", "component_id"), "digest").select(id_col, "component_id")
