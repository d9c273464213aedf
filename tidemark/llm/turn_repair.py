"""Repair of a conversation's structure: the cheapest edits that make its roles alternate, with an audit of them.

Turns are aligned to strings of the grammar `(s?(ua)+)?` by Wagner-Fischer tables, one for each feasible length: an
alternating string of a length is a single target. The cheapest cost so far, the incumbent, leaves out lengths
that can't reach it and narrows each table to Ukkonen's band. Tables hold the costs of what is left, so a walk from their
start that takes the least letter among the cheapest edits backtraces the least audit of a length; audits of equal cost
are compared over lengths.

A conversation may be long, so turns are aligned in chunks. A chunk's result tells, for each state of the grammar before it
and behind it, the cost and the audit; such results compose, some hundred at a time, over as many levels as the longest
conversation needs. Only the digest of a repaired conversation takes its turns one after another, as sha256 has to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ranked, shared_checkpoint

#: Costs of edits; what a truncated turn costs that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: Turns of a chunk, results that are composed at once, and chunk patterns that a worker remembers.
CHUNK, AT_ONCE, REMEMBERED = 16, 256, 50_000

#: States of the grammar: nothing so far, behind the system turn, behind a user turn, behind an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)

#: Cost and audit of one way.
Way = tuple[int, str]

SPACE = " \t\n\x0b\f\r"


def damaged(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, role and text of the turns behind the damage that crc32 of `conv:turn` modulo 20 decides: 0 drops a row, 1
    empties its text, 2 takes its end marks away, 3 doubles it, 4 makes it a user's. Null roles and texts are one space, in
    the hashed string null ids and turns as well."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank(conv_col), F.lit(":"), blank(turn_col)).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank(text_col), "[.!?]", "")).otherwise(blank(text_col))
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.when(kind == 4, "user").otherwise(blank(role_col)).alias("role"), text.alias("text"), kind.alias("kind")
    )
    return rows.where("kind <> 0").withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("kind", "copy")


def targets(first: str, length: int) -> str:
    """The alternating string of a length that begins with `first`: u, a or s (then u, a, u and so on)."""
    return ("s" + "ua" * length)[:length] if first == "s" else ("ua" * length if first == "u" else "au" * length)[:length]


def align(codes: str, target: str, most: float) -> Way | None:
    """The cheapest way to make turns (s, u, a, x; capitals: truncated; d: must go) have the target's roles, ties to the least
    audit; None if it costs more than `most`."""
    n, m = len(codes), len(target)
    gone = [0] * (n + 1)  # turns from here on that must go
    for i in range(n - 1, -1, -1):
        gone[i] = gone[i + 1] + (codes[i] == "d")

    def least(rows: int, must: int, columns: int) -> int:
        """No way over so many rows and columns of the table costs less."""
        free = rows - must
        return DELETE * must + (INSERT * (columns - free) if columns > free else DELETE * (free - columns))

    if least(n, gone[0], m) > most:
        return None
    costs: list[dict[int, int]] = [{} for _ in range(n + 1)]
    for i in range(n, -1, -1):
        here, below = costs[i], costs[i + 1] if i < n else {}
        code = codes[i] if i < n else ""
        role, extra = code.lower(), TRUNCATED if code.isupper() else 0
        for j in range(m, -1, -1):
            # The band: what is before a cell and behind it can't cost more than the incumbent.
            if least(i, gone[0] - gone[i], j) + least(n - i, gone[i], m - j) > most:
                continue
            best = 0 if i == n and j == m else None
            ways = []
            if i < n and j in below:
                ways.append(DELETE + below[j])
            if j < m:
                if target[j] != "s" and j + 1 in here:
                    ways.append(INSERT + here[j + 1])
                if i < n and code != "d" and j + 1 in below and (role == target[j] or target[j] != "s"):
                    ways.append((0 if role == target[j] else REROLE) + extra + below[j + 1])
            if ways:
                best = min(ways)
            if best is not None:
                here[j] = best
    if 0 not in costs[0] or costs[0][0] > most:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        left = costs[i][j]
        code = codes[i] if i < n else ""
        if i < n and costs[i + 1].get(j, left) + DELETE == left:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and costs[i].get(j + 1, left) + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if code.lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return costs[0][0], "".join(audit)


def best_of(codes: str, first: str, lengths: range) -> Way | None:
    """The cheapest way over all feasible targets of these lengths; the likeliest lengths come first and give the incumbent."""
    free = sum(c != "d" for c in codes)
    best: Way | None = None
    for length in sorted(lengths, key=lambda x: abs(x - free)):
        found = align(codes, targets(first, length), float("inf") if best is None else best[0])
        if found is not None and (best is None or found < best):
            best = found
    return best


def transfer(codes: str) -> list[Way | None]:
    """For each state before the chunk and each behind it, four times four, the cheapest way; None if there is none."""
    # Longer targets than twice the turns and two only add pairs of insertions.
    top = 2 * len(codes) + 3
    none, odd, even = (best_of(codes, "u", x) for x in (range(1), range(1, top, 2), range(2, top, 2)))
    a_even, a_odd = best_of(codes, "a", range(0, top, 2)), best_of(codes, "a", range(1, top, 2))
    alone, s_odd, s_even = (best_of(codes, "s", x) for x in (range(1, 2), range(2, top, 2), range(3, top, 2)))
    cheapest = lambda *ways: min((w for w in ways if w is not None), default=None)
    out: list[Way | None] = [None] * 16
    out[0:4] = none, alone, cheapest(odd, s_odd), cheapest(even, s_even)
    out[5:8] = none, odd, even
    out[10:12] = a_even, a_odd
    out[14:16] = odd, cheapest(none, even)
    return out


def composed(a: list[Way | None], b: list[Way | None]) -> list[Way | None]:
    """The transfer of one chunk and then another."""
    out: list[Way | None] = [None] * 16
    for i in range(4):
        for j in range(4):
            ways = [(x[0] + y[0], x[1], y[1]) for k in range(4) if (x := a[4 * i + k]) is not None and (y := b[4 * k + j]) is not None]
            cost = min((w[0] for w in ways), default=None)
            if cost is not None:
                out[4 * i + j] = cost, min(x + y for c, x, y in ways if c == cost)
    return out


def illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


RESULT = "chunk long, illegal long, ends string, costs array<int>, audits array<string>"


def results(convs: pa.Array, chunks: list[int], wrong: list[int], ends: list[str], ways: list[list[Way | None]]) -> pa.RecordBatch:
    costs = pa.array([[w and w[0] for w in x] for x in ways], pa.list_(pa.int32()))
    audits = pa.array([[w and w[1] for w in x] for x in ways], pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays([convs, pa.array(chunks, pa.int64()), pa.array(wrong, pa.int64()), pa.array(ends, pa.string()), costs, audits], names=["conv", "chunk", "illegal", "ends", "costs", "audits"])


def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The result of each chunk (conv, chunk, codes, initials)."""
    known: dict[str, list[Way | None]] = {}
    for batch in batches:
        ways = []
        for codes in batch.column(2).to_pylist():
            if codes not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[codes] = transfer(codes)
            ways.append(known[codes])
        initials = batch.column(3).to_pylist()
        yield results(batch.column(0), batch.column(1).to_pylist(), list(map(illegal, initials)), [x[0] + x[-1] for x in initials], ways)


def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The result of each list of results (conv, chunk, parts)."""
    for batch in batches:
        wrong, ends, ways = [], [], []
        for parts in batch.column(2).to_pylist():
            total, first, last, way = parts[0]["illegal"], parts[0]["ends"][0], parts[0]["ends"][1], None
            for k, p in enumerate(parts):
                mine = [None if c is None else (c, a) for c, a in zip(p["costs"], p["audits"], strict=True)]
                if k:
                    total += p["illegal"] + illegal(last + p["ends"][0])
                    last = p["ends"][1]
                way = mine if way is None else composed(way, mine)
            wrong.append(total)
            ends.append(first + last)
            ways.append(way)
        yield results(batch.column(0), batch.column(1).to_pylist(), wrong, ends, ways)


def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each repaired conversation. Rows (part, place, audit, role, text) are sorted: a conversation's audit, then its
    turns; they are hashed as they come, so memory is that of a batch and an audit."""
    part, digest, audit, at, made, odd = None, None, "", 0, 0, 0

    def name() -> str:
        return "system" if odd and made == 0 else ("user", "assistant")[(made + odd) % 2]

    def add(role: str, text: str) -> None:
        nonlocal made
        digest.update((("\n" if made else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        made += 1

    def inserted() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            add(name(), "")
            at += 1

    for batch in batches:
        done: list[tuple[int, str]] = []
        for p, _, a, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if a is not None:
                if digest is not None:
                    inserted()
                    done.append((part, digest.hexdigest()))
                part, digest, audit, at, made = p, hashlib.sha256(), a, 0, 0
                odd = (len(a) - a.count("D")) % 2
                continue
            inserted()
            if audit[at] != "D":
                add(role if audit[at] == "K" else name(), text)
            at += 1
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], kind) for k, kind in enumerate((pa.int64(), pa.string()))], names=["part", "repaired_sha256"])
    if digest is not None:
        inserted()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([digest.hexdigest()])], names=["part", "repaired_sha256"])


def coded(role: Column, faulty: Column, truncated: Column) -> tuple[Column, Column]:
    """A turn's letter for the alignment, and its role's initial: s, u, a, or x for all others."""
    initial = F.substring(role, 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return F.when(faulty, "d").when(truncated, F.upper(initial)).otherwise(initial), initial


def faults(rows: DataFrame) -> DataFrame:
    """Turns (conv, turn, role, text) by `place`, a number over all conversations in order, with each turn's first fault: `blank`,
    `duplicate` (of a turn of the same role and text earlier in the conversation) or `truncated`."""
    tied = shared_checkpoint(rows.withColumn("tie", F.monotonically_increasing_id()))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text", "tie")]
    placed = ranked(tied, order, "place").drop("tie")
    digest = F.sha2(F.concat(F.sha2(F.col("role").cast("binary"), 256), F.col("text")).cast("binary"), 256)
    firsts = placed.groupBy("conv", digest.alias("digest")).agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    bare = F.expr(f"rtrim('{SPACE}', text)")
    blank = bare == ""
    duplicate = ~blank & F.col("first").isNull()
    truncated = ~blank & ~duplicate & ~F.right(bare, F.lit(1)).isin(".", "!", "?")
    # Joined by a number that no two rows share, so a turn that is repeated often is no hot key.
    return placed.join(firsts, "place", "left").select("conv", "turn", "role", "text", "place", blank.alias("blank"), duplicate.alias("duplicate"), truncated.alias("truncated"))


def repair(rows: DataFrame) -> DataFrame:
    """One row for each conversation of `rows` (conv, turn, role, text): conv, gaps, blank, duplicate, truncated, illegal, cost,
    audit and repaired_sha256.

    Turns are ordered by number, null numbers first, then by role and text; which of equal turns comes first makes no
    difference. Roles and texts aren't null. Turns of a null conv are one conversation. Blank and repeated turns are deleted,
    and very long texts are hashed whole; a text is never cut. Other columns are not read. No rows give none.
    """
    turns = shared_checkpoint(faults(rows))
    code, initial = coded(F.col("role"), F.col("blank") | F.col("duplicate"), F.col("truncated"))
    letters = turns.select("conv", "place", F.floor(F.col("place") / CHUNK).cast("long").alias("chunk"), F.concat(code, initial).alias("letters"))
    listed = letters.groupBy("conv", "chunk").agg(F.sort_array(F.collect_list(F.struct("place", "letters"))).alias("l"))  # CHUNK turns at most
    string = lambda k: F.array_join(F.transform("l", lambda x: F.substring(x["letters"], k, 1)), "")
    strings = listed.select("conv", "chunk", string(1).alias("codes"), string(2).alias("initials"))
    kind = rows.schema["conv"].dataType.simpleString()
    found = shared_checkpoint(strings.mapInArrow(aligned, f"conv {kind}, {RESULT}"))
    while True:
        parts = F.sort_array(F.collect_list(F.struct("chunk", "illegal", "ends", "costs", "audits")))
        grouped = found.groupBy("conv", F.floor(F.col("chunk") / AT_ONCE).cast("long").alias("chunk")).agg(parts.alias("parts"))
        found = shared_checkpoint(grouped.mapInArrow(folded, f"conv {kind}, {RESULT}"))
        if found.groupBy("conv").count().where("count > 1").isEmpty():
            break
    # The grammar ends where it begins, or behind an assistant turn.
    ways = [F.struct(F.get("costs", F.lit(k)).alias("cost"), F.get("audits", F.lit(k)).alias("audit")) for k in (START, ASSISTANT)]
    best = F.array_min(F.filter(F.array(*ways), lambda w: w["cost"].isNotNull()))
    ended = found.select("conv", "illegal", best.alias("best")).select("conv", "illegal", F.col("best.cost").cast("long").alias("cost"), "best.audit")
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    counts = turns.groupBy("conv").agg(gaps.alias("gaps"), *(F.count_if(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated")), F.min("place").alias("part"))
    told = shared_checkpoint(counts.join(ended.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).drop("c"))
    none = F.lit(None).cast("string")
    # A conversation's turns are told apart by the place of its first one.
    body = turns.join(told.select(F.col("conv").alias("c"), "part"), F.col("conv").eqNullSafe(F.col("c"))).select("part", "place", none.alias("audit"), "role", "text")
    lines = told.select("part", F.lit(0).cast("long").alias("place"), "audit", none.alias("role"), none.alias("text")).union(body)
    hashed = lines.repartition("part").sortWithinPartitions("part", "place").mapInArrow(rebuilt, "part long, repaired_sha256 string")
    return told.join(hashed, "part").drop("part")


def repair_damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """repair() of the turns behind the damage of damaged(), with a row for each conversation of `turns`; those of which nothing
    is left have zeros, an empty audit and the digest of no text. An empty table gives an empty result."""
    done = repair(damaged(turns, conv_col, turn_col, role_col, text_col))
    every = turns.select(F.col(conv_col).alias(conv_col)).distinct()
    joined = every.join(done, every[conv_col].eqNullSafe(done["conv"]), "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return joined.select(conv_col, *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
