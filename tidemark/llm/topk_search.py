"""Exact search for the highest inner products with segment statistics at several resolutions.

A vector is cut into 1, 2, 4, ... equal segments, each described by its mean and its deviation. For two
vectors the inner product of a segment is its length times the product of the means plus at most its
length times the product of the deviations (Cauchy and Schwarz), which bounds the score from above
(in the words of distances: the distance from below). Bounds are computed coarse to fine, each only for
the candidates that the one before left, and exact products for the survivors.

Queries and candidates are packed into blocks of bounded size. Every query block meets every candidate
block once, as the statement of the search demands; a task keeps the best of each query over all of its
candidate blocks, so that what it has found bounds what it still has to look at. The partial answers, `k`
for a query and group of candidate blocks, meet by query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Neighbours of a query, vectors of a block, vectors of a group of blocks, and slack of
#: bounds in single precision as a share of the product of lengths.
K, QUERY_BLOCK, CANDIDATE_BLOCK, GROUP_ROWS, SLACK = 20, 512, 16_384, 100_000, 1e-5

#: Queries and candidates that are bounded together, and share of live pairs below which they are multiplied one by one.
QUERY_GROUP, PIECE, FEW = 128, 1024, 0.02

#: Products beyond this size aren't exact in doubles; they are computed in Python's integers.
EXACT = float(1 << 53)


def segment_stats(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments' means and deviations, each scaled by the root of the segment's length, so that products add up."""
    edges = np.linspace(0, x.shape[1], segments + 1).astype(int)[:-1]
    sizes = np.diff(np.r_[edges, x.shape[1]])
    mean = np.add.reduceat(x, edges, axis=1) / sizes
    square = np.add.reduceat(x * x, edges, axis=1) / sizes
    root = np.sqrt(sizes)
    return mean * root, np.sqrt(np.maximum(0, square - mean * mean)) * root


def bounding(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products bound those of the vectors from above: means, deviations, and the length for rounding errors."""
    length = np.linalg.norm(x, axis=1, keepdims=True) * np.sqrt(SLACK)
    return np.hstack([*segment_stats(x, segments), length]).astype(np.float32)


def resolutions(dim: int) -> list[int]:
    """Numbers of segments: 1, 4, 16, ... while a segment has two components or more, and segments of two."""
    out, n = [], 1
    while 2 * n <= dim:
        out.append(n)
        n *= 4
    return sorted({*out, max(1, dim // 2)})


def exact_in_doubles(q: np.ndarray, x: np.ndarray) -> bool:
    return q.shape[1] * np.abs(q).max(initial=0) * np.abs(x).max(initial=0) < EXACT


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    if exact_in_doubles(q, x):
        return q @ x.T
    return np.array([[int(v) for v in row] for row in q], object) @ np.array([[int(v) for v in row] for row in x], object).T


class Best:
    """Each query's k best of the candidates seen so far, ties to smaller ids; a query's own id is left out."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, k: int):
        # Queries of like direction stand together, so that a group drops the same candidates.
        order = np.lexsort(segment_stats(q, min(4, q.shape[1]))[0].T > 0) if len(q) else np.arange(0)
        self.q_ids, self.q, self.k = q_ids[order], q[order], k
        self.levels = resolutions(q.shape[1])
        self.stats = [bounding(self.q, n) for n in self.levels]
        self.scores = [np.empty(0, object)] * len(q)
        self.ids = [np.empty(0, np.int64)] * len(q)
        self.floor = np.full(len(q), -np.inf)
        self.left = np.zeros(len(self.levels) + 1, np.int64)  # pairs at the start and after each level

    def see(self, x_ids: np.ndarray, x: np.ndarray) -> None:
        # Candidates in order of their length, so that good ones raise the floor first.
        order = np.argsort(-np.linalg.norm(x, axis=1), kind="stable")
        for lo in range(0, len(x), PIECE):
            at = order[lo : lo + PIECE]
            cand, cand_ids = x[at], x_ids[at]
            stats = [bounding(cand, n) for n in self.levels]
            for first in range(0, len(self.q), QUERY_GROUP):
                self.meet(np.arange(first, min(first + QUERY_GROUP, len(self.q))), cand_ids, cand, stats)

    def meet(self, alive_q: np.ndarray, cand_ids: np.ndarray, cand: np.ndarray, stats: list[np.ndarray]) -> None:
        alive_x = np.arange(len(cand))
        self.left[0] += len(alive_q) * len(cand)
        for level, (mine, theirs) in enumerate(zip(self.stats, stats, strict=True)):
            # A bound out of range, which compares false, is none.
            live = ~(mine[alive_q] @ theirs[alive_x].T < self.floor[alive_q][:, None])
            keep_q, keep_x = live.any(axis=1), live.any(axis=0)
            alive_q, alive_x, live = alive_q[keep_q], alive_x[keep_x], live[keep_q][:, keep_x]
            self.left[level + 1] += int(live.sum())
            if not len(alive_q):
                return
        if live.mean() < FEW and exact_in_doubles(self.q, cand):
            row, column = np.nonzero(live)
            scores = np.einsum("ij,ij->i", self.q[alive_q[row]], cand[alive_x[column]])
        else:
            scores = products(self.q[alive_q], cand[alive_x])
            row, column = np.nonzero(live & (scores >= self.floor[alive_q][:, None]))
            scores = scores[row, column]
        good = (scores >= self.floor[alive_q[row]]) & (cand_ids[alive_x[column]] != self.q_ids[alive_q[row]])
        row, column, scores = row[good.astype(bool)], column[good.astype(bool)], scores[good.astype(bool)]
        edges = np.searchsorted(row, np.arange(len(alive_q) + 1))
        for r in np.unique(row).tolist():
            i, part = int(alive_q[r]), slice(edges[r], edges[r + 1])
            s = np.concatenate([self.scores[i], scores[part].astype(object)])
            v = np.concatenate([self.ids[i], cand_ids[alive_x[column[part]]]])
            best = np.lexsort((v, -s.astype(np.float64)))[: self.k] if abs(s).max() < EXACT else np.array(sorted(range(len(s)), key=lambda j: (-s[j], v[j]))[: self.k])
            self.scores[i], self.ids[i] = s[best], v[best]
            if len(best) == self.k:
                self.floor[i] = float(self.scores[i][-1])

    def rows(self) -> list[tuple[int, int, int]]:
        """(query, vector, score)"""
        return [(int(q), int(v), int(s)) for q, ids, scores in zip(self.q_ids.tolist(), self.ids, self.scores, strict=True) for v, s in zip(ids.tolist(), scores.tolist(), strict=True)]


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of at most `rows` vectors of one length: dim, n, ids and values as bytes."""
    schema = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("ids", T.BinaryType()), T.StructField("values", T.BinaryType())])

    def run(batches):
        held: dict[int, list[list]] = {}

        def block(dim, part):
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([np.concatenate(part[0]).tobytes()], pa.binary()), pa.array([np.concatenate(part[1]).tobytes()], pa.binary())], names=schema.names)

        for batch in batches:
            sizes = np.asarray(pa.compute.list_value_length(batch.column(1)))
            flat = np.asarray(batch.column(1).flatten())
            starts = np.cumsum(sizes) - sizes
            ids = np.asarray(batch.column(0))
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                x = flat[(starts[at][:, None] + np.arange(dim)).ravel()].reshape(-1, dim)
                for lo in range(0, len(at), rows):
                    part = held.setdefault(dim, [[], [], 0])
                    part[0].append(ids[at[lo : lo + rows]])
                    part[1].append(x[lo : lo + rows].ravel())
                    part[2] += len(at[lo : lo + rows])
                    if part[2] >= rows:
                        yield block(dim, part)
                        del held[dim]
        for dim, part in held.items():
            yield block(dim, part)

    import pyarrow.compute  # noqa: F401

    return vectors.mapInArrow(run, schema)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The `k` best of all other rows for each row that is a query: query_id, rank (from 1), vec_id, score.

    Components become floor(scale * x) in doubles; a score is their integer inner product, which must
    fit in 64 bits. Rows with a null id, a null or empty vector, or a null or non-finite component take
    no part; rows of other lengths are no candidates. Rows that repeat an id are candidates of their own
    but never of that id; a repeated query is answered once, from its first row's vector by value. Queries
    with fewer candidates return all. An empty table gives an empty result; other columns are not read.
    Queries and candidates are dealt to groups of about `group_rows`, of candidates at least two for each
    core; each pair of groups meets in one task.
    """
    x = F.transform(vector_col, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("double"))
    finite = F.forall(vector_col, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    valid = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite)
    rows = valid.select(F.col(id_col).cast("long").alias("id"), x.alias("v"), is_query.alias("q"))
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("q")).first()
    groups, q_groups = max(2 * vectors.sparkSession.sparkContext.defaultParallelism, -(-sizes["n"] // group_rows)), max(1, -(-sizes["q"] // group_rows))
    queries = rows.where("q").groupBy("id").agg(F.min("v").alias("v"))
    q_blocks = packed(queries, QUERY_BLOCK).select("dim", F.col("ids").alias("q_ids"), F.col("values").alias("q_values"))
    # Groups come from the blocks' bytes: a task that runs again deals its blocks as before.
    x_blocks = packed(rows.select("id", "v"), max(1, min(CANDIDATE_BLOCK, sizes["n"] // (4 * groups)))).withColumn("group", F.pmod(F.xxhash64("ids", "values"), F.lit(groups)).cast("int"))
    # A grid of groups: each task has about group_rows queries and as many candidates.
    q_dealt = q_blocks.withColumn("q_group", F.pmod(F.xxhash64("q_ids"), F.lit(q_groups)).cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    met = q_dealt.join(x_blocks.withColumn("q_group", F.explode(F.sequence(F.lit(0), F.lit(q_groups - 1)))), ["dim", "group", "q_group"])
    answer = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])

    def search(batches):
        held: dict[tuple, Best] = {}
        for batch in batches:
            for dim, q_ids, q_values, ids, values in zip(*(batch.column(c).to_pylist() for c in ("dim", "q_ids", "q_values", "ids", "values")), strict=True):
                if (best := held.get((dim, q_ids))) is None:
                    best = held[dim, q_ids] = Best(np.frombuffer(q_ids, np.int64), np.frombuffer(q_values).reshape(-1, dim), k)
                best.see(np.frombuffer(ids, np.int64), np.frombuffer(values).reshape(-1, dim))
        for best in held.values():
            if found := best.rows():
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=answer.names)

    partial = met.mapInArrow(search, answer)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
