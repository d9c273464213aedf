"""Boosted trees for a middle and for quantiles, grown from histograms that Spark sums, with early stopping.

Each input is cut into bins at its approximate quantiles over all rows. A level of a tree is one aggregate: the loss's slopes
of all rows, summed by model, node, input and bin. What comes back to the driver is that histogram, whose size depends on the
depth, inputs and bins alone, never on the rows. Several losses (squared, or the pinball loss of a quantile) are grown side by
side in the same aggregates. A leaf of the squared loss holds the mean of its residuals, one of a quantile their quantile.
Rows marked as held don't grow trees; their loss tells when to stop.

A trained model is a short table of trees, and predicts as a nested expression that runs within any query.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bins of an input, levels of a tree, most rounds, step size, rounds without progress until a model stops, least rows of a
#: leaf, rounds between cuts of the lineage, and the accuracy of quantile sketches.
BINS, DEPTH, ROUNDS, RATE, PATIENCE, LEAST_LEAF, CUT_EACH, ACCURACY = 24, 3, 24, 0.3, 3, 8, 6, 1000

Cut = Callable[[DataFrame], DataFrame]


@dataclass
class Tree:
    """A complete binary tree: the input and threshold of each inner node, level by level (None: all rows go left), the value
    of each leaf, and each input's gain. Rows above a threshold go right, nulls left."""

    splits: list[tuple[int, float, int] | None]
    leaves: list[float]
    gains: dict[int, float] = field(default_factory=dict)

    def sql(self, x: str) -> str:
        """The leaf's value as an expression over the array `x`."""

        def node(i: int) -> str:
            if i >= len(self.splits):
                return f"{self.leaves[i - len(self.splits)]!r}D"
            if self.splits[i] is None:
                return node(2 * i + 1)
            at, threshold, _ = self.splits[i]
            return f"CASE WHEN {x}[{at}] > {threshold!r}D THEN {node(2 * i + 2)} ELSE {node(2 * i + 1)} END"

        return node(0)


@dataclass
class Booster:
    """Trees whose leaves add up to a prediction; share: of the pinball loss, None for the squared one."""

    share: float | None
    base: float
    trees: list[Tree] = field(default_factory=list)

    def sql(self, x: str) -> str:
        return "(" + " + ".join([f"{self.base!r}D", *(t.sql(x) for t in self.trees)]) + ")"

    def predict(self, x: str = "x") -> Column:
        """The prediction from the array column `x`."""
        return F.expr(self.sql(x))

    def importance(self, inputs: int) -> list[float]:
        """Each input's share of all gains."""
        total = [sum(t.gains.get(i, 0.0) for t in self.trees) for i in range(inputs)]
        return [g / (sum(total) or 1.0) for g in total]


def cuts_of(rows: DataFrame, inputs: int, bins: int = BINS) -> list[list[float]]:
    """The bins' upper bounds of each input of the array `x`, but the last one's; one aggregate."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*(F.percentile_approx(F.get("x", F.lit(i)), shares, ACCURACY).alias(f"c{i}") for i in range(inputs))).first()
    return [sorted(set(found[i] or [])) for i in range(inputs)]


def binned(cuts: list[list[float]]) -> Column:
    """How many of its input's bounds each value of `x` is above; 0 for nulls."""
    above = lambda i, bounds: F.coalesce(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda c: c < F.get("x", F.lit(i)))), F.lit(0)) if bounds else F.lit(0)
    return F.array(*(above(i, bounds).cast("int") for i, bounds in enumerate(cuts)))


def node_of(splits: list[tuple[int, float, int] | None], levels: int) -> str:
    """SQL of the number, within its level, of the node that a row's `bins` lead to after `levels` splits."""

    def node(i: int, level: int) -> str:
        if level == levels:
            return str(i - (2**levels - 1))
        if splits[i] is None:
            return node(2 * i + 1, level + 1)
        return f"IF(bins[{splits[i][0]}] > {splits[i][2]}, {node(2 * i + 2, level + 1)}, {node(2 * i + 1, level + 1)})"

    return node(0, 0)


def best_split(cells: dict[int, dict[int, tuple[float, int]]], cuts: list[list[float]], least: int) -> tuple[float, tuple[int, float, int] | None]:
    """The gain and (input, threshold, bin) that part a node best; cells: of each input and bin the sum of slopes and the rows."""
    best: tuple[float, tuple[int, float, int] | None] = (1e-12, None)
    for at, held in sorted(cells.items()):
        total, n = sum(g for g, _ in held.values()), sum(k for _, k in held.values())
        left, rows = 0.0, 0
        for b in range(len(cuts[at])):
            g, k = held.get(b, (0.0, 0))
            left, rows = left + g, rows + k
            if rows >= least and n - rows >= least:
                gain = left**2 / rows + (total - left) ** 2 / (n - rows) - total**2 / n
                if gain > best[0]:
                    best = gain, (at, cuts[at][b], b)
    return best


def pinball(y: Column, p: Column, share: float) -> Column:
    return F.greatest((y - p) * share, (y - p) * (share - 1))


def boost(
    rows: DataFrame,
    shares: dict[str, float | None],
    cut: Cut,
    inputs: int,
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    rate: float = RATE,
    patience: int = PATIENCE,
    least: int = LEAST_LEAF,
    bins: int = BINS,
) -> dict[str, Booster]:
    """Trains a Booster for each of `shares` on rows (`x` array of `inputs` doubles, `y`, `held` boolean).

    Rows with a null `y` are left out; nulls in `x` go with the lowest values. Without rows to grow on, every prediction is 0;
    without held rows all rounds are grown. `cut` writes rows to the shared folder and reads them again.
    """
    known = rows.where(F.col("y").isNotNull()).select("x", F.col("y").cast("double").alias("y"), F.coalesce("held", F.lit(False)).alias("held"))
    grown = known.where("not held")
    cuts = cuts_of(grown, inputs, bins)
    names = list(shares)
    quantiles = [0.5 if shares[m] is None else shares[m] for m in names]
    begin = grown.agg(F.avg("y"), F.percentile_approx("y", quantiles, ACCURACY)).first()
    made = {m: Booster(shares[m], 0.0 if begin[0] is None else float(begin[0] if shares[m] is None else begin[1][k])) for k, m in enumerate(names)}
    if begin[0] is None:
        return made
    state = cut(known.select(binned(cuts).alias("bins"), "y", "held", *(F.lit(made[m].base).alias(f"p_{m}") for m in names)))
    slope = {m: f"y - p_{m}" if shares[m] is None else f"{shares[m]}D - CAST(y < p_{m} AS DOUBLE)" for m in names}
    loss = {m: f"(y - p_{m}) * (y - p_{m})" if shares[m] is None else f"greatest((y - p_{m}) * {shares[m]}D, (y - p_{m}) * {shares[m] - 1}D)" for m in names}
    best: dict[str, tuple[float, int]] = {m: (float("inf"), 0) for m in names}
    for turn in range(rounds + 1):
        splits: dict[str, list] = {m: [None] * (2**depth - 1) for m in names}
        gains: dict[str, dict[int, float]] = {m: {} for m in names}
        for level in range(depth):
            # A held row has its loss in one cell of its own.
            each = ", ".join(f"named_struct('m', {k}, 'node', IF(held, -1, {node_of(splits[m], level)}), 'g', IF(held, {loss[m]}, {slope[m]}))" for k, m in enumerate(names))
            cells = state.selectExpr(f"inline(array({each}))", "IF(held, array(0), bins) AS b").selectExpr("m", "node", "g", "posexplode(b) AS (at, bin)")
            held: dict[str, dict[int, dict[int, dict[int, tuple[float, int]]]]] = {m: {} for m in names}
            for r in cells.groupBy("m", "node", "at", "bin").agg(F.sum("g").alias("g"), F.count("*").alias("n")).collect():  # models x nodes x inputs x bins at most
                held[names[r["m"]]].setdefault(r["node"], {}).setdefault(r["at"], {})[r["bin"]] = r["g"], r["n"]
            if level == 0:
                for m in names:
                    if -1 in held[m]:
                        now = held[m][-1][0][0][0]
                        if now < best[m][0] * (1 - 1e-6):
                            best[m] = now, turn
                    else:
                        best[m] = 0.0, turn
                if turn == rounds or all(turn - best[m][1] >= patience for m in names):
                    for m in names:
                        made[m].trees = made[m].trees[: best[m][1]]
                    return made
            for m in names:
                for node, of in held[m].items():
                    if node >= 0:
                        gain, split = best_split(of, cuts, least)
                        splits[m][2**level - 1 + node] = split
                        if split is not None:
                            gains[m][split[0]] = gains[m].get(split[0], 0.0) + gain
        leaf = {m: node_of(splits[m], depth) for m in names}
        each = ", ".join(f"named_struct('m', {k}, 'leaf', {leaf[m]}, 'r', y - p_{m})" for k, m in enumerate(names))
        values = state.where("not held").selectExpr(f"inline(array({each}))").groupBy("m", "leaf").agg(F.avg("r").alias("mean"), F.percentile_approx("r", quantiles, ACCURACY).alias("q"))
        found = {(r["m"], r["leaf"]): r for r in values.collect()}  # a row a leaf
        for k, m in enumerate(names):
            of = [found.get((k, i)) for i in range(2**depth)]
            leaves = [0.0 if r is None else rate * float(r["mean"] if shares[m] is None else r["q"][k]) for r in of]
            made[m].trees.append(Tree(splits[m], leaves, gains[m]))
        added = {m: f"p_{m} + array({', '.join(f'{x!r}D' for x in made[m].trees[-1].leaves)})[{leaf[m]}] AS p_{m}" for m in names}
        state = state.selectExpr("bins", "y", "held", *added.values())
        if (turn + 1) % CUT_EACH == 0:
            state = cut(state)
    return made


def save(spark: SparkSession, boosters: dict[str, Booster], path: str) -> None:
    """Writes the models as a table of trees; a row a tree, and one for each base."""
    rows = [(m, b.share, -1, None, [b.base], None) for m, b in boosters.items()]
    for m, b in boosters.items():
        rows += [(m, b.share, i, [None if s is None else (s[0], float(s[1]), s[2]) for s in t.splits], t.leaves, t.gains) for i, t in enumerate(b.trees)]
    schema = "model string, share double, tree int, splits array<struct<input:int,threshold:double,bin:int>>, leaves array<double>, gains map<int,double>"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> dict[str, Booster]:
    """The models that save() wrote."""
    out: dict[str, Booster] = {}
    for r in spark.read.parquet(path).orderBy("tree").collect():  # a row a tree
        if r["tree"] < 0:
            out[r["model"]] = Booster(r["share"], r["leaves"][0])
        else:
            out[r["model"]].trees.append(Tree([None if s is None else tuple(s) for s in r["splits"]], list(r["leaves"]), dict(r["gains"])))
    return out
