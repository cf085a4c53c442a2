"""Boosted regression trees over all nodes, grown by histograms of their features.

Features are cut into equal bins between two outer quantiles. A level of all trees of a round, one tree per step
ahead, is one aggregation: count and residual sum per (step, tree node, feature, bin). Its size follows the
parameters, not the rows, and the driver picks the split of every tree node from it. Of two children only the one
with fewer rows is summed; its sibling is what it leaves of their parent. Residuals are whole numbers of ``UNIT``,
so sums do not depend on the order of rows, and a fit is the same however rows are dealt. They are summed as long
integers where no sum can leave their range, else as decimals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airpanel.operators.chunks import NODE, TIME, windowed
from airpanel.operators.quantiles import exact_quantiles
from airpanel.operators.rows import quoted
from airpanel.session import materialize

UNIT = 1e-6
#: Trees after which the residuals are written, so that expressions stay short.
ROUNDS = 5
#: Tree nodes summed by one aggregation, as columns of its rows; more take several.
AT_ONCE = 8
#: Features are summed in pairs while a pair has no more bins than this.
PAIRED = 4096

Cells = dict[tuple[int, int], tuple[int, int]]  # (count, sum) per (feature, bin)


@dataclass
class Tree:
    """Splits and leaves by heap number: node ``n`` has the children ``2n`` (bins up to the split's) and ``2n + 1``."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    leaves: dict[int, int] = field(default_factory=dict)  # in units

    def sql(self, node: int = 1, leaf: bool = True) -> str:
        """The leaf's value (or its number) of a row with bins ``_b0``, ``_b1``, ..."""
        if node not in self.splits:
            return f"CAST({self.leaves.get(node, 0)} AS BIGINT)" if leaf else str(node)
        f, b = self.splits[node]
        return f"CASE WHEN _b{f} <= {b} THEN {self.sql(2 * node, leaf)} ELSE {self.sql(2 * node + 1, leaf)} END"


@dataclass
class Boosted:
    """Bin bounds of the features, and per step ahead the mean and the trees."""

    features: list[str]
    bounds: list[tuple[float, float]]
    bins: int
    means: dict[int, int]
    trees: dict[int, list[Tree]]

    def binned(self) -> list[Column]:
        return [_bin(f, low, high, self.bins).alias(f"_b{i}") for i, (f, (low, high)) in enumerate(zip(self.features, self.bounds, strict=True))]

    def predicted(self, step: int) -> Column:
        """The forecast of a row with bins, in the target's own unit."""
        return F.expr(f"({' + '.join([str(self.means[step]), *(t.sql() for t in self.trees[step])])}) * {UNIT!r}D")


def _bin(feature: str, low: float, high: float, bins: int) -> Column:
    """0 to ``bins + 1``: the ends hold what lies beyond the bounds; values that are not known go to the first."""
    f = quoted(feature)
    if not low < high:
        return F.expr(f"CASE WHEN {f} > {high!r}D AND NOT isnan({f}) THEN 1 ELSE 0 END")
    return F.expr(f"CAST(CASE WHEN {f} IS NULL OR isnan({f}) THEN 0 ELSE width_bucket({f}, {low!r}D, {high!r}D, {bins}) END AS INT)")


def best_split(cells: Cells, features: int, least: int) -> tuple | None:
    """(feature, bin, (count, sum) up to it, (count, sum) beyond it) of the largest gain, or None.

    ``cells`` holds (count, sum) per (feature, bin). Of equal gains the first feature and the lowest bin.
    """
    best, kept = 0.0, None
    for f in range(features):
        mine = sorted((b, c) for (g, b), c in cells.items() if g == f)
        n, s = sum(c[0] for _, c in mine), sum(c[1] for _, c in mine)
        at_n, at_s = 0, 0
        for b, (cell_n, cell_s) in mine[:-1]:
            at_n, at_s = at_n + cell_n, at_s + cell_s
            if at_n < least or n - at_n < least:
                continue
            gain = at_s * at_s / at_n + (s - at_s) * (s - at_s) / (n - at_n) - s * s / n
            if gain > best * (1 + 1e-12) and gain > 1e-9 * (abs(s) + 1):
                best, kept = gain, (f, b, (at_n, at_s), (n - at_n, s - at_s))
    return kept


def fit_boosted(
    rows: DataFrame, features: Sequence[str], labels: dict[int, str], trees: int = 12, depth: int = 3, bins: int = 32,
    rate: float = 0.3, least: int = 20, outer: float = 0.01,
) -> Boosted:
    """A forest per step ahead; ``labels`` names each step's target, NULL in rows that it does not learn from."""
    features = list(features)
    wanted = {f"{f} {side}": (f, p) for f in features for side, p in (("low", outer), ("high", 1 - outer))}
    found = exact_quantiles(rows, wanted)
    bounds = [(found[f"{f} low"] or 0.0, found[f"{f} high"] or 0.0) for f in features]
    model = Boosted(features, bounds, bins, {}, {h: [] for h in labels})
    unit = lambda c: F.round(F.col(quoted(c)) / F.lit(UNIT)).cast("long")
    known = lambda c: F.when(~F.isnan(quoted(c)), unit(c))
    held = materialize(rows.select(*model.binned(), *[known(c).alias(f"_r{h}") for h, c in labels.items()]), "boosting")
    ends = [e for h in labels for e in (
        F.sum(F.col(f"_r{h}").cast("decimal(38,0)")).alias(f"s{h}"), F.count(f"_r{h}").alias(f"n{h}"),
        F.min(f"_r{h}").alias(f"low{h}"), F.max(f"_r{h}").alias(f"high{h}"),
    )]
    sums = held.agg(*ends).first()
    most: dict[int, int] = {}  # no residual of a step is further from zero
    for h in labels:
        model.means[h] = round(int(sums[f"s{h}"]) / sums[f"n{h}"]) if sums[f"n{h}"] else 0
        most[h] = max(abs(sums[f"low{h}"] or 0), abs(sums[f"high{h}"] or 0)) + abs(model.means[h])
    pending = {h: [str(model.means[h])] for h in labels}

    def residuals() -> list[Column]:
        return [F.expr(f"_r{h} - ({' + '.join(pending[h])})").alias(f"_r{h}") if pending[h] else F.col(f"_r{h}") for h in labels]

    at = [f"_b{i}" for i in range(len(features))]
    for done in range(1, trees + 1):
        now = held.select(*at, *residuals())
        kinds = {h: "BIGINT" if most[h] * sums[f"n{h}"] < 1 << 62 else "DECIMAL(38,0)" for h in labels}
        grown = _grown(now, len(features), bins + 2, kinds, depth, rate, least)
        for h, tree in grown.items():
            model.trees[h].append(tree)
            if tree.leaves:
                pending[h].append(tree.sql())
                most[h] += max(map(abs, tree.leaves.values()))
        if done % ROUNDS == 0 and done < trees:
            held = materialize(held.select(*at, *residuals()), "boosting")
            pending = {h: [] for h in labels}
    return model


def _grown(rows: DataFrame, features: int, stride: int, kinds: dict[int, str], depth: int, rate: float, least: int) -> dict[int, Tree]:
    """One tree per step ahead, level by level; ``kinds`` has the type of each step's sums, ``stride`` the bins of a feature."""
    grown = {h: Tree() for h in kinds}
    known: dict[tuple[int, int], Cells] = {}
    todo = [(h, 1) for h in kinds]
    siblings: list[tuple[int, int, int]] = []  # (step, node, sibling that is summed)
    for _ in range(depth):
        if not todo:
            break
        for i in range(0, len(todo), AT_ONCE):
            known |= _histograms(rows, grown, todo[i:i + AT_ONCE], features, stride, kinds)
        level = list(todo)
        for h, node, other in siblings:
            known[h, node] = _rest(known[h, node // 2], known[h, other])
            level.append((h, node))
        todo, siblings = [], []
        for h, node in sorted(level):
            split = best_split(known[h, node], features, least)
            if split is None:
                continue
            f, b, left, right = split
            grown[h].splits[node] = (f, b)
            for child, (n, s) in ((2 * node, left), (2 * node + 1, right)):
                grown[h].leaves[child] = round(rate * s / n)
            few, many = (2 * node, 2 * node + 1) if left[0] <= right[0] else (2 * node + 1, 2 * node)
            todo.append((h, few))
            siblings.append((h, many, few))
    return grown


def _histograms(
    rows: DataFrame, grown: dict[int, Tree], nodes: Sequence[tuple[int, int]], features: int, stride: int, kinds: dict[int, str],
) -> dict[tuple[int, int], Cells]:
    """The cells of some tree nodes, each node a column of residuals, in one aggregation.

    A row goes to one group per pair of features; the few (pairs x bins x bins) groups give the cells of both.
    """
    inside = [f"CASE WHEN ({grown[h].sql(leaf=False)}) = {node} THEN CAST(_r{h} AS {kinds[h]}) END AS r{k}" for k, (h, node) in enumerate(nodes)]
    names = [f"r{k}" for k in range(len(nodes))]
    side = 2 if stride * stride <= PAIRED else 1
    groups = [range(f, min(f + side, features)) for f in range(0, features, side)]
    cells = ", ".join(f"{i * stride ** side} + " + " + ".join(f"_b{f} * {stride ** k}" for k, f in enumerate(fs)) for i, fs in enumerate(groups))
    at = [f"_b{f}" for f in range(features)]
    # Rows in none of the nodes have no list to take apart; a filter would move below and compute the residuals again.
    any_of = " OR ".join(f"{r} IS NOT NULL" for r in names)
    found = rows.selectExpr(*at, *inside).selectExpr(f"explode(CASE WHEN {any_of} THEN array({cells}) END) AS cell", *names)
    out: dict[tuple[int, int], Cells] = {key: {} for key in nodes}
    for row in found.groupBy("cell").agg(*[e for r in names for e in (F.count(r).alias(f"n_{r}"), F.sum(r).alias(f"s_{r}"))]).collect():
        group, code = divmod(row["cell"], stride ** side)
        places = [(f, code // stride ** k % stride) for k, f in enumerate(groups[group])]
        for i, key in enumerate(nodes):
            n, s = row[1 + 2 * i], row[2 + 2 * i]
            for place in places if n else ():
                before = out[key].get(place, (0, 0))
                out[key][place] = (before[0] + n, before[1] + int(s))
    return out


def _rest(whole: Cells, part: Cells) -> Cells:
    """What a part leaves of the whole, cells without rows left out."""
    left = {at: (n - part.get(at, (0, 0))[0], s - part.get(at, (0, 0))[1]) for at, (n, s) in whole.items()}
    return {at: c for at, c in left.items() if c[0]}


def forecast_boosted(
    df: DataFrame, features: Sequence[str], target: str = "aqi", horizons: Sequence[int] = (1, 6, 12, 24),
    key: str = NODE, time: str = TIME, split: str = "split", size: int | None = None, **options,
) -> DataFrame:
    """One model over all nodes per step ahead, fitted on the train rows: (node, time, h, y_true, y_pred) of the test rows."""
    ahead = {f"_y{h}": (lambda w, h=h: F.lead(target, h).over(w)) for h in horizons}
    # Where the future row lies decides the fit, so no label of val or test leaks.
    ahead |= {f"_s{h}": (lambda w, h=h: F.lead("_train", h).over(w)) for h in horizons}
    needed = list(dict.fromkeys([key, time, split, target, *features]))
    chunk = {} if size is None else {"size": size}
    known = df.select(*map(quoted, needed)).dropna().withColumn("_train", F.col(quoted(split)) == "train")
    rows = windowed(known, ahead, lookahead=max(horizons), keys=[key], order=[time], **chunk)
    rows = materialize(rows, "boosted-rows")
    fit = rows.where("_train").withColumns({f"_y{h}": F.when(F.col(f"_s{h}"), F.col(f"_y{h}")) for h in horizons})
    model = fit_boosted(fit, features, {h: f"_y{h}" for h in horizons}, **options)
    test = rows.where(F.col(split) == "test").select(key, time, *[f"_y{h}" for h in horizons], *model.binned())
    made = F.array(*[F.struct(F.lit(h).alias("h"), F.col(f"_y{h}").alias("y_true"), model.predicted(h).alias("y_pred")) for h in horizons])
    return test.select(key, time, F.inline(made)).where("y_true IS NOT NULL")
