"""Boosted trees grown best leaf first, one fit per entity's daily series.

All rounds of a series run inside one task, over histograms of binned features, so a round is
no Spark job and a million entities are fitted side by side. A series has a row per day; one
of more than ``MOST_CELLS`` values is refused before anything is gathered, and ``model.train_gbt``
fits tables of that kind. The fitted trees are a table, from which importances are aggregated.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from mixlab.config import BOOSTING_ROUNDS
from mixlab.session import stage

MOST_CELLS = 20_000_000  # rows times features of one series: some 160 MB for each of three arrays
BATCH = 2_000  # rows scored at once

TREES = "tree INT, node INT, feature STRING, threshold DOUBLE, left INT, right INT, value DOUBLE, gain DOUBLE, rows LONG"


@dataclass(frozen=True)
class Boosting:
    """How trees are grown. A tree looks at ``feature_part`` of the features; every
    ``row_every`` rounds another ``row_part`` of the rows is drawn."""

    rounds: int = BOOSTING_ROUNDS
    leaves: int = 31
    step: float = 0.05
    feature_part: float = 0.9
    row_part: float = 0.8
    row_every: int = 5
    least_rows: int = 20
    bins: int = 255
    seed: int = 42


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Ascending cuts between bins: half-way between neighbours, or quantiles where values are too many."""
    known = np.sort(values[~np.isnan(values)])
    distinct = np.unique(known)
    if len(distinct) > bins:
        distinct = np.unique(np.quantile(known, np.linspace(0, 1, bins), method="lower"))
    middle = distinct[:-1] + (distinct[1:] - distinct[:-1]) / 2
    return np.where(middle < distinct[1:], middle, distinct[:-1])


class _Histograms:
    """Binned features; bin 0 of each holds the missing values, which go left at every split."""

    def __init__(self, x: np.ndarray, bins: int):
        self.edges = [_edges(x[:, j], bins) for j in range(x.shape[1])]
        codes = [np.where(np.isnan(x[:, j]), 0, np.searchsorted(e, x[:, j]) + 1) for j, e in enumerate(self.edges)]
        self.widths = np.array([len(e) + 2 for e in self.edges])
        self.starts = np.concatenate([[0], np.cumsum(self.widths)[:-1]])
        self.cells = np.stack(codes, axis=1) + self.starts
        self.size = int(self.widths.sum())

    def of(self, rows: np.ndarray, residual: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Sums of the drawn rows' residuals, and their number, per cell."""
        cells, width = self.cells[rows].ravel(), self.cells.shape[1]
        drawn = weight[rows]
        sums = np.bincount(cells, np.repeat(residual[rows] * drawn, width), self.size)
        return np.stack([sums, np.bincount(cells, np.repeat(drawn, width), self.size)])

    def best(self, cells: np.ndarray, total: float, n: float, allowed: np.ndarray, least: int) -> tuple[float, int]:
        """The largest gain and its cell; among equal ones the first feature and the lowest cut."""
        run = np.cumsum(cells, axis=1)
        before = np.concatenate([[[0.0], [0.0]], run], axis=1)[:, self.starts]
        left, count = run - np.repeat(before, self.widths, axis=1)
        rest = n - count
        fits = allowed & (count >= least) & (rest >= least)
        if not fits.any():
            return -np.inf, -1
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left**2 / count + (total - left) ** 2 / rest - total**2 / n
        gain = np.where(fits, gain, -np.inf)
        cell = int(np.argmax(gain))
        return float(gain[cell]), cell

    def feature_of(self, cell: int) -> tuple[int, float]:
        """The feature of a cell and the largest value that goes left there."""
        j = int(np.searchsorted(self.starts, cell, side="right")) - 1
        b = cell - self.starts[j]
        return j, -np.inf if b == 0 else float(self.edges[j][min(b, len(self.edges[j])) - 1])


def _grow(h: _Histograms, residual: np.ndarray, weight: np.ndarray, allowed: np.ndarray, how: Boosting):
    """One tree's nodes as [feature, threshold, left, right, value, gain, rows], and what it adds per row.

    The leaf with the largest gain is split next. The smaller child is counted and the
    other one is what is left of its parent.
    """
    floor = 1e-12 * float((residual**2 * weight).sum())
    nodes: list[list] = []
    queue: list[tuple[float, int]] = []
    held: dict[int, tuple] = {}

    def add(rows, cells):
        total, n = float((residual[rows] * weight[rows]).sum()), float(weight[rows].sum())
        node = len(nodes)
        nodes.append([-1, None, None, None, how.step * total / n if n else 0.0, None, int(n)])
        gain, cell = h.best(cells, total, n, allowed, how.least_rows)
        held[node] = (rows, cells, cell)
        if gain > floor:
            heapq.heappush(queue, (-gain, node))

    everything = np.arange(len(residual))
    add(everything, h.of(everything, residual, weight))
    leaves = 1
    while queue and leaves < how.leaves:
        loss, node = heapq.heappop(queue)
        rows, cells, cell = held.pop(node)
        j, threshold = h.feature_of(cell)
        goes = h.cells[rows, j] <= cell
        sides = [rows[goes], rows[~goes]]
        small = 0 if len(sides[0]) <= len(sides[1]) else 1
        counted = h.of(sides[small], residual, weight)
        parts = [counted, cells - counted] if small == 0 else [cells - counted, counted]
        nodes[node][:6] = [j, threshold, len(nodes), len(nodes) + 1, None, -loss]
        for side, part in zip(sides, parts):
            add(side, part)
        leaves += 1
    added = np.zeros(len(residual))
    for node, (rows, _, _) in held.items():
        added[rows] = nodes[node][4]
    return nodes, added


def _boost(x: np.ndarray, y: np.ndarray, how: Boosting) -> list[tuple]:
    """(tree, node, feature number, threshold, left, right, value, gain, rows); tree 0 is the mean."""
    order = np.lexsort([*x.T, y])
    x, y = x[order], y[order]
    h = _Histograms(x, how.bins)
    fitted = np.full(len(y), y.mean())
    out = [(0, 0, -1, None, None, None, float(y.mean()), None, len(y))]
    owner = np.repeat(np.arange(x.shape[1]), h.widths)
    chosen = max(1, round(how.feature_part * x.shape[1]))
    weight = np.ones(len(y))
    for tree in range(1, how.rounds + 1):
        if how.row_part < 1 and (tree - 1) % how.row_every == 0:
            draw = np.random.default_rng([how.seed, 0, tree]).permutation(len(y))
            weight = (draw < max(1, round(how.row_part * len(y)))).astype(float)
        seen = np.zeros(x.shape[1], bool)
        seen[np.random.default_rng([how.seed, 1, tree]).permutation(x.shape[1])[:chosen]] = True
        nodes, added = _grow(h, y - fitted, weight, seen[owner], how)
        fitted += added
        out += [(tree, node, *cells) for node, cells in enumerate(nodes)]
    return out


def _numbers(df: pd.DataFrame, columns: Sequence[str]) -> np.ndarray:
    """The columns as doubles; what is not finite counts as missing."""
    x = np.stack([df[c].to_numpy(dtype=float, na_value=np.nan) for c in columns], axis=1)
    return np.where(np.isfinite(x), x, np.nan)


class _Forest:
    """Trees as flat arrays, scored for a batch of rows at a time."""

    def __init__(self, trees: pd.DataFrame, features: Sequence[str]):
        trees = trees.sort_values(["tree", "node"])
        place = {name: i for i, name in enumerate(features)}
        self.features = list(features)
        self.feature = trees["feature"].map(place).fillna(0).to_numpy(dtype=int)
        here = np.arange(len(trees))
        self.roots = here[trees["node"].to_numpy() == 0]
        root = here - trees["node"].to_numpy()
        inner = trees["left"].notna().to_numpy()
        self.threshold = np.where(inner, trees["threshold"].to_numpy(dtype=float), np.inf)
        self.left = np.where(inner, root + trees["left"].fillna(0).to_numpy(dtype=int), here)
        self.right = np.where(inner, root + trees["right"].fillna(0).to_numpy(dtype=int), here)
        self.value = trees["value"].fillna(0.0).to_numpy(dtype=float)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._batch(x[i : i + BATCH]) for i in range(0, len(x), BATCH)] or [np.zeros(0)])

    def _batch(self, x: np.ndarray) -> np.ndarray:
        row = np.arange(len(x))[:, None]
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        while True:
            goes_right = x[row, self.feature[at]] > self.threshold[at]
            following = np.where(goes_right, self.right[at], self.left[at])
            if (following == at).all():
                return self.value[at].sum(axis=1)
            at = following

    def outputs(self, x: np.ndarray, zeroed: Sequence[str]) -> list[np.ndarray]:
        """The prediction, and per entry of ``zeroed`` what it loses when that feature is 0."""
        whole = self.score(x)
        out = [whole]
        for name in zeroed:
            if name in self.features:
                without = x.copy()
                without[:, self.features.index(name)] = 0.0
                out.append(whole - self.score(without))
            else:
                out.append(np.zeros(len(x)))
        return out


def _bounded(df: DataFrame, id_cols: Sequence[str], columns: int) -> None:
    most = (df.groupBy(*id_cols).count().agg(F.max("count")).first()[0] or 0) * columns
    if most > MOST_CELLS:
        raise ValueError(f"a series of {most} values is more than one task takes ({MOST_CELLS}); use model.train_gbt")


@dataclass(frozen=True)
class LeafwiseScorer:
    """Fitted trees as a table: per id, tree and node the split (feature, threshold: what is not
    above it or missing goes ``left``) with its gain, or the leaf's value."""

    trees: DataFrame
    features: Sequence[str]
    id_cols: Sequence[str] = ()

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return self.effects(df, {}, out)

    def effects(self, df: DataFrame, columns: Mapping[str, str], out: str) -> DataFrame:
        """As ``LinearScorer.effects``. Rows of an entity that has no trees get NULL."""
        names, zeroed = [out, *columns], list(columns.values())
        if self.id_cols:
            return self._by_entity(df, names, zeroed)
        features = list(self.features)
        table = self.trees.toPandas()  # at most rounds * (2 * leaves - 1) + 1 rows
        if table.empty:
            return df.withColumns({n: F.lit(None).cast("double") for n in names})
        forest = _Forest(table, features)

        @F.pandas_udf(StructType([StructField(f"c{i}", DoubleType()) for i in range(len(names))]))
        def scores(rows: pd.DataFrame) -> pd.DataFrame:
            values = forest.outputs(_numbers(rows, rows.columns), zeroed)
            return pd.DataFrame({f"c{i}": v for i, v in enumerate(values)})

        inputs = F.struct(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
        scored = df.withColumn("_scores", scores(inputs))
        return scored.withColumns({n: F.col(f"_scores.c{i}") for i, n in enumerate(names)}).drop("_scores")

    def _by_entity(self, df: DataFrame, names: Sequence[str], zeroed: Sequence[str]) -> DataFrame:
        _bounded(df, self.id_cols, len(df.columns))
        features, kept = list(self.features), [c for c in df.columns if c not in names]
        schema = StructType([df.schema[c] for c in kept] + [StructField(n, DoubleType()) for n in names])

        def score(rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
            values = [None] * len(names)
            if len(trees) and len(rows):
                values = _Forest(trees, features).outputs(_numbers(rows, features), zeroed)
            return rows[kept].assign(**dict(zip(names, values)))

        # Cogrouped keys may not be null, so a null id is its own flag.
        flags = [F.col(c).isNull() for c in self.id_cols]
        keys = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in self.id_cols]
        grouped = df.groupBy(*flags, *keys).cogroup(self.trees.groupBy(*flags, *keys))
        return grouped.applyInPandas(score, schema)


def train_leafwise(
    df: DataFrame,
    features: Sequence[str],
    target: str = "revenue",
    id_cols: Sequence[str] = (),
    how: Boosting = Boosting(),
) -> LeafwiseScorer:
    """Squared-error boosting per entity, or over the whole series without ``id_cols``.

    Rows without a finite target are left out, and an entity without any has no trees. Null,
    NaN and infinite features are missing and go left. Rows are ordered by their values before any
    are drawn, so partitions and retries do not change the trees; repeated rows count each.
    """
    clash = {c.split()[0] for c in TREES.split(", ")} & set(id_cols)
    if clash or not features:
        raise ValueError(f"ids named like columns of the trees: {sorted(clash)}" if clash else "no features")
    names, inputs = list(features), [f"x{i}" for i in range(len(features))]
    y = F.col(target).cast("double")
    rows = df.filter(y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf"))).select(
        F.struct(*id_cols).alias("ids") if id_cols else F.lit(0).alias("ids"),
        *[F.col(f).cast("double").alias(x) for f, x in zip(names, inputs)],
        y.alias("y"),
    )
    rows = stage(rows, "leafwise")
    _bounded(rows, ["ids"], len(names))
    keys = [F.col(f"ids.{c}").alias(c) for c in id_cols]
    rows = rows.select(*keys, *inputs, "y")
    key_fields = [rows.schema[c] for c in id_cols]
    columns = [c.split()[0] for c in TREES.split(", ")]
    schema = StructType([*key_fields, *StructType.fromDDL(TREES).fields])

    def fit(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        nodes = pd.DataFrame(_boost(_numbers(part, inputs), part["y"].to_numpy(dtype=float), how), columns=columns)
        nodes["feature"] = [None if j < 0 else names[j] for j in nodes["feature"]]
        for whole in ("left", "right"):
            nodes[whole] = nodes[whole].astype("Int32")
        ids = part[list(id_cols)].iloc[:1].loc[lambda d: d.index.repeat(len(nodes))].reset_index(drop=True)
        return pd.concat([ids, nodes], axis=1)

    return LeafwiseScorer(stage(rows.groupBy(*id_cols).applyInPandas(fit, schema), "trees"), names, tuple(id_cols))


def gain_importance(scorer: LeafwiseScorer) -> DataFrame:
    """(ids, feature, importance, splits): total gain per feature and how often it splits, 0 where it never does."""
    rows = []
    for name in scorer.features:
        mine = F.col("feature") == name
        rows.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.coalesce(F.sum(F.when(mine, F.col("gain"))), F.lit(0.0)).alias("importance"),
                F.count(F.when(mine, 1)).alias("splits"),
            )
        )
    # Without ids the groupBy() has one row even over no trees; with them, one per entity that has trees.
    grouped = scorer.trees.groupBy(*scorer.id_cols).agg(F.array(*rows).alias("parts"))
    return grouped.select(*scorer.id_cols, F.inline("parts"))
