"""Boosted regression trees, grown leaf-wise on histograms that many fits share."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetric.session import settle

NODES = "fit int, tree int, node int, feature int, bin int, left int, right int, value double, gain double"
SPLIT = "fit int, node int, gain double, feature int, bin int, sum_left double, rows_left double"
LEAST_GAIN = 1e-15
# Cells of a joint table: at most so many, and at most one for so many rows.
MOST_CELLS, ROWS_A_CELL = 8192, 64
# Cells that are summed up at once.
AT_ONCE = 1 << 19
# Rows of a fit that travel to its task as one.
BLOCK = 16


@dataclass(frozen=True)
class Settings:
    # The settings that results are compared at.
    rounds: int = 300
    rate: float = 0.05
    max_depth: int = 6
    leaves: int = 31
    min_rows: int = 10
    column_share: float = 0.8
    l1: float = 0.1
    l2: float = 0.1
    seed: int = 42
    max_bins: int = 255


@dataclass(frozen=True)
class Fit:
    """One model to learn: its target and features by number, and the fold its rows leave out."""

    target: int
    features: tuple[int, ...]
    fold: int | None = None


@dataclass
class Tree:
    """Nodes by number, 0 the root; a leaf has feature -1. Bins up to ``bin`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    # Sum of gradients and number of rows of each node.
    total: list[float] = field(default_factory=lambda: [0.0])
    rows: list[float] = field(default_factory=lambda: [0.0])
    value: list[float] = field(default_factory=list)

    def split(self, node: int, gain: float, feature: int, bin: int, total_left: float, rows_left: float) -> list[int]:
        """Give a leaf two children; their numbers."""
        children = [len(self.feature), len(self.feature) + 1]
        self.feature[node], self.bin[node], self.gain[node] = feature, bin, gain
        self.left[node], self.right[node] = children
        sums = ((total_left, rows_left), (self.total[node] - total_left, self.rows[node] - rows_left))
        for total, rows in sums:
            for column, value in (
                (self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.gain, 0.0),
                (self.total, total), (self.rows, rows),
            ):
                column.append(value)
        return children

    def pruned(self, leaves: int) -> Tree:
        """The tree that splits the leaf of the highest gain until it has ``leaves``.

        A node's best split doesn't depend on the others, so growing all nodes
        first and choosing afterwards gives the same as growing leaf by leaf.
        """
        tree = Tree(total=[self.total[0]], rows=[self.rows[0]])
        ready = [(-self.gain[0], 0, 0)] if self.feature[0] >= 0 else []
        while ready and (len(tree.feature) + 1) // 2 < leaves:
            _, old, new = heapq.heappop(ready)
            left = self.left[old]
            children = tree.split(
                new, self.gain[old], self.feature[old], self.bin[old], self.total[left], self.rows[left]
            )
            for child, place in zip((left, self.right[old]), children):
                if self.feature[child] >= 0:
                    heapq.heappush(ready, (-self.gain[child], child, place))
        return tree

    def leaf_of(self, bins: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The node that each row of bins ends in, from the nodes ``at`` on."""
        feature, bin, left, right = (np.array(x, np.int64) for x in (self.feature, self.bin, self.left, self.right))
        leaf = feature < 0
        depth = np.zeros(len(leaf), int)
        for node in np.flatnonzero(~leaf):
            depth[[left[node], right[node]]] = depth[node] + 1
        # Leaves lead to themselves, so that all rows take as many steps.
        own = np.arange(len(leaf))
        feature, bin = np.where(leaf, 0, feature), np.where(leaf, 255, bin).astype(np.uint8)
        step = np.stack([np.where(leaf, own, left), np.where(leaf, own, right)], axis=1).ravel()
        cells, start = np.ascontiguousarray(bins).ravel(), np.arange(len(bins)) * bins.shape[1]
        at = np.zeros(len(bins), np.int64) if at is None else at
        for _ in range(depth.max()):
            goes_right = cells.take(feature.take(at) + start, mode="clip") > bin.take(at)
            at = step.take(2 * at + goes_right)
        return at


def score(total: np.ndarray, rows: np.ndarray, settings: Settings) -> np.ndarray:
    return np.maximum(np.abs(total) - settings.l1, 0.0) ** 2 / (rows + settings.l2)


def best_splits(
    sums: np.ndarray, counts: np.ndarray, allowed: np.ndarray, unit: float, settings: Settings
) -> list[tuple[float, int, int, float, float]]:
    """(gain, feature, bin, sum on the left, rows on the left) of each node's best split.

    ``sums`` and ``counts`` are by node, feature and bin; ``unit`` is one in
    sums of gradients. Ties go to the first feature, then to the first bin.
    """
    left, rows = np.cumsum(sums, axis=2), np.cumsum(counts, axis=2)
    total, n = left[:, :, -1:], rows[:, :, -1:]
    gain = (
        score(left * unit, rows, settings)
        + score((total - left) * unit, n - rows, settings)
        - score(total * unit, n, settings)
    )
    fits = (rows >= settings.min_rows) & (n - rows >= settings.min_rows) & allowed[None, :, None]
    gain = np.where(fits, gain, -np.inf).reshape(len(sums), -1)
    best = gain.argmax(axis=1)
    every = np.arange(len(sums))
    feature, bin = np.divmod(best, sums.shape[2])
    return list(
        zip(gain[every, best].tolist(), feature.tolist(), bin.tolist(),
            left[every, feature, bin].tolist(), rows[every, feature, bin].tolist())
    )


def allowed_features(fit: int, spec: Fit, tree: int, n_features: int, settings: Settings) -> np.ndarray:
    """The features that a tree may use: a share of the fit's own, drawn anew for each tree."""
    chosen = np.array(spec.features)
    if settings.column_share < 1:
        most = max(1, int(settings.column_share * len(chosen) + 0.5))
        chosen = np.random.default_rng([settings.seed, fit, tree]).permutation(chosen)[:most]
    allowed = np.zeros(n_features, bool)
    allowed[chosen] = True
    return allowed


def grown(tree: Tree, active: list[int], found: Sequence[tuple], settings: Settings) -> list[int]:
    """Split the active nodes; those of the next level that have rows enough to split."""
    children = []
    for node, (gain, *split) in zip(active, found):
        if gain > LEAST_GAIN:
            children += tree.split(node, gain, *split)
    return [c for c in children if tree.rows[c] >= 2 * settings.min_rows]


def valued(tree: Tree, unit: float, settings: Settings) -> Tree:
    """The tree with the values of its leaves."""
    total, rows = np.array(tree.total) * unit, np.array(tree.rows)
    shrunk = np.sign(total) * np.maximum(np.abs(total) - settings.l1, 0.0)
    tree.value = (-settings.rate * shrunk / (rows + settings.l2)).tolist()
    return tree


def histograms(
    columns: Sequence[np.ndarray], rows: np.ndarray | slice, place: np.ndarray, gradients: np.ndarray, n_nodes: int, n_bins: int
) -> tuple[np.ndarray, np.ndarray]:
    """Sums of gradients and numbers of rows by node, feature and bin.

    ``columns`` are the bins of each feature, ``place`` and ``gradients`` node
    and gradient of each of ``rows``. Gradients are whole numbers, so that sums
    are the same in any order.
    """
    size, start = n_nodes * n_bins, place * n_bins
    sums, counts = np.zeros((2, n_nodes, len(columns), n_bins))
    for i, column in enumerate(columns):
        index = start + column[rows]
        sums[:, i] = np.bincount(index, gradients, size).reshape(n_nodes, n_bins)
        counts[:, i] = np.bincount(index, minlength=size).reshape(n_nodes, n_bins)
    return sums, counts


def places(nodes: Sequence[int], active: Sequence[int], size: int) -> np.ndarray:
    """The position of each row's node among the active ones, -1 elsewhere."""
    lookup = np.full(size, -1)
    lookup[list(active)] = np.arange(len(active))
    return lookup[nodes]


def joint_tables(sizes: dict[int, int], most: int) -> list[list[int]]:
    """Features whose numbers of bins multiply to ``most`` at most; a feature of more is alone."""
    found, cells = [], []
    for f in sorted(sizes, key=lambda f: (-sizes[f], f)):
        for i, n in enumerate(cells):
            if n * sizes[f] <= most:
                found[i].append(f)
                cells[i] *= sizes[f]
                break
        else:
            found.append([f])
            cells.append(sizes[f])
    return found


def margins(table: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    """Sums over a joint table (the last axis) by the bins of each of its features."""
    if len(sizes) == 1:
        return [table]
    half = len(sizes) // 2
    grid = table.reshape(len(table), int(np.prod(sizes[:half])), -1)
    return margins(grid.sum(axis=2), sizes[:half]) + margins(grid.sum(axis=1), sizes[half:])


def joint_cells(bins: np.ndarray, tables: Sequence[Sequence[int]], sizes: dict[int, int]) -> np.ndarray:
    """The cell of each row of bins in each joint table."""
    cells = np.zeros((len(bins), len(tables)), np.uint16)
    for t, members in enumerate(tables):
        for f in members:
            cells[:, t] = cells[:, t] * np.uint16(sizes[f]) + bins[:, f]
    return cells


class JointRows:
    """The rows of one fit, each with a cell in a few joint tables of its features.

    Features of few bins share a table that has a cell for each of their
    combinations, so a row is summed up once for all of them. Sums by bin are
    those of the cells, exactly, as gradients are whole numbers.
    """

    def __init__(self, parts: list[np.ndarray], tables: Sequence[Sequence[int]], sizes: dict[int, int], n_bins: int):
        """``parts`` are of ``joint_cells``; they are used up."""
        self.tables, self.sizes, self.n_bins = tables, sizes, n_bins
        self.cells = np.empty((len(tables), sum(map(len, parts))), np.uint16)
        end = self.cells.shape[1]
        while parts:
            part = parts.pop()
            self.cells[:, end - len(part) : end] = part.T
            end -= len(part)
        # A feature's table, and the cells that one step of its bin is away.
        self.at = {
            f: (t, int(np.prod([sizes[g] for g in members[i + 1 :]], dtype=int)))
            for t, members in enumerate(tables)
            for i, f in enumerate(members)
        }

    def goes_left(self, rows: np.ndarray, feature: int, bin: int) -> np.ndarray:
        """Whether the feature's bin is ``bin`` at most, for each of ``rows``."""
        t, step = self.at[feature]
        n_cells = int(np.prod([self.sizes[f] for f in self.tables[t]]))
        side = np.arange(n_cells) // step % self.sizes[feature] <= bin
        return side.take(self.cells[t].take(rows, mode="clip"))

    def summed(self, chosen: Sequence[int], gradients: np.ndarray):
        """A function of rows: their sums of gradients and numbers, by chosen feature and bin."""
        place = {f: i for i, f in enumerate(chosen)}
        used = [t for t, members in enumerate(self.tables) if any(f in place for f in members)]
        sizes = [[self.sizes[f] for f in self.tables[t]] for t in used]
        ends = np.cumsum([0, *(int(np.prod(x)) for x in sizes)])
        cells = self.cells if len(used) == len(self.tables) else self.cells[used]
        step = max(1, AT_ONCE // max(1, len(used)))

        def add(rows: np.ndarray | None = None, counted: bool = True) -> np.ndarray:
            table = np.zeros((2, ends[-1]))
            for first in range(0, cells.shape[1] if rows is None else len(rows), step):
                if rows is None:
                    some = slice(first, first + step)
                    own, weights = cells[:, some], gradients[some]
                else:
                    some = rows[first : first + step]
                    own, weights = (x.take(some, axis=-1, mode="clip") for x in (cells, gradients))
                index = (own + ends[:-1, None]).ravel()
                table[0] += np.bincount(index, np.tile(weights, len(used)), ends[-1])
                if counted:
                    table[1] += np.bincount(index, minlength=ends[-1])
            found = np.zeros((2, len(chosen), self.n_bins))
            for t, own, first, end in zip(used, sizes, ends, ends[1:]):
                for f, sums in zip(self.tables[t], margins(table[:, first:end], own)):
                    if f in place:
                        found[:, place[f], : self.sizes[f]] = sums
            return found

        return add


def boost(
    rows: JointRows, y: np.ndarray, fit: int, spec: Fit, base: float, unit: float, n_features: int, settings: Settings
) -> Iterator[Tree]:
    """The trees of one fit over rows in memory.

    Grown leaf by leaf, so no node is summed up that ends without a split for
    want of leaves: ties go to the upper node, then to the left one, as among
    nodes in order of levels. Rows are kept sorted by node, and of two children
    only the smaller is summed up: the other has what is left of their parent,
    exactly, as gradients are whole numbers.
    """
    n = len(y)
    predicted, gradients, order = np.full(n, base), np.zeros(n), np.zeros(n, np.int64)
    every = np.arange(n_features)
    # All rows are in the root of each tree: numbers of rows by bin stay.
    counts = rows.summed(spec.features, gradients)()[1]
    whole = np.zeros((n_features, rows.n_bins))
    whole[list(spec.features)] = counts
    for number in range(settings.rounds):
        chosen = every[allowed_features(fit, spec, number, n_features, settings)]
        np.subtract(predicted, y, out=gradients)
        np.rint(np.divide(gradients, unit, out=gradients), out=gradients)
        add = rows.summed(chosen.tolist(), gradients)
        order[:] = np.arange(n)
        tree = Tree(total=[float(gradients.sum())], rows=[float(n)])
        spans, ready, leaves = [(0, n)], [], 1
        # Nodes to find a split for, with their way from the root and their sums.
        waiting = []
        if len(chosen) and settings.max_depth and settings.leaves > 1:
            waiting = [(0, "", np.stack([add(counted=False)[0], whole[chosen]]))]
        while waiting or ready:
            if waiting:
                sums, numbers = np.stack([own for *_, own in waiting], axis=1)
                found = best_splits(sums, numbers, np.ones(len(chosen), bool), unit, settings)
                for (node, way, own), (gain, f, *split) in zip(waiting, found):
                    if gain > LEAST_GAIN:
                        heapq.heappush(ready, (-gain, len(way), way, node, (int(chosen[f]), *split), own))
            if not ready or leaves == settings.leaves:
                break
            loss, depth, way, node, split, own = heapq.heappop(ready)
            children = tree.split(node, -loss, *split)
            leaves += 1
            first, end = spans[node]
            here = order[first:end]
            goes_left = rows.goes_left(here, *split[:2])
            left, right = here.compress(goes_left), here.compress(~goes_left)
            middle = first + len(left)
            order[first:middle], order[middle:end] = left, right
            spans += [(first, middle), (middle, end)]
            waiting = []
            if depth + 1 < settings.max_depth and leaves < settings.leaves:
                # A larger child has rows enough whenever the smaller has.
                small = min(children, key=lambda c: tree.rows[c])
                if max(tree.rows[c] for c in children) >= 2 * settings.min_rows:
                    few = add(order[slice(*spans[small])])
                    waiting = [
                        (c, way + side, few if c == small else own - few)
                        for c, side in zip(children, "01")
                        if tree.rows[c] >= 2 * settings.min_rows
                    ]
        tree = valued(tree, unit, settings)
        for feature, value, span in zip(tree.feature, tree.value, spans):
            if feature < 0:
                np.add.at(predicted, order[slice(*span)], value)
        yield tree


# --- models -------------------------------------------------------------------------------------


@dataclass
class BoostedModel:
    """Trees over named inputs; splits by value."""

    inputs: list[str]
    edges: list[np.ndarray]
    base: float
    trees: list[Tree]

    def predict(self, values: np.ndarray) -> np.ndarray:
        """Predictions for rows of input values."""
        bins = np.empty(values.shape, np.uint8)
        for i, edges in enumerate(self.edges):
            bins[:, i] = np.searchsorted(edges, values[:, i])
        found = np.full(len(values), self.base)
        for tree in self.trees:
            found += np.array(tree.value)[tree.leaf_of(bins)]
        return found

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """The rows with a prediction; the inputs are complete doubles."""
        sent = df.sparkSession.sparkContext.broadcast(self)

        def predict(rows: pd.Series) -> pd.Series:
            return pd.Series(sent.value.predict(np.stack(rows.to_numpy())) if len(rows) else [], dtype="float64")

        return df.withColumn(name, F.pandas_udf(predict, "double")(F.array(*[F.col(f"`{c}`") for c in self.inputs])))

    def importances(self, kind: str = "split") -> list[float]:
        """By input: how often it splits, or its share of the gain."""
        found = np.zeros(len(self.inputs))
        for tree in self.trees:
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    found[feature] += gain if kind == "gain" else 1
        return (found / found.sum() if kind == "gain" and found.sum() else found).tolist()

    def save(self, path: str) -> None:
        """Write inputs and nodes as tables below ``path``; their size is that of the settings."""
        spark = SparkSession.active()
        inputs = [(i, c, e.tolist(), self.base) for i, (c, e) in enumerate(zip(self.inputs, self.edges))]
        nodes = [
            (t, i, x.feature[i], x.bin[i], x.left[i], x.right[i], x.value[i], x.gain[i])
            for t, x in enumerate(self.trees)
            for i in range(len(x.feature))
        ]
        for name, rows, schema in (
            ("inputs", inputs, "place int, input string, edges array<double>, base double"),
            ("nodes", nodes, NODES.removeprefix("fit int, ")),
        ):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedModel:
        inputs = spark.read.parquet(f"{path}/inputs").orderBy("place").collect()
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect()
        return BoostedModel(
            [r.input for r in inputs], [np.array(r.edges) for r in inputs], inputs[0].base if inputs else 0.0,
            trees_of(nodes, range(len(inputs))),
        )


def trees_of(nodes: Sequence, numbers: Sequence[int]) -> list[Tree]:
    """Trees from rows of nodes in order; ``numbers`` are the features' places among the inputs."""
    place = {f: i for i, f in enumerate(numbers)}
    trees: list[Tree] = []
    for r in nodes:
        if r.tree == len(trees):
            trees.append(Tree([], [], [], [], [], [], [], []))
        tree = trees[r.tree]
        for column, value in (
            (tree.feature, place[r.feature] if r.feature >= 0 else -1), (tree.bin, r.bin), (tree.left, r.left),
            (tree.right, r.right), (tree.value, r.value), (tree.gain, r.gain),
        ):
            column.append(value)
    return trees


# --- fitting on Spark ---------------------------------------------------------------------------


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int) -> list[np.ndarray]:
    """Upper ends of each feature's bins but the last: its different values, or quantiles of them; one pass."""
    shares = ", ".join(f"{i / max_bins:.6f}D" for i in range(1, max_bins + 1))
    found = df.agg(
        *[F.expr(f"percentile_approx(`{c}`, array({shares}), 10000)").alias(f"_{i}") for i, c in enumerate(features)]
    ).first()
    return [np.unique(np.array(x or [0.0], float))[:-1] for x in found]


def binned(df: DataFrame, features: Sequence[str], targets: Sequence[str], fold: Column, edges: list[np.ndarray]) -> DataFrame:
    """fold, y (the targets) and bins, a byte for each feature."""

    def to_bins(batches):
        for batch in batches:
            x = batch.column("x").values.to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(edges))
            bins = np.empty(x.shape, np.uint8)
            for i, e in enumerate(edges):
                bins[:, i] = np.searchsorted(e, x[:, i])
            column = pa.array([row.tobytes() for row in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("fold"), batch.column("y"), column], ["fold", "y", "bins"])

    rows = df.select(
        F.coalesce(fold.cast("int"), F.lit(-1)).alias("fold"),
        F.array(*[F.col(f"`{t}`").cast("double") for t in targets]).alias("y"),
        F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("x"),
    )
    return settle(rows.mapInArrow(to_bins, "fold int, y array<double>, bins binary"), "binned")


def uses(spec: Fit) -> Column:
    """Whether a row of ``binned`` belongs to the fit's rows."""
    inside = F.lit(True) if spec.fold is None else F.col("fold") != spec.fold
    return inside & F.col("y")[spec.target].isNotNull()


def starts(rows: DataFrame, fits: Sequence[Fit]) -> tuple[list[float], list[float]]:
    """The mean of each fit's target, and the unit its gradients are rounded to; one pass.

    The unit is a power of two so small that rounding hardly matters, and so
    large that sums over all rows, whatever their order, stay exact.
    """
    sums = rows.agg(
        *[
            F.struct(F.avg(y), F.count(y), F.max(F.abs(y)))
            for y in (F.when(uses(f), F.col("y")[f.target]) for f in fits)
        ]
    ).first()
    bases, units = [], []
    for mean, n, most in sums:
        bases.append(mean or 0.0)
        reach = 8 * max(n, 1) * max((most or 0.0) + abs(mean or 0.0), 1e-300)
        units.append(2.0 ** float(np.ceil(np.log2(reach)) - 52))
    return bases, units


def fit_many(
    df: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    fits: Sequence[Fit],
    fold: Column | None = None,
    settings: Settings = Settings(),
    small_bytes: int = 256 << 20,
) -> list[BoostedModel]:
    """A model for each fit, all from one table of binned rows.

    Features are complete doubles. Rows without the target are left out. The
    bins, from one quantile sketch a column, are shared by all fits. While rows
    times features stay below ``small_bytes``, each fit grows its trees in a task
    of its own, over its rows, which take about twice that memory; beyond it, every level of a round is one job
    for all fits: partial histograms by task, summed by (fit, node, feature, bin),
    of which only each node's best split reaches the driver. Both ways give the
    same trees. A fit without rows predicts 0.
    """
    edges = bin_edges(df, features, min(settings.max_bins, 256))
    rows = binned(df, features, targets, F.lit(-1) if fold is None else fold, edges)
    bases, units = starts(rows, fits)
    n_bins = [len(e) + 1 for e in edges]
    if rows.count() * len(features) <= small_bytes:
        trees = fit_in_tasks(rows, len(features), n_bins, fits, bases, units, settings)
    else:
        trees = fit_by_levels(rows, len(features), max(n_bins, default=1), fits, bases, units, settings)
    models = []
    for spec, base, own in zip(fits, bases, trees):
        numbers = list(spec.features)
        place = {f: i for i, f in enumerate(numbers)}
        own = [replace(t, feature=[place.get(f, -1) for f in t.feature]) for t in own]
        models.append(BoostedModel([features[i] for i in numbers], [edges[i] for i in numbers], base, own))
    return models


def blocks(values: np.ndarray) -> pa.Array:
    """The bytes of an array's rows, ``BLOCK`` rows at a time."""
    values = np.ascontiguousarray(values)
    ends = np.append(np.arange(0, len(values), BLOCK), len(values)) * (values.nbytes // len(values))
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)


def fit_in_tasks(rows, n_features, n_bins: Sequence[int], fits, bases, units, settings) -> list[list[Tree]]:
    """Each fit in one task, the ones of most features first: the rows are few, as ``fit_many`` has checked.

    ``n_bins`` are by feature.
    """

    n = rows.count()
    sizes = dict(enumerate(n_bins))
    most = min(MOST_CELLS, n // ROWS_A_CELL)
    tables = [joint_tables({f: sizes[f] for f in spec.features}, most) for spec in fits]

    def pack(batches):
        """The cells of each fit's rows, and its target."""
        for batch in batches:
            bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, n_features)
            values = batch.column("y").flatten()
            y = values.to_numpy(zero_copy_only=False).reshape(len(bins), -1)
            known = values.is_valid().to_numpy(zero_copy_only=False).reshape(len(bins), -1)
            fold = batch.column("fold").to_numpy()
            for i, spec in enumerate(fits):
                use = known[:, spec.target] if spec.fold is None else known[:, spec.target] & (fold != spec.fold)
                if use.any():
                    own = [blocks(x) for x in (joint_cells(bins[use], tables[i], sizes), y[use, spec.target])]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own[0]), i, np.int32)), *own], ["fit", "cells", "y"])

    def grow(batches):
        parts: dict[int, list] = {}
        for batch in batches:
            for fit in batch.column("fit").unique().to_pylist():
                own = batch.filter(pc.equal(batch.column("fit"), fit))
                cells, y = (b"".join(own.column(c).to_pylist()) for c in ("cells", "y"))
                all_cells, all_y = parts.setdefault(fit, ([], []))
                all_cells.append(np.frombuffer(cells, np.uint16).reshape(-1, len(tables[fit])))
                all_y.append(np.frombuffer(y))
        for fit in list(parts):
            all_cells, all_y = parts.pop(fit)
            given, y = JointRows(all_cells, tables[fit], sizes, max(n_bins)), np.concatenate(all_y)
            all_y.clear()
            found = [
                (fit, t, i, x.feature[i], x.bin[i], x.left[i], x.right[i], x.value[i], x.gain[i])
                for t, x in enumerate(boost(given, y, fit, fits[fit], bases[fit], units[fit], n_features, settings))
                for i in range(len(x.feature))
            ]
            if found:
                names = [c.split()[0] for c in NODES.split(", ")]
                kinds = [pa.int32()] * 7 + [pa.float64()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(list(v), k) for k, v in zip(kinds, zip(*found))], names)

    packed = rows.mapInArrow(pack, "fit int, cells binary, y binary")
    rank = sorted(range(len(fits)), key=lambda i: -len(fits[i].features))
    place = F.array_position(F.lit(rank), F.col("fit")).cast("int") - 1
    nodes = packed.repartitionById(max(1, len(fits)), place).mapInArrow(grow, NODES).collect()
    by_fit: list[list] = [[] for _ in fits]
    for r in sorted(nodes, key=lambda r: (r.fit, r.tree, r.node)):
        by_fit[r.fit].append(r)
    return [trees_of(own, range(n_features)) for own in by_fit]


def fit_by_levels(rows, n_features, n_bins, fits, bases, units, settings, keep: int = 16) -> list[list[Tree]]:
    """All fits together, a job a level; predictions are written anew every ``keep`` rounds."""
    spark = rows.sparkSession
    done: list[list[Tree]] = [[] for _ in fits]
    first = 0

    def columns_of(batch):
        bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, n_features)
        y = np.array(batch.column("y").to_pylist(), float).reshape(len(bins), -1)
        return bins, y, batch.column("fold").to_numpy()

    def predictions(batch, bins, recent):
        if "scores" in batch.schema.names:
            scores = np.frombuffer(b"".join(batch.column("scores").to_pylist())).reshape(len(bins), -1).copy()
        else:
            scores = np.tile(np.array(bases), (len(bins), 1))
        for i, trees in enumerate(recent):
            for tree in trees:
                scores[:, i] += np.array(tree.value)[tree.leaf_of(bins)]
        return scores

    def with_scores(recent):
        def advance(batches):
            for batch in batches:
                scores = predictions(batch, columns_of(batch)[0], recent)
                column = pa.array([s.tobytes() for s in scores], pa.binary())
                names = ["fold", "y", "bins"]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], column], [*names, "scores"])

        return advance

    def partial_sums(sent):
        """Sums of each task by fit, node, feature and bin; feature -1 holds those of the root."""

        def add(batches):
            recent, trees, active = sent.value
            sums: dict[int, list[np.ndarray]] = {}
            for batch in batches:
                bins, y, fold = columns_of(batch)
                scores = predictions(batch, bins, recent)
                columns = np.ascontiguousarray(bins.T)
                for i, spec in enumerate(fits):
                    if not active[i]:
                        continue
                    use = ~np.isnan(y[:, spec.target])
                    if spec.fold is not None:
                        use &= fold != spec.fold
                    place = np.full(len(bins), -1)
                    place[use] = places(trees[i].leaf_of(bins[use]), active[i], len(trees[i].feature))
                    here = np.flatnonzero(place >= 0)
                    gradients = np.rint((scores[here, i] - y[here, spec.target]) / units[i])
                    part = histograms(columns, here, place[here], gradients, len(active[i]), n_bins)
                    sums[i] = [a + b for a, b in zip(sums[i], part)] if i in sums else list(part)
            for i, (total, count) in sums.items():
                node, feature, bin = np.nonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(node), i, np.int32)), pa.array(np.array(active[i], np.int32)[node]),
                        pa.array(feature.astype(np.int32)), pa.array(bin.astype(np.int32)),
                        pa.array(total[node, feature, bin]), pa.array(count[node, feature, bin]),
                    ],
                    ["fit", "node", "feature", "bin", "total", "n"],
                )

        return add

    def best_of(number):
        def best(key: tuple, table: pa.Table) -> pa.Table:
            fit, node = (k.as_py() for k in key)
            shape = (1, n_features, n_bins)
            sums, counts = np.zeros(shape), np.zeros(shape)
            at = (0, table.column("feature").to_numpy(), table.column("bin").to_numpy())
            sums[at], counts[at] = table.column("total").to_numpy(), table.column("n").to_numpy()
            allowed = allowed_features(fit, fits[fit], number, n_features, settings)
            (found,) = best_splits(sums, counts, allowed, units[fit], settings)
            values = (fit, node, *found)
            root = (fit, -1, 0.0, -1, -1, float(sums[0, 0].sum()), float(counts[0, 0].sum()))
            names = [c.split()[0] for c in SPLIT.split(", ")]
            kinds = [pa.int32()] * 2 + [pa.float64()] + [pa.int32()] * 2 + [pa.float64()] * 2
            return pa.table({c: pa.array(list(v), k) for c, k, v in zip(names, kinds, zip(values, root))})

        return best

    for number in range(settings.rounds):
        if number and number % keep == 0:
            recent = [trees[first:] for trees in done]
            schema = "fold int, y array<double>, bins binary, scores binary"
            rows, first = settle(rows.mapInArrow(with_scores(recent), schema), "scores"), number
        trees = [Tree() for _ in fits]
        active: list[list[int]] = [[0] for _ in fits]
        for depth in range(settings.max_depth):
            if not any(active):
                break
            sent = spark.sparkContext.broadcast(([t[first:] for t in done], trees, active))
            sums = rows.mapInArrow(
                partial_sums(sent), "fit int, node int, feature int, bin int, total double, n double"
            )
            sums = sums.groupBy("fit", "node", "feature", "bin").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
            found = sums.groupBy("fit", "node").applyInArrow(best_of(number), SPLIT).collect()
            splits = {(r.fit, r.node): r for r in found}
            for i, tree in enumerate(trees):
                if not depth and (i, -1) in splits:
                    tree.total, tree.rows = [splits[i, -1].sum_left], [splits[i, -1].rows_left]
                none = (-np.inf, 0, 0, 0.0, 0.0)
                best = [tuple(splits[i, a])[2:] if (i, a) in splits else none for a in active[i]]
                active[i] = grown(tree, active[i], best, settings)
        for i, tree in enumerate(trees):
            done[i].append(valued(tree.pruned(settings.leaves), units[i], settings))
    return done
