"""Gradient boosting on binned features, every tree grown by sums over all rows.

Features are binned once, by merged quantile summaries, into a byte a value. Rows are packed into blocks of bytes, a file
in the checkpoint folder, which every later job reads from executor memory. A level of a tree is
one job: each block adds up gradients by node, feature and bin, and the
driver, which sees nothing but those sums, picks the splits by second-order gain. Of two siblings only the smaller
one is summed: the other is what its parent has left, and the leaves follow from the last splits, so a tree takes as many
jobs as it has levels above its leaves. The rows' own predictions stay in their blocks and are brought up to date by the
first job of the next tree.

What fits one block is boosted whole in the task that holds it, by the same functions: the same trees without a job
per level. Gradients are whole numbers (fixed point), so sums do not depend on the order of addition and a
lost executor or another number of tasks leads to the same trees.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlife.cluster import ensure_checkpoint_dir, stored

# Default training parameters.
DEFAULTS = {"rounds": 500, "depth": 6, "step": 0.05, "row_share": 0.8, "column_share": 0.8, "seed": 42}
#: Bins of a feature; the last one holds missing values, which count as larger than any.
BINS = 64
BLOCK_ROWS = 262_144
#: Share of a block's rows is drawn anew per tree; weights of leaves are held towards 0 by this many rows.
RIDGE, LEAST_ROWS = 1.0, 1.0
#: Steps of a gradient per unit of the largest target.
FIXED = 1 << 20
#: Trees after which the rows' predictions are written down, so that lost ones are made again from few trees.
KEEP_EVERY = 25
DEEPEST = 12
#: Up to this number of tasks their sums go to the driver at once; of more they are merged in a tree of tasks.
DIRECT_TASKS = 64


@dataclass
class Tree:
    """A full binary tree by levels: node i has the children 2 i + 1 and 2 i + 2; feature -1 is a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    def leaves(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Node of each row; ``bins`` has a row of bytes per feature."""
        n, split = bins.shape[1], self.feature >= 0
        nodes, rows, flat = np.arange(len(split)), np.arange(n), np.ascontiguousarray(bins).reshape(-1)
        # A leaf is its own left child, and nothing is to the right of it.
        place, last, left = np.where(split, self.feature, 0) * n, np.where(split, self.bin, BINS), np.where(split, 2 * nodes + 1, nodes)
        at = np.zeros(n, np.int64)
        for _ in range(depth if n else 0):
            at = left.take(at) + (flat.take(place.take(at) + rows) > last.take(at))
        return at


@dataclass
class BoostedModel:
    """Trees over named features. ``losses``: mean squared training error before each round, then after the last."""

    features: list
    cuts: list
    base: float
    depth: int
    trees: list = field(default_factory=list)
    losses: list = field(default_factory=list)

    def binned(self, columns) -> np.ndarray:
        return np.stack([bins_of(np.asarray(c, float), cut) for c, cut in zip(columns, self.cuts, strict=True)])

    def scores(self, columns) -> np.ndarray:
        """Predictions for one array per feature."""
        bins = self.binned(columns)
        out = np.full(bins.shape[1], self.base)
        for tree in self.trees:
            out += tree.value[tree.leaves(bins, self.depth)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """The frame with a ``prediction`` column, scored in Arrow batches."""
        told = df.sparkSession.sparkContext.broadcast(self)
        names = [f"f{i}" for i in range(len(self.features))]

        @F.pandas_udf("double")
        def predicted(rows):
            import pandas as pd

            return pd.Series(told.value.scores([rows[name].to_numpy(dtype="float64", na_value=np.nan) for name in names]))

        inputs = (F.col(f"`{c}`").cast("double").alias(name) for c, name in zip(self.features, names, strict=True))
        return df.withColumn("prediction", predicted(F.struct(*inputs)))

    def save(self, path: str, spark: SparkSession) -> None:
        """Two tables: a row per node, and a row per feature."""
        nodes = [
            (t, i, int(tree.feature[i]), int(tree.bin[i]), float(tree.value[i]))
            for t, tree in enumerate(self.trees)
            for i in range(len(tree.feature))
        ]
        rows = [(i, name, [float(c) for c in cut]) for i, (name, cut) in enumerate(zip(self.features, self.cuts, strict=True))]
        spark.createDataFrame(nodes, "tree int, node int, feature int, bin int, value double").coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame(rows, "place int, feature string, cuts array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
        # Written last: a folder without it holds no whole model.
        head = [(self.base, self.depth, [float(x) for x in self.losses])]
        spark.createDataFrame(head, "base double, depth int, losses array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/boosted")


def load(spark: SparkSession, path: str) -> BoostedModel:
    head = spark.read.parquet(f"{path}/boosted").first()
    rows = spark.read.parquet(f"{path}/features").orderBy("place").collect()
    nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toArrow()
    count = 2 ** (head.depth + 1) - 1
    columns = [np.asarray(nodes[name]).reshape(-1, count) for name in ("feature", "bin", "value")]
    trees = [Tree(*parts) for parts in zip(*columns, strict=True)]
    return BoostedModel([r.feature for r in rows], [np.array(r.cuts, float) for r in rows], head.base, head.depth, trees, list(head.losses))


def bins_of(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Bin b holds the values up to the b-th cut; missing ones are in the last bin."""
    out = np.searchsorted(cuts, values, "left").astype(np.uint8)
    out[np.isnan(values)] = BINS - 1
    return out


def quantile_cuts(train: DataFrame, features) -> list[np.ndarray]:
    """Ascending cuts per feature at equal shares of its rows, from summaries that tasks merge."""
    shares = [i / (BINS - 1) for i in range(1, BINS - 1)]
    value = [F.col(f"`{c}`").cast("double") for c in features]
    row = train.agg(*(F.percentile_approx(F.when(~F.isnan(v), v), shares, 10_000).alias(f"q{i}") for i, v in enumerate(value))).first()
    return [np.unique(np.array(row[i] or [], float)) for i in range(len(value))]


def packed(train: DataFrame, features, target: str, cuts) -> DataFrame:
    """Blocks of rows: (n, target, bins) with the targets and, feature by feature, the bins as bytes."""

    def pack(batches):
        held, rows = [], 0

        def block():
            y = np.concatenate([h[0] for h in held])
            bins = np.concatenate([h[1] for h in held], axis=1)
            return pa.record_batch([pa.array([len(y)]), pa.array([y.tobytes()]), pa.array([bins.tobytes()])], ["n", "target", "bins"])

        for batch in batches:
            columns = [np.asarray(c.to_numpy(zero_copy_only=False), float) for c in batch.columns]
            held.append((columns[0], np.stack([bins_of(c, cut) for c, cut in zip(columns[1:], cuts, strict=True)])))
            rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                yield block()
                held, rows = [], 0
        if rows:
            yield block()

    inputs = train.select(F.col(target).cast("double").alias("y"), *(F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)))
    return inputs.where("y IS NOT NULL").mapInArrow(pack, "n long, target binary, bins binary")


def best_splits(sums: np.ndarray, counts: np.ndarray, allowed: np.ndarray, scale: float):
    """(feature, bin, gain) of each node, from gradient sums and counts by (node, feature, bin); feature -1: none.

    Ties go to the first feature and the lowest bin.
    """
    g, n = np.cumsum(sums, axis=2) / scale, np.cumsum(counts, axis=2).astype(float)
    whole_g, whole_n = g[:, :1, -1:], n[:, :1, -1:]
    right_g, right_n = whole_g - g, whole_n - n
    gain = g**2 / (n + RIDGE) + right_g**2 / (right_n + RIDGE) - whole_g**2 / (whole_n + RIDGE)
    possible = (n >= LEAST_ROWS) & (right_n >= LEAST_ROWS) & allowed[None, :, None]
    gain = np.where(possible, gain, -np.inf).reshape(len(sums), -1)
    best = gain.argmax(axis=1)
    top = gain[np.arange(len(sums)), best]
    feature, at = np.divmod(best, sums.shape[2])
    return np.where(top > 1e-9, feature, -1), at, top


def _sums(y, bins, margin, tree, level, asked, drawn, scale):
    """(gradient sums, counts) by node, feature and bin for the nodes ``asked`` of a level, and the squared error of all rows (level 0 only)."""
    squared = 0
    if level:
        slots = np.full(2 ** (level + 1) - 1, -1)
        slots[2**level - 1 + asked] = np.arange(len(asked))
        slot = slots.take(tree.leaves(bins, level))
        on = np.flatnonzero(drawn & (slot >= 0))
        node, gradient = slot[on] * BINS, np.rint((margin[on] - y[on]) * scale)
    else:
        gradient, on = np.rint((margin - y) * scale), np.flatnonzero(drawn)
        squared = int(np.rint((gradient / scale * 1024) ** 2).sum())
        node, gradient = np.zeros(len(on), np.int64), gradient[on]
    shape = (len(bins), len(asked), BINS)
    sums, counts = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
    for f in range(len(bins)):
        at = node + bins[f].take(on)
        sums[f] = np.bincount(at, gradient, len(asked) * BINS).astype(np.int64).reshape(shape[1:])
        counts[f] = np.bincount(at, minlength=len(asked) * BINS).reshape(shape[1:])
    return sums.swapaxes(0, 1), counts.swapaxes(0, 1), squared


def grow(level_sums, features: int, depth: int, step: float, allowed: np.ndarray, scale: float):
    """A tree from ``level_sums(tree, level, nodes)``, which gives sums over all rows of these nodes; and the squared error before it."""
    count = 2 ** (depth + 1) - 1
    tree = Tree(np.full(count, -1), np.zeros(count, np.int64), np.zeros(count))
    sums, counts, error = level_sums(tree, 0, np.zeros(1, np.int64))
    g, n = sums[:, 0].sum(axis=1), counts[:, 0].sum(axis=1)
    for level in range(depth + 1):
        own = slice(2**level - 1, 2 ** (level + 1) - 1)
        tree.value[own] = np.where(n > 0, -step * (g / scale) / (n + RIDGE), 0.0)
        if level == depth:
            break
        if level:
            # The other sibling has what the parent has left: whole numbers, so nothing is lost.
            smaller = 2 * parents + (n[2 * parents + 1] < n[2 * parents])
            part_sums, part_counts, _ = level_sums(tree, level, smaller)
            whole_sums, whole_counts = sums[parents], counts[parents]
            sums, counts = (np.zeros((2**level, features, BINS), np.int64) for _ in range(2))
            sums[smaller], counts[smaller] = part_sums, part_counts
            sums[smaller ^ 1], counts[smaller ^ 1] = whole_sums - part_sums, whole_counts - part_counts
        feature, at, _ = best_splits(sums, counts, allowed, scale)
        tree.feature[own], tree.bin[own] = np.where(n > 0, feature, -1), at
        parents = np.flatnonzero(tree.feature[own] >= 0)
        if not len(parents):
            break
        upto = np.arange(BINS) <= at[parents, None]
        whole_g, whole_n = g[parents], n[parents]
        g, n = np.zeros(2 ** (level + 1), np.int64), np.zeros(2 ** (level + 1), np.int64)
        for children, by in ((g, sums), (n, counts)):
            children[2 * parents] = (by[parents, feature[parents]] * upto).sum(axis=1)
        g[2 * parents + 1], n[2 * parents + 1] = whole_g - g[2 * parents], whole_n - n[2 * parents]
    return tree, error


def _drawn(y: np.ndarray, number: int, p: dict) -> np.ndarray:
    """Rows of a block that a round learns from, drawn by the block's content: the same at every level and trial."""
    seed = (p["seed"], number, len(y), int(y[:64].sum() * 16) & 0xFFFFFFFF)
    return np.random.default_rng(seed).random(len(y)) < p["row_share"]


def _columns(features: int, p: dict):
    """Which features each round may split on."""
    pick = np.random.default_rng(p["seed"])
    for _ in range(p["rounds"]):
        allowed = np.zeros(features, bool)
        allowed[pick.permutation(features)[: max(1, round(p["column_share"] * features))]] = True
        yield allowed


def _alone(y: np.ndarray, bins: np.ndarray, base: float, p: dict, scale: float):
    """(trees, losses) of all rounds on one block."""
    margin, trees, losses = np.full(len(y), base), [], []
    for number, allowed in enumerate(_columns(len(bins), p)):
        drawn = _drawn(y, number, p)

        def level_sums(tree, level, asked, margin=margin, drawn=drawn):
            return _sums(y, bins, margin, tree, level, asked, drawn, scale)

        tree, error = grow(level_sums, len(bins), p["depth"], p["step"], allowed, scale)
        margin = margin + tree.value[tree.leaves(bins, p["depth"])]
        trees.append(tree)
        losses.append(error / 1024**2 / len(y))
    return trees, [*losses, float(((margin - y) ** 2).mean())]


def _together(blocks, base: float, rows: int, features: int, p: dict, scale: float):
    """The same on many blocks (target, bins): a job for every level."""
    now, before = blocks.map(lambda x: (*x, np.full(len(x[0]), base))).persist(StorageLevel.MEMORY_AND_DISK), None
    deep = 1 if now.getNumPartitions() <= DIRECT_TASKS else 2
    trees, losses = [], []
    for number, allowed in enumerate(_columns(features, p)):

        def level_sums(tree, level, asked, now=now, number=number):
            def block(x):
                y, bins, margin = x
                return _sums(y, bins, margin, tree, level, asked, _drawn(y, number, p), scale)

            return now.map(block).treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1], a[2] + b[2]), deep)

        tree, error = grow(level_sums, features, p["depth"], p["step"], allowed, scale)
        if before is not None:
            before.unpersist()  # the first job of this tree has made the next ones
        trees.append(tree)
        losses.append(error / 1024**2 / rows)
        before = now
        now = now.map(lambda x, tree=tree: (x[0], x[1], x[2] + tree.value[tree.leaves(x[1], p["depth"])])).persist(StorageLevel.MEMORY_AND_DISK)
        if (number + 1) % KEEP_EVERY == 0:
            now.checkpoint()
    left = now.map(lambda x: float(((x[2] - x[0]) ** 2).sum())).sum()
    before.unpersist()
    now.unpersist()
    return trees, [*losses, left / rows]


def fit(train: DataFrame, features, target: str = "RUL", **parameters) -> BoostedModel:
    """Train on all rows that have a target; null and NaN features are missing.

    Parameters as in DEFAULTS. Every round draws ``row_share`` of the rows and
    ``column_share`` of the features. What a task sends is bounded by nodes, features and bins.
    """
    unknown = set(parameters) - set(DEFAULTS)
    p = {**DEFAULTS, **parameters}
    features = list(features)
    if unknown or not features or not 1 <= p["depth"] <= DEEPEST or p["rounds"] < 1:
        raise ValueError(f"unknown parameters {sorted(unknown)}, no features or rounds, or a depth beyond 1 to {DEEPEST}")
    ensure_checkpoint_dir(train.sparkSession)
    cuts = quantile_cuts(train, features)
    known = train.where(F.col(target).isNotNull()).agg(F.count("*"), F.avg(target), F.max(F.abs(F.col(target)))).first()
    model = BoostedModel(features, cuts, float(known[1] or 0.0), p["depth"])
    if not known[0]:
        return model
    # Few rows need few tasks; many keep the tasks that read them.
    blocks = stored(packed(train.coalesce(max(1, -(-known[0] // BLOCK_ROWS))), features, target, cuts))
    scale, base, count = FIXED / max(1.0, float(known[2])), model.base, len(features)

    def opened(row):
        y = np.frombuffer(row.target, float)
        return y, np.frombuffer(row.bins, np.uint8).reshape(count, len(y))

    opened_blocks = blocks.select("target", "bins").rdd.map(opened)
    if blocks.count() == 1:
        model.trees, model.losses = opened_blocks.map(lambda x: _alone(*x, base, p, scale)).first()
    else:
        model.trees, model.losses = _together(opened_blocks, base, known[0], count, p, scale)
    return model
