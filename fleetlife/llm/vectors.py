"""Near-duplicate vectors by an inverted multi-index.

Each half of a vector has a codebook of its own; pairs of code words form a grid of cells.
Every vector is indexed in the cell of its nearest code words, and visits the cells nearest to it
in the order of the multi-sequence traversal, which walks the two sorted lists of distances
together. The codebooks come from a bounded sample; the number of cells visited is where vectors
just as similar as the threshold are met with the target recall, measured on the
sample. All vectors met are verified in double precision.

Equal vectors are one class. A cell is dealt to blocks of bounded size, compared as matrix
products; a block returns counts and a spanning tree of what is linked in it, not pairs.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.llm.graph import components
from fleetlife.llm.store import stored

#: Vectors at most in the sample that codebooks and traversal are fitted on.
SAMPLE = 10_000
#: Vectors wanted in a cell, and at most in each side of a block, about.
CELL, BLOCK = 1_000, 2_000
MOST_CODES = 256
TARGET_RECALL = 0.99


def _codebook(x, count, rounds=8):
    """k-means from spread-out starts; deterministic."""
    pick = np.random.default_rng(3)
    centres = x[pick.choice(len(x), count, replace=len(x) < count)].copy()
    for _ in range(rounds):
        near = (-2 * x @ centres.T + (centres**2).sum(1)).argmin(1)
        sums, sizes = np.zeros_like(centres), np.bincount(near, minlength=count)
        np.add.at(sums, near, x)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


class MultiIndex:
    """Codebooks of one dimension, and how many cells a vector visits."""

    def __init__(self, sample, codes, least_cosine):
        self.half, self.codes = sample.shape[1] // 2, codes
        self.books = [_codebook(sample[:, : self.half], codes), _codebook(sample[:, self.half :], codes)]
        self.visits = codes * codes
        self.visits = self._calibrated(sample[:1_000], least_cosine)

    def distances(self, x):
        parts = x[:, : self.half], x[:, self.half :]
        return [((p**2).sum(1)[:, None] - 2 * p @ b.T + (b**2).sum(1)) for p, b in zip(parts, self.books)]

    def home(self, x):
        first, second = self.distances(x)
        return first.argmin(1) * self.codes + second.argmin(1)

    def traversal(self, first, second, count):
        """The ``count`` cells with the smallest sums of distances, by the multi-sequence algorithm."""
        a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        heap, pushed, out = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}, []
        while heap and len(out) < count:
            _, i, j = heapq.heappop(heap)
            out.append(int(a[i]) * self.codes + int(b[j]))
            for k, l in ((i + 1, j), (i, j + 1)):
                if k < self.codes and l < self.codes and (k, l) not in pushed:
                    pushed.add((k, l))
                    heapq.heappush(heap, (first[a[k]] + second[b[l]], k, l))
        return out

    def _calibrated(self, sample, least):
        """Cells to visit so that vectors at the threshold are met with the target recall."""
        noise = np.random.default_rng(4).normal(size=sample.shape)
        noise -= (noise * sample).sum(1, keepdims=True) * sample
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
        other = least * sample + np.sqrt(1 - least * least) * noise
        first, second = self.distances(sample)
        cells = (first[:, :, None] + second[:, None, :]).reshape(len(sample), -1)
        ranks = (cells < cells[np.arange(len(sample)), self.home(other)][:, None]).sum(1)
        return int(np.sort(ranks)[min(len(ranks) - 1, int(TARGET_RECALL * len(ranks)))]) + 1


def _unit(column):
    x = np.array(column, np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit(classes: DataFrame, least: float) -> dict[int, MultiIndex]:
    """An index for each dimension that the sample holds; other dimensions have a single cell."""
    count, labels = classes.agg(F.count("*"), F.count_distinct("label")).first()
    sample = classes.orderBy(F.xxhash64("class_id"), "class_id").limit(SAMPLE).select("embedding").collect()
    codes = int(min(MOST_CODES, max(2, np.ceil(np.sqrt(count / max(1, labels) / CELL)))))
    found = {}
    for size in sorted({len(r[0]) for r in sample}):
        own = _unit([r[0] for r in sample if len(r[0]) == size])
        if size > 1 and len(own) > 1:
            found[size] = MultiIndex(own, codes, least)
    return found


def _placed(indexes):
    def run(batches):
        for batch in batches:
            vectors = batch.column(2).to_pylist()
            homes, visits = [0] * len(vectors), [[0]] * len(vectors)
            for size in {len(v) for v in vectors}:
                if index := indexes.get(size):
                    rows = [i for i, v in enumerate(vectors) if len(v) == size]
                    x = _unit([vectors[i] for i in rows])
                    first, second = index.distances(x)
                    for i, home, a, b in zip(rows, index.home(x).tolist(), first, second):
                        homes[i], visits[i] = home, index.traversal(a, b, index.visits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(homes, pa.int32()), pa.array(visits, pa.list_(pa.int32()))], names=["class_id", "label", "embedding", "copies", "home", "visits"])

    return run


def _compared(least):
    def run(block: pa.Table) -> pa.Table:
        ids, vectors = block["class_id"].to_numpy(), block["embedding"].to_pylist()
        copies, indexed = block["copies"].to_numpy(), block["indexed"].to_numpy()
        x = _unit(vectors)
        rows, asked = np.flatnonzero(indexed), np.flatnonzero(~indexed)
        linked = x[asked] @ x[rows].T >= least
        linked &= ids[asked][:, None] != ids[rows][None, :]
        counts = linked @ copies[rows].astype(np.float64)
        has = linked.any(1)
        used = linked.any(0)
        # Who is found by a vector whose home it does not visit gets the link as well.
        homes, visits = block["home"].to_numpy()[asked], block["visits"].to_pylist()
        credit = np.zeros(len(rows))
        for j in np.flatnonzero(used).tolist():
            unseen = linked[:, j] & ~np.isin(homes, visits[rows[j]])
            credit[j] = copies[asked][unseen].sum()
        owed = credit > 0
        nodes, targets = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if has.any():
            near = linked[has][:, used]
            a, b = ids[asked][has].copy(), ids[rows][used].copy()
            own_a, own_b = a.copy(), b.copy()
            top = np.iinfo(np.int64).max
            while True:
                new_a = np.minimum(a, np.where(near, b[None, :], top).min(1))
                new_b = np.minimum(b, np.where(near, new_a[:, None], top).min(0))
                if (new_a == a).all() and (new_b == b).all():
                    break
                a, b = new_a, new_b
            nodes, targets = np.concatenate([own_a, own_b]), np.concatenate([a, b])
        n = int(has.sum() + owed.sum())
        return pa.table({
            "a": pa.array(np.concatenate([ids[asked][has], ids[rows][owed], nodes])),
            "b": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(targets, pa.int64())]),
            "n": pa.array(np.concatenate([counts[has], credit[owed], np.zeros(len(nodes))]).astype(np.int64)),
        })

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """Links between vectors of one label with a cosine of ``least`` or more.

    Takes vec_id, embedding and label; returns (vec_id, n_links, component_id, kept) for
    each row: the other vectors linked directly, the smallest vec_id reachable, and whether
    that is the row's own. Null, empty and zero vectors, vectors with null or non-finite
    components, and rows without a label link with nothing; vectors of different lengths
    don't link. Rows need a vec_id of their own. An empty table gives an empty result.
    """
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label")
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda v: v != 0)
    vectors = stored(vectors.withColumn("usable", F.coalesce(usable, F.lit(False))))
    # Scaled first, so that squares of very large or small components stay finite.
    largest = F.array_max(F.transform("embedding", F.abs))
    scaled = stored(vectors.where("usable").select("vec_id", "label", F.transform("embedding", lambda v: v / largest).alias("embedding")))
    classes = stored(scaled.groupBy("label", "embedding").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies")).select("class_id", "label", "embedding", "copies"))
    indexes = fit(classes, least)
    label = classes.schema["label"].dataType.simpleString()
    placed = stored(classes.mapInArrow(_placed(indexes), f"class_id long, label {label}, embedding array<double>, copies long, home int, visits array<int>"))

    cell = ["label", "dim", "cell"]
    size = F.size("embedding").alias("dim")
    homes = placed.select("class_id", "label", size, F.col("home").alias("cell"), "embedding", "copies", "home", "visits")
    visits = placed.select("class_id", "label", size, F.explode("visits").alias("cell"), "embedding", "copies", "home", F.lit(None).cast("array<int>").alias("visits"))
    parts = lambda rows, name: rows.groupBy(*cell).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    grid = stored(parts(homes, "home_parts").join(parts(visits, "visit_parts"), cell))
    part = lambda n: F.pmod(F.xxhash64("class_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = homes.join(grid, cell).select("*", part("home_parts").alias("i")).select("*", every("visit_parts").alias("j"), F.lit(True).alias("indexed"))
    right = visits.join(grid, cell).select("*", part("visit_parts").alias("j")).select("*", every("home_parts").alias("i"), F.lit(False).alias("indexed"))
    columns = [*cell, "i", "j", "class_id", "embedding", "copies", "home", "visits", "indexed"]
    found = stored(left.select(*columns).union(right.select(*columns)).groupBy(*cell, "i", "j").applyInArrow(_compared(least), "a long, b long, n long"))

    counts = found.where("b is null").groupBy(F.col("a").alias("class_id")).agg(F.sum("n").alias("n"))
    groups = components(found.where("b is not null").select("a", "b"))
    members = scaled.join(classes, ["label", "embedding"]).select("vec_id", "class_id", "copies")
    members = members.join(counts, "class_id", "left").join(groups.withColumnRenamed("id", "class_id"), "class_id", "left")
    members = members.select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "class_id").alias("component_id"))
    out = vectors.select("vec_id").join(members, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
