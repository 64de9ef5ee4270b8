"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into pieces, documents into overlapping passages of 2, 4 and 8
blocks of BLOCK words. Weights are TF-IDF, with frequencies over all passages of the corpus. A
distributed randomised SVD of the benchmark's TF-IDF matrix gives the latent space: tasks
sketch their rows with a random matrix, the sketches are summed by word, and an
orthonormal basis of the sum spans the space. Every passage is projected and compared with the
pieces; a passage is a candidate if its projection on a piece's direction holds the least that a leak
leaves there. A candidate is a leak if the longest common
subsequence covers enough of the piece, and enough of its answer too: the item's answer words
where the benchmark has an ``answer`` column, else the piece's rarest words. This finds
paraphrases that keep most words in order as well as copies.

The bound on the projection follows from COVERAGE and ANSWER for each piece, so no leak is lost
there. As a bound on the cosine it would fall with the norm of whatever else the passage holds.
No word has weight 0: a passage that many documents share makes its own words frequent, and
must be found all the same.

Projecting on the corpus's own leading directions was tried on paper and left: they hold languages and
frequent words, and any two texts of a language look alike. Large benchmarks are worked off
in blocks of at most MOST_PIECES pieces, so what goes to every task has a fixed bound, and of no more
than RANK, so the space of a block holds each of its pieces whole, however large the benchmark.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.llm.words import chunks, text_words, word_hashes

BLOCK = 16
#: Longest piece of an item; longer items become several.
PIECE = 64
MOST_PIECES = 256
RANK, OVERSAMPLED = 256, 16
#: Blocks of a chunk whose words are looked up at once, and passages compared at once.
SOME = 1024
#: Word classes of the document frequencies, by hash.
CLASSES = 1 << 17
#: Least weight of a word, however frequent.
FLOOR = 0.05
COVERAGE, ANSWER = 0.6, 0.5
#: Share of a piece's words, rarest first, that stand for an answer.
RARE = 0.25
#: A passage must hold one word that weighs at least this share of the piece's heaviest: frequent words in order are no evidence.
EVIDENCE = 0.2
#: Words at least in an item: fewer are no evidence.
LEAST = 5


def _blocks(first, size):
    """Block starts within the chunk's words, and the row of each."""
    per_row = np.diff(first)
    count = -(-per_row // size)
    rows = np.repeat(np.arange(len(per_row)), count)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
    return first[:-1][rows] + nth * size, rows


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Passages of PIECE words that hold each word class, and their number, over all texts."""

    def run(batches):
        seen, passages = np.zeros(CLASSES, np.int64), 0
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                hashes, _, _, first = word_hashes(data, offsets, plain=True)
                if not len(hashes):
                    continue
                start, _ = _blocks(first, PIECE)
                passage = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(hashes))))
                own = np.sort(passage * CLASSES + (hashes % np.uint64(CLASSES)).astype(np.int64))
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
                seen += np.bincount(own % CLASSES, minlength=CLASSES)
                passages += len(start)
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1)), pa.array(np.append(seen[held], passages))], names=["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    words, counts = rows["word"].to_numpy(), rows["n"].to_numpy()
    out, passages = np.zeros(CLASSES), int(counts[words < 0].sum())
    out[words[words >= 0]] = counts[words >= 0]
    return out, passages


def pieces_of(item_id, words, answer):
    """Pieces of one item: (item_id, words, answer words or nothing)."""
    if len(words) < LEAST:
        return []
    count = -(-len(words) // PIECE)
    cuts = [round(i * len(words) / count) for i in range(count + 1)]
    return [(item_id, words[a:b], [w for w in answer if w in set(words[a:b])]) for a, b in zip(cuts, cuts[1:])]


class Space:
    """Latent space of a block of pieces."""

    def __init__(self, pieces, weight, basis, vocabulary):
        self.pieces, self.weight, self.basis, self.vocabulary = pieces, weight, basis, vocabulary
        self.weighted = (basis * weight[(vocabulary % np.uint64(CLASSES)).astype(np.int64)][:, None]).astype(np.float32)
        self.items = np.zeros((len(pieces), basis.shape[1]), np.float32)
        for i, (_, words, _) in enumerate(pieces):
            own = np.array(words, np.uint64)
            at = self.index(own)
            value = self.weight[(own % np.uint64(CLASSES)).astype(np.int64)]
            vector = (basis[at[at >= 0]] * value[at >= 0, None]).sum(0)
            self.items[i] = vector / max(np.linalg.norm(vector), 1e-12)
        self.need = [frozenset(answer or self._rarest(words)) for _, words, answer in pieces]
        value = [(w, self.weight[np.array(w, np.uint64) % np.uint64(CLASSES)]) for _, w, _ in pieces]
        self.proof = [frozenset(w for w, x in zip(words, own.tolist()) if x >= EVIDENCE * own.max()) for words, own in value]
        # A little less, for sums in single precision.
        self.least = np.array([0.999 * self._least(words, *sets) for (_, words, _), *sets in zip(pieces, self.need, self.proof)], np.float32)
        sizes = np.array([len(words) for _, words, _ in pieces])
        # Blocks in a passage that must hold a whole piece wherever it starts.
        self.scale = np.where(sizes <= BLOCK, 2, np.where(sizes <= 2 * BLOCK, 4, 8))
        self.sets = [frozenset(w for w in words) for _, words, _ in pieces]

    def _rarest(self, words):
        rare = sorted(set(words), key=lambda w: (-self.weight[w % CLASSES], w))
        return rare[: max(1, round(RARE * len(rare)))]

    def _least(self, words, need, proof):
        """Least projection on the piece's direction of a passage that holds COVERAGE of its words, ANSWER of its answer and a word of proof.

        A word in the passage adds its count in the piece times its squared weight, over the piece's norm; the
        words that add least are taken, of the answer first.
        """
        own, counts = np.unique(np.array(words, np.uint64), return_counts=True)
        adds = counts * self.weight[(own % np.uint64(CLASSES)).astype(np.int64)] ** 2
        norm = np.sqrt((counts * adds).sum())
        needed = [i for i, w in enumerate(own.tolist()) if w in need]
        chosen = sorted(needed, key=lambda i: adds[i])[: math.ceil(ANSWER * len(need))]
        counts[chosen] -= 1
        rest = np.sort(np.repeat(adds, counts))
        more = max(0, math.ceil(COVERAGE * len(words)) - len(chosen))
        return max(adds[chosen].sum() + rest[:more].sum(), min(x for w, x in zip(own.tolist(), adds) if w in proof)) / norm

    def index(self, hashes):
        """Row of each word in the basis, -1 if it has none."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)


def latent_space(spark, pieces, weight) -> Space:
    """Randomised SVD of the pieces' TF-IDF rows, by tasks that hold some rows each.

    Z = A'(A R) with a random R is summed by word over tasks; its orthonormal basis spans the leading right
    singular vectors. Cosines don't depend on the rotation within the space.
    """
    class_of = lambda words: (np.array(words, np.uint64) % np.uint64(CLASSES)).astype(np.int64)
    vocabulary = np.unique(np.concatenate([np.array(words, np.uint64) for _, words, _ in pieces] or [np.zeros(0, np.uint64)]))
    rank = min(RANK, len(pieces)) + OVERSAMPLED
    seed = 13

    def run(batches):
        random = np.random.default_rng(seed).normal(size=(len(vocabulary), rank))
        for batch in batches:
            total = {}
            for words in batch.column(0).to_pylist():
                own, counts = np.unique(np.array(words, np.int64).view(np.uint64), return_counts=True)
                at = np.searchsorted(vocabulary, own)
                row = counts * weight[class_of(own)]
                row = row / max(np.linalg.norm(row), 1e-12)
                sketch = row @ random[at]
                for i, x in zip(at.tolist(), row):
                    total[i] = total.get(i, 0) + x * sketch
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], names=["word", "z"])

    def added(table: pa.Table) -> pa.Table:
        words = table["word"].to_numpy()
        z = np.array(table["z"].to_pylist())
        own, at = np.unique(words, return_inverse=True)
        sums = np.zeros((len(own), z.shape[1]))
        np.add.at(sums, at, z)
        return pa.table({"word": pa.array(own, pa.int32()), "z": pa.array(list(sums), pa.list_(pa.float64()))})

    rows = spark.createDataFrame(pa.table({"words": pa.array([np.array(w, np.uint64).view(np.int64) for _, w, _ in pieces], pa.list_(pa.int64()))})).repartition(4)
    sums = rows.mapInArrow(run, "word int, z array<double>").groupBy(F.pmod("word", F.lit(64))).applyInArrow(added, "word int, z array<double>").toArrow()
    z = np.zeros((len(vocabulary), rank))
    if sums.num_rows:
        z[sums["word"].to_numpy()] = np.array(sums["z"].to_pylist())
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    basis = u[:, s > 1e-9 * max(s.max(initial=0), 1e-300)][:, :RANK]
    return Space(pieces, weight, np.ascontiguousarray(basis, dtype=np.float32), vocabulary)


def common_subsequence(a, b) -> int:
    """Length of the longest common subsequence, by bits of one whole number."""
    places = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    full, row = (1 << len(a)) - 1, (1 << len(a)) - 1
    for word in b:
        hit = row & places.get(word, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _candidates(space, hashes, first):
    """(row, first word, word after the last, piece, cosine) of passages near a piece."""
    at = space.index(hashes)
    weight = space.weight[(hashes % np.uint64(CLASSES)).astype(np.int64)].astype(np.float32)
    start, rows = _blocks(first, BLOCK)
    squares = np.add.reduceat(weight * weight, start)
    held = np.flatnonzero(at >= 0)
    block = np.searchsorted(start, held, "right") - 1
    vectors = np.zeros((len(start), space.basis.shape[1]), np.float32)
    if not len(held):
        return
    head = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    for some in np.array_split(head, -(-len(head) // SOME)):
        a, b = some[0], head[np.searchsorted(head, some[-1]) + 1] if some[-1] != head[-1] else len(held)
        vectors[block[some]] = np.add.reduceat(space.weighted[at[held[a:b]]], some - a, axis=0)
    sums, lengths = np.zeros((len(start) + 1, vectors.shape[1])), np.concatenate([[0.0], np.cumsum(squares, dtype=np.float64)])
    np.cumsum(vectors, 0, out=sums[1:])
    for scale in np.unique(space.scale).tolist():
        chosen = np.flatnonzero(space.scale == scale)
        step = scale // 2
        # Passages start at every second half; the last ones of a row are shorter.
        nth = np.arange(len(start)) - np.searchsorted(rows, rows)
        begin = np.flatnonzero((nth % step == 0) & ((nth == 0) | (np.searchsorted(rows, rows, "right") - np.arange(len(start)) > step)))
        end = np.minimum(begin + scale, np.searchsorted(rows, rows[begin], "right"))
        norm = np.sqrt(np.maximum(lengths[end] - lengths[begin], 1e-12))
        for low in range(0, len(begin), SOME):
            own = slice(low, low + SOME)
            shared = (sums[end[own]] - sums[begin[own]]).astype(np.float32) @ space.items[chosen].T
            for i, k in np.argwhere(shared >= space.least[chosen]).tolist():
                at_first, after = begin[low + i], end[low + i]
                yield int(rows[at_first]), int(start[at_first]), int(start[after]) if after < len(start) else len(hashes), int(chosen[k]), float(shared[i, k] / norm[low + i])


def _searched(space):
    def run(batches):
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), {}
            for low, _, data, offsets in chunks(batch.column(1)):
                hashes, starts, ends, first = word_hashes(data, offsets, plain=True)
                if not len(hashes):
                    continue
                for row, a, b, k, cosine in _candidates(space, hashes, first):
                    item, words, _ = space.pieces[k]
                    key = (low + row, item)
                    if key in out and out[key][0] >= 1:  # nothing covers more
                        continue
                    part = hashes[a:b].tolist()
                    own = space.sets[k]
                    places = [i for i, w in enumerate(part) if w in own]
                    if len(places) < COVERAGE * len(words):
                        continue
                    need = space.need[k]
                    if len(need.intersection(part)) < ANSWER * len(need) or space.proof[k].isdisjoint(part):
                        continue
                    share = common_subsequence(words, part) / len(words)
                    if share < COVERAGE:
                        continue
                    text = data[offsets[row] : offsets[row + 1]]
                    span = int(starts[a + places[0]] - offsets[row]), int(ends[a + places[-1]] - offsets[row])
                    points = [int(((text[:n] & 0xC0) != 0x80).sum()) for n in span]
                    if key not in out or share > out[key][0]:
                        out[key] = (share, cosine, *points)
            rows = [(ids[row], item, *found) for (row, item), found in out.items()]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["doc_id", "item_id", "coverage", "cosine", "start", "finish"])

    return run


FOUND = "doc_id long, item_id long, coverage double, cosine double, start int, finish int"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items that stand in documents, as copies or paraphrases in the item's order.

    Takes doc_id and text of ``docs``, item_id, text and, if there, answer of ``benchmark``; returns
    (doc_id, item_id, coverage, cosine, start, finish): the best passage of each document and
    item, start and finish in code points around the shared words. Null and empty texts and
    items of fewer than LEAST words match nothing. Rows of one doc_id are one document; an
    empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen, passages = document_frequencies(docs)
    weight = np.maximum(FLOOR, np.log((passages + 1) / (seen + 1)))
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit("")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", answer.cast("string").alias("answer")).where("item_id is not null and text is not null").distinct()
    out, block = None, []

    def searched():
        found = docs.mapInArrow(_searched(latent_space(spark, block, weight)), FOUND)
        return found if out is None else out.union(found)

    for item in items.orderBy("item_id", "text").toLocalIterator():
        for piece in pieces_of(item["item_id"], text_words(item["text"]), text_words(item["answer"] or "")):
            block = [*block, piece]
            if len(block) >= min(MOST_PIECES, RANK):
                out, block = searched(), []
    if block:
        out = searched()
    if out is None:
        return spark.createDataFrame([], FOUND)
    best = F.max_by(F.struct("coverage", "cosine", "start", "finish"), F.struct("coverage", "cosine", -F.col("start"))).alias("x")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "x.*")
