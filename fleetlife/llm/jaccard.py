"""N-gram Jaccard join by partitions of the token universe.

A document is the set of its distinct word shingles. For sets of a size band, the
largest symmetric difference H that a linked pair can have is known. The hashed token
universe is cut into H + 1 + spare segments, so a linked pair agrees on more than
``spare`` segments wholly. Each document therefore indexes, per segment, the hash of its
tokens there. Costs set the allocation: a segment that holds hardly any tokens would
have a long list and is skipped. The rule looks at the content only, so both partners
skip an agreeing segment alike, and a document that skips at most ``spare`` segments is
complete. One that skips more adds further, differently hashed partitions, and at last
half as many segments with their one-deletion neighbourhoods, which find a pair that
differs by one token there. No pair is missed, whatever the data.

Documents that share a list entry become candidates: all pairs of a short list, and the
first one against all of a long list. What a long list has left outside the first one's
component is compared in a second step as blocks of bounded size, which return a spanning
forest of the links, so a group of near copies never expands into all its pairs.
Candidates are verified on the whole sets.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.llm.graph import components
from fleetlife.llm.store import small_batches, stored
from fleetlife.llm.words import chunks, mix, shingle_sets, signed

#: Lists up to this length give all their pairs at once.
SHORT = 6
#: Partitions a document tries before it takes one-deletion neighbourhoods.
VARIANTS = 3
#: Documents in a part of a group; a block compares two parts.
PART = 512
#: Bits of the bitmap of wanted ids, as a power of two: 2 MB.
FILTER_BITS = 24
#: In a block, tokens of at most so many documents are counted as pairs, others by so many columns.
RARE, COLUMNS = 8, 4096
#: Sets from this size on also skip segments with a single token.
LONE_FROM = 64


def bands(percent: int, largest: int) -> list[int]:
    """Lower ends of the size bands: a set links with its own band and the two beside it."""
    lows = [1]
    while lows[-1] <= largest:
        lows.append(100 * lows[-1] // percent + 1)
    return lows


class Schemes:
    """Segments, spare ones and skipped sizes of each band."""

    def __init__(self, percent: int):
        self.percent, self.lows, self.known = percent, bands(percent, 1 << 22), {}

    def of_size(self, n: int) -> list[int]:
        """Bands whose pairs may hold a set of n tokens: as the smaller or as the larger one."""
        while self.lows[-1] <= n:
            self.lows = bands(self.percent, 2 * self.lows[-1])
        own = int(np.searchsorted(self.lows, n, "right")) - 1
        return [own] if own == 0 else [own - 1, own]

    def plan(self, band: int) -> tuple[int, int, int, int]:
        """(largest difference H, segments, spare segments, tokens below which a segment is skipped)."""
        if band not in self.known:
            small = self.lows[band + 1] - 1
            most = (100 - self.percent) * (small + 100 * small // self.percent) // (100 + self.percent)
            least = 2 if self.lows[band] >= LONE_FROM else 1
            spare = 1
            while True:  # as many spare segments as the skipped ones expected in the smallest set, and some
                cut = most + 1 + spare
                load = self.lows[band] / cut
                skipped = cut * math.exp(-load) * (1 + load * (least == 2))
                if spare >= skipped + math.sqrt(skipped) or spare > 2 * most:
                    break
                spare += 1
            self.known[band] = most, cut, spare, least
        return self.known[band]


def _segment(tokens, count, salt):
    """Segment of each token, and the token's part in its segment's hash."""
    value = mix(tokens ^ np.uint64(salt))
    return ((value >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64), mix(value + np.uint64(1))


def signatures(tokens: np.ndarray, schemes: Schemes) -> list[np.ndarray]:
    """The list entries of one set."""
    out = []
    with np.errstate(over="ignore"):
        for band in schemes.of_size(len(tokens)):
            most, cut, spare, least = schemes.plan(band)
            if most == 0:
                continue  # only equal sets link, and those are one class already
            for variant in range(VARIANTS):
                salt = (band * 16 + variant + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
                where, part = _segment(tokens, cut, salt)
                sizes = np.bincount(where, minlength=cut)
                sums = np.zeros(cut, np.uint64)
                np.add.at(sums, where, part)
                taken = np.flatnonzero(sizes >= least)
                out.append(mix(sums[taken] + mix(taken.astype(np.uint64) + np.uint64(salt))))
                if cut - len(taken) <= spare:
                    break
            else:
                cut = most // 2 + 1
                salt = (band * 16 + 15) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
                where, part = _segment(tokens, cut, salt)
                sums = np.zeros(cut, np.uint64)
                np.add.at(sums, where, part)
                own = mix(np.arange(cut).astype(np.uint64) + np.uint64(salt))
                out += [mix(sums + own), mix(sums[where] - part + own[where])]
    return out


def _sets(batches, shingle):
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, last, data, offsets in chunks(batch.column(1)):
            yield ids[first:last], list(shingle_sets(data, offsets, shingle))


def _keys_of(tokens):
    with np.errstate(over="ignore"):
        return int(mix(tokens).sum(dtype=np.uint64)), int(mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))


def set_keys(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n_shingles, k1, k2): equal numbers, equal sets."""

    def run(batches):
        for ids, sets in _sets(batches, shingle):
            keys = np.array([_keys_of(s) for s in sets], np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), signed(keys[:, 0].copy()), signed(keys[:, 1].copy())],
                names=["doc_id", "n_shingles", "k1", "k2"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long")


def index(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(sig, doc_id). Of equal sets, each task indexes the first it meets."""

    def run(batches):
        schemes, met = Schemes(percent), set()
        for ids, sets in _sets(batches, shingle):
            sigs, owners = [], []
            for doc_id, tokens in zip(ids.tolist(), sets):
                if len(tokens) and (key := (len(tokens), *_keys_of(tokens))) not in met:
                    met.add(key)
                    own = signatures(tokens, schemes)
                    sigs += own
                    owners.append((doc_id, sum(map(len, own))))
            if sigs:
                who = np.repeat(np.array([d for d, _ in owners], np.int64), [n for _, n in owners])
                yield pa.RecordBatch.from_arrays([signed(np.concatenate(sigs)), pa.array(who)], names=["sig", "doc_id"])

    return docs.mapInArrow(run, "sig long, doc_id long")


def _runs(batches):
    """Candidates of rows sorted by (sig, doc_id): (a, b, null), and (a, null, sig) for members of long lists."""
    names = ["a", "b", "sig"]

    def out(a, b, sig):
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b) if b is not None else pa.nulls(len(a), pa.int64()), pa.array(sig) if sig is not None else pa.nulls(len(a), pa.int64())], names=names)

    held_sig, held_id, long_sig, long_first = np.zeros(0, np.int64), np.zeros(0, np.int64), None, None

    def work(sig, ids, last):
        nonlocal held_sig, held_id, long_sig, long_first
        sig, ids = np.concatenate([held_sig, sig]), np.concatenate([held_id, ids])
        held_sig, held_id = sig[:0], ids[:0]
        if long_sig is not None:
            n = int(np.searchsorted(sig, long_sig, "right"))
            if n:
                yield out(np.full(n, long_first), ids[:n], None)
                yield out(ids[:n], None, sig[:n])
            sig, ids = sig[n:], ids[n:]
            if len(sig):
                long_sig = None
        if not len(sig):
            return
        start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        size = np.diff(np.append(start, len(sig)))
        if not last:
            if size[-1] <= SHORT:  # may go on in the next batch
                held_sig, held_id = sig[start[-1] :], ids[start[-1] :]
                start, size = start[:-1], size[:-1]
            else:
                long_sig, long_first = sig[start[-1]], ids[start[-1]]
        end = np.repeat(start + size, size)
        short = np.repeat(size <= SHORT, size)
        at = np.arange(len(end)) + (start[0] if len(start) else 0)
        found = []
        for step in range(1, SHORT):
            i = at[short & (at + step < end)]
            if not len(i):
                break
            found.append(np.stack([ids[i], ids[i + step]], 1))
        if found:
            pairs = np.concatenate(found)
            order = np.lexsort((pairs[:, 1], pairs[:, 0]))
            pairs = pairs[order]
            keep = np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(1)])
            yield out(pairs[keep, 0].copy(), pairs[keep, 1].copy(), None)
        if not short.all():
            i = at[~short]
            head = np.repeat(start, size)[~short]
            rest = i > head
            yield out(ids[head[rest]], ids[i[rest]], None)
            yield out(ids[i], None, sig[i])

    for batch in batches:
        yield from work(batch.column(0).to_numpy(), batch.column(1).to_numpy(), False)
    yield from work(np.zeros(0, np.int64), np.zeros(0, np.int64), True)


def _bit(ids):
    return mix(np.asarray(ids, np.int64).view(np.uint64)) >> np.uint64(64 - FILTER_BITS)


def _filter_of(wanted: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with a bit set for the hash of every doc_id; it comes to the driver as its words."""

    def run(batches):
        for batch in batches:
            bit = _bit(batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([signed(bit >> np.uint64(6)), signed(np.uint64(1) << (bit & np.uint64(63)))], names=["word", "bits"])

    words = wanted.select("doc_id").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return bitmap


def token_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, tokens) of the documents in ``wanted`` (doc_id).

    The scan leaves out what the bitmap of the wanted ids doesn't hold, so whole texts are not
    shuffled; the few it lets through wrongly go in the join. A full bitmap lets all through.
    """
    bitmap = _filter_of(wanted)

    def run(batches):
        for batch in batches:
            bit = _bit(batch.column(0).to_numpy(zero_copy_only=False))
            held = bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)
            for ids, sets in _sets([batch.filter(pa.array(held.astype(bool)))], shingle):
                tokens = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), tokens], names=["doc_id", "tokens"])

    return docs.mapInArrow(run, "doc_id long, tokens array<long>").join(wanted.select("doc_id"), "doc_id", "left_semi")


def verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    wanted = stored(pairs.select("a").union(pairs.select("b")).distinct().toDF("doc_id"))
    sets = stored(token_sets(docs, wanted, shingle))
    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").where(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b")


def _linked(percent):
    """A spanning forest (a, b) of the links among the sets of one block."""

    def run(block: pa.Table) -> pa.Table:
        ids, first = np.unique(block["id"].to_numpy(), return_index=True)
        lists = block["tokens"].combine_chunks().take(pa.array(first))
        tokens, n = lists.flatten().to_numpy(), len(ids)
        sizes = np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(n), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        held = np.diff(np.append(start, len(tokens)))
        common = np.zeros((n, n), np.float32)
        # Rare tokens as pairs of holders, the others as columns of a product.
        rare = np.repeat(held <= RARE, held)
        end, at = np.repeat(start + held, held), np.arange(len(tokens))
        for step in range(1, RARE):
            i = at[rare & (at + step < end)]
            if not len(i):
                break
            common += np.bincount(owner[i] * n + owner[i + step], minlength=n * n).reshape(n, n)
        common += common.T
        column = np.repeat(np.cumsum(held > RARE) - 1, held)
        for low in range(0, int((held > RARE).sum()), COLUMNS):
            own = ~rare & (column >= low) & (column < low + COLUMNS)
            part = np.zeros((n, COLUMNS), np.float32)
            part[owner[own], column[own] - low] = 1
            common += part @ part.T
        near = 100 * common.astype(np.float64) >= percent * (sizes[:, None] + sizes[None, :] - common.astype(np.float64))
        np.fill_diagonal(near, True)
        label = ids.copy()
        while True:
            new = np.where(near, label[None, :], np.iinfo(np.int64).max).min(1)
            if (new == label).all():
                break
            label = new
        own = label != ids
        return pa.table({"a": pa.array(ids[own], pa.int64()), "b": pa.array(label[own], pa.int64())})

    return run


def linked_in_groups(inside: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Spanning links (a, b) of long lists (sig, id), all their pairs compared, in blocks.

    Lists that overlap are compared as one cluster of documents where that is cheaper than
    list by list, as it is for near copies, which meet in most of their lists. A cluster
    or list is cut into parts; a block holds two of them, so its size is bounded, and
    returns fewer links than it has documents.
    """
    lists = stored(inside.groupBy("sig").agg(F.count("*").alias("n"), F.min("id").alias("low")))
    clusters = components(inside.join(lists, "sig").select(F.col("id").alias("a"), F.col("low").alias("b")))
    sizes = clusters.groupBy("component").agg(F.count("*").alias("members"))
    owned = stored(lists.join(clusters, lists["low"] == clusters["id"]).select("sig", "n", "component"))
    costs = owned.groupBy("component").agg(F.sum(F.col("n") * F.col("n")).alias("apart")).join(sizes, "component")
    whole = costs.select("component", (F.col("members") * F.col("members") <= F.col("apart")).alias("whole"))
    apart = inside.join(owned.join(whole.where("not whole"), "component").select("sig"), "sig").select(F.lit(0).alias("kind"), F.col("sig").alias("key"), "id")
    together = clusters.join(whole.where("whole"), "component").select(F.lit(1).alias("kind"), F.col("component").alias("key"), "id")
    members = stored(together.union(apart))
    parts = members.groupBy("kind", "key").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    placed = members.join(parts, ["kind", "key"]).withColumn("i", own).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = placed.select("kind", "key", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "id")
    sets = token_sets(docs, stored(members.select(F.col("id").alias("doc_id")).distinct()), shingle).withColumnRenamed("doc_id", "id")
    return placed.join(sets, "id").groupBy("kind", "key", "i", "j").applyInArrow(_linked(percent), "a long, b long").distinct()


def ngram_jaccard_join(docs: DataFrame, shingle: int = 4, percent: int = 85) -> DataFrame:
    """Groups of documents whose shingle sets have a Jaccard similarity of percent / 100 or more.

    Takes doc_id and text of ``docs``, whatever other columns it has, and returns
    (doc_id, n_shingles, class_id, component_id), a row per document: class_id is the
    smallest doc_id with an equal set, component_id the smallest reachable by links.
    Null and empty texts have no shingles and link with nothing; a text of fewer words
    than a shingle is one shingle. Rows that repeat a doc_id with the same text count once;
    a null doc_id is dropped. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    with small_batches(docs.sparkSession):
        keys = stored(set_keys(docs, shingle).distinct())
        classes = keys.where("n_shingles > 0").groupBy("n_shingles", "k1", "k2").agg(F.min("doc_id").alias("class_id"))
        members = stored(keys.join(classes, ["n_shingles", "k1", "k2"], "left").select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id")))
        lists = stored(index(docs, shingle, percent).repartition("sig").sortWithinPartitions("sig", "doc_id").mapInArrow(_runs, "a long, b long, sig long").distinct())

        of = members.select(F.col("doc_id").alias("a"), F.col("class_id").alias("ca"))
        pairs = lists.where("b is not null").join(of, "a").join(of.toDF("b", "cb"), "b").where("ca <> cb")
        pairs = stored(pairs.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct())
        links = stored(verified(pairs, docs, shingle, percent))

        groups = components(links)
        inside = lists.where("b is null").join(of, "a").select("sig", F.col("ca").alias("id")).distinct().join(groups, "id", "left")
        inside = stored(inside.select("sig", "id", F.coalesce("component", "id").alias("component")))
        mixed = inside.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("sig")
        inside = stored(inside.select("sig", "id").join(mixed, "sig"))
        if not inside.isEmpty():
            groups = components(links.union(linked_in_groups(inside, docs, shingle, percent)))
    found = groups.select(F.col("id").alias("class_id"), "component")
    return members.join(found, "class_id", "left").select("doc_id", "n_shingles", "class_id", F.coalesce("component", "class_id").alias("component_id"))
