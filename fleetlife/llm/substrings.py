"""Removal of passages that occur more than once, by suffix automata.

The text of a corpus is too large for one automaton, and one of a part would have to be
compared with everything. So the windows of ``span`` words are dealt to reference
shards: a window belongs to the shard of the smallest hash among its 12-word grams, and
equal windows have equal grams. Neighbouring windows of one document in one shard form a
slice of its words. Slices alone in their shard are done with; equal slices are counted
and kept once; a suffix automaton over each shard's different slices then gives, by
matching statistics, every longest stretch that occurs twice, and so all windows that do.
A shard with very many different slices is cut into single windows, a shard each.
The automata stay in the task of their shard: broadcasting them would grow with the data.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.llm.store import stored
from fleetlife.llm.words import chunks, grams, signed, stretch_hashes, word_bounds, word_hashes

GRAM = 12
#: A shard of more different slices, or of more rows held at a time, is cut into windows.
MOST_SLICES = 2_000
MOST_ROWS = 100_000

SLICES = "key long, slice long, doc_id long, at int, size int, repeats boolean"
DEALT = SLICES + ", copies int, lead boolean, hot boolean, alone boolean"


def _sliding_min(x, width):
    """Smallest of each ``width`` neighbours, by doubling."""
    have, low = 1, x
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(x) - width + 1], low[width - have :][: len(x) - width + 1])
    return low


def _slices_of(hashes, first, span):
    """(key, start, length in words, whether the gram is there twice, row) of every slice."""
    if len(hashes) < span:
        return None
    own = grams(hashes, GRAM)
    low = _sliding_min(own, span - GRAM + 1)
    per_row = np.diff(first)
    end = np.repeat(first[1:], per_row)
    start = np.flatnonzero(np.arange(len(low)) + span <= end[: len(low)])
    if not len(start):
        return None
    key = low[start]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (start[1:] != start[:-1] + 1)])
    head = np.flatnonzero(new)
    windows = np.diff(np.append(head, len(start)))
    at, key = start[head], key[head]
    covered = windows + span - GRAM
    place = np.arange(covered.sum()) - np.repeat(np.cumsum(covered) - covered, covered) + np.repeat(at, covered)
    hits = np.add.reduceat((own[place] == np.repeat(key, covered)).astype(np.int64), np.cumsum(covered) - covered)
    rows = np.repeat(np.arange(len(per_row)), per_row)[at]
    return key, at, windows + span - 1, hits > 1, rows


def _texts(batches):
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for low, high, data, offsets in chunks(batch.column(1)):
            yield batch, ids[low:high], low, high, data, offsets


def slices(docs: DataFrame, span: int) -> DataFrame:
    """All slices of (doc_id, text)."""

    def run(batches):
        for _, ids, _, _, data, offsets in _texts(batches):
            hashes, _, _, first = word_hashes(data, offsets)
            if (found := _slices_of(hashes, first, span)) is None:
                continue
            key, at, size, twice, rows = found
            content = stretch_hashes(hashes, at, size)
            yield pa.RecordBatch.from_arrays(
                [signed(key), signed(content), pa.array(ids[rows], pa.int64()), pa.array((at - first[rows]).astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(twice)],
                names=["key", "slice", "doc_id", "at", "size", "repeats"],
            )

    return docs.mapInArrow(run, SLICES)


def _dealt(most_slices, most_rows):
    """Over slices sorted by (key, slice): those whose shard may hold a repeat, with their counts."""
    names = ["key", "slice", "doc_id", "at", "size", "repeats"]

    def out(columns, copies, lead, hot, alone):
        return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(copies.astype(np.int32)), pa.array(lead), pa.array(hot), pa.array(alone)], names=[*names, "copies", "lead", "hot", "alone"])

    def work(columns):
        key, content = columns[0], columns[1]
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new = new_key | np.concatenate([[True], content[1:] != content[:-1]])
        head = np.flatnonzero(new)
        copies = np.repeat(np.diff(np.append(head, len(key))), np.diff(np.append(head, len(key))))
        key_head = np.flatnonzero(new_key)
        rows = np.diff(np.append(key_head, len(key)))
        kinds = np.add.reduceat(new.astype(np.int64), key_head)
        twice = np.add.reduceat(columns[5].astype(np.int64), key_head) > 0
        keep = np.repeat((rows > 1) | twice, rows)
        if keep.any():
            hot = np.repeat(kinds > most_slices, rows)
            alone = np.repeat((kinds == 1) & ~twice, rows)
            yield out([c[keep] for c in columns], copies[keep], new[keep], hot[keep], alone[keep])

    def flood(columns):
        n = len(columns[0])
        return out(columns, np.ones(n), np.ones(n, bool), np.ones(n, bool), np.zeros(n, bool))

    def run(batches):
        held, hot_key = None, None
        for batch in batches:
            columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
                held = None
            key = columns[0]
            if not len(key):
                continue
            if hot_key is not None:
                n = int(np.searchsorted(key, hot_key, "right"))
                if n:
                    yield flood([c[:n] for c in columns])
                columns = [c[n:] for c in columns]
                key = columns[0]
                if not len(key):
                    continue
                hot_key = None
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield from work([c[:cut] for c in columns])
            held = [c[cut:] for c in columns]
            if len(held[0]) > most_rows:
                hot_key = key[-1]
                yield flood(held)
                held = None
        if held is not None:
            yield from work(held)

    return run


class Automaton:
    """Suffix automaton of a sequence of integers, with the number of places of each state."""

    def __init__(self, symbols):
        step, link, length, count, prefix = [{}], [-1], [0], [0], []
        last = 0
        for symbol in symbols:
            now = len(step)
            step.append({})
            length.append(length[last] + 1)
            link.append(0)
            count.append(1)
            at = last
            while at >= 0 and symbol not in step[at]:
                step[at][symbol] = now
                at = link[at]
            if at >= 0:
                to = step[at][symbol]
                if length[to] == length[at] + 1:
                    link[now] = to
                else:
                    twin = len(step)
                    step.append(dict(step[to]))
                    length.append(length[at] + 1)
                    link.append(link[to])
                    count.append(0)
                    link[to] = link[now] = twin
                    while at >= 0 and step[at].get(symbol) == to:
                        step[at][symbol] = twin
                        at = link[at]
            last = now
            prefix.append(now)
        self.length, self.link, self.prefix = length, link, prefix
        order = sorted(range(1, len(step)), key=length.__getitem__)
        for state in reversed(order):
            if link[state] >= 0:
                count[link[state]] += count[state]
        # Longest suffix of each state that occurs at least twice.
        self.twice = twice = [0] * len(step)
        for state in order:
            twice[state] = length[state] if count[state] > 1 else twice[link[state]]

    def matching_statistics(self):
        """For each symbol, the length of the longest stretch ending there that occurs twice."""
        return [self.twice[state] for state in self.prefix]


def repeated_stretches(sequences, span):
    """For each sequence, the maximal stretches (start, end) of windows that occur twice among all."""
    joined = []
    for i, words in enumerate(sequences):
        joined += words
        joined.append((i,))  # unlike every word and every other mark
    longest = Automaton(joined).matching_statistics()
    begin = 0
    for words in sequences:
        found = []
        for i in range(len(words)):
            if (size := longest[begin + i]) >= span:
                a = i - size + 1
                if found and a <= found[-1][1]:
                    found[-1] = (min(a, found[-1][0]), i + 1)
                else:
                    found.append((a, i + 1))
        begin += len(words) + 1
        yield found


def _matched(span):
    def run(batches):
        key, names, bucket = None, [], []

        def finish():
            if len(bucket) > 0:
                found = [(n, a, b) for n, spans in zip(names, repeated_stretches(bucket, span)) for a, b in spans]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(found), pa.int64()), *(pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32())))],
                        names=["key", "slice", "low", "high"],
                    )

        for batch in batches:
            for k, s, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    yield from finish()
                    key, names, bucket = k, [], []
                names.append(s)
                bucket.append(words)
        yield from finish()

    return run


def _asked(docs, rows):
    """Documents with their requests: lists of (key, slice, at, size), bounded by the document."""
    asked = rows.groupBy("doc_id").agg(F.collect_list(F.struct("key", "slice", "at", "size")).alias("asked"))
    return docs.join(asked, "doc_id").select("doc_id", "text", "asked")


def _words_of(batches):
    for batch, _, low, high, data, offsets in _texts(batches):
        hashes, _, _, first = word_hashes(data, offsets)
        values = hashes.view(np.int64)
        keys, names, words = [], [], []
        for row, asked in zip(first[:-1].tolist(), batch.column(2).slice(low, high - low).to_pylist()):
            for a in asked:
                keys.append(a["key"])
                names.append(a["slice"])
                words.append(values[row + a["at"] : row + a["at"] + a["size"]])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(names, pa.int64()), pa.array(words, pa.list_(pa.int64()))], names=["key", "slice", "words"])


def _windows_of(span):
    def run(batches):
        for batch, ids, low, high, data, offsets in _texts(batches):
            hashes, _, _, first = word_hashes(data, offsets)
            places, owners, own = [], [], []
            for doc_id, row, asked in zip(ids.tolist(), first[:-1].tolist(), batch.column(2).slice(low, high - low).to_pylist()):
                for a in asked:
                    at = np.arange(a["at"], a["at"] + a["size"] - span + 1)
                    places.append(at + row)
                    own.append(at)
                    owners.append(np.full(len(at), doc_id, np.int64))
            if places:
                at = np.concatenate(places)
                content = stretch_hashes(hashes, at, np.full(len(at), span))
                yield pa.RecordBatch.from_arrays([signed(content), pa.array(np.concatenate(owners)), pa.array(np.concatenate(own).astype(np.int32))], names=["window", "doc_id", "at"])

    return run


def repeated_spans(docs: DataFrame, span: int = 35, most_slices: int = MOST_SLICES, most_rows: int = MOST_ROWS) -> DataFrame:
    """(doc_id, low, high): word ranges, covered by windows of ``span`` words that occur elsewhere too."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = stored(slices(docs, span).repartition("key").sortWithinPartitions("key", "slice").mapInArrow(_dealt(most_slices, most_rows), DEALT))
    equal = dealt.where("copies > 1 and not hot").select("doc_id", F.col("at").alias("low"), (F.col("at") + F.col("size")).alias("high"))

    mixed = dealt.where("not hot and not alone")
    words = _asked(docs, mixed.where("lead")).mapInArrow(_words_of, "key long, slice long, words array<long>")
    matched = words.repartition("key").sortWithinPartitions("key").mapInArrow(_matched(span), "key long, slice long, low int, high int")
    partly = mixed.where("copies = 1").join(matched, ["key", "slice"]).select("doc_id", (F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.col("high")).alias("high"))
    spans = equal.union(partly)

    hot = dealt.where("hot")
    if not hot.isEmpty():
        windows = stored(_asked(docs, hot).mapInArrow(_windows_of(span), "window long, doc_id long, at int"))
        often = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
        spans = spans.union(windows.join(often, "window").select("doc_id", F.col("at").alias("low"), (F.col("at") + span).alias("high")))
    return spans


def _covered(count, spans):
    gone = np.zeros(count + 1, np.int64)
    for low, high in spans:
        gone[low] += 1
        gone[high] -= 1
    return np.cumsum(gone[:-1]) > 0


def _kept(batches):
    for batch, _, low, high, data, offsets in _texts(batches):
        starts, ends, first = word_bounds(data, offsets)
        raw = data.tobytes()
        counts, removed, texts = [], [], []
        for a, b, lows, highs in zip(first[:-1].tolist(), first[1:].tolist(), batch.column(2).slice(low, high - low).to_pylist(), batch.column(3).slice(low, high - low).to_pylist()):
            pairs = zip(starts[a:b].tolist(), ends[a:b].tolist())
            if lows:
                gone = _covered(b - a, zip(lows, highs))
                removed.append(int(gone.sum()))
                words = [raw[s:e] for (s, e), g in zip(pairs, gone.tolist()) if not g]
            else:
                removed.append(0)
                words = [raw[s:e] for s, e in pairs]
            counts.append(b - a)
            texts.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])


def without_repeats(docs: DataFrame, span: int = 35, **bounds) -> DataFrame:
    """Every document without the words of passages that also start anywhere else.

    Takes doc_id and text; returns (doc_id, n_words, n_removed, kept), a row per row of
    ``docs``. Rows are told apart by id and text, so rows of one doc_id, or of none, keep their own spans; rows
    equal in both have the same.
    ``kept`` has the kept words joined by one blank. Null and empty texts have no words; a
    text below ``span`` words is kept whole. All copies of a passage go, in one document or
    in many. An empty table gives an empty result.
    """
    row = F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row)
    spans = stored(repeated_spans(docs.select(F.col("row").alias("doc_id"), "text"), span, **bounds))
    lists = spans.groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("s")).select(F.col("doc_id").alias("row"), F.col("s.low").alias("lows"), F.col("s.high").alias("highs"))
    rows = docs.join(lists, "row", "left").select("doc_id", "text", "lows", "highs")
    return rows.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept string")
