"""Phrase collocations, counted on a prefix-free parse of all texts.

Texts are lower-cased (A-Z) and cut at punctuation into pieces, pieces into words. Wherever the hash of
three words in a row is divisible by PERIOD, a chunk ends and the next one starts with the same
three words; a piece's ends are chunk ends as well. What is cut depends on the words around the
cut alone, so equal passages give equal chunks wherever they stand. The dictionary of
distinct chunks with their frequencies holds all that counting needs, and copies are counted by
multiplication.

Two chunks share three words, so a run of up to four words that starts in the last three of a
chunk is counted in the next chunk and nowhere else: overlaps are assigned once.

Counting goes from short to long. Only phrases with LEAST occurrences matter, and every part
of such a phrase has as many. The hashes of frequent words, then of frequent bigrams, make
bitmaps of fixed size, which tell every task what can be skipped. They only ever let too much
through; the counts themselves group by the phrases' text.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlife.llm.store import stored
from fleetlife.llm.words import BYTE, chunks, grams, mix, powers, word_bounds, word_hashes

#: Bytes that end a piece, and those between words.
ENDS = np.zeros(256, bool)
ENDS[[46, 44, 59, 58, 33, 63, 10, 11, 12, 13]] = True
BREAKS = ENDS.copy()
BREAKS[[32, 9]] = True
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32

LONGEST = 4
#: Words that two chunks of a piece share: one less than the longest phrase.
OVERLAP = LONGEST - 1
#: Words from one cut of a piece to the next, on average.
PERIOD = 24
LEAST = 30
#: A phrase goes if a longer one has this many percent of its occurrences.
HELD = 80
SCALE = 2_000_000
MOST = 2000
UNKNOWN = "und"
#: Bits of a bitmap (8 MB); beyond some tens of millions of frequent phrases it lets more through.
BITS = 26
#: Hashes that a task gathers before it adds up equal ones.
GATHERED = 1 << 21


def _gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Strings of the byte ranges."""
    size = end - start
    to = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - to[:-1], size) + np.arange(to[-1])
    offsets = pa.py_buffer(to.astype(np.int64))
    return pa.LargeStringArray.from_buffers(len(size), offsets, pa.py_buffer(data[at])).cast(pa.string())


def _parsed(data: np.ndarray, offsets: np.ndarray):
    """(row, chunk text, last) of each chunk of some texts; last: no further chunk of the piece follows."""
    data = FOLDED[data]
    starts, ends, first = word_bounds(data, offsets, BREAKS)
    n = len(starts)
    if not n:
        return None
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    before = np.cumsum(ENDS[data])[starts]
    opens = np.ones(n, bool)
    opens[1:] = (row[1:] != row[:-1]) | (before[1:] != before[:-1])
    # Words one after the other with one blank behind each.
    size = ends - starts
    place = np.concatenate([[0], np.cumsum(size + 1)])
    inside = ~BREAKS[data]
    flat = np.full(place[-1], 32, np.uint8)
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    flat[np.repeat(place[:-1], size) + within] = data[inside]
    value = BYTE[data[inside]] * powers(int(size.max()) + 1)[within]
    hashes = mix(np.add.reduceat(value, np.cumsum(size) - size) + size.astype(np.uint64))
    piece = np.cumsum(opens) - 1
    piece_start = np.flatnonzero(opens)
    piece_end = np.append(piece_start[1:], n)
    cut = np.flatnonzero(grams(hashes, OVERLAP) % np.uint64(PERIOD) == 0)
    own = piece[cut]
    cut = cut[(own == piece[cut + OVERLAP - 1]) & (cut > piece_start[own]) & (cut + OVERLAP < piece_end[own])]
    start = np.sort(np.concatenate([piece_start, cut]))
    last = np.ones(len(start), bool)
    last[:-1] = piece[start[:-1]] != piece[start[1:]]
    end = piece_end[piece[start]]
    go_on = np.flatnonzero(~last)
    end[go_on] = start[go_on + 1] + OVERLAP
    return row[start], _gathered(flat, place[start], place[end] - 1), last


def dictionary(docs: DataFrame) -> DataFrame:
    """(lang, last, chunk, times): the distinct chunks of all texts, each language for itself.

    ``chunk`` has its words joined by one blank. Null text is empty; a null lang is ``und``.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                langs = batch.column("lang")
                for low, _, data, offsets in chunks(batch.column("text")):
                    found = _parsed(data, offsets)
                    if found:
                        row, text, last = found
                        yield pa.record_batch([langs.take(pa.array(row + low)), pa.array(last), text], ["lang", "last", "chunk"])

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")
    return rows.mapInArrow(parse, "lang string, last boolean, chunk string").groupBy("lang", "last", "chunk").agg(F.count("*").alias("times"))


class _Words:
    """The words of some chunks: hashes, places, and which of them start phrases of the chunk."""

    def __init__(self, batch: pa.RecordBatch, low: int, high: int, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        self.hash, self.start, self.end, first = word_hashes(data, offsets)
        count = np.diff(first)
        self.row = np.repeat(np.arange(high - low), count)
        last = np.asarray(batch.column("last").slice(low, high - low).to_numpy(zero_copy_only=False))
        kept = np.where(last, count, count - OVERLAP)
        self.own = np.arange(len(self.hash)) - first[:-1][self.row] < kept[self.row]
        self.times = batch.column("times").slice(low, high - low).to_numpy()[self.row]
        named = batch.column("lang").slice(low, high - low).dictionary_encode()
        salt = np.array([_lang_hash(name) for name in named.dictionary.to_pylist()], np.uint64)
        self.salt = salt[named.indices.to_numpy()][self.row]
        self.lang = named

    def together(self, n: int) -> np.ndarray:
        """Which words start a run of n words of their chunk."""
        out = np.zeros(len(self.row), bool)
        out[: max(0, len(out) - n + 1)] = self.row[: max(0, len(out) - n + 1)] == self.row[n - 1 :]
        return out

    def phrases(self, at: np.ndarray, n: int) -> pa.Table:
        """(lang, phrase, times) of the runs of n words from ``at``, added up."""
        lang = pa.DictionaryArray.from_arrays(pa.array(self.lang.indices.to_numpy()[self.row[at]]), self.lang.dictionary).cast(pa.string())
        rows = pa.table([lang, _gathered(self.data, self.start[at], self.end[at + n - 1]), pa.array(self.times[at])], ["lang", "phrase", "times"])
        return rows.group_by(["lang", "phrase"], use_threads=False).aggregate([("times", "sum")]).rename_columns(["lang", "phrase", "times"])


def _lang_hash(name: str) -> int:
    raw = np.frombuffer(b"L" + name.encode("utf-8", "replace").replace(b" ", b"_"), np.uint8)
    return int(mix(np.array([(BYTE[raw] * powers(len(raw))[: len(raw)]).sum(dtype=np.uint64)], np.uint64))[0])


def _each(batches) -> Iterator[_Words]:
    for batch in batches:
        for low, high, data, offsets in chunks(batch.column("chunk")):
            yield _Words(batch, low, high, data, offsets)


def _pair_hashes(words: _Words) -> np.ndarray:
    out = np.zeros(len(words.hash), np.uint64)
    pairs = grams(words.hash, 2)
    out[: len(pairs)] = pairs
    return mix(out + words.salt)


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits at the hashes of a table (hash): at most 2 ** 20 rows of 64 bits reach the driver."""
    slot = F.col("hash").bitwiseAND((1 << BITS) - 1)
    rows = hashes.select(F.shiftright(slot, 6).alias("at"), F.expr(f"shiftleft(1L, cast(hash & 63 as int))").alias("bit"))
    held = rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << (BITS - 6), np.int64)
    bits[np.asarray(held["at"], np.int64)] = np.asarray(held["bits"], np.int64)
    return bits.view(np.uint64)


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64((1 << BITS) - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


def _word_counts(parse: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, f) of the words with at least ``least`` occurrences."""

    def count(batches):
        with np.errstate(over="ignore"):
            for words in _each(batches):
                yield from words.phrases(np.flatnonzero(words.own), 1).to_batches()

    rows = parse.mapInArrow(count, "lang string, phrase string, times long")
    return rows.groupBy("lang", "phrase").agg(F.sum("times").alias("f")).where(F.col("f") >= least)


def _word_hashes(counts: DataFrame) -> DataFrame:
    def emit(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                salt = np.array([_lang_hash(name) for name in batch.column("lang").to_pylist()], np.uint64)
                for low, high, data, offsets in chunks(batch.column("phrase")):
                    yield pa.record_batch([pa.array(mix(word_hashes(data, offsets)[0] + salt[low:high]).view(np.int64))], ["hash"])

    return counts.select("lang", "phrase").mapInArrow(emit, "hash long")


def _added(hashes: list, times: list) -> pa.RecordBatch:
    values, at = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.zeros(len(values), np.int64)
    np.add.at(total, at, np.concatenate(times))
    return pa.record_batch([pa.array(values.view(np.int64)), pa.array(total)], ["hash", "times"])


def _pair_counts(parse: DataFrame, frequent: np.ndarray, least: int) -> DataFrame:
    """(hash) of the bigrams of frequent words whose hashes occur at least ``least`` times."""
    told = parse.sparkSession.sparkContext.broadcast(frequent)

    def count(batches):
        hashes, times, held = [], [], 0
        with np.errstate(over="ignore"):
            for words in _each(batches):
                known = _marked(told.value, mix(words.hash + words.salt))
                at = np.flatnonzero(words.own & words.together(2) & known & np.append(known[1:], False))
                hashes.append(_pair_hashes(words)[at])
                times.append(words.times[at])
                held += len(at)
                if held >= GATHERED:
                    yield _added(hashes, times)
                    hashes, times, held = [], [], 0
            if held:
                yield _added(hashes, times)

    return parse.mapInArrow(count, "hash long, times long").groupBy("hash").agg(F.sum("times").alias("times")).where(F.col("times") >= least)


def _phrase_counts(parse: DataFrame, frequent: np.ndarray, longest: int, least: int) -> DataFrame:
    """(lang, n_words, phrase, f) of the phrases of 2 and more words with at least ``least`` occurrences."""
    told = parse.sparkSession.sparkContext.broadcast(frequent)

    def count(batches):
        with np.errstate(over="ignore"):
            for words in _each(batches):
                pair = words.together(2) & _marked(told.value, _pair_hashes(words))
                run = pair
                for n in range(2, longest + 1):
                    if n > 2:
                        run = run & np.append(pair[n - 2 :], np.zeros(n - 2, bool))[: len(run)]
                    at = np.flatnonzero(run & words.own)
                    if len(at):
                        rows = words.phrases(at, n)
                        yield from rows.append_column("n_words", pa.array(np.full(len(rows), n, np.int32))).to_batches()

    rows = parse.mapInArrow(count, "lang string, phrase string, times long, n_words int")
    return rows.groupBy("lang", "n_words", "phrase").agg(F.sum("times").alias("f")).where(F.col("f") >= least)


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """((lang, n_words, phrase, f) with f >= least, (lang, n) with all word occurrences)."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases of 2 to {LONGEST} words expected")
    parse = stored(dictionary(docs))
    size = F.length("chunk") - F.length(F.replace("chunk", F.lit(" "), F.lit(""))) + 1 - F.when(F.col("last"), 0).otherwise(OVERLAP)
    totals = stored(parse.groupBy("lang").agg(F.sum(size.cast("long") * F.col("times")).alias("n")))
    words = stored(_word_counts(parse, least))
    pairs = _bitmap(_pair_counts(parse, _bitmap(_word_hashes(words)), least))
    more = _phrase_counts(parse, pairs, longest, least)
    return stored(words.select("lang", F.lit(1).alias("n_words"), "phrase", "f").union(more)), totals


def scored(counts: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer candidate covers.

    ``counts`` is what phrase_counts gives; it has every part of a phrase that it has.
    """
    candidates = counts.where("n_words > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = candidates.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("tail")
    )
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    score = F.expr(f"cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    least = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("cut"))
    inner = F.expr(
        "flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))"
    )
    covers = candidates.where(F.size("w") > 2).select("lang", F.explode(inner).alias("phrase"), "a")
    covers = covers.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    # Percentages of 64-bit counts pass 64 bits.
    open_ = F.expr(f"longer is null or cast(longer as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * {held}")
    return least.join(covers, ["lang", "phrase"], "left").where(open_).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, held: int = HELD, most: int = MOST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` best phrases of each language.

    Reads text and lang of ``docs``. Order: score and a descending, phrase by its bytes. Repeated rows
    count again; null and empty texts hold no words; languages without a candidate
    have no row, nor has an empty table.
    """
    counts, totals = phrase_counts(docs, longest, least)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored(counts, held).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
