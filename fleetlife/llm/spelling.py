"""Spelling variants: words one edit apart, found by pivotal grams.

All bigrams have one global order, rare ones first. A word's gram prefix holds its three
rarest bigrams (and all that tie with the third); two of them that do not overlap, the
cheapest such pair by dynamic programming, are its pivots. One edit spoils at most one
pivot. The word whose prefix ends earlier in the order then has a whole pivot that lies
in the other word's prefix, so looking up every word's pivots in an index of all
prefixes finds every pair.

Position limits sharpen the lookup: an edit lies in the left or in the right half of a pair,
so the other half is equal, and a pivot has moved by the difference of the lengths if the
edit is before it, and not at all if it is behind. A key of the index is therefore (bigram, place,
length, half, what that half holds). What shares a key is verified by edit distance.

Words of one length are worked on as one numpy matrix; Spark shuffles keys and words.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlife.llm.store import stored
from fleetlife.llm.words import mix, powers, signed

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form occurs at least so many times as often as the word.
RATIO = 10
#: One in so many runs loses a letter.
SLIP = 31
#: Bigrams of one prefix: 2 * 1 + 1.
PREFIX = 3
#: So many of the most frequent bigrams get a rank of their own; all others come before them, by code.
RANKED = 1 << 16
#: Chains of forms are followed by doubling; counts grow tenfold a step, so 2 ** 5 steps pass any chain of 64-bit counts.
DOUBLINGS = 5
SCHEMA = "key long, word string, n long, letters int"


def written_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): runs of letters with A-Z lower-cased, at least so long and so frequent.

    A run whose hash with its document's id is divisible by ``slip`` has lost one letter. A
    null doc_id counts as empty in the hash; null text holds no run.
    """
    found = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    place = F.expr("cast(h % length(run) as int)")
    word = F.when(F.col("h") % slip == 0, F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices of the batch's words of one length, their code points as a matrix)."""
    words = batch.column("word").to_pylist()
    sizes = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        if size > PREFIX:
            yield at, codes[starts[at][:, None] + np.arange(size)]


def _grams(codes: np.ndarray) -> np.ndarray:
    return (codes[:, :-1] << 21) | codes[:, 1:]


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, n): words in which each bigram stands, repeats counted."""

    def count(batches):
        for batch in batches:
            every = [_grams(codes).ravel() for _, codes in _matrices(batch)]
            if every:
                gram, n = np.unique(np.concatenate(every), return_counts=True)
                yield pa.record_batch([pa.array(gram), pa.array(n)], ["gram", "n"])

    return words.select("word").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def gram_order(words: DataFrame, most: int = RANKED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bigrams by code, rank of each, count of each) of the ``most`` frequent bigrams. Two letters of
    an alphabet of 90 make 8,100; whatever the alphabet, no more than ``most`` are brought together."""
    held = gram_counts(words).orderBy(F.desc("n"), F.desc("gram")).limit(most).toArrow()
    gram, n = np.asarray(held["gram"], np.int64), np.asarray(held["n"], np.int64)
    rank = np.empty(len(gram), np.int64)
    rank[np.lexsort((gram, n))] = np.arange(len(gram))
    order = np.argsort(gram)
    return gram[order], rank[order], n[order]


def _ranked(grams: np.ndarray, order) -> tuple[np.ndarray, np.ndarray]:
    """(rank, cost) of each bigram. Unlisted ones have negative ranks by code and cost nothing."""
    known, rank, n = order
    if not len(known):
        return grams - (1 << 50), np.zeros(grams.shape)
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    listed = known[at] == grams
    return np.where(listed, rank[at], grams - (1 << 50)), np.where(listed, n[at], 0).astype(float)


def prefixes(rank: np.ndarray) -> np.ndarray:
    """Which bigrams of each word are in its prefix."""
    return rank <= np.partition(rank, PREFIX - 1, axis=1)[:, PREFIX - 1 : PREFIX]


def pivots(cost: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the two pivots of each word: the cheapest two prefix bigrams without a common letter.

    Dynamic programming over places: the cheapest pair that ends at a place is that
    place and the cheapest bigram at least two places before it.
    """
    cost = np.where(inside, cost, np.inf)
    before = np.minimum.accumulate(cost, axis=1)[:, :-2]
    second = np.argmin(cost[:, 2:] + before, axis=1) + 2
    first = np.argmin(np.where(np.arange(cost.shape[1]) <= second[:, None] - 2, cost, np.inf), axis=1)
    return first, second


def _halves(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first k and of the last k letters of each word, for every k."""
    letters = mix(codes.astype(np.uint64) + np.uint64(1)) * powers(codes.shape[1])[: codes.shape[1]]
    turned = mix(codes[:, ::-1].astype(np.uint64) + np.uint64(1)) * powers(codes.shape[1])[: codes.shape[1]]
    zero = np.zeros((len(codes), 1), np.uint64)
    return np.hstack([zero, np.cumsum(letters, axis=1)]), np.hstack([zero, np.cumsum(turned, axis=1)])


def _odd_letters(codes: np.ndarray) -> np.ndarray:
    """A bit for each letter (modulo 32) that a word has an odd number of times. One edit turns at most two."""
    return np.bitwise_xor.reduce(np.uint32(1) << (codes & 31).astype(np.uint32), axis=1).view(np.int32)


def _key(gram, place, size: int, shorter: int, right: bool, half) -> np.ndarray:
    tag = np.uint64((size * 2 + size - shorter) * 2 + right)
    return mix(mix(gram.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64)) + tag + mix(half + tag))


def index_keys(codes: np.ndarray, order) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, key) of what the index holds: each prefix bigram, with either half, for partners of every length."""
    size, grams = codes.shape[1], _grams(codes)
    row, place = np.nonzero(prefixes(_ranked(grams, order)[0]))
    gram = grams[row, place]
    left, right = _halves(codes)
    for shorter in (size, size - 1):
        cut = shorter // 2
        yield row, _key(gram, place, size, shorter, False, left[row, cut])
        yield row, _key(gram, place, size, shorter, True, right[row, shorter - cut])


def probe_keys(codes: np.ndarray, order) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, key) under which a word's pivots look for partners one edit away."""
    size, grams = codes.shape[1], _grams(codes)
    rank, cost = _ranked(grams, order)
    left, right = _halves(codes)
    every = np.arange(len(codes))
    for place in pivots(cost, prefixes(rank)):
        gram = grams[every, place]
        for moved in (-1, 0, 1):
            partner, shorter = size + moved, min(size, size + moved)
            cut = shorter // 2
            # The edit is right of the cut: a pivot in the left half stays; one beyond may have moved.
            yield every, _key(gram, place, partner, shorter, False, left[:, cut])
            # The edit is left of the cut: a pivot in the right half moves; one before may have stayed.
            on = np.flatnonzero(place + moved >= 0)
            yield on, _key(gram[on], place[on] + moved, partner, shorter, True, right[on, shorter - cut])
            if moved:
                on = np.flatnonzero((place + 2 > cut) & (place + moved >= 0))
                yield on, _key(gram[on], place[on] + moved, partner, shorter, False, left[on, cut])
                on = np.flatnonzero(place < size - (shorter - cut))
                yield on, _key(gram[on], place[on], partner, shorter, True, right[on, shorter - cut])


def _entries(words: DataFrame, keys, order) -> DataFrame:
    """(key, word, n, letters) for every key that ``keys`` gives a word."""
    told = words.sparkSession.sparkContext.broadcast(order)

    def emit(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                for at, codes in _matrices(batch):
                    letters = _odd_letters(codes)
                    for row, key in keys(codes, told.value):
                        own = batch.take(pa.array(at[row]))
                        yield pa.record_batch([signed(key), own.column("word"), own.column("n"), pa.array(letters[row])], ["key", "word", "n", "letters"])

    return words.select("word", "n").mapInArrow(emit, SCHEMA)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) for each two words of ``words`` (word, n) exactly one inserted, deleted or replaced
    code point apart, both ways round.

    ``word`` is unique and has at least 4 code points; shorter ones have no two disjoint bigrams
    in every prefix and are refused.
    """
    if not words.where(F.length("word") <= PREFIX).isEmpty():
        raise ValueError(f"words of at least {PREFIX + 1} letters expected")
    order = gram_order(words)
    index = _entries(words, index_keys, order)
    probes = _entries(words, probe_keys, order).select("key", F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("letters").alias("near_letters"))
    # Counted as a long without sign: of an int Spark counts the sign bit 33 times.
    odd = F.col("letters").bitwiseXOR(F.col("near_letters")).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    alike = F.bit_count(odd) <= 2
    pairs = index.join(probes, "key").where(alike & (F.levenshtein("word", "near", 1) == 1))
    ends = F.explode(F.array(F.struct("word", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return pairs.select(ends.alias("end")).select("end.*").distinct()


def _followed(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms from each word of ``forms`` (word, form)."""
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        now = stored(now)
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return now


def spelling_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of ``words`` (word, n).

    A word's form is its most frequent near word (ties: first in code-point order) if that is
    at least ``ratio`` times as frequent, else null; root is the last word reached by forms. Every
    word has at most one row per near word, which is combined to a count and a minimum,
    so no group is brought together. An empty table gives an empty result.
    """
    words = stored(words)
    best = F.min(F.struct((-F.col("near_n")).alias("least"), "near"))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    known: Column = -F.col("best.least") >= F.col("n") * ratio
    rows = words.join(near, "word", "left")
    rows = stored(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(known, F.col("best.near")).alias("form"), F.when(known, -F.col("best.least")).alias("form_n")))
    roots = _followed(rows.where(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_groups(docs: DataFrame) -> DataFrame:
    """Spelling groups of the words written in ``docs`` (doc_id, text); further columns are ignored.

    Repeated rows count again; null and empty texts hold no words.
    """
    return spelling_groups(written_words(docs))
