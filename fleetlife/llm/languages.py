"""Language of whole texts by a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time, on a bounded
sample: ``per_language`` documents of each language, ``pieces`` byte stretches each. Every
byte position gets a probability per language from a state that read the bytes before
it and one that read those after it, within pieces of ``PIECE`` bytes; all pieces of the whole
text are read. A document's probabilities are the means over its positions.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fleetlife.llm.words import chunks

PIECE = 256
STATES = 8
TRAINED_BYTES = 64
#: More languages than that are refused: their sample goes to the driver.
MOST_LANGUAGES = 200
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class Direction:
    """One gated recurrent layer; bytes are its one-hot inputs, so inputs are rows of a table."""

    def __init__(self, pick, states):
        self.n = states
        self.table = pick.normal(0, 0.3, (256, 3 * states)).astype(np.float32)
        self.back = pick.normal(0, 0.3, (states, 3 * states)).astype(np.float32)

    def weights(self):
        return [self.table, self.back]

    def states(self, x, inside=None, trace=None):
        """States (steps, rows, n) of bytes x (steps, rows). inside: 0 where a row has no byte."""
        n = self.n
        out = np.empty((*x.shape, n), np.float32)
        h = np.zeros((x.shape[1], n), np.float32)
        for t in range(len(x)):
            own = self.table[x[t]]
            fed = h @ self.back
            gates = own[:, : 2 * n] + fed[:, : 2 * n]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            z, r = gates[:, :n], gates[:, n:]
            new = fed[:, 2 * n :] * r
            new += own[:, 2 * n :]
            np.tanh(new, out=new)
            if trace is not None:
                trace.append((h, z, r, new, fed[:, 2 * n :]))
            h = new + z * (h - new)
            if inside is not None:
                h *= inside[t]
            out[t] = h
        return out

    def gradients(self, x, trace, d_states):
        """Backpropagation through time: gradients of the table and of the recurrent weights."""
        n = self.n
        d_back = np.zeros_like(self.back)
        d_own = np.empty((*x.shape, 3 * n), np.float32)
        dh = np.zeros((x.shape[1], n), np.float32)
        for t in reversed(range(len(x))):
            h, z, r, new, fed = trace[t]
            dh = dh + d_states[t]
            dn = dh * (1 - z) * (1 - new * new)
            dz = dh * (h - new) * z * (1 - z)
            dr = dn * fed * r * (1 - r)
            d_own[t] = np.concatenate([dz, dr, dn], 1)
            d_fed = np.concatenate([dz, dr, dn * r], 1)
            d_back += h.T @ d_fed
            dh = dh * z + d_fed @ self.back.T
        d_table = np.zeros_like(self.table)
        np.add.at(d_table, x.ravel(), d_own.reshape(-1, 3 * n))
        return [d_table, d_back]


class Network:
    def __init__(self, languages, states=STATES, seed=7):
        pick = np.random.default_rng(seed)
        self.languages = list(languages)
        self.ahead, self.behind = Direction(pick, states), Direction(pick, states)
        self.out = pick.normal(0, 0.3, (2 * states, len(self.languages))).astype(np.float32)
        self.bias = np.zeros(len(self.languages), np.float32)

    def probabilities(self, x, inside=None, traces=(None, None)):
        """(steps, rows, languages) and the joined states."""
        turned = None if inside is None else inside[::-1]
        joined = np.concatenate([self.ahead.states(x, None, traces[0]), self.behind.states(x[::-1], turned, traces[1])[::-1]], 2)
        scores = joined @ self.out + self.bias
        scores -= scores.max(2, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(2, keepdims=True)
        return scores, joined

    def train(self, x, y, rounds, rate=0.02, batch=128, seed=11):
        """Adam on the cross-entropy of every position."""
        pick = np.random.default_rng(seed)
        weights = [*self.ahead.weights(), *self.behind.weights(), self.out, self.bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        step, total = 0, rounds * -(-len(y) // batch)
        for _ in range(rounds):
            order = pick.permutation(len(y))
            for at in range(0, len(y), batch):
                rows = order[at : at + batch]
                own, step = np.ascontiguousarray(x[rows].T), step + 1
                traces = ([], [])
                p, joined = self.probabilities(own, None, traces)
                p[:, np.arange(len(rows)), y[rows]] -= 1
                p /= p.shape[0] * p.shape[1]
                d_joined, n = p @ self.out.T, self.ahead.n
                flat = p.reshape(-1, p.shape[2])
                found = [
                    *self.ahead.gradients(own, traces[0], d_joined[:, :, :n]),
                    *self.behind.gradients(own[::-1], traces[1], d_joined[::-1, :, n:]),
                    joined.reshape(-1, 2 * n).T @ flat,
                    flat.sum(0),
                ]
                now = rate * (1 - 0.9 * step / total)
                for w, g, a, b in zip(weights, found, first, second):
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    w -= now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        return self

    def pooled(self, data, offsets):
        """Mean probabilities over all positions of each row (rows, languages); empty rows get zeros."""
        sizes = np.diff(offsets)
        pieces = -(-sizes // PIECE)
        rows = np.repeat(np.arange(len(sizes)), pieces)
        nth = np.arange(len(rows)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = offsets[:-1][rows] + nth * PIECE
        length = np.minimum(PIECE, offsets[1:][rows] - start)
        sums = np.zeros((len(sizes), len(self.languages)))
        order = np.argsort(-length, kind="stable")  # pieces of like length run together
        for low in range(0, len(order), 2048):
            own = order[low : low + 2048]
            steps = int(length[own[0]])
            at = np.arange(steps)[:, None]
            inside = at < length[own]
            x = data[np.where(inside, start[own] + at, 0)]
            mask = None if inside.all() else inside.astype(np.float32)
            p, _ = self.probabilities(x, None if mask is None else mask[:, :, None])
            if mask is not None:
                p *= mask[:, :, None]
            np.add.at(sums, rows[own], p.sum(0, dtype=np.float64))
        return sums / np.maximum(sizes, 1)[:, None]


def training_pieces(docs: DataFrame, per_language: int, pieces: int) -> DataFrame:
    """(lang, piece) of the sampled documents: the smallest hashes of doc_id of each language, of
    repeated ids the first text in alphabet.

    A language's documents are ranked in parts first, so that none is ranked in one task.
    """
    number = F.xxhash64(F.col("doc_id").cast("string"))
    labelled = docs.where("text is not null and lang is not null").select("doc_id", "lang", "text", number.alias("number"))
    ranked = labelled.groupBy("lang", "doc_id").agg(F.first("number").alias("number"))
    for by in (["lang", F.pmod("number", F.lit(997))], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("number", "doc_id"))
        ranked = ranked.withColumn("nth", rank).where(F.col("nth") <= per_language).drop("nth")
    # Repeated rows are ranked once, so this many ids are known to be all that is brought together.
    held = ranked.select("lang", "doc_id").limit(MOST_LANGUAGES * per_language + 1).toArrow()
    if held.num_rows > MOST_LANGUAGES * per_language or len(set(held["lang"].to_pylist())) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    known = docs.sparkSession.createDataFrame(held, labelled.select("lang", "doc_id").schema)
    chosen = labelled.join(F.broadcast(known), ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(F.min("text").alias("text")).select("lang", "text")

    def cut(batches):
        for batch in batches:
            langs, out = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                for i in range(pieces):
                    at = (2 * i + 1) * max(0, len(raw) - TRAINED_BYTES) // (2 * pieces)
                    part = raw[at : at + TRAINED_BYTES]
                    if part and lang is not None:
                        langs.append(lang)
                        out.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], names=["lang", "piece"])

    return chosen.mapInArrow(cut, "lang string, piece binary")


def fit(docs: DataFrame, per_language: int = 300, pieces: int = 6, rounds: int = 5) -> Network | None:
    """Train on a bounded sample of (doc_id, text, lang); None where there is no labelled text.

    At most ``per_language`` documents of a language and ``pieces`` stretches of
    TRAINED_BYTES bytes of each come to the driver.
    """
    rows = sorted((r.lang, bytes(r.piece)) for r in training_pieces(docs, per_language, pieces).collect())
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    x = np.full((len(rows), TRAINED_BYTES), 32, np.uint8)
    for i, (_, piece) in enumerate(rows):
        piece = np.frombuffer(piece, np.uint8)
        x[i] = np.resize(piece, TRAINED_BYTES)
    y = np.searchsorted(languages, [lang for lang, _ in rows])
    return Network(languages).train(x, y, rounds)


def predict(docs: DataFrame, network: Network | None, keep_text: bool = False) -> DataFrame:
    """Rows of ``docs`` (text first, any other columns after it) with lang_pred and score for text;
    the text itself is left out unless ``keep_text`` is set.

    Null text and text without a letter is ``und`` with score 0, as is every text where
    nothing could be learned. Ties go to the language first in alphabet.
    """

    def run(batches):
        for batch in batches:
            names, scores = [], []
            column = batch.column(0)
            for low, high, data, offsets in chunks(column):
                letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
                known = (letters[offsets[1:]] > letters[offsets[:-1]]).tolist()
                for i in (i for i, k in enumerate(known) if not k):
                    text = column[low + i].as_py()
                    known[i] = text is not None and any(c.isalpha() for c in text)
                p = network.pooled(data, offsets) if network else np.zeros((high - low, 1))
                best = p.argmax(1)
                for i, k in enumerate(known):
                    names.append(network.languages[best[i]] if k and network else UNKNOWN)
                    scores.append(min(1.0, float(p[i, best[i]])) if k and network else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[left:], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*rest, "lang_pred", "score"])

    left = 0 if keep_text else 1
    rest = docs.columns[left:]
    found = T.StructType(docs.schema.fields[left:]).add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(run, found)


def held_out(doc_id="doc_id"):
    """Documents that are never learned from: a fifth, by the checksum of the id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def language_id(docs: DataFrame, **sizes) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text, lang).

    Learns from text and lang of rows that are not held out; a null doc_id is held out.
    Predictions look at the text only. Every row, also a repeated one, gives a row; an
    empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    network = fit(docs.where(~held_out()), **sizes)
    found = predict(docs.select("text", "doc_id"), network)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
