"""Secret scan: patterns, and a character convolutional network for what they miss.

Candidates are the spans of the three base patterns and every other long token with
letters and digits that they don't cover. The network sees stretches of the candidate with the text before it
and after it, as classes of characters; a candidate scores as its highest stretch. It is trained in numpy by Spark tasks on labelled findings:
by default all that the patterns find, against words and formed things of every document. Its threshold is the
highest that keeps the wanted recall on findings left out of the training, whatever share of the
others passes; that share is kept and logged where it is above the wanted one. Base spans always
stay; the network adds candidates at or above the threshold.
"""

import copy
import logging
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlife.llm.store import stored

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Other candidates: tokens of 16 characters or more with a digit and a letter.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,}")
#: What is long and no secret: words, and things with a form of their own.
WORD = re.compile(r"[^\W\d_]{7,}")
FORMED = re.compile(r"[\w.+-]+@[\w-]+[\w.-]+|https?://[^\s\"'<>]+|\d{4}-\d\d-\d\d[\w:.+-]*|\d{7,}|[a-z]+(?:[-_.][a-z]+){2,}|(?:\d+[.:-]){2,}\d+")
NETWORK = "network"

BEFORE, INSIDE, AFTER = 24, 32, 8
WIDTH = BEFORE + INSIDE + AFTER
CLASSES = 48
#: Examples learned from in one go and how often; those of a shard, rounds of common weights, and how often a single shard goes over its examples.
FEW, PASSES = 6_000, 12
SHARD, ROUNDS, TURNS = 20_000, 6, 4
#: Steps of a score when the threshold is set: counts by step come from all examples that are kept out.
STEPS = 1 << 16
#: Stretches scored at once.
SCORED = 4096
FILTERS, REACH = 16, 5


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start and then kind as listed."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base) -> list[tuple[int, int]]:
    """Tokens that could be secrets and hold characters outside the base spans (by start)."""
    found = []
    for m in TOKEN.finditer(text):
        covered = m.start()
        for _, s, e in base:
            if s <= covered < e:
                covered = e
        if covered < m.end():
            found.append((m.start(), m.end()))
    return found


def stretches(start: int, end: int) -> list[int]:
    """Starts of the overlapping stretches of INSIDE characters that cover a candidate; the last ends with it."""
    return [*range(start, max(start + 1, end - INSIDE), INSIDE // 2), *([end - INSIDE] if end - start > INSIDE else [])]


def _class_of():
    """Characters share a class by use: digits, hex letters, other letters in both cases, single signs."""
    table = np.full(256, 1, np.uint8)
    for i, sign in enumerate("+/_.=-:\"' \n,;@"):
        table[ord(sign)] = 2 + i
    table[48:58] = 16
    for letter in range(26):
        table[97 + letter] = 17 + letter
        table[65 + letter] = 43 if letter < 6 else 44
    return table


CLASS = _class_of()


def picture(text: str, start: int, end: int, seen=True, at=None) -> np.ndarray:
    """The candidate from ``at`` on (its start) and its surroundings as WIDTH classes. Not seen: without what stands before it."""
    inside = start if at is None else at
    out = np.zeros(WIDTH, np.uint8)
    for at, part in ((0, text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0") if seen else ""), (BEFORE, text[inside : min(end, inside + INSIDE)]), (BEFORE + INSIDE, text[end : end + AFTER])):
        codes = np.frombuffer(part.encode("latin-1", "replace"), np.uint8)
        out[at : at + len(codes)] = CLASS[codes]
    return out


class Convolution:
    """One layer of filters over character classes, the largest and mean response of each, a logistic output."""

    def __init__(self, seed=5):
        pick = np.random.default_rng(seed)
        self.filters = pick.normal(0, 0.3, (REACH, CLASSES, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = pick.normal(0, 0.3, 2 * FILTERS).astype(np.float32)
        self.offset = np.zeros(1, np.float32)
        self.threshold = np.inf
        #: Share of the other examples kept out of the training that pass.
        self.false_rate = 0.0

    def _responses(self, x):
        """Filter responses (rows, places, filters): one-hot inputs make them sums of table rows."""
        places = WIDTH - REACH + 1
        total = np.broadcast_to(self.bias, (len(x), places, FILTERS)).copy()
        for j in range(REACH):
            total += self.filters[j][x[:, j : j + places]]
        return np.maximum(total, 0)

    def score(self, x):
        if not len(x):
            return np.zeros(0)
        a = self._responses(x)
        pooled = np.concatenate([a.max(1), a.mean(1)], 1)
        return 1 / (1 + np.exp(-(pooled @ self.out + self.offset[0])))

    def train(self, x, y, rounds=12, rate=0.01, batch=64, seed=9, weigh=None):
        """``weigh``: weights of an example that is none and of a finding; by default both kinds weigh the same in ``y``."""
        pick = np.random.default_rng(seed)
        weights = [self.filters, self.bias, self.out, self.offset]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        least, most = weigh or (0.5 / max(1 - y.mean(), 1e-9), 0.5 / max(y.mean(), 1e-9))
        share = np.where(y > 0, most, least)
        for _ in range(rounds):
            order = pick.permutation(len(y))
            for at in range(0, len(y), batch):
                rows, step = order[at : at + batch], step + 1
                own, places = x[rows], WIDTH - REACH + 1
                a = self._responses(own)
                top = a.argmax(1)
                pooled = np.concatenate([a.max(1), a.mean(1)], 1)
                p = 1 / (1 + np.exp(-(pooled @ self.out + self.offset[0])))
                d = ((p - y[rows]) * share[rows] / len(rows)).astype(np.float32)
                d_pooled = d[:, None] * self.out
                d_a = np.repeat(d_pooled[:, None, FILTERS:] / places, places, 1)
                np.put_along_axis(d_a, top[:, None], np.take_along_axis(d_a, top[:, None], 1) + d_pooled[:, None, :FILTERS], 1)
                d_a *= a > 0
                d_filters = np.zeros_like(self.filters)
                for j in range(REACH):
                    np.add.at(d_filters[j], own[:, j : j + places], d_a)
                found = [d_filters, d_a.sum((0, 1)), pooled.T @ d, d.sum(keepdims=True)]
                for w, g, m, v in zip(weights, found, first, second):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return self

    def calibrate(self, x, y, recall, most_false):
        """The highest threshold that keeps ``recall`` of the findings; without findings nothing passes.

        More than ``most_false`` of the others passing is logged and changes nothing."""
        return self.settle(self.score(x), np.ones(len(y), np.int64), y > 0, recall, most_false)

    def settle(self, scores, n, good, recall, most_false):
        """The same from scores that ``n`` examples each have."""
        order = np.argsort(scores[good], kind="stable")
        upto = np.cumsum(n[good][order])
        if len(upto):
            self.threshold = float(scores[good][order][np.searchsorted(upto, int((1 - recall) * upto[-1]), "right")])
            others = n[~good]
            self.false_rate = float(others[scores[~good] >= self.threshold].sum() / others.sum()) if len(others) else 0.0
            if self.false_rate > most_false:
                logging.getLogger(__name__).warning("%.1f %% of examples that are no secrets pass at recall %.2f; wanted at most %.1f %%", 100 * self.false_rate, recall, 100 * most_false)
        return self


def labelled_findings(docs: DataFrame) -> DataFrame:
    """(found, picture): the different examples of all documents.

    Spans of the patterns are findings (1), all of them; a document's first long word (0) and first thing with a form
    of its own, such as an address or a date (-1), are none. Other candidates have no label: they are what the
    network is to judge. Findings are shown with and without the text before them, so that
    the network doesn't learn the keyword alone.
    """

    def run(batches):
        for batch in batches:
            found, pictures = [], []
            for text in batch.column(0).to_pylist():
                if text:
                    for kind, s, e in base_spans(text):
                        if kind == "assign":
                            s = ASSIGN.match(text, s).start(2)
                        for seen in (True, False):
                            pictures.append(picture(text, s, e, seen).tobytes())
                            found.append(1)
                    for label, pattern in ((0, WORD), (-1, FORMED)):
                        if m := pattern.search(text):
                            pictures.append(picture(text, *m.span()).tobytes())
                            found.append(label)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(pictures, pa.binary())], names=["found", "picture"])

    return docs.select("text").mapInArrow(run, "found int, picture binary").distinct()


def _examples(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(table["picture"].to_pylist()), np.uint8).reshape(-1, WIDTH)
    return x, (np.asarray(table["found"]) == 1).astype(np.float32)


def fit(findings: DataFrame, recall: float, most_false: float) -> Convolution:
    """Train on all rows of (found, picture), found 1 for findings; the fourth by hash set the threshold.

    Rows are dealt to shards of about SHARD by hash. In each of ROUNDS rounds every shard goes on from the common weights
    over its own rows of that round, and the weights are averaged: every example is learned from, and what comes
    to the driver is one set of weights, added up by Spark. At most FEW examples are learned from in one go, PASSES times.
    """
    spark = findings.sparkSession
    placed = F.xxhash64("picture", "found")
    rows = stored(findings.select((F.col("found") == 1).cast("int").alias("found"), "picture", placed.alias("hash")))
    sides = {r["found"]: r["n"] for r in rows.groupBy("found").agg(F.count("*").alias("n")).collect()}
    network, total = Convolution(), sum(sides.values())
    if not (sides.get(0) and sides.get(1)):
        return network
    if total <= FEW:
        own = sorted((bytes(r.picture), r.found) for r in rows.collect())
        x, y = np.frombuffer(b"".join(p for p, _ in own), np.uint8).reshape(-1, WIDTH), np.array([f for _, f in own], np.float32)
        kept = np.arange(len(y)) % 4 == 3
        if y[kept].any():
            network.train(x[~kept], y[~kept], PASSES).calibrate(x[kept], y[kept], recall, most_false)
        return network
    shards, rounds = -(-total // SHARD), ROUNDS
    passes = max(1, TURNS // shards)
    part = F.pmod("hash", F.lit(4))
    dealt = rows.withColumns({"part": part, "shard": F.expr(f"cast(pmod(hash div 4, {shards}) as int)"), "round": F.expr(f"cast(pmod(hash div 4 div {shards}, {rounds}) as int)")})
    weigh = (0.5 * total / sides[0], 0.5 * total / sides[1])
    names = ["filters", "bias", "out", "offset"]
    sizes = [getattr(network, n).size for n in names]

    def learner(told, number):
        def learn(table):
            own = copy.deepcopy(told.value)
            x, y = _examples(table.sort_by([("hash", "ascending"), ("picture", "ascending")]))
            own.train(x, y, rounds=passes, seed=9 + number, weigh=weigh)
            flat = np.concatenate([getattr(own, n).ravel() for n in names]).astype(np.float64)
            # Whole numbers: sums do not depend on the order of addition.
            steps = np.rint(flat * len(y) * 2.0**24).astype(np.int64)
            return pa.table({"place": np.arange(len(flat), dtype=np.int32), "weight": steps, "n": np.full(len(flat), len(y), np.int64)})

        return learn

    for number in range(rounds):
        learn = learner(spark.sparkContext.broadcast(network), number)
        mine = dealt.where((F.col("part") != 3) & (F.col("round") == number))
        made = mine.repartition(shards, "shard").groupBy("shard").applyInArrow(learn, "place int, weight long, n long")
        made = made.groupBy("place").agg((F.sum("weight").cast("double") / F.sum("n") / 2.0**24).alias("weight")).orderBy("place").toArrow()
        if made.num_rows:
            flat = np.asarray(made["weight"]).astype(np.float32)
            for n, piece in zip(names, np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
                setattr(network, n, piece.reshape(getattr(network, n).shape).copy())
    told = spark.sparkContext.broadcast(network)

    def scored(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = _examples(pa.Table.from_batches([batch]))
                scores = np.concatenate([told.value.score(x[at : at + SCORED]) for at in range(0, len(x), SCORED)])
                yield pa.record_batch([pa.array(y.astype(np.int32)), pa.array(np.floor(scores * STEPS).astype(np.int32))], ["found", "step"])

    held = dealt.where("part = 3").select("found", "picture").mapInArrow(scored, "found int, step int").groupBy("found", "step").agg(F.count("*").alias("n")).toArrow()
    step, n, good = np.asarray(held["step"]), np.asarray(held["n"]), np.asarray(held["found"]) == 1
    return network.settle(step / STEPS, n, good, recall, most_false)


def find_secrets(docs: DataFrame, findings: DataFrame | None = None, recall: float = 0.98, most_false: float = 0.01, carried: tuple[str, ...] = ()) -> DataFrame:
    """Spans of secrets in every whole text.

    Takes doc_id and text; returns (doc_id, text, spans) and the columns named in ``carried``
    for each row, spans an array of (kind, start, finish, score) in code points, by start and then kind, finish exclusive.
    Base spans have score 1; kind ``network`` are those the network adds. ``findings``
    (found, picture) replaces those of the documents. Null text
    is empty text and has no span. Equal texts have equal spans; an empty table gives an
    empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carried)
    network = fit(labelled_findings(docs) if findings is None else findings, recall, most_false)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("finish", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        for batch in batches:
            out, waiting, pictures = [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                base = base_spans(text) if text else []
                out.append([(k, s, e, 1.0) for k, s, e in base])
                for s, e in candidates(text, base) if text else ():
                    for at in stretches(s, e):
                        waiting.append((row, s, e))
                        pictures.append(picture(text, s, e, at=at))
            if waiting:
                best = {}
                for at in range(0, len(pictures), SCORED):
                    for own, score in zip(waiting[at : at + SCORED], network.score(np.array(pictures[at : at + SCORED])).tolist()):
                        best[own] = max(score, best.get(own, 0.0))
                for (row, s, e), score in best.items():
                    if score >= network.threshold:
                        out[row].append((NETWORK, s, e, score))
                order = (*KINDS, NETWORK)
                for row in {w[0] for w in waiting}:
                    out[row].sort(key=lambda x: (x[1], order.index(x[0])))
            spans = [[dict(zip(("kind", "start", "finish", "score"), s)) for s in own] for own in out]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], names=["doc_id", "text", *carried, "spans"])

    spans = T.ArrayType(T.StructType().add("kind", "string").add("start", "integer").add("finish", "integer").add("score", "double"))
    return docs.mapInArrow(run, T.StructType(list(docs.schema.fields)).add("spans", spans))


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash and list of the spans of ``find_secrets``."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["finish"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != NETWORK)
    of_kind = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def redact(found: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """Rows of ``find_secrets`` with every span of text replaced and without spans; overlapping spans are one.

    Column expressions: a second Python step would double the workers that tasks keep.
    """
    text = F.col("text")

    def replaced(done, span):
        before = F.substring(text, done["until"] + 1, span["start"] - done["until"])
        kept = F.when(span["start"] >= done["until"], F.concat(done["kept"], before, F.lit(mark))).otherwise(done["kept"])
        return F.struct(F.greatest(done["until"], span["finish"]).alias("until"), kept.alias("kept"))

    def whole(done):
        return F.concat(done["kept"], F.substring(text, done["until"] + 1, F.length(text)))

    clean = F.aggregate("spans", F.struct(F.lit(0).alias("until"), F.lit("").alias("kept")), replaced, whole)
    columns = {c: F.when(F.size("spans") > 0, clean).otherwise(text).alias(c) if c == "text" else F.col(c) for c in found.columns if c != "spans"}
    return found.select(*columns.values())
