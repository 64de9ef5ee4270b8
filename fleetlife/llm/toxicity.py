"""Toxicity by a weighted finite-state grammar of clauses.

Words become symbols (insult, threat, target, negation, report, other). Three transducers rewrite
them one after the other: negation marks what stands within a few words behind it, reported
speech what follows in its clause, and the last one keeps a clause's strongest finding and whether
somebody is addressed. They are composed into one table of states once; a clause runs
through it, and its end state names the pattern that it matches, its arcs add up to its weight. A
word outside a clause pattern counts for nothing: documents are scored by the weights of their
matched clauses, pattern by pattern, in a logistic model.

Which words insult, and how much, is learned: from a bounded sample of labelled documents, words and
word beginnings get the log-odds of the label, where a likelihood-ratio test tells them from chance. The model's
coefficients come from clauses that are weighted with words of the other half of the sample.
"""

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlife.llm.words import MARKS, PLAIN, chunks, grams, mix, powers, text_words, word_bounds

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
KINDS = ("other", "insult", "threat", "target", "negation", "report")
#: A finding is a symbol above the kinds: 6 + 2 * mark + (0 insult, 1 threat).
PLAINLY, REPORTED, DENIED = range(3)

#: Function words of the grammar, by language, and words that count until labels say otherwise.
TARGETS = "you your yours yourself u ur du dich dir dein deine euch ihr sie tu toi te ton ta tes vous votre vos usted ustedes tú ti tus su vosotros"
NEGATIONS = "not no never nobody isn aren don doesn wasn nicht kein keine keinen nie niemals ne pas jamais aucun aucune nunca jamás ningún ninguna sin"
REPORTS = "said says saying told called calls claimed wrote quoted according sagte sagt nannte behauptete schrieb dit disait appelé écrit selon dijo dice llamó escribió según"
THREATS = "kill killing murder hurt strangle stab shoot destroy töten umbringen verletzen tuer blesser frapper matar herir golpear"
INSULTS = "idiot moron imbecile stupid fool scum loser bastard idiota estúpido imbécil idiote débile dummkopf vollidiot abschaum"

#: Words that a negation reaches.
SCOPE = 3
#: Share of a word's weight that its finding keeps, by mark.
KEPT = (1.0, 0.5, 0.25)
SEED_WEIGHT = 3.0
#: A clause weighs at most so much.
CLAUSE_MOST = 8.0
#: Documents of each label that the words are learned from, taken by hash.
PER_LABEL = 8000
#: Learned words and beginnings, those with the most evidence.
MOST_FEATURES = 20000
#: Bytes of the word beginnings that may be learned.
BEGINNINGS = (4, 5, 6)
#: Least evidence (log-likelihood ratio) and least log-odds of a learned word.
EVIDENCE, ODDS = 30.0, 2.0
THRESHOLD = 0.7
RIDGE = 0.05
#: Smallest hashes by which near copies among the labelled documents are told.
SIGNATURES = 4

CLAUSE_END = np.zeros(256, bool)
CLAUSE_END[[46, 33, 63, 59, 10]] = True


@dataclass(frozen=True)
class Transducer:
    """Deterministic: arcs (state, symbol) -> (state, symbol); what has no arc stays and passes unchanged."""

    states: int
    symbols: int
    arcs: dict = field(default_factory=dict)

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        return self.arcs.get((state, symbol), (state, symbol))


def marked(symbol: int, mark: int) -> int:
    """A finding (or the bare word) with a mark; a stronger one stays."""
    if symbol in (INSULT, THREAT):
        return 6 + 2 * mark + symbol - INSULT
    return max(symbol, 6 + 2 * mark + symbol % 2) if symbol >= 6 else symbol


SYMBOLS = 12


def negation(scope: int = SCOPE) -> Transducer:
    arcs = {}
    for state in range(scope + 1):
        for symbol in range(SYMBOLS):
            after = scope if symbol == NEGATION else max(0, state - 1)
            arcs[state, symbol] = (after, marked(symbol, DENIED if state else PLAINLY))
    return Transducer(scope + 1, SYMBOLS, arcs)


def reported_speech() -> Transducer:
    arcs = {(0, REPORT): (1, REPORT)}
    arcs |= {(1, symbol): (1, marked(symbol, REPORTED)) for symbol in range(6, SYMBOLS)}
    return Transducer(2, SYMBOLS, arcs)


def strongest() -> Transducer:
    """States 2 * finding + target. Findings: 0 none, then denied, reported and plain insults and threats by strength."""
    arcs = {}
    for state in range(14):
        best, target = divmod(state, 2)
        for symbol in range(SYMBOLS):
            found = 0 if symbol < 6 else 2 * (DENIED - (symbol - 6) // 2) + symbol % 2 + 1
            arcs[state, symbol] = (2 * max(best, found) + max(target, symbol == TARGET), symbol)
    return Transducer(14, SYMBOLS, arcs)


PATTERNS = tuple(
    f"{'targeted ' if target else ''}{mark}{kind}" for mark in ("denied ", "reported ", "") for kind in ("insult", "threat") for target in (0, 1)
)


def compose(first: Transducer, second: Transducer) -> tuple[Transducer, list[tuple[int, int]]]:
    """The transducer that feeds what ``first`` writes to ``second``, and the pair of states that each of
    its states stands for. Only pairs that can be reached become states."""
    pairs, place, arcs = [(0, 0)], {(0, 0): 0}, {}
    waiting = deque(pairs)
    while waiting:
        pair = waiting.popleft()
        for symbol in range(first.symbols):
            one, between = first.step(pair[0], symbol)
            two, out = second.step(pair[1], between)
            after = (one, two)
            if after not in place:
                place[after] = len(pairs)
                pairs.append(after)
                waiting.append(after)
            arcs[place[pair], symbol] = (place[after], out)
    return Transducer(len(pairs), first.symbols, arcs), pairs


class Grammar:
    """The composed transducers as lists: next state and share of the weight by (state, kind), pattern by state."""

    def __init__(self, scope: int = SCOPE):
        half, _ = compose(negation(scope), reported_speech())
        machine, pairs = compose(half, strongest())
        self.next = [[machine.step(s, k)[0] for k in range(6)] for s in range(machine.states)]
        out = [[machine.step(s, k)[1] for k in range(6)] for s in range(machine.states)]
        self.share = [[KEPT[(o - 6) // 2] if o >= 6 else 0.0 for o in row] for row in out]
        self.pattern = [pair[1] - 2 for pair in pairs]  # below 0: no finding

    def match(self, kinds, weights) -> tuple[int, float]:
        """(pattern, weight) of a clause; pattern -1 where nothing is found."""
        state, total = 0, 0.0
        for kind, weight in zip(kinds, weights):
            total += weight * self.share[state][kind]
            state = self.next[state][kind]
        pattern = self.pattern[state]
        return (pattern, min(total, CLAUSE_MOST)) if pattern >= 0 else (-1, 0.0)


def _seed(words: str) -> list[int]:
    return sorted({h for word in words.split() for h in text_words(word)})


FUNCTION_WORDS = {h: kind for kind, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for h in _seed(words)}
SEEDS = {h: kind for kind, words in ((INSULT, INSULTS), (THREAT, THREATS)) for h in _seed(words)}


def held_out(doc_id="doc_id") -> Column:
    """Rows whose labels no one learns from. A null doc_id is none of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


class _Words:
    """Words of some texts: hash of each, hashes of its beginnings (0 where it is no longer than that)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.start, self.end, self.first = word_bounds(data, offsets, MARKS)
        n = len(self.start)
        self.hash, self.beginnings = np.zeros(n, np.uint64), np.zeros((len(BEGINNINGS), n), np.uint64)
        if not n:
            return
        lead = int(self.start[0])
        gaps = np.diff(np.append(self.start, len(data)))
        place = np.arange(lead, len(data)) - np.repeat(self.start, gaps)
        value = PLAIN[data[lead:]] * powers(int(gaps.max()) + 1)[place]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(value)])
        size, at = self.end - self.start, self.start - lead
        self.hash = mix(sums[at + size] - sums[at] + size.astype(np.uint64))
        for i, k in enumerate(BEGINNINGS):
            long_ = np.flatnonzero(size > k)
            self.beginnings[i, long_] = mix(sums[at[long_] + k] - sums[at[long_]] + np.uint64((k << 40) + 1))


def _count_features(sample: DataFrame) -> DataFrame:
    """(feature, part, n1, n0): documents of either label that hold a word or beginning, by half of the sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                label, part = batch.column("label").to_numpy(), batch.column("part").to_numpy()
                for low, high, data, offsets in chunks(batch.column("text")):
                    words = _Words(data, offsets)
                    row = np.repeat(np.arange(low, high), np.diff(words.first))
                    feature = np.concatenate([words.hash, *words.beginnings])
                    row = np.tile(row, 1 + len(BEGINNINGS))[feature != 0]
                    feature = feature[feature != 0]
                    order = np.lexsort((row, feature))
                    feature, row = feature[order], row[order]
                    new = np.ones(len(row), bool)
                    new[1:] = (feature[1:] != feature[:-1]) | (row[1:] != row[:-1])
                    feature, row = feature[new], row[new]
                    one = (label[row] == 1).astype(np.int64)
                    yield pa.record_batch([pa.array(feature.view(np.int64)), pa.array(part[row].astype(np.int32)), pa.array(one), pa.array(1 - one)], ["feature", "part", "n1", "n0"])

    rows = sample.select("text", "label", "part").mapInArrow(count, "feature long, part int, n1 long, n0 long")
    return rows.groupBy("feature", "part").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def _weights(counts: DataFrame, all1: int, all0: int) -> dict[int, float]:
    """Log-odds of the features (feature, n1, n0) that evidence supports; a seed's weight ends where labels speak against it."""
    n, seen = float(all1 + all0), F.col("n1") + F.col("n0")

    def term(have: Column, expected: Column) -> Column:
        return F.when(have > 0, have * F.log(have / expected)).otherwise(0.0)

    one, zero = max(all1, 1) / max(n, 1.0), max(all0, 1) / max(n, 1.0)
    evidence = 2 * (term(F.col("n1"), seen * one) + term(F.col("n0"), seen * zero))
    odds = F.log((F.col("n1") + 0.5) / (all1 + 1) / ((F.col("n0") + 0.5) / (all0 + 1)))
    rows = counts.withColumn("odds", odds).withColumn("evidence", evidence).where(F.col("n1") + F.col("n0") > 0)
    learned = rows.where((F.col("odds") >= ODDS) & (F.col("evidence") >= EVIDENCE)).orderBy(F.desc("evidence"), "feature").limit(MOST_FEATURES)
    against = rows.where(F.col("feature").isin([int(np.uint64(h).view(np.int64)) for h in SEEDS]) & (F.col("odds") < ODDS) & (F.col("n0") >= 5))
    weights = dict.fromkeys(SEEDS, SEED_WEIGHT)
    for row in against.select("feature").collect():
        weights.pop(int(np.int64(row.feature).view(np.uint64)), None)
    for row in learned.select("feature", "odds").collect():
        weights[int(np.int64(row.feature).view(np.uint64))] = float(row.odds)
    return weights


@dataclass(frozen=True)
class Model:
    """Weighted words by ascending hash, and coefficients: one a pattern, then the strongest clause, then the constant."""

    known: np.ndarray
    weight: np.ndarray
    kind: np.ndarray
    coefficients: np.ndarray


#: Coefficients before any label is seen.
PRIOR = np.array([0.2, 0.4, 0.2, 0.5, 0.5, 0.8, 0.5, 0.8, 0.9, 1.2, 0.9, 1.2, 0.6, -3.0])


def _model(weights: dict[int, float], coefficients=PRIOR) -> Model:
    known = np.array(sorted(set(weights) | set(FUNCTION_WORDS)), np.uint64)
    weight = np.array([weights.get(int(h), 0.0) for h in known])
    # A function word stays one, whatever its odds are.
    kind = np.array([FUNCTION_WORDS.get(int(h)) or SEEDS.get(int(h), INSULT) for h in known])
    return Model(known, np.where(kind <= THREAT, weight, 0.0), kind, np.asarray(coefficients, float))


def _found(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(model.known, hashes), len(model.known) - 1)
    same = model.known[at] == hashes
    return np.where(same, model.kind[at], OTHER), np.where(same, model.weight[at], 0.0)


def _clauses(model: Model, grammar: Grammar, data: np.ndarray, offsets: np.ndarray):
    """(row, first byte, end byte, pattern, weight) of the matched clauses of some texts."""
    words = _Words(data, offsets)
    if not len(words.hash):
        return []
    kind, weight = _found(model, words.hash)
    for hashes in words.beginnings:
        other, more = _found(model, hashes)
        better = (kind <= THREAT) & (more > weight)
        kind, weight = np.where(better, other, kind), np.where(better, more, weight)
    hits = np.flatnonzero((kind == INSULT) | (kind == THREAT))
    if not len(hits):
        return []
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
    before = np.cumsum(CLAUSE_END[data])[words.start]
    opens = np.ones(len(row), bool)
    opens[1:] = (row[1:] != row[:-1]) | (before[1:] != before[:-1])
    start = np.flatnonzero(opens)
    end = np.append(start[1:], len(row))
    out = []
    for c in np.unique(np.searchsorted(start, hits, "right") - 1).tolist():
        a, b = int(start[c]), int(end[c])
        pattern, total = grammar.match(kind[a:b].tolist(), weight[a:b].tolist())
        if pattern >= 0:
            out.append((int(row[a]), int(words.start[a]), int(words.end[b - 1]), pattern, total))
    return out


def _features(found, rows: int) -> np.ndarray:
    """(rows, patterns + 2): damped sums of clause weights by pattern, the strongest clause, a constant."""
    x = np.zeros((rows, len(PATTERNS) + 2))
    for row, _, _, pattern, weight in found:
        x[row, pattern] += weight
        x[row, -2] = max(x[row, -2], weight)
    x[:, :-2] = np.log1p(x[:, :-2])
    x[:, -1] = 1.0
    return x


CLAUSES = "array<struct<start: int, end: int, pattern: string, weight: double>>"


def _run(docs: DataFrame, model: Model, columns, schema: str, make) -> DataFrame:
    """``make`` gets the carried columns, the features and the matched clauses of a slice of rows."""
    told = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        grammar = Grammar()
        with np.errstate(over="ignore"):
            for batch in batches:
                for low, high, data, offsets in chunks(batch.column("text")):
                    found = _clauses(told.value, grammar, data, offsets)
                    yield make(batch.slice(low, high - low), _features(found, high - low), found, data, offsets, told.value)

    return docs.select(*columns, "text").mapInArrow(score, schema)


def _probability(x: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ coefficients, -40, 40)))


def _calibrated(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Coefficients of a logistic model drawn to PRIOR, by Newton steps."""
    beta, pull = PRIOR.copy(), np.full(len(PRIOR), RIDGE)
    for _ in range(steps if len(y) else 0):
        p = _probability(x, beta)
        gradient = x.T @ (p - y) + pull * (beta - PRIOR)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    # More of a finding never makes a text less toxic.
    return np.append(np.maximum(beta[:-1], 0.0), beta[-1])


def _signatures(rows: DataFrame) -> DataFrame:
    """(id, label, s0, s1, ...): smallest hashes of the three-word runs of each text, in several orders."""
    names = [f"s{i}" for i in range(SIGNATURES)]

    def emit(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                for low, high, data, offsets in chunks(batch.column("text")):
                    words = _Words(data, offsets)
                    runs = np.append(grams(words.hash, 3), np.zeros(min(2, len(words.hash)), np.uint64))
                    out = np.zeros((high - low, SIGNATURES), np.uint64)
                    for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
                        own = runs[a : b - 2] if b - a > 2 else words.hash[a:b]
                        for j in range(SIGNATURES if len(own) else 0):
                            out[i, j] = mix(own + np.uint64(j)).min()
                    columns = [batch.column("id").slice(low, high - low), batch.column("label").slice(low, high - low)]
                    yield pa.record_batch([*columns, *(pa.array(out[:, j].view(np.int64)) for j in range(SIGNATURES))], ["id", "label", *names])

    schema = "id long, label int, " + ", ".join(f"{name} long" for name in names)
    found = rows.select("id", "label", "text").mapInArrow(emit, schema)
    return found.groupBy("id", "label").agg(*(F.min(name).alias(name) for name in names))


def _without_copies(held: pa.Table) -> pa.Table:
    """(id, label) of the documents that have the smallest id of their label under each of their signatures."""
    ids, label = np.asarray(held["id"], np.int64), np.asarray(held["label"], np.int64)
    kept = np.ones(len(ids), bool)
    for j in range(SIGNATURES):
        order = np.lexsort((ids, np.asarray(held[f"s{j}"], np.int64), label))
        own, of = np.asarray(held[f"s{j}"], np.int64)[order], label[order]
        kept[order[1:]] &= (own[1:] != own[:-1]) | (of[1:] != of[:-1])
    return held.select(["id", "label"]).filter(pa.array(kept))


def _sample(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """Labelled documents to learn from: at most ``per_label`` ids of either label, first by hash, without the
    near copies among them, which would pass for evidence of their own."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("label"))
    parts = [known.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(per_label).toArrow() for value in (0, 1)]
    own = docs.select(F.col("doc_id").cast("long").alias("id"), "text")

    def among(table: pa.Table) -> DataFrame:
        return own.join(F.broadcast(docs.sparkSession.createDataFrame(table, "id long, label int")), "id")

    single = among(_without_copies(_signatures(among(pa.concat_tables(parts))).toArrow()))
    return single.withColumn("part", (F.crc32(F.col("id").cast("string").cast("binary")) % 3).cast("int"))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Learn from ``labels`` (doc_id, toxic) of documents that are not held out.

    A doc_id with both labels counts as toxic; null labels and ids are left out. Without labels
    the fixed words and coefficients stand.
    """
    sample = _sample(docs, labels, per_label)
    counts = _count_features(sample).groupBy("feature").pivot("part", [0, 2]).agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).fillna(0)
    counts = counts.persist()
    try:
        size = {(r.part, r.label): r.n for r in sample.groupBy("part", "label").agg(F.count("*").alias("n")).collect()}
        total = {(p, y): size.get((p, y), 0) for p in (0, 2) for y in (0, 1)}

        def learned(*parts):
            n1, n0 = (sum((F.col(f"{p}_{name}") for p in parts), F.lit(0)) for name in ("n1", "n0"))
            return _weights(counts.select("feature", n1.alias("n1"), n0.alias("n0")), *(sum(total[p, y] for p in parts) for y in (1, 0)))

        xs, ys = [], []
        for part, other in ((0, 2), (2, 0)):
            rows = _run(sample.where(F.col("part") == part), _model(learned(other)), ("id", "label"), "id long, label int, x array<double>", _as_features)
            # Rows that repeat an id count as one, the one with the least features.
            held = rows.groupBy("id").agg(F.min(F.struct("x", "label")).alias("one")).select("one.x", "one.label").toArrow()
            xs.append(np.array(held["x"].to_pylist(), float).reshape(-1, len(PRIOR)))
            ys.append(np.asarray(held["label"], float))
        return _model(learned(0, 2), _calibrated(np.concatenate(xs), np.concatenate(ys)))
    finally:
        counts.unpersist()


def _as_features(batch, x, found, data, offsets, model):
    return pa.record_batch([batch.column("id"), batch.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))], ["id", "label", "x"])


def _as_scores(batch, x, found, data, offsets, model):
    probability = _probability(x, model.coefficients)
    clauses = [[] for _ in range(batch.num_rows)]
    if found:
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        for row, a, b, pattern, weight in found:
            zero = points[offsets[row]]
            clauses[row].append({"start": int(points[a] - zero), "end": int(points[b] - zero), "pattern": PATTERNS[pattern], "weight": weight})
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("pattern", pa.string()), ("weight", pa.float64())]))
    return pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(probability), pa.array(clauses, kind)], ["doc_id", "held_out", "score", "clauses"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, clauses) for each row of ``docs`` (doc_id, text).

    clauses: start and end in code points, pattern and weight of each matched clause. Null text is empty; texts
    without a match share one score. Equal texts score alike.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return _run(rows, model, ("doc_id", "held_out"), f"doc_id long, held_out boolean, score double, clauses {CLAUSES}", _as_scores)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, clauses) of every document, learned from the labels that are not held out."""
    found = score(docs, fit(docs, labels))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "clauses")
