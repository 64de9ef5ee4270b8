"""The grammar against a plain reading of clauses, the model by held-out accuracy."""

import itertools
import random
import zlib

import numpy as np

from fleetlife.llm import toxicity
from fleetlife.llm.toxicity import INSULT, NEGATION, OTHER, REPORT, TARGET, THREAT

SF = "/root/testdata/sf0.01"


def plain_match(kinds, weights):
    """A clause by the rules as they are told, without states."""
    best, total = None, 0.0
    for i, (kind, weight) in enumerate(zip(kinds, weights)):
        if kind not in (INSULT, THREAT):
            continue
        if NEGATION in kinds[max(0, i - toxicity.SCOPE) : i]:
            mark, strength = "denied ", 0
        elif REPORT in kinds[:i]:
            mark, strength = "reported ", 1
        else:
            mark, strength = "", 2
        total += weight * {"denied ": 0.25, "reported ": 0.5, "": 1.0}[mark]
        found = (strength, kind == THREAT, f"{mark}{'threat' if kind == THREAT else 'insult'}")
        best = max(best, found) if best else found
    if best is None:
        return None, 0.0
    return ("targeted " if TARGET in kinds else "") + best[2], min(total, toxicity.CLAUSE_MOST)


def test_composed_grammar_equals_the_rules():
    grammar = toxicity.Grammar()
    pick = random.Random(1)
    some = [[pick.randrange(6) for _ in range(pick.randrange(1, 15))] for _ in range(3000)]
    for kinds in itertools.chain(itertools.product(range(6), repeat=4), some):
        kinds = list(kinds)
        weights = [1.0 + i if k in (INSULT, THREAT) else 0.0 for i, k in enumerate(kinds)]
        pattern, weight = grammar.match(kinds, weights)
        assert (toxicity.PATTERNS[pattern] if pattern >= 0 else None, weight) == plain_match(kinds, weights), kinds


def test_composition_is_the_chain_of_its_parts():
    first, second = toxicity.negation(), toxicity.reported_speech()
    both, pairs = toxicity.compose(first, second)
    pick = random.Random(2)
    for _ in range(300):
        a = b = c = 0
        for symbol in [pick.randrange(6) for _ in range(12)]:
            a, between = first.step(a, symbol)
            b, wanted = second.step(b, between)
            c, got = both.step(c, symbol)
            assert got == wanted and pairs[c] == (a, b)


def clauses(spark, text):
    model = toxicity._model(dict.fromkeys(toxicity.SEEDS, 2.0))
    rows = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    return rows.score, [(text[c.start : c.end], c.pattern, c.weight) for c in rows.clauses]


def test_clauses_and_spans(spark):
    text = "Été. You are an IDIOT, you know! He said she is a moron; you are not stupid\nI will kill you. Nothing here"
    _, found = clauses(spark, text)
    assert found == [
        ("You are an IDIOT, you know", "targeted insult", 2.0),
        ("He said she is a moron", "reported insult", 1.0),
        ("you are not stupid", "targeted denied insult", 0.5),
        ("I will kill you", "targeted threat", 2.0),
    ]


def test_pattern_matters_not_the_word_alone(spark):
    plainly, denied, reported = (clauses(spark, t)[0] for t in ("a moron here", "never a moron here", "called a moron here"))
    assert clauses(spark, "you moron")[0] > plainly > reported > clauses(spark, "nothing")[0]
    assert plainly > denied


def made(spark, n=900):
    """Texts of invented words; label 1 holds words with one of two beginnings, one of a third of the texts ones of either."""
    pick = random.Random(7)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(pick.choice("abcdefg") for _ in range(pick.choice([3, 5, 8]))) for _ in range(pick.choice([5, 30, 200]))]
        toxic = int(pick.random() < 0.15)
        for _ in range(pick.choice([2, 3, 5]) * toxic):
            words.insert(pick.randrange(len(words)), pick.choice(["zorkü", "vélmu"]) + "".join(pick.choice("aeiou") for _ in range(3)))
        text = " ".join(w + pick.choice(["", "", "", ".", ",", "\n"]) for w in words)
        docs.append((i, text, "src", 1))
        if i % 5:
            labels.append((i, 1, toxic))
    return docs, labels


def test_learned_words_find_unlabelled_texts(spark):
    docs, labels = made(spark)
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string, label int").repartition(5)
    got = toxicity.toxicity(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "clauses"]
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == len(docs)
    for doc_id, text, *_ in docs:
        row = rows[doc_id]
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert row.predicted == int(row.score >= 0.7) == int("zork" in text or "vélm" in text), (doc_id, row.score)


def test_given_documents_by_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    wrong = [r for r in rows if r.toxic == 0 and r.predicted == 1]
    found = [r for r in rows if r.toxic == 1 and r.predicted == 1]
    assert not wrong and len(found) >= 0.6 * sum(r.toxic for r in rows)


def test_labels_of_held_out_documents_are_not_read(spark):
    docs, labels = made(spark, 300)
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, lang int")
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    a, b = (toxicity.toxicity(frame, spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).select("doc_id", "score").collect() for rows in (labels, turned))
    assert sorted(a) == sorted(b)


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, "you idiot"), (1, "you idiot"), (None, "you idiot"), (2, None), (3, ""), (4, "x " * 200000 + "you idiot"), (5, "..!?")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None), (9, 0)], "doc_id long, toxic int")
    for labels in (none, odd):
        got = [tuple(r)[:4] for r in toxicity.toxicity(docs, labels).collect()]
        assert len(got) == 7 and all(0 <= r[2] <= 1 for r in got)
        score = {r[0]: r[2] for r in got}
        assert score[2] == score[3] == score[5] < score[1] == score[None] and [r[1] for r in got if r[0] is None] == [False]
    assert toxicity.toxicity(docs.limit(0), none).collect() == []


def test_calibration_separates():
    pick = np.random.default_rng(0)
    x = np.zeros((400, len(toxicity.PRIOR)))
    x[:, -1] = 1
    y = (np.arange(400) % 8 == 0).astype(float)
    x[y == 1, 8] = pick.random(50) + 1
    p = toxicity._probability(x, toxicity._calibrated(x, y))
    assert p[y == 1].min() > 0.7 and p[y == 0].max() < 0.2
