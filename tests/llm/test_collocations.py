"""Collocations against plain counting of every run of words."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from fleetlife.llm import collocations


def plain_counts(rows):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i : i + n])] += 1
    return counts, totals


def plain(rows, least=30, most=2000):
    counts, totals = plain_counts(rows)
    out = set()
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            longer = [q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * candidates[q] >= 80 * a for q in longer):
                continue
            score, _, left, right = min((2000000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (score, a, phrase, left, right) in enumerate(sorted(found)[:most]):
            out.add((lang, i + 1, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def texts(seed=2, n=250):
    pick = random.Random(seed)
    vocabulary = ["The", "of", "ein", "straße", "ñu", "x_y", "(a)", "z"]
    line = " ".join(pick.choice(vocabulary) for _ in range(60))
    rows = []
    for i in range(n):
        words = []
        for _ in range(pick.choice([0, 3, 20, 70])):
            words += pick.choice([["new", "york"], ["new", "York", "city"], ["ab", "cd", "ef", "gh"], [pick.choice(vocabulary)], [pick.choice(vocabulary)]])
            words[-1] += pick.choice(["", "", "", ".", ",", "\n", " !", ";", ":?"])
        rows.append((pick.choice([" ", "\t ", "  "]).join(words), pick.choice(["en", "en", "en", "de", None, ""])))
        if i % 3 == 0:
            rows.append((line, "en"))
    return rows + [(None, "en"), ("", None), ("...", "fr"), ("one", "fr"), ("same " * 3000, "rep")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").selectExpr("lang", "text", "1 as times", "'p' as phrase", "true as last")


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return [tuple(r) for r in df.collect()]


def test_collocations_equal_plain_ones(spark, monkeypatch):
    rows = texts()
    got = result(collocations.collocations(frame(spark, rows).repartition(4)))
    wanted = plain(rows)
    assert len(got) == len(wanted) and set(got) == wanted
    assert {r[0] for r in wanted} >= {"en", "de", "und", "", "rep"}


def test_ties_take_the_first_cut_and_the_first_phrases(spark):
    rows = [("a b c", "x")] * 40 + [("d e", "x")] * 40 + [("b a", "x")] * 3
    got = result(collocations.collocations(frame(spark, rows), least=3, most=2))
    assert set(got) == plain(rows, least=3, most=2)


def test_every_run_is_counted_once(spark):
    rows = texts(9, 60)
    counts, totals = plain_counts(rows)
    got, n = collocations.phrase_counts(frame(spark, rows), least=1)
    wanted = {(lang, len(p), " ".join(p), a) for lang, own in counts.items() for p, a in own.items()}
    assert {tuple(r) for r in got.collect()} == wanted
    assert {r.lang: r.n for r in n.collect()} == {k: v for k, v in totals.items() if v}


def test_equal_passages_give_equal_chunks(spark):
    pick = random.Random(1)
    passage = " ".join(f"w{pick.randrange(500)}" for _ in range(600))
    rows = [(" ".join(f"v{pick.randrange(500)}" for _ in range(pick.randrange(40))) + " " + passage, "en") for _ in range(20)]
    parse = collocations.dictionary(frame(spark, rows)).collect()
    assert sum(r.times == 20 for r in parse) > 10
    assert sum(len(r.chunk.split()) for r in parse) < 20 * 60 + 2 * 600


def test_cuts_depend_on_words_alone():
    import numpy as np

    raw = np.frombuffer(("a b c d e f g " * 40).encode(), np.uint8)
    row, text, last = collocations._parsed(raw, np.array([0, len(raw)]))
    assert isinstance(text, pa.StringArray) and set(row.tolist()) == {0} and last.tolist().count(True) == 1


def test_empty_tables(spark):
    assert result(collocations.collocations(frame(spark, []))) == []
    assert result(collocations.collocations(frame(spark, [(None, None), ("", "en"), ("few words here", "en")]))) == []
