"""Removal of repeated passages against a count of all windows."""

import random
import re
from collections import Counter

import pytest

from fleetlife.llm import substrings


def plain(rows, span):
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in rows}
    count = Counter(tuple(w[i : i + span]) for w in words.values() for i in range(len(w) - span + 1))
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - span + 1):
            if count[tuple(w[i : i + span])] > 1:
                gone |= set(range(i, i + span))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def made(seed=2):
    pick = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(200)]
    fresh = lambda n: [pick.choice(vocabulary) for _ in range(n)]
    passages = [fresh(n) for n in (34, 35, 36, 60, 150)]
    rows = []
    for i in range(120):
        words = fresh(pick.choice([0, 3, 20, 50, 200]))
        for _ in range(pick.choice([0, 0, 1, 2])):
            passage = list(pick.choice(passages))
            if pick.random() < 0.3:
                passage[pick.randrange(len(passage))] = "edit"
            words += passage + fresh(pick.choice([0, 1, 30]))
        rows.append((i, pick.choice([" ", "\n", " \r\n"]).join(words)))
    rows += [(500 + i, rows[i * 7][1]) for i in range(10)]
    rows += [(600, None), (601, ""), (602, "x " * 36), (603, "y " * 35), (604, "a b " * 40), (605, "W " * 3000), (606, " ".join(passages[4] * 3))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("'k' as key", "text", "doc_id", "1 as at").repartition(6)


@pytest.mark.parametrize("most_slices, most_rows", [(2000, 100_000), (3, 100_000), (3, 4)])
def test_equals_the_count_of_windows(spark, most_slices, most_rows):
    rows = made()
    found = substrings.without_repeats(frame(spark, rows), 35, most_slices=most_slices, most_rows=most_rows)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in found.collect()} == plain(rows, 35)


def test_empty_table(spark):
    assert substrings.without_repeats(frame(spark, made()).limit(0)).collect() == []


def test_automaton_finds_longest_repeats():
    pick = random.Random(4)
    for _ in range(200):
        text = [pick.randrange(3) for _ in range(pick.randrange(1, 40))]
        got = substrings.Automaton(text).matching_statistics()
        for end in range(len(text)):
            best = 0
            for size in range(1, end + 2):
                part = text[end + 1 - size : end + 1]
                if sum(text[i : i + size] == part for i in range(len(text) - size + 1)) > 1:
                    best = size
            assert got[end] == best


def test_rows_of_one_id_and_of_none(spark):
    passage = " ".join(f"w{i}" for i in range(80))
    rows = [(1, passage), (1, "five words stay as they are"), (2, passage), (None, passage + " more"), (3, "x")]
    got = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got) == [(0, 81, 80), (1, 6, 0), (1, 80, 80), (2, 80, 80), (3, 1, 0)]
