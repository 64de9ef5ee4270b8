"""The Jaccard join against all pairs, on sets of every size."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from fleetlife.llm import jaccard


def plain_sets(rows, k):
    out = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        out[doc_id] = {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()
    return out


def plain_components(sets, percent):
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    common = defaultdict(int)
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {d: root(d) for d in sets}


def made(seed=3, n=80):
    pick = random.Random(seed)
    vocabulary = [f"Wort{i}é" for i in range(60)]
    rows, doc_id = [], 0
    for size in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 45, 70, 120, 250, 600] * (n // 20):
        base = [pick.choice(vocabulary) for _ in range(size)]
        for _ in range(pick.choice([1, 2, 4, 9])):
            words = list(base)
            for _ in range(pick.choice([0, 0, 1, 1, 2, 3]) * max(1, size // 60)):
                if words:
                    at = pick.randrange(len(words))
                    words[at : at + 1] = pick.choice([[], ["x"], [words[at], "neu"]])
            rows.append((doc_id, pick.choice([" ", "\n", "\t "]).join(words)))
            doc_id += 1
    rows += [(doc_id, None), (doc_id + 1, ""), (doc_id + 2, " \n "), (doc_id + 3, "UND und"), (doc_id + 4, "und\vUND")]
    return rows


@pytest.mark.parametrize("percent", [85, 60])
def test_components_equal_all_pairs(spark, percent):
    rows = made()
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "1 as sig", "2 as a", "doc_id", "'t' as tokens").repartition(5)
    sets = plain_sets(rows, 4)
    wanted = plain_components(sets, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.ngram_jaccard_join(frame, 4, percent).collect()}
    assert got == {d: (len(sets[d]), wanted[d]) for d in sets}


def test_large_group_of_near_copies(spark):
    pick = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(2):
            words[pick.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(words)))
    got = jaccard.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    wanted = plain_components(plain_sets(rows, 4), 85)
    assert {r.doc_id: r.component_id for r in got} == wanted


def test_group_of_chained_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 20)
    pick = random.Random(8)
    rows = []
    for group in range(3):
        base = [f"g{group}w{i}" for i in range(200)]
        for i in range(60):
            words = list(base)
            for _ in range(pick.choice([0, 1, 3, 5, 9, 14])):
                words[pick.randrange(200)] = f"x{pick.randrange(40)}"
            rows.append((100 * group + i, " ".join(words)))
    got = jaccard.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    wanted = plain_components(plain_sets(rows, 4), 85)
    assert len(set(wanted.values())) > 10
    assert {r.doc_id: r.component_id for r in got} == wanted


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard.ngram_jaccard_join(frame).select("doc_id", "n_shingles", "component_id").collect())
    assert got == [(1, 3, 1), (2, 3, 1)]
    assert jaccard.ngram_jaccard_join(frame.limit(0)).collect() == []


def test_every_linked_pair_shares_an_entry():
    pick = np.random.default_rng(1)
    schemes = jaccard.Schemes(85)
    for _ in range(1500):
        size = int(pick.choice([6, 7, 8, 11, 13, 20, 40, 64, 70, 150, 400]))
        first = np.unique(pick.integers(0, 1 << 62, size, dtype=np.uint64))
        drop = int(pick.integers(0, size // 6 + 1))
        second = np.unique(np.concatenate([first[drop:], pick.integers(0, 1 << 62, int(pick.integers(0, size // 6 + 1)), dtype=np.uint64)]))
        same = len(np.intersect1d(first, second))
        if len(first) == len(second) == same or 100 * same < 85 * (len(first) + len(second) - same):
            continue
        own = [set(np.concatenate(jaccard.signatures(s, schemes)).tolist()) for s in (first, second)]
        assert own[0] & own[1], (size, drop)
