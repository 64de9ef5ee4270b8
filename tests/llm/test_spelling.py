"""Spelling groups against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fleetlife.llm import spelling


def plain_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_groups(counts):
    near = {w: [v for v in counts if abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def changed(pick, word):
    at, letter = pick.randrange(len(word) + 1), pick.choice("abcñéÀxyz")
    return pick.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :]])


def vocabulary(seed, n=120, letters="abcdeéñ"):
    pick = random.Random(seed)
    words = {"".join(pick.choice(letters) for _ in range(pick.choice([4, 5, 7, 8, 9, 13, 30]))) for _ in range(n)}
    words |= {"aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "ababababa", "babababa", "a" * 400, "a" * 401}
    for _ in range(3):
        words |= {changed(pick, w) for w in sorted(words)}
    return sorted(w for w in words if len(w) >= 4)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_words_equal_all_pairs(spark, seed):
    words = vocabulary(seed)
    frame = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long").repartition(4)
    got = Counter((r.word, r.near, r.near_n) for r in spelling.near_words(frame).collect())
    wanted = {(w, v, j + 1) for w in words for j, v in enumerate(words) if abs(len(w) - len(v)) <= 1 and one_edit(w, v)}
    assert set(got) == wanted and max(got.values()) == 1
    assert len(wanted) > len(words)


def test_letters_of_every_code_are_compared(spark):
    """One edit with each letter a run may hold, the last of every 32 codes included (ß, ÿ)."""
    letters = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100))]
    words = sorted({"berkeit", *("be" + x + "keit" for x in letters), *("berkeit" + x for x in letters)})
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    wanted = {(w, v) for w in words for v in words if abs(len(w) - len(v)) <= 1 and one_edit(w, v)}
    assert {(r.word, r.near) for r in spelling.near_words(frame).collect()} == wanted
    assert ("berkeit", "beßkeit") in wanted


def test_every_order_of_bigrams_finds_all(spark):
    words = vocabulary(5, 40)
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    wanted = sum(one_edit(w, v) for w in words for v in words if abs(len(w) - len(v)) <= 1)
    held = spelling.gram_order
    try:
        spelling.gram_order = lambda words: held(words, 3)  # nearly all bigrams without a rank of their own
        assert spelling.near_words(frame).count() == wanted
    finally:
        spelling.gram_order = held


def test_pivots_are_the_cheapest_disjoint_pair():
    pick = np.random.default_rng(3)
    for _ in range(200):
        cost = pick.integers(1, 50, (5, int(pick.integers(3, 12)))).astype(float)
        inside = pick.random(cost.shape) < 0.5
        inside[:, [0, -1]] = True
        first, second = spelling.pivots(cost, inside)
        for row in range(5):
            places = np.flatnonzero(inside[row])
            least = min(cost[row, a] + cost[row, b] for a in places for b in places if b - a >= 2)
            assert inside[row, first[row]] and inside[row, second[row]] and second[row] - first[row] >= 2
            assert cost[row, first[row]] + cost[row, second[row]] == least


def texts(seed=4):
    pick = random.Random(seed)
    base = ["Information", "straße_ganz", "éléphantes", "ÀÉÈlargeur", "notwithstanding", "x" * 60, "paralel", "parallel", "parallell"]
    rows = []
    for i in range(150):
        words = [w for w in base for _ in range(pick.choice([0, 1, 9]))]
        rows.append((i, " ".join(pick.choice([w, w, w, w.upper(), changed(pick, w)]) for w in words)))
    return rows + [(7, rows[7][1]), (None, "information parallel"), (900, None), (901, ""), (902, "short 12345678 §§§")]


def test_groups_equal_plain_ones(spark):
    rows = texts()
    wanted = plain_groups(plain_words(rows))
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "1 as word", "doc_id", "2 as n", "'k' as key").repartition(3)
    got = [tuple(r) for r in spelling.variant_groups(frame).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got)) and set(got) == wanted
    assert any(f is not None and r != f for _, f, r, *_ in wanted) or any(f for _, f, *_ in wanted)


def test_chains_of_forms_are_followed(spark):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "zbcdefghij": 2000, "unrelated": 5}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {tuple(r) for r in spelling.spelling_groups(frame).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == plain_groups(counts)
    assert ("abcdefg", "abcdefgh", "abcdefghij", 2, 1, 20) in got


def test_empty_tables_and_short_words(spark):
    assert spelling.variant_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert spelling.variant_groups(spark.createDataFrame([(None, None)], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        spelling.near_words(spark.createDataFrame([("abc", 1)], "word string, n long"))
