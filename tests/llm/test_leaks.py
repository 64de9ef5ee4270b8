"""Decontamination: planted copies and paraphrases are found, clean documents are not."""

import random

import numpy as np

from fleetlife.llm import leaks


def made(seed=1):
    pick = random.Random(seed)
    common = ["the", "of", "and", "to", "in", "a", "is"]
    word = lambda: pick.choice(common) if pick.random() < 0.4 else "".join(pick.choice("abcdefghij") for _ in range(pick.randrange(3, 7)))
    fresh = lambda n: [word() for _ in range(n)]
    items = [(i, fresh(pick.choice([6, 12, 20, 40, 60, 150]))) for i in range(40)]
    docs, planted = [], set()
    for i in range(300):
        words = fresh(pick.choice([0, 10, 200, 400]))
        if i % 5 == 0:
            item, own = pick.choice(items)
            own = list(own)
            if i % 10 == 0 and len(own) > 11:  # a paraphrase: every eighth word another
                own[::8] = fresh(len(own[::8]))
            at = pick.randrange(len(words) + 1)
            words[at:at] = own
            planted.add((i, item))
        docs.append((i, pick.choice([" ", "\n"]).join(words).capitalize()))
    return docs, [(i, " ".join(w)) for i, w in items], planted


def test_planted_items(spark, monkeypatch):
    docs, items, planted = made()
    frame = spark.createDataFrame([*docs, (900, None), (901, "")], "doc_id long, text string").selectExpr("text", "doc_id", "1 as item_id", "2 as word")
    benchmark = spark.createDataFrame([*items, (800, None), (801, ""), (802, "the of and"), (None, items[0][1])], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in leaks.find_leaks(frame, benchmark).collect()}
    assert set(got) == planted
    text = dict(docs)
    assert all(len(text[d][r.start : r.finish].split()) >= leaks.COVERAGE * 6 for (d, _), r in got.items())
    monkeypatch.setattr(leaks, "MOST_PIECES", 9)
    assert {(r.doc_id, r.item_id) for r in leaks.find_leaks(frame, benchmark).collect()} == planted


def test_answers_must_be_there(spark):
    docs, items, planted = made()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    i, text = items[3]
    answered = [(*item, None) for item in items if item[0] != i] + [(i, text, text.split()[2])]
    benchmark = spark.createDataFrame(answered, "item_id long, text string, answer string")
    got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(frame, benchmark).collect()}
    assert got <= planted and {p for p in planted if p[1] != i} <= got


def test_an_item_in_a_third_of_the_documents(spark):
    docs, items, planted = made()
    pick = random.Random(4)
    item, own = next((i, w.split()) for i, w in items if 40 <= len(w.split()) <= 60)
    fresh = lambda n: ["".join(pick.choice("klmnopqrst") for _ in range(5)) for _ in range(n)]
    changed = lambda i: [w if (j + i) % 7 else fresh(1)[0] for j, w in enumerate(own)] if i % 2 else own
    hot = [(1000 + i, " ".join([*fresh(at := pick.randrange(150)), *changed(i), *fresh(150 - at)])) for i in range(75)]
    same = " ".join([*fresh(60), *own, *fresh(60)])
    hot += [(2000 + i, same) for i in range(75)]
    frame, benchmark = spark.createDataFrame([*docs, *hot], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(frame, benchmark).collect()}
    assert got == planted | {(d, item) for d, _ in hot}


def test_items_of_more_pieces_than_the_rank(spark, monkeypatch):
    pick = random.Random(8)
    word = lambda: "".join(pick.choice("abcdefghij") for _ in range(3))
    items = [(i, [word() for _ in range(60)]) for i in range(60)] + [(99, [word() for _ in range(64 * 20)])]
    kept = lambda own: [w if pick.random() < 0.7 else word() for w in own]
    docs = [(i, " ".join([*(word() for _ in range(100)), *kept(own[:60]), *(word() for _ in range(100))])) for i, own in items[:60]]
    docs.append((99, " ".join(items[-1][1][640:704])))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(own)) for i, own in items], "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in leaks.find_leaks(frame, benchmark).collect()}
    assert (99, 99) in whole and len(whole) >= 50
    ranks = []
    made_space = leaks.latent_space
    monkeypatch.setattr(leaks, "latent_space", lambda *x: ranks.append((len(x[1]), made_space(*x))) or ranks[-1][1])
    monkeypatch.setattr(leaks, "RANK", 16)
    monkeypatch.setattr(leaks, "MOST_PIECES", 32)
    assert {(r.doc_id, r.item_id) for r in leaks.find_leaks(frame, benchmark).collect()} == whole
    assert all(pieces <= leaks.RANK and space.basis.shape[1] == pieces for pieces, space in ranks)


def test_empty_tables(spark):
    docs, items, _ = made()
    frame, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert leaks.find_leaks(frame.limit(0), benchmark).collect() == []
    assert leaks.find_leaks(frame, benchmark.limit(0)).collect() == []


def test_common_subsequence():
    pick = random.Random(6)
    for _ in range(300):
        a, b = ([pick.randrange(5) for _ in range(pick.randrange(12))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert leaks.common_subsequence(a, b) == table[-1, -1]
