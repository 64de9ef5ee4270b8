"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from fleetlife.llm import vectors


def plain(rows, least):
    usable = {}
    for vec_id, vector, label in rows:
        if label is not None and vector and all(v is not None and np.isfinite(v) for v in vector) and any(vector):
            x = np.array(vector, np.float64)
            usable[vec_id] = (label, x / np.sqrt((x * x).sum()))
    links = {vec_id: set() for vec_id, _, _ in rows}
    ids = sorted(usable)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if usable[a][0] == usable[b][0] and len(usable[a][1]) == len(usable[b][1]) and usable[a][1] @ usable[b][1] >= least:
                links[a].add(b)
                links[b].add(a)
    component = {}
    for start in sorted(links):
        if start not in component:
            todo = [start]
            while todo:
                node = todo.pop()
                if node not in component:
                    component[node] = start
                    todo += links[node]
    return {v: (len(n), component[v]) for v, n in links.items()}


def made(n=500, size=16, seed=0):
    pick = np.random.default_rng(seed)
    rows, vec_id = [], 0
    for i in range(n):
        base = pick.normal(size=size)
        for _ in range(int(pick.choice([1, 1, 1, 2, 5]))):
            x = base + pick.normal(size=size) * pick.choice([0, 0.05, 0.2, 0.35])
            rows.append((vec_id, [float(v) for v in x.astype(np.float32)], int(pick.choice([0, 0, 0, 1]))))
            vec_id += 1
    rows += [(vec_id + i, v, label) for i, (v, label) in enumerate([
        (None, 0), ([], 0), ([0.0] * size, 0), ([float("nan")] * size, 0), ([float("inf")] + [1.0] * (size - 1), 0), ([None] + [1.0] * (size - 1), 0),
        (rows[0][1], None), ([1.0, 0.0, 0.0], 0), ([1.0, 0.01, 0.0], 0), ([5.0], 1), ([7.0], 1), ([1e30] * size, 0), ([1e-30] * size, 0)])]
    return rows


@pytest.mark.parametrize("cell, block", [(1_000, 2_000), (5, 7)])
def test_equals_all_pairs(spark, monkeypatch, cell, block):
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = made(n=200 if block == 7 else 500)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("label", "embedding", "vec_id", "1 as copies", "2 as cell").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(frame).collect()}
    wanted = plain([(v, None if x is None else [None if a is None else float(np.float32(a)) for a in x], l) for v, x, l in rows], 0.93)
    assert set(got) == set(wanted)
    found, all_links = sum(g[0] for g in got.values()), sum(w[0] for w in wanted.values())
    assert all(got[v][0] <= wanted[v][0] for v in got)
    assert found >= 0.97 * all_links > 0
    assert sum(got[v] == wanted[v] for v in got) >= 0.95 * len(got)


def test_copies_count_each_other(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0], 3) for i in range(50)] + [(60, [1.0, 2.0, 3.0, 4.01], 3), (61, [1.0, 2.0, 3.0, 4.0], 4)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert got[0] == (50, 0, True) and got[7] == (50, 0, False) and got[60] == (50, 0, False) and got[61] == (0, 61, True)


def test_empty_table(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_traversal_is_in_order():
    pick = np.random.default_rng(2)
    index = vectors.MultiIndex(pick.normal(size=(300, 8)), 6, 0.93)
    first, second = pick.random(6), pick.random(6)
    wanted = sorted(range(36), key=lambda c: first[c // 6] + second[c % 6])
    assert index.traversal(first, second, 36) == wanted


def test_links_count_at_both_ends(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELL", 4)
    rows = [(v, x, l) for v, x, l in made(n=600, seed=5) if x and len(x) == 16 and l is not None and all(c is not None and abs(c) < 1e9 for c in x)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.component_id, []).append(r.n_links)
    assert all(min(links) >= 1 and sum(links) % 2 == 0 for links in groups.values() if len(links) > 1)
    assert any(len(links) == 2 and links == [1, 1] for links in groups.values())
