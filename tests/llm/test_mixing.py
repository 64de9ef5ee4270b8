"""Source mixing against a plain resharing of targets."""

import math
import random
import re

from fleetlife.llm import mixing


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return share | fixed
        fixed |= {s: 3.0 * sizes[s] for s in over}


def made(n=600, seed=1):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        source = pick.choice(["big"] * 9 + ["a", "b", "c", None, "é", "z"])
        rows.append((i, " ".join("w" * pick.randrange(1, 5) for _ in range(pick.randrange(0, 60))), source))
    return rows + [(9001, None, "a"), (9002, "", None), (9003, "one", "tiny"), (9004, None, "none")]


def plain_copies(docs, hashes, targets):
    """Copies by bisection of every source's tilt and by copying long documents first."""
    out = {}
    for source, target in targets.items():
        own = [(size, hashes[d], d) for d, (size, s) in docs.items() if s == source]
        words = sum(size for size, _, _ in own)
        out |= {d: 1 for size, _, d in own if size == 0}
        if not words:
            continue
        mean = round(sum(size * size for size, _, _ in own) / words, 3)

        def rate(m, size):
            return 3 / (1 + 2 * math.exp(-max(-700.0, min(700.0, m * size / mean))))

        low, high = -1e6, 1e6
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if sum(size * rate(middle, size) for size, _, _ in own) < target else (low, middle)
        m = 1e18 if target >= 3 * words * (1 - 1e-12) else round(high, 6)
        sizes = sorted({size for size, _, _ in own if size}, reverse=True)
        n = {size: sum(o[0] == size for o in own) for size in sizes}
        take, left = {}, 0.0
        for size in sizes:
            left += n[size] * rate(m, size) * size
            take[size] = min(max(math.floor(left / size + 0.5), 0), 3 * n[size])
            left -= take[size] * size
        left = target - sum(take[size] * size for size in sizes)
        for size in sizes:
            while left >= size and take[size] < 3 * n[size]:
                take[size], left = take[size] + 1, left - size
            while left <= -size and take[size] > 0:
                take[size], left = take[size] - 1, left + size
        step = 1 if left > 0 else -1
        near = [size for size in sizes if abs(left - step * size) < abs(left) and 0 <= take[size] + step <= 3 * n[size]]
        if near:
            take[min(near, key=lambda size: abs(left - step * size))] += step
        for size in sizes:
            for i, (_, _, d) in enumerate(sorted(o for o in own if o[0] == size)):
                out[d] = take[size] // n[size] + (i < take[size] % n[size])
    return out


def checked(spark, rows):
    """Rows of the mix, compared with the plain one."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("source", "doc_id", "text", "1 as size", "2 as target", "'x' as of").repartition(4)
    got = mixing.mix_sources(docs).collect()
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    size = {d: (len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for d, t, s in rows}
    sizes = {}
    for n, s in size.values():
        sizes[s] = sizes.get(s, 0) + n
    wanted = plain_targets(sizes)
    hashes = {r.doc_id: r.u for r in docs.selectExpr("doc_id", "shiftrightunsigned(xxhash64(cast(doc_id as string)), 1) as u").collect()}
    copies = plain_copies(size, hashes, wanted)
    assert len(got) == len(rows) and {r.doc_id: r.copies for r in got} == copies
    for r in got:
        assert (r["size"], r.source) == size[r.doc_id] and r.source_size == sizes[r.source]
        assert abs(r.target - wanted[r.source]) < 1e-6 and r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        taken[r.source] += r.taken
    return got, wanted, taken


def test_targets_and_taken_words(spark):
    got, wanted, taken = checked(spark, made())
    for s in wanted:
        assert abs(taken[s] - wanted[s]) <= min((r["size"] for r in got if r.source == s and r["size"]), default=0), s


def test_heavy_tail_and_one_huge_document(spark):
    pick = random.Random(4)
    rows = [(i, "w " * min(4000, int(pick.paretovariate(0.7))), pick.choice(["a", "a", "b", "c"])) for i in range(1500)]
    _, wanted, taken = checked(spark, [*rows, (9999, "w " * 60000, "b")])
    for s in wanted:
        assert abs(taken[s] - wanted[s]) <= 1, s


def test_tilts_depend_on_the_document(spark):
    got, _, _ = checked(spark, [(i, "w " * (1 + i % 40), "a" if i < 400 else "b") for i in range(440)])
    rates = {(r.source, r["size"]): r.rate for r in got}
    assert len({round(rates["a", n], 9) for n in range(1, 41)}) == 40


def test_a_document_larger_than_what_is_missing(spark):
    # One document of each source is too long, another one in each.
    rows = [(100 * j + i, " ".join("w" * (900 if i == j else 10 + i)), f"s{j:02}") for j in range(12) for i in range(12)]
    got, wanted, taken = checked(spark, rows)
    for source in wanted:
        short = 3 * sum(r["size"] for r in got if r.source == source and r["size"] < 900)
        reach = min(max(0, low - wanted[source], wanted[source] - low - short) for low in (0, 900, 1800, 2700))
        assert abs(taken[source] - wanted[source]) <= max(reach + 1e-6, 11), source


def test_long_hash_ranges(spark):
    # Many documents of one size: the cut lies within a range of hashes.
    checked(spark, [(i, "one two three", "a" if i % 3 else "b") for i in range(9000)])


def test_carried_columns(spark):
    docs = spark.createDataFrame([(i, "w " * i, "a", f"r{i}") for i in range(20)], "doc_id long, text string, source string, row string")
    assert {(r.doc_id, r.row) for r in mixing.mix_sources(docs, carried=("row",)).collect()} == {(i, f"r{i}") for i in range(20)}


def test_no_words_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None, None), (1, "", "a")], "doc_id long, text string, source string")
    assert sorted((r.source_size, r.target, r.taken) for r in mixing.mix_sources(docs).collect()) == [(0, 0.0, 0), (0, 0.0, 0)]
    assert mixing.mix_sources(docs.limit(0)).collect() == []


def test_equal_rows_are_taken_alike(spark):
    docs = spark.createDataFrame([(1, "a b", "x")] * 4 + [(2, "c", "y")], "doc_id long, text string, source string")
    got = [r.copies for r in mixing.mix_sources(docs).collect() if r.source == "x"]
    assert len(got) == 4 and len(set(got)) == 1
