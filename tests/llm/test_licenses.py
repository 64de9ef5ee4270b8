"""License scan: fingerprints, alignment against the full table, planted wordings."""

import random

from fleetlife.llm import licenses
from fleetlife.llm.words import text_words


def test_planted_wordings(spark):
    full = licenses.TEMPLATES["apache-2.0"]
    words = full.split()
    changed = " ".join(w for i, w in enumerate(words) if i % 12)
    rows = [
        (1, "prose. Released under the MIT License. more é prose"),
        (2, "é " + full),
        (3, "x y " + changed + " z"),
        (4, " ".join(words[: len(words) // 3])),
        (5, "licensed under the moon"),
        (6, None),
        (7, ""),
        (8, "RELEASED UNDER THE MIT LICENSE -- released\nunder the 'MIT' license"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "doc_id", "1 as license", "2 as start")
    got = licenses.scan_licenses(docs).collect()
    found = {(r.doc_id, r.license): r for r in got}
    text = dict(rows)
    shown = lambda r: text[r.doc_id][r.start : r.finish]
    assert shown(found[1, "mit-line"]) == "Released under the MIT License"
    assert found[2, "apache-2.0"].coverage == 1 and shown(found[2, "apache-2.0"]) == full.rstrip(".")
    assert 0.85 < found[3, "apache-2.0"].coverage < 1
    assert not any(d in (5, 6, 7) for d, _ in found) and (4, "apache-2.0") not in found
    assert sum(r.doc_id == 8 for r in got) == 2
    assert licenses.scan_licenses(docs.limit(0)).collect() == []


def test_band_equals_the_full_alignment_where_it_fits():
    pick = random.Random(2)
    for _ in range(100):
        template = [pick.randrange(6) for _ in range(pick.randrange(1, 12))]
        words = [pick.randrange(6) for _ in range(pick.randrange(0, 9))]
        best = 0
        table = [[0] * (len(words) + 1) for _ in range(len(template) + 1)]
        for i, a in enumerate(template):
            for j, b in enumerate(words):
                table[i + 1][j + 1] = max(0, table[i][j] + (2 if a == b else -1), table[i][j + 1] - 1, table[i + 1][j] - 1)
                best = max(best, table[i + 1][j + 1])
        matched, first, last = licenses.aligned(template, words, -len(template), len(words))
        assert matched <= min(len(template), len(words)) and (matched > 0) == (best > 0)
        assert 2 * matched >= best


def test_every_template_finds_itself():
    index = licenses.Index(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        words = text_words(text)
        assert any(own == name for places in index.places.values() for own, _ in places), name
        assert licenses.aligned(words, words, 0, 0) == (len(words), 0, len(words) - 1)


def changed_once(words):
    for i in range(len(words)):
        yield [*words[:i], "zzz", *words[i + 1 :]]
        yield [*words[:i], *words[i + 1 :]]
        yield [*words[:i], "zzz", *words[i:]]


def test_one_changed_word_in_every_template(spark):
    rows, wanted = [], {}
    for name, text in licenses.TEMPLATES.items():
        words = text.split()
        plain = len(licenses.text_words(text))
        for changed in changed_once(words):
            left = sum(len(licenses.text_words(w)) for w in words) - max(len(licenses.text_words(w)) for w in words)
            if left >= 0.8 * plain:
                wanted[len(rows)] = name
            rows.append((len(rows), "vorher " * 5 + " ".join(changed) + " danach" * 5))
    got = {}
    for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert [rows[i] for i, name in wanted.items() if name not in got.get(i, ())] == []


def test_intact_gram_is_guaranteed():
    import random

    pick = random.Random(3)
    for words in range(1, 130):
        gram, window = licenses.winnowing(words, 0.8)
        for _ in range(20):
            spoilt = set(pick.sample(range(words), words - -(-words * 8 // 10)))
            run = best = 0
            for i in range(words):
                run = 0 if i in spoilt else run + 1
                best = max(best, run)
            assert best >= gram + window - 1


def test_many_copies_of_a_line(spark):
    line = licenses.TEMPLATES["mit-line"]
    got = licenses.scan_licenses(spark.createDataFrame([(1, (line + " ") * 1200 + "end")], "doc_id long, text string")).collect()
    assert len(got) == 1200 and {r.license for r in got} == {"mit-line"} and len({r.start for r in got}) == 1200
