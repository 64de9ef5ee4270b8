"""Language ID: held-out accuracy, and gradients against differences."""

import numpy as np
import pytest

from fleetlife.llm import languages

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = languages.language_id(docs, per_language=60, rounds=8).collect()
    return {r.doc_id: r for r in rows}, {r.doc_id: r for r in docs.collect()}


def test_held_out_accuracy(found):
    rows, docs = found
    assert len(rows) == len(docs)
    judged = [(docs[d].lang, r.lang_pred) for d, r in rows.items() if r.held_out and docs[d].lang and docs[d].text and len(docs[d].text) > 40]
    assert len(judged) > 20
    assert sum(a == b for a, b in judged) >= 0.95 * len(judged)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_held_out_is_the_checksum(found):
    import zlib

    rows, _ = found
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())


def test_texts_without_letters_and_clashing_columns(spark):
    rows = [(1, None, "en"), (2, "", "de"), (3, "12 % 3", "en"), (4, "the and of", "en"), (5, "ß", "de"), (None, "der die", None), (6, "die und", "de"), (6, "die und", "de"), (7, "x" * 5000 + " ü", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("lang", "text", "doc_id", "0.5 as score", "'q' as lang_pred")
    got = languages.language_id(docs, rounds=1).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by_id[3].score == 0
    assert {by_id[i].lang_pred for i in (4, 5, 6, 7, None)} <= {"en", "de"}
    assert languages.language_id(docs.limit(0)).collect() == []
    unlabelled = languages.language_id(docs.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_gradients():
    pick = np.random.default_rng(0)
    x = pick.integers(0, 256, (7, 3)).astype(np.uint8)
    layer = languages.Direction(pick, 4)
    layer.table, layer.back = layer.table.astype(np.float64), layer.back.astype(np.float64)
    weigh = pick.normal(size=(7, 3, 4))
    loss = lambda: float((layer.states(x).astype(np.float64) * weigh).sum())
    trace = []
    layer.states(x, None, trace)
    d_table, d_back = layer.gradients(x, trace, weigh)
    for weights, gradient in ((layer.back, d_back), (layer.table, d_table)):
        for _ in range(10):
            i = int(x[pick.integers(7), pick.integers(3)]) if weights is layer.table else int(pick.integers(4))
            j, step = int(pick.integers(12)), 1e-2
            weights[i, j] += step
            up = loss()
            weights[i, j] -= 2 * step
            down = loss()
            weights[i, j] += step
            assert abs((up - down) / (2 * step) - gradient[i, j]) < 1e-2 * max(1, abs(gradient[i, j]))


def test_pieces_pool_the_whole_text():
    network = languages.Network(["a", "b", "c"])
    pick = np.random.default_rng(1)
    texts = [pick.integers(0, 256, n).astype(np.uint8) for n in (0, 1, 5, languages.PIECE, languages.PIECE + 1, 3 * languages.PIECE + 7)]
    offsets = np.cumsum([0, *map(len, texts)])
    got = network.pooled(np.concatenate(texts), offsets)
    for row, text in zip(got, texts):
        parts = [network.probabilities(text[i : i + languages.PIECE][:, None])[0].sum((0, 1)) for i in range(0, len(text), languages.PIECE)]
        assert np.allclose(row, np.sum(parts, 0) / max(1, len(text)) if parts else 0, atol=1e-4)


def test_sample_is_bounded(spark, monkeypatch):
    rows = [(7, f"repeated {i}", "aa") for i in range(3000)] + [(i, f"text {i}", "bb") for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pieces = languages.training_pieces(docs, 20, 2).collect()
    assert sum(r.lang == "aa" for r in pieces) == 2 and sum(r.lang == "bb" for r in pieces) == 40
    monkeypatch.setattr(languages, "MOST_LANGUAGES", 1)
    with pytest.raises(ValueError):
        languages.training_pieces(docs, 20, 2)
