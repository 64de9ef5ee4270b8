"""The corpus pipeline: what each stage keeps, and the whole against its parts."""

import sys

import corpus_pipeline
from fleetlife.llm import jaccard, languages, leaks, mixing, secrets_scan, store
from fleetlife.llm.store import stored

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, FOLDER))
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        ids = [r.doc_id for r in before.select("doc_id").collect()]
        assert kept[name] <= set(ids)
        if name != "source_mix":
            assert docs.columns == columns and docs.dtypes == before.dtypes and docs.count() == len(kept[name])
        if name == "ngram_jaccard_join":
            groups = jaccard.ngram_jaccard_join(before).collect()
            assert kept[name] == {r.doc_id for r in groups if r.doc_id == r.component_id}
        if name == "benchmark_decontamination":
            found = {r.doc_id for r in leaks.find_leaks(before, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
            assert kept[name] == set(ids) - found
        if name == "secret_scan":
            assert not any(secrets_scan.base_spans(r.text) for r in docs.collect() if r.text)
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        if name == "source_mix":
            wanted = {r.doc_id: r.copies for r in mixing.mix_sources(before).collect()}
            got = {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()}
            assert got == {d: n for d, n in wanted.items() if n}
    final = {(r.doc_id, r.copy) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert final == {(r.doc_id, r.copy) for r in docs.collect()}


def test_texts_go_to_python_once_and_in_small_batches(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"the quick brown fox number {i} jumps over the lazy dog", "en", "web", 1) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars int")
    usual, sent, told = spark.conf.get(store.BATCH_SETTING), [], []
    predict = languages.predict

    def watched(rows, *rest, **options):
        sent.append(rows.schema)
        return predict(rows, *rest, **options)

    def kept(df):
        told.append(spark.conf.get(store.BATCH_SETTING))
        return stored(df)

    monkeypatch.setattr(languages, "predict", watched)
    monkeypatch.setattr(corpus_pipeline, "stored", kept)
    monkeypatch.setattr(jaccard, "stored", kept)
    found = corpus_pipeline.identify_language(spark, docs, None)
    assert found.columns == docs.columns and found.exceptAll(docs).count() == 0
    assert sent[0].simpleString().count("text") == 1 and told == [store.BATCH]
    assert jaccard.ngram_jaccard_join(docs).count() == 40
    assert set(told) == {store.BATCH} and len(told) > 4 and spark.conf.get(store.BATCH_SETTING) == usual


def test_odd_rows(spark, tmp_path):
    words = " ".join(f"wort{i}" for i in range(60))
    rows = [(1, words, "de", "a", 10), (2, words, "de", None, None), (None, words + " x", None, "a", 1), (3, None, "de", "a", 0), (4, "", "de", "a", 0), (5, "token=abcdefgh " + words[::-1], "de", "b", 3), (5, "token=abcdefgh " + words[::-1], "de", "b", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "0.5 as score", "'c' as copies", "3 as size", "1 as copy", "'s' as spans", "2 as row", "4 as component_id")
    spark.createDataFrame([(1, "nothing like it at all here")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            frame = stored(stage(spark, frame, str(tmp_path)))
        got = {r.doc_id for r in frame.collect()}
        assert got <= {1, None, 5}


def test_only_the_entry_minds_a_missing_folder():
    import __spark_entry__ as entry

    assert {"pipeline", "op5_ngram_jaccard_join"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] and languages and "fleetlife.llm" in sys.modules
