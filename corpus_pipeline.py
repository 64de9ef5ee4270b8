"""A corpus pipeline of five stages over ``documents``.

Language ID drops documents without a recognisable language, the n-gram Jaccard join keeps
one document of each group of near copies, decontamination drops documents that hold a
benchmark item, the secret scan replaces secrets, and mixing repeats or leaves out documents so
that sources get their shares. Every stage keeps rows without a doc_id that it can't
judge by text alone, and rows that repeat a doc_id share its fate.
"""

from pyspark.sql import functions as F

from fleetlife.llm import jaccard, languages, leaks, mixing, secrets_scan
from fleetlife.llm.store import small_batches, stored, table

#: A document whose most likely language has less than this probability has none.
LEAST_SCORE = 0.3


def without(docs, found):
    """The documents whose doc_id is not in ``found``. The ids are stored first: few ones, by their
    known size, are broadcast, and whole texts are not shuffled."""
    return docs.join(stored(found.select("doc_id").distinct()), "doc_id", "left_anti").select(docs.columns)


def identify_language(spark, docs, sf_dir):
    """Documents with a recognised language, stored. Columns as they were."""
    network = languages.fit(docs.where(~languages.held_out()))
    rest = F.struct(*(c for c in docs.columns if c != "text")).alias("row")
    rows = languages.predict(docs.select("text", rest), network, keep_text=True)
    kept = rows.where((F.col("lang_pred") != languages.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    with small_batches(spark):
        return stored(kept.select(*((F.col("text") if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns)))


def drop_near_copies(spark, docs, sf_dir):
    """The document with the smallest id of each group of documents linked by 4-word shingles."""
    groups = jaccard.ngram_jaccard_join(docs)
    return without(docs, groups.where("doc_id <> component_id"))


def drop_leaks(spark, docs, sf_dir):
    """Documents without a benchmark item."""
    with small_batches(spark):
        return without(docs, leaks.find_leaks(docs, table(spark, sf_dir, "benchmark")))


def redact_secrets(spark, docs, sf_dir):
    """All documents, secrets replaced; n_chars follows the text where it was counted."""
    rest = F.struct(*(c for c in docs.columns if c != "text")).alias("row")
    found = secrets_scan.redact(secrets_scan.find_secrets(docs.select("doc_id", "text", rest), carried=("row",)))
    columns = {c: F.col("text") if c == "text" else F.col("row")[c] for c in docs.columns}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(columns["n_chars"].isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
    return found.select(*(value.alias(c) for c, value in columns.items()))


def mix(spark, docs, sf_dir):
    """A row for each copy of a document that the mix takes, numbered in ``copy``, or where
    the documents have such a column, in the first free one of copy_1, copy_2 and so on."""
    rows = mixing.mix_sources(docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("row")), carried=("row",)).where("copies > 0")
    free = next(name for name in ("copy", *(f"copy_{i}" for i in range(1, len(docs.columns) + 2))) if name not in docs.columns)
    return rows.select(*(F.col("row")[c].alias(c) for c in docs.columns), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(free))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scan", redact_secrets),
    ("source_mix", mix),
]

#: Trained models and near-duplicate joins have no SQL counterpart.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if 0 < i < len(STAGES) - 1:  # the first stage stores its own
            docs = stored(docs)
    return docs
