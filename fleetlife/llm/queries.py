"""Registered queries of the operators in this folder, over the whole tables."""

from pyspark.sql import functions as F

from fleetlife.llm import collocations, jaccard, languages, leaks, licenses, mixing, pages, secrets_scan, spelling, substrings, toxicity, urls, vectors
from fleetlife.llm.store import table

REGISTRY = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


@query
def op5_ngram_jaccard_join(spark, folder):
    found = jaccard.ngram_jaccard_join(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op7_substring_dedup(spark, folder):
    found = substrings.without_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op4_language_id(spark, folder):
    return languages.language_id(table(spark, folder, "documents"))


@query
def op2_mix_sources(spark, folder):
    found = mixing.mix_sources(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op3_url_filter(spark, folder):
    found = urls.url_filter(table(spark, folder, "pages"), whole=True)
    return found.select("page_id", "host", "path", "rule", "verdict")


@query
def op10_secret_scan(spark, folder):
    return secrets_scan.digest(secrets_scan.find_secrets(table(spark, folder, "documents")))


@query
def op9_html_extraction(spark, folder):
    found = pages.extract_text(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_embedding_near_dedup(spark, folder):
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


@query
def op1_license_scan(spark, folder):
    return licenses.scan_licenses(table(spark, folder, "documents"))


@query
def op6_benchmark_decontamination(spark, folder):
    return leaks.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op11_spelling_variants(spark, folder):
    found = spelling.variant_groups(table(spark, folder, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


@query
def op13_toxicity(spark, folder):
    found = toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")
