"""From raw documents to token files: five stages, each over all rows that the one before kept.

run() writes what each stage returns and reads it again as the next one's documents. All
stages but the last return the columns of documents. Of rows that share an
id and a text the n-gram stage keeps one at most; the other stages keep or drop them together,
null ids included. Empty input stays empty throughout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import decontaminate, jaccard, language, mixing, token_files
from tarmac.llm.queries import mixing_weights, table, tokenizer_path
from tarmac.llm.store import Scratch, disposed, one_of_each, row_key, without

#: Share of the tokens that the mixture takes.
MIXED_SHARE = 0.8

#: Near copies agree in 80 of 100 five-word shingles; op3_ngram_jaccard has a contract of its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is unknown."""
    evidence = language.document_evidence(docs, row_key("doc_id", "text"))
    found = language.identify(evidence, docs.select("lang", "text"))
    rejected = Scratch(spark).save(found.where("NOT accepted").select("id"), "rejected")
    return without(docs, row_key("doc_id", "text"), rejected)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of similar documents, that with the smallest id."""
    found = jaccard.similar_documents(docs, k=NEAR_WORDS, percent=NEAR_PERCENT)
    found = Scratch(spark).save(found.select("row_key", "component_key"), "found")
    dropped = found.where("row_key <> component_key").select("row_key")
    repeated = found.where("row_key = component_key").groupBy("row_key").count().where("count > 1").select("row_key")
    kept = without(docs, jaccard.document_key(), dropped)
    return one_of_each(kept, jaccard.document_key(), repeated)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark passage occurs."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps each leaf's budget of documents; one that the cut falls in is kept whole."""
    tree = docs.withColumn("domain", mixing.domain_of(F.col("source")))
    budget = F.floor(F.col("tokens") * MIXED_SHARE)
    taken = mixing.mix(tree, weights=mixing_weights(spark), budget=budget, max_epochs=1, seed=7)
    keys = docs.select(row_key("doc_id", "text").alias("row_key"))
    left = Scratch(spark).save(keys.join(taken.select("row_key").distinct(), "row_key", "left_anti"), "left")
    return without(docs, row_key("doc_id", "text"), left)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and returns what they hold: doc_id, start, n_tokens, ids_crc32."""
    path = Scratch(spark).path("tokens")
    token_files.write_token_files(docs, path, tokenizer_path())
    return token_files.token_index(token_files.read_token_files(spark, path))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("ngram_jaccard", join_near_copies),
    ("decontaminate", remove_benchmarks),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: The stages' models and digests are beyond SQL; tests/llm compares them with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with disposed(spark):  # a stage's own tables go when its result is written
            docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
