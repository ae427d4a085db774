"""Registered queries of this subpackage, each over its whole table, with their expected SQL."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm import chat, decontaminate, fill_middle, jaccard, language, mixing, oracle, periods, personal, resample, suffix_tree, token_files, topk, urls
from tarmac.llm.store import Scratch


def tokenizer_path() -> str:
    """The vocabulary file is a parameter of the operators; this is the installed one."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Target weights: of domains, and of languages in each.
DOMAIN_WEIGHTS = [("domain0", 0.5), ("domain1", 0.3), ("domain2", 0.2)]
LANGUAGE_WEIGHTS = [(d, lang, x) for d, _ in DOMAIN_WEIGHTS for lang, x in (("en", 0.4), ("de", 0.2), ("fr", 0.2), ("es", 0.2))]

MIXED_EPOCHS, MIXED_SEED = 2, 7


def mixing_weights(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "domain": spark.createDataFrame(DOMAIN_WEIGHTS, "domain string, weight double"),
        "lang": spark.createDataFrame(LANGUAGE_WEIGHTS, "domain string, lang string, weight double"),
    }


ADDED_CHAT = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(ADDED_CHAT, "conv_id long, turn long, role string, text string")
    path = tokenizer_path()
    chats = chat.format_chats(rows.unionByName(added), path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chat.load_tokenizer(path)
        decode = chat.decoder_of(tokenizer)
        for batch in batches:
            out = []
            for ids, loss in zip(batch["ids"], batch["loss"]):
                turns, learned = chat.read_back(ids.values.to_numpy(), loss.values.to_numpy(), tokenizer, decode)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                out.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch["conv_id"],
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.string()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(columns[3], pa.string()),
                    pa.array([len(f) for f in batch["formatted"].to_pylist()], pa.int64()),
                ],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return chats.mapInArrow(digest, schema)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.sort_array(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return language.identify(language.document_evidence(docs), docs).withColumnRenamed("id", "doc_id")


def op5_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = language.page_evidence(table(spark, sf_dir, "pages"))
    return language.identify(pages, table(spark, sf_dir, "documents").select("lang", "text")).withColumnRenamed("id", "page_id")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    docs = docs.withColumn("domain", mixing.domain_of(F.col("source")))
    return mixing.mix(docs, weights=mixing_weights(spark), max_epochs=MIXED_EPOCHS, seed=MIXED_SEED).drop("row_key")


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op9_quality_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resample(docs, table(spark, sf_dir, "labels"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark).path("tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_files.token_index(token_files.read_token_files(spark, path))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def op11_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find_personal(table(spark, sf_dir, "documents"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}") for kind in personal.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@F.pandas_udf(T.StringType())
def repeated(doc_id: pd.Series, text: pd.Series) -> pd.Series:
    """Texts of which a tenth, chosen by id, repeat a stretch of their words to the end."""

    def one(key: str, text: str | None) -> str | None:
        h = zlib.crc32(key.encode())
        said = (text or "").encode().split() if h % 10 == 0 else []
        if not said:
            return text
        n, g = len(said), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join(said[i] if i < a else said[a + (i - a) % p] for i in range(n)).decode()

    return pd.Series([one(k, t) for k, t in zip(doc_id, text)], dtype=object)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = periods.periodic_runs(docs.withColumn("text", repeated(key, "text")))
    ordered = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("period")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    found = found.withColumn("most", F.array_max(ordered))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("most.back")).alias("start"),
        F.col("most.length").alias("length"),
        (-F.col("most.period")).alias("period"),
        F.expr("1000 * most.length div -most.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.fill_middle(table(spark, sf_dir, "documents"), seed=1)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    return found.select(*names, F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_decontaminate": op2_decontaminate,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_suffix_tree": op4_suffix_tree,
    "op5_language_id": op5_language_id,
    "op5_page_language": op5_page_language,
    "op6_mixing": op6_mixing,
    "op7_exact_topk": op7_exact_topk,
    "op8_token_files": op8_token_files,
    "op9_quality_resample": op9_quality_resample,
    "op10_url_filter": op10_url_filter,
    "op11_personal": op11_personal,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_fill_middle": op13_fill_middle,
}

SQL: dict[str, str] = {
    "op1_chat_format": oracle.chat_format(ADDED_CHAT),
    "op2_decontaminate": oracle.DECONTAMINATE,
    "op3_ngram_jaccard": oracle.NGRAM_JACCARD,
    "op6_mixing": oracle.mixed(DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, MIXED_EPOCHS, MIXED_SEED),
    "op7_exact_topk": oracle.EXACT_TOPK,
    "op10_url_filter": oracle.url_filter(),
    "op13_fill_middle": oracle.FILL_MIDDLE,
}
