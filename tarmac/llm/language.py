"""Language identification by Bayesian evidence fusion.

Method: each language has a model of hashed byte trigrams, counted over all labelled
texts; one more class, UNKNOWN, gives all trigrams the same probability. A row's log
likelihoods (its mean per trigram times at most EVIDENCE, since neighbouring trigrams
repeat each other) are fused with
  * the declared markup language, by how often rows of each language declare what,
  * the address: a prior over languages of the host, smoothed towards that of the
    address suffix, and that towards the corpus.
The tables for both are grouped counts of the languages that the text alone gives.

Defined results: texts without a trigram that holds a letter, null texts among them, are UNKNOWN
with confidence 1; a null declaration is no evidence; a null host takes the suffix' prior, a null
suffix the corpus'; ties go to the language first in alphabetical order; equal rows get equal
results; an empty table gives an empty table; extra columns are not read. A label counts by
its language (``EN`` and ``en-GB`` as ``en``); labels that are no language tag train nothing (unlabelled() has
them). Without any labelled text all rows are UNKNOWN.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import words as w
from tarmac.llm.store import Scratch
from tarmac.llm.urls import host_and_path

UNKNOWN = "und"
BUCKETS = 1 << 16
SMOOTHING = 0.5
EVIDENCE = 200.0
#: Rows that a host's, a suffix' and a declaration's smoothing are worth.
HOST_ROWS, SUFFIX_ROWS, DECLARED_ROWS = 20.0, 100.0, 20.0
UNKNOWN_PRIOR = 0.01
MIN_CONFIDENCE = 0.5
#: A label is a language tag; its first part is the language.
LABEL = "^([a-z]{2,3})(?:[-_].*)?$"


def trigrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams inside each text that hold a letter, and the text of each."""
    low = w.SPACED[0][data].astype(np.uint32)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    letter = (low >= 128) | ((low >= 97) & (low <= 122))
    ends = np.zeros(len(low), bool)
    ends[bounds[1:-1][bounds[1:-1] < len(low)]] = True  # a text begins here
    keep = np.flatnonzero((letter[:-2] | letter[1:-1] | letter[2:]) & ~ends[1:-1] & ~ends[2:])
    bucket = (code[keep] * np.uint32(2654435761)) >> np.uint32(16)
    return bucket.astype(np.int64), np.searchsorted(bounds, keep, "right") - 1


def _each(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for at, stop in w.pieces(texts, 4 * w.CHUNK):
        yield at, stop - at, *trigrams(*w.raw(texts.slice(at, stop - at)))


def unlabelled(labelled: DataFrame) -> DataFrame:
    """(lang, n): the labels that are no language tag, null among them, and how many rows carry each."""
    return labelled.where(language_of(F.col("lang")).isNull()).groupBy("lang").agg(F.count("*").alias("n"))


def trigram_counts(labelled: DataFrame, languages: list[str]) -> DataFrame:
    """(place, bucket, n): counts per language, by its place in languages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(languages) * BUCKETS, np.int64)
        places = {c: i for i, c in enumerate(languages)}
        for batch in batches:
            place = np.array([places.get(x, -1) for x in batch["lang"].to_pylist()], np.int64)
            for first, _, bucket, text in _each(batch["text"]):
                own = place[first + text]
                sums += np.bincount((own * BUCKETS + bucket)[own >= 0], minlength=len(sums))
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some // BUCKETS, pa.int32()), pa.array(some % BUCKETS, pa.int32()), pa.array(sums[some])], names=["place", "bucket", "n"]
        )

    counted = labelled.select("lang", "text").mapInArrow(w.tidy(run), "place int, bucket int, n long")
    return counted.groupBy("place", "bucket").agg(F.sum("n").alias("n"))


def language_of(label: Column) -> Column:
    """The language of a label such as ``en``, ``EN`` or ``pt-BR``; null if it is no language tag."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(label)), LABEL, 1), F.lit(""))


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and log probabilities of BUCKETS trigrams for each and for UNKNOWN."""
    labelled = labelled.select(language_of(F.col("lang")).alias("lang"), "text").where(F.col("lang") != UNKNOWN)
    labels = labelled.select("lang").distinct()
    languages = sorted(r[0] for r in labels.collect())  # language codes: a bounded set
    counts = np.zeros((len(languages) + 1, BUCKETS))
    if languages:
        rows = trigram_counts(labelled, languages).toArrow()  # BUCKETS numbers for each language at most
        counts[rows["place"].to_numpy(), rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    counts += SMOOTHING
    model = np.log(counts / counts.sum(1, keepdims=True))
    model[-1] = -np.log(BUCKETS)
    return languages, model.astype(np.float32)


def text_likelihoods(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """rows (id, text, declared, host, suffix) with likely, the tempered log likelihoods, in place of text; empty without letters."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers for each language
    names = ["id", "declared", "host", "suffix"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first, n, bucket, text in _each(batch["text"]):
                size = np.bincount(text, minlength=n)
                sums = np.stack([np.bincount(text, m[bucket], minlength=n) for m in model], 1)
                likely = sums * (np.minimum(size, EVIDENCE) / np.maximum(size, 1))[:, None]
                ends = np.concatenate(([0], np.cumsum(np.where(size > 0, len(model), 0))))
                part = batch.slice(first, n)
                values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(likely[size > 0].ravel()))
                yield pa.RecordBatch.from_arrays([*[part[c] for c in names], values], names=[*names, "likely"])

    return rows.select("text", *names).mapInArrow(w.tidy(run), "id long, declared string, host string, suffix string, likely array<double>")


def _counts(languages: list[str]) -> list[Column]:
    return [F.sum((F.col("best") == i).cast("long")).alias(f"n{i}") for i in range(len(languages))]


def _shares(prefix: str, languages: list[str], rows: float, prior: str) -> Column:
    """An array of smoothed shares of counts n0, n1, ... towards the array column prior."""
    total = sum((F.col(f"n{i}") for i in range(len(languages))), F.lit(0))
    return F.array(*[(F.col(f"n{i}") + rows * F.col(prior)[i]) / (total + rows) for i in range(len(languages))]).alias(prefix)


def fused(read: DataFrame, languages: list[str]) -> DataFrame:
    """(id, lang, confidence, accepted) from rows of text_likelihoods."""
    count = len(languages)
    likely = read.withColumn("best", F.array_position("likely", F.array_max(F.slice("likely", 1, count))).cast("int") - 1)
    known = likely.where("best >= 0")
    corpus = known.agg(*_counts(languages), F.count("*").alias("n")).select(
        F.array(*[(F.coalesce(F.col(f"n{i}"), F.lit(0)) + 1.0) / (F.col("n") + float(count)) for i in range(count)]).alias("p")
    )
    corpus = F.lit(corpus.first()[0])  # one number per language
    by_suffix = known.where("suffix IS NOT NULL").groupBy("suffix").agg(*_counts(languages)).withColumn("above", corpus)
    by_suffix = by_suffix.select("suffix", _shares("suffix_prior", languages, SUFFIX_ROWS, "above"))
    by_host = known.where("host IS NOT NULL").groupBy("host").agg(*_counts(languages), F.min("suffix").alias("suffix"))
    by_host = by_host.join(by_suffix, "suffix", "left").withColumn("above", F.coalesce("suffix_prior", corpus))
    by_host = by_host.select("host", _shares("host_prior", languages, HOST_ROWS, "above"))
    # how often rows of a language declare it: P(declared | language), smoothed towards the declaration's own share
    totals = known.where("declared IS NOT NULL").groupBy().agg(*_counts(languages), F.count("*").alias("all"))
    of_language = totals.first()
    declared = known.where("declared IS NOT NULL").groupBy("declared").agg(*_counts(languages), F.count("*").alias("here"))
    share = F.col("here") / F.lit(float(max(of_language["all"], 1)))
    odds = [F.log((F.col(f"n{i}") + DECLARED_ROWS * share) / ((of_language[f"n{i}"] or 0) + DECLARED_ROWS)) for i in range(count)]
    declared = declared.select("declared", F.array(*odds, F.log(share)).alias("odds"))
    rows = likely.join(by_host, "host", "left").join(by_suffix, "suffix", "left").join(declared, "declared", "left")
    prior = F.coalesce("host_prior", "suffix_prior", corpus)
    log_prior = F.concat(F.transform(prior, lambda p: F.log(p * (1 - UNKNOWN_PRIOR))), F.array(F.log(F.lit(UNKNOWN_PRIOR))))
    nothing = F.array_repeat(F.lit(0.0), count + 1)
    total = F.zip_with(F.zip_with("likely", log_prior, lambda a, b: a + b), F.coalesce("odds", nothing), lambda a, b: a + b)
    rows = rows.withColumn("total", F.when(F.size("likely") > 0, total))
    top = F.array_max("total")
    place = F.array_position("total", top).cast("int")
    spread = F.aggregate("total", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    names = F.array(*[F.lit(c) for c in [*languages, UNKNOWN]])
    rows = rows.select(
        "id",
        F.coalesce(F.element_at(names, place), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(1 / spread, F.lit(1.0)).alias("confidence"),
    )
    return rows.withColumn("accepted", (F.col("lang") != UNKNOWN) & (F.col("confidence") >= MIN_CONFIDENCE))


def identify(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """(id, lang, confidence, accepted) for every row of (id, text, declared, host, suffix).

    labelled has lang and text. accepted is false for UNKNOWN and for a confidence below MIN_CONFIDENCE.
    """
    scratch = Scratch(rows.sparkSession)
    languages, model = train(labelled)
    if not languages:
        return rows.select("id", F.lit(UNKNOWN).alias("lang"), F.lit(1.0).alias("confidence"), F.lit(False).alias("accepted"))
    return fused(scratch.save(text_likelihoods(rows, model), "likely"), languages)


def page_evidence(pages: DataFrame) -> DataFrame:
    """(id, text, declared, host, suffix) of pages (page_id, url, html); a suffix has no port, and a numeric address none."""
    host, _ = host_and_path(F.col("url"))
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    declared = F.lower(F.regexp_extract("html", r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    named = pages.select(F.col("page_id").alias("id"), bare.alias("text"), F.nullif(declared, F.lit("")).alias("declared"), F.nullif(host, F.lit("")).alias("host"))
    name = F.regexp_replace("host", r":[0-9]*$", "")
    numeric = F.regexp_like(name, F.lit(r"^[0-9.]*$")) | F.startswith(name, F.lit("["))
    return named.withColumn("suffix", F.when(~numeric, F.nullif(F.regexp_extract(name, r"([^.]*)$", 1), F.lit(""))))


def document_evidence(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """(id, text, declared, host, suffix) of documents (doc_id, text, lang, source); a source stands for a host.

    id is doc_id, or the key given.
    """
    key = F.col("doc_id") if key is None else key
    return docs.select(
        key.alias("id"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"), F.lit(None).cast("string").alias("suffix")
    )
