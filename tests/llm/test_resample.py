import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarmac.llm import resample
from tarmac.llm import words as w


def labelled(spark):
    rnd = random.Random(6)
    docs, labels = [], []
    for i in range(300):
        good = i % 3 != 0
        pool = [f"good{j}" for j in range(40)] if good else [f"bad{j}" for j in range(40)]
        docs.append((i, " ".join(rnd.choice(pool + [f"any{j}" for j in range(40)]) for _ in range(40))))
        if i % 2:
            labels.append((i, int(good), 0))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    rows = resample.resample(docs, labels).collect()
    unseen = [r for r in rows if r.doc_id % 2 == 0]
    right = sum(r.kept == (r.doc_id % 3 != 0) for r in unseen)
    assert right / len(unseen) > 0.95
    assert sum(r.kept for r in rows) == round(300 * 100 / 150)


def test_kept_are_the_largest_keys(spark):
    docs, labels = labelled(spark)
    rows = resample.resample(docs, labels, keep_share=0.25).collect()
    by_key = sorted(rows, key=lambda r: -r.sample_key)
    assert {r.doc_id for r in by_key[:75]} == {r.doc_id for r in rows if r.kept}
    again = resample.resample(docs.repartition(5), labels, keep_share=0.25).collect()
    assert {(r.doc_id, r.kept) for r in again} == {(r.doc_id, r.kept) for r in rows}


def test_largest_with_ties_and_bounds(spark):
    rnd = random.Random(0)
    values = [(i, rnd.choice([0.0, 1.0, 1.0 + 1e-12, 5e8, -3.0])) for i in range(3000)] + [(3000 + i, rnd.random()) for i in range(3000)]
    frame = spark.createDataFrame(values, "row_key long, key double")
    order = sorted(values, key=lambda v: (-v[1], v[0]))
    for k in (0, 1, 700, 2500, 5999, 6000, 9999):
        kept = {r.row_key for r in resample.largest(frame, "key", "row_key", k).where("kept").collect()}
        assert kept == {i for i, _ in order[:k]}, k
    assert resample.largest(frame.limit(0), "key", "row_key", 3).collect() == []


def test_gumbel_noise(spark):
    noise = [r[0] for r in spark.range(4000).select(resample.gumbel(F.col("id"), 1)).collect()]
    assert all(map(math.isfinite, noise)) and abs(sum(noise) / 4000 - 0.5772) < 0.1


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, None), (6, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = resample.resample(odd_docs, labels, keep_share=1.0).collect()
    assert len(rows) == odd_docs.count() and all(r.kept for r in rows)
    assert all(r.log_weight == 0 for r in rows if r.n_features == 0)
    assert resample.resample(odd_docs.limit(0), labels).collect() == []
    assert len(resample.resample(odd_docs, labels.limit(0)).collect()) == odd_docs.count()


def word_hash(word):
    hashes, *_ = w.word_spans(*w.raw(pa.array([word])))
    return hashes[:1]


def brute_weights(docs, good):
    """Mean log ratio of smoothed unigram and bigram counts times LENGTH, with dictionaries."""
    known = {}

    def grams(text):
        said = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        hashes = [known.setdefault(x, word_hash(x)) for x in said]
        both = [w.combine(a, b) for a, b in zip(hashes, hashes[1:])]
        return [int(h[0]) % resample.BUCKETS for h in (*hashes, *both)]

    target, raw = Counter(), Counter()
    for doc_id, text in docs:
        raw.update(grams(text))
        if doc_id in good:
            target.update(grams(text))
    n_target, n_raw, s = sum(target.values()), sum(raw.values()), resample.SMOOTHING

    def ratio(b):
        return math.log((target[b] + s) / (n_target + s * resample.BUCKETS)) - math.log((raw[b] + s) / (n_raw + s * resample.BUCKETS))

    out = {}
    for doc_id, text in docs:
        own = grams(text)
        out[doc_id] = (len(own), sum(map(ratio, own)) / max(len(own), 1) * resample.LENGTH)
    return out


def test_weights_against_dictionaries(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    marks = {}
    for r in labels.collect():
        if r.quality is not None:
            marks[r.doc_id] = marks.get(r.doc_id, True) and r.quality == 1 and not r.toxic
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = brute_weights(rows, {d for d, good in marks.items() if good})
    found = resample.resample(docs.select("doc_id", "text"), labels).collect()
    assert len(found) == len(rows)
    for r in found:
        n, weight = expected[r.doc_id]
        assert r.n_features == n and r.log_weight == pytest.approx(weight, abs=1e-6)
    kept = sum(marks.values()) / len(marks)
    assert sum(r.kept for r in found) == round(len(rows) * kept)
    least = min(r.sample_key for r in found if r.kept)
    assert all(r.sample_key <= least for r in found if not r.kept)
