import math
import random
import re
import zlib
from collections import Counter

import pytest

from tarmac.llm import suffix_tree as pst

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


class Brute:
    """The model of the docstring, with dictionaries."""

    def __init__(self, texts, held):
        counts = [Counter() for _ in range(pst.DEPTH + 1)]
        for x, out in zip(texts, held):
            if not out:
                for i in range(len(x)):
                    for d in range(min(i, pst.DEPTH) + 1):
                        counts[d][tuple(x[i - d : i + 1])] += 1
        self.counts, self.total, self.distinct = counts, sum(counts[0].values()), len(counts[0])
        self.entries: dict[tuple, dict] = {}
        for d in range(1, pst.DEPTH + 1):
            fresh: dict[tuple, dict] = {}
            for gram, n in counts[d].items():
                context, word = gram[:-1], gram[-1]
                if d > 1 and context[-1] not in self.entries.get(context[:-1], {}):
                    continue
                above = counts[d - 1][context]
                below = self.probability(context[1:], word)
                expected = above * below
                if n >= pst.MIN_COUNT and n / expected >= pst.RATIO and n * math.log(n / expected) - (n - expected) >= pst.DIVERGENCE:
                    fresh.setdefault(context, {})[word] = ((n - pst.DISCOUNT) / above, below)
            self.entries |= fresh

    def probability(self, context, word):
        if not context:
            return (self.counts[0][(word,)] + 0.5) / (self.total + 0.5 * (self.distinct + 1))
        own = self.entries.get(context, {})
        below = self.probability(context[1:], word)
        if word in own:
            return own[word][0]
        if own:
            return below * (1 - sum(p for p, _ in own.values())) / (1 - sum(q for _, q in own.values()))
        return below

    def score(self, x):
        return sum(math.log10(self.probability(tuple(x[max(0, i - pst.DEPTH) : i]), x[i])) for i in range(len(x)))


def corpus():
    rnd = random.Random(8)
    phrases = [[rnd.choice("abcdefgh") * rnd.randint(1, 2) for _ in range(rnd.randint(3, 8))] for _ in range(12)]
    docs = []
    for i in range(120):
        x = []
        for _ in range(rnd.randint(0, 6)):
            x += rnd.choice(phrases) if rnd.random() < 0.7 else [f"w{rnd.randrange(200)}"]
        docs.append((i, " ".join(x)))
    return [*docs, (None, "a b c"), (None, None), (500, ""), (501, None), (7, docs[7][1]), (502, " \n\t ")]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, "c") for i, t in docs], "doc_id long, text string, block int, score string").repartition(3)


def test_against_brute_force(spark):
    docs = corpus()
    texts = [[*WORDS.findall(t or ""), "\0"] for _, t in docs]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in docs]
    model = Brute(texts, held)
    expected = [
        (i, h, len(x), sum((t,) in model.counts[0] for t in x), model.total, sum(math.log10(model.probability((), t)) for t in x), model.score(x))
        for (i, _), x, h in zip(docs, texts, held)
    ]
    found = [tuple(r) for r in pst.score_documents(frame(spark, docs)).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    for a, b in zip(sorted(found, key=order), sorted(expected, key=order), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], abs=1e-9)
    assert any(len(c) == 2 for c in model.entries)  # contexts of two words are retained

    # the states give distributions: known words and the unknown one add up to one
    words = [w for (w,) in model.counts[0]]
    for context in [(), *list(model.entries)[:40]]:
        assert sum(model.probability(context, w) for w in [*words, "unknown"]) == pytest.approx(1)

    # held-out texts are likelier than under the root alone
    out = [r for r in found if r[1]]
    assert sum(r[6] for r in out) > sum(r[5] for r in out)


def test_empty_and_untrained(spark):
    assert pst.score_documents(frame(spark, [(1, "a")]).limit(0)).collect() == []
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    (row,) = pst.score_documents(frame(spark, [(held, "a b")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert row.score == row.base_score == pytest.approx(0.0)


def test_blocks_fill_over_batches(spark):
    docs = corpus()
    tokens = sum(len(WORDS.findall(t or "")) + 1 for _, t in docs)
    rows = frame(spark, docs).selectExpr("doc_id", "doc_id % 5 = 1 AS held", "text")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        whole = pst.encoded_blocks(rows).collect()
        small = pst.encoded_blocks(rows, 100).collect()
        scored = [pst.score_documents(frame(spark, docs), block_tokens=n).collect() for n in (1, pst.BLOCK_TOKENS)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(whole) == 3  # one of each task, however many batches come
    longest = max(len(WORDS.findall(t or "")) + 1 for _, t in docs)
    assert len(small) > 3 and all(sum(b.lengths) < 100 + 7 * longest for b in small)
    for blocks in (whole, small):
        assert len({b.block for b in blocks}) == len(blocks) and sum(sum(b.lengths) for b in blocks) == tokens
        key = lambda i: (i is None, i)
        assert sorted((i for b in blocks for i in b.doc_ids), key=key) == sorted((i for i, _ in docs), key=key)
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    for a, b in zip(*(sorted(map(tuple, rows), key=order) for rows in scored), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-9)


def test_blocks_are_not_shuffled_again(spark):
    scored = pst.score_documents(frame(spark, corpus()))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(block") == 1, plan  # the answers alone
    assert not spark.sql("SHOW TABLES").where("tableName LIKE 'tarmac%'").collect()
