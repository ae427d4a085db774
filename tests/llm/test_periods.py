import random
import re
import zlib

import numpy as np
import pytest
import pyarrow as pa

from tarmac.llm import periods, queries
from tarmac.llm import words as w
from tests.llm.conftest import DOCS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(said, min_length=6, exponent=4):
    """Every maximal stretch of each period, and of these the ones that no smaller period fits."""
    out = []
    for q in range(1, len(said) // exponent + 1):
        i = 0
        while i + q < len(said):
            start = i
            while i + q < len(said) and said[i] == said[i + q]:
                i += 1
            length = i + q - start
            run = said[start : start + length]
            if i > start and length >= max(min_length, exponent * q) and not any(run[p:] == run[:-p] for p in range(1, q)):
                out.append((start, length, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(said, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(said) if i not in gone)


def some_texts(rnd, many):
    texts = []
    for _ in range(many):
        said = []
        while rnd.random() < 0.8 and len(said) < 250:
            unit = [rnd.choice("abA") for _ in range(rnd.choice([1, 1, 2, 3, 5, 8, 17]))]
            said += (unit * 70)[: rnd.randint(1, 70)]
        texts.append(" ".join(said))
    return texts


@pytest.mark.parametrize("exponent,min_length", [(4, 6), (3, 6), (3, 2), (5, 20)])
def test_runs_against_all_periods(exponent, min_length):
    texts = some_texts(random.Random(exponent + min_length), 150)
    for at in range(0, len(texts), 5):
        part = texts[at : at + 5]
        hashes, _, _, offsets = w.word_spans(*w.raw(pa.array(part)), periods.EXACT)
        expected = [(i, *r) for i, t in enumerate(part) for r in brute(t.split(), min_length, exponent)]
        assert sorted(periods.runs_of(hashes, offsets, min_length, exponent)) == sorted(expected)


def test_operator(spark, odd_docs):
    rows = [(i, t) for i, t in enumerate(some_texts(random.Random(8), 40))]
    rows += [(100, "aba" * 3), (101, " ".join(["la", "LA"] * 40) + " end"), (102, "a b " * 9), (103, "x\x1cy " * 9), (104, " ".join(map(str, list(range(500)) * 7)))]
    docs = spark.createDataFrame(rows, DOCS).unionByName(odd_docs.select("doc_id", "text"))
    given = [(r.doc_id, r.text) for r in docs.collect()]
    found = periods.periodic_runs(docs).collect()
    expected = []
    for doc_id, text in given:
        said = WORD.findall(text or "")
        runs = [(0, len(said), 1)] if len(said) > 1000 and len(set(said)) == 1 else brute(said)
        expected.append((doc_id, len(said), runs, collapsed(said, runs)))
    order = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found), key=order) == sorted(expected, key=order)
    assert next(r for r in found if r.doc_id == 104).runs[0].period == 500
    assert periods.periodic_runs(odd_docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periods.periodic_runs(docs, exponent=2)


def test_a_lag_covered_once_is_not_extended_again(monkeypatch):
    calls = []
    agreeing = periods.agreeing
    monkeypatch.setattr(periods, "agreeing", lambda a, b: calls.append(1) or agreeing(a, b))
    hashes = np.tile(np.arange(1, 6, dtype=np.uint64), 2000)
    assert periods.runs_of(hashes, np.array([0, len(hashes)])) == [(0, 0, len(hashes), 5)]
    assert len(calls) == 2


def test_query_repeats_a_tenth(spark, tmp_path):
    texts = {i: " ".join(random.Random(i).choice("one two three four five six".split()) for _ in range(random.Random(i).randint(0, 120))) for i in range(150)}
    spark.createDataFrame(list(texts.items()), DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()}
    seen = 0
    for i, text in texts.items():
        said, h = text.split(), zlib.crc32(str(i).encode())
        n, g = len(said), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            said = [said[j] if j < a else said[a + (j - a) % p] for j in range(n)]
        runs = brute(said)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = found[i]
        seen += bool(runs)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *(best or (None,) * 3))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        sha = lambda t: __import__("hashlib").sha256(t.encode()).hexdigest()
        assert r.runs_sha256 == sha("".join(f"{a},{b},{c}\n" for a, b, c in runs))
        assert r.collapsed_sha256 == sha(collapsed(said, runs))
    assert seen > 5
