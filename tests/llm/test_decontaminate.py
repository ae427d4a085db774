import random
import re

import numpy as np

from tarmac.llm import decontaminate as dc
from tarmac.llm import words as w

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        x = words(text)
        n = min(dc.SPAN, len(x))
        for a in range(len(x) - n + 1 if n else 0):
            windows.setdefault(tuple(x[a : a + n]), set()).add(item)
    out = []
    for doc, text in docs:
        x, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(x) - n + 1):
                if tuple(x[a : a + n]) in windows:
                    hit.update(range(a, a + n))
                    found |= windows[tuple(x[a : a + n])]
        out.append((doc, len(x), len(hit), sorted(found)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_words int, items string")
    b = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, fp int")
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in dc.contamination(d, b).collect()), key=str)


def test_against_brute_force(spark):
    rnd = random.Random(5)
    some = lambda n, k=6: " ".join(rnd.choice("abcdefghij"[:k]) for _ in range(n))
    items = [(i, some(rnd.choice([0, 1, 3, 9, 10, 11, 25]), 10)) for i in range(12)] + [(50, None), (51, "A, b. C"), (52, "A, b. C")]
    docs = [(i, some(rnd.choice([0, 5, 9, 10, 40]), 10)) for i in range(25)]
    for i in range(15):  # documents with whole and cut passages
        text = items[rnd.randrange(12)][1].split()
        cut = text[rnd.randrange(3) : len(text) - rnd.randrange(3)]
        docs.append((100 + i, some(7) + " " + ", ".join(cut).upper() + "! " + some(7)))
    docs += [(None, None), (None, docs[30][1]), (200, docs[30][1]), (200, docs[30][1]), (201, "")]
    assert run(spark, docs, items) == brute(docs, items)
    assert any(r[2] for r in brute(docs, items))


def test_empty_tables(spark):
    docs = [(1, "a b c d e f g h i j k")]
    assert run(spark, docs, []) == [(1, 11, 0, [])]
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, docs, [(1, ""), (2, None)]) == [(1, 11, 0, [])]


def test_every_shared_span_keeps_a_common_fingerprint():
    rng = np.random.default_rng(3)
    span = rng.integers(0, 4, dc.SPAN).astype(w.U64)  # few different words make many equal hashes
    for _ in range(200):
        kept = []
        for _ in range(2):
            a, b = rng.integers(0, 12, 2)
            text = np.concatenate((rng.integers(0, 4, a).astype(w.U64), span, rng.integers(0, 4, b).astype(w.U64)))
            at, fps = dc.winnow(text, np.array([0, len(text)]))
            kept.append({(int(i - a), int(f)) for i, f in zip(at, fps) if a <= i <= a + dc.SPAN - dc.K})
        assert kept[0] & kept[1]


def test_clean_documents_keep_columns(spark, odd_docs):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog and runs away")], "item_id long, text string")
    clean = dc.clean_documents(odd_docs, items)
    assert clean.columns == odd_docs.columns
    assert clean.count() == odd_docs.count() - 3
