import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import fill_middle as fm
from tests.llm.conftest import DOCS

PIECES = {"characters": lambda t: list(t), "words": lambda t: re.findall(r"^[ \t-\r]*[^ \t-\r]*[ \t-\r]*|[^ \t-\r]+[ \t-\r]*", t), "lines": lambda t: re.findall(r"[^\n]*\n|[^\n]+", t)}


def brute(doc_id, text, seed=1, unit="characters", rate=90, suffix_first=20):
    """The contract's words, by list slices."""
    text = text or ""
    units = [x for x in PIECES[unit](text) if x]
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < suffix_first:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("unit", list(fm.UNITS))
def test_against_slices(spark, odd_docs, unit):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("a é日\n<P😀\t") for _ in range(rnd.choice([1, 3, 50, 900, 9000]))) for _ in range(80)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(200, "has <M> inside"), (201, "  "), (202, "\n\n")]
    docs = spark.createDataFrame(rows, DOCS).unionByName(odd_docs.select("doc_id", "text"))
    given = [(r.doc_id, r.text) for r in docs.collect()]
    found = fm.fill_middle(docs, seed=1, unit=unit)
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert found.columns == names
    assert sorted(map(tuple, found.collect()), key=key) == sorted((brute(*r, unit=unit) for r in given), key=key)
    assert {r.form for r in found.collect()} == {"plain", "psm", "spm"}
    back = found.select("doc_id", fm.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(map(tuple, back), key=key) == sorted(((d, t or "") for d, t in given), key=key)


def test_rates_and_marks(spark):
    docs = spark.createDataFrame([(i, f"text number {i} <P> of some length") for i in range(300)], DOCS)
    marks = ("[pre]", "[suf]", "[mid]")
    found = fm.fill_middle(docs, seed=9, marks=marks, rate=100, suffix_first=50)
    assert {r.form for r in found.collect()} == {"psm", "spm"}
    back = found.select(fm.restored(F.col("output"), F.col("form"), marks).alias("text"))
    assert sorted(r.text for r in back.collect()) == sorted(r.text for r in docs.collect())
    with pytest.raises(ValueError):
        fm.fill_middle(docs, seed=9, marks=("<P>", "<P>x", "<M>"))
    with pytest.raises(ValueError):
        fm.fill_middle(docs, seed=9, unit="bytes")


def test_fenwick_tree():
    rnd = random.Random(1)
    for size in (1, 2, 7, 8, 33):
        counts = np.array([rnd.choice([0, 0, 1, 5]) for _ in range(size)])
        tree = fm.Fenwick(counts)
        assert [tree.before(i) for i in range(size + 1)] == [int(counts[:i].sum()) for i in range(size + 1)]
        holders = [(i, j) for i, c in enumerate(counts) for j in range(c)]
        assert [tree.find(k) for k in range(len(holders))] == holders
        assert tree.find(len(holders))[0] == size


def test_empty_table(spark, odd_docs):
    assert fm.fill_middle(odd_docs.limit(0), seed=1).collect() == []
