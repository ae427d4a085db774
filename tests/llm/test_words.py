import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.llm import words as w
from tarmac.llm.store import Scratch, disposed

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KINDS = {"spaced": (w.SPACED, r"[^\x20\x09-\x0D]+"), "alnum": (w.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")}


def split(texts, kind):
    out = []
    for _, hashes, offsets in w.each_text(pa.array(texts, pa.string()), kind):
        out += [hashes[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    return out


@pytest.mark.parametrize("name", KINDS)
@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aAbZ09 .\n\tßé日 ", max_size=30), max_size=6))
def test_words_are_those_of_the_pattern(name, texts):
    kind, pattern = KINDS[name]
    expected = [re.findall(pattern, (t or "").translate(LOWER)) for t in texts]
    found = split(texts, kind)
    assert [len(x) for x in found] == [len(x) for x in expected]
    flat = [(h, word) for hs, ws in zip(found, expected) for h, word in zip(hs, ws)]
    assert len({h for h, _ in flat}) == len({word for _, word in flat}) == len(set(flat))


def test_chunks_do_not_show(monkeypatch):
    texts = ["ab cd " * 50 + "x" * 70 + " y", "", "z" * 40, "q r s"]
    whole = split(texts, w.SPACED)
    monkeypatch.setattr(w, "CHUNK", 16)
    assert split(texts, w.SPACED) == whole


def test_sliced_and_null_columns():
    column = pa.array(["skipped", None, "a b", ""]).slice(1)
    data, bounds = w.raw(column)
    assert bytes(data) == b"a b" and bounds.tolist() == [0, 0, 3, 3]
    assert w.raw(pa.array([], pa.string()))[1].tolist() == [0]


def test_shingles():
    hashes = np.array([1, 2, 3, 1, 2, 3, 9], w.U64)
    sets = list(w.shingle_sets(hashes, np.array([0, 6, 6, 7]), 3))
    assert [len(s) for s in sets] == [3, 0, 1]


@given(st.lists(st.integers(0, 2**64 - 1), max_size=20))
def test_packed_keys(keys):
    keys = np.unique(np.array(keys, w.U64))
    assert np.array_equal(w.unpack_sorted(w.pack_sorted(keys)), keys)


def test_what_is_made_inside_a_scope_goes(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting, None)
    outside = Scratch(spark)
    kept = outside.save(spark.range(5), "kept")
    spark.conf.set(setting, "12345")
    with disposed(spark):
        inside = Scratch(spark)
        assert inside.save(spark.range(3), "gone").count() == 3
    assert not Path(inside.base).exists() and kept.count() == 5
    assert spark.conf.get(setting) == "12345"
    spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
