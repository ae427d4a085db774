import random
import struct
import zlib
from pathlib import Path

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import orc

from tarmac.llm import token_files as tf
from tarmac.llm.chat import load_tokenizer
from tarmac.llm.store import Scratch

TEXT = st.text(alphabet="abAB é\n\t.,;:!?'0½²ª日本  \u0085　 -́", max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT | st.none(), max_size=5))
def test_pieces_give_the_tokenizers_ids(tokenizer_path, texts):
    tokenizer = load_tokenizer(tokenizer_path)
    for first, stop, ids, offsets in tf.encode_texts(pa.array(texts, pa.string()), tokenizer_path):
        for i in range(first, stop):
            expected = tokenizer.encode(texts[i] or "", add_special_tokens=False).ids
            assert ids[offsets[i - first] : offsets[i - first + 1]].tolist() == expected, texts[i]


def test_store_starts_anew_when_full(tokenizer_path, monkeypatch):
    monkeypatch.setattr(tf, "KEPT_PIECES", 50)
    tokenizer = load_tokenizer(tokenizer_path)
    rnd = random.Random(1)
    for _ in range(5):
        texts = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 9) for _ in range(30))]
        ((_, _, ids, _),) = tf.encode_texts(pa.array(texts), tokenizer_path)
        assert ids.tolist() == tokenizer.encode(texts[0], add_special_tokens=False).ids


def test_round_trip(spark, odd_docs, tokenizer_path):
    path = Scratch(spark).path("tokens")
    tf.write_token_files(odd_docs, path, tokenizer_path)
    files = tf.read_token_files(spark, path)
    tokenizer = load_tokenizer(tokenizer_path)
    expected = [(r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]) for r in odd_docs.collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.ids) for r in files.collect()), key=key) == sorted(expected, key=key)
    index = sorted(tf.token_index(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in index] == sorted((r.doc_id for r in index), key=lambda i: (i is not None, i or 0))
    at = 0
    sums = {(i, zlib.crc32(struct.pack(f"<{len(x)}I", *x))) for i, x in expected}
    for r in index:
        assert r.start == at and (r.doc_id, r.ids_crc32) in sums
        at += r.n_tokens


def test_reads_by_id_reach_the_index(spark, tokenizer_path):
    docs = spark.range(5000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    path = Scratch(spark).path("tokens")
    tf.write_token_files(docs, path, tokenizer_path)
    one = tf.read_token_files(spark, path).where("doc_id = 1234")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,1234)" in plan
    assert len(one.collect()) == 1


def test_empty_table(spark, odd_docs, tokenizer_path):
    path = Scratch(spark).path("tokens")
    tf.write_token_files(odd_docs.limit(0), path, tokenizer_path)
    assert tf.token_index(tf.read_token_files(spark, path)).collect() == []


def test_byte_letters_match_the_vocabulary(tokenizer_path):
    vocab = load_tokenizer(tokenizer_path).get_vocab()
    letters = tf.byte_letters()
    assert len(set(letters.values())) == 256 and all(c in vocab for c in letters.values())


def test_added_tokens_have_their_id(tokenizer_path):
    """As the plain vocabulary has it; a mark that only two texts together spell is none."""
    tokenizer = load_tokenizer(tokenizer_path, special_as_text=False)
    mark = "<|endoftext|>"
    texts = [f"x {mark} y", mark, f"{mark}{mark}a", f"<{mark}>  {mark}\n", "<|endo", f"ftext|>b, c.{mark}", None, f"é {mark}日本"]
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids[1:].count(50256) == 1
    for first, stop, ids, offsets in tf.encode_texts(pa.array(texts, pa.string()), tokenizer_path):
        for i in range(first, stop):
            expected = tokenizer.encode(texts[i] or "", add_special_tokens=False).ids
            assert ids[offsets[i - first] : offsets[i - first + 1]].tolist() == expected, texts[i]


def rows_read(df):
    """Rows that the scan gave, after whatever the files' indexes let it skip."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_indexes_and_bloom_filters_skip_rows(spark, tokenizer_path, monkeypatch):
    """Even ids in one file of many row groups and more than one stripe."""
    monkeypatch.setattr(tf, "ORC_STRIDE", 1000)
    monkeypatch.setattr(tf, "ORC_STRIPE", 1 << 16)
    docs = spark.range(40_000).selectExpr("2 * id AS doc_id", "concat('some text number ', id, ' of many') AS text").coalesce(1)
    path = Scratch(spark).path("tokens")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        tf.write_token_files(docs, path, tokenizer_path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    files = sorted(Path(path).glob("*.orc"))
    assert len(files) == 1 and orc.ORCFile(files[0]).nstripes > 1
    read = tf.read_token_files(spark, path)
    assert rows_read(read.select("doc_id")) == 40_000
    assert 0 < rows_read(read.where("doc_id = 23456")) <= 1000  # one row group
    assert rows_read(read.where("doc_id > 79000 AND doc_id < 79100")) <= 2000
    assert rows_read(read.where("doc_id = 100001")) == 0  # beyond all ids
    missing = [rows_read(read.where(f"doc_id = {i}")) for i in (10_001, 23_457, 40_003, 60_123)]
    assert missing.count(0) >= 3  # inside the row groups' ranges: the Bloom filters know


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        tf.PieceEncoder(public_tokenizers.path("word_bpe_49k.json"))
