import zlib

import corpus_pipeline as cp
import pytest

from tarmac.llm.store import Scratch
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_mixing import brute as mixture

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of documents and of each stage's result."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    scratch = Scratch(spark)
    for name, stage in cp.STAGES:
        docs = scratch.save(stage(spark, docs, SF), name)
        out.append(docs.collect())
        if name != cp.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return out


def test_stages_against_brute_force(spark, stages):
    """Each group at five words and 0.8 keeps one document, and the stages after it go on from there."""
    given, spoken, single, clean, mixed, tokens = stages
    ids = lambda rows: sorted(r.doc_id for r in rows)
    assert ids(spoken) == ids(r for r in given if any(c.isalpha() for c in r.text or ""))
    texts = [(r.doc_id, r.text) for r in spoken]
    kept = [d for d, _, c in groups(texts, 5, 80) if d == c]
    assert ids(single) == kept
    assert len(kept) < len([d for d, _, c in groups(texts) if d == c])  # these rows tell the two measures apart
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert ids(clean) == sorted(d for d, _, hit, _ in leaks([(r.doc_id, r.text) for r in single], items) if not hit)
    domain = lambda s: f"domain{zlib.crc32(s.encode()) % 3}"
    tree = [(r.doc_id, r.text, domain(r.source), r.lang, r.source) for r in clean]
    weights = {(r.domain,): r.weight for r in cp.mixing_weights(spark)["domain"].collect()}
    weights |= {(r.domain, r.lang): r.weight for r in cp.mixing_weights(spark)["lang"].collect()}
    budget = int(sum(len(r.text.split()) for r in clean) * cp.MIXED_SHARE)
    assert ids(mixed) == sorted(d for d, _, _ in mixture(tree, weights, budget, 1, 7))
    assert ids(tokens) == ids(mixed)
    assert len(given) > len(single) > len(clean) > len(mixed)


def test_edited_copy_is_joined(spark):
    """An edited copy that 5 words at 0.8 find and 3 words at 0.9 do not."""
    words = [f"w{i}" for i in range(50)]
    texts = [(1, " ".join(words)), (2, " ".join([*words[:30], "other", *words[31:]])), (3, "a text of its own that is like none of the others")]
    docs = spark.createDataFrame([(d, t, "en", "host", len(t)) for d, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(r.doc_id for r in cp.join_near_copies(spark, docs, SF).collect())
    assert kept == [1, 3] == [d for d, _, c in groups(texts, 5, 80) if d == c]
    assert [d for d, _, c in groups(texts) if d == c] == [1, 2, 3]


def test_texts_under_one_id_and_repeated_rows(spark):
    """A clean text whose id another text shares stays; equal rows, and equal texts without id, leave one."""
    near = " ".join(f"w{i}" for i in range(50))
    rows = [(3, near), (5, near + " end"), (5, "a clean text of its own that is like none of the others"), (7, "one row given three times over here")]
    rows += [rows[-1]] * 2 + [(None, "the same words and no id at all")] * 2
    docs = spark.createDataFrame([(d, t, "en", f"host{i}", len(t)) for i, (d, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.join_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, rows[-1][1]), (3, near), (5, rows[2][1]), (7, rows[3][1])]


def test_run_gives_the_last_stage(spark, stages):
    found = cp.run(spark, SF)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, stages[-1]))


def test_odd_and_empty_rows(spark, odd_docs):
    docs = odd_docs.selectExpr("doc_id", "text", "lang", "source", "CAST(length(text) AS long) AS n_chars")
    for rows in (docs, docs.limit(0)):
        for _, stage in cp.STAGES:
            rows = Scratch(spark).save(stage(spark, rows, SF), "stage")
        kept = [r.doc_id for r in rows.collect()]
        assert len(kept) <= 9
