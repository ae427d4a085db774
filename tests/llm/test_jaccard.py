import random
import re

import numpy as np

from tarmac.llm import jaccard
from tarmac.llm.components import components
from tarmac.llm.store import Scratch

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, k=3, percent=90):
    sets = []
    for _, text in docs:
        x = WORDS.findall((text or "").lower())
        sets.append({tuple(x[a : a + k]) for a in range(len(x) - k + 1)} if len(x) >= k else {tuple(x)} - {()})
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(docs))


def near_copies(rnd, size):
    """Groups of near copies, each made by changing a few words of another member, and unrelated texts."""
    docs, at = [], 0
    for group in range(size):
        base = [rnd.choice("abcdefghijklmnopqrstuvwxyz") * rnd.randint(1, 3) for _ in range(rnd.choice([2, 3, 30, 90, 200]))]
        members = [base]
        for _ in range(rnd.choice([0, 1, 4, 12])):
            copy = list(rnd.choice(members))
            for _ in range(rnd.choice([0, 1, 2, 5])):
                copy[rnd.randrange(len(copy))] = "x" + str(rnd.randrange(9))
            members.append(copy)
        for m in members:
            at += rnd.randint(1, 5)
            docs.append((at, " ".join(m)))
    rnd.shuffle(docs)
    return docs


def run(spark, docs, **options):
    frame = spark.createDataFrame([(i, t, "p", 3) for i, t in docs], "doc_id long, text string, pivot string, n int")
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_documents(frame, **options).collect())


def test_against_brute_force(spark):
    docs = near_copies(random.Random(11), 25)
    expected = brute(docs)
    assert run(spark, docs) == expected
    assert len({c for _, _, c in expected}) < len(docs) - 20


def test_long_sets(spark):
    """Counts by hash range that do not fit a byte lose no link."""
    rnd = random.Random(1)
    base = [f"w{i}" for i in range(12_000)]
    docs = []
    for i, size in enumerate([12_000, 12_000, 9_000, 8_500, 7_500, 7_400, 6_000]):
        copy = base[:size]
        for _ in range(size // 100):
            copy[rnd.randrange(size)] = f"x{i}"
        docs.append((i, " ".join(copy)))
    assert run(spark, docs) == brute(docs)


def test_lower_similarity(spark):
    docs = near_copies(random.Random(4), 10)
    assert run(spark, docs, k=5, percent=80) == brute(docs, 5, 80)


def test_odd_rows(spark, odd_docs):
    found = {}
    for r in jaccard.similar_documents(odd_docs).collect():
        found.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert found[1] == found[2] == {(12, 1)}
    assert found[3] == {(0, 3)} and found[4] == {(0, 4)} and found[5] == {(0, 5)}
    assert found[6] == {(1, 6)} and found[7] == {(1, 7)}
    assert found[9] == {(1, 9)} and found[None] == {(1, 9), (0, None)}  # the null id with two words joins document 9
    assert jaccard.similar_documents(odd_docs.limit(0)).collect() == []


def test_prefix_is_long_enough():
    for percent in (50, 80, 90, 100):
        for n in range(1, 200):
            need = -(-percent * n // 100)  # overlap that any similar set has at least
            assert jaccard.prefix_length(n, percent) == n - need + 1


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 230)]
    links = spark.createDataFrame([*chain, *star, (5, 5), (None, 3), (9, 8)], "a long, b long")
    found = {r.node: r.component for r in components(links, Scratch(spark)).collect()}
    assert found == {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 230)]} | {8: 8, 9: 8}


def test_ranks_by_slot(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "b c d")], "doc_id long, text string")
    signed = jaccard.signed_sets(docs, 3, 1 << 17)
    ranks = jaccard.slot_ranks(signed, 1 << 17)
    assert np.array_equal(np.sort(ranks[ranks > 0]), [1, 2])
    assert not jaccard.slot_ranks(signed.limit(0), 1 << 17).any()


def test_counts_of_a_task_are_bounded(spark):
    docs = spark.createDataFrame([(i, "a b c") for i in range(1000)], "doc_id long, text string").coalesce(1)
    ranks = jaccard.slot_ranks(jaccard.signed_sets(docs, 3, 1 << 16), 1 << 16)
    assert ranks.max() == jaccard.MOST_IN_TASK and (ranks > 0).sum() == 1


def test_ranks_take_few_jobs(spark):
    signed = Scratch(spark).save(jaccard.signed_sets(spark.createDataFrame(near_copies(random.Random(2), 10), "doc_id long, text string"), 3, 1 << 24), "signed")
    spark.sparkContext.setJobGroup("ranks", "")
    jaccard.slot_ranks(signed, 1 << 24)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("ranks")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 3
