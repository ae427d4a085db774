import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from tarmac.llm import mixing


def fill(budget, children):
    """Shares of a budget by weight and capacity, by repeated rounds: (name, weight, capacity) to tokens."""
    if not any(w for _, w, _ in children):
        children = [(n, 1.0, c) for n, _, c in children]
    got, left = {}, list(children)
    while left:
        total = sum(w for _, w, _ in left)
        full = [x for x in left if x[1] and budget / total * x[1] >= x[2]] if total else []
        if not full:
            got |= {n: int(budget / total * w) if w else 0 for n, w, _ in left} if total else {n: 0 for n, _, _ in left}
            return got
        for n, _, c in full:
            got[n] = c
            budget -= c
        left = [x for x in left if x not in full]
    return got


def brute(docs, weights, budget, max_epochs, seed):
    leaves = defaultdict(list)
    for doc, text, *path in docs:
        leaves[tuple(path)].append((doc, len((text or "").split())))
    sizes = {p: sum(n for _, n in x) for p, x in leaves.items()}
    share = {(): min(budget, sum(sizes.values()) * max_epochs)}
    for depth in range(3):
        for above in [p for p in share if len(p) == depth]:
            names = sorted({p[depth] for p in leaves if p[:depth] == above}, key=str)
            children = [(n, weights.get((*above, n), 1.0), max_epochs * sum(s for p, s in sizes.items() if p[: depth + 1] == (*above, n))) for n in names]
            share |= {(*above, n): s for n, s in fill(share[above], children).items()}
    out = []
    for path, rows in leaves.items():
        whole = share[path] // sizes[path] if sizes[path] else 0
        out += [(d, e, n) for d, n in rows for e in range(whole)]
        part = share[path] - whole * sizes[path]
        for d, n in sorted(rows, key=lambda r: hashlib.md5(f"{seed}|{whole}|{r[0]}".encode()).hexdigest()) if part > 0 else []:
            if min(n, part) > 0:
                out.append((d, whole, min(n, part)))
            part -= min(n, part)
    return sorted(out)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_DOCS", 4)
    rnd = random.Random(3)
    docs = [(i, "w " * rnd.choice([0, 1, 5, 30]), rnd.choice("xyz"), rnd.choice(["a", "b", None]), rnd.choice("pqr")) for i in range(150)]
    given = {("x",): 5.0, ("y",): 1.0, ("z",): 0.0, ("x", "a"): 9.0, ("x", "b"): 0.5, ("y", "a"): 0.0, ("y", "b"): 0.0}
    frame = spark.createDataFrame([(*d, 1, "s") for d in docs], "doc_id long, text string, domain string, lang string, source string, budget int, slice string")
    weights = {
        "domain": spark.createDataFrame([(k[0], v) for k, v in given.items() if len(k) == 1], "domain string, weight double"),
        "lang": spark.createDataFrame([(*k, v) for k, v in given.items() if len(k) == 2], "domain string, lang string, weight double"),
    }
    for budget, epochs in ((300, 1), (700, 3), (10**6, 2), (0, 1)):
        found = mixing.mix(frame, weights=weights, budget=F.lit(budget), max_epochs=epochs, seed=9)
        assert sorted((r.doc_id, r.epoch, r.taken) for r in found.collect()) == brute(docs, given, budget, epochs, 9), budget


def test_shortage_goes_to_siblings_first(spark):
    rows = [(1, "w " * 10, "x", "a", "short"), (2, "w " * 100, "x", "a", "long"), (3, "w " * 100, "x", "b", "s"), (4, "w " * 200, "y", "a", "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string, source string")
    taken = {r.doc_id: r.taken for r in mixing.mix(frame, budget=F.lit(200)).collect()}
    assert taken == {1: 10, 2: 40, 3: 50, 4: 100}  # 100 a domain, 50 a language; the short source leaves 15 to its sibling


def test_odd_rows(spark, odd_docs):
    tree = odd_docs.withColumn("domain", mixing.domain_of(F.col("source")))
    found = mixing.mix(tree, budget=F.col("tokens"), max_epochs=1).collect()
    assert len(found) == odd_docs.where("lang IS NOT NULL").count() and all(r.taken == r.n_tokens for r in found)
    assert mixing.mix(tree.limit(0)).collect() == []


def test_tokens_of_weight_0_are_no_capacity(spark):
    """What a node's children of weight 0 hold is not kept from its siblings."""
    rows = [(1, "w " * 10, "x", "a", "s"), (2, "w " * 100, "x", "b", "s"), (3, "w " * 100, "y", "a", "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string, source string")
    weights = {"lang": spark.createDataFrame([("x", "b", 0.0)], "domain string, lang string, weight double")}
    taken = {r.doc_id: r.taken for r in mixing.mix(frame, weights=weights, budget=F.lit(100)).collect()}
    assert taken == {1: 10, 3: 90}


def test_texts_under_one_id_are_taken_in_a_fixed_order(spark):
    rows = [(i % 3, "w " * (1 + i), "x", "en", "h") for i in range(60)] + [(None, "w " * 7, "x", "en", "h")] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string, source string")
    results = set()
    for seed in range(6):
        dealt = frame.orderBy(F.rand(seed)).repartition(1 + seed)
        results.add(tuple(sorted(map(str, mixing.mix(dealt, budget=F.floor(F.col("tokens") / 3), seed=4).collect()))))
    assert len(results) == 1
