import hashlib
import random
import re

import numpy as np
import pytest

from tarmac.llm import personal as p
from tarmac.llm import queries
from tests.llm.conftest import DOCS

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def brute(text):
    """Valid base spans, by the patterns as they are written."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


def card(rnd, first="4"):
    body = first + "".join(rnd.choice("0123456789") for _ in range(15 - len(first)))
    return next(body + d for d in "0123456789" if luhn(body + d))


def wrong(rnd):
    good = card(rnd, rnd.choice("0189"))
    return good[:-1] + str((int(good[-1]) + 1) % 10)


def corpus(rnd, many):
    """(doc_id, text, planted, decoys): planted spans with what stands there."""
    rows = []
    for i in range(many):
        said = [rnd.choice("the house by river stands und das haus".split()) for _ in range(rnd.randint(0, 30))]
        planted, decoys = [], []
        for _ in range(rnd.randint(0, 3)):
            kind = rnd.choice(["card", "phone", "email", "ip", "decoy", "joined", "spelled"])
            phone = f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"
            word = {
                "card": lambda: card(rnd),
                "phone": lambda: phone,
                "email": lambda: f"some.one{rnd.randint(1, 99)}@mail{rnd.randint(1, 9)}.example.com",
                "ip": lambda: ".".join(str(rnd.randint(11, 99)) for _ in range(4)),
                "decoy": lambda: wrong(rnd),
                "joined": lambda: f"{phone} {card(rnd)}",
                "spelled": lambda: f"some{rnd.randint(1, 99)} (at) mail (dot) example (dot) com",
            }[kind]()
            said.append(word)
            (decoys if kind == "decoy" else planted).extend([phone, word[len(phone) + 1 :]] if kind == "joined" else [word])
            said.append("and")
        rows.append((i, " ".join(said), planted, decoys))
    return rows


def test_base_matches_are_those_of_the_patterns():
    rnd = random.Random(4)
    pieces = ["a.b", "@", "x-y", ".", "..", "1.2.3.4", "300.1.1.1", "0001.2.3.4", "1.2.3", "+49", " ", "(0)", "-", "4111 1111-1111 1111", "_", "é", "1" * 40, "+", "5", "c%d+e@f.g", "@h.i"]
    for _ in range(4000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 14)))
        assert [(p.KINDS[k], s, e) for k, s, e, valid in p.base_matches(text) if valid] == brute(text), text
        assert {(p.KINDS[k], s, e) for (k, s, e), base in p.candidates(text).items() if base} == set(brute(text))


def test_long_rows_of_one_character_take_linear_time():
    for text in ("x" * 3_000_000, "1" * 3_000_000, "1." * 500_000, "+1" + " " * 1_000_000, "a@" * 300_000, "(" * 1_000_000, "1 " * 500_000, "[at]" * 200_000):
        list(p.base_matches(text))
        p.candidates(text)


def test_expectation_maximisation_on_counts_is_that_on_rows():
    """Counted patterns against one update a row, in plain loops."""
    rnd = random.Random(5)
    truth = [rnd.random() < 0.3 for _ in range(400)]
    good = (0.9, 0.8, 0.7, 0.85)
    rows = [tuple((2 if (rnd.random() < g) == t else 0) if rnd.random() < 0.8 else 1 for g in good) for t in truth]
    believed = [1 / (1 + np.exp(-(sum(r) - len(r)))) for r in rows]
    for _ in range(50):
        share = (sum(believed) + 1) / (len(rows) + 2)
        rates = {}
        for i in range(4):
            for y in (0, 1):
                mass = list(p._PRIOR[y])
                for r, b in zip(rows, believed):
                    mass[r[i]] += b if y else 1 - b
                rates[i, y] = [m / sum(mass) for m in mass]
        odds = [share / (1 - share) * np.prod([rates[i, 1][v] / rates[i, 0][v] for i, v in enumerate(r)]) for r in rows]
        believed = [o / (1 + o) for o in odds]
    patterns, counts = np.unique(np.array(rows), axis=0, return_counts=True)
    found_share, table = p.reliabilities(patterns, counts.astype(float))
    assert found_share == pytest.approx(share)
    assert all(table[i, y] == pytest.approx(rates[i, y]) for i in range(4) for y in (0, 1))
    by_pattern = dict(zip(map(tuple, patterns.tolist()), p.posterior(patterns, found_share, table)))
    assert [by_pattern[r] for r in rows] == pytest.approx(believed)
    assert np.mean([(b > 0.5) == t for b, t in zip(believed, truth)]) > 0.9
    assert table[0, 1, 2] + table[0, 0, 0] > table[2, 1, 2] + table[2, 0, 0]  # the more reliable labeler is found to be so


def test_classifier_climbs_to_the_top_of_its_likelihood():
    rnd = np.random.default_rng(6)
    looks = np.unique(rnd.integers(0, p.LOOKS, 60))
    counts, believed = rnd.integers(1, 50, len(looks)).astype(float), rnd.random(len(looks))
    weights = p.classifier(looks, counts, believed)

    def value(x):
        q = p.probability(looks, x)
        return (counts * (believed * np.log(q) + (1 - believed) * np.log(1 - q))).sum() - (x**2).sum() / 2

    assert all(value(weights) >= value(weights + 0.01 * rnd.normal(size=len(weights))) for _ in range(200))


def test_planted_spans_are_found_and_decoys_left(spark):
    rows = corpus(random.Random(7), 600)
    found = {r.doc_id: r.spans for r in p.find_personal(spark.createDataFrame([r[:2] for r in rows], DOCS)).collect()}
    hits = total = taken = decoyed = 0
    for doc_id, text, planted, decoys in rows:
        spans = found[doc_id]
        assert [(s.kind, s.start, s.end) for s in spans if s.base] == brute(text)
        assert [tuple(s)[:3] for s in spans] == sorted((tuple(s)[:3] for s in spans), key=lambda s: (p.KINDS.index(s[0]), s[1]))
        said = [text[s.start : s.end] for s in spans]
        hits, total = hits + sum(x in said for x in planted), total + len(planted)
        taken, decoyed = taken + sum(x in said for x in decoys), decoyed + len(decoys)
    assert hits / total > 0.95
    assert decoyed > 40 and taken / decoyed < 0.1


def test_query_digests(spark, tmp_path):
    rows = corpus(random.Random(9), 120)
    spark.createDataFrame([r[:2] for r in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op11_personal(spark, str(tmp_path)).collect()}
    for doc_id, text, *_ in rows:
        base = brute(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        r = found[doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in base) for kind in p.KINDS)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_odd_rows(spark, odd_docs):
    found = p.find_personal(odd_docs).collect()
    assert len(found) == odd_docs.count() and not any(r.spans for r in found)
    assert p.find_personal(odd_docs.limit(0)).collect() == []
    twice = spark.createDataFrame([(1, "me@x.com"), (1, "me@x.com"), (None, "é 😀 me@x.com"), (2, "only me@x.com")], DOCS)
    spans = sorted((r.doc_id or 0, *[tuple(s)[:4] for s in r.spans]) for r in p.find_personal(twice).collect())
    assert spans == [(0, ("email", 4, 12, True)), (1, ("email", 0, 8, True)), (1, ("email", 0, 8, True)), (2, ("email", 5, 13, True))]


def test_redact():
    text = "call +1 (555) 555-1234 or me@x.com"
    assert p.redact(text, [("phone", 5, 22), ("email", 26, 34), ("card", 10, 24)]) == "call <phone>r <email>"
    assert p.redact("", []) == ""
