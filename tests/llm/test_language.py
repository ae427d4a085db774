import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tarmac.llm import language

WORDS = {"en": "the of and to in is that with river house", "de": "der die und das ist nicht mit für straße haus", "fr": "le la et les des est dans pour rivière très"}


def texts(rnd, lang, n):
    return " ".join(rnd.choice(WORDS[lang].split()) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(1)
    rows = [(lang, texts(rnd, lang, 30)) for lang in WORDS for _ in range(30)]
    return spark.createDataFrame([*rows, (None, "x y z"), ("und", "noise"), ("de", None)], "lang string, text string")


EVIDENCE = "id long, text string, declared string, host string, suffix string"


def identify(spark, labelled, rows):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], EVIDENCE + ", lang string")
    return {r.id: r for r in language.identify(frame, labelled).collect()}


def test_held_out_texts(spark, labelled):
    rnd = random.Random(2)
    truth = {i: lang for i, lang in enumerate(lang for lang in WORDS for _ in range(20))}
    found = identify(spark, labelled, [(i, texts(rnd, lang, 12), None, None, None) for i, lang in truth.items()])
    assert {i: r.lang for i, r in found.items()} == truth
    assert all(r.accepted and r.confidence > 0.5 for r in found.values())


def test_evidence_settles_short_texts(spark, labelled):
    rnd = random.Random(3)
    sure = [(i, texts(rnd, "de", 25), "de", "haus.de", "de") for i in range(100, 140)]
    sure += [(i, texts(rnd, "fr", 25), "fr", "riviere.fr", "fr") for i in range(200, 240)]
    unclear = "abc"
    found = identify(spark, labelled, [*sure, (1, unclear, "de", None, None), (2, unclear, "fr", None, None), (3, unclear, None, "haus.de", "de"), (4, unclear, None, "new.fr", "fr")])
    assert [found[i].lang for i in (1, 2, 3, 4)] == ["de", "fr", "de", "fr"]


def test_prior_is_smoothed_by_host_then_suffix(spark, labelled):
    """The posterior of one row, computed from the tables by hand."""
    rnd = random.Random(4)
    rows = [(i, texts(rnd, "de", 30), None, "a.x", "x") for i in range(3)] + [(10 + i, texts(rnd, "fr", 30), None, "b.x", "x") for i in range(6)]
    rows.append((99, "abc", None, "a.x", "x"))
    languages, model = language.train(labelled)
    assert languages == ["de", "en", "fr"]
    read = {r.id: r for r in language.text_likelihoods(spark.createDataFrame(rows, EVIDENCE), model).collect()}
    best = [max(range(3), key=lambda i: (r.likely[i], -i)) for r in read.values()]
    corpus = [(best.count(i) + 1) / (len(best) + 3) for i in range(3)]
    suffix = [(best.count(i) + language.SUFFIX_ROWS * corpus[i]) / (len(best) + language.SUFFIX_ROWS) for i in range(3)]
    own = [max(range(3), key=lambda i: (r.likely[i], -i)) for r in read.values() if r.host == "a.x"]
    host = [(own.count(i) + language.HOST_ROWS * suffix[i]) / (len(own) + language.HOST_ROWS) for i in range(3)]
    total = [x + math.log(p) for x, p in zip(read[99].likely, [*[h * 0.99 for h in host], 0.01])]
    share = [math.exp(t - max(total)) for t in total]
    found = identify(spark, labelled, rows)[99]
    assert found.confidence == pytest.approx(max(share) / sum(share))
    assert found.lang == [*languages, language.UNKNOWN][share.index(max(share))]


def test_odd_rows(spark, labelled, odd_docs):
    found = language.identify(language.document_evidence(odd_docs), labelled).collect()
    assert len(found) == odd_docs.count()
    by_id = {r.id: r for r in found}
    assert all(by_id[i].lang == language.UNKNOWN and not by_id[i].accepted and by_id[i].confidence == 1 for i in (3, 4, 5))
    assert by_id[1].lang == "en"
    assert language.identify(language.document_evidence(odd_docs.limit(0)), labelled).collect() == []
    untrained = language.identify(language.document_evidence(odd_docs), labelled.limit(0)).collect()
    assert {r.lang for r in untrained} == {language.UNKNOWN}


def test_pages(spark):
    html = '<!DOCTYPE html><HTML class="a" lang="DE-at"><head><style>p{x}</style><script>var t="</p>";f("le la")</script></head><p>der <b>Haus</b><!-- the --></p>'
    pages = spark.createDataFrame([(1, "https://www.x.de:80/a?b", html), (2, None, None), (3, "nothing", "<html><p>a"), (4, "http://10.0.0.7:8080/", ""), (5, "http://[::1]/", ""), (6, "http://x./", "")], "page_id long, url string, html string")
    found = {r.id: r for r in language.page_evidence(pages).collect()}
    assert (found[1].declared, found[1].host, found[1].suffix) == ("de", "www.x.de:80", "de")
    assert found[1].text.split() == ["der", "Haus"]
    assert (found[2].text, found[2].declared, found[2].host, found[2].suffix) == (None, None, None, None)
    assert found[3].text.split() == ["a"]
    assert [(found[i].host, found[i].suffix) for i in (4, 5, 6)] == [("10.0.0.7:8080", None), ("[::1]", None), ("x.", None)]


def test_labels_count_by_their_language(spark):
    rnd = random.Random(6)
    rows = [("pt-BR", texts(rnd, "fr", 20)), ("PT", texts(rnd, "fr", 20)), (" pt_PT", texts(rnd, "fr", 20))] + [("EN", texts(rnd, "en", 20))] * 3
    rows += [("english", "x"), ("x-1", "y"), (None, "z"), ("und", "noise"), ("english", "w")]
    labelled = spark.createDataFrame(rows, "lang string, text string")
    assert language.train(labelled)[0] == ["en", "pt"]
    found = identify(spark, labelled, [(1, texts(rnd, "fr", 20), None, None, None), (2, texts(rnd, "en", 20), None, None, None)])
    assert (found[1].lang, found[2].lang) == ("pt", "en")
    assert {(r.lang, r.n) for r in language.unlabelled(labelled).collect()} == {("english", 2), ("x-1", 1), (None, 1)}


def trigram_buckets(text):
    """Hashed trigrams of a text's bytes, A-Z lowered, that hold a letter."""
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    letter = lambda b: b >= 128 or 97 <= b <= 122
    triples = [data[i : i + 3] for i in range(len(data) - 2) if any(map(letter, data[i : i + 3]))]
    return [((t[0] << 16 | t[1] << 8 | t[2]) * 2654435761 % 2**32) >> 16 for t in triples]


def brute(rows, labelled):
    """(lang, confidence) of rows (id, text, declared, host, suffix), all tables made with dictionaries."""
    counts = defaultdict(Counter)
    for lang, text in labelled:
        code = re.match(r"([a-z]{2,3})(?:[-_].*)?$", (lang or "").strip().lower())
        if code and code[1] != language.UNKNOWN:
            counts[code[1]].update(trigram_buckets(text))
    languages = sorted(counts)
    totals = {c: sum(counts[c].values()) + language.SMOOTHING * language.BUCKETS for c in languages}
    likely, best = {}, {}
    for i, text, *_ in rows:
        grams = trigram_buckets(text)
        temper = min(len(grams), language.EVIDENCE) / max(len(grams), 1)
        of = [temper * sum(math.log((counts[c][b] + language.SMOOTHING) / totals[c]) for b in grams) for c in languages]
        likely[i] = [*of, -temper * len(grams) * math.log(language.BUCKETS)] if grams else None
        best[i] = max(range(len(languages)), key=lambda k: (of[k], -k)) if grams else None
    known = [r for r in rows if best[r[0]] is not None]
    n = len(languages)
    corpus = [(sum(best[r[0]] == k for r in known) + 1) / (len(known) + n) for k in range(n)]

    def shares(place, value, above, weight):
        own = [best[r[0]] for r in known if r[place] == value]
        return [(own.count(k) + weight * above[k]) / (len(own) + weight) for k in range(n)]

    suffix = {s: shares(4, s, corpus, language.SUFFIX_ROWS) for s in {r[4] for r in known} - {None}}
    host_suffix = {h: min((r[4] for r in known if r[3] == h and r[4] is not None), default=None) for h in {r[3] for r in known} - {None}}
    host = {h: shares(3, h, suffix.get(s, corpus), language.HOST_ROWS) for h, s in host_suffix.items()}
    said = [r for r in known if r[2] is not None]
    odds = {}
    for d in {r[2] for r in said}:
        share = sum(r[2] == d for r in said) / len(said)
        of = [sum(best[r[0]] == k for r in said) for k in range(n)]
        both = [sum(best[r[0]] == k and r[2] == d for r in said) for k in range(n)]
        odds[d] = [math.log((both[k] + language.DECLARED_ROWS * share) / (of[k] + language.DECLARED_ROWS)) for k in range(n)] + [math.log(share)]
    out = {}
    for i, _, declared, h, s in rows:
        if likely[i] is None:
            out[i] = (language.UNKNOWN, 1.0)
            continue
        prior = host.get(h) or suffix.get(s) or corpus
        prior = [math.log(p * (1 - language.UNKNOWN_PRIOR)) for p in prior] + [math.log(language.UNKNOWN_PRIOR)]
        total = [a + b + c for a, b, c in zip(likely[i], prior, odds.get(declared, [0.0] * (n + 1)))]
        top = max(total)
        out[i] = ([*languages, language.UNKNOWN][total.index(top)], 1 / sum(math.exp(t - top) for t in total))
    return out


@pytest.mark.parametrize("table", ["documents", "pages"])
def test_given_tables_against_dictionaries(spark, table):
    """Likelihoods, odds of declarations, priors and posteriors of whole tables."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    if table == "documents":
        evidence = language.document_evidence(docs)
    else:
        evidence = language.page_evidence(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    rows = [tuple(r) for r in evidence.select("id", "text", "declared", "host", "suffix").collect()]
    expected = brute(rows, [(r.lang, r.text) for r in docs.collect()])
    found = language.identify(evidence, docs.select("lang", "text")).collect()
    assert len(found) == len(rows) > 20
    for r in found:
        lang, confidence = expected[r.id]
        assert r.lang == lang and r.confidence == pytest.approx(confidence, abs=1e-4), r.id
        assert r.accepted == (lang != language.UNKNOWN and r.confidence >= language.MIN_CONFIDENCE)


def test_fusion_decides_where_the_text_alone_does_not(spark, labelled):
    """Short texts held out of training: the declaration and the address raise the share that is right."""
    rnd = random.Random(12)
    rows, truth = [], {}
    for i in range(300):
        lang = rnd.choice(list(WORDS))
        long = i % 4 != 0
        text = texts(rnd, lang, 25) if long else rnd.choice(["abc", "bcd", "xyz"])
        declared = lang if rnd.random() < 0.8 else rnd.choice(list(WORDS))
        rows.append((i, text, declared, f"h{i % 3}.{lang}", lang))
        truth[i] = lang, long
    bare = {i: r.lang for i, r in identify(spark, labelled, [(i, t, None, None, None) for i, t, *_ in rows]).items()}
    full = {i: r.lang for i, r in identify(spark, labelled, rows).items()}
    short = [i for i, (_, long) in truth.items() if not long]
    right = lambda found: sum(found[i] == truth[i][0] for i in short) / len(short)
    assert right(full) > right(bare) + 0.2, (right(bare), right(full))
