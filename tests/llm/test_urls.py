import re

from tarmac.llm import urls


def run(spark, rows, **options):
    frame = spark.createDataFrame([(i, u, lab, "h", "p") for i, u, lab in rows], "page_id long, url string, label string, host string, path string")
    return sorted((tuple(r) for r in urls.filter_urls(frame, **options).collect()), key=str)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def test_hosts_paths_and_rules(spark):
    cases = [
        None, "", "no scheme", "http://", "://x.com/", "http://A.Example.COM/en/1?x#y", "http://www.example.com/en/2", "http://a.www.example.com/en/",
        "http://example.com/en", "http://example.com", "http://xexample.com/en/1", "http://b.net/es/1", "http://net/fr/", "http://b.net/de/1", "http://b.org/es/",
        "http://x.com?u=http://y.net/es/", "http://b.net/es", "ftp://b.net/fr/#a", "http://é.com/Ü", "http://x.com:80/",
    ]
    found = {r[0]: r for r in run(spark, [(i, u, None) for i, u in enumerate(cases)])}
    for i, url in enumerate(cases):
        host, path = split(url)
        fits = [r for r in urls.RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.host + r.path), default=None)
        assert found[i][1:4] == (host, path, rule and rule.host + rule.path), url
        if rule:
            assert found[i][4] == rule.verdict, url


def test_templates(spark):
    rows = [(i, f"http://h.org/shop/{name}/view/{i}", None) for i, name in enumerate(f"item-{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))]
    rows += [(100 + i, f"http://h.org/help/{name}", None) for i, name in enumerate(["faq", "terms"] * 10)]
    rows += [(200, "http://h.org/" + "/".join("abcdefghijkl"), None), (201, "http://h.org//a//", None), (202, None, None), (202, None, None)]
    found = {r[0]: r[5] for r in run(spark, rows)}
    assert {found[i] for i in range(60)} == {"/shop/*/view/*"}
    assert found[100] == "/help/faq" and found[200] == "/a/b/c/d/e/f/g/h/i/j/k/l" and found[201] == "/a" and found[202] == "/"


def test_labelled_purity_rejects(spark):
    rows = [(i, f"http://h.org/ads/x/{i}", "block" if i % 10 else "allow") for i in range(40)]
    rows += [(100 + i, f"http://h.org/news/x/{i}", "allow" if i % 10 else "block") for i in range(40)]
    rows += [(200, "http://h.org/ads/x/999", None), (201, "http://h.org/news/x/999", None), (202, "http://h.org/other/x", None), (203, "http://k.org/ads/x/1", None)]
    found = {r[0]: r for r in run(spark, rows, rules=(), label_column="label")}
    assert [found[i][4] for i in (200, 201, 202, 203)] == ["block", "allow", "allow", "allow"]
    place = (36 + 4 * 0.5) / (40 + 4)  # corpus and host are blocked by halves
    assert abs(found[200][6] - (36 + 4 * place) / (40 + 4)) < 1e-9 and found[202][6] == 0.5


def purities(spark, counts):
    """Purity by path of branches of one place, given as path: (blocked, allowed); and the place's rate."""
    rows = [(f"http://h.org/{c}", label) for c, (block, allow) in counts.items() for label in ["block"] * block + ["allow"] * allow]
    found = run(spark, [(i, *r) for i, r in enumerate(rows)], rules=(), label_column="label")
    n, blocked = len(rows), sum(b for b, _ in counts.values())
    corpus = (blocked + 2) / (n + 4)
    host = (blocked + 4 * corpus) / (n + 4)
    return {r[2][1:]: r[6] for r in found}, (blocked + 4 * host) / (n + 4)


def test_similar_branches_share_their_labels(spark):
    purity, place = purities(spark, {"a": (3, 0), "b": (3, 0), "c": (3, 0), "d": (0, 30)})
    assert purity["a"] == purity["b"] == purity["c"] and abs(purity["a"] - (9 + 4 * place) / (9 + 4)) < 1e-9
    assert abs(purity["d"] - 4 * place / 34) < 1e-9


def test_branches_alike_by_way_of_others_do_not_chain(spark):
    purity, place = purities(spark, {"a": (10, 90), "b": (40, 60), "c": (70, 30), "d": (100, 0)})
    assert {c: round(p, 9) for c, p in purity.items()} == {c: round((n + 4 * place) / 104, 9) for c, n in (("a", 10), ("b", 40), ("c", 70), ("d", 100))}
    few, _ = purities(spark, {"a": (1, 9), "b": (10, 0), "c": (2, 8)})
    assert few["a"] == few["c"] < 0.5 < few["b"]


def test_pages_without_labels_are_judged_by_their_surroundings(spark):
    rows = [(i, f"http://bad.org/x/{c}", "block") for i, c in enumerate("abcdefgh" * 3)] + [(100 + i, f"http://good.org/x/{c}", "allow") for i, c in enumerate("abcdefgh" * 3)]
    rows += [(200, "http://bad.org/x/z", None), (201, "http://bad.org/other", None), (202, "http://good.org/x/z", None), (203, "http://new.org/", None), (204, None, None)]
    found = {r[0]: r for r in run(spark, rows, rules=(), label_column="label")}
    corpus = (24 + 2) / (48 + 4)
    host = (24 + 4 * corpus) / (24 + 4)
    assert abs(found[200][6] - (24 + 4 * host) / (24 + 4)) < 1e-9 and abs(found[201][6] - host) < 1e-9
    assert [found[i][4] for i in (200, 201, 202, 203, 204)] == ["block", "block", "allow", "allow", "allow"]
    assert found[203][6] == found[204][6] == corpus


def test_deep_paths_are_told_apart(spark):
    deep = "/".join("abcdefghijklmnop")
    rows = [(i, f"http://h.org/{deep}/ads/{i}", "block") for i in range(30)] + [(100 + i, f"http://h.org/{deep}/news/{i}", "allow") for i in range(30)]
    rows += [(200 + i, f"http://k.org/{deep}/{'x' * (i + 1)}/end", None) for i in range(40)] + [(300, "http://h.org/" + "/".join(["s"] * 3000), None)]
    found = {r[0]: r for r in run(spark, rows, rules=(), label_column="label")}
    assert found[0][5] == f"/{deep}/ads/*" and found[100][5] == f"/{deep}/news/*"
    assert found[0][6] > 0.9 and found[100][6] < 0.1
    assert found[200][5] == f"/{deep}/*/end"
    assert len(found[300][5]) == 6000


def test_empty(spark):
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []
