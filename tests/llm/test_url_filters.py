import random
import re

import pytest

from flowgauge.llm import url_filters
from flowgauge.llm.queries import URL_RULES, op2_url_filters
from tests.conftest import DATA
from tests.llm import brute

LABELS = "id bigint, good boolean"


def split(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url[at + 3 :], re.S).groups()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    best = None
    for what, rule in URL_RULES:
        name, slash, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest) and (best is None or len(rule) > len(best[1])):
            best = (what, rule)
    return best or (None, None)


def judged(spark, urls, labels=(), **options):
    pages = spark.createDataFrame([(k, u, "own") for k, u in urls], "page_id bigint, url string, purity string")
    return {r.page_id: r for r in url_filters.judge(pages, spark.createDataFrame(list(labels), LABELS), URL_RULES, **options).collect()}


def test_whole_table(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    found = op2_url_filters(spark, DATA).collect()
    assert len(found) == len(pages)
    for r in found:
        assert (r.host, r.path) == split(pages[r.page_id])
        what, rule = rule_of(r.host, r.path)
        assert r.rule == rule and r.verdict == (what or ("block" if r.purity < 0.5 else "allow"))


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_templates_and_purity_of_the_whole_table(spark, size):
    """The tree built once more outside of Spark; many wildcards and branches with names of their own."""
    folder = DATA.replace("sf0.001", size)
    found = op2_url_filters(spark, folder).collect()
    good = {r.doc_id: r.quality == 1 for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    want = brute.url_templates([(r.page_id, r.host, r.path) for r in found], good)
    assert [r.template for r in found] == [template for template, _ in want]
    assert [r.purity for r in found] == pytest.approx([purity for _, purity in want])
    assert all(r.rule or r.verdict == ("block" if purity < 0.5 else "allow") for r, (_, purity) in zip(found, want))


def test_made_up_trees(spark):
    rng = random.Random(8)
    names = ["news", "blog", "spam", "x1", "ads", "*", "0123456789abcdef-"]
    urls = [(k, f"http://h{k % 3}.net/" + "/".join(rng.choice(names) for _ in range(rng.randrange(5)))) for k in range(1500)]
    labels = {k: rng.random() < (0.1 if "spam" in u else 0.3 if "ads" in u else 0.8) for k, u in urls if k % 3}
    found = judged(spark, urls, labels.items(), depth=3, least_rows=8)
    want = brute.url_templates([(k, *split(u)) for k, u in urls], labels, depth=3, least_rows=8)
    assert {k: found[k].template for k, _ in urls} == {k: w[0] for (k, _), w in zip(urls, want)}
    assert [found[k].purity == pytest.approx(w[1]) for (k, _), w in zip(urls, want)] == [True] * len(urls)
    assert len({w[0] for w in want}) > 10


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "://", "http://", "http://ORG", "https://A.Example.ORG/en/12?x#y", "http://xorg/", "x://h?q/://", "http://a.org",
            "http://a.org/", "ftp://é.com/fr/", "http://h.com/de/x#f", "http://u@h:80/p", "http://a\nb/c\nd?e"] + ["http://h/" + "s/" * 30] * 2
    for k, r in judged(spark, enumerate(urls)).items():
        assert (r.host, r.path) == split(urls[k])
        assert r.rule == rule_of(r.host, r.path)[1] and r.verdict in ("allow", "block")


def test_bad_branch_stands_out_and_similar_ones_merge(spark):
    urls = [(k, f"http://site.net/{'spam' if k % 4 == 0 else ['news', 'blog', 'wiki'][k % 3]}/{k}/page-{k}") for k in range(400)]
    found = judged(spark, urls, [(k, k % 4 != 0) for k in range(0, 400, 2)])
    assert {r.template for r in found.values()} == {"/spam/*/page-*", "/*+/*/page-*"}
    assert all((r.verdict == "block") == (k % 4 == 0) for k, r in found.items())


def test_variable_segments_become_wildcards(spark):
    found = judged(spark, [(k, f"http://site.net/user/{'abcdefghijklmnop'[k % 16]}{'x' * k}/home") for k in range(60)])
    assert {r.template for r in found.values()} == {"/user/*/home"}


def test_smoothing_towards_the_host(spark):
    urls = [(k, f"http://good.net/a/{k}") for k in range(50)] + [(100, "http://good.net/b/x/y")]
    labels = [(k, True) for k in range(50)] + [(100, False)]
    assert judged(spark, urls, labels)[100].verdict == "allow"
    assert judged(spark, urls, labels, strength=0.01, least_rows=1)[100].verdict == "block"


def test_repeated_labels_and_empty_tables(spark):
    assert judged(spark, [(1, "http://h/a"), (1, "http://h/a")], [(1, True), (1, False), (None, True)])[1].purity == pytest.approx(0.0)
    assert judged(spark, [(k, u) for k, u in [(1, "x")] if False] or [(1, None)])[1].verdict == "allow"
    empty = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filters.judge(empty, spark.createDataFrame([], LABELS), URL_RULES).count() == 0
