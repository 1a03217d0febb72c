"""Texts of very many words and words of very many characters, among short ones."""

import pytest

from flowgauge.llm import quality_rules, simhash, substrings, toxicity
from tests.llm import brute

LONG = " ".join(f"w{k * 7919 % 50_021}" + "." * (k % 17 == 0) for k in range(300_000))
ROWS = [(1, LONG), (2, LONG + " more"), (3, "short text here. " * 5), (4, "x" * 2_000_000), (5, None)]


@pytest.fixture(scope="module")
def long_docs(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)


def test_fingerprints(long_docs):
    found = {r.doc_id: r for r in simhash.near_duplicates(long_docs).collect()}
    assert {k: found[k].fingerprint for k, _ in ROWS} == {k: f"{brute.fingerprint(t):016x}" for k, t in ROWS}
    assert found[2].component_id == 1


def test_passages(long_docs):
    found = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.remove_repeated(long_docs).collect()}
    # All but the last word of the second text stand in the first as well.
    assert found == {1: (300_000, 300_000), 2: (300_001, 300_000), 3: (15, 0), 4: (1, 0), 5: (0, 0)}


def test_rules(spark, long_docs):
    found = quality_rules.judge(long_docs, spark.createDataFrame([(3,)], "doc_id bigint")).collect()
    names = brute.base_rules("").keys()
    assert {r.doc_id: {k: r[k] for k in names} for r in found} == {k: brute.base_rules(t) for k, t in ROWS}


def test_toxicity(spark, long_docs):
    labels = spark.createDataFrame([(k, int(k < 3)) for k, _ in ROWS], "doc_id bigint, toxic int")
    found = {r.doc_id: r for r in toxicity.score(long_docs, toxicity.fit(long_docs, labels)).collect()}
    assert all(0 <= r.score <= 1 for r in found.values()) and len(found) == 5
    assert min(found[1].score, found[2].score) > max(found[k].score for k in (3, 4, 5))
