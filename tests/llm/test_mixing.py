import random
from collections import Counter, defaultdict

import pytest

from flowgauge.llm.mixing import balance, capped_targets, mix
from tests.llm import brute


def test_targets_by_water_filling():
    assert capped_targets({"a": 10, "b": 10, "c": 10}, {"a": 5, "b": 2, "c": 1}) == pytest.approx({"a": 18.75, "b": 7.5, "c": 3.75})
    assert capped_targets({"a": 1, "b": 20, "c": 30}, {"a": 5, "b": 2, "c": 1}) == pytest.approx({"a": 3, "b": 32, "c": 16})
    assert capped_targets({"a": 0, "b": 4}, {"a": 5, "b": 2}) == pytest.approx({"a": 0, "b": 4})
    assert capped_targets({}, {}) == {}


def test_newton_finds_the_tilt(spark):
    rows = spark.createDataFrame([("a", 10), ("a", 30), ("b", 50), (None, 8), ("z", 0)], "source string, size bigint")
    found = balance(rows, "source", "size", {"a": 120.0, "b": 5.0, None: 8.0, "z": 0.0})
    assert {s: round(2.718281828459045**v, 6) for s, v in found.items()} == {"a": 3.0, "b": 0.1, None: 1.0}


def assert_mixed(rows, docs, slack):
    found = mix(docs).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in found) == sorted((r[0] or 0, r[1] or "") for r in rows)
    taken, targets, largest = defaultdict(int), {}, defaultdict(int)
    for r in found:
        n = len(brute.words(r.text))
        assert int(r["size"]) == n and 0 <= r.copies <= 3
        taken[r.source] += r.copies * n
        targets[r.source] = r.target
        largest[r.source] = max(largest[r.source], n)
    for s in targets:
        assert abs(taken[s] - targets[s]) <= slack * largest[s] + 1
    return found


def test_whole_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert sum(r.copies * int(r["size"]) for r in assert_mixed(rows, documents, 0.5)) == pytest.approx(
        sum(len(brute.words(t)) for _, t in rows), rel=0.05)


def test_hot_source_and_null_source(spark, docs_of):
    rng = random.Random(0)
    rows = [(k, "w " * rng.randrange(60), rng.choice(["a", "a", "a", "b", "é", "Z", None])) for k in range(600)]
    assert_mixed(rows, docs_of(*rows), 0.5)


@pytest.mark.parametrize("seed", range(3))
def test_a_third_of_repeated_rows_meets_its_target(spark, docs_of, seed):
    # Rate 1.25 for a; one repeated row holds a third of it. Rows of None are all equal, so one more is one of them.
    rows = [(k, "w " * (80 + k % 40), "a") for k in range(400)] + [(1000 + seed, "v " * 100, "a")] * 200
    rows += [(2000 + k, "w " * 100, "b") for k in range(400)] + [(None, "u " * 130, None)] * 200
    found = mix(docs_of(*rows), seed=seed).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in found) == Counter(rows)
    for source in ("a", "b", None):
        mine = [r for r in found if r.source == source]
        assert abs(sum(r.copies * int(r["size"]) for r in mine) - mine[0].target) <= 66
        assert {r.rate.__floor__() for r in mine} | {r.rate.__floor__() + 1 for r in mine} >= {r.copies for r in mine}


def test_reruns_agree(spark, documents):
    once, again = (sorted((r.doc_id, r.copies) for r in mix(d).collect()) for d in (documents, documents.repartition(5)))
    assert once == again


def test_odd_rows_and_empty_table(spark, docs_of, odd):
    assert_mixed(odd, docs_of(*odd), 3)
    assert mix(docs_of((1, "a")).filter("false")).count() == 0
