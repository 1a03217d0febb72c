from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowgauge.llm.histogram import at_least, part_of, splitters
from flowgauge.llm.sharding import histogram_sort


def assert_shards(rows, found, shards, slack):
    assert sorted((r.doc_id or 0, r.text or "\0") for r in found) == sorted((r[0] or 0, r[1] or "\0") for r in rows)
    sizes, slots, of_text = [0] * shards, defaultdict(list), defaultdict(set)
    for r in found:
        assert int(r["size"]) == len((r.text or "").encode()) + 1
        sizes[r.shard] += int(r["size"])
        slots[r.shard].append(r.slot)
        of_text[r.text].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(abs(s - sum(sizes) / shards) for s in sizes) <= slack
    return of_text


def test_whole_table_is_cut_evenly(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = histogram_sort(documents).collect()
    texts = assert_shards(rows, found, 8, max(len((t or "").encode()) for _, t in rows))
    assert sum(len(s) > 1 for s in texts.values()) <= 7


def test_one_text_in_most_rows_is_divided(spark, docs_of):
    rows = [(k, "the same text") for k in range(700)] + [(1000 + k, f"text {k}") for k in range(300)]
    assert_shards(rows, histogram_sort(docs_of(*rows)).collect(), 8, 30)
    assert_shards(rows, histogram_sort(docs_of(*rows), parts_per_shard=2, cell_bytes=200).collect(), 8, 30)


@pytest.mark.parametrize("options", [{}, {"parts_per_shard": 1, "cell_bytes": 300}])
def test_equal_rows_are_divided(spark, docs_of, options):
    rows = [(7, "one row repeated many times over")] * 400 + [(1000 + k, f"text {k}" * (k % 5)) for k in range(800)]
    assert_shards(rows, histogram_sort(docs_of(*rows), **options).collect(), 8, 40)
    assert_shards([(None, None)] * 90, histogram_sort(docs_of(*[(None, None)] * 90)).collect(), 8, 2)


def test_odd_rows(spark, docs_of, odd):
    assert_shards(odd, histogram_sort(docs_of(*odd), shards=3).collect(), 3, 10**4)


def test_empty_table(spark, docs_of):
    assert histogram_sort(docs_of((1, "a")).filter("false")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_splitters_are_the_nearest_boundaries(spark, seed):
    rng = np.random.default_rng(seed)
    a = np.where(rng.random(800) < 0.4, 5.0, rng.integers(0, 50, 800)).astype(float)
    b, w = rng.integers(0, 40, 800).astype(float), rng.integers(1, 9, 800)
    rows = spark.createDataFrame(list(zip(a.tolist(), b.tolist(), w.tolist())), "a double, b double, w bigint")
    targets = [w.sum() * k / 5 for k in range(1, 5)]
    found = splitters(rows, ["a", "b"], "w", targets, 0.0, probes=4)
    edges = [int(w[(a < x) | ((a == x) & (b < y))].sum()) for x, y in set(zip(a, b))] + [int(w.sum())]
    for target, splitter in zip(targets, found):
        below = rows.filter(~at_least(["a", "b"], splitter)).agg(F.sum("w")).first()[0] or 0
        assert abs(below - target) == min(abs(e - target) for e in edges)
    parts = rows.select("a", "b", part_of(["a", "b"], sorted(found)).alias("p")).collect()
    assert all(r.p == sum((r.a, r.b) >= s for s in found) for r in parts)
