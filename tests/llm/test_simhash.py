import random

import numpy as np
import pytest

from flowgauge.llm import simhash
from flowgauge.llm.components import component_labels
from tests.llm import brute


def assert_groups(spark, rows, docs, **options):
    got = sorted((r[0], r[1], r[2]) for r in simhash.near_duplicates(docs, **options).na.fill(-(10**6), ["doc_id"]).collect())
    fps, roots = brute.near_groups([r[1] for r in rows])
    smallest = {}
    for root, row in zip(roots, rows):
        if row[0] is not None:
            smallest[root] = min(smallest.get(root, row[0]), row[0])
    want = sorted((-(10**6) if r[0] is None else r[0], f"{fp:016x}", smallest.get(root)) for r, fp, root in zip(rows, fps, roots))
    assert got == want


def test_whole_table_against_all_pairs(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert_groups(spark, rows, documents)


def test_odd_rows_and_small_tiles(spark, docs_of, odd):
    assert_groups(spark, odd, docs_of(*odd), tile=2)


def test_near_copies_that_only_chain(spark, docs_of):
    rng = random.Random(3)
    text = [rng.choice("abcdefgh") * 3 + str(rng.randrange(90)) for _ in range(400)]
    rows = []
    for k in range(40):
        text[rng.randrange(400)] = f"new{k}"
        rows.append((100 - k, " ".join(text)))
    assert_groups(spark, rows, docs_of(*rows), tile=8)


def test_empty_table(spark, docs_of):
    empty = docs_of((1, "a")).filter("false")
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_one_of_each_group_stays(spark, docs_of, odd):
    rows = [(r.doc_id, r.text) for r in simhash.drop_near_duplicates(docs_of(*odd)).collect()]
    _, roots = brute.near_groups([r[1] for r in odd])
    assert len(rows) == len(set(roots)) and set(rows) <= set(odd)
    assert (-8, "a b c d") in rows and (7, "p q r s") in rows and (7, "other words here") in rows


def test_all_columns_are_passed_on(spark, docs_of):
    assert simhash.drop_near_duplicates(docs_of((1, "a"), (2, "a"))).columns == ["doc_id", "text", "source", "size"]


@pytest.mark.parametrize("seed", range(5))
def test_tile_edges_connect_as_all_pairs_do(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 20)
    values = np.array([int(base[k % 20]) ^ sum(1 << int(b) for b in rng.integers(0, 63, k % 4)) for k in range(200)])
    a, b = values[:120], values[80:]
    x, y = simhash.tile_edges(a, b, 3, block=64)
    every = np.unique(values).tolist()
    at = {v: k for k, v in enumerate(every)}
    pairs = [(at[int(u)], at[int(v)]) for u in a for v in b if (int(u) ^ int(v)).bit_count() <= 3]
    assert brute.components(len(every), pairs) == brute.components(len(every), [(at[int(u)], at[int(v)]) for u, v in zip(x, y)])
    assert len(x) < len(every)


def test_components_of_random_edges(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 480)]
    got = {r.node: r.label for r in component_labels(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = brute.components(500, edges)
    assert got == {x: want[x] for e in edges for x in e if e[0] != e[1]}
