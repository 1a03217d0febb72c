import numpy as np
import pytest

from flowgauge.llm import nearest
from flowgauge.llm.proximity_graph import Graph
from flowgauge.llm.queries import op9_nearest
from tests.conftest import DATA

SCHEMA = "vec_id bigint, embedding array<double>, score string"


def truth(ids, x, queries, k):
    out = {}
    for q in queries:
        scores = x @ x[ids.index(q)]
        out[q] = sorted((-s, i) for s, i in zip(scores, ids) if i != q)[:k]
    return out


def assert_near(found, want, recall):
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = 0
    for q, best in want.items():
        rows = got[q]
        assert len(rows) == len(best) and [(-s, i) for i, s in rows] == sorted((-s, i) for i, s in rows)
        assert q not in dict(rows)
        scores = {i: -s for s, i in best}
        assert all(abs(scores[i] - s) < 1e-9 for i, s in rows if i in scores)
        hits += len(scores.keys() & dict(rows).keys())
    assert set(got) == set(want) and hits >= recall * sum(map(len, want.values()))


def test_whole_table_against_brute_force(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows])
    assert_near(op9_nearest(spark, DATA).collect(), truth(ids, x, [i for i in ids if i % 20 == 0], 20), 0.95)


def test_recall_over_several_shards_with_norms_that_differ(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 24)) * rng.uniform(0.3, 2, (3000, 1))
    table = spark.createDataFrame([(k, v, "own") for k, v in enumerate(x.tolist())], SCHEMA)
    index = nearest.build_index(table, shard_rows=800, degree=24, beam=60).cache()
    assert index.select("shard").distinct().count() == 4
    found = nearest.search(index, table.filter("vec_id % 30 = 0"), k=10, block=20).collect()
    assert_near(found, truth(list(range(3000)), x, range(0, 3000, 30), 10), 0.9)


def recall_of(spark, x, k=20):
    n = len(x)
    rows = spark.createDataFrame([(i, v, "own") for i, v in enumerate(x.tolist())], SCHEMA).repartition(4)
    found = nearest.search(nearest.build_index(rows).cache(), rows.filter("vec_id % 20 = 0")).collect()
    want = truth(list(range(n)), x, range(0, n, 20), k)
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == set(want) and all(len(v) == k for v in got.values())
    return sum(len(got[q] & {i for _, i in best}) for q, best in want.items()) / (k * len(want))


@pytest.mark.parametrize("kind", ["own", "uniform", "lognormal", "gaussian"])
def test_recall_at_the_registered_settings(spark, kind):
    """Vectors of the table; the same with other lengths; vectors without any structure, the hardest to search."""
    rng = np.random.default_rng(4)
    own = np.array([r.embedding for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()])
    x = {
        "own": own, "uniform": own * rng.uniform(0.3, 2, (len(own), 1)), "lognormal": own * rng.lognormal(0, 0.5, (len(own), 1)),
        "gaussian": rng.normal(size=(8192, 64)),
    }[kind]
    assert recall_of(spark, x) >= 0.95


def test_copies_tie_by_id(spark):
    x = [[1.0, 0.0]] * 300 + [[0.0, 1.0]] * 5
    table = spark.createDataFrame([(k, v, "own") for k, v in enumerate(x)], SCHEMA)
    found = nearest.search(nearest.build_index(table, shard_rows=100), table.filter("vec_id % 100 = 0")).collect()
    assert_near(found, truth(list(range(305)), np.array(x), [0, 100, 200, 300], 20), 1.0)


def test_rows_that_take_no_part(spark):
    rows = [(1, [1.0, 2.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, []),
            (None, [1.0, 1.0]), (8, [2.0, 1.0]), (9, [1.0, 2.0, 3.0]), (1, [1.0, 2.0]), (10, [-1.0, 0.5])]
    table = spark.createDataFrame([(*r, "own") for r in rows], SCHEMA)
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest.search(nearest.build_index(table), table).collect())
    assert found == [(1, 1, 8, 4.0), (1, 2, 10, 0.0), (8, 1, 1, 4.0), (8, 2, 10, -1.5), (10, 1, 1, 0.0), (10, 2, 8, -1.5)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest.search(nearest.build_index(empty), empty).count() == 0


def test_pruned_edges_are_diverse():
    line = np.array([[0.0], [1.0], [1.1], [1.2], [-1.0]])
    graph = Graph.build(np.hstack([line, np.full((5, 1), 3.0)]), degree=4, beam=5, alpha=1.0)
    assert all((row >= 0).any() for row in graph.edges)
    found, _ = graph.search(graph.x, 5)
    assert all(set(row) == set(range(5)) for row in found)
