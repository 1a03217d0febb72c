"""Approximate nearest neighbours by inner product: a proximity graph for each shard of the vectors."""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import stored
from flowgauge.llm.proximity_graph import Graph

_INDEX = "shard int, node int, start int, ids array<bigint>, vector array<double>, edges array<int>"
_FOUND = "query_id bigint, query int, vec_id bigint, score double"


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """``id`` and ``vector`` (array<double>) of the rows that take part."""
    values = F.col("vector")
    whole = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(vectors[id].cast("bigint").alias("id"), vectors[vector].cast("array<double>").alias("vector"))
    return rows.filter(values.isNotNull() & whole & F.exists(values, lambda x: x != 0) & F.col("id").isNotNull())


def build_index(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 20, shard_rows: int = 8192,
    degree: int = 48, beam: int = 100, alpha: float = 1.2,
) -> DataFrame:
    """The index as a table: a row per node with its shard, vector, edges and the smallest ids that have this vector.

    Rows are dealt to shards of about ``shard_rows`` by a hash of their id, so a vector of very many rows is spread, and
    a shard fits a task whatever the size of the table. Within a shard equal vectors are one node; it keeps its ``k + 1``
    smallest ids, as no answer can hold more of them (one may be the query's own). Every row is indexed. Edges are found by
    greedy searches in the growing graph and thinned by robust pruning (see ``proximity_graph``).

    Vectors that are null, all zero, or hold a null or non-finite component take no part, nor do rows without an id and
    vectors of another length than most have. Repeated rows count once. An empty table gives an empty index.
    """
    rows = usable(vectors, id, vector)
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.filter(F.size("vector") == (lengths["d"] if lengths else 0))
    shards = max(1, ceil((lengths["count"] if lengths else 0) / shard_rows))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        ids, x = rows["id"].to_numpy(), np.stack(rows["vector"].to_numpy())
        nodes, inverse = np.unique(x, axis=0, return_inverse=True)
        of: list[list[int]] = [[] for _ in nodes]
        for node, one in zip(inverse.ravel().tolist(), ids.tolist()):
            if len(of[node]) <= k and one not in of[node]:
                of[node].append(one)
        graph = Graph.build(nodes, degree, beam, alpha)
        return pd.DataFrame({
            "shard": rows["shard"].iloc[0], "node": np.arange(len(nodes), dtype=np.int32), "start": graph.start,
            "ids": of, "vector": list(nodes), "edges": list(graph.edges),
        })

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(build, _INDEX)


def search(
    index: DataFrame, queries: DataFrame, k: int = 20, id: str = "vec_id", vector: str = "embedding", beam: int = 120,
    block: int = 4096, recall: float = 0.97, sample: int = 64,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest rows found for each query, its own id left out.

    Each block of queries is searched in every shard, by a beam search in the shard's graph; the nearest nodes found are
    scored again with the original vectors in double precision. How wide a beam has to be depends on the data: ``sample``
    queries of a block are compared with the whole shard first, and ``beam`` is doubled until ``recall`` of their nearest
    are found. Scores descend, ties go to the smaller id. ``queries``
    have the columns of the vectors; those that take no part get no rows, nor do vectors of another length than those of
    the index; equal queries count once.
    """
    length = index.select(F.size("vector").alias("d")).first()
    asked = usable(queries, id, vector).filter(F.size("vector") == (length["d"] if length else -1)).dropDuplicates()
    asked = stored(asked.withColumn("query", F.hash("vector")))
    shards = [r["shard"] for r in index.select("shard").distinct().collect()]
    blocks = max(1, ceil(asked.count() / block))
    each = F.explode(F.array(*map(F.lit, shards)) if shards else F.array().cast("array<int>")).alias("shard")
    dealt = asked.select("*", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), each)
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def find(nodes: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if nodes.empty or rows.empty:
            return pd.DataFrame({"query_id": [], "query": [], "vec_id": [], "score": []})
        nodes, rows = nodes.sort_values("node"), rows.sort_values(["id", "query"])
        x, q = np.stack(nodes["vector"].to_numpy()), np.stack(rows["vector"].to_numpy())
        graph = Graph(x, np.stack(nodes["edges"].to_numpy()).astype(np.int32), int(nodes["start"].iloc[0]))
        ids = nodes["ids"].to_numpy()
        made: list[tuple[int, int, int, float]] = []
        points = q.astype(np.float32)
        tried = np.unique(np.linspace(0, len(q) - 1, min(sample, len(q))).astype(np.int64))
        wide = graph.beam_for(points[tried], k, max(beam, 2 * k), recall)
        some = max(32, 1024 * 120 // wide)
        for at in range(0, len(q), some):
            part = q[at : at + some]
            found, _ = graph.search(points[at : at + some], wide)
            keys = rows.iloc[at : at + some][["id", "query"]].itertuples(index=False)
            for (own, query), vec, near in zip(keys, part, found[:, : 2 * k + 2]):
                near = near[near >= 0]
                score = (x[near] * vec).sum(axis=1)
                best = sorted((-s, i) for n, s in zip(near, score.tolist()) for i in ids[n] if i != own)[:k]
                made += [(own, query, i, -s) for s, i in best]
        return pd.DataFrame(made, columns=["query_id", "query", "vec_id", "score"])

    found = copies.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block")).applyInPandas(find, _FOUND)
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
