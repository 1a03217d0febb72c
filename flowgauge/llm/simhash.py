"""SimHash near-duplicates: fingerprints of word shingles, compared exactly tile by tile."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import row_key, stored
from flowgauge.llm.components import component_labels

HALF = (1 << 32) - 1


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text, A-Z lower-cased: a bit is set if over half of the shingles' XXH64 have it."""
    hashes = shingle_hashes(text, shingle, seed)
    return majority(hashes) if len(hashes) else 0


def shingle_hashes(text: str | None, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of each word shingle of a text, A-Z lower-cased; a text with fewer words than a shingle is one shingle."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.array([], dtype="<u8")
    whole = memoryview(b" ".join(parts))
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(parts))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(parts) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.array([digest(whole[a:b], seed) for a, b in spans], dtype="<u8")


def majority(hashes: np.ndarray, block: int = 1 << 16) -> int:
    """Bits set in over half of the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), block):
        part = np.ascontiguousarray(hashes[k : k + block]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``id``, the row's key ``k1``, ``k2`` and ``fp``, the fingerprint as a signed long, one row per document."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch["text"]], dtype=np.uint64).view(np.int64)
            yield batch[["id", "k1", "k2"]].assign(fp=fps)

    kind = docs.schema[id].dataType.simpleString()
    k1, k2 = row_key(docs[id], docs[text])
    # Ids travel as text: pandas would turn whole numbers with nulls into floating-point ones.
    rows = docs.select(docs[id].cast("string").alias("id"), docs[text].alias("text"), k1.alias("k1"), k2.alias("k2"))
    made = rows.mapInPandas(of, "id string, k1 bigint, k2 int, fp bigint")
    return made.withColumn("id", F.col("id").cast(kind))


def tile_edges(a: np.ndarray, b: np.ndarray, radius: int, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles as stars: every linked fingerprint with the smallest of its component in these tiles.

    All pairs are compared, in blocks of rows; pairs that are already connected are not kept, so a clique of m
    fingerprints yields m - 1 edges.
    """
    values = np.unique(np.concatenate([a, b]))
    ia, ib = np.searchsorted(values, a), np.searchsorted(values, b)
    label = np.arange(len(values))
    rows = max(1, block // max(1, len(b)))
    ua, ub = a.view(np.uint64), b.view(np.uint64)
    for k in range(0, len(a), rows):
        near = np.bitwise_count(ua[k : k + rows, None] ^ ub[None, :]) <= radius
        i, j = np.nonzero(near)
        label = _merge(label, ia[k + i], ib[j])
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


def _merge(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels after joining x[k] with y[k] for all k; a label is the smallest index of its component."""
    while True:
        lx, ly = label[x], label[y]
        open_ = lx != ly
        if not open_.any():
            return label
        x, y, lx, ly = x[open_], y[open_], lx[open_], ly[open_]
        np.minimum.at(label, np.maximum(lx, ly), np.minimum(lx, ly))
        while not np.array_equal(jumped := label[label], label):
            label = jumped


def links(distinct: DataFrame, radius: int = 3, tile: int = 4096) -> DataFrame:
    """Edges (a, b) that connect the fingerprints ``fp`` of ``distinct`` within ``radius`` bits of each other.

    Tiles hold fingerprints with the same population counts of both 32-bit halves. Two fingerprints differ in at least
    as many bits as the counts of their halves do, so only tiles whose counts are within ``radius`` meet; the others
    are skipped without being built. A tile has about ``tile`` fingerprints at most: fuller cells are split by hash.
    """
    spark = distinct.sparkSession
    high = F.bit_count(F.shiftrightunsigned("fp", 32))
    low = F.bit_count(F.col("fp").bitwiseAND(F.lit(HALF)))
    cells = distinct.select("fp", (high * 64 + low).alias("cell"))
    # At most 33 x 33 cells, however many fingerprints there are.
    sizes = {r["cell"]: ceil(r["n"] / tile) for r in cells.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    pairs = [
        (x, y, sizes[x], sizes[y])
        for x in sizes for y in sizes
        if x <= y and abs(x // 64 - y // 64) + abs(x % 64 - y % 64) <= radius
    ]
    if not pairs:
        return spark.createDataFrame([], "a bigint, b bigint")
    splits = spark.createDataFrame(list(sizes.items()), "cell int, k int")
    tiles = stored(
        cells.join(F.broadcast(splits), "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("k")).cast("int").alias("part"))
        .agg(F.collect_list("fp").alias("fps"))
    )
    plan = F.broadcast(spark.createDataFrame(pairs, "ca int, cb int, ka int, kb int"))
    same = (F.col("ca") == F.col("cb"))
    left = (
        tiles.join(plan, tiles["cell"] == plan["ca"])
        .withColumn("pb", F.explode(F.sequence(F.lit(0), F.col("kb") - 1)))
        .filter(~same | (F.col("part") <= F.col("pb")))
        .select("ca", "cb", F.col("part").alias("pa"), "pb", F.col("fps").alias("x"))
    )
    right = (
        tiles.join(plan, tiles["cell"] == plan["cb"])
        .withColumn("pa", F.explode(F.sequence(F.lit(0), F.col("ka") - 1)))
        .filter(~same | (F.col("pa") <= F.col("part")))
        .select("ca", "cb", "pa", F.col("part").alias("pb"), F.col("fps").alias("y"))
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for x, y in zip(batch["x"], batch["y"]):
                a, b = tile_edges(np.asarray(x, dtype=np.int64), np.asarray(y, dtype=np.int64), radius)
                yield pd.DataFrame({"a": a, "b": b})

    joined = left.hint("shuffle_hash").join(right, ["ca", "cb", "pa", "pb"]).select("x", "y")
    return joined.mapInPandas(compare, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, tile: int = 4096
) -> DataFrame:
    """The documents of ``docs`` with ``fingerprint`` (16 hex digits) and ``component_id``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is the smallest id that
    can be reached over links, the document's own included. Equal fingerprints are one node, so copies never meet each
    other in pairs.

    A text that is null or has no word has fingerprint 0 and is linked like any other. A text with fewer words than a
    shingle is one shingle. Rows that share an id are separate documents with a common id. A null id takes part in
    links, but is never the smallest; a component with no other id has a null ``component_id``. Only ``id`` and ``text``
    are read, so other columns may have any name; columns named like the results are replaced.
    """
    return _grouped(docs, id, text, shingle, radius, tile).select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, tile: int = 4096
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component of ``near_duplicates`` one row stays.

    It is the row with the smallest id, a null id last; among rows that share it, the one with the smallest hash of its
    content. Of rows that are equal in id and text, one stays.
    """
    return one_of_each(docs, _grouped(docs, id, text, shingle, radius, tile), id, text)


def one_of_each(docs: DataFrame, groups: DataFrame, id: str, text: str) -> DataFrame:
    """The rows of ``docs`` that are the ``first`` of their component in ``groups``, equal ones once."""
    k1, k2 = row_key(docs[id], docs[text])
    stay = groups.filter("first.k1 = k1 AND first.k2 = k2").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
    rows = docs.select("*", k1.alias("_d1"), k2.alias("_d2"))
    kept = rows.join(stay.distinct(), (F.col("_d1") == F.col("_k1")) & (F.col("_d2") == F.col("_k2")), "left_semi")
    return kept.dropDuplicates(["_d1", "_d2"]).drop("_d1", "_d2")


def _grouped(docs: DataFrame, id: str, text: str, shingle: int, radius: int, tile: int) -> DataFrame:
    """Per row its id, key and fingerprint, and ``first``, the first row of its component."""
    kept = stored(fingerprints(docs, id, text, shingle))
    return first_of_each(kept, links(kept.select("fp").distinct(), radius, tile))


def first_of_each(kept: DataFrame, edges: DataFrame) -> DataFrame:
    """``kept`` with ``first``, the first row of the component of its ``fp`` under ``edges``."""
    row = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")
    distinct = kept.groupBy("fp").agg(F.min(row).alias("first"))
    labels = component_labels(edges)
    # Linked fingerprints only: the first row of each component.
    linked = labels.join(distinct.select(F.col("fp").alias("node"), "first"), "node")
    roots = linked.groupBy("label").agg(F.min("first").alias("root"))
    known = linked.join(roots, "label").select(F.col("node"), "root")
    # Written first, so that the join below only exchanges rows and a fingerprint of very many copies can be split.
    of_fp = stored(distinct.join(known, distinct["fp"] == known["node"], "left").select(
        distinct["fp"].alias("of"), F.coalesce("root", "first").alias("first")
    ))
    return kept.join(of_fp, F.col("fp") == F.col("of"), "left").drop("of")
