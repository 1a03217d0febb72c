"""Hashed n-gram models of a trusted target and of the raw corpus, and texts scored by their ratio."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import let, stored, words


def _word(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def _pair(word: Column, following: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word, following), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class RatioModel:
    """``weights``: for each bucket the logarithm of its share in the target over its share in the raw corpus."""

    weights: tuple[float, ...]

    def score(self, ws: Column) -> Column:
        """Sum of the weights of all words and pairs of neighbours in ``ws``, an array of words."""
        # A constant array, folded once, however many rows are scored.
        table = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        buckets = len(self.weights)

        def each(ws: Column) -> Column:
            return F.transform(ws, lambda w, i: F.get(table, _word(w, buckets)) + F.when(
                i + 1 < F.size(ws), F.get(table, _pair(w, F.get(ws, i + 1), buckets))
            ).otherwise(F.lit(0.0)))

        return F.aggregate(let(ws, each), F.lit(0.0), lambda total, x: total + x)


def features(ws: Column) -> Column:
    """How many n-grams ``score`` adds up."""
    return F.greatest(2 * F.size(ws) - 1, F.lit(0))


def fit(
    docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", buckets: int = 1 << 14,
    smoothing: float = 20.0,
) -> RatioModel:
    """Count the n-grams of all of ``docs``, and of those whose id is in ``target`` (one column named ``id``).

    Both multinomials are over ``buckets`` hashed words and word pairs. The raw counts are scaled to the size of the
    target, then ``smoothing`` is added to each bucket of either, so a bucket that is rare in the target by chance weighs
    little. Counts are summed before the shuffle; the model, ``buckets`` numbers, is what reaches the driver. Without a
    target all weights are 0.
    """
    trusted = target.select(F.col(id).alias("_id")).distinct()
    # Texts are exchanged as they are; arrays of their words would take up twice the room.
    # The ids grow with the corpus, so they are merged in, at every size alike, and never broadcast.
    joined = docs.select(docs[id].alias("_doc"), docs[text].alias("_text")).join(
        trusted.hint("merge"), F.col("_doc") == F.col("_id"), "left"
    )
    marked = joined.select(F.col("_id").isNotNull().alias("trusted"), words(F.col("_text")).alias("ws"))
    following = F.slice("ws", F.lit(2), F.size("ws"))
    each = marked.select("trusted", F.inline(F.arrays_zip(F.col("ws").alias("w"), following.alias("v"))))
    each = each.toDF("trusted", "w", "v").select("trusted", F.explode(F.array(
        _word(F.col("w"), buckets), F.when(F.col("v").isNotNull(), _pair(F.col("w"), F.col("v"), buckets))
    )).alias("bucket"))
    counted = stored(each.filter("bucket IS NOT NULL").groupBy("bucket").agg(
        F.count("*").alias("raw"), F.count_if("trusted").alias("target")
    ))
    sums = counted.agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets")).first()
    if not sums["targets"]:
        return RatioModel((0.0,) * buckets)
    expected = F.col("raw") * (sums["targets"] / sums["raws"])
    weight = F.log(F.col("target") + smoothing) - F.log(expected + smoothing)
    found = dict(counted.select("bucket", F.round(weight, 6)).collect())
    return RatioModel(tuple(found.get(k, 0.0) for k in range(buckets)))
