"""A set of keys as a few hashed bits, for scans to leave out the rows of other keys.

The sketch is a Bloom filter: it passes every row of a key in the set, and few others. It
stands in front of an exact join, so it never decides a result, only how much reaches the
join. Its size is bounded however many keys there are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key, rounded up to a power of two, and hashes per key: about one foreign key in 400 passes.
BITS_PER_KEY = 16
HASHES = 4
#: The largest sketch has so many bits, 128 KB. With more keys than these, it would pass over 2 % of the foreign ones.
MOST_BITS = 1 << 20
MOST_KEYS = MOST_BITS // 9


@dataclass(frozen=True)
class KeySketch:
    """``words``: 64 bits each."""

    words: tuple[int, ...]

    def may_hold(self, key: Column) -> Column:
        """False for a null key and for nearly all keys that are not in the set."""
        # A constant array, folded once.
        table = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        passed = key.isNotNull()
        for seed in range(HASHES):
            place = _place(key, seed, 64 * len(self.words))
            word = F.get(table, F.shiftright(place, 6).cast("int"))
            passed = passed & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return passed


def key_sketch(rows: DataFrame, key: str, keys: int) -> KeySketch | None:
    """The sketch of the values of ``key``, of which there are about ``keys`` different ones; none for too many.

    One aggregate with partial sums; what reaches the driver is the sketch, ``MOST_BITS`` at most. Nulls take no part.
    """
    if keys > MOST_KEYS:
        return None
    bits = min(MOST_BITS, 1 << max(6, (BITS_PER_KEY * keys - 1).bit_length()))
    places = F.explode(F.array(*(_place(F.col(key), seed, bits) for seed in range(HASHES))))
    found = rows.filter(F.col(key).isNotNull()).select(places.alias("place")).groupBy(
        F.shiftright("place", 6).cast("int").alias("word")
    ).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))))
    words = dict(map(tuple, found.collect()))
    return KeySketch(tuple(words.get(k, 0) for k in range(bits // 64)))


def _place(key: Column, seed: int, bits: int) -> Column:
    return F.xxhash64(F.lit(seed), key.cast("bigint")).bitwiseAND(F.lit(bits - 1).cast("bigint"))
