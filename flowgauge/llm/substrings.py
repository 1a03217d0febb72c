"""Removal of repeated passages: windows of words that start more than once anywhere in the corpus."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import row_key, stored

_LOCATED = "lo bigint, hi int, known boolean, k1 bigint, k2 int, pos int"


def difference_cover(period: int) -> list[int]:
    """The smallest set of residues whose pairwise differences are all residues modulo ``period``.

    For any positions i and j there is then an offset below ``period`` that moves both to residues of the set.
    """
    if not 1 <= period <= 31:
        raise ValueError("the period has to lie between 1 and 31")
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return list(cover)
    raise AssertionError("unreachable: all residues are a cover")


class Words:
    """The words of a text as slices of one byte string."""

    def __init__(self, text: str | None):
        parts = (text or "").encode("utf-8", "surrogatepass").split()
        self.parts = parts
        self.whole = memoryview(b" ".join(parts))
        self.ends = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64) - 1
        self.starts = self.ends - np.array([len(p) for p in parts], dtype=np.int64)

    def __len__(self) -> int:
        return len(self.parts)

    def digests(self, at: np.ndarray, width: int, digest: Callable[[memoryview], bytes]) -> np.ndarray:
        """Hashes of ``width`` words from each position, one column per long."""
        whole = self.whole
        spans = zip(self.starts[at].tolist(), self.ends[at + width - 1].tolist())
        longs = len(digest(b"")) // 8
        return np.frombuffer(b"".join([digest(whole[a:b]) for a, b in spans]), dtype="<i8").reshape(-1, longs)


def _located(batch: pd.DataFrame, at: list[np.ndarray], hashes: list[np.ndarray]) -> pd.DataFrame:
    """Rows of a batch, where each hash is sent once under its own value.

    Its repetitions are known to be repetitions already; they go under a value made from their place, so that a passage
    of very many documents does not meet in one task.
    """
    counts = [len(x) for x in at]
    h = np.concatenate(hashes) if hashes else np.zeros((0, 2), dtype=np.int64)
    pos = np.concatenate(at).astype(np.int32) if at else np.zeros(0, dtype=np.int32)
    k1, k2 = np.repeat(batch["k1"].to_numpy(), counts), np.repeat(batch["k2"].to_numpy(), counts)
    lo = h[:, 0].copy()
    hi = h[:, 1].astype(np.int32) if h.shape[1] > 1 else np.zeros(len(lo), dtype=np.int32)
    order = np.lexsort((hi, lo))
    same = (lo[order][1:] == lo[order][:-1]) & (hi[order][1:] == hi[order][:-1])
    later = np.zeros(len(lo), dtype=bool)
    later[order[1:]] = same
    known = later.copy()
    known[order[:-1]] |= same
    lo[later] = k1[later] ^ (pos[later].astype(np.int64) * np.int64(0x9E3779B97F4A7C1))
    hi[later] = k2[later] if h.shape[1] > 1 else 0
    return pd.DataFrame({"lo": lo, "hi": hi, "known": known, "k1": k1, "k2": k2, "pos": pos})


def _repeated(rows: DataFrame) -> DataFrame:
    """``k1``, ``k2`` and ``at``, all places whose hash occurs again. A text has no more of them than words."""
    times = F.count("*").over(Window.partitionBy("lo", "hi"))
    found = rows.withColumn("times", times).filter("known OR times > 1")
    return found.groupBy("k1", "k2").agg(F.collect_set("pos").alias("at"))


def repeated_windows(docs: DataFrame, id: str, text: str, window: int, period: int) -> DataFrame:
    """``k1``, ``k2`` (the row's key) and ``at``, the places where a window starts that also starts elsewhere.

    Any two equal windows share an aligned anchor: there is an offset below ``period`` at which both have a position of
    the difference cover, and the ``window - period + 1`` words from there lie in both windows. So only anchors at cover
    positions are hashed and exchanged, a quarter of all positions for a period of 21. A repeated anchor is extended to
    the windows around it; these alone are hashed whole (96 bits) and compared.
    """
    if not 1 <= period <= window:
        raise ValueError("the period has to lie between 1 and the window")
    cover = np.zeros(period, dtype=bool)
    cover[difference_cover(period)] = True
    anchor = window - period + 1

    def anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, hashes = [], []
            for text in batch["text"]:
                words = Words(text)
                places = np.arange(len(words) - anchor + 1 if len(words) >= window else 0)
                places = places[cover[places % period]]
                at.append(places)
                hashes.append(words.digests(places, anchor, xxhash.xxh64_digest))
            yield _located(batch, at, hashes)

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, hashes = [], []
            for text, found in zip(batch["text"], batch["at"]):
                words = Words(text)
                last = len(words) - window
                found = np.asarray(found, dtype=np.int64)
                marks = np.zeros(len(words) + 2, dtype=np.int64)
                np.add.at(marks, np.maximum(found - period + 1, 0), 1)
                np.add.at(marks, np.minimum(found, last) + 1, -1)
                places = np.flatnonzero(np.cumsum(marks)[: last + 1] > 0)
                at.append(places)
                hashes.append(words.digests(places, window, xxhash.xxh3_128_digest))
            yield _located(batch, at, hashes)

    k1, k2 = row_key(docs[id], docs[text])
    rows = docs.select(k1.alias("k1"), k2.alias("k2"), docs[text].alias("text"))
    places = stored(_repeated(rows.mapInPandas(anchors, _LOCATED)))
    # Written, so that the exchange of all texts is over before the windows are exchanged.
    candidates = stored(rows.join(places, ["k1", "k2"]).select("k1", "k2", "text", "at"))
    return _repeated(candidates.mapInPandas(windows, _LOCATED))


def remove_repeated(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 35, period: int = 21
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``: its words without those in repeated windows.

    A window is ``window`` consecutive words of one document. It is repeated if its word sequence also starts anywhere
    else, in the same document or another; all occurrences go, judged on the input. ``kept_text`` joins the remaining
    words by one space. Words are compared unchanged; they are what spaces, tabs and line ends separate.

    A null text has no words and an empty ``kept_text``; a text shorter than a window stays whole. Rows that are equal
    in id and text repeat each other like any two documents. Ids may be null or repeat. All columns are passed on;
    columns named like the results are replaced. An empty table gives an empty result.
    """
    found = stored(repeated_windows(docs, id, text, window, period))

    @F.pandas_udf("n_words bigint, n_removed bigint, kept_text string")
    def cut(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        out = []
        for value, at in zip(texts, places):
            parts = (value or "").encode("utf-8", "surrogatepass").split()
            keep = parts
            if at is not None and len(at):
                marks = np.zeros(len(parts) + 1, dtype=np.int64)
                np.add.at(marks, at, 1)
                np.add.at(marks, np.asarray(at) + window, -1)
                covered = np.cumsum(marks) > 0
                keep = [p for p, gone in zip(parts, covered.tolist()) if not gone]
            out.append((len(parts), len(parts) - len(keep), b" ".join(keep).decode("utf-8", "surrogatepass")))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_text"])

    k1, k2 = row_key(docs[id], docs[text])
    marked = docs.select("*", k1.alias("_k1"), k2.alias("_k2"))
    joined = marked.join(
        found.withColumnsRenamed({"k1": "_f1", "k2": "_f2", "at": "_at"}),
        (F.col("_k1") == F.col("_f1")) & (F.col("_k2") == F.col("_f2")), "left",
    )
    done = joined.withColumn("_cut", cut(joined[text], joined["_at"]))
    done = done.withColumns({c: F.col(f"_cut.{c}") for c in ("n_words", "n_removed", "kept_text")})
    return done.drop("_k1", "_k2", "_f1", "_f2", "_at", "_cut")
