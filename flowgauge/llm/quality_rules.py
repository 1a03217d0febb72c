"""Rules on the words and lines of a text, and its n-gram log-likelihood ratio, all in built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm import ngrams
from flowgauge.llm.common import SPACE, let, words


def repeated_words(ws: Column) -> Column:
    """Words of ``ws`` that lie in a window of three words found twice or more, the first occurrence included."""
    def of(ws: Column) -> Column:
        windows = F.transform(
            F.slice(ws, F.lit(1), F.greatest(F.size(ws) - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)),
        )
        return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h)))

    return let(ws, of).cast("bigint")


def _covered(windows: Column) -> Column:
    """Words under the windows that are not alone with their hash: three each, less where the next one starts sooner."""
    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def starts(z: Column) -> Column:
        twice = F.filter(z, lambda x, k: F.coalesce(F.get(z, k - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(z, k + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def width(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    return let(let(F.sort_array(pairs), starts), width)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` (bigint)."""
    value = F.coalesce(docs[text], F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    ws = words(docs[text])
    return docs.withColumns({
        "n_words": F.size(ws).cast("bigint"),
        "word_chars": (F.length(value) - F.regexp_count(value, F.lit(SPACE))).cast("bigint"),
        "n_symbols": F.regexp_count(value, F.lit(r"[#*$%&|<>]")).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": repeated_words(ws),
    })


def judge(
    docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", buckets: int = 1 << 14,
    threshold: float = -0.05, least_words: int = 50,
) -> DataFrame:
    """``docs`` with the columns of ``measures``, ``base_failed``, ``llr`` and ``kept``.

    A document fails the base rules with fewer than ``least_words`` words, or if over half of its words lie in repeated
    windows of three words. ``llr`` is its mean log-likelihood ratio per n-gram between the trusted target and the raw
    corpus: words and pairs of neighbours are hashed to ``buckets``, and every document is scored over its whole text.
    It is kept if it passes the base rules and ``llr`` is at least ``threshold``.

    ``target`` lists the trusted ids (column ``id``), repeats and nulls allowed. Without a trusted document every ``llr``
    is 0. A null or empty text has no words, a null ``llr`` and fails the base rules. Repeated rows are judged alike. All
    columns are passed on; columns named like the results are replaced. An empty table gives an empty result.
    """
    model = ngrams.fit(docs, target, id, text, buckets)
    ws = words(docs[text])
    llr = let(ws, lambda ws: F.when(F.size(ws) > 0, model.score(ws) / ngrams.features(ws)))
    measured = measures(docs.withColumn("llr", llr), text)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("llr") >= threshold)
    )
