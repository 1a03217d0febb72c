"""Importance resampling of documents towards a trusted target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm import ngrams
from flowgauge.llm.common import row_key, stored, unit_hash, words
from flowgauge.llm.histogram import at_least, splitters


def resample(
    docs: DataFrame, target: DataFrame, share: float, id: str = "doc_id", text: str = "text",
    buckets: int = 1 << 14, seed: int = 1,
) -> DataFrame:
    """``docs`` with ``log_weight``, ``gumbel_key`` and ``kept``.

    ``log_weight`` is the logarithm of the ratio of two generative models, hashed n-grams of the documents in ``target``
    (column ``id``) and of all documents, over the whole text. Adding Gumbel noise and keeping the greatest keys draws
    ``round(share * rows)`` documents without replacement, with probabilities in proportion to the weights. The noise
    is a function of ``seed`` and the row, so reruns agree. The key of the last document kept is found by exact counts
    over the table (see ``histogram``), not by sorting it; of equal keys the one with the greater row hash comes first.

    A null or empty text has log weight 0. Without a target all weights are equal. Rows that are equal in id and text
    have equal keys and are kept or left together. All columns are passed on; columns named like the results are
    replaced. An empty table gives an empty result.
    """
    model = ngrams.fit(docs, target, id, text, buckets)
    k1, k2 = row_key(docs[id], docs[text])
    noise = -F.log(-F.log(unit_hash(k1, k2, seed=seed)))
    scored = docs.withColumn("log_weight", model.score(words(docs[text])))
    scored = scored.withColumns({"gumbel_key": F.col("log_weight") + noise, "_tie": k2.cast("double"), "_one": F.lit(1)})
    keys = ["gumbel_key", "_tie"]
    narrow = stored(scored.select(*keys, "_one"))
    rows = narrow.count()
    left = rows - round(share * rows)
    first = splitters(narrow, keys, "_one", [float(left)], 0.0)[0]
    return scored.withColumn("kept", at_least(keys, first) if left else F.lit(True)).drop("_tie", "_one")
