"""Toxic documents and sentences: sentence scores combined by noisy-or, learned from labels of documents."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import stored

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def features(word: str, width: int = 4) -> set[str]:
    """A word and its runs of ``width`` characters, where ``^`` and ``$`` stand for its ends."""
    framed = f"^{word}$"
    return {word} | {framed[i : i + width] for i in range(max(1, len(framed) - width + 1))}


class Words(dict):
    """The weight of each word met so far: the sum over those of its features that the model knows."""

    def __init__(self, weights: dict[str, float], room: int = 500_000):
        super().__init__()
        self.weights, self.room = weights, room

    def __missing__(self, word: str) -> float:
        weight = sum(self.weights[f] for f in features(word) if f in self.weights)
        if len(self) >= self.room:
            self.clear()
        self[word] = weight
        return weight


@dataclass(frozen=True)
class Model:
    """A sentence's logit is ``bias`` plus the weights of its words, each counted as often as it occurs."""

    bias: float
    weights: dict[str, float]

    def words(self) -> Words:
        return Words(self.weights)


def sentences(text: str, bias: float, words: Words) -> list[tuple[int, int, float]]:
    """Start, end and logit of each sentence."""
    found = []
    for match in _SENTENCE.finditer(text):
        found.append((match.start(), match.end(), bias + sum([words[w] for w in _WORD.findall(match[0].lower())])))
    return found


def noisy_or(logits: np.ndarray) -> float:
    """1 - product of (1 - sigmoid): the probability that at least one sentence is toxic."""
    return float(-np.expm1(-np.logaddexp(0, logits).sum()))


def telling(words: Iterable[set[str]], labels: np.ndarray, least_documents: int = 4, least_z: float = 4.0) -> list[str]:
    """Features that occur in a greater share of the toxic documents than of the clean ones, by ``least_z`` errors."""
    toxic, clean = Counter(), Counter()
    for some, label in zip(words, labels):
        (toxic if label else clean).update(set().union(*map(features, some)))
    n, m = int(labels.sum()), int((~labels).sum())
    chosen = []
    for f, a in toxic.items():
        share = (a + clean[f]) / (n + m)
        error = np.sqrt(max(share * (1 - share), 1e-12) * (1 / n + 1 / m))
        if a + clean[f] >= least_documents and a / n - clean[f] / m > least_z * error:
            chosen.append(f)
    return sorted(chosen)


def train(
    texts: list[str], labels: list[int], steps: int = 2500, rate: float = 0.1, penalty: float = 3e-6
) -> Model:
    """Fit bias and weights so that the noisy-or of a document's sentences predicts its label.

    Only ``telling`` features have a weight. Plain gradient steps (Adam) on the mean log loss with a quadratic
    ``penalty``; the outcome depends on nothing else.
    """
    y = np.array(labels, dtype=bool)
    once: dict[str, str] = {}  # a word is held once, however often it occurs
    parts = [[[once.setdefault(w, w) for w in _WORD.findall(s.lower())] for s in _SENTENCE.findall(t)] for t in texts]
    names = telling(({w for s in of for w in s} for of in parts), y)
    index = {f: k for k, f in enumerate(names)}
    known: dict[str, list[int]] = {}
    used, of_sentence, of_document = array("q"), array("q"), array("q")
    plain = np.zeros(len(y))  # sentences without any telling feature
    for k, of in enumerate(parts):
        for s in of:
            ids = []
            for w in s:
                if w not in known:
                    known[w] = [index[f] for f in features(w) if f in index]
                ids += known[w]
            if ids:
                used.extend(ids)
                of_sentence.extend([len(of_document)] * len(ids))
                of_document.append(k)
            else:
                plain[k] += 1
    del parts, once
    used, of_sentence, of_document = (np.array(x, dtype=np.int64) for x in (used, of_sentence, of_document))
    theta = np.zeros(len(names) + 1)
    theta[-1] = -6.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        z = theta[-1] + np.bincount(of_sentence, theta[used], minlength=len(of_document))
        softplus = plain * np.logaddexp(0, theta[-1]) + np.bincount(of_document, np.logaddexp(0, z), minlength=len(y))
        total = np.maximum(softplus, 1e-12)
        # Log loss by the summed softplus S of a document: S if clean, -log(1 - exp(-S)) if toxic.
        slope = np.where(y, -1 / np.expm1(np.minimum(total, 500)), 1.0) / len(y)
        by_sentence = slope[of_document] * sigmoid(z)
        grad = np.append(
            np.bincount(used, by_sentence[of_sentence], minlength=len(names)) + penalty * theta[:-1],
            by_sentence.sum() + (slope * plain).sum() * sigmoid(theta[-1]),
        )
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(float(theta[-1]), dict(zip(names, theta[:-1].tolist())))


def sigmoid(z):
    return np.exp(-np.logaddexp(0, -z))


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    most_rows: int = 10_000, most_bytes: int = 256 << 20,
) -> Model:
    """Train on the labelled documents, on ``most_rows`` of them at most: those whose ids have the smallest hashes.

    The bounds are the one thing that is sampled here; both hold for what reaches the driver. Rows that are equal in id
    and text count as one. Rows are taken in order of a hash until their texts come to ``most_bytes``. Null labels and ids are left out, an id labelled more than once is
    toxic if one label says so. Without a toxic or without a clean document the model finds nothing toxic.
    """
    wanted = labels.select(labels[id].alias("_id"), labels[label].alias("_y")).dropna().groupBy("_id").agg(F.max("_y").alias("_y"))
    # A number of rows that is bounded by the parameter, so it may be broadcast.
    chosen = F.broadcast(wanted.orderBy(F.xxhash64("_id"), "_id").limit(most_rows))
    rows = docs.join(chosen, docs[id] == chosen["_id"]).select("_id", docs[text].alias("text"), "_y").distinct()
    order = [F.xxhash64("_id"), F.col("_id"), F.xxhash64("text")]
    picked = stored(rows.orderBy(*order).limit(most_rows).withColumns({
        "_order": F.struct(*(c.alias(f"o{k}") for k, c in enumerate(order))), "_bytes": F.coalesce(F.octet_length("text"), F.lit(0)),
    }))
    left, last = most_bytes, None
    for row in picked.orderBy("_order").select("_order", "_bytes").collect():
        left -= row["_bytes"]
        if left < 0:
            break
        last = row["_order"]
    if last is None:
        return Model(-30.0, {})
    until = F.struct(*(F.lit(v).alias(f"o{k}") for k, v in enumerate(last))).cast(picked.schema["_order"].dataType)
    taken = picked.filter(F.col("_order") <= until).select("_id", "text", "_y")
    rows = sorted(taken.collect(), key=lambda r: (r["_id"], r["text"] or ""))
    y = [int(r["_y"]) for r in rows]
    if len(set(y)) < 2:
        return Model(-30.0, {})
    return train([r["text"] or "" for r in rows], y)


def score(docs: DataFrame, model: Model, text: str = "text", offending: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``sentences``, the places (start, end, score) of offending sentences.

    Whole texts are read. A sentence ends at ``.``, ``!``, ``?`` or a line end; one with a score of at least
    ``offending`` is listed, by its character positions. A null or empty text has no sentence and score 0. Repeated rows
    are scored alike. All columns are passed on; columns named like the results are replaced. An empty table gives an
    empty result.
    """
    bound = float(np.log(offending / (1 - offending)))

    @F.pandas_udf("score double, sentences array<struct<start:int,end:int,score:double>>")
    def scored(texts: pd.Series) -> pd.DataFrame:
        out, words = [], model.words()
        for value in texts:
            found = sentences(value or "", model.bias, words)
            logits = np.array([z for _, _, z in found])
            places = [{"start": a, "end": b, "score": float(sigmoid(z))} for a, b, z in found if z >= bound]
            out.append((noisy_or(logits), places))
        return pd.DataFrame(out, columns=["score", "sentences"])

    done = docs.withColumn("_scored", scored(docs[text]))
    return done.withColumns({c: F.col(f"_scored.{c}") for c in ("score", "sentences")}).drop("_scored")
