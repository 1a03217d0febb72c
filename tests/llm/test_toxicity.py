import numpy as np
import pytest

from flowgauge.llm import toxicity
from flowgauge.llm.queries import op10_toxicity
from tests.conftest import DATA

CLEAN = ["the garden is green. we walk home", "a quiet day.\nnothing happens", "rain again! the river rises", ""] * 15
TOXIC = ["the garden is green. you are a grumbler", "rain again! what a grumbler", "grumblers everywhere", "a quiet day. grumbling grumbler"] * 5


def model():
    return toxicity.train(CLEAN + TOXIC, [0] * len(CLEAN) + [1] * len(TOXIC))


def test_noisy_or():
    logits = np.array([-1.0, 0.5, 2.0])
    assert toxicity.noisy_or(logits) == pytest.approx(1 - np.prod(1 - 1 / (1 + np.exp(-logits))))
    assert toxicity.noisy_or(np.array([])) == 0 and toxicity.noisy_or(np.array([-800.0, 800.0])) == 1


def test_learned_words_score_and_sentences_are_located(spark, docs_of):
    text = "We walk home. You GRUMBLER!\nthe end"
    docs = docs_of((1, text), (2, "we walk home"), (3, None), (4, ""), (None, "a grumblerish day"), (1, text))
    found = toxicity.score(docs, model()).collect()
    scores = {r.doc_id: r.score for r in found}
    assert scores[1] > 0.8 and scores[2] < 0.2 and scores[3] == scores[4] == 0 and scores[None] > 0.5
    assert all([text[p.start : p.end] for p in r.sentences] == [" You GRUMBLER"] for r in found if r.doc_id == 1)


def test_training_does_not_depend_on_order():
    order = np.random.default_rng(0).permutation(len(CLEAN + TOXIC))
    texts, labels = CLEAN + TOXIC, [0] * len(CLEAN) + [1] * len(TOXIC)
    other = toxicity.train([texts[k] for k in order], [labels[k] for k in order])
    assert other.bias == pytest.approx(model().bias, rel=1e-6)


def test_one_kind_of_label_and_empty_table(spark, docs_of):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id bigint, toxic int")
    nothing = toxicity.fit(docs_of((1, "a")), labels)
    assert [r.score for r in toxicity.score(docs_of((1, "grumbler")), nothing).collect()] == [pytest.approx(0, abs=1e-9)]
    assert toxicity.score(docs_of((1, "a")).filter("false"), nothing).count() == 0


def test_bounds_hold_for_rows_and_bytes(spark, docs_of, monkeypatch):
    """An id that is repeated very often, and texts of any length."""
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: seen.append(list(zip(texts, labels))) or toxicity.Model(0.0, {}))
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id bigint, toxic int")
    repeated = docs_of(*[(1, "the same")] * 5000, *[(1, f"text {k}") for k in range(30)], (2, "b" * 100), (3, None))
    toxicity.fit(repeated, labels)
    toxicity.fit(repeated, labels, most_rows=10)
    toxicity.fit(repeated, labels, most_bytes=150)
    assert len(seen[0]) == 33 and sorted(seen[0])[-1] == ("the same", 0) and ("", 1) in seen[0]
    assert all(len(some) <= 10 for some in seen[1:2])
    assert all(sum(len(t) for t, _ in some) <= 150 for some in seen[2:])
    assert toxicity.fit(repeated, labels, most_bytes=0).weights == {} and toxicity.fit(repeated, labels, most_rows=1).bias == -30.0


def test_held_out_documents(spark):
    folder = DATA.replace("sf0.001", "sf0.1")
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = [r for r in op10_toxicity(spark, folder).collect() if r.held_out and r.doc_id in toxic]
    positive = [r.predicted for r in found if toxic[r.doc_id]]
    negative = [r.predicted for r in found if not toxic[r.doc_id]]
    assert sum(positive) >= 0.9 * len(positive) and sum(negative) <= 0.02 * len(negative)
