import random
from math import log

import pytest
from pyspark.sql import functions as F

from flowgauge.llm import ngrams, quality_rules
from flowgauge.llm.common import row_key, words
from flowgauge.llm.queries import op1_resampling
from flowgauge.llm.resampling import resample
from tests.conftest import DATA
from tests.llm import brute


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "doc_id bigint")


def assert_measured(rows, found):
    want = sorted((i or 0, str(sorted(brute.base_rules(t).items()))) for i, t in rows)
    names = brute.base_rules("").keys()
    assert sorted((r.doc_id or 0, str(sorted((k, r[k]) for k in names))) for r in found) == want


def test_whole_table(spark, documents):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    found = quality_rules.judge(documents, labels.filter("quality = 1")).collect()
    assert_measured([(r.doc_id, r.text) for r in documents.collect()], found)


def test_verdicts_follow_the_labels(spark):
    folder = DATA.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality_rules.judge(spark.read.parquet(f"{folder}/documents.parquet"), labels.filter("quality = 1")).collect()
    good = {r.doc_id: r.quality for r in labels.collect()}
    passed = [r for r in found if not r.base_failed and r.doc_id in good]
    assert sum(r.kept for r in passed if good[r.doc_id] == 1) >= 0.97 * sum(good[r.doc_id] == 1 for r in passed)
    assert sum(r.kept for r in passed if good[r.doc_id] == 0) <= 0.2 * sum(good[r.doc_id] == 0 for r in passed)


def test_rules_on_made_up_texts(spark, docs_of, odd):
    rng = random.Random(5)
    rows = odd + [(k + 100, "".join(rng.choice(["a ", "b ", "c ", "\n", "#", "\t", "a\n", "b\n", " é|"]) for _ in range(rng.randrange(200)))) for k in range(60)]
    assert_measured(rows, quality_rules.judge(docs_of(*rows), ids(spark, 1)).collect())


def bucket(spark, buckets, *texts):
    return spark.range(1).select(F.pmod(F.xxhash64(*map(F.lit, texts)), F.lit(buckets))).first()[0]


def test_ratio_by_hand(spark, docs_of):
    docs = docs_of((1, "a b"), (2, "a c c"), (None, "b"), (1, "a b"))
    model = ngrams.fit(docs, ids(spark, 1, 1, None), buckets=64, smoothing=0.5)
    grams = {k: bucket(spark, 64, *k) for k in [("a",), ("b",), ("c",), ("a", "b"), ("a", "c"), ("c", "c")]}
    raw, target = [0.5] * 64, [0.5] * 64  # 12 n-grams, 6 of them trusted
    for k, n in {("a",): 3, ("b",): 3, ("c",): 2, ("a", "b"): 2, ("a", "c"): 1, ("c", "c"): 1}.items():
        raw[grams[k]] += n / 2
    for k in [("a",), ("b",), ("a", "b")] * 2:
        target[grams[k]] += 1
    want = [log(t) - log(r) for t, r in zip(target, raw)]
    assert model.weights == pytest.approx(want, abs=1e-6)
    scored = {r.text: r.s for r in docs.select("text", model.score(words(F.col("text"))).alias("s")).collect()}
    assert scored["a c c"] == pytest.approx(sum(want[grams[k]] for k in [("a",), ("c",), ("c",), ("a", "c"), ("c", "c")]), abs=1e-5)


@pytest.fixture(scope="module")
def labelled(spark, documents):
    """All documents, and the ids labelled as good."""
    labels = spark.read.parquet(f"{DATA}/labels.parquet").filter("quality = 1").collect()
    return [(r.doc_id, r.text) for r in documents.collect()], {r.doc_id for r in labels}


def test_ratios_of_the_whole_table(spark, documents, labelled):
    """Every document's ratio, and the verdict that follows, recomputed outside of Spark."""
    rows, good = labelled
    want = {row: found for row, found in zip(rows, brute.log_ratios(rows, good))}
    judged = quality_rules.judge(documents, ids(spark, *good)).collect()
    assert len(judged) == len(rows)
    for r in judged:
        total, n = want[r.doc_id, r.text]
        assert r.llr == (pytest.approx(total / n, abs=2e-6) if n else None)
        assert r.kept == (not r.base_failed and r.llr >= -0.05)


def test_weights_and_noise_of_the_whole_table(spark, documents, labelled):
    rows, good = labelled
    want = {row: found for row, found in zip(rows, brute.log_ratios(rows, good))}
    hashes = documents.select("doc_id", "text", F.xxhash64(F.lit(1), *row_key(F.col("doc_id"), F.col("text"))).alias("h"))
    uniform = {(r.doc_id, r.text): ((r.h & ((1 << 52) - 1)) + 0.5) / (1 << 52) for r in hashes.collect()}
    found = resample(documents, ids(spark, *good), 0.5).collect()
    for r in found:
        total, n = want[r.doc_id, r.text]
        assert r.log_weight == pytest.approx(total, abs=2e-6 * n + 1e-9)
        assert r.gumbel_key == pytest.approx(total - log(-log(uniform[r.doc_id, r.text])), abs=2e-6 * n + 1e-9)


def test_as_many_are_kept_as_are_labelled_good(spark, documents):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    found = op1_resampling(spark, DATA).collect()
    share = labels.filter("quality = 1").count() / labels.count()
    assert sum(r.kept for r in found) == pytest.approx(share * len(found), abs=3)


def test_without_trusted_documents_and_empty_table(spark, docs_of):
    long = " ".join(f"w{k}" for k in range(60))
    found = quality_rules.judge(docs_of((1, long), (2, None)), ids(spark)).collect()
    assert sorted((r.doc_id, r.llr, r.kept) for r in found) == [(1, 0.0, True), (2, None, False)]
    assert quality_rules.judge(docs_of((1, "a")).filter("false"), ids(spark, 1)).count() == 0


@pytest.mark.parametrize("share", [0.0, 0.3, 0.86, 1.0])
def test_gumbel_top_k(spark, documents, share):
    found = resample(documents, spark.read.parquet(f"{DATA}/labels.parquet").filter("quality = 1"), share).collect()
    kept = sorted((r.gumbel_key for r in found if r.kept), reverse=True)
    assert len(kept) == pytest.approx(round(share * len(found)), abs=3)  # equal rows go together
    assert kept == sorted((r.gumbel_key for r in found), reverse=True)[: len(kept)]


def test_resampling_odd_rows(spark, docs_of, odd):
    found = resample(docs_of(*odd), ids(spark, 6), 0.5).collect()
    assert len(found) == len(odd) and all(r.log_weight == 0 for r in found if not brute.words(r.text))
    again = resample(docs_of(*odd), ids(spark, 6), 0.5).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert resample(docs_of(*odd).filter("false"), ids(spark, 6), 0.5).count() == 0
