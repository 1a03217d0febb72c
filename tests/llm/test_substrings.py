import random

import pytest

from flowgauge.llm.substrings import difference_cover, remove_repeated
from tests.llm import brute


def assert_cut(rows, docs, window=35, period=21):
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_text) for r in remove_repeated(docs, window=window, period=period).collect())
    cut = brute.without_repeats([r[1] for r in rows], window)
    assert got == sorted((r[0] or 0, len(a), len(a) - len(b), " ".join(b)) for r, (a, b) in zip(rows, cut))


@pytest.mark.parametrize("period", [1, 2, 7, 13, 21, 31])
def test_cover_reaches_every_difference(period):
    cover = difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_whole_table(spark, documents):
    assert_cut([(r.doc_id, r.text) for r in documents.collect()], documents)


def test_odd_rows(spark, docs_of, odd):
    assert_cut(odd, docs_of(*odd), window=3, period=2)


@pytest.mark.parametrize("seed", range(3))
def test_few_different_words(spark, docs_of, seed):
    rng = random.Random(seed)
    rows = [(k, " ".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for k in range(30)]
    assert_cut(rows, docs_of(*rows), window=9, period=5)


def test_passages_at_all_alignments(spark, docs_of):
    rng = random.Random(7)
    passage = " ".join(f"p{k}" for k in range(35))
    rows = [(k, " ".join([f"d{k}w{i}" for i in range(k)] + [passage] + [f"e{k}"] * rng.randrange(3))) for k in range(45)]
    rows += [(100, passage.rsplit(" ", 1)[0]), (101, f"{passage} mid {passage}"), (102, passage.replace(" ", "\n\t"))]
    assert_cut(rows, docs_of(*rows))


def test_columns_and_empty_table(spark, docs_of):
    done = remove_repeated(docs_of((1, "a")).filter("false"))
    assert done.columns == ["doc_id", "text", "source", "size", "n_words", "n_removed", "kept_text"] and done.count() == 0
