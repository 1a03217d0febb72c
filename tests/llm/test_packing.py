from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flowgauge.llm.cutting_stock import assign, best_pattern, fractional_patterns
from flowgauge.llm.packing import Encoder, pack, ranked_encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def assert_packed(rows, docs, size, least_use=0.0):
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter((i, *tokenizer.encode(t or "", add_special_tokens=False).ids, 1) for i, t in rows)
    pieces = pack(docs, PATH, size=size).collect()
    sequences, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, dtype="<u4").tolist()
        assert len(ids) == p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length))
        parts[p.doc_id, p.doc_tokens].append((p.start, ids))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    assert sum(p.length for p in pieces) == sum(len(k) - 1 for k in want.elements())
    for (doc, n), found in parts.items():
        texts = [k[1:] for k in want.elements() if k[0] == doc and len(k) - 1 == n]
        whole = Counter((start, tuple(t[start : start + len(ids)])) for t in texts for start, ids in found)
        assert all(whole[start, tuple(ids)] for start, ids in found)
        assert sum(len(ids) for _, ids in found) == n * len(texts)
    assert sum(p.length for p in pieces) >= least_use * size * len(sequences)


def test_whole_table(spark, documents):
    assert_packed([(r.doc_id, r.text) for r in documents.collect()], documents, 2048, 0.98)


@pytest.mark.parametrize("size", [8, 64])
def test_odd_rows(spark, docs_of, odd, size):
    assert_packed(odd, docs_of(*odd), size)


def test_empty_table(spark, docs_of):
    assert pack(docs_of((1, "a")).filter("false"), PATH).count() == 0


def test_ids_are_those_of_the_tokenizer():
    texts = ["", " ", "  two  spaces ", "a b\n c\n\nd \n", "it's we'll  x", "tab\t x", " lead", "trail ", "<|endoftext|> a<|endoftext|>b",
             "Ünïcödé  nb   em", "1 2  33 4,5 !! ??", "a\r\n b"]
    tokenizer, encode = Tokenizer.from_file(PATH), Encoder(PATH)
    for text, ids in zip(texts, encode(texts)):
        assert np.frombuffer(ids, dtype="<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert encode.ranked is not None


@pytest.mark.parametrize("run", [" ", "\n", "\u3000"])
def test_long_runs_of_white_space_are_encoded(run):
    tokenizer, encode = Tokenizer.from_file(PATH), Encoder(PATH)
    text = "a" + run * 1_500_000 + "b"
    assert np.frombuffer(encode([text])[0], dtype="<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_one_long_run_does_not_lose_the_other_documents(spark, docs_of):
    rows = [(1, "a few words"), (2, " " * 1_500_000), (3, None)]
    found = pack(docs_of(*rows), PATH).groupBy("doc_id").agg({"length": "sum"}).collect()
    tokenizer = Tokenizer.from_file(PATH)
    assert dict(found) == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows}


def test_other_vocabularies_are_left_to_their_library():
    assert ranked_encoder(public_tokenizers.path("word_bpe_49k.json")) is None


@pytest.mark.parametrize("lengths", [
    np.full(500, 1500), np.arange(1, 2048), np.full(7, 2047), np.random.default_rng(0).integers(1, 2048, 3000),
    np.concatenate([np.full(900, 700), np.random.default_rng(1).integers(1, 300, 4000)]), np.array([5]),
])
def test_assignment_places_every_item_once(lengths):
    counts = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
    runs, used = assign(counts, 2048)
    sequences = defaultdict(list)
    for length, number in counts.items():
        for rank in range(number):
            pieces = runs[length].pieces(rank, length, 2048)
            assert sum(p[0] for p in pieces) == length
            for n, sequence, offset in pieces:
                sequences[sequence].append((offset, n))
    for held in sequences.values():
        assert [o for o, _ in sorted(held)] == np.cumsum([0, *(n for _, n in sorted(held))])[:-1].tolist()
        assert sum(n for _, n in held) <= 2048
    assert set(sequences) == set(range(used)) and used <= np.ceil(lengths.sum() / 2048 / 0.97)


def test_program_meets_demand_near_its_bound():
    sizes, demand = np.array([3, 5, 9, 14]), np.array([40.0, 25.0, 31.0, 12.0])
    patterns = fractional_patterns(sizes, demand, 20, tolerance=1e-6)
    assert (sum(p * x for p, x in patterns) >= demand - 1e-6).all()
    assert sum(x for _, x in patterns) == pytest.approx((sizes * demand).sum() / 20, rel=0.08)


def test_knapsack():
    value, counts = best_pattern(np.array([2.0, 3.0, 6.5]), np.array([2, 3, 6]), 11)
    assert value == 11.5 and counts.tolist() == [1, 1, 1]
