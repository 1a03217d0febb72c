from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from flowgauge.llm.mixing import mix
from tests.conftest import DATA
from tests.llm import brute


def key(row):
    return (row.doc_id, row.text)


def test_stages_against_brute_force(spark, documents, tmp_path):
    docs, kept = documents, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.dtypes == documents.dtypes
        kept.append(docs.collect())
    before = documents.collect()
    rules, near, passages, mixed, pieces = kept

    failed = {r.doc_id for r in before if brute.base_rules(r.text)["base_failed"]}
    assert not failed & {r.doc_id for r in rules} and 0.5 * len(before) < len(rules) < len(before)

    _, roots = brute.near_groups([r.text for r in rules])
    first = {}
    for root, row in zip(roots, rules):
        first[root] = min(first.get(root, row.doc_id), row.doc_id)
    assert {r.doc_id for r in near} == set(first.values()) and len(near) == len(first)

    cut = brute.without_repeats([r.text for r in near])
    want = {r.doc_id: r.text if len(a) == len(b) else " ".join(b) for r, (a, b) in zip(near, cut)}
    assert {r.doc_id: r.text for r in passages} == want and all(r.n_chars == len(r.text) for r in passages)

    copies = {r.doc_id: r.copies for r in mix(spark.read.parquet(f"{tmp_path}/2")).collect()}
    assert Counter(r.doc_id for r in mixed) == Counter({i: n for i, n in copies.items() if n})

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1] for r in mixed}
    covered, filled = defaultdict(Counter), defaultdict(list)
    for p in pieces:
        piece = np.frombuffer(p.ids, dtype="<u4").tolist()
        assert piece == ids[p.doc_id][p.start : p.start + p.length]
        covered[p.doc_id].update(range(p.start, p.start + p.length))
        filled[p.sequence_id].append((p.offset, p.length))
    assert all(covered[i] == Counter({k: copies[i] for k in range(len(x))}) for i, x in ids.items())
    for held in filled.values():
        assert [o for o, _ in sorted(held)] == np.cumsum([0, *(n for _, n in sorted(held))])[:-1].tolist()
        assert sum(n for _, n in held) <= 2048


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, DATA)
    assert found.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert found.count() > 0
