import random
import re

import pytest
from pyspark.sql import functions as F

from flowgauge.llm.license_scans import TEMPLATES, matches, scan, templates_of
from flowgauge.llm.queries import ORACLES, QUERIES
from tests.compare import assert_same, connect
from tests.conftest import DATA

NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def blocks(ws, stride):
    k = 0
    while True:
        yield ws[k : k + 2 * stride]
        if k + 2 * stride >= len(ws):
            return
        k += stride


def by_hand(text, templates=TEMPLATES, threshold=0.9):
    ws = words(text)
    starts = {p: [i for i in range(len(ws)) if tuple(ws[i : i + len(p)]) == p] for p in PHRASES}
    places = sorted(i for found in starts.values() for i in found)
    base = {PHRASES[p] for p, found in starts.items() if found}
    labels, score = set(base), float(bool(places))
    for label, template in templates:
        t = words(template)
        stride = 8
        while stride < len(t):
            stride *= 2
        for block in blocks(ws, stride):
            share = len(set(t) & set(block)) / len(set(t))
            if share >= threshold:
                labels.add(label)
                score = max(score, share)
    return (len(ws), len(places), places[0] if places else None, places[-1] if places else None,
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


def assert_all(docs, **options):
    order = lambda row: tuple(str(x) for x in row)
    got = [(r.doc_id, *(r[c] for c in NAMES)) for r in scan(docs, **options).collect()]
    want = [(r.doc_id, *by_hand(r.text, **options)) for r in docs.select("doc_id", "text").collect()]
    assert sorted(got, key=order) == sorted(want, key=order)
    return got


def test_the_twin(spark):
    name = "op11_license_scans"
    assert_same(QUERIES[name](spark, DATA).toPandas(), connect(DATA).execute(ORACLES[name]).df())


def test_whole_table(spark):
    found = assert_all(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert {x[-2] for x in found} >= {"", "apache", "cc-by-nc", "gpl", "mit"}


@pytest.mark.parametrize("text", [
    "Released under the MIT License.", "MIT LICENSE mit license", "mit-license, MIT\nLicense; mit  license", "submit license",
    "mit licenses", "mit2 license", "m\u0131t license", "mit \u00a0 license", "mit license\u00e9", "\u00e9mit license", "\u212aIT License mit licen\u017fe",
    "\U0001F600 mit license \U0001F600mit license", "general public license apache license", "general public apache license",
    "GNU General\nPublic   License", "license mit apache license", "mit mit license license", "\x00mit\x7flicense\x00",
])
def test_phrases(spark, docs_of, text):
    assert_all(docs_of((1, text), (2, "a b " + text + " c"), (3, text + " " + text)))


def noisy(rng, template, drop, between):
    """A template with some words left out or replaced, and others set between them."""
    out = []
    for w in template.split():
        if rng.random() >= drop:
            out.append(w)
        out += rng.choices(["the", "of", "license", "zz", "Software"], k=rng.random() < between)
    return " ".join(out)


@pytest.mark.parametrize("threshold", [0.5, 0.9, 1.0])
def test_near_templates_at_all_places(spark, docs_of, threshold):
    """Found at any offset, and missed exactly where the share is too small; common words of templates all around."""
    rng = random.Random(int(threshold * 10))
    filler = ["the", "of", "under", "license", "and", "you", "may", "this", "is", "foo", "bar", "version", "public"]
    rows = []
    for k in range(250):
        label, template = TEMPLATES[k % len(TEMPLATES)]
        before, after = (" ".join(rng.choices(filler, k=rng.randrange(70))) for _ in range(2))
        rows.append((k, f"{before} {noisy(rng, template, rng.choice([0, 0.05, 0.1, 0.2]), rng.choice([0, 0.1, 0.3]))} {after}"))
    found = assert_all(docs_of(*rows), threshold=threshold)
    assert any(x[-2] for x in found)


def test_each_block_once(spark, docs_of):
    docs = docs_of((1, "x " * 20 + "Licensed under CC BY-NC 4.0. " * 3), (2, "Licensed under CC BY-NC 4.0."))
    met = matches(docs, "doc_id", "text", templates_of(TEMPLATES, 0.9)).collect()
    assert len({(r.k1, r.stride, r.block, r.label) for r in met}) == len(met)
    assert {(r.stride, r.block) for r in met if r.label == "cc-by-nc"} == {(8, 0), (8, 2), (8, 3), (8, 4)}


def test_odd_rows(spark, docs_of, odd):
    long = "und die " * 300_000 + "Released under the MIT License." + " mit" * 100_000
    assert_all(docs_of(*odd, (9, long), (9, long), (10, "Released under the MIT License."), (10, "Released under the MIT License."), (None, "mit license")))


def test_empty_table_and_clashing_names(spark, docs_of):
    assert scan(docs_of((1, "a")).filter("false")).count() == 0
    docs = docs_of((1, "MIT License")).withColumn("labels", F.lit("old")).withColumn("k1", F.lit(1)).withColumn("word", F.lit(2))
    row = scan(docs).first()
    assert row.labels == "mit" and row.k1 == 1 and row.word == 2 and row.size == "own"


def test_no_templates_and_no_phrases(spark, docs_of):
    assert [tuple(r[c] for c in NAMES) for r in scan(docs_of((1, "mit license")), templates=[]).collect()] == [(2, 1, 0, 0, "mit", "mit", 1.0)]
    assert scan(docs_of((1, "mit license")), phrases=[], templates=[]).first().n_base == 0


@pytest.mark.parametrize("bad", [[("a", "")], [("a,b", "word")], [("a", " ".join(f"w{k}" for k in range(30_000)))]])
def test_bad_templates(bad):
    with pytest.raises(ValueError):
        templates_of(bad, 0.9)


def test_native(spark):
    """Built-in functions alone; texts are read, but never exchanged."""
    plan = QUERIES["op11_license_scans"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert plan.count("ReadSchema: struct<doc_id:bigint,text:string>") == 2
