import hashlib
import re

import pytest
from pyspark.sql import functions as F

from flowgauge.llm.infilling import fill_in_middle, restored
from flowgauge.llm.queries import ORACLES, QUERIES
from tests.compare import assert_same, connect
from tests.conftest import DATA


def by_hand(doc_id, text):
    """n, form, prefix_chars, middle_chars, output."""
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def assert_all(docs):
    found = fill_in_middle(docs).withColumn("again", restored(F.col("output"), F.col("form"))).collect()
    before = docs.select("doc_id", "text").collect()
    key = lambda row: tuple(str(x) for x in row)
    assert sorted(((r.doc_id, *by_hand(r.doc_id, r.text), r.text or "") for r in before), key=key) == sorted(
        ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.again) for r in found), key=key
    )
    return found


def test_whole_table(spark, documents):
    found = assert_all(documents.select("doc_id", "text"))
    assert {r.form for r in found} == {"psm", "spm"}


def test_the_twin(spark):
    name = "op12_fill_in_middle"
    assert_same(QUERIES[name](spark, DATA).toPandas(), connect(DATA).execute(ORACLES[name]).df())


@pytest.mark.parametrize("text", [
    None, "", "\n", "\n\n\n", "no end", "one\n", "one\ntwo", "\r\n\r\n", "$1 \\1 {2} \\ $", "\U0001F600\u00e9\n\u20ac\nq\n",
    "a <P> b\nc", "<S>", "x\n<M>", "< P>\n<p>\n", "<\nP>\n<S", "a<\n<\nb>\n", "\x00\n\x85\u2028\nend",
])
def test_texts(spark, docs_of, text):
    assert_all(docs_of(*((k, text) for k in range(12))))


def test_odd_rows(spark, docs_of, odd):
    found = assert_all(docs_of(*odd))
    assert len(found) == len(odd)


def test_very_long_texts(spark, docs_of):
    """A million lines, and a line of three million characters: no recursion, no second try."""
    assert_all(docs_of(*((k, "z\n" * 1_000_000 + "end") for k in range(3)), (5, "w" * 3_000_000), (6, "w" * 3_000_000 + "\n")))


def test_empty_table_and_clashing_names(spark, docs_of):
    empty = fill_in_middle(docs_of((1, "a")).filter("false"))
    assert empty.count() == 0
    clashing = docs_of((1, "a\nb")).withColumn("form", F.lit("old")).withColumn("n", F.lit(-1)).withColumn("odd`.name", F.lit(1))
    found = fill_in_middle(clashing)
    assert found.columns == [
        "doc_id", "text", "source", "size", "form", "n", "odd`.name", "output", "prefix_chars", "middle_chars"
    ]
    assert found.first().form != "old" and found.first().n == 2


def test_shares(spark, docs_of):
    docs = docs_of(*((k, "a\nb\nc\n") for k in range(2000)))
    forms = {r["form"]: r["count"] for r in fill_in_middle(docs, percent=50, spm_percent=20).groupBy("form").count().collect()}
    assert 900 < forms["plain"] < 1100 and 130 < forms["spm"] < 270


def test_no_exchange_and_no_python(spark):
    plan = QUERIES["op12_fill_in_middle"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
