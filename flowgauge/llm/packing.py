"""Packing of tokenised documents into sequences of one size."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import stored
from flowgauge.llm.cutting_stock import assign

# Longer runs of white space exceed what the regex engine behind ``ranked_encoder`` can go back.
_LONG_RUN = 100_000
# Fixed value: how byte-level BPE vocabularies of this kind split a text.
_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids of whole texts as bytes, unsigned and little-endian."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = ranked_encoder(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [np.array(self._ids(t), dtype=self.dtype).tobytes() for t in texts]

    def _ids(self, text: str) -> list[int]:
        if self.ranked and not any(t in text for t in self.special) and not has_long_run(text):
            return self.ranked(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


def has_long_run(text: str) -> bool:
    """Whether more than ``_LONG_RUN`` characters in a row are white space."""
    return len(text) > _LONG_RUN and any(m.end() - m.start() > _LONG_RUN for m in re.finditer(r"\s+", text))


def ranked_encoder(path: str) -> Callable[[str], list[int]] | None:
    """A faster encoder of the same vocabulary, where it is plain byte-level BPE whose ids are the ranks of its merges."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or spec.get("normalizer") or split.get("type") != "ByteLevel":
        return None
    if split.get("add_prefix_space") or not split.get("use_regex", True) or model.get("ignore_merges"):
        return None
    vocabulary = model["vocab"]
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if [vocabulary.get(m) for m in merged] != list(range(256, 256 + len(merged))):
        return None
    # Bytes that are no printable Latin-1 characters are written as characters from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    added = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in token): id for token, id in vocabulary.items() if token not in added}
    return tiktoken.Encoding("ranked", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokens(
    docs: DataFrame, tokenizer: str, end: int = 1, id: str = "doc_id", text: str = "text", batch: int = 256
) -> DataFrame:
    """``id``, ``ids`` (unsigned little-endian, two bytes each where the vocabulary allows it) and their number ``n``."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        stop = np.array([end], dtype=encode.dtype).tobytes()
        for rows in batches:
            for k in range(0, len(rows), batch):
                part = rows.iloc[k : k + batch]
                ids = [x + stop for x in encode([t or "" for t in part["text"]])]
                width = encode.dtype.itemsize
                yield pd.DataFrame({"id": part["id"].array, "ids": ids, "n": [len(x) // width for x in ids], "width": width})

    kind = docs.schema[id].dataType.simpleString()
    # Ids travel as text: pandas would turn whole numbers with nulls into floating-point ones.
    rows = docs.select(docs[id].cast("string").alias("id"), docs[text].alias("text"))
    made = rows.mapInPandas(of, "id string, ids binary, n bigint, width int")
    return made.withColumn("id", F.col("id").cast(kind))


def pack(
    docs: DataFrame, tokenizer: str, size: int = 2048, end: int = 1, id: str = "doc_id", text: str = "text",
    bucket_rows: int = 100_000, width: int = 8,
) -> DataFrame:
    """Pieces of the tokenised documents, packed into sequences of ``size`` tokens at most.

    A document is its text's ids, then ``end``. Whole sequences are cut off its front; what is left over is an item of
    the cutting-stock problem (see ``cutting_stock``). Its histogram has at most ``size`` lengths and is all that the
    driver sees. Items are ranked within their length: documents are dealt to buckets of about ``bucket_rows`` by hash,
    ranked in each, and the counts of the buckets before are added, so documents that all have one length are ranked by
    many tasks.

    Result, one row per piece: ``id``, ``start`` (ids of the document before it), ``length``, ``ids`` (binary, unsigned
    little-endian 32-bit), ``doc_tokens`` (with ``end``), ``sequence_id``, ``offset`` (in the sequence, without gaps).

    A null text is empty: its document is ``end`` alone. Rows with equal or null ids are separate documents. Other
    columns are not read. An empty table gives an empty result.
    """
    kind = docs.schema[id].dataType.simpleString()
    # The number that orders documents is kept with the ids, so it is the same for all that follows.
    kept = stored(tokens(docs, tokenizer, end, id, text).withColumn("row", F.monotonically_increasing_id()))
    buckets = max(16, ceil(kept.count() / bucket_rows))
    dealt = kept.withColumns({
        "rest": (F.col("n") % size).cast("int"), "whole": F.floor(F.col("n") / size),
        "bucket": F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"),
    })
    cells = stored(dealt.groupBy("rest", "bucket").agg(F.count("*").alias("items"), F.sum("whole").alias("wholes")))
    lengths = cells.groupBy("rest").agg(F.sum("items").alias("items"), F.sum("wholes").alias("wholes")).collect()
    runs, used = assign({r["rest"]: r["items"] for r in lengths if r["rest"]}, size, width)
    # Whole sequences of all documents with a smaller rest.
    ahead, total = {}, used
    for r in sorted(lengths, key=lambda r: r["rest"]):
        ahead[r["rest"]], total = total, total + r["wholes"]

    earlier = Window.partitionBy("rest").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(cells.select("rest", "bucket", *(
        F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("items", "wholes")
    )))
    within = Window.partitionBy("rest", "bucket").orderBy("row")
    ranked = dealt.withColumns({
        "rank": F.row_number().over(within) - 1,
        "before": F.sum("whole").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("whole"),
    }).join(starts, ["rest", "bucket"]).select(
        F.col("id").cast("string"), "ids", "n", "width", "rest", "whole",
        (F.col("items_before") + F.col("rank")).alias("rank"), (F.col("wholes_before") + F.col("before")).alias("before"),
    )

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for k in range(0, len(rows), 256):
                yield _pieces(rows.iloc[k : k + 256])

    def _pieces(rows: pd.DataFrame) -> pd.DataFrame:
        made = []
        for one in rows.itertuples(index=False):
            ids = np.frombuffer(one.ids, dtype="<u2" if one.width == 2 else "<u4").astype("<u4")
            cuts = [(size, ahead[one.rest] + int(one.before) + k, 0) for k in range(int(one.whole))]
            cuts += runs[one.rest].pieces(int(one.rank), one.rest, size) if one.rest else []
            start = 0
            for length, sequence, offset in cuts:
                made.append((one.id, start, length, ids[start : start + length].tobytes(), one.n, sequence, offset))
                start += length
        names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        return pd.DataFrame({name: list(column) for name, column in zip(names, zip(*made))})

    made = ranked.mapInPandas(
        pieces, "id string, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    return made.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id)
