"""The operators of this subpackage over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.llm import (
    conversation_trie, infilling, license_scans, mixing, nearest, packing, quality_rules, resampling, sharding, simhash, substrings, toxicity, twins,
    url_filters,
)
from flowgauge.llm.common import stored, table


def trusted(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of the documents labelled as good."""
    return table(spark, folder, "labels").filter("quality = 1").select("doc_id")


def op1_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """As large a share of the documents is kept as of the labels is good; all of them without labels."""
    labels = table(spark, folder, "labels").filter("quality IS NOT NULL")
    share = labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    scored = resampling.resample(table(spark, folder, "documents"), trusted(spark, folder), 1.0 if share is None else share)
    return scored.select("doc_id", "log_weight", "gumbel_key", "kept")


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate"
    )


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"), trusted(spark, folder))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"
    )


URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("good"))
    judged = url_filters.judge(table(spark, folder, "pages"), labels, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), tokenizer())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    dealt = sharding.histogram_sort(table(spark, folder, "documents"))
    return dealt.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op8_substrings(spark: SparkSession, folder: str) -> DataFrame:
    done = substrings.remove_repeated(table(spark, folder, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_nearest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest.search(stored(nearest.build_index(vectors)), vectors.filter("vec_id % 20 = 0"))


def held_out(id: str = "doc_id") -> Column:
    return F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = toxicity.score(documents, toxicity.fit(documents, labels.filter(~held_out())))
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.transform("sentences", lambda x: F.struct(x["start"], x["end"])).alias("offending"),
    )


def op11_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    scanned = license_scans.scan(table(spark, folder, "documents"))
    return scanned.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    moved = infilling.fill_in_middle(table(spark, folder, "documents"))
    text = infilling.restored(F.col("output"), F.col("form"))
    return moved.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = stored(conversation_trie.turns_in_order(table(spark, folder, "conversations")))
    rows, convs = conversation_trie.branched(turns, every=20, most=4)
    return conversation_trie.prefix_trie(stored(rows), stored(convs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_resampling": op1_resampling,
    "op2_url_filters": op2_url_filters,
    "op3_packing": op3_packing,
    "op4_mixing": op4_mixing,
    "op5_sharding": op5_sharding,
    "op6_quality_rules": op6_quality_rules,
    "op7_simhash": op7_simhash,
    "op8_substrings": op8_substrings,
    "op9_nearest": op9_nearest,
    "op10_toxicity": op10_toxicity,
    "op11_license_scans": op11_license_scans,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLES: dict[str, str] = {
    "op11_license_scans": twins.license_scans(),
    "op12_fill_in_middle": twins.FILL_IN_MIDDLE,
    "op13_conversation_trie": twins.CONVERSATION_TRIE,
}
