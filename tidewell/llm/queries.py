"""The numbered operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import (
    bpe,
    burst_trie,
    filter_audit,
    lm,
    lsh,
    main_text,
    packing,
    pii,
    quality,
    sharding,
    simhash,
    toxicity,
    url_lists,
)
from tidewell.llm.common import table


def op1_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures, and a list of domains that pages on suspicious hosts put on and take off it.

    The days of captures and of list changes are drawn from a hash of the address.
    """
    pages = table(spark, sf_dir, "pages")
    hosts = pages.select("page_id", "url", url_lists.host("url").alias("host"))
    day = lambda text: F.date_add(
        F.lit("2024-01-01").cast("date"), (F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int") % 366)
    )
    captures = hosts.select("page_id", "url", day(F.col("url")).alias("fetched_on"))
    changes = hosts.filter(F.col("host").rlike("casino|bets|pills")).select(
        F.regexp_replace("host", r"^(www|m|blog)\.", "").alias("entry"),
        day(F.concat(F.lit("list "), "url")).alias("day"),
        F.when(F.col("url").startswith("https"), "add").otherwise("remove").alias("action"),
        F.col("page_id").alias("number"),
    )
    return url_lists.judged(captures, url_lists.intervals(changes))


def op2_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def op3_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "score",
    )


def op4_multiprobe_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = lsh.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))
    return found.select("query_id", "rank", "vec_id", "score")


def op5_mincut_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = main_text.extract(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def packed_pieces(docs: DataFrame) -> DataFrame:
    """The digest of packed documents that op6 and the pipeline return."""
    return packing.pack(docs).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op6_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(table(spark, sf_dir, "documents"))


def op7_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_records(table(spark, sf_dir, "documents"), sharding.map_folder(spark))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


def op8_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_simhash_vantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op10_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    count = [
        F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{kind}")
        for k, kind in enumerate(pii.KINDS)
    ]
    digest = F.sha2(pii.listed("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *count, digest, pii.listed("spans").alias("spans"))


def op11_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return burst_trie.nodes(burst_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op12_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_filter_potential(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return filter_audit.audit(filter_audit.marked(documents, labels))


QUERIES = {
    "op1_temporal_lists": op1_temporal_lists,
    "op2_recurrent_lm": op2_recurrent_lm,
    "op3_isolation_forest": op3_isolation_forest,
    "op4_multiprobe_lsh": op4_multiprobe_lsh,
    "op5_mincut_extraction": op5_mincut_extraction,
    "op6_window_packing": op6_window_packing,
    "op7_virtual_slots": op7_virtual_slots,
    "op8_backtracking_bpe": op8_backtracking_bpe,
    "op9_simhash_vantage": op9_simhash_vantage,
    "op10_boosted_pii": op10_boosted_pii,
    "op11_burst_trie": op11_burst_trie,
    "op12_kneser_ney_toxicity": op12_kneser_ney_toxicity,
    "op13_filter_potential": op13_filter_potential,
}
