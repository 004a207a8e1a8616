"""The operators applied to the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgraft.llm import decontamination, fill_middle, language_id, licenses, line_dedup, packing, pieces, ppm, prefix_trie, repeats, sharding, simhash, top_k
from rowgraft.llm.common import crc_of, documents, numbered, table
from rowgraft.llm.oracles import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

__all__ = ["ORACLES", "QUERIES"]


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines and sentences of every document, the earliest of which stays, and the words
    of its longest passage of ``PASSAGE`` words or more that occurs elsewhere too (else 0)."""
    found = line_dedup.repeated_units(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    passage = F.when(F.col("passage_words") >= line_dedup.PASSAGE, F.col("passage_words")).otherwise(F.lit(0).cast("long"))
    return found.select(
        "doc_id", "n_units", F.size("spans").cast("long").alias("n_removed"), removed.alias("n_chars_removed"), line_dedup.spans_text(F.col("spans")).alias("removed_spans"), passage.alias("n_passage_words")
    )


@query
def op3_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every document's canonical text and the licence it is, if any."""
    return licenses.license_matches(documents(spark, sf_dir).select("doc_id", "text"), licenses.known_licenses(spark)).drop("text")


@query
def op5_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards of near equal bytes; copies of a text are neighbours."""
    sized = documents(spark, sf_dir).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        F.xxhash64("text").alias("group"),
    )
    dealt = sharding.histogram_shards(sized, F.col("group"), F.col("doc_id"), F.col("size"), 24)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_benchmark_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of the benchmark found in every document."""
    found = decontamination.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 400-byte strings; beside that, how many of its
    words lie in passages it shares with another place, which may have fewer bytes."""
    docs = numbered(documents(spark, sf_dir).select("doc_id", "text"))
    cut = repeats.without_repeats(docs).select(
        "rid", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
    told = docs.select("rid", "doc_id").join(cut, "rid").join(repeats.shared_words(docs), "rid", "left")
    return told.withColumn("n_shared_words", F.coalesce("shared_words", F.lit(0).cast("long"))).drop("rid", "shared_words")


@query
def op2_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of every document under PPM and under word counts, both from four fifths of them."""
    held_out = crc_of("doc_id") % 5 == 1
    found = ppm.lm_scores(documents(spark, sf_dir).select("doc_id", "text"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op7_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document and whether decoding gives the text back."""
    found = pieces.decoded(pieces.encoded(documents(spark, sf_dir).select("doc_id", "text")))
    same = F.col("decoded").eqNullSafe(F.encode("text", "UTF-8"))
    return found.select("doc_id", F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"), "pieces", same.alias("lossless"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from three quarters of them."""
    held_out = crc_of("doc_id") % 4 == 2
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    learned = language_id.learn(docs.where(~held_out))
    return language_id.with_language(docs.select("doc_id", "text"), learned).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    found = top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.withColumnRenamed("id", "vec_id")


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, rebuilt to share their first turns."""
    rows, convs = prefix_trie.rebuilt(prefix_trie.turn_hashes(table(spark, sf_dir, "conversations")))
    return prefix_trie.prefix_trie(rows, convs)


@query
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for filling in the middle, and its text rebuilt from the output."""
    cut = fill_middle.fill_in_middle(documents(spark, sf_dir).select("doc_id", "text"))
    digest, again = F.sha2("output", 256), F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256)
    return cut.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", digest.alias("output_sha256"), again.alias("restored_sha256"))


@query
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.packed(documents(spark, sf_dir))
