"""The pipeline that prepares training text, made of operators of rowgraft.llm.

Every stage takes (spark, docs, sf_dir) and gives the documents it keeps, with all their columns;
the last one adds their pieces.  Between stages the documents are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgraft.llm import decontamination, language_id, near_copies, pieces, repeats
from rowgraft.llm.common import crc_of, documents, durable, free_name, numbered, passing, table

#: SQL cannot express learned languages, byte cuts or sampled pieces: see tests/llm/test_pipeline.py.
ORACLE_SQL = None

#: Words of a passage that is cut out where it occurs again.
PASSAGE = 51


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letter, or none likelier than all others together.

    The languages are learned from three quarters of the stage's own labelled documents; where
    none is labelled, nothing is known and every document goes."""
    learned = language_id.learn(docs.where(crc_of("doc_id") % 4 != 2))
    told = language_id.with_language(docs, learned)
    pred, score = told.columns[-2:]
    return told.where(~language_id.rejected(F.col(pred), F.col(score))).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by a Jaccard similarity of 0.8 or more of five-word
    shingles: the smallest doc_id, of rows that share it the first.  SimHash clusters, then MinHash
    groups for what few bits cannot tell; every link is checked.  Documents without words are one group."""
    rid = free_name(docs, "rid")
    own = numbered(docs, rid)
    with passing(spark) as keep:
        groups = near_copies.near_copies(own.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", rid).alias("key"), "text"), "key")
        gone = keep(groups.where(~F.col("key").eqNullSafe(F.col("component_id"))).select(F.col(f"key.{rid}").alias(rid)))
    return own.join(gone, rid, "left_anti").drop(rid)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of over 50 words that occur again out of the texts, and repeated 400-byte
    strings of fewer words (and parts of characters cut apart); n_chars follows.  Every document stays, also one that is cut to nothing."""
    rid, kept = free_name(docs, "rid"), free_name(docs, "kept")
    own = numbered(docs, rid)
    cut = repeats.without_repeats(own.select(F.col(rid).alias("rid"), "text"), words=PASSAGE, as_text=True).where("size(spans) > 0")
    cut = cut.select(F.col("rid").alias(rid), F.col("kept").alias(kept))
    changed = F.col(kept).isNotNull()
    out = own.join(cut, rid, "left").withColumn("text", F.coalesce(kept, "text"))
    return out.withColumn("n_chars", F.when(changed, F.length(kept)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten words in a row of a benchmark item, or a whole shorter item."""
    rid = free_name(docs, "rid")
    with passing(spark) as keep:
        found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
        hit = keep(found.where("n_hit > 0").select(F.col("rid").alias(rid)))
    return numbered(docs, rid).join(hit, rid, "left_anti").drop(rid)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the sampled pieces of every document; decoding them gives its text back."""
    return pieces.encoded(docs)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup by word shingles", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
