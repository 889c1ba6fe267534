"""Corpus pipeline: language ID, SimHash near-dedup, suffix-array dedup, packing.

Every stage takes and (but for the last) returns the columns of ``documents``.
Rows with a null id pass the deduplicating stages unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagegrid.llm import langid, packing, simhash, suffix
from wagegrid.llm.queries_text import PACK_TOKENIZER, SEQ_LEN, training_fold, tokenizer_path
from wagegrid.llm.shared import discard, ship_package, store

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a learned language (see ``langid``); texts that
    are null, hold no letter or look like no learned language go. Ids play no part:
    rows with null or repeated ids stay or go by their text. Without a labelled text
    no language is learned and every row goes; an empty table stays empty."""
    ship_package(spark)
    model = langid.fit(training_fold(docs))
    return langid.identify(docs.select(*COLUMNS), model).where(~F.col("rejected")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row: the one with the smallest id; of
    its rows in the group the smallest by (fingerprint, text, other columns), nulls
    first. An id with texts in several groups may stay once for each."""
    ship_package(spark)
    groups = simhash.components(docs, shingle=3, max_bits=3).where("id is not null")
    stays = (groups.groupBy("component").agg(F.min(F.struct("id", "fp")).alias("row"))
             .select(F.col("row.id").alias("doc_id"), F.col("row.fp").alias("fp")))
    repeated = groups.groupBy(F.col("id").alias("doc_id")).count().where("count > 1").select("doc_id")
    rows = docs.select(*COLUMNS)
    nameless = rows.where("doc_id is null")
    if not repeated.limit(1).count():
        return rows.join(stays, "doc_id", "left_semi").unionByName(nameless).select(*COLUMNS)
    once = rows.join(stays.join(repeated, "doc_id", "left_anti"), "doc_id", "left_semi")
    # Which of an id's rows is in which group, its fingerprint tells.
    others = COLUMNS[1:]
    again = (simhash.fingerprints(rows.join(repeated, "doc_id", "left_semi"), others=others)
             .withColumnRenamed("id", "doc_id").join(stays, ["doc_id", "fp"], "left_semi")
             .groupBy("doc_id", "fp").agg(F.min("rest").alias("rest")).select("doc_id", "rest.*"))
    return once.unionByName(again).unionByName(nameless).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings of documents with smaller ids.

    Where a cut leaves a part of a character, that part goes too. ``n_chars``
    counts the new text. Texts that are wholly repeated stay as empty ones.
    """
    ship_package(spark)
    cut = suffix.remove_repeats(docs.select(*COLUMNS), width=50)
    text = F.col("kept").cast("string")
    whole = F.when(F.is_valid_utf8(text), text).otherwise(
        F.replace(F.make_valid_utf8(text), F.lit("�"), F.lit("")))
    return cut.select("doc_id", whole.alias("text"), "rest.lang", "rest.source",
                      F.length(whole).cast("bigint").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of sequences of 2048 tokens. Every row is a document of
    its own, repeated rows and null ids too; a null text is empty and has the end
    token alone. An empty table gives no piece."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path(PACK_TOKENIZER), seq_len=SEQ_LEN, end_id=1)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("pack", pack)]

# A learned model, fingerprint components and a tokenizer are beyond SQL;
# tests/llm checks the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each one's result written and reread; a
    result goes when the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
