"""The corpus pipeline: five stages over documents, each the work of one operator of docketry.llm.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; its result is written as Parquet and read again for
the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm import decontamination, jaccard_join, language_id, mixing, pii, repeats
from docketry.llm.common import shared_dir, stored, table, word_count


def _packed(docs: DataFrame, *used: str) -> DataFrame:
    """docs with the columns that a stage works on, and all others in one struct, so that their names can't clash with any that the stage makes."""
    other = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, *([F.struct(*other).alias("row_")] if other else []))


def _unpacked(rows: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    """The columns of docs of rows that went through a stage as _packed() makes them."""
    return rows.select(*[F.col(c) if c in used else F.col("row_").getField(c).alias(c) for c in docs.columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified: text with letters, one of the languages that documents declare, and a posterior of at least language_id.ACCEPT.

    Null and empty texts and those without letters go; a null lang or source is no evidence and keeps no row out; long texts are read whole; ties go to the first language by
    name; repeated rows are judged each, alike. An empty table stays empty. Extra columns pass, whatever their names."""
    used = ("doc_id", "text", "lang", "source")
    return _unpacked(language_id.of_documents(_packed(docs, *used)).where(language_id.accepted()), docs, *used)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that links of Jaccard similarity 0.8 and more connect.

    Rows with a null id are documents of their own, after all others. Of rows that are repeated as a whole one stays; rows that share an id but differ are one document and
    stay or go together. Null and empty texts are alike to nothing and stay; texts under five words are one shingle; long texts are compared whole. An empty table stays empty.
    Extra columns pass, whatever their names."""
    rows = repeats.keyed(_packed(docs, "doc_id", "text"))
    groups = jaccard_join.jaccard_groups(rows.withColumn("doc_id", F.col("__key"))).where("doc_id = class_id").select(F.col("doc_id").alias("__key")).distinct()
    kept = rows.join(groups, "__key", "left_semi")
    shared = stored(rows.groupBy("__key").agg(F.count("*").alias("n")).where("n > 1").select("__key"), "shared")
    if shared.isEmpty():
        return _unpacked(kept, docs, "doc_id", "text")
    once = kept.join(shared, "__key", "left_semi").dropDuplicates()
    return _unpacked(kept.join(shared, "__key", "left_anti").unionByName(once), docs, "doc_id", "text")


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into: tiles cover less than half of every item.

    Null and empty texts leak nothing and stay; long texts are searched whole; repeated rows are judged each, alike. An empty table, or an empty benchmark, changes nothing. Extra columns pass,
    whatever their names."""
    return _unpacked(decontamination.contamination(_packed(docs, "text"), table(spark, sf_dir, "benchmark")).where(~F.col("leaked")), docs, "text")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates in place of personal data; n_chars follows.

    Every row stays. Null texts stay null, with n_chars 0, and empty ones empty; long texts are rewritten whole; an entity has one surrogate in all rows, so repeated rows stay
    repeated. An empty table stays empty. Extra columns pass, whatever their names."""
    out = _unpacked(pii.replace_entities(_packed(docs, "text"), pii.session_key(spark)), docs, "text")
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0))) if "n_chars" in docs.columns else out


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document: doc_id, lang, source, size, source_size, target, taken, for every row. Other columns end here.

    Null and empty texts have size 0 and taken 0; a null source is a source, the last one; long documents are taken whole or not at all; rows that are repeated as a whole
    share a draw and are taken together. An empty table gives no rows."""
    sized = docs.select("doc_id", "lang", "source", word_count(F.col("text")).alias("size"))
    out = mixing.mix(sized, F.col("size"), F.array("source"))
    return out.select("doc_.doc_id", "doc_.lang", "doc_.source", F.col("size_").alias("size"), F.col("source_size_").alias("source_size"), F.col("target_").alias("target"), F.col("taken_").alias("taken"))


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", not_in_benchmark),
    ("pii", without_personal_data),
    ("mixing", mixed),
]

#: The stages learn and compare in ways that SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
