"""From raw documents to packed sequences: quality rules, language ID, near-duplicates, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents.  All but the last return the columns of documents, further
columns included, whatever their names.  An empty table goes through every stage and stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from skyloom.llm import langid, packing, quality, simhash
from skyloom.llm.common import delete, load, released, shared_dir
from skyloom.llm.queries import tokenizer_file

#: SQL cannot express tokenisation, hashing or scoring over a vocabulary; tests/llm compares the
#: stages with brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.  Null and empty texts have no words and go; a null,
    blank or "und" label is judged against all languages; repeated rows are judged alike."""
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model knows, by the text alone.  Null texts and texts without
    letters go, and all documents if none has a label to learn from; repeated rows are scored alike."""
    return langid.keep_identified(docs, tokenizer_file("piece_bpe_32k.model"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8.  The
    smallest id stays (nulls last, ties by the text's hash), and one of equal rows; all null, empty
    and wordless texts are one group."""
    return simhash.drop_near_duplicates(docs, width=5, similarity=0.8)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 1024 tokens.  A null or empty text is its end id alone;
    rows with null or repeated ids are packed like any other."""
    return packing.packed_pieces(docs, tokenizer=tokenizer_file("byte_bpe_50k.json"), end_id=0, length=1024).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", quality_rules),
    ("language", language_id),
    ("near_duplicates", near_duplicates),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents.  Each result is a table in the shared folder, which goes
    when the next one is written; the last stays until the session's JVM ends."""
    docs, last = load(spark, sf_dir, "documents"), None
    top = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    delete(spark, top, on_exit=True)
    for name, stage in STAGES:
        with released(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
        if last:
            delete(spark, last)
        last = f"{top}/{name}"
    return docs
