"""A training corpus from raw documents: toxicity, line dedup, near-duplicate dedup, mixing by source, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm.common import ensure_checkpoint_dir, small_batches
from tallyflow.llm.line_dedup import line_dedup
from tallyflow.llm.minhash_dedup import minhash_dedup
from tallyflow.llm.mixing import mix_documents
from tallyflow.llm.packing import pack_documents
from tallyflow.llm.queries import tokenizer_path
from tallyflow.llm.toxicity import without_toxic

#: SQL cannot state these stages; the tests hold them against brute-force versions.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the nearest labelled examples do not call toxic.

    Null and empty texts have the prior's score and stay, unless most labels are toxic; repeated rows and rows without doc_id are
    judged each; without labels all stay. Other columns, whatever their names, are kept; an empty table gives none.
    """
    small_batches(spark)
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines that repeat earlier ones. A document goes if this leaves it without any word.

    Documents that lose nothing stay as they are, null and empty ones too. Of equal lines that of the least doc_id stays, null
    before all. Columns n_lines and n_kept of the input get the counts made here; other columns are kept; an empty table gives none.
    """
    small_batches(spark)
    names = docs.columns
    out = line_dedup(docs).where("n_kept = n_lines or text rlike '[^ \\\\t\\\\n\\\\x0B\\\\f\\\\r]'")
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near copies.

    Rows of one doc_id are one document and stay or go together; rows without doc_id are not compared and stay, as do null and
    empty texts. Other columns are kept; an empty table gives none.
    """
    small_batches(spark)
    copies = minhash_dedup(docs).where("not kept").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: whole, in part, or twice, with the places of their blocks in the output shards.

    Null and blank texts go; rows without doc_id or source are mixed like others; equal rows count each. A column ``places`` of
    the input is replaced, others are kept; an empty table gives none.
    """
    small_batches(spark)
    return mix_documents(docs, places=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens.

    Sequences are filled as full as can be, whatever shard the mix put a block in: ``places`` orders the mixed documents, not the
    sequences. Null texts are empty documents of one token; equal rows are packed each; an empty table gives none.
    """
    small_batches(spark)
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder where Spark finds it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("minhash_dedup", near_duplicates), ("source_mixing", mixing), ("best_fit_packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's rows are written as Parquet under the checkpoint folder and read by the next."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if done is not None:
            remove(spark, done)  # what the stage before wrote is read no more
        done = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
