"""The corpus pipeline: documents to packed training sequences, each stage a Spark job over the written result of the one before.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the
columns of documents. ``n_chars`` follows the text where a stage changes it. Nulls, empty and very long
texts, repeated rows and empty tables pass through each stage as its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import ngram_join, packing, secret_scan, substring_dedup, toxicity
from barloom.llm.shared import column, ship_package, table, written

#: Near duplicates share this many words in a row, in at least this percentage of all such runs of both.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not predicted to be toxic; labels teach the models.

    Null and empty texts are not toxic unless most labelled texts are; repeated rows go or stay together.
    """
    ship_package(spark)
    found = toxicity.score(_wrapped(docs), table(spark, sf_dir, "labels"), keep=[ROW, "text"])
    return _unwrapped(found.where("predicted = 0"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of documents linked by similar runs of words: that of the smallest id.

    Texts without words link with nothing and all stay. Rows of a group with the same id and text are one.
    """
    ship_package(spark)
    return ngram_join.keep_one(docs, n=NEAR_WORDS, percent=NEAR_PERCENT)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts without words that a repeated window covers; other texts, null ones too, stay as they are."""
    ship_package(spark)
    found = substring_dedup.remove_repeated(_wrapped(docs), keep=[ROW, "text"])
    changed = F.col("n_removed") > 0
    return _unwrapped(found, docs, F.when(changed, F.col("kept_text")).otherwise(F.col("text")), changed)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, each secret of their texts replaced by a mark; null and empty texts stay as they are."""
    ship_package(spark)
    found = secret_scan.redact(_wrapped(docs))
    return _unwrapped(found, docs, F.col("redacted"), F.col("n_secrets") > 0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts' token ids and their places in packed sequences; null texts count as empty."""
    ship_package(spark)
    return packing.pack(docs.select("doc_id", "text"))


ROW = "__row"


def _wrapped(docs: DataFrame) -> DataFrame:
    """The id, the text and all other columns as one, so that none can clash with a column that an operator adds."""
    others = [column(c).alias(c) for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*others).alias(ROW))


def _unwrapped(found: DataFrame, docs: DataFrame, text=None, changed=None) -> DataFrame:
    """The columns of ``docs`` again, with a new text, if given, and the number of characters of changed texts."""
    out = {c: F.col(ROW).getField(c) for c in docs.columns if c != "text"}
    out["text"] = F.col("text") if text is None else text
    if text is not None and "n_chars" in out:
        out["n_chars"] = F.when(changed, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(out["n_chars"])
    return found.select(*[out[c].alias(c) for c in docs.columns])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: Learned models and token ids are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
