"""Line dedup: lines that many documents hold go from all of them but one, in built-in functions only.

Lines are exploded, their keys (trimmed, A-Z lower-cased) hashed to 128 bits, and distinct
documents counted per hash; only hashes, ids and places are shuffled for that. The places of
the lines to drop come back as one short row per text, and each text is put together again
from the places that stay. Texts are shuffled once.

A key that a large part of all lines share never meets in one task: counts are summed up
before each shuffle, and keys with more than 1/``HOT_KEYS`` of the repeated lines, which are
fewer than ``HOT_KEYS``, are looked up in a broadcast list of at most that many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.shared import column, table, written

MIN_CHARS = 20
MIN_DOCUMENTS = 3
HOT_KEYS = 1000
_SPACE = " \t\n\u000b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _keys(docs: DataFrame, id: str, text: str, min_chars: int) -> DataFrame:
    """(doc, which, place, h1, h2) of each line whose key is long enough; ``which`` tells texts of one id apart."""
    body = column(text).cast("string")
    # A line shorter than the least key cannot have one; this spares most short lines the work.
    lines = docs.select(column(id).alias("doc"), F.xxhash64(body).alias("which"), F.posexplode(F.split(body, "\n")).alias("place", "line"))
    key = F.translate(F.btrim("line", F.lit(_SPACE)), _UPPER, _LOWER)
    keyed = lines.where(F.length("line") >= min_chars).select("doc", "which", "place", key.alias("key")).where(F.length("key") >= min_chars)
    return keyed.select("doc", "which", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def repeated_keys(docs: DataFrame, id: str, text: str, min_chars: int, min_documents: int) -> DataFrame:
    """(h1, h2, n_docs, n_places, last) of the keys that at least ``min_documents`` documents hold; ``last`` is the largest id."""
    of_document = _keys(docs, id, text, min_chars).groupBy("h1", "h2", "doc").agg(F.count("*").alias("n"))
    return (
        of_document.groupBy("h1", "h2")
        .agg(F.count("doc").alias("n_docs"), F.sum("n").alias("n_places"), F.max("doc").alias("last"))
        .where(F.col("n_docs") >= min_documents)
    )


def drop_repeated_lines(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all, if not given) and n_lines, n_dropped and kept_text for each row.

    A null or empty text is one empty line. Rows of one id are one document, whose lines all
    stay if its id is the largest; rows without id count as no document, and lose what
    documents with ids repeat. Repeated rows come out alike and as often as they went in.
    Columns of ``docs`` with the name of an added one are replaced in the result; an empty table gives an empty one.
    """
    added = ["n_lines", "n_dropped", "kept_text"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    repeated = written(repeated_keys(docs, id, text, min_chars, min_documents), "repeated-lines")
    total = repeated.agg(F.sum("n_places")).first()[0] or 0
    hot = repeated.where(F.col("n_places") * HOT_KEYS > total)
    hot = F.broadcast(hot.select(F.col("h1").alias("hot1"), F.col("h2").alias("hot2"), F.col("last").alias("hot_last"), F.lit(True).alias("is_hot")))
    lines = _keys(docs, id, text, min_chars).join(hot, (F.col("h1") == F.col("hot1")) & (F.col("h2") == F.col("hot2")), "left")
    # Lines of hot keys have their answer already and are spread by their own place.
    lines = lines.select(
        "doc",
        "which",
        "place",
        F.when(F.col("is_hot"), F.xxhash64("doc", "which", "place")).otherwise(F.col("h1")).alias("to1"),
        "h2",
        F.coalesce("is_hot", F.lit(False)).alias("is_hot"),
        "hot_last",
    )
    others = repeated.where(F.col("n_places") * HOT_KEYS <= total).select(
        F.col("h1").alias("to1"), "h2", F.col("last").alias("cold_last"), F.lit(False).alias("is_hot"), F.lit(True).alias("is_cold")
    )
    found = lines.hint("merge").join(others.hint("merge"), ["to1", "h2", "is_hot"], "left").where(F.col("is_hot") | F.col("is_cold"))
    dropped = (
        found.where(~F.col("doc").eqNullSafe(F.coalesce("hot_last", "cold_last")))
        .groupBy(F.col("doc").alias("__doc"), F.col("which").alias("__which"))
        .agg(F.collect_set("place").alias("__dropped"))
    )
    body = column(text).cast("string")
    rows = docs.select(
        *[column(c) for c in keep],
        column(id).alias("__id"),
        F.coalesce(body, F.lit("")).alias("__text"),
        F.xxhash64(body).alias("__hash"),
    )
    same = F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__which"))
    parts = F.split("__text", "\n")
    out = rows.hint("merge").join(dropped.hint("merge"), same, "left").withColumn("__lines", parts)
    stays = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__dropped"))
    kept = F.array_join(F.transform(stays, lambda i: F.col("__lines")[i]), "\n")
    return out.select(
        *[column(c) for c in keep],
        F.size("__lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("__dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("__dropped").isNull(), F.col("__text")).otherwise(kept).alias("kept_text"),
    )


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_lines(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
