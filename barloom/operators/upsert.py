"""Keyed writes expressed as joins: the result is the next content of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(batch: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep each key's row that comes last in ``order_by``.

    An aggregate rather than a window: a key repeated many times is reduced in every
    map task, so one row per key and task is shuffled.
    """
    rest = [c for c in batch.columns if c not in key]
    kept = batch.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order_by)).alias("_kept"))
    return kept.select(*[c if c in key else F.col("_kept").getField(c).alias(c) for c in batch.columns])


def upsert(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``batch`` replacing those of the same key. Batch keys must be unique.

    The target only takes part in an anti join on the key, so a small batch is
    broadcast and the target is not shuffled.
    """
    return absent(batch, target, key).unionByName(batch)


def insert_if_absent(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """``target`` plus those rows of ``batch`` whose key it does not hold."""
    return target.unionByName(absent(target, batch, key))


def absent(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    return batch.join(target.select(*key), list(key), "left_anti")


def upsert_keeping(
    target: DataFrame, batch: DataFrame, key: Sequence[str], carried: dict[str, Column]
) -> DataFrame:
    """Upsert in which some columns are not taken from the batch.

    ``carried`` maps such a column to the value used for a new key; a known key keeps
    what the target holds. One full outer join on unique keys.
    """
    replaced = [c for c in target.columns if c not in key and c not in carried]
    old = target.select(*key, F.struct(*replaced, *carried).alias("_old"))
    new = batch.select(*key, F.struct(*replaced).alias("_new"))
    both = old.join(new, list(key), "full_outer")
    out = []
    for name in target.columns:
        if name in key:
            out.append(F.col(name))
        elif name in carried:
            was_known = F.col("_old").isNotNull()
            out.append(F.when(was_known, F.col("_old").getField(name)).otherwise(carried[name]).alias(name))
        else:
            in_batch = F.col("_new").isNotNull()
            out.append(
                F.when(in_batch, F.col("_new").getField(name)).otherwise(F.col("_old").getField(name)).alias(name)
            )
    return both.select(*out)


def delete_rows(target: DataFrame, condition: Column) -> DataFrame:
    """``target`` without the rows for which ``condition`` holds."""
    return target.where(~F.coalesce(condition, F.lit(False)))


def delete_keys(target: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """``target`` without the rows whose key is in ``keys``; NULL keys match nothing."""
    return target.join(keys.select(*on), list(on), "left_anti")
