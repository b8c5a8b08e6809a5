"""Small helpers of the operators: input tables, written intermediate tables, Arrow maps, bitmaps of hashes."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import work_folder

SLICE_BITS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Write a DataFrame to the shared work folder and read it back: cuts lineage, survives lost executors."""
    path = work_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(name: str):
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def append_columns(df: DataFrame, text: str, fields: str, make: Callable) -> DataFrame:
    """Add columns that ``make`` computes from the text column of each Arrow batch.

    All input columns pass through; one with the name of an added column is replaced.
    """
    added = T.StructType.fromDDL(fields)
    names = [f.name for f in added.fields]
    kept = [f for f in df.schema.fields if f.name not in names]
    source = df.select(*[column(f.name) for f in kept], column(text).cast("string").alias("__text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            arrays = make(batch.column(batch.num_columns - 1))
            columns = [batch.column(i) for i in range(len(kept))] + list(arrays)
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + names)

    return source.mapInArrow(run, T.StructType(kept + added.fields))


def small_batches(batches: Iterable[pa.RecordBatch], size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches to about ``size`` bytes, a row at least. Freed memory goes back to the system, as workers are used again."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        pa.default_memory_pool().release_unused()
    trim_memory()


def trim_memory() -> None:
    """Return what the C library holds of freed memory; it otherwise stays with the worker for later tasks."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# Bitmaps over hash cells. Each task counts the cells it saw and sends them by slice of 65,536
# cells; a slice's counts are added up in one task, whose input is at most one short row per
# flush and slice however often a value occurs.

PARTIAL = "slice int, cells binary"


def partial_cells(cells: np.ndarray, saturate: int) -> pa.RecordBatch | None:
    """Sorted cells of one task by slice; a cell occurs as often as it was counted, ``saturate`` times at most."""
    if not len(cells):
        return None
    cells = np.sort(cells)
    if len(cells) > saturate:
        new = np.concatenate((np.ones(saturate, bool), cells[saturate:] != cells[:-saturate]))
        cells = cells[new]
    slices = (cells >> SLICE_BITS).astype(np.int32)
    low = (cells & 0xFFFF).astype(np.uint16)
    at = np.flatnonzero(np.concatenate(([True], slices[1:] != slices[:-1])))
    bounds = np.append(at, len(low)).astype(np.int64) * 2
    packed = pa.Array.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(low.tobytes())]
    ).cast(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(slices[at]), packed], names=["slice", "cells"])


def merge_cells(partial: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """(slice, level, bits): for each level, which cells of a slice were counted that often, over all tasks."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, of = np.zeros(1 << SLICE_BITS, np.int64), None
        for batch in batches:
            for which, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                if which != of:
                    if of is not None:
                        yield finished(of, count)
                    count[:] = 0
                    of = which
                count += np.bincount(np.frombuffer(cells.as_buffer(), np.uint16), minlength=1 << SLICE_BITS)
        if of is not None:
            yield finished(of, count)

    def finished(of: int, count: np.ndarray) -> pa.RecordBatch:
        bits = [np.packbits(count >= level).tobytes() for level in levels]
        return pa.RecordBatch.from_arrays(
            [pa.array([of] * len(levels), pa.int32()), pa.array(levels, pa.int32()), pa.array(bits, pa.binary())],
            names=["slice", "level", "bits"],
        )

    tasks = int(partial.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = partial.repartition(tasks, "slice").sortWithinPartitions("slice")
    return dealt.mapInArrow(merge, "slice int, level int, bits binary")


def collect_bits(merged: DataFrame, levels: tuple[int, ...], bits: int) -> np.ndarray:
    """One row of 2^bits packed bits per level. The size is fixed by ``bits``, whatever the input."""
    out = np.zeros((len(levels), 1 << (bits - 3)), np.uint8)
    width = 1 << (SLICE_BITS - 3)
    for row in merged.collect():
        at = row["slice"] * width
        out[levels.index(row["level"]), at : at + width] = np.frombuffer(row["bits"], np.uint8)
    return out


def test_bits(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bits[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1


def width_bits(expected: int, least: int = 20, most: int = 28) -> int:
    """Bits of a sketch for an expected number of entries: it grows with the input up to 2^most cells."""
    return min(most, max(least, int(expected).bit_length()))


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(column(text).cast("string")))).first()[0] or 0


def ship_package(spark: SparkSession) -> SparkSession:
    """Give the executors this package's source, once per context: a cluster need not have it installed.

    Batches of whole texts are kept short, so that a worker's memory follows a few texts.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    context = spark.sparkContext
    if getattr(context, "_barloom_shipped", False):
        return spark
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="barloom-")) / "barloom_source.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(path))
    context._barloom_shipped = True
    return spark
