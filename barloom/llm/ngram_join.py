"""N-gram Jaccard join: documents whose word 4-gram sets are at least 85 % alike, as components of links.

Unique grams first. Two sets of sizes a and b link when they share at least
T = ceil(0.85 max(a, b)) grams, so a document with more than n - T grams that no other has
links with nothing and is done. Half of all grams (by hash) are counted for that: blocks of documents
send cells of 16 bits by slice, slices send back which occurred once. The number of slices grows with the
text, so as many unique grams are seen at any size, and no task or driver holds more than a slice and the sums of some blocks.

T-occurrence search among the rest. Each link's documents meet in the inverted list of one of
the first n - T + 1 grams of either document, grams being in one order for all documents:
grams that one document has, then rare grams, then common ones (from a count sketch that
never underestimates). A gram of one document needs no list. Gram sets are written once; steps
that need some of them pick these where they read, by a bitmap of vertices, before any shuffle.

* Short lists (at most ``SHORT`` documents by the sketch) are merged by a shuffle: pairs
  that meet in one are candidates, at most ``SHORT`` / 2 a posting; they are verified by
  probing one gram set with the other.
* Documents that meet in long lists form groups, which are cut into blocks of similar size by
  number of grams. Each pair of blocks that may link runs DivideSkip in a task: it merges the
  short lists of a query document, keeps those that occur T - L times, and probes the L
  longest lists by binary search. A task returns the edges of a spanning forest of its links.

Documents with equal sets are one vertex throughout. Sets compare by 64-bit gram hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import words as W
from barloom.llm.graph import components
from barloom.llm.shared import (
    PARTIAL,
    SLICE_BITS,
    collect_bits,
    column,
    merge_cells,
    partial_cells,
    small_batches,
    table,
    test_bits,
    text_bytes,
    width_bits,
    written,
)

GRAM = 4
PERCENT = 85
SHORT = 32
#: Documents and bytes of grams of a block, about.
BLOCK_ROWS, BLOCK_BYTES = 2000, 16 << 20
#: Cells a task counts before it sends them on.
FLUSH = 2_000_000
#: Documents of a block whose unique grams are counted together: their numbers have 16 bits.
BLOCK_DOCS = 1 << 16
_U = np.uint64
_GRAM_BASE = 0xC2B2AE3D27D4EB4F | 1


def gram_sets(block: W.Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct gram hashes of each text, one after the other, and their bounds.

    A text of fewer than n words has its whole word sequence as its gram; without words none.
    """
    h, counts = block.hashes(W.LOWER), block.counts
    grams = W.gram_hashes(h, n, _GRAM_BASE)
    size = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(bounds[-1], np.uint64)
    room = block.room()
    long = (room >= n)[: len(grams)]
    whole = np.repeat(counts >= n, size)
    out[whole] = grams[long]
    for k in range(1, n):
        of = np.flatnonzero(counts == k)
        value = h[block.first[of]]
        for j in range(1, k):
            value = value * _U(_GRAM_BASE) + h[block.first[of] + j]
        out[bounds[of]] = W.mix(value ^ W.mix(np.full(len(of), k + 1, np.uint64)))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            out[a:b].sort()
    new = np.ones(len(out), bool)
    if len(out):
        new[1:] = out[1:] != out[:-1]
        new[bounds[:-1][size > 0]] = True
    kept = np.concatenate(([0], np.cumsum(new)))
    return out[new], kept[bounds]


def required(n: np.ndarray, percent: int) -> np.ndarray:
    return (percent * n + 99) // 100


def _by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _keys(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set, whatever the order of its grams."""
    size = np.diff(bounds).astype(np.uint64)
    return W.mix(_by_text(W.mix(grams ^ _U(0x5851F42D4C957F2D)), bounds) ^ W.mix(size))


def _binaries(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Binary values that begin at the given places of an array, each up to the next."""
    bounds = np.append(at, len(values)).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(values.tobytes())]
    ).cast(pa.binary())


def _flat(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed binaries, and how many each row has."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    size = np.diff(offsets) // np.dtype(dtype).itemsize
    if not size.sum():
        return np.zeros(0, dtype), size
    return np.frombuffer(column.buffers()[2], dtype, int(size.sum()), int(offsets[0])), size


#: A block's row for each slice: cells and the block's documents that have them. In a row with a slice below 0, keys and sizes of its documents.
_CELLS = "slice long, block long, cells binary, docs binary"
_COUNTS = "block long, keys binary, sizes binary, counts binary"


def _block_cells(n: int, bits: int):
    """Texts to the cells of every second gram (by hash), block by block."""
    most_docs, most_cells = BLOCK_DOCS, FLUSH

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        keys, sizes, cells = [], [], []  # a cell and, in its last 16 bits, the document
        n_docs = n_cells = 0

        def flush() -> Iterator[pa.RecordBatch]:
            key, size, cell = (np.concatenate(x) for x in (keys, sizes, cells))
            for x in (keys, sizes, cells):
                x.clear()
            # A task that runs again gives a block of the same documents the same name, and another one another name.
            mark = W.mix(key + W.mix(np.arange(len(key), dtype=np.uint64) + _U(task << 32)))
            block = int(W.mix(np.array([mark.sum(dtype=np.uint64)])).view(np.int64)[0])
            names = ["slice", "block", "cells", "docs"]
            spread = pa.array([-1 - (block & 0x7FFFFFFF)], pa.int64())
            head = [pa.array([x.tobytes()], pa.binary()) for x in (key, size)]
            yield pa.RecordBatch.from_arrays([spread, pa.array([block], pa.int64()), *head], names=names)
            cell.sort()
            if len(cell) > 2:  # two of a cell tell that it is not unique
                cell = cell[np.concatenate(([True, True], cell[2:] >> _U(16) != cell[:-2] >> _U(16)))]
            if len(cell):
                of = (cell >> _U(16 + SLICE_BITS)).astype(np.int64)
                at = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
                low, doc = (cell >> _U(16)).astype(np.uint16), cell.astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of[at]), pa.array(np.full(len(at), block)), _binaries(low, at), _binaries(doc, at)], names=names
                )

        for batch in small_batches(batches):
            for begin in range(0, batch.num_rows, most_docs):
                for block in W.blocks(batch.column(0).slice(begin, most_docs)):
                    grams, bounds = gram_sets(block, n)
                    size = np.diff(bounds)
                    if keys and (n_docs + len(size) > most_docs or n_cells >= most_cells):
                        yield from flush()
                        n_docs = n_cells = 0
                    half = grams & _U(1) == 0
                    keys.append(_keys(grams, bounds))
                    sizes.append(size.astype(np.int64))
                    of = np.repeat(np.arange(n_docs, n_docs + len(size), dtype=np.uint64), size)[half]
                    cells.append((grams[half] >> _U(64 - bits) << _U(16)) | of)
                    n_docs, n_cells = n_docs + len(size), n_cells + len(cells[-1])
        if keys:
            yield from flush()

    return run


def _block_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_CELLS``, sorted by slice, to ``_COUNTS``: how many cells of each document no other has, up to 255."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    rest: list[pa.RecordBatch] = []

    def resolve(rows: pa.RecordBatch) -> None:
        cells, size = _flat(rows.column(2), np.uint16)
        of = rows.column(0).to_numpy()
        rank = np.cumsum(np.concatenate(([0], of[1:] != of[:-1])))
        key = (np.repeat(rank, size) << SLICE_BITS) | cells
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1], [True]))
        alone = order[new[:-1] & new[1:]]
        found.append((np.repeat(rows.column(1).to_numpy(), size)[alone], _flat(rows.column(3), np.uint16)[0][alone]))

    def taken() -> pa.RecordBatch:
        block, doc = (np.concatenate(x) for x in zip(*found))
        found.clear()
        order = np.argsort(block, kind="stable")
        block, doc = block[order], doc[order]
        at = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        counts = [np.minimum(np.bincount(d), 255).astype(np.uint8).tobytes() for d in np.split(doc, at[1:])]
        none = pa.nulls(len(at), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(block[at]), none, none, pa.array(counts, pa.binary())], names=["block", "keys", "sizes", "counts"]
        )

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(rest).combine_chunks().to_batches()[0]

    for batch in small_batches(batches):
        slices = batch.column(0).to_numpy()
        heads = int(np.searchsorted(slices, 0))
        if heads:
            head = batch.slice(0, heads)
            yield pa.RecordBatch.from_arrays(
                [head.column(1), head.column(2), head.column(3), pa.nulls(heads, pa.binary())],
                names=["block", "keys", "sizes", "counts"],
            )
            batch = batch.slice(heads)
        if not batch.num_rows:
            continue
        if rest and rest[0].column(0)[0].as_py() != batch.column(0)[0].as_py():
            resolve(joined())
            rest.clear()
        slices = batch.column(0).to_numpy()
        last = int(np.searchsorted(slices, slices[-1]))  # rows of the last slice may follow in the next batch
        if last:
            rest.append(batch.slice(0, last))
            resolve(joined())
            rest.clear()
        rest.append(batch.slice(last))
        if sum(len(x) for _, x in found) >= FLUSH // 2:
            yield taken()
    if rest:
        resolve(joined())
    if sum(len(x) for _, x in found):
        yield taken()


def _may_link(percent: int):
    """Rows of ``_COUNTS``, sorted by block, to the keys of the documents that are not too unique to link."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, key, size, unique = None, None, None, np.zeros(BLOCK_DOCS, np.int64)

        def linked() -> pa.RecordBatch:
            stays = (size > 0) & (unique[: len(size)] <= size - required(size, percent))
            return pa.RecordBatch.from_arrays([pa.array(key[stays])], names=["k"])

        for batch in batches:
            for block, keys, sizes, counts in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if block != of:
                    if key is not None:
                        yield linked()
                    of, key = block, None
                    unique[:] = 0
                if keys is not None:
                    key, size = np.frombuffer(keys, np.int64), np.frombuffer(sizes, np.int64)
                if counts is not None:
                    unique[: len(counts)] += np.frombuffer(counts, np.uint8)
        if key is not None:
            yield linked()

    return run


def _candidates(texts: DataFrame, n: int, percent: int, text_size: int) -> DataFrame:
    """(k): the key of each document that may link with another or equals it; repeated."""
    bits = width_bits(text_size // 12, most=38) + 2
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = texts.mapInArrow(_block_cells(n, bits), _CELLS).repartition(tasks, "slice").sortWithinPartitions("slice")
    counts = cells.mapInArrow(_block_counts, _COUNTS).repartition(tasks, "block").sortWithinPartitions("block")
    return counts.mapInArrow(_may_link(percent), "k long")


class Bitmap:
    """A broadcast set of 64-bit numbers: all that were put in, and few others."""

    def __init__(self, keys: DataFrame):
        """``keys``: a stored table with one column of longs."""
        self.bits = bits = width_bits(16 * keys.count())

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in small_batches(batches):
                if batch.num_rows:
                    cells = W.mix(batch.column(0).to_numpy().view(np.uint64)) >> _U(64 - bits)
                    yield partial_cells(cells.astype(np.uint32), 1)

        merged = merge_cells(keys.mapInArrow(run, PARTIAL), (1,))
        self.sent = keys.sparkSession.sparkContext.broadcast(collect_bits(merged, (1,), bits)[0])

    def has(self, numbers: np.ndarray) -> np.ndarray:
        return test_bits(self.sent.value, W.mix(numbers.view(np.uint64)) >> _U(64 - self.bits))


def _shingle(n: int, candidates: Bitmap):
    """Rows of (id, h, text) to (id, h, v, n, active, tokens): the gram sets of candidates."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for block in W.blocks(batch.column(2)):
                grams, bounds = gram_sets(block, n)
                size = np.diff(bounds)
                key = _keys(grams, bounds)
                active = candidates.has(key) & (size > 0)
                tokens: list[bytes | None] = [None] * len(size)
                for i in np.flatnonzero(active):
                    tokens[i] = grams[bounds[i] : bounds[i + 1]].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.rows.start, len(size)),
                        batch.column(1).slice(block.rows.start, len(size)),
                        pa.array(key.view(np.int64)),
                        pa.array(size.astype(np.int64)),
                        pa.array(active),
                        pa.array(tokens, pa.binary()),
                    ],
                    names=["id", "h", "v", "n", "active", "tokens"],
                )

    return run


def _picked(vertices: Bitmap, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of batches whose first column numbers the written rows, one row of each vertex (or, seldom, more)."""
    for batch in small_batches(batches):
        yield batch.filter(pa.array(vertices.has(batch.column(0).to_numpy())))


def _count_grams(vertices: Bitmap, bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in _picked(vertices, batches):
            held.append((_flat(batch.column(1), np.uint64)[0] >> _U(64 - bits)).astype(np.uint32))
            size += len(held[-1])
            if size >= FLUSH:
                yield partial_cells(np.concatenate(held), SHORT + 1)
                held, size = [], 0
        if size:
            yield partial_cells(np.concatenate(held), SHORT + 1)

    return run


def _postings(vertices: Bitmap, percent: int, bits: int, sketch):
    """The inverted lists' entries of each vertex: its first grams in the order of the module, without those it alone has."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, common = sketch.value
        for batch in _picked(vertices, batches):
            v, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            grams, size = _flat(batch.column(3), np.uint64)
            bounds = np.concatenate(([0], np.cumsum(size)))
            cells = grams >> _U(64 - bits)
            again, often = test_bits(repeated, cells), test_bits(common, cells)
            need = n - required(n, percent) + 1 - _by_text((~again).astype(np.int64), bounds)
            heads, long = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
            taken = np.zeros(len(n), np.int64)
            for i in np.flatnonzero(need > 0):
                at = slice(bounds[i], bounds[i + 1])
                rare, frequent = grams[at][again[at] & ~often[at]], grams[at][often[at]]
                heads.append(np.concatenate((rare, frequent))[: need[i]])
                long.append(np.arange(len(heads[-1])) >= len(rare))
                taken[i] = len(heads[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(heads).view(np.int64)),
                    pa.array(np.concatenate(long)),
                    pa.array(np.repeat(v, taken)),
                    pa.array(np.repeat(n, taken)),
                ],
                names=["gram", "long", "v", "n"],
            )

    return run


def _chosen(rows: DataFrame, vertices: Bitmap, wanted: DataFrame) -> DataFrame:
    """(v, n, tokens) of the vertices in a stored table of one column, and of few others."""
    some = Bitmap(wanted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _picked(vertices, batches):
            yield batch.select([1, 2, 3]).filter(pa.array(some.has(batch.column(1).to_numpy())))

    return rows.mapInArrow(run, "v long, n long, tokens binary")


def _verify(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            keep = []
            nu, nv = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for i in range(batch.num_rows):
                a = np.frombuffer(batch.column(4)[i].as_buffer(), np.uint64)
                b = np.sort(np.frombuffer(batch.column(5)[i].as_buffer(), np.uint64))
                at = np.searchsorted(b, a)
                both = int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
                keep.append(100 * both >= percent * (nu[i] + nv[i] - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def divide_skip(sets: list[np.ndarray], sizes: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between documents of a block pair.

    ``side``: 0 for documents of the first block, 1 for the second; if both blocks are the
    same, all are 0 and each document is searched for among those before it.
    """
    same = not side.any()
    index = np.arange(len(sets)) if same else np.flatnonzero(side == 1)
    queries = np.arange(len(sets)) if same else np.flatnonzero(side == 0)
    if not len(index) or not len(queries):
        return []
    flat = np.concatenate([sets[i] for i in index])
    owner = np.repeat(index, [len(sets[i]) for i in index])
    order = np.lexsort((owner, flat))
    flat, owner = flat[order], owner[order]
    heads = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1]))) if len(flat) else np.zeros(0, np.int64)
    grams, ends = flat[heads], np.append(heads[1:], len(flat))
    parent = np.arange(len(sets))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for q in queries.tolist():
        need = int(required(sizes[q], percent))
        at = np.searchsorted(grams, sets[q])
        hit = at[(at < len(grams))]
        hit = hit[grams[hit] == sets[q][at < len(grams)]]
        if len(hit) < need:
            continue
        length = ends[hit] - heads[hit]
        hit = hit[np.argsort(length, kind="stable")]
        longest = int(length.max())
        # The number of long lists that balances merging against probing.
        skip = min(need - 1, len(hit) - 1, int(need / (0.1 * np.log2(longest + 1) + 1)))
        short, long = hit[: len(hit) - skip], hit[len(hit) - skip :]
        merged = np.sort(np.concatenate([owner[heads[j] : ends[j]] for j in short]), kind="stable")
        if same:
            merged = merged[: np.searchsorted(merged, q)]
        if not len(merged):
            continue
        runs = np.flatnonzero(np.concatenate(([True], merged[1:] != merged[:-1])))
        found, times = merged[runs], np.diff(np.append(runs, len(merged)))
        ok = times >= need - skip
        found, times = found[ok], times[ok]
        for left, j in zip(range(skip - 1, -1, -1), long):
            if not len(found):
                break
            posting = owner[heads[j] : ends[j]]
            spot = np.searchsorted(posting, found)
            times = times + (posting[np.minimum(spot, len(posting) - 1)] == found)
            ok = times + left >= need
            found, times = found[ok], times[ok]
        linked = found[100 * times >= percent * (sizes[q] + sizes[found] - times)]
        for d in linked.tolist():
            a, b = find(q), find(d)
            if a != b:
                parent[max(a, b)] = min(a, b)
                edges.append((q, d))
    return edges


def _search_blocks(percent: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        v, n, side = (group.column(name).to_numpy() for name in ("v", "n", "side"))
        sets = [np.frombuffer(t.as_buffer(), np.uint64) for t in group.column("tokens")]
        edges = np.array(divide_skip(sets, n, side, percent), np.int64).reshape(-1, 2)
        return pa.table({"u": pa.array(v[edges[:, 0]]), "v": pa.array(v[edges[:, 1]])})

    return run


def _short_list_links(postings: DataFrame, rows: DataFrame, vertices: Bitmap, percent: int) -> DataFrame:
    member = F.struct("v", "n")
    lists = (
        postings.where(~F.col("long")).groupBy("gram").agg(F.sort_array(F.collect_set(member)).alias("l")).where(F.size("l") > 1)
    )
    first = lists.select("l", F.posexplode("l").alias("i", "a"))
    pairs = first.select("a", F.explode(F.slice("l", F.col("i") + 2, F.size("l"))).alias("b")).where(
        100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")
    )
    pairs = pairs.select(F.col("a.v").alias("u"), F.col("b.v").alias("v"), F.col("a.n").alias("nu"), F.col("b.n").alias("nv")).distinct()
    pairs = written(pairs, "pairs")
    left = _chosen(rows, vertices, pairs.select("u")).select(F.col("v").alias("u"), F.col("tokens").alias("tu"))
    right = _chosen(rows, vertices, pairs.select("v")).select("v", F.col("tokens").alias("tv"))
    both = pairs.join(left, "u").join(right, "v").select("u", "v", "nu", "nv", "tu", "tv")
    return both.mapInArrow(_verify(percent), "u long, v long")


def _long_list_links(postings: DataFrame, rows: DataFrame, vertices: Bitmap, percent: int) -> DataFrame:
    entries = postings.where("long").select("gram", "v")
    hubs = entries.groupBy("gram").agg(F.min("v").alias("u"), F.count("*").alias("c")).where("c > 1")
    group = written(components(entries.join(hubs, "gram").select("u", "v")), "groups")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent))).cast("int")
    members = _chosen(rows, vertices, group.select("v")).join(group, "v").select("root", "v", "n", "tokens", band.alias("band"))
    parts = F.ceil(
        F.greatest(F.count("*") / F.lit(BLOCK_ROWS), F.sum(F.octet_length("tokens")) / F.lit(BLOCK_BYTES))
    ).cast("int")
    counts = members.groupBy("root", "band").agg(parts.alias("parts"))
    mine = counts.withColumnRenamed("parts", "k")
    up = counts.select("root", (F.col("band") - 1).alias("band"), F.col("parts").alias("k_up"))
    down = counts.select("root", (F.col("band") + 1).alias("band"), F.col("parts").alias("k_down"))
    around = mine.join(up, ["root", "band"], "left").join(down, ["root", "band"], "left").na.fill(0, ["k_up", "k_down"])
    own = F.pmod(F.xxhash64("v"), F.col("k")).cast("int").alias("own")
    placed = members.join(around, ["root", "band"]).select("*", own)
    # Block pairs: a block with itself, with later blocks of its band, and with all blocks of the next band.
    tasks = F.filter(
        F.concat(
            F.transform(
                F.sequence(F.lit(0), F.col("k") - 1),
                lambda o: F.struct(
                    F.col("band").alias("band"),
                    F.least("own", o).alias("a"),
                    F.lit(0).alias("step"),
                    F.greatest("own", o).alias("b"),
                    F.when(F.col("own") > o, 1).otherwise(0).alias("side"),
                ),
            ),
            F.transform(
                F.sequence(F.lit(0), F.greatest("k_up", F.lit(1)) - 1),
                lambda o: F.struct(
                    F.col("band").alias("band"),
                    F.col("own").alias("a"),
                    F.when(F.col("k_up") > 0, 1).otherwise(-1).alias("step"),
                    o.alias("b"),
                    F.lit(0).alias("side"),
                ),
            ),
            F.transform(
                F.sequence(F.lit(0), F.greatest("k_down", F.lit(1)) - 1),
                lambda o: F.struct(
                    (F.col("band") - 1).alias("band"),
                    o.alias("a"),
                    F.when(F.col("k_down") > 0, 1).otherwise(-1).alias("step"),
                    F.col("own").alias("b"),
                    F.lit(1).alias("side"),
                ),
            ),
        ),
        lambda x: x["step"] >= 0,
    )
    dealt = placed.select("root", "v", "n", "tokens", F.explode(tasks).alias("t")).select("root", "t.*", "v", "n", "tokens")
    return dealt.groupBy("root", "band", "a", "step", "b").applyInArrow(_search_blocks(percent), "u long, v long")


def _components(docs: DataFrame, id: str, text: str, n: int, percent: int) -> DataFrame:
    """(id, text_hash, v, n, root, component): root is equal for the rows of one component."""
    spark = docs.sparkSession
    rows = docs.select(
        column(id).alias("id"), F.xxhash64(column(text).cast("string")).alias("h"), column(text).cast("string").alias("text")
    )
    candidates = Bitmap(written(_candidates(rows.select("text"), n, percent, text_bytes(docs, text)), "candidates"))
    schema = T.StructType(
        [rows.schema["id"], *T.StructType.fromDDL("h long, v long, n long, active boolean, tokens binary").fields]
    )
    found = rows.mapInArrow(_shingle(n, candidates), schema).withColumn("row", F.monotonically_increasing_id())
    found = written(found, "grams")
    candidates.sent.destroy()
    active = found.where("active")
    vertices = Bitmap(written(active.groupBy("v").agg(F.min("row").alias("row")).select("row"), "vertices"))
    bits = width_bits((active.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0) // 8)
    levels = (2, SHORT + 1)
    partial = active.select("row", "tokens").mapInArrow(_count_grams(vertices, bits), PARTIAL)
    sketch = spark.sparkContext.broadcast(collect_bits(merge_cells(partial, levels), levels, bits))
    sets = active.select("row", "v", "n", "tokens")
    entries = sets.mapInArrow(_postings(vertices, percent, bits, sketch), "gram long, long boolean, v long, n long")
    postings = written(entries, "postings")
    sketch.destroy()
    links = _short_list_links(postings, sets, vertices, percent).union(_long_list_links(postings, sets, vertices, percent))
    ids = active.groupBy("v").agg(F.min("id").alias("least"))
    labelled = ids.join(components(links), "v", "left").select("v", "least", F.coalesce("root", "v").alias("root"))
    first = labelled.groupBy("root").agg(F.min("least").alias("component"))
    by_vertex = labelled.join(first, "root").select("v", "root", "component")
    many = active.select("id", "h", "v", "n").join(by_vertex, "v").select("id", "h", "v", "n", "root", "component")
    return many.union(
        found.where(~F.col("active")).select("id", "h", "v", "n", F.lit(None).cast("long").alias("root"), F.col("id").alias("component"))
    )


def jaccard_components(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) for each row of ``docs``.

    ``component_id`` is the smallest id reachable by links, the row's own included; null ids
    never count as smallest, and a component of null ids has a null one. Null and empty
    texts have no grams and link with nothing. Rows may repeat, ids too; other columns of
    ``docs`` are not read. An empty table gives an empty one.
    """
    found = _components(docs, id, text, n, percent)
    return found.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps the row of its smallest id (nulls last).

    Of rows of a component with the same id and text one stays; rows without words link with nothing and all
    stay, however alike. All columns are kept.
    """
    found = _components(docs, id, text, n, percent).where(F.col("root").isNotNull())
    copies = found.groupBy("root", "id", "h").agg(F.count("*").alias("copies"))
    rank = F.struct(F.col("id").isNull().alias("z"), F.col("id").alias("id"), F.col("h").alias("h"))
    best = copies.groupBy("root").agg(F.min(rank).alias("best"))
    stays = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("h") == F.col("best.h"))
    marks = copies.join(best, "root").select(F.col("id").alias("__id"), F.col("h").alias("__h"), stays.alias("__stays"), "copies")
    marks = written(marks.where(~F.col("__stays") | (F.col("copies") > 1)), "marks")
    names = docs.columns
    row = F.struct(*[column(c) for c in names]).alias("row")
    named = docs.select(column(id).alias("id"), F.xxhash64(column(text).cast("string")).alias("hash"), row)
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("__h"))
    untouched = named.join(marks, same, "left_anti")
    repeated = named.join(marks.where("__stays"), same, "left_semi").dropDuplicates(["id", "hash"])
    return untouched.unionByName(repeated).select(*[F.col("row").getField(c).alias(c) for c in names])


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")
