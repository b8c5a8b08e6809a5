"""Best-fit packing: tokenise documents and pack their pieces into as few sequences as possible.

Pattern packing by non-negative least squares. What is solved depends on the histogram of
piece lengths alone, which has at most as many entries as a sequence has tokens, at any
scale: patterns of two to four lengths that fill a sequence (or nearly) are enumerated,
repeat counts are fitted to the histogram by non-negative least squares and rounded down,
and what is left is packed best-fit, longest first, into the gaps and new sequences, all as
counts of equal sequences. Each piece then finds its place from its rank among the pieces
of its length; ranks are counted in hash buckets, so no length's pieces meet in one task.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import words as W
from barloom.llm.shared import column, small_batches, table, written

CAPACITY = 2048
END = 0
#: Different words whose ids a worker keeps.
KNOWN_WORDS = 1_500_000
#: Pieces of a rank bucket, about.
BUCKET_ROWS = 100_000
_U = np.uint64


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of words, each encoded once. White space never joins tokens of this kind of vocabulary."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.bounds = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def slots(self, block: W.Block) -> np.ndarray:
        """For each word of a block, its entry in ``bounds`` and ``ids``."""
        keys, first, back = np.unique(block.hashes(), return_index=True, return_inverse=True)
        if len(self.keys) > KNOWN_WORDS:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        fresh = np.flatnonzero(~known)
        if len(fresh):
            raw = block.data.tobytes()
            starts, ends = block.start[first[fresh]].tolist(), block.end[first[fresh]].tolist()
            texts = [raw[a:b].decode(errors="replace") for a, b in zip(starts, ends)]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            base = len(self.bounds) - 1
            self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))
            flat = np.fromiter((i for word in ids for i in word), np.uint32, int(sizes.sum()))
            self.ids = np.concatenate((self.ids, flat))
            merged = np.concatenate((self.keys, keys[fresh]))
            order = np.argsort(merged, kind="stable")
            self.slot = np.concatenate((self.slot, np.arange(base, base + len(fresh))))[order]
            self.keys = merged[order]
        return self.slot[np.searchsorted(self.keys, keys)][back]

    def texts(self, block: W.Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text, with the end mark, one after the other, and their bounds."""
        slot = self.slots(block)
        size = self.bounds[slot + 1] - self.bounds[slot]
        before = np.concatenate(([0], np.cumsum(size)))
        ends = before[block.first[1:]] + np.arange(1, len(block.first))
        bounds = np.concatenate(([0], ends))
        out = np.full(bounds[-1], END, np.uint32)
        text = block.text_of_word()
        target = np.arange(before[-1]) + np.repeat(text, size)
        source = np.arange(before[-1]) - np.repeat(before[:-1] - self.bounds[slot], size)
        out[target] = self.ids[source]
        return out, bounds


_encoders: dict[str, WordEncoder] = {}


def _encoder(definition: str) -> WordEncoder:
    """One encoder a worker process, which serves one task after the other: words stay known."""
    if definition not in _encoders:
        _encoders.clear()
        _encoders[definition] = WordEncoder(definition)
    return _encoders[definition]


def _pieces(definition, capacity: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        for batch in small_batches(batches):
            for block in W.blocks(batch.column(1), size=2 * W.BLOCK_BYTES):
                ids, bounds = encoder.texts(block)
                size = np.diff(bounds)
                count = -(-size // capacity)
                text = np.repeat(np.arange(len(size)), count)
                piece = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(capacity, size[text] - start)
                at = bounds[text] + start
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
                id = batch.column(0).slice(block.rows.start, len(size))
                yield pa.RecordBatch.from_arrays(
                    [
                        pc.take(id, pa.array(text)),
                        *(pa.array(x.astype(t)) for x, t in ((piece, np.int32), (start, np.int64), (length, np.int64))),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def patterns(present: np.ndarray, weight: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Combinations of two to four present lengths, longest first, that leave the least room."""
    present = np.sort(present)
    often = present[np.argsort(-weight, kind="stable")[:24]] if len(present) else present

    def fitting(room: int) -> int | None:
        at = np.searchsorted(present, room, "right") - 1
        return int(present[at]) if at >= 0 else None

    found = set()
    for a in present.tolist():
        others = [()] + [(int(b),) for b in often] + [(int(b), int(c)) for b in often[:8] for c in often[:8]]
        for more in others:
            last = fitting(capacity - a - sum(more)) if a + sum(more) < capacity else None
            if last is not None:
                found.add(tuple(sorted((a, *more, last), reverse=True)))
    return sorted(found, reverse=True)


def fit_counts(combos: list[tuple[int, ...]], histogram: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Non-negative least squares: counts x of the patterns with A x near the histogram (projected, accelerated gradient)."""
    width = max(map(len, combos))
    items = np.zeros((len(combos), width), np.int64)
    for i, combo in enumerate(combos):
        items[i, : len(combo)] = combo
    used = items > 0
    scale = histogram.sum() or 1.0
    target = histogram / scale
    # Row sums of A'A bound the step that each count may take.
    share = np.bincount(items[used], minlength=len(histogram)).astype(float)
    step = 1.0 / (1e-12 + np.where(used, share[items], 0).sum(1))
    x = np.zeros(len(combos))
    y, t = x, 1.0
    for _ in range(rounds):
        made = np.bincount(items[used], weights=np.repeat(y, used.sum(1)), minlength=len(histogram))
        error = made - target
        new = np.maximum(0.0, y - step * np.where(used, error[items], 0.0).sum(1))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = np.maximum(0.0, new + (t - 1) / t_new * (new - x))
        x, t = new, t_new
    return x * scale


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Layouts: (lengths in order, number of sequences laid out so), over all pieces of the histogram."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    open_bins: dict[tuple[int, ...], int] = Counter()
    done: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        done.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    present = np.flatnonzero(left)
    combos = patterns(present, left[present], capacity)
    if combos:
        counts = np.floor(fit_counts(combos, left.astype(float))).astype(np.int64)
        room = np.array([capacity - sum(c) for c in combos])
        for i in np.lexsort((-counts, room)).tolist():
            if counts[i] <= 0:
                continue
            need = Counter(combos[i])
            n = min(int(counts[i]), *(int(left[length]) // k for length, k in need.items()))
            if n > 0:
                open_bins[combos[i]] += n
                for length, k in need.items():
                    left[length] -= n * k
    # Best fit, longest first. Bins of the same layout are handled together.
    by_room: dict[int, Counter] = {}
    rooms = np.zeros(capacity + 1, bool)

    def put(layout: tuple[int, ...], n: int) -> None:
        free = capacity - sum(layout)
        if free == 0:
            done.append((layout, n))
            return
        by_room.setdefault(free, Counter())[layout] += n
        rooms[free] = True

    for layout, n in open_bins.items():
        put(layout, n)
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            fits = np.flatnonzero(rooms[length:])
            if len(fits):
                free = length + int(fits[0])
                layout, bins = next(iter(by_room[free].items()))
                take = min(n, bins)
                if take == bins:
                    del by_room[free][layout]
                    if not by_room[free]:
                        del by_room[free]
                        rooms[free] = False
                else:
                    by_room[free][layout] = bins - take
                put((*layout, length), take)
                n -= take
            else:
                each = capacity // length
                full, rest = divmod(n, each)
                if full:
                    put((length,) * each, full)
                if rest:
                    put((length,) * rest, 1)
                n = 0
    done.extend((layout, n) for counts in by_room.values() for layout, n in counts.items())
    return done


def _slots(layouts: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first ranks, first sequences and offsets of the places for its pieces."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    taken: Counter = Counter()
    sequence = 0
    for layout, n in layouts:
        offset = 0
        for length in layout:
            slots.setdefault(length, []).append((taken[length], sequence, offset))
            taken[length] += n
            offset += length
        sequence += n
    return {length: tuple(np.array(x, np.int64) for x in zip(*rows)) for length, rows in slots.items()}


def _place(slots):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = slots.value
        for batch in small_batches(batches):
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for each in np.unique(length).tolist():
                at = np.flatnonzero(length == each)
                first, base, start = places[each]
                slot = np.searchsorted(first, rank[at], "right") - 1
                sequence[at] = base[slot] + rank[at] - first[slot]
                offset[at] = start[slot]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row's token ids.

    A text's ids end with ``END``; ids longer than ``capacity`` are cut into pieces of that
    length and a last one that may be shorter. Null and empty texts have the end mark alone.
    Repeated rows and null ids are packed like any other; other columns are not read; an
    empty table gives an empty one. ``tokenizer``: the file of the vocabulary, read on the driver.
    """
    spark = docs.sparkSession
    with open(tokenizer or tokenizer_file(), encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    rows = docs.select(column(id).alias("id"), column(text).cast("string").alias("text"))
    fields = T.StructType.fromDDL("piece int, start long, length long, ids_crc32 long").fields
    piece_schema = T.StructType([rows.schema["id"], *fields])
    pieces = written(rows.mapInArrow(_pieces(definition, capacity), piece_schema), "pieces")
    lengths = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    histogram = {r["length"]: r["n"] for r in lengths}
    slots = spark.sparkContext.broadcast(_slots(pack_histogram(histogram, capacity), capacity))
    buckets = 1 + sum(histogram.values()) // BUCKET_ROWS
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    count = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = count.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("id", "piece", "ids_crc32")
    ranked = dealt.withColumn("r", F.row_number().over(within)).join(base, ["length", "bucket"])
    ranked = ranked.select(*piece_schema.names, (F.col("base") + F.col("r") - 1).alias("rank"))
    places = T.StructType.fromDDL("sequence_id long, offset long").fields
    out = ranked.mapInArrow(_place(slots), T.StructType(piece_schema.fields + places))
    return out.withColumnRenamed("id", id)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
