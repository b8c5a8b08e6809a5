"""Substring dedup: remove the words covered by a window of words that also starts anywhere else.

Count-min prefilter. A window of 35 words is represented by its leftmost least 16-gram (by
hash). Equal windows have equal grams at equal distances, so a gram's chosen places are at
least as many as the starts of any window that chose it: the count of its places, which
tasks sketch and the merged sketch never underestimates, overestimates the window's count,
and about a tenth of the windows' number needs counting. A second pass reads the texts
again and groups exactly, by 128 bits of window and gram hash, only the windows whose
estimate is two or more; the others are certainly unique. None is lost at any size of the
sketch, which grows with the text up to 2 x 2^28 bits (64 MB); beyond that more unique
windows reach the second pass.

Windows that chose one place travel as one row; rows with the same gram and the same
windows are added up per task before they are dealt by gram, so a passage that half the
rows hold arrives as one row a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import words as W
from barloom.llm.shared import (
    PARTIAL,
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

WINDOW = 35
ANCHOR = 16
#: Anchors a task counts before it sends them on.
FLUSH = 2_000_000
_U = np.uint64
_GRAM_BASE = 0xA24BAED4963EE407 | 1
_WINDOW_BASE = 0x9FB21C651E98DF25 | 1
_SPAN_BASE = 0xD6E8FEB86659FD93 | 1
_SALTS = (0x8CB92BA72F3D8DD7, 0xF1357AEA2E62A9C5)
#: Bits that keep a word's place in its block: more words than a string can hold.
_PLACE = 30
#: Different surroundings of one gram that a task resolves in memory; more are grouped window by window.
HELD = 4096


def _anchor_words(window: int) -> int:
    """Words of the gram that stands for a window: 16, or fewer for short windows."""
    return min(ANCHOR, max(1, window // 2))


def anchors(h: np.ndarray, room: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows within their texts, the place of each one's gram, and all gram hashes."""
    k = _anchor_words(window)
    grams = W.gram_hashes(h, k, _GRAM_BASE)
    starts = np.flatnonzero(room >= window)
    if not len(starts):
        return starts, starts, grams
    width = window - k + 1
    places = np.arange(len(grams), dtype=np.uint64)
    least = (grams & ~_U((1 << _PLACE) - 1)) | (places & _U((1 << _PLACE) - 1))
    # Least of `width` neighbours by doubling; the place in the low bits breaks ties to the left.
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    return starts, (least[starts] & _U((1 << _PLACE) - 1)).astype(np.int64), grams


def _cells(grams: np.ndarray, bits: int, salt: int) -> np.ndarray:
    return W.mix(grams ^ _U(salt)) >> _U(64 - bits)


def _count_anchors(window: int, bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            grams = np.concatenate(held)
            both = [_cells(grams, bits, salt).astype(np.int64) + (row << bits) for row, salt in enumerate(_SALTS)]
            return partial_cells(np.concatenate(both).astype(np.uint32), 2)

        for batch in small_batches(batches):
            for block in W.blocks(batch.column(0)):
                _, at, grams = anchors(block.hashes(), block.room(), window)
                if len(at):
                    at = at[np.concatenate(([True], at[1:] != at[:-1]))]
                    held.append(grams[at])
                    size += len(at)
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return run


def _candidate_windows(window: int, bits: int, sketch):
    """Rows of (k1, k2, text) to one row for each place whose windows may repeat."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = sketch.value[0]
        for batch in small_batches(batches):
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for block in W.blocks(batch.column(2)):
                h = block.hashes()
                starts, at, grams = anchors(h, block.room(), window)
                if not len(at):
                    continue
                gram = grams[at]
                maybe = np.ones(len(at), bool)
                for row, salt in enumerate(_SALTS):
                    maybe &= test_bits(repeated, _cells(gram, bits, salt) + _U(row << bits))
                starts, at, gram = starts[maybe], at[maybe], gram[maybe]
                if not len(at):
                    continue
                hashes = W.gram_hashes(h, window, _WINDOW_BASE)[starts]
                head = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
                size = np.diff(np.append(head, len(at)))
                order = np.arange(len(at)) - np.repeat(head, size) + 1
                span = np.add.reduceat(W.mix(hashes + order.astype(np.uint64) * _U(_SPAN_BASE)), head)
                text = np.searchsorted(block.first, starts[head], "right") - 1
                bounds = (np.append(head, len(at)) * 8).astype(np.int64)
                packed = pa.Array.from_buffers(
                    pa.large_binary(), len(head), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(hashes.tobytes())]
                ).cast(pa.binary())
                row = text + block.rows.start
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram[head].view(np.int64)),
                        pa.array(span.view(np.int64)),
                        pa.array(k1[row]),
                        pa.array(k2[row]),
                        pa.array((starts[head] - block.first[text]).astype(np.int32)),
                        packed,
                    ],
                    names=["gram", "span", "k1", "k2", "start", "windows"],
                )

    return run


def _repeated_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (gram, span, count, windows), sorted by gram, to rows with a mask of the repeated windows.

    The rows of a gram, one for each different sequence of windows around it, are held
    together; those of a gram with more than ``HELD`` pass through without a mask.
    """
    out: list = []

    def resolved(of, held):
        sizes = [len(w) // 8 for _, _, w in held]
        flat = np.concatenate([np.frombuffer(w, np.uint64) for _, _, w in held])
        count = np.repeat(np.array([c for _, c, _ in held]), sizes)
        order = np.argsort(flat, kind="stable")
        ranked = flat[order]
        head = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        total = np.add.reduceat(count[order], head)
        again = np.empty(len(flat), bool)
        again[order] = np.repeat(total >= 2, np.diff(np.append(head, len(flat))))
        weight = 1 << (np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
        masks = np.add.reduceat(weight * again, np.cumsum(sizes) - sizes)
        out.extend((of, span, mask, None, None) for (span, _, _), mask in zip(held, masks.tolist()) if mask)

    def taken():
        rows = pa.RecordBatch.from_arrays(
            [
                pa.array(values, kind)
                for values, kind in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))
            ],
            names=["gram", "span", "mask", "count", "windows"],
        )
        out.clear()
        return rows

    held, of, many = [], None, False
    for batch in small_batches(batches):
        for gram, span, count, windows in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if gram != of:
                if held and (len(held) > 1 or held[0][1] > 1):
                    resolved(of, held)
                held, of, many = [], gram, False
            held.append((span, count, windows))
            if many or len(held) > HELD:
                out.extend((of, s, None, c, w) for s, c, w in held)
                held, many = [], True
            if len(out) >= 20_000:
                yield taken()
    if held and (len(held) > 1 or held[0][1] > 1):
        resolved(of, held)
    if out:
        yield taken()


def _spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (gram, span, count, windows) to one row a window."""
    for batch in small_batches(batches, 1 << 20):
        hashes = [np.frombuffer(w.as_buffer(), np.int64) for w in batch.column(3)]
        size = np.array([len(x) for x in hashes])
        bit = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        columns = [np.repeat(batch.column(i).to_numpy(), size) for i in range(3)] + [np.concatenate(hashes), 1 << bit]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["gram", "span", "count", "hash", "bit"])


def _masks(spans: DataFrame) -> DataFrame:
    """(gram, span, mask): the windows of each sequence that occur twice or more."""
    tasks = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_gram = spans.repartition(tasks, "gram").sortWithinPartitions("gram")
    found = written(
        by_gram.mapInArrow(_repeated_windows, "gram long, span long, mask long, count long, windows binary"), "masks"
    )
    each = (
        found.where("mask is null")
        .select("gram", "span", "count", "windows")
        .mapInArrow(_spread, "gram long, span long, count long, hash long, bit long")
    )
    again = each.groupBy("gram", "hash").agg(F.sum("count").alias("n")).where("n > 1").select("gram", "hash")
    split = each.join(again, ["gram", "hash"]).groupBy("gram", "span").agg(F.sum("bit").alias("mask"))
    return found.where("mask is not null").select("gram", "span", "mask").union(split)


def repeated_places(rows: DataFrame, window: int) -> DataFrame:
    """(k1, k2, place): for each text key of ``rows`` (k1, k2, text), the list of (start, mask) of its repeated windows."""
    spark = rows.sparkSession
    bits = width_bits(text_bytes(rows, "text") // 8)
    partial = rows.select("text").mapInArrow(_count_anchors(window, bits), PARTIAL)
    sketch = spark.sparkContext.broadcast(collect_bits(merge_cells(partial, (2,)), (2,), bits + 1))
    found = written(
        rows.mapInArrow(
            _candidate_windows(window, bits, sketch), "gram long, span long, k1 long, k2 long, start int, windows binary"
        ),
        "windows",
    )
    sketch.destroy()
    spans = found.groupBy("gram", "span").agg(F.count("*").alias("count"), F.first("windows").alias("windows"))
    hit = found.select("gram", "span", "k1", "k2", "start").join(_masks(spans), ["gram", "span"])
    # A text's places are as many as its words at most; copies of a text share a key and add nothing.
    return hit.select("k1", "k2", F.struct("start", "mask").alias("place")).groupBy("k1", "k2").agg(F.collect_set("place").alias("places"))


def _remove(kept: int, at: int, window: int):
    """Batches of kept columns, the text (column ``at``, kept or not) and places last; the kept words and counts come."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            n_words, n_removed, texts = [], [], []
            for text, places in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                words = (text.as_py() or "").encode().split()
                n_words.append(len(words))
                if places.is_valid:
                    start = places.values.field(0).to_numpy()
                    mask = places.values.field(1).to_numpy()
                    place, bit = np.nonzero((mask[:, None] >> np.arange(window)) & 1)
                    first = start[place] + bit
                    cover = np.bincount(first, minlength=len(words) + 1) - np.bincount(first + window, minlength=len(words) + 1)
                    stay = np.cumsum(cover[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(stay).tolist()]
                n_removed.append(n_words[-1] - len(words))
                texts.append(b" ".join(words))
            columns = [batch.column(i) for i in range(kept)]
            columns += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())]
            columns.append(pa.array([hashlib.sha256(t).hexdigest() for t in texts]))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:kept], *ADDED])

    return run


ADDED = ["n_words", "n_removed", "kept_text", "kept_sha256"]


def remove_repeated(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, window: int = WINDOW
) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all but added names, if not given) and n_words, n_removed, kept_text, kept_sha256.

    Words are runs of characters other than ASCII white space. A word goes if a window of
    ``window`` words that covers it starts at another place too, in any row or the same one;
    windows are judged on the input. kept_text joins the words that stay by one space. Null
    and empty texts have no words and give an empty kept_text; repeated rows repeat each
    other; an empty table gives an empty one. Columns with the name of an added one are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    body = column(text).cast("string")
    keys = [F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(35), body).alias("k2")]
    places = repeated_places(docs.select(*keys, body.alias("text")), window)
    # A text that is kept anyway travels once.
    at = keep.index(text) if text in keep and docs.schema[text].dataType == T.StringType() else len(keep)
    texts = [body.alias(f"c{at}")] if at == len(keep) else []
    left = docs.select(*[column(c).alias(f"c{i}") for i, c in enumerate(keep)], *texts, *keys)
    joined = left.join(places, ["k1", "k2"], "left").select(*[f"c{i}" for i in range(len(keep) + len(texts))], "places")
    fields = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    added = T.StructType.fromDDL("n_words long, n_removed long, kept_text string, kept_sha256 string").fields
    out = joined.mapInArrow(_remove(len(keep), at, window), T.StructType(fields + added))
    return out.toDF(*keep, *ADDED)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return remove_repeated(docs, keep=["doc_id"]).select("doc_id", "n_words", "n_removed", "kept_sha256")
