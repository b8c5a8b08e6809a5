"""Ranked lexical search: accumulators of short inverted lists run as one more iterator beside long lists.

Documents are read once into an index of segments: a row holds the inverted lists of some
thousand documents, for the terms that items ask for, and what is needed for the statistics.
Document frequencies, which weigh the terms, are summed up over all segments. Each task then
searches its segments for all items. In a segment, an item's short lists are summed up term by term;
these accumulators, sorted by document and with their largest sum as a bound, join
the long lists as one iterator. All iterators advance through the documents window by window: a
window whose bounds cannot reach the item's k-th score so far is skipped, and in others only lists
that a document needs to reach it name candidates, which the remaining lists are probed for
while they can still reach it. A task keeps k results an item from segment to segment.

Nothing is shuffled by term, so frequent terms are no hot keys; only each task's k results an item are.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import words as W
from barloom.llm.shared import column, small_batches, table, written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Terms of items that are searched for at a time; more items take further passes over the documents.
HELD_TERMS = 1 << 20
#: A segment is closed when it has that many postings.
SEGMENT_POSTINGS = 1 << 20
#: Segments that a task reads at once.
SEGMENTS_PER_FILE = 8
#: A list is short if it has at most this share of a segment's documents.
SHORT_SHARE = 1 / 32
WINDOW_DOCS = 1024
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Vocabulary:
    """Distinct terms as bytes, looked up by hash and compared byte by byte."""

    def __init__(self, terms: list[bytes]):
        data, offsets = W.text_buffers(pa.array(terms, pa.large_binary()))
        found = W.Block(slice(0, len(terms)), data, offsets, offsets[:-1], offsets[1:], np.arange(len(terms) + 1))
        hashes = found.hashes()
        order = np.argsort(hashes)
        self.terms = [terms[i] for i in order]
        self.hashes, self.data = hashes[order], data
        self.start, self.size = offsets[:-1][order], np.diff(offsets)[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two terms have one hash of 64 bits")

    def find(self, block: W.Block) -> tuple[np.ndarray, np.ndarray]:
        """The words of a block that are terms, and which: (numbers of words, numbers of terms)."""
        if not len(self.hashes) or not len(block.start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = block.hashes(W.LOWER)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        size = block.end - block.start
        word = np.flatnonzero((self.hashes[at] == hashes) & (self.size[at] == size))
        if not len(word):
            return word, at[word]
        term, size = at[word], size[word]
        begin = np.cumsum(size) - size
        inside = np.arange(int(size.sum())) - np.repeat(begin, size)
        same = W.LOWER[block.data[np.repeat(block.start[word], size) + inside]] == self.data[np.repeat(self.start[term], size) + inside]
        equal = np.logical_and.reduceat(same, begin)
        return word[equal], term[equal]


def _index(terms, segment_postings: int):
    """Rows (id, text) to segments.

    ids, sizes: the documents that hold a term, and their numbers of words; terms, dfs: the lists and their lengths;
    docs, tfs: the lists one after the other; n_docs, n_words: of all documents with words.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, keys, tfs, docs, postings, n_docs, n_words = [], [], [], [], 0, 0, 0, 0

        def close() -> pa.RecordBatch:
            key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            tf = np.concatenate(tfs) if tfs else np.zeros(0, np.uint32)
            order = np.argsort(key, kind="stable")
            key, tf = key[order], tf[order]
            term, df = np.unique(key >> 32, return_counts=True)
            values = {
                "ids": pa.array([[x for part in ids for x in part.to_pylist()]], pa.list_(pa.int64())),
                "sizes": pa.array([np.concatenate(sizes).tobytes() if sizes else b""]),
                "terms": pa.array([term.astype(np.int32)], pa.list_(pa.int32())),
                "dfs": pa.array([df.astype(np.int32)], pa.list_(pa.int32())),
                "docs": pa.array([(key & 0xFFFFFFFF).astype(np.uint32).tobytes()]),
                "tfs": pa.array([tf.tobytes()]),
                "n_docs": pa.array([n_docs]),
                "n_words": pa.array([n_words]),
            }
            return pa.RecordBatch.from_arrays(list(values.values()), names=list(values))

        for batch in small_batches(batches):
            for block in W.blocks(batch.column(1), W.ALNUM_BYTE):
                counts = block.counts
                n_docs, n_words = n_docs + int((counts > 0).sum()), n_words + int(counts.sum())
                word, term = terms.value.find(block)
                row, held = np.unique(block.text_of_word()[word], return_inverse=True)
                key, tf = np.unique((term << 32) | (held + docs), return_counts=True)
                ids.append(batch.column(0).slice(block.rows.start, len(counts)).take(pa.array(row)))
                sizes.append(counts[row].astype(np.int64))
                keys.append(key)
                tfs.append(tf.astype(np.uint32))
                docs, postings = docs + len(row), postings + len(key)
                if postings >= segment_postings:
                    yield close()
                    ids, sizes, keys, tfs, docs, postings, n_docs, n_words = [], [], [], [], 0, 0, 0, 0
        if n_docs:
            yield close()

    return run


class Segment:
    """Inverted lists of some documents with the impact of each posting, and each list's bounds by window."""

    def __init__(self, terms: list, dfs: list, docs: bytes, tfs: bytes, sizes: bytes, total_docs: int, total_words: int, window: int):
        self.docs, tf = np.frombuffer(docs, np.uint32).astype(np.int64), np.frombuffer(tfs, np.uint32).astype(np.int64)
        n = np.frombuffer(sizes, np.int64)
        self.n_docs, self.window = len(n), window
        self.edges = np.arange(0, self.n_docs + window, window)
        if len(n) and 50 * int(n.max()) * total_docs >= 1 << 63:
            length = np.array([(50 * int(x) * total_docs) // total_words for x in n], np.int64)
        else:
            length = (50 * n * total_docs) // max(1, total_words)
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 20 * (50 + length)[self.docs])
        stops = np.cumsum(dfs) if len(dfs) else np.zeros(0, np.int64)
        self.lists = {t: (int(stop) - df, int(stop)) for t, df, stop in zip(terms, dfs, stops)}
        self._windows: dict = {}

    def windows(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each window of a list begins (one place more at the end), and the largest impact in each."""
        found = self._windows.get(term)
        if found is None:
            begin, end = self.lists[term]
            found = self._windows[term] = bounds_by_window(self.docs[begin:end], self.impact[begin:end], self.edges)
        return found


def bounds_by_window(docs: np.ndarray, values: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    places = np.searchsorted(docs, edges)
    filled = places[1:] > places[:-1]
    most = np.zeros(len(edges) - 1, np.int64)
    if filled.any():
        most[filled] = np.maximum.reduceat(values, places[:-1][filled])
    return places, most


class Best:
    """The k best (score, id) of an item so far: larger scores first, then smaller ids, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def floor(self) -> int:
        """What a document must score to get in, or tie."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        scores, ids, known = (np.concatenate(p) for p in ((self.scores, scores), (self.ids, ids), (self.known, known)))
        order = np.lexsort((ids, ~known, -scores))[: self.k]
        self.scores, self.ids, self.known = scores[order], ids[order], known[order]


def search_segment(
    segment: Segment, terms: np.ndarray, weights: np.ndarray, best: Best, ids: np.ndarray, known: np.ndarray, short_share: float
) -> int:
    """Add a segment's documents to the best of an item; returns the number of documents that were scored in full or in part."""
    short = segment.n_docs * short_share
    seen, summed, iterators = 0, [], []
    for term, weight in zip(terms.tolist(), weights.tolist()):
        span = segment.lists.get(term)
        if span is None or weight <= 0:
            continue
        if span[1] - span[0] <= short:
            summed.append((segment.docs[span[0] : span[1]], segment.impact[span[0] : span[1]] * weight))
        else:
            places, most = segment.windows(term)
            iterators.append((segment.docs[span[0] : span[1]], segment.impact[span[0] : span[1]], weight, places, most * weight))
    if summed:
        docs, parts = np.concatenate([d for d, _ in summed]), np.concatenate([s for _, s in summed])
        order = np.argsort(docs, kind="stable")
        docs = docs[order]
        new = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
        docs, sums = docs[new], np.add.reduceat(parts[order], new)
        iterators.append((docs, sums, 1, *bounds_by_window(docs, sums, segment.edges)))
    if not iterators:
        return 0
    bounds = np.array([most for *_, most in iterators])
    whole = bounds.sum(axis=0)
    for window in np.flatnonzero(whole >= best.floor).tolist():
        floor = best.floor
        if whole[window] < floor:
            continue
        order = np.argsort(-bounds[:, window], kind="stable")
        order = order[bounds[order, window] > 0]
        # What the lists from each one on can add at most; those that cannot reach the floor together name no candidates.
        rest = np.append(np.cumsum(bounds[order, window][::-1])[::-1], 0)
        needed = max(1, int((rest[:-1] >= floor).sum()))
        low = window * segment.window
        scores = np.zeros(segment.window, np.int64)
        for i in order[:needed]:
            docs, values, weight, places, _ = iterators[i]
            part = slice(places[window], places[window + 1])
            scores[docs[part] - low] += values[part] * weight
        found = np.flatnonzero(scores)
        seen += len(found)
        for at, i in enumerate(order[needed:], needed):
            found = found[scores[found] + rest[at] >= floor]
            if not len(found):
                break
            docs, values, weight, places, _ = iterators[i]
            part = slice(places[window], places[window + 1])
            inside = docs[part] - low
            place = np.minimum(np.searchsorted(inside, found), len(inside) - 1)
            hit = inside[place] == found
            scores[found[hit]] += values[part][place[hit]] * weight
        found = found[scores[found] >= floor]
        if len(found):
            best.add(scores[found], ids[found + low], known[found + low])
    return seen


def _search(items, total_docs: int, total_words: int, k: int, kind: pa.DataType, window: int, short_share: float):
    """Segments to the k best documents of each item in a task's segments: (item, doc, score)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                value = {name: batch.column(name)[row] for name in batch.schema.names}
                listed = value["ids"].values
                known = ~np.asarray(listed.is_null())
                ids = listed.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                lists = [value[n].values.to_numpy().tolist() for n in ("terms", "dfs")]
                blobs = [value[n].as_buffer() for n in ("docs", "tfs", "sizes")]
                segment = Segment(*lists, *blobs, total_docs, total_words, window)
                for number, (_, terms, weights) in enumerate(items.value):
                    search_segment(segment, terms, weights, best.setdefault(number, Best(k)), ids, known, short_share)
        for number, found in best.items():
            if len(found.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([items.value[number][0]] * len(found.scores), kind),
                        pa.array(found.ids, pa.int64(), mask=~found.known),
                        pa.array(found.scores),
                    ],
                    names=["item", "doc", "score"],
                )

    return run


def weight(df: int, total_docs: int) -> int:
    return math.floor(1000 * math.log((2 * total_docs + 2) / (2 * df + 1)))


def item_terms(items: DataFrame, id: str, text: str) -> DataFrame:
    """(item, term) of each item's distinct terms; texts of one id are one item."""
    lowered = F.translate(column(text).cast("string"), _UPPER, _LOWER)
    terms = items.select(column(id).alias("item"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
    return terms.distinct()


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    held_terms: int = HELD_TERMS,
    segment_postings: int = SEGMENT_POSTINGS,
    window: int = WINDOW_DOCS,
    short_share: float = SHORT_SHARE,
) -> DataFrame:
    """(item, rank, doc, score): each item's k documents of the largest scores above 0, ties by id, null ids last.

    Null and empty texts have no terms: such documents count nowhere, such items have no rows. Each row of
    ``docs`` is a document, also if its id or text is repeated; rows of ``items`` with one id are one item.
    Ids of documents are whole numbers. Other columns are not read; an empty table gives an empty one. Items are searched for in
    blocks of about ``held_terms`` terms, which the tasks hold.
    """
    spark = docs.sparkSession
    asked = written(item_terms(items, item_id, item_text), "item-terms")
    blocks = max(1, -(-2 * asked.count() // held_terms))
    kind = asked.schema["item"].dataType
    rows = docs.select(column(doc_id).cast("long").alias("id"), column(doc_text).cast("string").alias("text"))
    index_type = "ids array<long>, sizes binary, terms array<int>, dfs array<int>, docs binary, tfs binary, n_docs long, n_words long"
    out = None
    for number in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).orderBy("item", "term").toArrow()
        listed, wanted = mine.column("item").to_pylist(), mine.column("term").cast(pa.large_binary()).to_pylist()
        vocabulary = Vocabulary(sorted(set(wanted)))
        terms = spark.sparkContext.broadcast(vocabulary)
        index = written(rows.mapInArrow(_index(terms, segment_postings), index_type), "index", maxRecordsPerFile=SEGMENTS_PER_FILE)
        total_docs, total_words = index.agg(F.sum("n_docs"), F.sum("n_words")).first()
        counted = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("e")).groupBy("e.terms").agg(F.sum("e.dfs").alias("df"))
        weights = {row["terms"]: weight(row["df"], total_docs) for row in counted.collect()}
        places = {term: i for i, term in enumerate(vocabulary.terms)}
        of_item: dict = {}
        for item, term in zip(listed, wanted):
            if places[term] in weights:
                of_item.setdefault(item, []).append(places[term])
        chosen = [(item, np.array(t, np.int64), np.array([weights[x] for x in t], np.int64)) for item, t in of_item.items()]
        made = _search(
            spark.sparkContext.broadcast(chosen), total_docs or 0, total_words or 0, k, mine.schema.field("item").type, window, short_share
        )
        found = index.drop("n_docs", "n_words").mapInArrow(
            made, T.StructType([T.StructField("item", kind), T.StructField("doc", T.LongType()), T.StructField("score", T.LongType())])
        )
        out = found if out is None else out.unionByName(found)
    # Twice: a part of an item's documents at a time, then what is left of them.
    for part in ([F.pmod(F.xxhash64("doc"), F.lit(16))], []):
        order = Window.partitionBy("item", *part).orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
        out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select("item", "rank", "doc", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
