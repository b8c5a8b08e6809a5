"""Approximate nearest neighbours by largest inner product: a forest of random-projection trees.

Each tree splits space at the median of a bounded sample's projections on random
directions; vectors get one more coordinate that makes all norms equal, so near directions
mean large inner products. Every vector is put into one leaf of each tree. A query walks all
trees with one priority queue, ordered by the largest distance to a split it had to
cross, until it has visited ``visits`` leaves; the number is the least at which queries of
the sample reach the wanted recall within the sample. Of some depths the cheapest for the number
of all vectors is taken: deeper trees leave fewer candidates and send each query to more leaves. Leaves are dealt in bounded
blocks, candidates are ranked exactly there, and each query merges the best of its leaves.

Equal vectors are one candidate with their smallest ids, and one query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.shared import column, small_batches, table, written

TREES = 3
#: Levels of a tree, from and to, as far as a leaf holds 16 vectors of the sample or more.
DEPTH = (7, 10)
#: Sending a query to one more leaf costs about as much as scoring this many candidates.
VISIT_ROWS = 200
#: The forest is fitted to, and its effort chosen on, this many distinct vectors at most.
SAMPLE = 20_000
SAMPLE_QUERIES = 200
RECALL = 0.96
#: Vectors of a block of a leaf, and queries of a block, about.
BLOCK_ROWS = 8_000
SEED = 20


@dataclass
class Forest:
    """``direction[t][l]``: (2^l, dimensions); ``split[t][l]``: (2^l,)."""

    direction: list[list[np.ndarray]]
    split: list[list[np.ndarray]]
    norm: float
    visits: int

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        square = (x * x).sum(1)
        if query:  # only a query's direction matters
            return np.concatenate((x * (self.norm / np.sqrt(square))[:, None], np.zeros((len(x), 1))), axis=1)
        more = np.sqrt(np.maximum(0.0, self.norm**2 - square))
        return np.concatenate((x, more[:, None]), axis=1)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each lifted vector in each tree."""
        out = np.zeros((len(self.split), len(x)), np.int64)
        for t, (directions, splits) in enumerate(zip(self.direction, self.split)):
            node = np.zeros(len(x), np.int64)
            for d, s in zip(directions, splits):
                node = 2 * node + ((x * d[node]).sum(1) > s[node])
            out[t] = node
        return out

    def search(self, x: np.ndarray, visits: int) -> list[tuple[int, int]]:
        """The first ``visits`` (tree, leaf) of a lifted query, nearest first."""
        margins = [[d @ x - s for d, s in zip(*tree)] for tree in zip(self.direction, self.split)]
        queue = [(0.0, t, 0, 0) for t in range(len(self.split))]
        found = []
        while queue and len(found) < visits:
            crossed, t, level, node = heapq.heappop(queue)
            tree = margins[t]
            while level < len(tree):
                m = tree[level][node]
                right = m > 0
                level += 1
                heapq.heappush(queue, (max(crossed, abs(m)), t, level, 2 * node + (not right)))
                node = 2 * node + right
            found.append((t, node))
        return found


def fit_forest(
    sample: np.ndarray, norm: float, k: int, rows: int, trees: int = TREES, depth: tuple[int, int] = DEPTH, recall: float = RECALL
) -> Forest:
    """Fit the trees to a sample of ``rows`` vectors; depth and leaves to visit follow from the sample's own nearest neighbours."""
    rng = np.random.default_rng(SEED)
    forest = Forest([], [], norm, 1)
    x = forest.lift(sample, query=False)
    room = int(np.log2(max(1, len(x) / 16)))
    least, depth = (max(0, min(levels, room)) for levels in depth)
    for _ in range(trees):
        directions, splits, node = [], [], np.zeros(len(x), np.int64)
        for level in range(depth):
            d = rng.normal(size=(1 << level, x.shape[1]))
            d /= np.linalg.norm(d, axis=1)[:, None]
            p = (x * d[node]).sum(1)
            s = np.array([np.median(p[node == i]) if (node == i).any() else 0.0 for i in range(1 << level)])
            node = 2 * node + (p > s[node])
            directions.append(d)
            splits.append(s)
        forest.direction.append(directions)
        forest.split.append(splits)
    forest.visits = trees << depth
    if len(x) <= 2 * k or depth == 0:
        return forest
    queries = range(0, len(sample), max(1, len(sample) // SAMPLE_QUERIES))
    near = []
    for i in queries:
        score = sample @ sample[i]
        score[i] = -np.inf
        near.append(np.argpartition(-score, k)[:k])
    leaf = forest.leaves(x)
    shapes = []
    for levels in range(least, depth + 1):
        cut = Forest([d[:levels] for d in forest.direction], [s[:levels] for s in forest.split], norm, trees << levels)
        cut.visits = _visits(cut, sample, queries, near, leaf >> (depth - levels), recall)
        shapes.append((cut.visits * (rows / (1 << levels) + VISIT_ROWS), levels, cut))
    return min(shapes, key=lambda s: s[:2])[2]


def _visits(forest: Forest, sample: np.ndarray, queries: range, near: list[np.ndarray], leaf: np.ndarray, recall: float) -> int:
    """The least number of leaves at which the sample's queries have met that share of their nearest neighbours."""
    arrival = []
    for i, ids in zip(queries, near):
        places = forest.search(forest.lift(sample[i : i + 1], True)[0], forest.visits)
        when = {place: n for n, place in enumerate(places, 1)}
        arrival.append([min(when[t, int(row[j])] for t, row in enumerate(leaf)) for j in ids])
    return int(np.quantile(np.array(arrival), recall, method="higher"))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    values = batch.column(batch.schema.names.index(name))
    return values.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(values), -1)


def _put_into_leaves(forest):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = forest.value
        for batch in small_batches(batches, 2 << 20):
            leaf = trees.leaves(trees.lift(_matrix(batch, "vector"), query=False))
            for t in range(len(leaf)):
                place = [pa.array(np.full(batch.num_rows, t, np.int32)), pa.array(leaf[t].astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*place, *batch.columns], names=["tree", "leaf", *batch.schema.names])

    return run


def _visit(forest):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = forest.value
        for batch in small_batches(batches, 64 << 10):
            x = trees.lift(_matrix(batch, "vector"), query=True)
            found = [trees.search(row, trees.visits) for row in x]
            row = pa.array(np.repeat(np.arange(len(x)), [len(f) for f in found]))
            tree, leaf = np.array([place for f in found for place in f], np.int32).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree), pa.array(leaf), *(c.take(row) for c in batch.columns)],
                names=["tree", "leaf", *batch.schema.names],
            )

    return run


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest scores, ties to smaller ids, each id once."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    _, first = np.unique(ids, return_index=True)
    first = np.sort(first)[:k]
    return ids[first], scores[first]


def _rank_leaf(k: int):
    """Best candidates of a block of a leaf for each query that visits it."""

    def run(key, queries: pa.Table, members: pa.Table) -> pa.Table:
        out_q, out_ids, out_scores = [], [], []
        if queries.num_rows and members.num_rows:
            q = queries.combine_chunks().to_batches()[0]
            m = members.combine_chunks().to_batches()[0]
            vectors = _matrix(m, "vector")
            id_lists = m.column(m.schema.names.index("ids"))
            flat = id_lists.flatten().to_numpy()
            bounds = np.concatenate(([0], np.cumsum(np.diff(id_lists.offsets.to_numpy()))))
            points = _matrix(q, "vector")
            lengths = float(np.linalg.norm(vectors, axis=1).max()) * vectors.shape[1]
            names = q.column(q.schema.names.index("query")).to_numpy()
            for at in range(0, len(points), 256):
                rough = points[at : at + 256] @ vectors.T
                # All that may tie with the k-th: the last digits of a matrix product depend on its shape.
                last = max(0, len(vectors) - k)
                floor = np.partition(rough, last, axis=1)[:, last] - 1e-12 * lengths * np.linalg.norm(points[at : at + 256], axis=1)
                for i in range(len(rough)):
                    top = np.flatnonzero(rough[i] >= floor[i])
                    exact = np.cumsum(vectors[top] * points[at + i], axis=1)[:, -1]
                    sizes = bounds[top + 1] - bounds[top]
                    ids = np.concatenate([flat[bounds[j] : bounds[j + 1]] for j in top])
                    ids, scores = _best(ids, np.repeat(exact, sizes), k)
                    out_q.append(names[at + i])
                    out_ids.append(ids)
                    out_scores.append(scores)
        return pa.table(
            {
                "query": pa.array(out_q, pa.int64()),
                "ids": pa.array(out_ids, pa.list_(pa.int64())),
                "scores": pa.array(out_scores, pa.list_(pa.float64())),
            }
        )

    return run


def _merge(k: int):
    """Rows (query, ids, scores) sorted by query to the best k of each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(done):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([d[0] for d in done], pa.int64()),
                    pa.array([d[1] for d in done], pa.list_(pa.int64())),
                    pa.array([d[2] for d in done], pa.list_(pa.float64())),
                ],
                names=["query", "ids", "scores"],
            )

        of, ids, scores, done = None, [], [], []
        for batch in small_batches(batches):
            names = batch.column(0).to_pylist()
            for i, name in enumerate(names):
                if name != of:
                    if of is not None:
                        done.append((of, *_best(np.concatenate(ids), np.concatenate(scores), k)))
                    of, ids, scores = name, [], []
                ids.append(batch.column(1)[i].values.to_numpy())
                scores.append(batch.column(2)[i].values.to_numpy())
            if len(done) > 1000:
                yield packed(done)
                done = []
        if of is not None:
            done.append((of, *_best(np.concatenate(ids), np.concatenate(scores), k)))
        if done:
            yield packed(done)

    return run


def nearest(
    vectors: DataFrame, k: int, is_query, id: str = "vec_id", embedding: str = "embedding", sample: int = SAMPLE
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row for which ``is_query`` holds.

    Rows take no part whose id or vector is null, whose vector is zero, has a null or
    non-finite component, or has not the most frequent dimension (ties: the larger). Rows of
    one id and vector count once; of a candidate id with several vectors the best counts,
    and a query id with several is answered for each. Fewer than k candidates give fewer
    rows; an empty table gives an empty one. Other columns are not read.
    """
    spark = vectors.sparkSession
    v = F.col("vector")
    rows = vectors.select(column(id).cast("long").alias("id"), column(embedding).cast("array<double>").alias("vector"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    common = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dimension = common["d"] if common else 1
    rows = rows.where(F.size(v) == dimension)
    # The k + 1 smallest ids of each vector, in two steps, as one vector may have most of the rows.
    few = rows.distinct()
    for part in ([F.pmod(F.xxhash64("id"), F.lit(64))], []):
        order = Window.partitionBy("vector", *part).orderBy("id")
        few = few.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= k + 1)
    classes = written(few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "classes")
    norm = classes.agg(F.max(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)))).first()[0] or 1.0
    drawn = classes.orderBy(F.xxhash64("vector")).limit(sample).select("vector").toArrow().column(0).combine_chunks()
    points = drawn.flatten().to_numpy(zero_copy_only=False).reshape(len(drawn), dimension) if len(drawn) else np.zeros((0, dimension))
    total = classes.count()
    fitted = fit_forest(points, norm, k, total)
    forest = spark.sparkContext.broadcast(fitted)

    asked = rows.where(is_query(F.col("id"))).select("id", "vector", F.xxhash64("vector").alias("query"))
    named = written(asked.select("query", "vector").dropDuplicates(["query"]), "queries")
    queries = named.count()
    leaves = len(fitted.split[0][-1]) * 2 if fitted.split[0] else 1
    member_blocks = 1 + total // (leaves * BLOCK_ROWS) * 2
    query_blocks = 1 + queries * fitted.visits // (leaves * len(fitted.split) * BLOCK_ROWS)
    index = classes.select("ids", "vector").mapInArrow(
        _put_into_leaves(forest), "tree int, leaf int, ids array<long>, vector array<double>"
    )
    dealt = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = index.withColumn("mb", F.pmod(F.xxhash64("vector"), F.lit(member_blocks)).cast("int")).withColumn("qb", dealt(query_blocks))
    visits = named.select("query", "vector").mapInArrow(_visit(forest), "tree int, leaf int, query long, vector array<double>")
    visits = visits.withColumn("qb", F.pmod(F.xxhash64("query"), F.lit(query_blocks)).cast("int")).withColumn("mb", dealt(member_blocks))
    keys = ["tree", "leaf", "mb", "qb"]
    lists = "query long, ids array<long>, scores array<double>"
    found = visits.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(_rank_leaf(k + 1), lists)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = found.repartition(tasks, "query").sortWithinPartitions("query").mapInArrow(_merge(k + 1), lists)
    answers = asked.select(F.col("id").alias("query_id"), "query").distinct().join(merged, "query")
    pairs = F.filter(F.arrays_zip("ids", "scores"), lambda p: p["ids"] != F.col("query_id"))
    each = answers.select("query_id", F.slice(pairs, 1, k).alias("pairs"))
    best = each.select("query_id", F.posexplode("pairs").alias("i", "p")).select(
        "query_id", (F.col("i") + 1).alias("rank"), F.col("p.ids").alias("vec_id"), F.col("p.scores").alias("score")
    )
    return best


def op5_random_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), 20, lambda id: id % 20 == 0)
