"""Toxicity: class-conditional Kneser-Ney models of texts as strings of bytes.

Texts are letters and digits in lower case, words parted by one space. Both classes share the
lower orders of an interpolated Kneser-Ney model of order 4: continuation counts, pooled over all
labelled texts. The ordinary model has the counts of ordinary texts after each context of three bytes and backs
off to the shared orders. The toxic model has those of toxic texts, far fewer, and backs off, by absolute discounting with
a concentration, to the counts of both classes after the same context, and these to the shared orders: an expression
that is rare among toxic texts costs about the same in both models, and only what labels show often enough moves them
apart. A text's measure is the difference of its log-likelihoods, toxic less ordinary, over its number of words, which
a logistic curve, fitted to labelled texts that the models have not seen, turns into a score.

Counts come from all labelled texts whose crc32(id) mod 5 is 1, 2 or 3, and grow with them.
A byte's measure depends on its context, if toxic texts have it, and on itself if labelled texts have it there.
Contexts are three bytes, so their number is bounded; values
of grams go to the tasks ``HELD`` at a time, in as many passes as it takes. Texts with remainder 4 fit the curve (``CURVE_ROWS`` at most); those with 0 are held out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import words as W
from barloom.llm.shared import append_columns, column, small_batches, table, written

ORDER = 4
DISCOUNT = 0.75
TOXIC_DISCOUNT, CONCENTRATION = 1.0, 200.0
#: Values of grams that a task holds at a time, 16 bytes each.
HELD = 4_000_000
CURVE_ROWS = 50_000
FOLDS = 5


def spelled(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """The last ``ORDER`` bytes up to each byte of a block's words and the space after each, and the text of each.

    Bytes are packed into an integer, the last one lowest; before a text there are spaces.
    """
    size = block.end - block.start + 1
    last = np.cumsum(size) - 1
    flat = np.full(int(size.sum()), 32, np.int64)
    inside = np.ones(len(flat), bool)
    inside[last] = False
    source = np.arange(len(flat)) + np.repeat(block.start - (last + 1 - size), size)
    flat[inside] = W.LOWER[block.data[source[inside]]]
    sizes = np.concatenate(([0], np.cumsum(size)))[block.first]
    text = np.repeat(np.arange(len(sizes) - 1), np.diff(sizes))
    place = np.arange(len(flat)) - np.repeat(sizes[:-1], np.diff(sizes))
    gram = flat.copy()
    for back in range(1, ORDER):
        before = np.full(len(flat), 32, np.int64)
        before[back:] = np.where(place[back:] >= back, flat[:-back], 32)
        gram |= before << (8 * back)
    return gram, text


def _count_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (toxic, text) to (toxic, gram, n), added up within a block."""
    for batch in small_batches(batches):
        toxic = batch.column(0).to_numpy()
        for block in W.blocks(batch.column(1), W.ALNUM_BYTE):
            gram, text = spelled(block)
            label = toxic[block.rows][text]
            for which in (0, 1):
                grams, n = np.unique(gram[label == which], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(grams), which, np.int32)), pa.array(grams), pa.array(n)], names=["toxic", "gram", "n"]
                )


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out, at = np.unique(keys, return_inverse=True)
    return out, np.bincount(at, weights=weights, minlength=len(out))


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of keys in a sorted table; 0 where absent."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


class Shared:
    """The orders below 4 that both classes share, from (last three bytes of a gram, different bytes before them)."""

    def __init__(self, suffixes: tuple[np.ndarray, ...]):
        self.grams: list = [None] * ORDER
        self.grams[ORDER - 1] = _sums(*suffixes)
        for k in range(ORDER - 2, 0, -1):
            shorter = self.grams[k + 1][0] & ((1 << 8 * k) - 1)
            self.grams[k] = _sums(shorter, np.ones(len(shorter)))
        self.contexts = [None] + [
            (*_sums(g >> 8, n), _sums(g >> 8, np.full(len(g), DISCOUNT))[1]) for g, n in self.grams[1:]
        ]

    def probability(self, gram: np.ndarray) -> np.ndarray:
        """Of the last byte of grams after the two before it, interpolated from the lowest order up."""
        p = np.full(len(gram), 1 / 256)
        for k in range(1, ORDER):
            suffix = gram & ((1 << 8 * k) - 1)
            keys, total, held = self.contexts[k]
            n, back = _find(keys, total, suffix >> 8), _find(keys, held, suffix >> 8)
            count = np.maximum(_find(*self.grams[k], suffix) - DISCOUNT, 0)
            p = np.where(n > 0, (count + back * p) / np.maximum(n, 1e-300), p)
        return p


class Contexts:
    """Contexts of some texts: how often each occurs, and how many different bytes follow it."""

    def __init__(self, keys: np.ndarray, total: np.ndarray, different: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.total, self.different = keys[order], total[order], different[order]

    def at(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _find(self.keys, self.total, contexts), _find(self.keys, self.different, contexts)

    def probability(self, gram: np.ndarray, counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Of the last byte of grams that occur ``counts`` times, interpolated with the lower orders."""
        total, different = self.at(gram >> 8)
        return np.where(total > 0, (np.maximum(counts - DISCOUNT, 0) + DISCOUNT * different * lower) / np.maximum(total, 1), lower)

    def back_off(self, contexts: np.ndarray) -> np.ndarray:
        """The part of the lower orders after each context: all of it where the context does not occur."""
        total, different = self.at(contexts)
        return np.where(total > 0, DISCOUNT * different / np.maximum(total, 1), 1.0)


class Values:
    """Parts of log P(a byte after those before it, toxic) - the same, ordinary: by the context, and more by the gram."""

    def __init__(self, contexts: tuple[np.ndarray, np.ndarray], grams: tuple[np.ndarray, np.ndarray]):
        self.contexts, self.grams = contexts, grams

    def texts(self, block: W.Block) -> np.ndarray:
        """The difference of log-likelihoods of each text over its number of words; 0 without words."""
        gram, text = spelled(block)
        value = _find(*self.contexts, gram >> 8) + _find(*self.grams, gram)
        return np.bincount(text, weights=value, minlength=len(block.first) - 1) / np.maximum(1, block.counts)


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton's method with a small penalty on the slope."""
    base = np.log((y.sum() + 1.0) / (len(y) - y.sum() + 1.0)) if len(y) else 0.0
    if not len(y) or y.min() == y.max():
        return 0.0, float(base)
    middle, spread = x.mean(), x.std() or 1.0
    z = np.stack(((x - middle) / spread, np.ones(len(x))), axis=1)
    theta, penalty = np.array([0.0, base]), np.diag([1e-2, 1e-9])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        gradient = z.T @ (y - p) - penalty @ theta
        change = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(2), gradient)
        theta = theta + np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-9:
            break
    return float(theta[0] / spread), float(theta[1] - theta[0] * middle / spread)


def fold(id: str):
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.pmod(F.crc32(column(id).cast("string").cast("binary")), F.lit(FOLDS))


def labelled_texts(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str) -> DataFrame:
    """(id, fold, toxic, text) of the labelled texts that may be learned from. Texts are joined by one shuffle at every size."""
    known = labels.where(column(label).isNotNull()).groupBy(column(id).alias("__id")).agg(F.max(column(label).cast("int")).alias("toxic"))
    rows = docs.where(fold(id) > 0).select(column(id).alias("__id"), fold(id).alias("fold"), column(text).cast("string").alias("text"))
    joined = rows.hint("merge").join(known.where(F.col("toxic").isin(0, 1)).hint("merge"), "__id")
    return written(joined.select(F.col("__id").alias("id"), "fold", "toxic", "text"), "labelled")


def fit_models(labelled: DataFrame) -> Iterator[Values]:
    """The model in parts whose measures add up; one, up to ``HELD`` values of grams."""
    counted = (
        labelled.where("fold < 4")
        .select("toxic", "text")
        .mapInArrow(_count_grams, "toxic int, gram long, n long")
        .groupBy("gram")
        .agg(F.sum(F.expr("if(toxic = 0, n, 0)")).alias("ordinary"), F.sum(F.expr("if(toxic = 1, n, 0)")).alias("toxic"))
    )
    counted = written(counted, "grams")

    def arrays(df: DataFrame) -> tuple[np.ndarray, ...]:
        found = df.toArrow()
        return tuple(found.column(i).to_numpy().astype(float if i else np.int64) for i in range(found.num_columns))

    context, every = F.shiftright("gram", 8).alias("context"), F.col("ordinary") + F.col("toxic")
    suffix = F.col("gram").bitwiseAND(F.lit((1 << 8 * (ORDER - 1)) - 1)).alias("suffix")
    shared = Shared(arrays(counted.groupBy(suffix).count()))
    contexts = counted.groupBy(context)
    ordinary = Contexts(*arrays(contexts.agg(F.sum("ordinary").alias("n"), F.count_if(F.col("ordinary") > 0)).where("n > 0")))
    toxic = Contexts(*arrays(contexts.agg(F.sum("toxic").alias("n"), F.count_if(F.col("toxic") > 0)).where("n > 0")))
    pooled = Contexts(*arrays(contexts.agg(F.sum(every), F.count("*"))))
    # What the discount takes off all grams of a context, and the concentration, is the share of the counts of both classes.
    share = TOXIC_DISCOUNT * toxic.different + CONCENTRATION
    # A byte that labelled texts do not have after a context is left to the shared orders by all counts.
    unseen = share / (toxic.total + CONCENTRATION) * pooled.back_off(toxic.keys) / ordinary.back_off(toxic.keys)
    by_context = np.log(unseen)
    # After a context that toxic texts do not have, the two models agree.
    more = counted.join(counted.where("toxic > 0").select(context).distinct(), context == F.col("context"), "left_semi")
    more = written(more, "values")
    parts = max(1, -(-more.count() // HELD))
    for part in range(parts):
        gram, often, seldom = arrays(more.where(F.pmod(F.xxhash64("gram"), F.lit(parts)) == part).select("gram", "toxic", "ordinary"))
        order = np.argsort(gram)
        gram, often, seldom = gram[order], often[order], seldom[order]
        lower = shared.probability(gram)
        both = pooled.probability(gram, often + seldom, lower)
        own = _find(toxic.keys, share, gram >> 8)
        total = _find(toxic.keys, toxic.total, gram >> 8)
        as_toxic = (np.maximum(often - TOXIC_DISCOUNT, 0) + own * both) / (total + CONCENTRATION)
        value = np.log(as_toxic / ordinary.probability(gram, seldom, lower)) - _find(toxic.keys, by_context, gram >> 8)
        yield Values((toxic.keys, by_context) if part == 0 else (toxic.keys[:0], by_context[:0]), (gram, value))


def measured(docs: DataFrame, text: str, models: list) -> DataFrame:
    """``docs`` and __measure, from the broadcast parts of the model; more than one are added up pass by pass."""
    out = None
    for model in models:

        def make(texts: pa.Array, model=model) -> list[pa.Array]:
            found = [model.value.texts(b) for b in W.blocks(texts, W.ALNUM_BYTE)]
            return [pa.array(np.concatenate(found) if found else np.zeros(0))]

        if out is None:
            out = append_columns(docs, text, "__measure double", make)
        else:
            added = append_columns(written(out, "measured"), text, "__more double", make)
            out = added.withColumn("__measure", F.col("__measure") + F.col("__more")).drop("__more")
    return out


def score(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", keep: list[str] | None = None
) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all, if not given) and held_out, score and predicted.

    ``labels`` (id, label 0 or 1): null labels are no labels, and an id labelled twice is
    toxic if either label is. Null and empty texts have a measure of 0; rows with null ids
    are scored and never learned from; repeated rows score alike. Without labels of both
    classes every score is the share of toxic labels, or 0.5. Columns of ``docs`` with the
    name of an added one are replaced; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    labelled = labelled_texts(docs, labels, id, text, label)
    models = [spark.sparkContext.broadcast(part) for part in fit_models(labelled)]
    names = ["held_out", "score", "predicted"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    chosen = docs.select(*[column(c) for c in dict.fromkeys([*keep, id, text])])
    every = measured(chosen, text, models)
    fitting = measured(labelled.where("fold = 4"), "text", models)
    curve = (
        fitting.select("id", "__measure", F.col("toxic").cast("double"))
        .orderBy(F.xxhash64("id", "__measure"))
        .limit(CURVE_ROWS)
        .select("__measure", "toxic")
        .toArrow()
    )
    slope, intercept = fit_curve(curve.column(0).to_numpy(), curve.column(1).to_numpy())
    value = 1 / (1 + F.exp(-(F.lit(slope) * F.col("__measure") + F.lit(intercept))))
    out = every.select(
        *[column(c) for c in keep],
        F.coalesce(fold(id) == 0, F.lit(False)).alias("held_out"),
        value.alias("score"),
    )
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
