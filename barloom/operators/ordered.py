"""Window results over groups of any size.

A plain window sorts a whole group in one task; a symbol or a day that holds a large
part of all rows would stall the job there. Groups are therefore counted first (one
column, reduced before its shuffle). Without large groups the plain window does. Large ones
are cut where quantile sketches of their keys say: each level of cutting sums up one mergeable sketch
for each piece that is still too large, and cuts it into up to ``FAN`` pieces at its quantiles, until no piece
is larger than a task should take, whatever its range: a hot minute, or values that share all but their last digits.
Only rows with one and the same key stay together. Pieces are summed up in a small aggregate, a prefix scan
over it gives each what it needs from the pieces before, and that reaches it as one extra *seed row*.

The cuts are written to the shared work folder, so every later step sees the same ones. There is at
most one for each ``rows_per_task / FAN`` rows of a large group; they meet the rows by a join without hints.
Seeds travel by union, and large groups are looked up null-safe, so NULL keys stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import written

ROWS_PER_TASK = 2_000_000
#: Pieces that one level of cutting makes of one at most, and the size of the sketches it cuts by.
FAN, SKETCH = 64, 800

PIECE = "_piece"
IS_ROW = "_is_row"
CARRY = "_carry"
LARGE = "_large_group"
CUTS = "_cuts"
KEY = "_key"


def large_groups(df: DataFrame, group: str, rows_per_task: int, size: Column | None = None) -> DataFrame:
    """The groups with more rows than one task should take: fewer than all rows over ``rows_per_task``."""
    size = F.count(F.lit(1)) if size is None else size
    sizes = df.groupBy(F.col(group).alias(LARGE)).agg(size.alias("_n"))
    return written(sizes.where(F.col("_n") > rows_per_task).select(LARGE), "large-groups")


def piece_of(key: Column, cuts: Column, most: int) -> Column:
    """How many cuts are not above the key, by halving; one more than there are for a NULL key.

    ``most`` is the number of cuts that any group has at most.
    """
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, most.bit_length())))])
    below = lambda at, step: (at + step <= F.size(cuts)) & (F.get(cuts, at + step - 1) <= key)
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(below(at, step), at + step).otherwise(at))
    return F.when(key.isNull(), F.size(cuts) + 1).otherwise(found)


def cut_points(keys: DataFrame, large: DataFrame, rows_per_task: int) -> tuple[DataFrame, int]:
    """(group, cuts) of the large groups and the largest number of cuts; ``keys`` has the group as LARGE, and KEY."""
    cuts = large.select(LARGE, F.array().cast("array<bigint>").alias(CUTS))
    most, among = 0, F.col(LARGE).eqNullSafe(F.col("_of"))
    ranks = F.array(*[F.lit(i / FAN) for i in range(1, FAN)])
    while True:
        placed = keys.join(cuts.withColumnRenamed(LARGE, "_of"), among).where(F.col(KEY).isNotNull())
        placed = placed.select(LARGE, KEY, piece_of(F.col(KEY), F.col(CUTS), most).alias(PIECE))
        sized = placed.groupBy(LARGE, PIECE).agg(
            F.count(F.lit(1)).alias("_n"),
            F.min(KEY).alias("_min"),
            F.max(KEY).alias("_max"),
            F.kll_sketch_agg_bigint(KEY, F.lit(SKETCH)).alias("_sketch"),
        )
        # A piece begins at its cut, so the least key is none; the largest always is one, so every level gets on.
        within = F.filter(
            F.array_union(F.kll_sketch_get_quantile_bigint("_sketch", ranks), F.array("_max")), lambda c: c > F.col("_min")
        )
        found = sized.where((F.col("_n") > rows_per_task) & (F.col("_min") < F.col("_max"))).select(LARGE, F.explode(within).alias("_cut"))
        found = written(found, "cuts")
        if found.isEmpty():
            return cuts, most
        every = cuts.select(LARGE, F.explode_outer(CUTS).alias("_cut")).unionByName(found).groupBy(LARGE).agg(F.sort_array(F.collect_set("_cut")).alias(CUTS))
        cuts = written(every, "cut-points")
        most = cuts.agg(F.max(F.size(CUTS))).first()[0]


def _cut(df: DataFrame, group: str, key: Column, rows_per_task: int) -> DataFrame | None:
    """Rows with the piece of their group, NULL in groups that stay whole; None if all do."""
    large = large_groups(df, group, rows_per_task)
    if large.isEmpty():
        return None
    cuts, most = cut_points(df.select(F.col(group).alias(LARGE), key.alias(KEY)), large, rows_per_task)
    marked = df.join(cuts, F.col(group).eqNullSafe(F.col(LARGE)), "left")
    return marked.select(*df.columns, F.when(F.col(CUTS).isNotNull(), piece_of(key, F.col(CUTS), most)).alias(PIECE))


def row_numbers_latest_first(
    df: DataFrame, group: str, ts: str, out: str = "row_num", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Number the rows of each group from the latest back; NULL times come first."""
    latest = F.col(ts).desc_nulls_first()
    cut = _cut(df, group, F.unix_micros(ts), rows_per_task)
    if cut is None:
        numbers = F.row_number().over(Window.partitionBy(group).orderBy(latest))
        return df.withColumn(out, numbers.cast("bigint"))
    later = Window.partitionBy(group).orderBy(F.col(PIECE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    seeds = (
        cut.where(F.col(PIECE).isNotNull())
        .groupBy(group, PIECE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(group, PIECE, F.coalesce(F.sum("_n").over(later), F.lit(0)).alias(CARRY), F.lit(0).alias(IS_ROW))
    )
    rows = cut.withColumn(CARRY, F.lit(1).cast("bigint")).withColumn(IS_ROW, F.lit(1))
    running = Window.partitionBy(group, PIECE).orderBy(IS_ROW, latest).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.unionByName(seeds, allowMissingColumns=True)
        .withColumn(out, F.sum(CARRY).over(running))
        .where(F.col(IS_ROW) == 1)
        .select(*df.columns, out)
    )


def previous_value(
    df: DataFrame, group: str, ts: str, value: str, out: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The value of the row before, in time order within the group; NULL times come last."""
    in_time = F.col(ts).asc_nulls_last()
    cut = _cut(df, group, F.unix_micros(ts), rows_per_task)
    if cut is None:
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(group).orderBy(in_time)))
    by_time = Window.partitionBy(group).orderBy(PIECE)
    seeds = (
        cut.where(F.col(PIECE).isNotNull())
        .groupBy(group, PIECE)
        .agg(F.max_by(value, ts).alias("_last"))
        .select(group, PIECE, F.lag("_last").over(by_time).alias(value), F.lit(0).alias(IS_ROW))
    )
    before = Window.partitionBy(group, PIECE).orderBy(IS_ROW, in_time)
    return (
        cut.withColumn(IS_ROW, F.lit(1))
        .unionByName(seeds, allowMissingColumns=True)
        .withColumn(out, F.lag(value).over(before))
        .where(F.col(IS_ROW) == 1)
        .select(*df.columns, out)
    )


def dense_rank_highest_first(
    df: DataFrame, group: str, value: str, out: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Dense rank of whole numbers within each group, highest first, NULL before all.

    One aggregate by group and value gives the sizes of the groups and the distinct values to rank. In large groups these
    are ranked, piece by piece, and joined back, so rows that share a value never have to meet in one task.
    """
    highest = F.col(value).desc_nulls_first()
    values = written(df.groupBy(F.col(group).alias(LARGE), F.col(value).alias(KEY)).agg(F.count(F.lit(1)).alias("_n")), "values")
    large = large_groups(values, LARGE, rows_per_task, F.sum("_n"))
    whole = F.dense_rank().over(Window.partitionBy(group).orderBy(highest))
    if large.isEmpty():
        return df.withColumn(out, whole)
    is_large = F.col(group).eqNullSafe(F.col(LARGE))
    small_ranked = df.join(large, is_large, "left_anti").withColumn(out, whole)

    cuts, most = cut_points(values.select(LARGE, KEY), large, rows_per_task)
    cuts = cuts.withColumnRenamed(LARGE, "_of")
    distinct = values.join(cuts, F.col(LARGE).eqNullSafe(F.col("_of"))).select(LARGE, KEY, piece_of(F.col(KEY), F.col(CUTS), most).alias(PIECE))
    higher = Window.partitionBy(LARGE).orderBy(F.col(PIECE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    seeds = (
        distinct.groupBy(LARGE, PIECE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(LARGE, PIECE, F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias(CARRY), F.lit(0).alias(IS_ROW))
    )
    running = (
        Window.partitionBy(LARGE, PIECE)
        .orderBy(IS_ROW, F.col(KEY).desc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranks = (
        distinct.withColumn(CARRY, F.lit(1).cast("bigint"))
        .withColumn(IS_ROW, F.lit(1))
        .unionByName(seeds, allowMissingColumns=True)
        .withColumn(out, F.sum(CARRY).over(running).cast("int"))
        .where(F.col(IS_ROW) == 1)
        .select(F.col(LARGE).alias("_group"), F.col(KEY).alias("_value"), out)
    )
    # Null-safe on both columns: NULLs are ranked too.
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(value).eqNullSafe(F.col("_value"))
    large_ranked = df.join(large, is_large, "left_semi").join(ranks, same, "left").select(*df.columns, out)
    return small_ranked.unionByName(large_ranked)
