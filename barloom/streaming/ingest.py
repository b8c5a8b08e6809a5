"""The incremental load as a stream over the landing folder, its marks kept as state of the stream.

State is one row per source and symbol: the newest run date seen, the mark its bars must be later than, and the latest bar
seen. A run date is one delivery, so its files are held against the same mark however many micro-batches they
come in; of two files with one bar the later name wins in the table. So the bars are those of the batch
load, whatever the number of files in a micro-batch and wherever the stream was stopped. The state lies in the checkpoint
folder, which must be shared storage; a new stream takes over the stored marks of the tables once. While a stream loads a
table, routine batch loads should not.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barloom import schemas as S
from barloom.operators import staging
from barloom.plans.load import BARS_ADDED, add_bars, keep_rejects, keep_staged, load_order
from barloom.session import use_utc
from barloom.sources import tables as tb
from barloom.sources.payloads import LANDING

#: Rejected entries change no mark; they are spread over this many groups instead of one for all without a symbol.
REJECT_GROUPS = 64
MARKS = T.StructType([S.BARS["source"], S.BARS["symbol"], S.BARS["ts"]])
STATE = T.StructType(
    [
        T.StructField("run_date", T.DateType()),
        T.StructField("mark", T.TimestampType()),
        T.StructField("latest", T.TimestampType()),
    ]
)
#: Through Python numbers go as text, which is exact and may be null.
NUMBERS = [*S.PRICE_COLUMNS, "volume"]
ROWS = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name in NUMBERS else f.dataType) for f in S.BARS.fields]
    + [
        T.StructField("zone", T.StringType()),
        T.StructField("raw_date", T.StringType()),
        T.StructField(staging.REASON, T.StringType()),
        T.StructField("run_date", T.DateType()),
        T.StructField("load_order", T.StringType()),
        T.StructField("is_mark", T.BooleanType()),
    ]
)


def landing_stream(
    spark: SparkSession, landing: str, max_files: int | None = None, by_line: bool = False
) -> DataFrame:
    """Landed payloads as they arrive, with their run date and file: one per file, or one per line."""
    reader = spark.readStream.schema(LANDING)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.text(landing, wholetext=not by_line)
        .select("value", "run_date", F.col("_metadata.file_path").alias("file"))
    )


def later_than_marks(names: list[str]):
    """A function that gives the rows of a source and symbol that are later than its mark, and all rejects, and moves the mark.

    A group holds what one micro-batch brings of a symbol. The function goes to the executors by value: they need not have this package.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        date, mark, latest = state.get if state.exists else (None, None, None)
        rows = pd.concat(list(frames), ignore_index=True)
        known = rows["is_mark"].astype(bool)
        if known.any():
            latest = max(t for t in (latest, rows.loc[known, "ts"].max()) if t is not None)
        rejected = rows["reject_reason"].notna() & ~known
        kept = [rows[rejected]]
        typed = rows[~known & ~rejected]
        dates = typed["run_date"].where(typed["run_date"].notna(), dt.date.min)
        for one in sorted(set(dates)):
            part = typed[dates == one]
            if date is None or one > date:
                date, mark = one, latest
            floor = mark if one == date else latest
            kept.append(part if floor is None else part[part["ts"] > floor])
            newest = part["ts"].max()
            latest = newest if latest is None else max(latest, newest)
        if latest is not None:
            state.update((date, mark, latest))
        yield pd.concat(kept, ignore_index=True)[names]

    return run


def _rows(stream: DataFrame) -> DataFrame:
    parsed = staging.parse_payloads(stream)
    columns = [F.col(f.name).cast(f.dataType) for f in ROWS.fields if f.name not in ("load_order", "is_mark")]
    return parsed.select(*columns, load_order(parsed).alias("load_order"), F.lit(False).alias("is_mark"))


def _stored_marks(spark: SparkSession, root: str, checkpoint: str) -> DataFrame:
    """The marks that were stored when this stream first started, as rows of the stream."""
    path = f"{checkpoint.rstrip('/')}-marks"
    try:
        spark.read.schema(MARKS).parquet(path).limit(0).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        state = tb.read_table(spark, root, tb.LOAD_STATE)
        state.select("source", "symbol", F.col("last_watermark").alias("ts")).coalesce(1).write.parquet(path)
    marks = spark.readStream.schema(MARKS).parquet(path)
    columns = {f.name: F.lit(None).cast(f.dataType) for f in ROWS.fields}
    columns |= {name: F.col(name) for name in MARKS.names} | {"is_mark": F.lit(True)}
    return marks.select(*[column.alias(name) for name, column in columns.items()])


def new_rows(spark: SparkSession, landing: DataFrame, root: str, checkpoint: str) -> DataFrame:
    """Typed rows of the stream that are later than their marks, and rejects."""
    rows = _rows(landing).unionByName(_stored_marks(spark, root, checkpoint))
    spread = F.concat(F.lit("reject "), F.pmod(F.xxhash64("raw_date", "load_order"), F.lit(REJECT_GROUPS)).cast("string"))
    group = F.when(F.col(staging.REASON).isNull(), F.col("symbol")).otherwise(spread)
    kept = rows.withColumn("_group", group).groupBy("source", "_group").applyInPandasWithState(
        later_than_marks(ROWS.names), ROWS, STATE, "append", GroupStateTimeout.NoTimeout
    )
    types = {f.name: f.dataType for f in S.BARS.fields}
    return kept.select(*[F.col(n).cast(types[n]).alias(n) if n in NUMBERS else F.col(n) for n in ROWS.names if n != "is_mark"])


def write_batch(root: str, checkpoint: str, strict: bool, now: dt.datetime | None = None):
    """Writes a micro-batch as one batch of the tables; one that was finished before is passed over when it is replayed."""
    consumer = f"stream {checkpoint}"

    def write(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        done = tb.read_table(spark, root, tb.CONSUMED).where((F.col("consumer") == consumer) & (F.col("source_batch") == str(number)))
        if not done.isEmpty():
            return
        at = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        batch = tb.new_batch()
        # Written first: every reading of a micro-batch would run the stream's state again.
        staged, rejected = keep_staged(spark, root, rows, batch, strict)
        changed = keep_rejects(spark, root, staged, batch, at.date()) if rejected else {}
        nothing = spark.createDataFrame([], S.LOAD_STATE)
        if add_bars(spark, root, staging.accepted(staged).drop("zone", "run_date"), batch, at, nothing):
            changed |= BARS_ADDED
        if changed:
            read = spark.createDataFrame([(None, str(number))], "trading_date date, source_batch string")
            tb.consume(root, tb.BARS, consumer, read, batch)
            tb.finish(spark, root, batch, changed | {tb.CONSUMED: False})

    return write


def start_ingest(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    strict: bool = False,
    available_now: bool = True,
    interval: str = "1 minute",
    max_files: int | None = None,
    by_line: bool = False,
    now: dt.datetime | None = None,
) -> StreamingQuery:
    """Start loading the landing folder; by default stop when all present files are loaded."""
    use_utc(spark)
    stream = landing_stream(spark, landing, max_files, by_line)
    writer = (
        new_rows(spark, stream, root, checkpoint)
        .writeStream.foreachBatch(write_batch(root, checkpoint, strict, now))
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
