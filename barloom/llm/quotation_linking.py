"""Chat formatting by quotation linking, in built-in functions only.

Lines that begin with ``>`` quote; the number of ``>`` is the level. A message's quoted
passages are normalised (case, white space), cut into units and hashed, and joined to the
first message of the conversation that says the same in its own words. Units are lines, all
lines of one level together, runs of lines of one level, their paragraphs and sentences, and
runs of ``WORDS`` words, so that neither new line breaks nor a choice of passages matter. The
message answered is the one most of whose text is quoted at the least level with a find. Messages are ordered by the first message of their
thread and their turn, so each comes after what it answers, and lose their quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.shared import column, table, written

#: Words of a unit that may begin anywhere.
WORDS = 8
_SENTENCE_END = r"(?<=[.!?\u2026])\x20+|(?<=[\u3002\uFF01\uFF1F])\x20*"
_QUOTE = r"^[\x20\x09]*(>[\x20\x09>]*)"


def _normal(text: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")))


def _lines(text: Column) -> Column:
    """Array of (level, body) of a text's lines."""

    def parse(line: Column) -> Column:
        marks = F.regexp_extract(line, _QUOTE, 1)
        level = F.length(marks) - F.length(F.translate(marks, ">", ""))
        return F.struct(level.alias("level"), F.regexp_replace(line, _QUOTE, "").alias("body"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), parse)


def _units(level: Column) -> Column:
    """Normalised units of the lines of one level, each once, without empty ones."""
    bodies = F.transform(F.filter("lines", lambda x: x["level"] == level), lambda x: _normal(x["body"]))
    some = F.filter(bodies, lambda x: x != "")

    def marked(line: Column) -> Column:
        body = _normal(F.translate(line["body"], "\x1d\x1e", "  "))
        return F.when(line["level"] != level, "\x1e").when(body == "", "\x1d").otherwise(body)

    # Lines of another level end a run, empty lines a paragraph.
    told = F.array_join(F.transform("lines", marked), " ")
    runs = F.transform(F.split(told, "\x1e"), lambda x: _normal(F.translate(x, "\x1d", " ")))
    paragraphs = F.transform(F.split(told, "[\x1d\x1e]"), _normal)
    sentences = F.flatten(F.transform(paragraphs, lambda x: F.split(x, _SENTENCE_END)))
    words = F.flatten(F.transform(runs, lambda x: _word_runs(F.split(x, " "))))
    units = F.concat(some, F.array(F.array_join(some, " ")), runs, paragraphs, sentences, words)
    return F.array_distinct(F.filter(units, lambda x: x != ""))


def _word_runs(words: Column) -> Column:
    begins = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - (WORDS - 1)))
    return F.transform(begins, lambda i: F.array_join(F.slice(words, i, WORDS), " "))


def _messages(conversations: DataFrame) -> DataFrame:
    out = conversations.select("conv_id", "turn", "role", column("text").cast("string").alias("text"))
    return out.withColumn("lines", _lines(F.col("text")))


def links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, source_turn, chars): for each quoting message and level, how much of which earlier message."""
    quoting = messages.where(F.col("turn").isNotNull() & F.exists("lines", lambda x: x["level"] > 0))
    levels = F.array_distinct(F.filter(F.transform("lines", lambda x: x["level"]), lambda x: x > 0))
    quoted = quoting.select("conv_id", "turn", "lines", F.explode(levels).alias("level"))
    quoted = quoted.select("conv_id", "turn", "level", F.explode(_units(F.col("level"))).alias("unit"))
    hashes = [F.xxhash64("unit").alias("h1"), F.xxhash64(F.lit(1), "unit").alias("h2")]
    quoted = quoted.select("conv_id", "turn", "level", *hashes, F.length("unit").alias("chars"))
    talks = quoting.select("conv_id").distinct()
    said = messages.where(F.col("turn").isNotNull()).join(talks, ["conv_id"], "left_semi")
    own = said.select("conv_id", "turn", F.explode(_units(F.lit(0))).alias("unit"))
    first = own.select("conv_id", "turn", *hashes).groupBy("conv_id", "h1", "h2").agg(F.min("turn").alias("source_turn"))
    found = quoted.distinct().join(first, ["conv_id", "h1", "h2"]).where(F.col("source_turn") < F.col("turn"))
    return found.groupBy("conv_id", "turn", "level", "source_turn").agg(F.sum("chars").alias("chars"))


def threads(found: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, thread_turn) of messages that answer another; thread_turn is the first one's turn.

    The way to the first is halved each round, so rounds grow with the logarithm of the longest chain.
    """
    best = found.groupBy("conv_id", "turn").agg(
        F.max(F.struct((-F.col("level")).alias("l"), "chars", F.col("source_turn").alias("s"))).alias("best")
    )
    now = written(best.select("conv_id", "turn", F.col("best.s").alias("parent_turn"), F.col("best.s").alias("thread_turn")), "threads")
    while True:
        up = now.select("conv_id", F.col("turn").alias("thread_turn"), F.col("thread_turn").alias("next"))
        moved = now.join(up, ["conv_id", "thread_turn"], "left")
        if moved.where("next is not null").isEmpty():
            return now
        now = written(
            moved.select("conv_id", "turn", "parent_turn", F.coalesce("next", "thread_turn").alias("thread_turn")), "threads"
        )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, thread_turn, turn, parent_turn, role, n_quoted_lines, text, formatted) for each message.

    Ordered by conv_id, thread_turn and turn, a conversation's messages follow what they
    answer. ``text`` has the message's own lines, ``formatted`` the role and the text as one
    chat turn. A conversation is not gathered into one row, as nothing bounds its length. A
    message that quotes nothing found starts a thread of its own. Null texts are empty; a null
    role is "unknown"; messages without a turn or a conversation are not linked; repeated
    rows repeat; other columns are not read; an empty table gives an empty one.
    """
    messages = _messages(conversations)
    tree = threads(links(messages.where(F.col("conv_id").isNotNull())))
    own = F.btrim(
        F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"]), "\n"), F.lit(" \t\n\r")
    )
    told = messages.join(tree, ["conv_id", "turn"], "left").select(
        "conv_id",
        F.coalesce("thread_turn", "turn").alias("thread_turn"),
        "turn",
        "parent_turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("long").alias("n_quoted_lines"),
        own.alias("text"),
    )
    return told.withColumn("formatted", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text")))


def op6_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_conversations(table(spark, sf_dir, "conversations"))
