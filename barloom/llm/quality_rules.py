"""Quality rules as a short-circuit cascade, in built-in functions only.

Each rule's cost (seconds) and rejections are measured alone on a bounded sample; rules
then run in the order of most rejections per cost, each only on rows that passed those
before it. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.shared import column, table, written

SAMPLE_ROWS = 2000
_SPACE = " \t\n\u000b\f\r"
_SPACES = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"
_PLACE = 10


@dataclass(frozen=True)
class Rule:
    """A row passes if ``passes`` is true; null counts as a rejection."""

    name: str
    passes: Column


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` (with a string column ``text``) and n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words.

    Null texts count as empty. Nothing is shuffled: a text's word triples are sorted within its row,
    and only if one of them occurs twice.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(body, F.lit(_SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACES))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(_SPACE)) != "")
    out = docs.withColumns({"__w": words, "__l": lines})
    w = F.col("__w")
    triples = F.when(
        F.size(w) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.concat_ws(" ", w[i], w[i + 1], w[i + 2])),
    ).otherwise(F.array().cast("array<string>"))
    out = out.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(F.translate(body, _SPACE, "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, _SYMBOLS, ""))).cast("long"),
            "n_lines": F.size("__l").cast("long"),
            "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
            "__t": triples,
        }
    )
    t = F.col("__t")
    # A triple's words hold no space, so equal triples are neighbours when sorted with their places.
    keys = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), F.size(t) - 1), lambda i: F.concat(t[i], F.lit(" "), F.lpad(i.cast("string"), _PLACE, "0"))
        )
    )
    out = out.withColumn("__k", F.when(F.size(F.array_distinct(t)) < F.size(t), keys))
    k = F.col("__k")
    same = lambda a, b: F.substring_index(a, " ", 3) == F.substring_index(b, " ", 3)
    last = F.size(k) - 1
    found = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: F.when(i > 0, same(k[i], k[F.greatest(i - 1, F.lit(0))])).otherwise(False)
        | F.when(i < last, same(k[i], k[F.least(i + 1, last)])).otherwise(False),
    )
    places = F.sort_array(F.transform(found, lambda i: F.right(k[i], F.lit(_PLACE)).cast("int")))
    out = out.withColumn("__p", F.when(k.isNotNull(), places))
    p = F.col("__p")
    covered = F.when(
        F.size(p) > 1,
        F.aggregate(F.sequence(F.lit(1), F.size(p) - 1), F.lit(3), lambda a, i: a + F.least(F.lit(3), p[i] - p[i - 1])),
    ).otherwise(0)
    out = out.withColumn("n_repeat_words", F.when(p.isNull(), 0).otherwise(covered).cast("long"))
    return out.drop("__w", "__l", "__t", "__k", "__p")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> list[Rule]:
    """Rules over the measured columns and the text; each holds for ordinary prose in any language."""
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.col("n_words")
    return [
        Rule("word_length", (F.col("word_chars") >= 2 * n) & (F.col("word_chars") <= 20 * n)),
        Rule("symbols", 10 * F.col("n_symbols") <= 3 * n),
        Rule("duplicate_lines", 10 * F.col("n_dup_lines") <= 3 * F.col("n_lines")),
        Rule("letters", 10 * F.length(F.regexp_replace(text, r"[^\p{L}]", "")) >= 6 * F.col("word_chars")),
        Rule("ellipsis_lines", 10 * F.regexp_count(text, F.lit(r"(?:\.\.\.|…)[\x20\x09\r]*(?:\n|\z)")) <= 3 * F.col("n_lines")),
        Rule("bullet_lines", 10 * F.regexp_count(text, F.lit(r"(?:\A|\n)[\x20\x09]*[-*•]")) <= 9 * F.col("n_lines")),
    ]


def ordered(sample: DataFrame, candidates: list[Rule]) -> list[Rule]:
    """The rules by rejections per second on the sample, most first; ties by name."""
    size = sample.count()

    def seconds_and_rejections(passes: Column) -> tuple[float, int]:
        began = time.perf_counter()
        rejected = sample.agg(F.sum(F.when(passes, 0).otherwise(1))).first()[0] or 0
        return time.perf_counter() - began, rejected

    if not size:
        return sorted(candidates, key=lambda r: r.name)
    empty = min(seconds_and_rejections(F.lit(True))[0] for _ in range(2))
    rate = {}
    for rule in candidates:
        took, rejected = seconds_and_rejections(rule.passes)
        rate[rule.name] = rejected / max(1e-4, took - empty)
    return sorted(candidates, key=lambda r: (-rate[r.name], r.name))


def cascade(chosen: list[Rule]) -> Column:
    """True for rows that pass all rules; a rule is only evaluated where those before it passed."""
    verdict = F.lit(True)
    for rule in reversed(chosen):
        verdict = F.when(F.coalesce(rule.passes, F.lit(False)), verdict).otherwise(False)
    return verdict


def judge(docs: DataFrame, id: str = "doc_id", text: str = "text", candidates: list[Rule] | None = None) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) for each row.

    Null texts count as empty and fail; repeated rows are judged alike; other columns of
    ``docs`` are not read; an empty table gives an empty one. The sample is drawn by a hash of the text.
    """
    rows = docs.select(column(id).alias("id"), column(text).cast("string").alias("text"))
    candidates = rules() if candidates is None else candidates
    every = 1 + rows.count() // SAMPLE_ROWS
    drawn = measure(rows.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0))
    chosen = ordered(written(drawn, "sample"), candidates)
    measured = measure(rows).withColumn("base_failed", base_failed())
    kept = F.when(F.col("base_failed"), False).otherwise(cascade(chosen))
    return measured.select(
        F.col("id").alias(id),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        kept.alias("kept"),
    )


def op4_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
