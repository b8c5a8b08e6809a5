"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

The repaired roles are an optional system row and pairs of user and assistant, or nothing.
Costs of the rows still to come are a vector over four states (nothing yet, system, user,
assistant). A walk over a conversation stores the backward vectors only at every square
root of its rows, computes those of a stretch anew when it gets there, and takes at each
place the ASCII-least edit that the vectors prove cheapest.

Rows are dealt by ranges of (conversation, turn), so a conversation of any length is a chain
of blocks in one or more tasks. A block that is a whole conversation is walked at once. Of the
others each gives the costs between its 4 first and 4 last states; one scan over these gives each
block the vector at its end (a checkpoint of the whole conversation), a second one, over the
states in which the walks of each block end, the state it begins in. Texts stay out of all this
and are joined to the edits by the number of their row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.shared import column, table, written

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the next user or assistant row.
NEXT = (USER, USER, ASSISTANT, USER)
#: What a row's role begins with, as it is coded: the state it leads to less one; others are 3.
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER = 3
SOUND, UNFIT, TRUNCATED = 0, 4, 8
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 1, 2, 5, 5
#: Costs at the end of a conversation, with the rows to insert there.
END = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 40
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Rows of a conversation that one block holds at most; longer ones are chains of blocks.
BLOCK_ROWS = 1 << 16
_SPACE = " \t\n\u000b\f\r"


def step(after: tuple, code: int) -> tuple:
    """The vector before a row, rows inserted there included, from the one after it."""
    own, extra = code & 3, LEFT_TRUNCATED if code & TRUNCATED else 0
    here = [cost + DELETE for cost in after]
    if not code & UNFIT:
        for state, to in enumerate(NEXT):
            here[state] = min(here[state], after[to] + extra + (0 if own + 1 == to else REROLE))
        if own + 1 == SYSTEM:
            here[NOTHING] = min(here[NOTHING], after[SYSTEM] + extra)
    nothing, system, user, assistant = here
    to_user, to_assistant = min(user, assistant + INSERT), min(assistant, user + INSERT)
    return (min(nothing, to_user + INSERT), min(system, to_user + INSERT), to_user, to_assistant)


def _matrices() -> np.ndarray:
    """For each code, the costs from each state before a row to each state after it."""
    ends = [tuple(0 if s == to else NEVER for s in range(4)) for to in range(4)]
    return np.array([[[step(end, code)[state] for end in ends] for state in range(4)] for code in range(12)], np.int64)


STEPS = _matrices()


def between(codes: bytes) -> np.ndarray:
    """Costs from each state before some rows to each state after them: the product of their matrices."""
    found = STEPS[np.frombuffer(codes, np.uint8)]
    while len(found) > 1:
        odd = found[len(found) & ~1 :]
        left, right = found[: len(found) & ~1 : 2], found[1::2]
        found = np.concatenate((np.minimum((left[:, :, :, None] + right[:, None, :, :]).min(axis=2), NEVER), odd))
    return found[0]


def step_back(codes: bytes, end: tuple) -> tuple:
    """The vector before some rows, from the one after them."""
    for code in reversed(codes):
        end = step(end, code)
    return end


def walk(codes: bytes, state: int, end: tuple, last: bool) -> tuple[str, int, int]:
    """The edits of some rows from a state on, the state they end in and their cost.

    ``end`` is the vector after the rows; with ``last`` the conversation ends there.
    """
    n, began = len(codes), state
    gap = max(1, isqrt(n))
    checkpoints, vector = {n: end}, end
    for i in range(n - 1, -1, -1):
        vector = step(vector, codes[i])
        if i % gap == 0:
            checkpoints[i] = vector
    first, edits = vector, []
    for begin in range(0, n, gap):
        stop = min(begin + gap, n)
        vectors = [checkpoints[stop]]
        for i in range(stop - 1, begin, -1):
            vectors.append(step(vectors[-1], codes[i]))
        vectors.append(checkpoints.pop(begin))
        for i in range(begin, stop):
            here, after, code = vectors.pop(), vectors[-1], codes[i]
            extra = LEFT_TRUNCATED if code & TRUNCATED else 0
            while here[state] != DELETE + after[state] and here[state] == INSERT + here[NEXT[state]]:
                edits.append("I")
                state = NEXT[state]
            if here[state] == DELETE + after[state]:
                edits.append("D")
            elif state == NOTHING and (code & 3) + 1 == SYSTEM and here[state] == extra + after[SYSTEM]:
                edits.append("K")
                state = SYSTEM
            else:
                state = NEXT[state]
                edits.append("K" if (code & 3) + 1 == state else "R")
    cost = first[began] - end[state]
    while last and END[state]:
        edits.append("I")
        state = NEXT[state]
        cost += INSERT
    return "".join(edits), state, cost


def _illegal(codes: bytes) -> int:
    return sum((a & 3, b & 3) not in LEGAL for a, b in zip(codes, codes[1:]))


_BLOCK = "block long, codes binary, ids binary, state int, audit string, cost long, illegal long, whole boolean"


def _blocks(conv: T.DataType, block_rows: int):
    """Rows (conv, code, id) in order to blocks; those that are whole conversations with their edits."""
    schema = T.StructType([T.StructField("conv", conv), *T.StructType.fromDDL(_BLOCK).fields])
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        kind, out, held = None, [], 0
        of, codes, ids, alone, first = None, bytearray(), [], True, True

        def close(whole: bool) -> None:
            nonlocal number, held, codes, ids
            text = bytes(codes)
            audit, _, cost = walk(text, NOTHING, END, True) if whole else (None, None, None)
            out.append((of, number, text, np.array(ids, np.int64).tobytes(), NOTHING if whole else None, audit, cost, _illegal(text), whole))
            number, held, codes, ids = number + 1, held + len(text), bytearray(), []

        def batch() -> pa.RecordBatch:
            nonlocal held
            types = [kind, pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
            out.clear()
            held = 0
            return made

        for rows in batches:
            kind = rows.schema.field(0).type
            for which, code, id in zip(*(rows.column(i).to_pylist() for i in range(3))):
                if ids and (which != of or len(ids) >= block_rows):
                    # The first and the last conversation of a task may go on in other tasks.
                    close(which != of and alone and not first)
                    first, alone = first and which == of, which != of
                of = which
                codes.append(code)
                ids.append(id)
            if held > 1 << 18:
                yield batch()
        if ids:
            close(False)
        if out:
            yield batch()

    return run, schema


def _ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, block, between), each conversation's last block first, to (block, end, last): the vector at the end of each block."""
    of, vector, seen = None, END, False
    for rows in batches:
        found = []
        for conv, block, costs in zip(*(rows.column(i).to_pylist() for i in range(3))):
            last = not seen or conv != of
            of, seen, vector = conv, True, END if last else vector
            found.append((block, list(vector), last))
            vector = tuple(int(c) for c in (np.frombuffer(costs, np.int64).reshape(4, 4) + np.array(vector)).min(axis=1))
        if found:
            block, end, last = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int64()), pa.array(end, pa.list_(pa.int64())), pa.array(last)], names=["block", "end", "last"]
            )


def _walks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, codes, end, last) to the walks of a block from each of the four states."""
    for rows in batches:
        for block, codes, end, last in zip(*(rows.column(i).to_pylist() for i in range(4))):
            audits, states, costs = zip(*(walk(codes, state, tuple(end), last) for state in range(4)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()),
                    pa.array([audits], pa.list_(pa.string())),
                    pa.array([states], pa.list_(pa.int32())),
                    pa.array([costs], pa.list_(pa.int64())),
                ],
                names=["block", "audits", "states", "costs"],
            )


def _begins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, block, states, first, last) in order to (block, state, joint): the state before each block, and if it joins illegally."""
    of, state, before, seen = None, NOTHING, None, False
    for rows in batches:
        found = []
        for conv, block, states, first, last in zip(*(rows.column(i).to_pylist() for i in range(5))):
            if not seen or conv != of:
                of, state, before, seen = conv, NOTHING, None, True
            found.append((block, state, int(before is not None and (before, first & 3) not in LEGAL)))
            state, before = states[state], last & 3
        if found:
            block, begin, joint = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int64()), pa.array(begin, pa.int32()), pa.array(joint, pa.int64())],
                names=["block", "state", "joint"],
            )


def _chained(pieces: DataFrame) -> DataFrame:
    """Blocks of conversations that are more than one, with their edits."""

    def costs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            made = [between(codes).tobytes() for codes in rows.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(made, pa.binary())], names=["conv", "block", "between"])

    conv = pieces.schema["conv"].dataType.simpleString()
    matrices = pieces.select("conv", "block", "codes").mapInArrow(costs, f"conv {conv}, block long, between binary")
    backward = matrices.repartition("conv").sortWithinPartitions("conv", F.desc("block"))
    ends = backward.mapInArrow(_ends, "block long, end array<long>, last boolean")
    walked = pieces.join(ends, "block").select("block", "codes", "end", "last")
    walked = written(
        walked.mapInArrow(_walks, "block long, audits array<string>, states array<int>, costs array<long>").join(
            pieces.select("conv", "block", "codes", "ids", "illegal"), "block"
        ),
        "walks",
    )
    edge = lambda at: F.conv(F.hex(F.substring("codes", at, 1)), 16, 10).cast("int")
    forward = walked.select("conv", "block", "states", edge(1).alias("first"), edge(-1).alias("last"))
    forward = forward.repartition("conv").sortWithinPartitions("conv", "block")
    begins = forward.mapInArrow(_begins, "block long, state int, joint long")
    return walked.join(begins, "block").select(
        "conv",
        "block",
        "codes",
        "ids",
        "state",
        F.col("audits")[F.col("state")].alias("audit"),
        F.col("costs")[F.col("state")].alias("cost"),
        (F.col("illegal") + F.col("joint")).alias("illegal"),
    )


def _edit_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, codes, ids, state, audit, conv) to one row an edit: what it does, to which row, and the role it gives."""
    roles = {USER: "user", ASSISTANT: "assistant"}
    for rows in batches:
        found = []
        for conv, block, codes, ids, state, audit in zip(*(rows.column(i).to_pylist() for i in range(6))):
            numbers, at = np.frombuffer(ids, np.int64).tolist(), 0
            for place, edit in enumerate(audit):
                if edit == "K" and state == NOTHING and (codes[at] & 3) + 1 == SYSTEM:
                    state = SYSTEM
                elif edit != "D":
                    state = NEXT[state]
                found.append((conv, block, place, edit, None if edit == "I" else numbers[at], roles[state] if edit in "IR" else None))
                at += edit != "I"
            if len(found) > 4096 or len(ids) > 1 << 18:
                yield _edits(found, rows.schema.field(0).type)
                found = []
        if found:
            yield _edits(found, rows.schema.field(0).type)


def _edits(found: list, kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*found), types)], names=["conv", "block", "place", "edit", "id", "new_role"]
    )


def _first_of(role: Column) -> Column:
    initial = F.substring(role, 1, 1)
    out = F.lit(OTHER)
    for letter, code in INITIALS.items():
        out = F.when(initial == letter, code).otherwise(out)
    return out


@dataclass(frozen=True)
class Repaired:
    """``edits``: conv, block, place (the order), edit (D, I, K or R), role and text (null for D);
    ``faults``: conv, gaps, blank, duplicate, truncated, illegal, cost. One row an edit, one a conversation."""

    edits: DataFrame
    faults: DataFrame


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block_rows: int = BLOCK_ROWS
) -> Repaired:
    """Edits and faults of each conversation, its rows by turn, null turns first; ties by role, then by a hash of the text.

    A row without a character but white space is blank (null and empty texts too), one whose
    role and text were there before is a duplicate, one whose last character is no full stop,
    question or exclamation mark is truncated; the first of these counts. Roles count by their first
    letter; a null role is like any other that is none of s, u, a. Rows without conversation are one
    conversation. Repeated rows are duplicates. Other columns are not read; an empty table gives empty ones.
    """
    body = column(text).cast("string")
    trimmed = F.btrim(F.coalesce(body, F.lit("")), F.lit(_SPACE))
    staged = written(
        rows.select(
            column(conv).alias("conv"),
            column(turn).alias("turn"),
            column(role).cast("string").alias("role"),
            body.alias("text"),
            F.xxhash64(body).alias("h1"),
            F.xxhash64(F.lit(1), body).alias("h2"),
            F.monotonically_increasing_id().alias("id"),
            (trimmed == "").alias("blank"),
            (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("open"),
        ),
        "turns",
    )
    # The first of equal rows is told by its number, so the join that marks the others has a key that never repeats.
    firsts = staged.groupBy("conv", "role", "h1", "h2").agg(F.min(F.struct("turn", "id"))["id"].alias("id"))
    marked = staged.drop("text").join(firsts.select("id", F.lit(True).alias("is_first")), "id", "left")
    again = ~F.col("blank") & F.col("is_first").isNull()
    marked = marked.select(
        "conv",
        "turn",
        "role",
        "h1",
        "h2",
        "id",
        "blank",
        again.alias("again"),
        (~F.col("blank") & ~again & F.col("open")).alias("truncated"),
    )
    fault = F.when(F.col("blank") | F.col("again"), UNFIT).when(F.col("truncated"), TRUNCATED).otherwise(SOUND)
    marked = written(marked.withColumn("code", _first_of(F.col("role")) + fault), "faults")

    order = ["conv", "turn", "role", "h1", "h2", "id"]
    dealt = marked.select(*order, "code").repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "code", "id")
    cut, schema = _blocks(marked.schema["conv"].dataType, block_rows)
    blocks = written(dealt.mapInArrow(cut, schema), "blocks")
    whole = blocks.where("whole").drop("whole")
    done = written(whole.unionByName(_chained(blocks.where("not whole"))), "audits")

    kind = marked.schema["conv"].dataType.simpleString()
    edits = done.select("conv", "block", "codes", "ids", "state", "audit").mapInArrow(
        _edit_rows, f"conv {kind}, block long, place long, edit string, id long, new_role string"
    )
    edits = written(edits, "edits")
    place = ["conv", "block", "place", "edit"]
    texts = staged.select("id", "role", "text")
    of_rows = edits.where("edit <> 'I'").join(texts, "id")
    there = F.col("edit") != "D"
    of_rows = of_rows.select(
        *place, F.when(there, F.coalesce("new_role", "role", F.lit(""))).alias("role"), F.when(there, F.coalesce("text", F.lit(""))).alias("text")
    )
    added = edits.where("edit = 'I'").select(*place, F.col("new_role").alias("role"), F.lit("").alias("text"))

    by_turn = marked.groupBy("conv", "turn").agg(*[F.count_if(c).alias(c) for c in ("blank", "again", "truncated")])
    found = by_turn.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum("blank").alias("blank"),
        F.sum("again").alias("duplicate"),
        F.sum("truncated").alias("truncated"),
    )
    costs = done.groupBy(F.col("conv").alias("__conv")).agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    faults = found.join(costs, F.col("conv").eqNullSafe(F.col("__conv"))).drop("__conv")
    return Repaired(of_rows.unionByName(added), faults)


def digests(edits: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256): each conversation's edits, and the hash of its repaired rows, read as a sorted stream."""
    kind = edits.schema["conv"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, audit, sha, empty, seen, type = None, [], hashlib.sha256(), True, False, None

        def row() -> pa.RecordBatch:
            values = [pa.array([of], type), pa.array(["".join(audit)]), pa.array([sha.hexdigest()])]
            return pa.RecordBatch.from_arrays(values, names=["conv", "audit", "repaired_sha256"])

        for rows in batches:
            type, made = rows.schema.field(0).type, []
            for conv, edit, role, text in zip(*(rows.column(i).to_pylist() for i in range(4))):
                if not seen or conv != of:
                    if seen:
                        made.append(row())
                    of, audit, sha, empty, seen = conv, [], hashlib.sha256(), True, True
                audit.append(edit)
                if edit != "D":
                    sha.update((("" if empty else "\n") + role + ":").encode())
                    sha.update(text.encode())
                    empty = False
            if made:
                yield pa.Table.from_batches(made).combine_chunks().to_batches()[0]
        if seen:
            yield row()

    ordered = edits.repartition("conv").sortWithinPartitions("conv", "block", "place").select("conv", "edit", "role", "text")
    return ordered.mapInArrow(run, f"conv {kind}, audit string, repaired_sha256 string")


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults planted by crc32 of ``conv_id:turn``; nulls count as one space.

    Of twenty remainders, 0 drops a row, 1 empties its text, 2 takes out its full stops, question and
    exclamation marks, 3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    which = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return rows.where(which != 0).select(
        "conv_id",
        "turn",
        F.when(which == 4, "user").otherwise(role).alias("role"),
        F.when(which == 1, "").when(which == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(which == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    repaired = repair(damage(rows))
    every = rows.groupBy("conv_id").agg(F.lit(1).alias("__one")).drop("__one")
    told = digests(repaired.edits).withColumnRenamed("conv", "__told")
    out = every.join(repaired.faults, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    out = out.join(told, F.col("conv_id").eqNullSafe(F.col("__told")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
