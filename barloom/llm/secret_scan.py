"""Secret scans: fixed patterns, and a linear-chain conditional random field for what they miss.

The field tags the words of a text as beginning a secret, inside one, or outside, from each
word's shape, its neighbours and the file, and is decoded by Viterbi. It is fitted, on the
driver, to stretches of a bounded sample of the texts themselves, with the patterns' finds as
labels. Decoding is exact: a word whose score for "outside" leads by more than any change
of tags around it can gain is outside on the best path, so only the stretches between
such words are decoded, each for itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import words as W
from barloom.llm.shared import append_columns, column, table

KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key", b"credential", b"bearer", b"private", b"auth")

#: Texts drawn by their hash to fit the field, about; stretches with finds, and without, that are used at most.
FIT_TEXTS = 30_000
FIT_WITH, FIT_WITHOUT = 1000, 1000
#: Words of a stretch around a find, on either side.
AROUND = 8
OUT, BEGIN, INSIDE = range(3)
_TRIM = "\"'`,;:()[]{}<>="
_SPACE = " \t\n\x0b\x0c\r"


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns' finds, in order."""
    low = text.encode("utf-8", "replace").lower()
    found = []
    if any(x in low for x in (b"passw", b"secret", b"token", b"api")):
        found += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"akia" in low:
        found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


# Byte classes that make up a word's shape.
_CLASS = np.zeros((6, 256), bool)
_CLASS[0, ord("0") : ord("9") + 1] = True
_CLASS[1, ord("A") : ord("Z") + 1] = True
_CLASS[2, ord("a") : ord("z") + 1] = True
_CLASS[3, [ord(c) for c in "+/_.=-"]] = True
_CLASS[4, 128:] = True
_CLASS[5] = _CLASS[0]
_CLASS[5, ord("a") : ord("f") + 1] = True

FEATURES = (
    "any length<6 length<12 length<20 length<32 long digits few_digits many_digits mixed_case upper_inside symbols "
    "punctuation non_ascii hex quoted assigns keyword after_keyword after_assign two_after_keyword before_plain "
    "after_secretive file_keyword file_symbols file_digits letters_digits"
).split()


def features(block: W.Block) -> np.ndarray:
    """One row of 0 and 1 for each word of a block: shape, neighbours and file."""
    n = len(block.start)
    out = np.zeros((n, len(FEATURES)), np.float32)
    if not n:
        return out
    length = block.end - block.start
    # Punctuation around a word is no part of its shape.
    data, start, end = block.data, block.start, block.end
    counts = []
    for member in _CLASS:
        sums = np.concatenate(([0], np.cumsum(member[data], dtype=np.int32)))
        counts.append(sums[end] - sums[start])
    digits, upper, lower, symbols, high, hexes = counts
    punctuation = length - digits - upper - lower - symbols - high
    f = {name: out[:, i] for i, name in enumerate(FEATURES)}
    f["any"][:] = 1
    core = length - punctuation
    for name, low, up in (("length<6", 0, 6), ("length<12", 6, 12), ("length<20", 12, 20), ("length<32", 20, 32), ("long", 32, 1 << 60)):
        f[name][:] = (core >= low) & (core < up)
    f["digits"][:] = (digits == core) & (core > 0)
    f["few_digits"][:] = (digits > 0) & (5 * digits <= core)
    f["many_digits"][:] = (5 * digits > core) & (digits < core)
    f["mixed_case"][:] = (upper > 1) & (lower > 0)
    first_upper = _CLASS[1][data[start]]
    f["upper_inside"][:] = (upper - first_upper > 0) & (lower > 0)
    f["symbols"][:] = symbols - (data[end - 1] == ord(".")) > 0
    f["punctuation"][:] = punctuation > 0
    f["non_ascii"][:] = high > 0
    f["hex"][:] = (hexes == core) & (core >= 12) & (digits > 0)
    f["quoted"][:] = np.isin(data[start], [34, 39, 96])
    f["assigns"][:] = np.isin(data[end - 1], [ord("="), ord(":")])
    f["letters_digits"][:] = (digits > 0) & (upper + lower > 0) & (core >= 12) & (high == 0)
    text = block.text_of_word()
    low = data.tobytes().lower()
    keyword = np.zeros(n, bool)
    for literal in _KEYWORDS:
        at = low.find(literal)
        while at >= 0:
            keyword[max(0, int(np.searchsorted(start, at, "right")) - 1)] = True
            at = low.find(literal, at + 1)
    f["keyword"][:] = keyword

    def shifted(values: np.ndarray, by: int) -> np.ndarray:
        moved = np.zeros(n, np.float32)
        if by > 0:
            moved[by:] = values[:-by] * (text[by:] == text[:-by])
        else:
            moved[:by] = values[-by:] * (text[:by] == text[-by:])
        return moved

    plain = (digits == 0) & (symbols == 0) & (f["upper_inside"] == 0)
    f["after_keyword"][:] = shifted(f["keyword"], 1)
    f["two_after_keyword"][:] = shifted(f["keyword"], 2)
    f["after_assign"][:] = shifted(f["assigns"], 1)
    f["before_plain"][:] = shifted(plain.astype(np.float32), -1)
    f["after_secretive"][:] = shifted(f["letters_digits"], 1)
    texts = len(block.first) - 1
    per = lambda values: np.bincount(text, weights=values, minlength=texts)
    size = np.maximum(1, per(length))
    f["file_keyword"][:] = (per(keyword) > 0)[text]
    f["file_symbols"][:] = (per(symbols + punctuation) * 20 > size)[text]
    f["file_digits"][:] = (per(digits) * 20 > size)[text]
    return out


class Field:
    """Weights: (features, 3) for words; start (3,) and step (3, 3) for tags."""

    def __init__(self, word: np.ndarray, start: np.ndarray, step: np.ndarray):
        self.word, self.start, self.step = word, start, step
        # The most a path can gain at the steps around a word by another tag than "outside".
        gains = [
            step[a, t] + step[t, b] - step[a, OUT] - step[OUT, b] for a in range(3) for b in range(3) for t in (BEGIN, INSIDE)
        ]
        ends = [step[a, t] - step[a, OUT] for a in range(3) for t in (BEGIN, INSIDE)]
        starts = [start[t] - start[OUT] + step[t, b] - step[OUT, b] for b in range(3) for t in (BEGIN, INSIDE)]
        alone = [start[t] - start[OUT] for t in (BEGIN, INSIDE)]
        self.lead = float(max(gains + ends + starts + alone)) + 1e-6

    def viterbi(self, scores: np.ndarray, before: bool, after: bool) -> list[int]:
        """Best tags of a stretch; ``before`` and ``after``: whether words that are outside stand there."""
        rows = scores.tolist()
        step, best = self.step.tolist(), []
        now = [rows[0][t] + (step[OUT][t] if before else float(self.start[t])) for t in range(3)]
        for row in rows[1:]:
            back, new = [], []
            for t in range(3):
                a = max(range(3), key=lambda s: now[s] + step[s][t])
                back.append(a)
                new.append(now[a] + step[a][t] + row[t])
            best.append(back)
            now = new
        if after:
            now = [now[t] + step[t][OUT] for t in range(3)]
        tags = [max(range(3), key=lambda t: now[t])]
        for back in reversed(best):
            tags.append(back[tags[-1]])
        return tags[::-1]

    def runs(self, block: W.Block) -> list[tuple[int, int]]:
        """(first word, end word) of each secret on the best paths of a block's texts."""
        scores = features(block) @ self.word
        lead = scores[:, OUT] - np.maximum(scores[:, BEGIN], scores[:, INSIDE])
        unsure = np.flatnonzero(lead <= self.lead)
        if not len(unsure):
            return []
        text = block.text_of_word()
        cut = np.flatnonzero((np.diff(unsure) != 1) | (np.diff(text[unsure]) != 0)) + 1
        found = []
        for stretch in np.split(unsure, cut):
            a, b = int(stretch[0]), int(stretch[-1]) + 1
            first, end = block.first[text[a]], block.first[text[a] + 1]
            tags = self.viterbi(scores[a:b], a > first, b < end)
            i = 0
            while i < len(tags):
                if tags[i] == OUT:
                    i += 1
                    continue
                j = i + 1
                while j < len(tags) and tags[j] == INSIDE:
                    j += 1
                found.append((a + i, a + j))
                i = j
        return found


def fit_field(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 80) -> Field:
    """Maximum likelihood with a small penalty, all sequences at once, by Adam.

    Each sequence is also there with a third of its features hidden, so that no one shape of the finds is all that counts.
    """
    width = len(FEATURES)
    if not sequences:
        sequences = [(np.eye(1, width, dtype=np.float32), np.zeros(1, np.int64))]
    rng = np.random.default_rng(9)
    hidden = [(rows * (rng.random(rows.shape) > 0.33), tags) for rows, tags in sequences]
    for rows, _ in hidden:
        rows[:, 0] = 1
    sequences = sequences + hidden
    longest = max(len(y) for _, y in sequences)
    count = len(sequences)
    x = np.zeros((count, longest, width), np.float32)
    y = np.zeros((count, longest), np.int64)
    mask = np.zeros((count, longest), bool)
    for i, (rows, tags) in enumerate(sequences):
        x[i, : len(tags)], y[i, : len(tags)], mask[i, : len(tags)] = rows, tags, True
    words = mask.sum()
    gold = np.eye(3)[y] * mask[..., None]
    gold_step = np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:])
    theta = [np.zeros((width, 3)), np.zeros(3), np.zeros((3, 3))]
    moment, square = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for turn in range(1, rounds + 1):
        word, start, step = theta
        scores = x @ word
        alpha = np.zeros((count, longest, 3))
        alpha[:, 0] = scores[:, 0] + start
        for t in range(1, longest):
            new = _log_sum(alpha[:, t - 1, :, None] + step, 1) + scores[:, t]
            alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
        total = _log_sum(alpha[:, -1], 1)
        beta = np.zeros((count, longest, 3))
        pair = np.zeros((3, 3))
        for t in range(longest - 2, -1, -1):
            inner = step + (scores[:, t + 1] + beta[:, t + 1])[:, None, :]
            on = mask[:, t + 1, None]
            beta[:, t] = np.where(on, _log_sum(inner, 2), beta[:, t + 1])
            pair += (np.exp(alpha[:, t, :, None] + inner - total[:, None, None]) * on[..., None]).sum(0)
        marginal = np.exp(alpha + beta - total[:, None, None]) * mask[..., None]
        gradient = [
            np.einsum("ntf,nta->fa", x, gold - marginal) / words - 1e-6 * word,
            (gold[:, 0] - marginal[:, 0]).sum(0) / count - 1e-6 * start,
            (gold_step - pair) / words - 1e-6 * step,
        ]
        for k, g in enumerate(gradient):
            moment[k] = 0.9 * moment[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            theta[k] = theta[k] + 0.3 * (moment[k] / (1 - 0.9**turn)) / (np.sqrt(square[k] / (1 - 0.99**turn)) + 1e-8)
    return Field(theta[0].astype(np.float32), theta[1], theta[2])


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis, keepdims=True))).squeeze(axis)


def stretches(text: str, spans: list[tuple[int, str, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training sequences of one text: around its finds, or around its least plain word."""
    data = text.encode("utf-8", "replace")
    block = W.block(np.frombuffer(data, np.uint8), np.array([0, len(data)]), slice(0, 1))
    n = len(block.start)
    if not n:
        return []
    rows, tags = features(block), np.zeros(n, np.int64)
    if not spans:
        middle = int(rows[:, 1:].sum(1).argmax())
        at = slice(max(0, middle - AROUND), middle + AROUND + 1)
        return [(rows[at], tags[at])]
    centres = []
    for start, kind, end in spans:
        if kind == "assign":
            value = _ASSIGN.match(text, start)
            start = value.start(2) if value else start
        a, b = len(text[:start].encode("utf-8", "replace")), len(text[:end].encode("utf-8", "replace"))
        first = int(np.searchsorted(block.end, a, "right"))
        last = max(first + 1, int(np.searchsorted(block.start, b, "left")))
        tags[first] = BEGIN
        tags[first + 1 : last] = np.where(tags[first + 1 : last] == BEGIN, BEGIN, INSIDE)
        centres.append((first, last))
    out, upto = [], 0
    for first, last in sorted(centres):
        if last > upto:
            at = slice(max(upto, first - AROUND), last + AROUND)
            out.append((rows[at], tags[at]))
            upto = min(n, last + AROUND)
    return out


def fit(docs: DataFrame, text: str = "text") -> Field:
    """Fit a field to about ``FIT_TEXTS`` different texts, drawn by their hash.

    Of their stretches with and without finds, those that come first by a hash are used, at
    most ``FIT_WITH`` and ``FIT_WITHOUT``.
    """
    every = 1 + docs.count() // FIT_TEXTS
    body = column(text).cast("string").alias("text")
    drawn = docs.select(body, F.xxhash64(body).alias("h")).where(F.pmod("h", F.lit(every)) == 0).dropDuplicates(["h"])
    found = drawn.select("text").where("text is not null").mapInArrow(_training_stretches, "found boolean, stretch binary")
    h = F.xxhash64("stretch")
    parts = [found.where(F.col("found") == which).orderBy(h, "stretch").limit(n) for which, n in ((True, FIT_WITH), (False, FIT_WITHOUT))]
    width = len(FEATURES) + 1
    sequences = []
    for row in parts[0].union(parts[1]).collect():
        rows = np.frombuffer(row["stretch"], np.uint8).reshape(-1, width)
        sequences.append((rows[:, :-1].astype(np.float32), rows[:, -1].astype(np.int64)))
    return fit_field(sequences)


def _training_stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, packed = [], []
        for text in batch.column(0).to_pylist():
            spans = base_spans(text)
            for rows, tags in stretches(text, spans):
                found.append(bool(spans))
                packed.append(np.concatenate((rows.astype(np.uint8), tags[:, None].astype(np.uint8)), axis=1).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.bool_()), pa.array(packed, pa.binary())], names=["found", "stretch"])


def field_spans(text: str, data: bytes, runs: list[tuple[int, int]], base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """The field's finds (byte bounds) as spans: of each run the parts that the patterns' spans do not cover.

    No part are white space and punctuation at the ends, and a name before a value: what goes
    before an "assign" span in its word, or ends with = or : where a span begins.
    """
    out = []
    for a, b in runs:
        start = len(data[:a].decode("utf-8", "replace"))
        piece = data[a:b].decode("utf-8", "replace")
        trimmed = piece.strip(_TRIM)
        if not trimmed:
            continue
        start += piece.index(trimmed)
        end, at = start + len(trimmed), start
        for s, kind, e in sorted(x for x in base if x[0] < end and x[2] > start):
            if s > at:
                head = text[at:s]
                if kind == "assign" or head[-1] in "=:":
                    head = head[: len(head) - len(head.split()[-1])] if not head[-1].isspace() else head
                _add_part(out, head, at, at > start)
            at = max(at, e)
            value = _ASSIGN.match(text, s).start(2) if kind == "assign" else s
            if text[e : e + 1] in ('"', "'", "`") and value and text[value - 1] == text[e]:
                # A closed quotation is the whole secret; what hangs on it in its word is none.
                while at < end and not text[at].isspace():
                    at += 1
        if at < end:
            _add_part(out, text[at:end], at, at > start)
    return out


def _add_part(out: list[tuple[int, str, int]], part: str, at: int, after: bool) -> None:
    """Add a part of a run as a span; ``after``: it follows a pattern's span, whose text may end a sentence."""
    left = part.lstrip(_TRIM + _SPACE)
    kept = left.rstrip(_TRIM + _SPACE)
    if kept and not (after and not kept.strip(".!?")):
        start = at + len(part) - len(left)
        out.append((start, "crf", start + len(kept)))


def _spans(texts: pa.Array, field: Field) -> Iterator[tuple[str, list, list]]:
    """(text, the patterns' spans, all spans) of each row."""
    for block in W.blocks(texts):
        runs: dict[int, list[tuple[int, int]]] = {}
        for a, b in field.runs(block):
            row = int(np.searchsorted(block.first, a, "right")) - 1
            at = int(block.offsets[row])
            runs.setdefault(row, []).append((int(block.start[a]) - at, int(block.end[b - 1]) - at))
        for row in range(len(block.first) - 1):
            text = texts[block.rows.start + row].as_py() or ""
            base = base_spans(text)
            spans = base
            if row in runs:
                spans = base + field_spans(text, text.encode(), runs[row], base)
                spans.sort(key=lambda s: (s[0], KINDS.index(s[1])))
            yield text, base, spans


def scan(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """All columns of ``docs`` and n_assign, n_access, n_hex, base_sha256, spans, secrets.

    Spans are kind:start:end in code points, by start and then kind, joined by commas;
    ``secrets`` has them as an array of (kind, start, end). Null and empty texts have none;
    repeated rows repeat their spans; an empty table gives an empty one. Columns with the
    name of an added one are replaced. ``field``: a fitted field; fitted to ``docs`` if not given.
    """
    model = docs.sparkSession.sparkContext.broadcast(field if field is not None else fit(docs, text))
    added = (
        "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
        "secrets array<struct<kind: string, start: int, end: int>>"
    )
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def make(texts: pa.Array) -> list[pa.Array]:
        counts, digests, joined, listed = [[], [], []], [], [], []
        for _, base, spans in _spans(texts, model.value):
            for c, k in zip(counts, KINDS):
                c.append(sum(found == k for _, found, _ in base))
            digests.append(hashlib.sha256(_join(base).encode()).hexdigest())
            joined.append(_join(spans))
            listed.append([{"kind": k, "start": s, "end": e} for s, k, e in spans])
        return [*(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(joined, pa.string()), pa.array(listed, kind)]

    return append_columns(docs, text, added, make)


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", field: Field | None = None) -> DataFrame:
    """All columns of ``docs``, redacted and n_secrets: the text with each secret replaced by ``mark``.

    Secrets that overlap or touch give one mark. Texts without secrets, null ones too, stay as they are. Otherwise as ``scan``.
    """
    model = docs.sparkSession.sparkContext.broadcast(field if field is not None else fit(docs, text))

    def make(texts: pa.Array) -> list[pa.Array]:
        out, counts = [], []
        for row, (body, _, spans) in enumerate(_spans(texts, model.value)):
            upto, parts = 0, []
            for start, _, end in spans:
                if start > upto or not parts:
                    parts += [body[upto:start], mark]
                upto = max(upto, end)
            out.append("".join([*parts, body[upto:]]) if texts[row].is_valid else None)
            counts.append(len(spans))
        return [pa.array(out, pa.string()), pa.array(counts, pa.int64())]

    return append_columns(docs, text, "redacted string, n_secrets long", make)


def _join(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
