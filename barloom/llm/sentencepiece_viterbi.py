"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives Viterbi.

One pass over the text: at each place the automaton's output links give the pieces that end
there, longest first, and each relaxes the best score there. A character that is no
piece costs ten more than the least score and becomes byte pieces. Where two characters meet that stand
side by side in no piece, no piece crosses, so the stretches between such places are segmented for themselves
and each different short one once a worker, also in texts without spaces. Without byte pieces, where unknown
characters in a row are one id, the begins of words are such places if no piece has a space mark after
another character; otherwise a text is segmented as a whole.

The vocabulary (pieces and scores) is read on the driver from the given file and sent to the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.shared import append_columns, table

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Different words whose ids a worker keeps.
KNOWN_WORDS = 500_000
#: Bits of a hash of two neighbouring characters.
PAIR_BITS = 21


def _pairs(text: str) -> np.ndarray:
    """A hash of each two neighbouring characters."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return (code[:-1] * np.uint32(0x9E3779B1) + code[1:] * np.uint32(0x85EBCA77)) >> np.uint32(32 - PAIR_BITS)


def model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    """``pieces``: (piece, id, score) of ordinary pieces; ``byte``: ids of the 256 byte pieces, or none."""

    definition: bytes
    pieces: list[tuple[str, int, float]]
    byte: list[int]
    unknown: int
    surface: list[bytes] = field(default_factory=list)

    @property
    def by_word(self) -> bool:
        return not any(SPACE in piece.lstrip(SPACE) for piece, _, _ in self.pieces)


def load(path: str | None = None) -> Vocabulary:
    import sentencepiece

    with open(path or model_file(), "rb") as file:
        definition = file.read()
    model = sentencepiece.SentencePieceProcessor(model_proto=definition)
    pieces, byte, surface = [], [0] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte[int(piece[3:5], 16)] = i
            surface.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i):
            surface.append(b"")
        elif model.is_unknown(i):
            surface.append(" ⁇ ".encode())
        else:
            if not model.is_unused(i):
                pieces.append((piece, i, model.get_score(i)))
            surface.append(piece.replace(SPACE, " ").encode())
    return Vocabulary(definition, pieces, byte if any(byte) else [], model.unk_id(), surface)


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick
        import sentencepiece

        self.vocabulary = vocabulary
        self.normalize = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.definition).normalize
        self.automaton = ahocorasick.Automaton()
        for piece, i, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), i, score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _, _ in vocabulary.pieces if len(piece) == 1}
        self.penalty = min((s for _, _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.by_word = vocabulary.by_word
        #: Hashes of neighbours within a piece, and of few others, where a text is then not cut.
        self.inside = np.zeros(1 << PAIR_BITS, bool)
        for piece, _, _ in vocabulary.pieces:
            self.inside[_pairs(piece)] = True
        self.known: dict[str, tuple[int, ...]] = {}

    def segment(self, text: str) -> tuple[int, ...]:
        """Ids of the best segmentation; of equally good ones that with the longer last piece."""
        if self.single.issuperset(text):
            return self._segment_known(text)
        n = len(text)
        best = [0.0] + [float("-inf")] * n
        via: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        single, penalty, done = self.single, self.penalty, 0

        def unknown_until(end: int) -> None:
            nonlocal done
            while done < end:
                done += 1
                if text[done - 1] not in single and best[done - 1] + penalty > best[done]:
                    best[done], via[done] = best[done - 1] + penalty, (1, -1)

        for last, (length, i, score) in self.automaton.iter(text):
            end = last + 1
            if done < last:
                unknown_until(last)
            value = best[end - length] + score
            if value > best[end]:
                best[end], via[end] = value, (length, i)
        unknown_until(n)
        out: list[int] = []
        while n:
            length, i = via[n]
            if i >= 0:
                out.append(i)
            elif self.vocabulary.byte:
                out.extend(self.vocabulary.byte[b] for b in reversed(text[n - 1].encode()))
            elif not out or out[-1] != self.vocabulary.unknown:
                out.append(self.vocabulary.unknown)
            n -= length
        return tuple(reversed(out))

    def _segment_known(self, text: str) -> tuple[int, ...]:
        """``segment`` of a text whose characters all are pieces."""
        n = len(text)
        best = [0.0] + [float("-inf")] * n
        via: list = [None] * (n + 1)
        for last, piece in self.automaton.iter(text):
            end = last + 1
            value = best[end - piece[0]] + piece[2]
            if value > best[end]:
                best[end], via[end] = value, piece
        out: list[int] = []
        while n:
            piece = via[n]
            out.append(piece[1])
            n -= piece[0]
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        text = self.normalize(text)
        out: list[int] = []
        known = self.known
        for stretch in self.stretches(text):
            ids = known.get(stretch)
            if ids is None:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                ids = self.segment(stretch)
                if len(stretch) < 64:
                    known[stretch] = ids
            out += ids
        return out

    def stretches(self, text: str) -> list[str]:
        """A normalized text cut where no piece crosses."""
        if self.vocabulary.byte:
            cuts = (np.flatnonzero(~self.inside[_pairs(text)]) + 1).tolist()
            return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        # A word begins at a run of space marks; the part before the first run is one too.
        return _WORDS.findall(text) if self.by_word else [text]


_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


#: The encoder of a worker's last vocabulary, with the words it knows; later tasks go on with it.
_encoders: dict[bytes, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    if vocabulary.definition not in _encoders:
        _encoders.clear()
        _encoders[vocabulary.definition] = Encoder(vocabulary)
    return _encoders[vocabulary.definition]


def decode_ids(ids: Iterable[int], surface: list[bytes]) -> str:
    """The text of ids: pieces joined, byte pieces as bytes, without the space that encoding puts first."""
    text = b"".join([surface[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, text: str = "text", model: str | None = None, out: str = "ids") -> DataFrame:
    """``docs`` with an array of ids. Null texts have null ids, empty ones an empty array; repeated rows repeat.

    All columns pass through; one named ``out`` is replaced; an empty table gives an empty one.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(load(model))

    def make(texts: pa.Array) -> list[pa.Array]:
        encoder = _encoder(vocabulary.value)
        values = [None if t is None else encoder.encode(t) for t in texts.to_pylist()]
        return [pa.array(values, pa.list_(pa.int32()))]

    return append_columns(docs, text, f"`{out}` array<int>", make)


def decode(docs: DataFrame, ids: str = "ids", model: str | None = None, out: str = "decoded") -> DataFrame:
    """``docs`` with the text of an array of ids; null ids give a null text, ids outside the vocabulary raise."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(load(model).surface)
    names = [c for c in docs.columns if c != out]
    schema = docs.select(*[f"`{c}`" for c in names]).schema.add(out, "string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surface = vocabulary.value
        for batch in batches:
            values = batch.column(names.index(ids))
            texts = [
                decode_ids(v.values.to_numpy().tolist(), surface) if v.is_valid else None for v in values
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, out])

    return docs.select(*[f"`{c}`" for c in names]).mapInArrow(run, schema)


def op7_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each whole text encoded and decoded: how many ids, their hash, and whether the text comes back."""
    back = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"),
    )
