"""SentencePiece encoding and decoding.

The pieces of a model file form an Aho-Corasick automaton. One pass over a text visits, at each
position, the pieces that end there (the output links of the automaton), and each relaxes the best
score of the position: a Viterbi search without a second look at any character. Characters that no
piece covers become byte pieces. Where no piece can cross (before a word mark that follows another
character) the search is cut, and the segments between cuts are remembered in a bounded table.

The model's file is small and read by the driver; its path is a parameter.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.common import packed

MARK = "▁"
# Segments remembered per Python worker, and rows turned into one batch of output.
CACHE_SEGMENTS = 400_000
CACHE_CHARS = 32
ROWS_OUT = 256
NOWHERE = -math.inf
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass(frozen=True)
class PieceModel:
    """Pieces with scores by id; ``bytes_at`` is the id of byte piece 0, those of the others follow."""

    pieces: list[str]
    scores: list[float]
    usable: list[bool]
    bytes_at: int
    byte_score: float

    @classmethod
    def from_file(cls, path: str) -> PieceModel:
        """Read a model with byte pieces.

        A unigram model has log probabilities as scores. A BPE model has merge ranks; its pieces get
        the log probabilities that Zipf's law gives to those ranks.
        """
        import sentencepiece

        file = sentencepiece.SentencePieceProcessor(model_file=path)
        size = file.get_piece_size()
        own = [file.get_score(k) for k in range(size)]
        special = [file.is_control(k) or file.is_unknown(k) or file.is_unused(k) or file.is_byte(k) for k in range(size)]
        pieces = [file.id_to_piece(k) for k in range(size)]
        ranked = all(score == int(score) for score, skip in zip(own, special, strict=True) if not skip)
        scores = [-math.log(10.0 - score) for score in own] if ranked else own
        usable = [not skip for skip in special]
        lowest = min((score for score, good in zip(scores, usable, strict=True) if good), default=0.0)
        return cls(pieces, scores, usable, pieces.index("<0x00>"), lowest - 10.0)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for k, piece in enumerate(self.pieces):
            if self.usable[k]:
                found.add_word(piece, (len(piece), self.scores[k], k))
        found.make_automaton()
        return found

    @cached_property
    def has_pieces(self) -> bool:
        return any(self.usable)

    @cached_property
    def known(self) -> dict[str, array]:
        """Ids of segments met before."""
        return {}

    @cached_property
    def cut(self) -> re.Pattern | None:
        """Splits a text where no piece can cross; None if some piece has a mark behind another character."""
        crossing = any(self.usable[k] and MARK in piece.lstrip(MARK) for k, piece in enumerate(self.pieces))
        return None if crossing else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    @cached_property
    def spelled(self) -> list[bytes]:
        """What each id stands for in a decoded text."""
        spelled = [piece.replace(MARK, " ").encode() if self.usable[k] else b"" for k, piece in enumerate(self.pieces)]
        for value in range(256):
            spelled[self.bytes_at + value] = bytes([value])
        return spelled


def segment(text: str, model: PieceModel) -> array:
    """Best ids of a text whose spaces are marks, by one pass of the automaton.

    Of equal scores the one with the longer last piece wins. A position that no piece reaches is
    reached by the bytes of its last character.
    """
    size = len(text)
    best, start_of, id_of = [0.0] + [NOWHERE] * size, [0] * (size + 1), [-1] * (size + 1)
    done = 0  # up to here every position has its best score
    for last, (length, score, k) in model.automaton.iter(text) if model.has_pieces else ():
        while done < last:
            done += 1
            if best[done] == NOWHERE:
                best[done] = best[done - 1] + model.byte_score * len(text[done - 1].encode("utf-8", "surrogatepass"))
                start_of[done] = done - 1
        end = last + 1
        start = end - length
        total = best[start] + score
        if total > best[end]:
            best[end], start_of[end], id_of[end] = total, start, k
    ids = []
    end = size
    while end:
        k = id_of[end]
        # Only a reached position has a start; past the last match positions follow each other.
        start = start_of[end] if best[end] != NOWHERE else end - 1
        if k >= 0:
            ids.append(k)
        else:
            ids.extend(model.bytes_at + b for b in reversed(text[start:end].encode("utf-8", "surrogatepass")))
        end = start
    ids.reverse()
    return array("i", ids)


def encode_text(text: str, model: PieceModel) -> array:
    """Ids of a whole text; a word mark of its own in the text is spelled in bytes, so it survives."""
    known = model.known
    ids = array("i")
    if not text:
        return ids
    literal = array("i", [model.bytes_at + b for b in MARK.encode()])
    for number, part in enumerate(text.split(MARK)):
        if number:
            ids.extend(literal)
        # Only the text as a whole begins with a mark that is not there.
        marked = (MARK if number == 0 else "") + part.replace(" ", MARK)
        if not marked:
            continue
        for piece in (marked,) if model.cut is None else model.cut.findall(marked):
            found = known.get(piece)
            if found is None:
                found = segment(piece, model)
                if len(piece) <= CACHE_CHARS:
                    if len(known) >= CACHE_SEGMENTS:
                        known.clear()
                    known[piece] = found
            ids.extend(found)
    return ids


def decode_ids(ids: array, model: PieceModel) -> str:
    """The text of the ids; exact for what ``encode_text`` gave."""
    spelled = b"".join(map(model.spelled.__getitem__, ids)).decode("utf-8", "surrogatepass")
    return spelled[1:] if spelled.startswith(" ") else spelled


def encode(docs: DataFrame, model: PieceModel, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int), ``n_tokens`` and ``round_trip``.

    ``round_trip`` says that the ids decode to the very text. NULL text has NULL in all three, an
    empty text no ids. Columns of ``docs`` with these names are replaced. No row moves.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<ids array<int>, n_tokens int, round_trip boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = held.value
        for batch in batches:
            parts = []
            for at in range(0, len(batch), ROWS_OUT):
                parts.append(_encode_rows(batch.slice(at, ROWS_OUT).to_pylist(), model))
            yield pa.concat_arrays(parts) if parts else _encode_rows([], model)

    row = packed(docs, but=("ids", "n_tokens", "round_trip"))
    return docs.select(row, run(F.col(f"`{text}`")).alias("coded")).select("row.*", "coded.*")


def _encode_rows(texts: list[str | None], model: PieceModel) -> pa.StructArray:
    flat, ends, same = array("i"), [0], []
    for text in texts:
        if text is None:
            same.append(None)
        else:
            ids = encode_text(text, model)
            same.append(decode_ids(ids, model) == text)
            flat.extend(ids)
        ends.append(len(flat))
    missing = np.array([flag is None for flag in same], dtype=bool)
    lengths = np.diff(np.array(ends, dtype=np.int64)).astype(np.int32)
    offsets = pa.array(np.array(ends, dtype=np.int32), mask=np.append(missing, False))
    ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(flat, dtype=np.int32) if flat else [], pa.int32()))
    return pa.StructArray.from_arrays([ids, pa.array(lengths, mask=missing), pa.array(same, pa.bool_())],
                                      ["ids", "n_tokens", "round_trip"])


def decode(coded: DataFrame, model: PieceModel, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with the text of its ids; NULL ids have no text, ids outside the model are an error."""
    held = coded.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if row is None else decode_ids(array("i", row), held.value)
                            for row in batch.to_pylist()], pa.string())

    return coded.withColumn(out, run(F.col(f"`{ids}`")))
