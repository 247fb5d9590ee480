"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a Viterbi or merges.

The automaton reads a text once. In a unigram model its output links list the pieces that end at each
position, and each of them relaxes the best score of the position from the best score where the piece
starts. In a BPE model the scores are merge ranks and can't be added: there the automaton finds the
pieces that a text holds, and neighbours that make one of them are merged by rank.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map

SPACE = "▁"
_MARKS, _LETTERS = ",.;:!?", "A-Za-z\u00c0-\u024f"
#: Chunks between cuts: before a space run, around a line break, and between a letter and a mark.
_CHUNK = re.compile(rf"{SPACE}*[{_LETTERS}]+(?=[{_MARKS}])|{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
#: A piece that lies across such a cut; a vocabulary that has one is not cut.
_ACROSS = re.compile(rf"[^{SPACE}]{SPACE}|\n.|.\n|[{_LETTERS}][{_MARKS}]", re.DOTALL)


class Pieces:
    """A model file's pieces with their automaton. model: the bytes of the file."""

    #: What an unknown character costs beside the least score of a piece.
    UNKNOWN_PENALTY = 10.0

    def __init__(self, model: bytes, cache_size: int = 200_000):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(sp.vocab_size())
        names = [sp.id_to_piece(i) for i in ids]
        self.unk = sp.unk_id()
        self.bytes = {int(names[i][3:5], 16): i for i in ids if sp.is_byte(i)}
        plain = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and names[i]]
        score = {i: sp.get_score(i) for i in plain}
        self.unknown_score = min(score.values(), default=0.0) - self.UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            self.automaton.add_word(names[i], (len(names[i]), score[i], i))
        self.automaton.make_automaton()
        self.names = names
        self.single = {names[i] for i in plain if len(names[i]) == 1}
        self.cuttable = not any(_ACROSS.search(names[i]) for i in plain)
        self.surface = [b""] * len(names)
        for i in plain:
            self.surface[i] = names[i].replace(SPACE, " ").encode()
        for b, i in self.bytes.items():
            self.surface[i] = bytes([b])
        self.surface[self.unk] = " ⁇ ".encode()
        self.cache: dict[str, tuple[int, ...]] = {}
        self.cache_size = cache_size

    def viterbi(self, text: str) -> tuple[int, ...]:
        """Ids of the best segmentation of an escaped text; of equal scores the longest last piece wins."""
        n = len(text)
        best = [0.0] + [float("-inf")] * n
        back = [None] * (n + 1)
        if self.single.issuperset(text):
            for last, value in self.automaton.iter(text):
                end = last + 1
                s = best[end - value[0]] + value[1]
                if s > best[end]:
                    best[end], back[end] = s, value
        else:
            self._with_unknown(text, best, back)
        out: list[int] = []
        at = n
        while at:
            length, _, piece = back[at]
            if piece >= 0:
                out.append(piece)
            elif self.bytes:
                out += [self.bytes[b] for b in reversed(text[at - 1].encode())]
            elif not out or out[-1] != self.unk:
                out.append(self.unk)
            at -= length
        out.reverse()
        return tuple(out)

    def _with_unknown(self, text: str, best: list[float], back: list) -> None:
        """The same pass where some characters are no pieces: those get an edge of their own."""
        unknown, done = (1, self.unknown_score, -1), 0
        for last, value in chain(self.automaton.iter(text), ((len(text), None),)):
            for at in range(done, last):
                if text[at] not in self.single and best[at] + unknown[1] > best[at + 1]:
                    best[at + 1], back[at + 1] = best[at] + unknown[1], unknown
            done = max(done, last)
            if value and best[last + 1 - value[0]] + value[1] > best[last + 1]:
                best[last + 1], back[last + 1] = best[last + 1 - value[0]] + value[1], value

    def segment(self, text: str) -> tuple[int, ...]:
        """Ids of an escaped text by the model's own rule."""
        return self.viterbi(text)

    def chunk(self, text: str) -> tuple[int, ...]:
        got = self.cache.get(text)
        if got is None:
            got = self.segment(text)
            if len(text) <= 48:
                if len(self.cache) >= self.cache_size:
                    self.cache.clear()
                self.cache[text] = got
        return got

    def encode(self, text: str) -> list[int]:
        """Ids of a text. A space is put before it; a literal U+2581 goes by its bytes, so that decode() is exact."""
        if not text:
            return []
        if SPACE in text and self.bytes:
            parts = (" " + text).split(SPACE)
            mark = [self.bytes[b] for b in SPACE.encode()]
            out = self._encode(parts[0])
            for p in parts[1:]:
                out += mark
                out += self._encode(p)
            return out
        return self._encode(" " + text)

    def _encode(self, text: str) -> list[int]:
        if not text:
            return []
        if not self.cuttable:
            return list(self.segment(text.replace(" ", SPACE)))
        out: list[int] = []
        get, more, make = self.cache.get, out.extend, self.chunk
        for c in _CHUNK.findall(text.replace(" ", SPACE)):
            more(get(c) or make(c))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids; exact for what encode() gave if the model has byte pieces."""
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


class MergedPieces(Pieces):
    """The pieces of a BPE model: ids are those of the library, except that a literal U+2581 goes by its bytes."""

    def __init__(self, model: bytes, cache_size: int = 200_000):
        super().__init__(model, cache_size)
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        if any(sp.is_unused(i) for i in range(sp.vocab_size())) or 4 in piece_types(model):
            raise ValueError("BPE models with unused or user-defined pieces are not supported")
        #: Whether a piece (first key -1) stays as it is by itself, and whether two pieces stay apart side by side.
        self.fits: dict[int, bool] = {}

    def segment(self, text: str) -> tuple[int, ...]:
        """Ids by one pass of the automaton.

        Merging leaves a row of pieces as it is exactly if it leaves each two neighbours so. Hence one of the
        pieces that end at a position, which the output links list, is the last of its prefix: the one that
        stays apart from the last piece of the prefix before it. Which pieces do is kept in a table.
        """
        if not self.single.issuperset(text):
            return self.merged(text)
        n = len(text)
        ids, starts = [-1] * (n + 1), [0] * (n + 1)
        known = self.fits.get
        for last, (size, _, piece) in self.automaton.iter(text):
            end = last + 1
            if ids[end] >= 0:
                continue
            start = end - size
            before = ids[start]  # -1 at the start of the text
            if before < 0 and start:
                continue
            fits = known(before << 24 | piece)
            if fits is None:
                fits = self._fit(before, piece)
            if fits:
                ids[end], starts[end] = piece, start
        out = []
        at = n
        while at:
            out.append(ids[at])
            at = starts[at]
        out.reverse()
        return tuple(out)

    def _fit(self, before: int, piece: int) -> bool:
        both = (before, piece) if before >= 0 else (piece,)
        if len(self.fits) >= 2 * self.cache_size:
            self.fits.clear()
        fits = self.fits[before << 24 | piece] = self.merged("".join(self.names[i] for i in both)) == both
        return fits

    def merged(self, text: str) -> tuple[int, ...]:
        """Ids after merging, again and again, the neighbours whose piece has the best score; of equal ones the leftmost."""
        n = len(text)
        # at[start, end]: score and id of the pieces that the text holds; only these can come of a merge.
        at: dict[tuple[int, int], tuple[float, int]] = {
            (last + 1 - size, last + 1): (score, piece) for last, (size, score, piece) in self.automaton.iter(text)
        }
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(-at[i, i + 2][0], i, i + 1, i + 2) for i in range(n - 1) if (i, i + 2) in at]
        heapify(heap)
        while heap:
            _, left, mid, right = heappop(heap)
            if end[left] != mid or end[mid] != right:
                continue
            end[left], end[mid] = right, 0  # 0: merged away
            if right < n:
                before[right] = left
                if new := at.get((left, end[right])):
                    heappush(heap, (-new[0], left, right, end[right]))
            first = before[left]
            if first >= 0 and (new := at.get((first, right))):
                heappush(heap, (-new[0], first, left, right))
        out: list[int] = []
        i = 0
        while i < n:
            if found := at.get((i, end[i])):
                out.append(found[1])
            elif self.bytes:
                out += [self.bytes[b] for b in text[i].encode()]
            elif not out or out[-1] != self.unk:
                out.append(self.unk)
            i = end[i]
        return tuple(out)


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message; values of fixed size as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        x = shift = 0
        while True:
            b = message[at]
            at += 1
            x |= (b & 127) << shift
            shift += 7
            if b < 128:
                return x

    while at < len(message):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, message[at : at + size]
        at += size


def piece_types(model: bytes) -> set[int]:
    """The types of a model's pieces; 1 (normal) is the one that the file leaves out."""
    return {dict(_fields(x)).get(3, 1) for number, x in _fields(model) if number == 1}


def is_bpe(model: bytes) -> bool:
    """Whether the trainer's model_type (field 3 of field 2) is BPE, 2; unigram, 1, is the default."""
    return any(number == 2 and dict(_fields(x)).get(3, 1) == 2 for number, x in _fields(model))


def pieces_of(model: bytes) -> Pieces:
    """The encoder of a model file: merges by rank if it is BPE, else the Viterbi."""
    return MergedPieces(model) if is_bpe(model) else Pieces(model)


def encode_pieces(docs: DataFrame, model: bytes, text_col: str = "text", check: bool = True) -> DataFrame:
    """docs with pieces (array of ids), n_pieces, n_byte_pieces and, if check, exact (decoding gives the text).

    model: the bytes of a sentencepiece model file. One map over the rows: nothing is shuffled or
    dropped. A null text has null pieces, no counts and exact null; an empty one has no pieces and is
    exact. Repeated rows get the same ids. A text without spaces is one pass over its length, with a heap
    of merges if the model is BPE.
    Segmentations of short chunks are kept in a table of bounded size for each worker. Columns of docs
    named like a result column, in any case, give way to it.
    An empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = [("pieces", T.ArrayType(T.IntegerType())), ("n_pieces", T.LongType()), ("n_byte_pieces", T.LongType())]
    kinds += [("exact", T.BooleanType())] * check
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in dict(kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = loaded(shared)
        is_byte = np.zeros(len(own.surface), bool)
        is_byte[list(own.bytes.values())] = True
        for batch in batches:
            ids, exact, n_bytes = [], [], []
            for text in batch.column(batch.schema.get_field_index(text_col)).to_pylist():
                got = None if text is None else np.array(own.encode(text), np.int32)
                ids.append(got)
                n_bytes.append(None if got is None else int(is_byte[got].sum()))
                if check:
                    exact.append(None if got is None else own.decode(got.tolist()) == text)
            columns = [
                pa.array(ids, pa.list_(pa.int32())),
                pa.array([None if x is None else len(x) for x in ids], pa.int64()),
                pa.array(n_bytes, pa.int64()),
            ] + [pa.array(exact, pa.bool_())] * check
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *(k for k, _ in kinds)])

    return arrow_map(docs, run, T.StructType(docs.schema.fields + [T.StructField(k, t) for k, t in kinds]))


def decode_pieces(docs: DataFrame, model: bytes, pieces_col: str = "pieces", out_col: str = "text") -> DataFrame:
    """docs with out_col: the text of the ids in pieces_col; null ids give null and no ids an empty text.

    One map over the rows: repeated rows get the same text, and an empty table gives an empty one. A column
    of docs named like out_col, in any case, gives way to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != out_col.lower()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = loaded(shared)
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(pieces_col)).to_pylist()
            text = pa.array([None if x is None else own.decode(x) for x in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, out_col])

    return arrow_map(docs, run, T.StructType(docs.schema.fields + [T.StructField(out_col, T.StringType())]))


_LOADED: dict[int, Pieces] = {}


def loaded(shared) -> Pieces:
    """The worker's own Pieces of a broadcast model, kept from task to task."""
    key = hash(shared.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = pieces_of(shared.value)
    return _LOADED[key]
