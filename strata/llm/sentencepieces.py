"""SentencePiece models on the tokenizers library.

The model protobuf is read field by field; from it a tokenizers pipeline is built
with the model's normaliser, metaspace marker, scores (unigram) or score-ordered
merges (BPE) and byte fallback, and a decoder for the way back.  Batches are
encoded by the library in the task's own thread.  Each unit met is also encoded by the
sentencepiece library and decoded again: ``parity`` and ``lossless`` tell per
document whether all of its units agreed.

Defined cases: a null or empty text has no ids, parity and lossless true; repeated
rows are encoded row by row; an empty table gives an empty result; other columns are
carried along, columns named like the computed ones are replaced.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from strata.llm.units import UnitTable, keep_whole, list_array, slices, split_between

MARK = "▁"
SLICE_CHARS = 1_000_000        # characters handled at a time: two codecs and their tables stand beside them
# Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message, in file order."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        wire = tag & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            size, at = (8, at) if wire == 1 else (4, at) if wire == 5 else _varint(data, at)
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


class SentencePieceModel:
    """Pieces, scores, types and settings of a model file."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        trainer, normaliser = {}, {}
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                self.pieces.append(piece.get(1, b"").decode("utf-8"))
                self.scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normaliser = dict(fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.unknown = self.types.index(UNKNOWN) if UNKNOWN in self.types else 0
        self.charsmap = normaliser.get(2, b"")
        self.dummy_prefix = bool(normaliser.get(3, 1))
        self.collapse_spaces = bool(normaliser.get(4, 1))
        self.escape_spaces = bool(normaliser.get(5, 1))

    @property
    def splits_at_spaces(self) -> bool:
        """Whether a text may be encoded unit by unit: spaces survive, every unit gets
        the marker, and no piece holds a marker after another character."""
        inner = any(MARK in p.lstrip(MARK) for p, t in zip(self.pieces, self.types) if t != CONTROL)
        return (self.dummy_prefix and self.escape_spaces and not self.collapse_spaces
                and not self.charsmap and not inner)

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces in the order in which BPE joins them: by the score of the result."""
        rank = {p: k for k, p in enumerate(self.pieces) if self.types[k] in (NORMAL, USER_DEFINED, UNUSED)}
        found = []
        for piece, k in rank.items():
            pairs = [(piece[:i], piece[i:]) for i in range(1, len(piece))
                     if piece[:i] in rank and piece[i:] in rank]
            pairs.sort(key=lambda ab: (rank[ab[0]], rank[ab[1]]))
            found += [(-self.scores[k], k, *ab) for ab in pairs]
        found.sort(key=lambda x: x[:2])
        return [(a, b) for _, _, a, b in found]

    def tokenizer(self):
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers
        if self.kind == UNIGRAM:
            model = models.Unigram(list(zip(self.pieces, self.scores)), self.unknown, self.byte_fallback)
        else:
            model = models.BPE({p: k for k, p in enumerate(self.pieces)}, self.merges(),
                               unk_token=self.pieces[self.unknown], fuse_unk=True,
                               byte_fallback=self.byte_fallback)
        t = Tokenizer(model)
        steps = []
        if self.charsmap:
            steps.append(normalizers.Precompiled(self.charsmap))
        if self.collapse_spaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if self.escape_spaces else " "))
        if self.escape_spaces:
            steps.append(normalizers.Replace(" ", MARK))
        t.normalizer = normalizers.Sequence(steps)
        back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        if self.dummy_prefix:
            back.append(decoders.Strip(" ", 1, 0))
        t.decoder = decoders.Sequence(back)
        return t


class SentencePieceCodec:
    """Encoder and decoder of whole texts by one model file."""

    def __init__(self, path: str):
        import sentencepiece
        with open(path, "rb") as f:
            self.model = SentencePieceModel(f.read())
        self.tokenizer = self.model.tokenizer()
        self._original = sentencepiece.SentencePieceProcessor(model_file=path)
        self._split = split_between if self.model.splits_at_spaces else keep_whole
        self._table = UnitTable(self._units)

    def _units(self, units: list[str]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # the cores belong to Spark's tasks, and threads keep memory
        lists = [e.ids for e in self.tokenizer.encode_batch(units, add_special_tokens=False)]
        theirs = self._original.encode(units, num_threads=1)
        back = self.tokenizer.decode_batch(lists, skip_special_tokens=False)
        # two flags in one number: 1 for parity, 2 for a lossless way back
        return lists, [(a == b) + 2 * (u == d) for a, b, u, d in zip(lists, theirs, units, back)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text, parity per text, lossless per text)."""
        ids, n, flags = self._table.encode(texts, self._split)
        return ids, n, (flags & 1) == 1, (flags & 2) == 2

    def decode(self, lists: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(lists, skip_special_tokens=False)


@lru_cache(maxsize=2)
def codec(path: str) -> SentencePieceCodec:
    return SentencePieceCodec(path)


ENCODED = StructType([StructField("ids", ArrayType(IntegerType())), StructField("n_tokens", LongType()),
                      StructField("ids_crc32", LongType()), StructField("parity", BooleanType()),
                      StructField("lossless", BooleanType())])


def encode_documents(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` plus ids, n_tokens, ids_crc32 (little-endian unsigned 32 bit), parity, lossless."""

    @F.arrow_udf(ENCODED)
    def encode(texts: pa.Array) -> pa.Array:
        pa.default_memory_pool().release_unused()        # of the tasks that the worker had before
        parts = [codec(model_path).encode(run) for run in slices(texts, SLICE_CHARS)]
        if not parts:
            return pa.array([], pa.struct([("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()),
                                           ("ids_crc32", pa.int64()), ("parity", pa.bool_()),
                                           ("lossless", pa.bool_())]))
        ids, n, parity, lossless = (np.concatenate(x) for x in zip(*parts))
        ends = np.cumsum(n)
        raw = ids.astype("<u4")
        crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(ends - n, ends)]
        return pa.StructArray.from_arrays(
            [list_array(ids, n), pa.array(n), pa.array(crc, pa.int64()), pa.array(parity), pa.array(lossless)],
            names=ENCODED.names)

    out = docs.withColumn("_encoded", encode(text))
    return out.withColumns({c: F.col(f"_encoded.{c}") for c in ENCODED.names}).drop("_encoded")


def decode_column(ids: str, model_path: str):
    """Column of texts for a column of id lists (null: null)."""

    @F.arrow_udf(StringType())
    def decode(lists: pa.Array) -> pa.Array:
        rows = lists.to_pylist()
        texts = iter(codec(model_path).decode([r for r in rows if r is not None]))
        return pa.array([None if r is None else next(texts) for r in rows], pa.string())

    return decode(F.col(ids))
