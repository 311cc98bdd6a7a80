"""Byte-level BPE by ranks, run as a sentencepiece BPE model.

The rank file's byte sequences are mapped to strings, one printable character per byte, and written
straight into a sentencepiece model: every sequence is a piece whose score is its negative rank, the
normaliser is the identity and no blanks are added or escaped. sentencepiece then merges the pair of
best score, which is the pair of lowest rank. A text is split by the pattern first and every match
is encoded on its own; a match that is itself a sequence of the file is one id without merging, as in
the rank format's own rules. Ids are ranks; decoding maps ids back to bytes.

The work is per row, in Arrow batches, without a shuffle. Words repeat, so each worker remembers the
ids of recent blank-delimited stretches (a bounded number).

Defined cases: null and empty texts have no ids; texts are never cut, whatever their length; repeated
rows each give a row; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as model_pb

from .common import fresh, ship

#: Stretches remembered by a worker before it starts over.
REMEMBER = 200_000


def byte_characters() -> list[str]:
    """A printable character for every byte: itself where Latin-1 has a visible one, else one of the
    characters from U+0100 on, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [], 0x100
    for b in range(256):
        if b in visible:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised sentencepiece model. Piece i has rank i; the unknown piece comes last."""
    chars = byte_characters()
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[b] for b in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks are not 0, 1, 2, ...")
    m = model_pb.ModelProto()
    for rank, seq in enumerate(by_rank):
        m.pieces.add(piece="".join(chars[b] for b in seq), score=-float(rank))
    m.pieces.add(piece="<unk>", score=0.0, type=model_pb.ModelProto.SentencePiece.UNKNOWN)
    spec = m.trainer_spec
    spec.model_type = model_pb.TrainerSpec.BPE
    spec.vocab_size = len(m.pieces)
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(by_rank), -1, -1, -1
    norm = m.normalizer_spec
    norm.name = "identity"
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    return m.SerializeToString()


class Codec:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        ranks = read_ranks(path)
        self.ids = {seq: np.uint32(i).tobytes() for seq, i in ranks.items()}
        self.bytes = sorted(ranks, key=ranks.__getitem__)
        self.find = regex.compile(pattern).findall
        self.chars = {i: c for i, c in enumerate(byte_characters())}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.run = regex.compile(r"\s\s").search
        self.known: dict[str, bytes] = {}

    def piece(self, match: str) -> bytes:
        """Ids of one match of the pattern."""
        raw = match.encode("utf-8", "surrogatepass")
        whole = self.ids.get(raw)
        if whole is not None:
            return whole
        ids = self.model.encode(raw.decode("latin-1").translate(self.chars), out_type=int)
        return np.asarray(ids, "<u4").tobytes()

    def stretch(self, text: str) -> bytes:
        return b"".join(map(self.piece, self.find(text)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. Every match of the pattern either is white
        space or has none but one leading blank, so a text without two white-space characters in a
        row splits before each blank."""
        if self.run(text):
            return self.stretch(text)
        first, *rest = text.split(" ")
        parts = [first, *[" " + x for x in rest]]
        known = self.known
        found = list(map(known.get, parts))
        if None in found:
            if len(known) > REMEMBER:
                known.clear()
            for i, x in enumerate(found):
                if x is None:
                    part = parts[i]
                    x = known.get(part)
                    if x is None:
                        x = self.stretch(part)
                        if len(part) < 64:
                            known[part] = x
                    found[i] = x
        return b"".join(found)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(
    df: DataFrame, path: str, pattern: str, text_col: str = "text", keep_text: bool = False
) -> tuple[DataFrame, str]:
    """`df` with the text replaced by its ids (binary, little-endian unsigned 32-bit), or with both;
    and the name of the id column. `path` must be readable on every executor."""
    ship(df.sparkSession)
    (name,) = fresh(df, "ids")
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for rows in batches:
            ids = pa.array([c.encode(t.as_py() or "") for t in rows.column(place)], pa.binary())
            cols = list(rows.columns)
            if keep_text:
                cols.append(ids)
            else:
                cols[place] = ids
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    fields, names = list(plain.schema.fields), list(df.columns)
    if keep_text:
        fields, names = [*fields, T.StructField("ids", T.BinaryType())], [*names, name]
    else:
        fields[place], names[place] = T.StructField(f"c{place}", T.BinaryType()), name
    schema = T.StructType(fields)
    return plain.mapInArrow(run, schema).toDF(*names), name


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> tuple[DataFrame, str]:
    """`df` with a binary column of the bytes its ids stand for, and that column's name."""
    ship(df.sparkSession)
    (name,) = fresh(df, "decoded")
    place = df.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for rows in batches:
            out = pa.array([c.decode(x.as_py() or b"") for x in rows.column(place)], pa.binary())
            yield pa.RecordBatch.from_arrays([*rows.columns, out], names=schema.names)

    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    schema = T.StructType([*plain.schema.fields, T.StructField("decoded", T.BinaryType())])
    return plain.mapInArrow(run, schema).toDF(*df.columns, name), name
