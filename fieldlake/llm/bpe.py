"""Byte-level BPE through a sentencepiece model made from a rank file.

A rank file lists byte strings by merge rank. Each becomes a piece of a
serialised BPE model: its bytes written as printable characters, one each,
with its negative rank as score and no normalisation, so the merges a
sentencepiece processor makes are the merges by lowest rank. Texts are split
by the vocabulary's pattern, pre-tokens are encoded one by one, and ids are
decoded by the inverse mapping.

Rows are independent: one map over the table without a shuffle. A worker
keeps the ids of the pre-tokens it has met, packed, in a table that is emptied
when it holds ``MEMO`` of them and at the end of a partition; a long text is
held once with its ids.

Defined cases: a null text is an empty one and has no ids; repeated rows are
encoded alike; an empty table gives an empty table; further columns pass
through ``encoded`` unchanged, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from fieldlake.llm.common import col, columns_of, fresh, slices

MEMO = 200_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where Latin-1 prints it,
    else the next one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (x.split() for x in lines if x.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, body: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(body)) + body


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def model_proto(ranks: dict[bytes, int]) -> tuple[bytes, list[int]]:
    """A serialised sentencepiece model, and the rank of each of its ids
    (the unknown piece, which the format requires, has -1)."""
    chars = byte_characters()
    out, rank_of = [_field(1, _field(1, b"<unk>") + _number(3, 2))], [-1]
    for piece, rank in sorted(ranks.items(), key=lambda x: x[1]):
        text = "".join(chars[b] for b in piece).encode()
        out.append(_field(1, _field(1, text) + b"\x15" + struct.pack("<f", -float(rank)) + _number(3, 1)))
        rank_of.append(rank)
    trainer = _number(3, 2) + _number(4, len(rank_of)) + _number(40, 0)
    plain = _field(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join([*out, _field(2, trainer), _field(3, plain)]), rank_of


class Codec:
    """Encodes and decodes texts on one worker."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(ranks_path)
        proto, rank_of = model_proto(self.ranks)
        self.packed = [max(r, 0).to_bytes(4, "little") for r in rank_of]
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.chars = dict(enumerate(byte_characters()))
        self.split = regex.compile(pattern).findall
        self.bytes_of: dict[int, bytes] = {r: p for p, r in self.ranks.items()}
        self.memo: dict[str, bytes] = {}  # a pre-token's ids as 4-byte integers

    def _learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self.memo]
        if len(self.memo) + len(new) > MEMO:
            self.memo, new = {}, list(tokens)
        hard = []
        for t in new:
            rank = self.ranks.get(t.encode())  # a whole piece is one id
            if rank is None:
                hard.append(t)
            else:
                self.memo[t] = rank.to_bytes(4, "little")
        mapped = [t.encode().decode("latin-1").translate(self.chars) for t in hard]
        for t, ids in zip(hard, self.model.encode(mapped, num_threads=1) if mapped else [], strict=True):
            self.memo[t] = b"".join([self.packed[i] for i in ids])

    def encode(self, text: str) -> np.ndarray:
        tokens = self.split(text)
        try:
            ids = b"".join(map(self.memo.__getitem__, tokens))
        except KeyError:
            self._learn(set(tokens))
            ids = b"".join(map(self.memo.__getitem__, tokens))
        return np.frombuffer(ids, dtype="<i4")

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(ranks_path: str, pattern: str) -> Codec:
    key = (ranks_path, pattern)
    if key not in _codecs:
        _codecs[key] = Codec(*key)
    return _codecs[key]


def _texts(column: pa.Array) -> Iterator[str]:
    for x in column:
        yield x.as_py() or ""


def encoded(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
            ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of each text (the new column gets another name
    if this one is taken)."""
    (name,) = fresh(docs, ids_col)
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])

    def run(batches):
        c = codec(ranks_path, pattern)
        for batch in batches:
            for one in slices(batch, at):
                lists = [c.encode(t) for t in _texts(one.column(at))]
                ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))
                yield pa.RecordBatch.from_arrays([*one.columns, ids], [*one.schema.names, name])
        c.memo = {}

    return docs.select(*columns_of(docs)).mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Per document the number of ids, the SHA-256 of the decimal ids joined
    by commas, and that of the bytes decoded from the ids."""

    def run(batches):
        c = codec(ranks_path, pattern)
        decimal = {r: str(r) for r in c.bytes_of}
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in _texts(batch.column(1)):
                ids = c.encode(text).tolist()
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
        c.memo = {}

    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])
    return docs.select(col(id_col), col(text_col)).mapInArrow(run, schema)


def decoded(rows: DataFrame, ranks_path: str, pattern: str, ids_col: str = "token_ids",
            text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of each list of ids (null ids: empty)."""
    (name,) = fresh(rows, text_col)
    at = rows.columns.index(ids_col)
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())])

    def run(batches):
        c = codec(ranks_path, pattern)
        for batch in batches:
            texts = pa.array([c.decode(x.as_py() or []).decode() for x in batch.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, name])

    return rows.select(*columns_of(rows)).mapInArrow(run, schema)
