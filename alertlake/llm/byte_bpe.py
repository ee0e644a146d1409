"""Byte-level BPE through a sentencepiece model written directly from a rank vocabulary.

Each byte sequence of the vocabulary becomes a piece: its bytes are mapped one to one to printable
characters, and its score is its negative rank, so that the model merges the pair of lowest rank
first, the leftmost of equals, as rank merging does. The model normalises nothing. Texts are cut
by the vocabulary's pattern, every pre-token is encoded by itself, and ids are decoded by the
inverse mapping. The vocabulary file is read once on the driver (under 1 MB, a fixed size) and
broadcast, so executors need no copy of it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from alertlake.llm.common import built_once, fresh, with_computed

#: Pre-tokens held at once of one text, and remembered by one worker (about 200 bytes each).
PRE_TOKENS_AT_ONCE = 1 << 18
REMEMBERED = 500_000


def ranks_of(raw: bytes) -> list[bytes]:
    """The byte sequences of a rank file, by rank; ranks have to be 0, 1, 2, …"""
    found = {int(rank): base64.b64decode(text) for text, rank in (x.split() for x in raw.splitlines() if x.strip())}
    if sorted(found) != list(range(len(found))):
        raise ValueError("the ranks are not consecutive")
    return [found[i] for i in range(len(found))]


def byte_symbols() -> list[str]:
    """A printable character for each byte: itself where it is one, else the next from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol buffer: bytes, varint or 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_proto(vocabulary: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose ids are the ranks; the id after is unknown."""
    symbols = byte_symbols()
    pieces = [
        _field(1, _field(1, "".join(symbols[b] for b in text).encode()) + _field(2, float(-rank)) + _field(3, 1))
        for rank, text in enumerate(vocabulary)
    ]
    unknown = _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    n = len(vocabulary)
    trainer = _field(3, 2) + _field(4, n + 1) + _field(40, n) + b"".join(_field(k, (1 << 64) - 1) for k in (41, 42, 43))
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + unknown + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes and decodes with one vocabulary; remembers what it has encoded."""

    def __init__(self, raw: bytes, pattern: str) -> None:
        self.vocabulary = ranks_of(raw)
        self.pattern = regex.compile(pattern)
        self.whole = {text: rank for rank, text in enumerate(self.vocabulary)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(self.vocabulary))
        self.symbols = dict(enumerate(byte_symbols()))
        #: Ids of pre-tokens, packed.
        self.kind = np.dtype(np.uint16 if len(self.vocabulary) < 1 << 16 else np.uint32)
        self.known: dict[str, bytes] = {}

    def _learn(self, pre_tokens: set[str]) -> None:
        todo = []
        for p in pre_tokens:
            rank = self.whole.get(p.encode())
            if rank is None:
                todo.append(p)
            else:
                self.known[p] = self.kind.type(rank).tobytes()
        mapped = [p.encode().decode("latin-1").translate(self.symbols) for p in todo]
        code = self.kind.char
        for p, ids in zip(todo, self.model.encode(mapped, num_threads=1), strict=True):
            self.known[p] = array(code, ids).tobytes()

    def _pre_tokens(self, text: str) -> Iterator[list[str]]:
        """The matches of the pattern, in lists of bounded length."""
        if len(text) <= PRE_TOKENS_AT_ONCE:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(found, PRE_TOKENS_AT_ONCE)):
            yield part

    def encode(self, text: str | None) -> np.ndarray:
        packed = []
        for part in self._pre_tokens(text or ""):
            if len(self.known) > REMEMBERED:
                self.known.clear()
            if new := set(part).difference(self.known):
                self._learn(new)
            packed.extend(map(self.known.__getitem__, part))
        return np.frombuffer(b"".join(packed), self.kind)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids.tolist()))


def _codec(df: DataFrame, path: str, pattern: str):
    """A function that gives a worker's own Codec."""
    with open(path, "rb") as f:
        raw = f.read()
    given = df.sparkSession.sparkContext.broadcast(raw)
    key = ("codec", hashlib.sha256(raw).hexdigest(), pattern)

    def codec() -> Codec:
        return built_once(key, lambda: Codec(given.value, pattern))

    return codec


def encode(docs: DataFrame, path: str, pattern: str, name: str = "ids", text_col: str = "text") -> DataFrame:
    """``docs`` with the array ``name`` of token ids; null and empty texts have none.

    Rows and other columns stay; ``name`` must not be a column already.
    """
    codec = _codec(docs, path, pattern)

    kind = T.ArrayType(T.IntegerType(), False)
    arrow_kind = to_arrow_type(kind)

    def compute(texts: pa.Array) -> pa.Array:
        made = [codec().encode(x) for x in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, made)], dtype=np.int32)
        ids = np.concatenate(made).astype(np.int32) if made else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids), type=arrow_kind)

    return with_computed(docs, name, kind, [text_col], compute)


def decode(docs: DataFrame, path: str, pattern: str, name: str = "decoded", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the binary column ``name``: the bytes of the ids. Null ids decode to nothing."""
    codec = _codec(docs, path, pattern)

    def compute(ids: pa.Array) -> list[bytes]:
        values, none = ids.flatten().to_numpy(), np.empty(0, np.int32)
        ends = np.cumsum([0, *(n or 0 for n in pc.list_value_length(ids).to_pylist())])
        parts = (values[a:b] if b > a else none for a, b in zip(ends[:-1], ends[1:], strict=True))
        return [codec().decode(x) for x in parts]

    return with_computed(docs, name, T.BinaryType(), [ids_col], compute)


def encoded_and_decoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ids, their count and digest, and the digest of the decoded bytes.

    The columns are ``ids``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, with
    underscores in front where ``docs`` has such a column.
    """
    ids, decoded = fresh(docs.columns, "ids"), fresh(docs.columns, "decoded")
    both = decode(encode(docs, path, pattern, ids), path, pattern, decoded, ids)
    return both.select(
        *docs.columns,
        ids,
        F.size(ids).cast("long").alias(fresh(docs.columns, "n_tokens")),
        F.sha2(F.concat_ws(" ", F.col(ids).cast("array<string>")), 256).alias(fresh(docs.columns, "ids_sha256")),
        F.sha2(F.col(decoded), 256).alias(fresh(docs.columns, "decoded_sha256")),
    )


def report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    made = encoded_and_decoded(docs.select("doc_id", "text"), path, pattern)
    return made.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
