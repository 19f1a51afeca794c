"""Byte-level BPE on top of sentencepiece.

A rank file is turned into a sentencepiece BPE model: every byte of a token becomes one letter, the
score of a piece is its negative rank, and normalisation is the identity. Sentencepiece then merges
the pair of the highest score first, which is the pair of the lowest rank. Texts are cut by a
pattern and each match is encoded alone; decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewlog.llm.tables import text_of

FIRST_LETTER = 0x100  # byte b is written as the letter U+0100 + b
REMEMBERED = 200_000  # pieces whose ids a worker keeps; beyond that it starts over

# Field numbers and values of sentencepiece's model format: fixed values.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
TYPE_NORMAL, TYPE_UNKNOWN = 1, 2
MODEL_TYPE, MODEL_BPE = 3, 2
NORMALIZER_NAME, ADD_DUMMY_PREFIX, REMOVE_EXTRA_SPACES, ESCAPE_SPACES = 1, 3, 4, 5


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file by rank; ranks are 0, 1, 2 ... without gaps."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    if not all(tokens):
        raise ValueError(f"{path}: ranks have gaps")
    return tokens


def letters(data: bytes) -> str:
    """The bytes as letters, one each."""
    return data.decode("latin-1").translate(_TO_LETTERS)


_TO_LETTERS = {byte: FIRST_LETTER + byte for byte in range(256)}


def _varint(number: int) -> bytes:
    out = bytearray()
    while number > 0x7F:
        out.append(number & 0x7F | 0x80)
        number >>= 7
    out.append(number)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    body = _bytes(PIECE_TEXT, text.encode()) + _varint(PIECE_SCORE << 3 | 5) + struct.pack("<f", score)
    return _bytes(PIECES, body + _number(PIECE_TYPE, kind))


def model_bytes(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks; the unknown piece comes last."""
    pieces = [_piece(letters(token), -float(rank), TYPE_NORMAL) for rank, token in enumerate(tokens)]
    pieces.append(_piece("<unk>", 0.0, TYPE_UNKNOWN))
    normalizer = (
        _bytes(NORMALIZER_NAME, b"identity") + _number(ADD_DUMMY_PREFIX, 0)
        + _number(REMOVE_EXTRA_SPACES, 0) + _number(ESCAPE_SPACES, 0))
    return b"".join(pieces) + _bytes(TRAINER, _number(MODEL_TYPE, MODEL_BPE)) + _bytes(NORMALIZER, normalizer)


class Codec:
    """Encodes and decodes texts by a rank file."""

    def __init__(self, path: str, pattern: str):
        self.tokens = read_ranks(path)
        self.pieces = regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.tokens))
        # A piece that is a token by itself is that token, whatever the merges would lead to.
        self.whole = {}
        for rank, token in enumerate(self.tokens):
            try:
                self.whole[token.decode()] = str(rank)
            except UnicodeDecodeError:
                continue
        self.seen = dict(self.whole)
        self.by_id = {str(rank): token for rank, token in enumerate(self.tokens)}

    def encode(self, text: str) -> str:
        """The decimal ids of a text, joined by commas; empty for an empty text."""
        pieces, seen = self.pieces.findall(text), self.seen
        ids = [seen.get(piece) for piece in pieces]
        if None in ids:
            new = list({piece for piece, known in zip(pieces, ids) if known is None})
            if len(seen) + len(new) > len(self.whole) + REMEMBERED:
                self.seen = seen = dict(self.whole)
            own = dict(zip(new, self._merge(new)))
            if len(new) <= REMEMBERED:
                seen.update(own)
            ids = [known or own[piece] for piece, known in zip(pieces, ids)]
        return ",".join(ids)

    def _merge(self, pieces: list[str]) -> Iterable[str]:
        encoded = self.model.encode([letters(piece.encode()) for piece in pieces], num_threads=1)
        return (",".join(map(str, ids)) for ids in encoded)

    def decode(self, ids: str) -> bytes:
        """The bytes of ids as ``encode`` gives them."""
        by_id = self.by_id
        return b"".join([by_id[one] for one in ids.split(",")]) if ids else b""


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """A worker builds each codec once."""
    return Codec(path, pattern)


ENCODED = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.StringType()),
    T.StructField("decoded", T.BinaryType()),
])
DIGESTS = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
])


def _coded(texts: pd.Series, path: str, pattern: str) -> Iterator[tuple[int, str, bytes]]:
    coder = codec(path, pattern)
    for text in texts:
        ids = coder.encode(text)
        yield (ids.count(",") + 1 if ids else 0), ids, coder.decode(ids)


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document doc_id, n_tokens, ids (decimal, joined by commas) and the bytes decoded from them.

    ``path`` is a rank file that every executor can open, ``pattern`` cuts the texts. A NULL text is
    an empty one and has no ids. Rows are independent of each other, so ties, repeated rows and
    tables without rows need no rule; other columns are ignored.
    """

    @F.pandas_udf(ENCODED)
    def code(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(_coded(texts, path, pattern), columns=ENCODED.names)

    return docs.select(docs["doc_id"], code(text_of(docs)).alias("_coded")).select("doc_id", "_coded.*")


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document doc_id, n_tokens and the SHA-256 of what ``encode_texts`` returns.

    The digests are taken next to the encoder, so ids and bytes never leave the worker.
    """

    @F.pandas_udf(DIGESTS)
    def code(texts: pd.Series) -> pd.DataFrame:
        rows = [
            (count, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest())
            for count, ids, decoded in _coded(texts, path, pattern)
        ]
        return pd.DataFrame(rows, columns=DIGESTS.names)

    return docs.select(docs["doc_id"], code(text_of(docs)).alias("_coded")).select("doc_id", "_coded.*")
