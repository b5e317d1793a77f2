"""Byte-level byte-pair encoding and decoding through a sentencepiece model written from a rank vocabulary.

The vocabulary file holds a token's bytes (base64) and its rank. From it a sentencepiece model of kind BPE is serialised
as it stands, nothing is trained: each token becomes a piece of visible characters, one for each byte, whose score is the
negative rank, so the library joins the lowest rank first, leftmost on ties; normalisation is the identity. Texts are cut
into the matches of the split pattern; each match is encoded on its own and remembered. A piece's id is its rank.
Decoding maps pieces back to their bytes and joins them.

Defined results: a null text counts as empty, and an empty text has no ids; no string in a text is a special token; a
match that is itself a token has that one id; matches of any length are encoded whole; equal texts give equal ids and
rows do not depend on each other, so an empty table gives an empty one, repeated rows stay, and extra columns are not
looked at. Null ids decode to no bytes; ids outside the vocabulary raise. A lost task is run again on its own rows;
memory is bounded by a batch and the dictionary of matches.
"""

from __future__ import annotations

import base64
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from harborline.llm.common import arrow_map, whole_text
from harborline.llm.tokens import KEPT_CHUNKS, byte_alphabet, little_endian, visible

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Longer matches are encoded each time they occur, so that the dictionary stays small.
KEPT_CHARS = 64

# Matches encoded in one call of the library.
CALL = 4096

# Fixed values of the model format (public protocol buffer of sentencepiece): field numbers and enumeration values.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_KIND = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
MODEL_TYPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 3, 4, 40, 41, 42, 43
BPE = 2
NORMALIZER_NAME, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 1, 3, 4, 5

_codecs: dict[str, "Codec"] = {}


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file by rank; ranks must be 0, 1, 2, ... without a gap, and every byte must be a token."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(bytes.strip, f))}
    tokens = [ranks[i] for i in range(len(ranks)) if i in ranks]
    if len(tokens) != len(ranks) or len(set(tokens)) != len(tokens) or not {bytes([b]) for b in range(256)} <= set(tokens):
        raise ValueError(f"{path} is not a gapless byte-level vocabulary")
    return tokens


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose piece i is token i, scored -i; the unknown piece it must have comes last."""
    alphabet = byte_alphabet()
    pieces = [
        _bytes(PIECE_TEXT, "".join(map(alphabet.__getitem__, token)).encode()) + _float(PIECE_SCORE, float(-rank))
        + _number(PIECE_KIND, NORMAL)
        for rank, token in enumerate(tokens)
    ]
    pieces.append(_bytes(PIECE_TEXT, b"<unk>") + _float(PIECE_SCORE, 0.0) + _number(PIECE_KIND, UNKNOWN))
    trainer = _number(MODEL_TYPE, BPE) + _number(VOCAB_SIZE, len(pieces)) + _number(UNK_ID, len(tokens))
    trainer += b"".join(_number(field, -1) for field in (BOS_ID, EOS_ID, PAD_ID))
    plain = _bytes(NORMALIZER_NAME, b"identity") + b"".join(
        _number(field, 0) for field in (DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES)
    )
    return b"".join(_bytes(PIECES, piece) for piece in pieces) + _bytes(TRAINER, trainer) + _bytes(NORMALIZER, plain)


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(tokens))
        if self.model.get_piece_size() != len(tokens) + 1:
            raise ValueError(f"{path}: the library did not take all pieces")
        self.split = regex.compile(pattern).findall
        self.whole = {token: little_endian([rank]) for rank, token in enumerate(tokens)}
        back = {ord(shown): byte for byte, shown in byte_alphabet().items()}
        shown = [self.model.id_to_piece(i) for i in range(len(tokens))]
        self.tokens = [piece.translate(back).encode("latin-1") for piece in shown]
        self.known: dict[str, bytes] = {}

    def learn(self, matches: list[str]) -> dict[str, bytes]:
        """Packed ids of matches that are not in the dictionary yet; those of moderate length are remembered."""
        found = {}
        for start in range(0, len(matches), CALL):
            some = matches[start : start + CALL]
            ids = self.model.encode([visible(match) for match in some], out_type=int, num_threads=1)
            for match, its in zip(some, ids):
                found[match] = self.whole.get(match.encode()) or little_endian(its)
        self.known.update((match, ids) for match, ids in found.items() if len(match) <= KEPT_CHARS)
        return found

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text."""
        if len(self.known) > KEPT_CHUNKS:
            self.known.clear()
        cut = [self.split(text) if text else [] for text in texts]
        fresh = set().union(*cut).difference(self.known)
        table = self.known
        if fresh:
            long = {match: ids for match, ids in self.learn(list(fresh)).items() if len(match) > KEPT_CHARS}
            table = self.known | long if long else self.known
        return [b"".join(map(table.__getitem__, matches)) for matches in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def codec(path: str) -> Codec:
    """The codec of a file, one for each Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _mapped(rows: DataFrame, text: bool, path: str, decoded: bool) -> DataFrame:
    """doc_id and ids of each row, made from its text or taken over, and the decoded bytes where asked for."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made, given = codec(path), batch.column(1).to_pylist()
        ids = made.encode_all(given) if text else [x or b"" for x in given]
        columns = [batch.column(0), pa.array(ids, pa.binary())]
        if decoded:
            columns.append(pa.array([made.decode(np.frombuffer(x, "<u4")) for x in ids], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, run, f"doc_id {kind}, ids binary" + ", decoded binary" * decoded)


def encode(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of every document."""
    return _mapped(docs.select("doc_id", whole_text().alias("text")), True, path, False)


def decode(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """The rows of `encode` with the bytes they decode to."""
    return _mapped(encoded.select("doc_id", "ids"), False, path, True)


def round_trip(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """Encoding and decoding in one pass over the documents: doc_id, ids and the bytes decoded from them."""
    return _mapped(docs.select("doc_id", whole_text().alias("text")), True, path, True)
