"""Token ids of whole texts, as the tokenizers library gives them, at the speed of a dictionary.

A text is cut at spaces (and line ends) into chunks whose ids do not depend on each other; the library's model encodes
a chunk once, and then it is looked up. Texts for which the cut is not certain go to the library whole. The cut is known
for the two kinds of vocabulary below; any other tokenizer file gets every text whole.
"""

from __future__ import annotations

import json
from array import array

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from harborline.llm.common import arrow_map, whole_text

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

# Chunks a worker remembers of the newer and of the older half; bounds memory, not the result.
KEPT_CHUNKS = 600_000

# Marks that may stand behind letters; without the apostrophe, which may begin a piece of letters.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

ODD_SPACES = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

_encoders: dict[str, "ChunkEncoder"] = {}


if array("I").itemsize != 4 or array("H", [1]).tobytes() != b"\1\0":
    raise RuntimeError("needs a little-endian machine with 4-byte integers")


def little_endian(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return array("I", ids).tobytes()


def byte_alphabet() -> dict[int, str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


_alphabet = byte_alphabet()


def visible(text: str) -> str:
    """The UTF-8 bytes of a text, each as its visible character."""
    if text.isascii() and text.isprintable():
        return text.replace(" ", _alphabet[32])
    return text.encode("utf-8").decode("latin-1").translate(_alphabet)


def load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def read_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return "<|" not in text and "\0" not in text and not any(c in text for c in ODD_SPACES)


def cut_byte_level(text: str) -> list[str] | None:
    """Chunks in front of single spaces and line ends. A run of white space may join its neighbours: not cut then.

    A chunk stands for itself with the space before it; NUL marks the first, which has none.
    """
    if not _is_latin(text) or any(run in text for run in ("  ", " \n", "\n ", "\n\n")):
        return None
    chunks = text.replace("\n", " \n").split(" ")
    chunks[0] = "\0" + chunks[0]
    return chunks


def cut_words(text: str) -> list[str] | None:
    """Lower-cased chunks between white space, for texts in Latin-1, where case and composition are plain."""
    return text.lower().split() if _is_latin(text) else None


class ChunkEncoder(dict):
    """Maps a chunk to its packed ids; encodes texts through that map."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer, self.older, self.cut, self.space = load(path), {}, None, ""
        self.model = self.tokenizer.model
        # A chunk is often a known word with some other mark behind it: the word is a chunk as well, other pieces stand here.
        self.parts: dict[str, bytes] = {}
        spec = read_spec(path)
        before, normal = spec["pre_tokenizer"] or {}, spec["normalizer"] or {}
        steps = [step.get("type") for step in normal.get("normalizers", [])]
        splits = before.get("pretokenizers", [])
        if before.get("type") == "ByteLevel" and before.get("use_regex") and not before["add_prefix_space"] and not normal:
            self.cut, self.pieces, self.space = cut_byte_level, regex.compile(public_tokenizers.PATTERN).findall, " "
        elif steps == ["NFC", "Replace", "Lowercase"] and [s.get("type") for s in splits] == ["Split", "ByteLevel"]:
            self.cut, self.pieces = cut_words, regex.compile(splits[0]["pattern"]["Regex"]).findall

        # Whether letters are one piece and marks behind them one more, which saves looking for them by the pattern.
        self.plain = self.cut is not None and self.pieces(self.space + "ab" + MARKS) == [self.space + "ab", MARKS]

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.pop(chunk, None)
        if found is None:
            found = self._made(chunk)
        if len(chunk) <= 64:
            self[chunk] = found
        return found

    def _made(self, chunk: str) -> bytes:
        known = self.parts.get
        word = chunk if chunk.isalpha() else chunk.rstrip(MARKS)
        if self.plain and word.isalpha():
            if len(word) == len(chunk):
                return self._ids(self.space + word)
            marks = chunk[len(word) :]
            return self[word] + (known(marks) or self._part(marks))
        text = chunk
        if self.cut is cut_byte_level:
            text = chunk[1:] if chunk[:1] == "\0" else chunk if chunk[:1] == "\n" else " " + chunk
        return b"".join([known(piece) or self._part(piece) for piece in self.pieces(text)])

    def _ids(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(visible(piece))]).tobytes()

    def _part(self, piece: str) -> bytes:
        ids = self._ids(piece)
        if len(piece) <= 64:
            self.parts[piece] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Packed ids of one text; a null text counts as empty."""
        chunks = self.cut(text or "") if self.cut else None
        if chunks is None:
            return little_endian(self.tokenizer.encode(text or "", add_special_tokens=False).ids)
        if len(self) > KEPT_CHUNKS:
            self.older = dict(self)
            self.clear()
            if len(self.parts) > KEPT_CHUNKS:
                self.parts.clear()
        return b"".join(map(self.__getitem__, chunks))


def encoder(path: str) -> ChunkEncoder:
    """The encoder of a file, one for each Python worker."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def forget() -> None:
    """Let go of this worker's encoders with all they remember; who needs one again makes it anew."""
    _encoders.clear()


def tokenize(docs: DataFrame, path: str, end_id: int | None = None) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of each document, with an end id if one is named."""
    tail = b"" if end_id is None else little_endian([end_id])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = encoder(path).encode
        ids = [encode(t) + tail for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return arrow_map(docs.select("doc_id", whole_text().alias("text")), run, f"doc_id {_type(docs)}, ids binary")


def _type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()
