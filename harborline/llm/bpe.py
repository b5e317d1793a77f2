"""Byte-pair encoding and decoding by forced-boundary splitting.

No merge crosses a place where two bytes meet that stand next to each other inside no token of the vocabulary. Each word
is cut at all such places; the fragments are encoded on their own, remembered, and their ids joined. The result is that
of merging whole words, and of the tokenizers library with the same file.

Defined results: a null text counts as empty and has no ids; the names of special tokens in a text are those tokens;
words of any length are merged in n log n; equal texts give equal ids, and rows are independent of each other, so an
empty table gives an empty one and extra columns are not looked at. Decoding joins the tokens' names by one space, as
the file names no decoder. A lost task is run again on its own rows; memory is bounded by a text and the dictionary.
"""

from __future__ import annotations

import heapq
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from harborline.llm.common import arrow_map, whole_text
from harborline.llm.tokens import KEPT_CHUNKS, WORD_VOCABULARY, cut_words, load, read_spec, visible

END = "</w>"

# Up to so many symbols the lowest merge is found by looking at all of them.
SHORT = 48

_codecs: dict[str, "Codec"] = {}


class Codec:
    """Encoder and decoder of one vocabulary file with word ends."""

    def __init__(self, path: str):
        spec = read_spec(path)
        model, library = spec["model"], load(path)
        if model["end_of_word_suffix"] != END or spec["decoder"] is not None:
            raise ValueError(f"{path} is not a vocabulary with word ends")
        self.normalize = library.normalizer.normalize_str
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.any_words = library.pre_tokenizer.pre_tokenize_str
        self.vocabulary: dict[str, int] = dict(model["vocab"])
        self.merges = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        names = {i: t for t, i in (self.vocabulary | self.special).items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.meeting = self._pairs_inside_tokens()
        self.fragments: dict[str, list[int]] = {}
        self.chunks: dict[str, list[int]] = {}

    def _pairs_inside_tokens(self) -> set[str]:
        """Two neighbours inside some token; the second carries the word end if the token does."""
        found = set()
        for token in self.vocabulary:
            ends = token.endswith(END) and len(token) > len(END)
            body = token.removesuffix(END) if ends else token
            found.update(body[i : i + 2] for i in range(len(body) - (2 if ends else 1)))
            if ends and len(body) > 1:
                found.add(body[-2:] + END)
        return found

    def cut(self, word: str) -> list[str]:
        """The fragments of a word of visible bytes; the last one is marked with the word end."""
        last, start, parts = len(word) - 1, 0, []
        for i in range(1, len(word)):
            pair = word[i - 1 : i + 1]
            if (pair + END if i == last else pair) not in self.meeting:
                parts.append(word[start:i])
                start = i
        return [*parts, word[start:] + END]

    def merge(self, fragment: str) -> list[int]:
        """Ids of a fragment: the lowest-ranked pair is merged, leftmost first, until none is left."""
        ends = fragment.endswith(END) and len(fragment) > len(END)
        symbols = list(fragment.removesuffix(END) if ends else fragment)
        if ends:
            symbols[-1] += END
        symbols = self._merge_short(symbols) if len(symbols) <= SHORT else self._merge_long(symbols)
        return [self.vocabulary[s] for s in symbols]

    def _merge_short(self, symbols: list[str]) -> list[str]:
        rank = self.merges.get
        none = len(self.merges)
        ranks = [rank(pair, none) for pair in zip(symbols, symbols[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((symbols[i - 1], symbols[i]), none)
            if i < len(ranks):
                ranks[i] = rank((symbols[i], symbols[i + 1]), none)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        rank, n = self.merges.get, len(symbols)
        before, after, alive = [*range(-1, n - 1)], [*range(1, n + 1)], [True] * n
        queue = [(r, i, pair) for i, pair in enumerate(zip(symbols, symbols[1:])) if (r := rank(pair)) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or j >= n or (symbols[i], symbols[j]) != pair:
                continue
            symbols[i] += symbols[j]
            alive[j], after[i] = False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank((symbols[a], symbols[b]))) is not None:
                    heapq.heappush(queue, (r, a, (symbols[a], symbols[b])))
        return [s for s, there in zip(symbols, alive) if there]

    def _latin_words(self, text: str) -> list[str]:
        return [visible(word) for word in ([text] if text.isalpha() else self.words(text))]

    def _any_words(self, text: str) -> list[str]:
        """Beyond Latin-1, what counts as a letter depends on the library's own tables."""
        return [word for word, _ in self.any_words(text)]

    def _ids(self, words: list[str]) -> list[int]:
        out: list[int] = []
        for word in words:
            for fragment in self.cut(word):
                ids = self.fragments.get(fragment)
                if ids is None:
                    ids = self.merge(fragment)
                    if len(fragment) <= 64:
                        self.fragments[fragment] = ids
                out += ids
        return out

    def encode(self, text: str | None) -> list[int]:
        if len(self.fragments) > KEPT_CHUNKS:
            self.fragments.clear()
        if len(self.chunks) > KEPT_CHUNKS:
            self.chunks.clear()
        chunks, out = cut_words(text or ""), []
        if chunks is not None:
            known = self.chunks.get
            for chunk in chunks:
                ids = known(chunk)
                if ids is None:
                    ids = self._ids(self._latin_words(chunk))
                    if len(chunk) <= 64:
                        self.chunks[chunk] = ids
                out += ids
            return out
        start = 0
        for found in self.at_special.finditer(text) if self.at_special else ():
            out += self._ids(self._any_words(self.normalize(text[start : found.start()])))
            out.append(self.special[found.group()])
            start = found.end()
        return out + self._ids(self._any_words(self.normalize(text[start:])))

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.names.__getitem__, ids))


def codec(path: str) -> Codec:
    """The codec of a file, one for each Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _mapped(rows: DataFrame, text: bool, path: str, decoded: bool) -> DataFrame:
    """doc_id and ids of each row, made from its text or taken over, and the decoded text where asked for."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made, given = codec(path), batch.column(1).to_pylist()
        ids = [made.encode(t) if text else t or [] for t in given]
        columns = [batch.column(0), pa.array(ids, pa.list_(pa.int32()))]
        if decoded:
            columns.append(pa.array([made.decode(x) for x in ids], pa.string()))
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, run, f"doc_id {kind}, ids array<int>" + ", decoded string" * decoded)


def encode(docs: DataFrame, path: str = WORD_VOCABULARY) -> DataFrame:
    """doc_id and ids of every document."""
    return _mapped(docs.select("doc_id", whole_text().alias("text")), True, path, False)


def decode(encoded: DataFrame, path: str = WORD_VOCABULARY) -> DataFrame:
    """The rows of `encode` with the decoded text; null ids decode to the empty text."""
    return _mapped(encoded.select("doc_id", "ids"), False, path, True)


def round_trip(docs: DataFrame, path: str = WORD_VOCABULARY) -> DataFrame:
    """Encoding and decoding in one pass over the documents: doc_id, ids and the text decoded from them."""
    return _mapped(docs.select("doc_id", whole_text().alias("text")), True, path, True)
