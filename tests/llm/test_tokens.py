"""Byte-pair coding, packing and token files against the tokenizers library and plain versions."""

import hashlib
import heapq
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from harborline.llm import bpe, huffman, packing, queries, tokens
from harborline.llm.common import scratch_path, stage_packed
from harborline.llm.tokens import BYTE_VOCABULARY, WORD_VOCABULARY, encoder, little_endian, load, tokenize
from harborline.session import scratch_scope
from tests_llm_rows import ODD_ROWS, SMALL

BYTES, WORDS = load(BYTE_VOCABULARY), load(WORD_VOCABULARY)

RANGES = st.text(st.one_of(st.sampled_from("ab cDE 'sté\n\t.,!ſΣİ<|"), st.characters(exclude_categories=["Cs"])), max_size=60)


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(RANGES)
def test_ids_are_those_of_the_library(text):
    codec = bpe.codec(WORD_VOCABULARY)
    ids = codec.encode(text)
    assert ids == plain(WORDS, text)
    assert codec.decode(ids) == WORDS.decode(ids, skip_special_tokens=False)
    assert encoder(WORD_VOCABULARY).encode(text) == little_endian(ids)
    assert encoder(BYTE_VOCABULARY).encode(text) == little_endian(plain(BYTES, text))


def test_every_character_of_the_first_planes():
    codec = bpe.codec(WORD_VOCABULARY)
    for start in range(0, 0x20000, 128):
        text = "".join(chr(c) for c in range(start, start + 128) if not 0xD800 <= c < 0xE000) + " x"
        assert codec.encode(text) == plain(WORDS, text)
        assert encoder(BYTE_VOCABULARY).encode(text) == little_endian(plain(BYTES, text))


def test_cuts_are_forced():
    codec = bpe.codec(WORD_VOCABULARY)
    word = "xqzjvkçñß"
    parts = codec.cut(bpe.visible(word))
    assert len(parts) > 1
    assert [i for p in parts for i in codec.merge(p)] == plain(WORDS, word)


def test_ids_of_a_column_come_from_its_buffer():
    rows = [little_endian([1, 2]), b"", little_endian([3]), None, little_endian([70_000])]
    column = pa.array(rows, pa.binary())
    assert huffman.joined_ids(column).tolist() == [1, 2, 3, 70_000]
    assert huffman.joined_ids(column.slice(2, 3)).tolist() == [3, 70_000]
    assert huffman.joined_ids(pa.array([], pa.binary())).tolist() == huffman.joined_ids(pa.array([b""], pa.binary())).tolist() == []


def test_chunks_are_forgotten_and_found_again(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 20)
    texts = [f"word{i % 37}, (other{i % 11}) {'x' * 70}{i}!" for i in range(200)]
    for path, tokenizer in ((WORD_VOCABULARY, WORDS), (BYTE_VOCABULARY, BYTES)):
        small = tokens.ChunkEncoder(path)
        assert [small.encode(t) for t in texts] == [little_endian(plain(tokenizer, t)) for t in texts]


@pytest.mark.parametrize("path, tokenizer", [(BYTE_VOCABULARY, BYTES), (WORD_VOCABULARY, WORDS)])
def test_letters_and_marks_need_no_pattern(path, tokenizer):
    marked = ["word", "wörd,", "ab***", "ª?!", "x_", *(f"a{m}{m}" for m in tokens.MARKS)]
    # Here the pattern decides.
    other = ["it's", "its'", "a,b", "3.", "(a)", "a1", "1a", ",", "''s", "a'.s", "a.'s", "²a", "a²,", "\nab,"]
    made = tokens.ChunkEncoder(path)
    asked, pieces = [], made.pieces
    made.pieces = lambda text: asked.append(text) or pieces(text)
    for chunk in marked:
        assert made[chunk] == little_endian(plain(tokenizer, (made.space + chunk)))
    assert not asked
    for chunk in other:
        text = chunk if chunk[:1] == "\n" else made.space + chunk
        assert made[chunk] == little_endian(plain(tokenizer, text))
    assert len(asked) == len(other)


def test_long_fragments_merge_alike():
    codec = bpe.codec(WORD_VOCABULARY)
    for word in ("the" * 60, "abcabd" * 30, "aaaa" * 50):
        assert codec._merge_long(list(word)) == codec._merge_short(list(word))


def test_bpe_query_matches_the_library(llm, texts):
    rows = queries.op2_bpe(llm, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = plain(WORDS, texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = WORDS.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_on_odd_rows(odd, empty):
    found = sorted((r.doc_id or 0, tuple(r.ids)) for r in bpe.encode(odd).collect())
    assert found == sorted((r[0] or 0, tuple(plain(WORDS, r[1]))) for r in ODD_ROWS)
    assert {r.decoded for r in bpe.decode(bpe.encode(odd)).collect()} == {
        WORDS.decode(plain(WORDS, r[1]), skip_special_tokens=False) for r in ODD_ROWS
    }
    assert bpe.round_trip(empty).count() == 0


# ---- packing ---------------------------------------------------------------------


def best_fit(lengths, window):
    """Best-fit decreasing, one piece at a time: how full each window is."""
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits)[1]] -= length
        else:
            room.append(window - length)
    return sorted(room)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_plan_is_best_fit_decreasing(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    used, seen = {}, {n: set() for n in counts}
    for length, first, many, window, at in packing.best_fit_decreasing(counts, 32):
        for k in range(many):
            seen[length].add(first + k)
            used.setdefault(window + k, []).append((at, length))
    assert all(seen[n] == set(range(c)) for n, c in counts.items())
    rooms = []
    for pieces in used.values():
        end = 0
        for at, length in sorted(pieces):
            assert at == end
            end += length
        rooms.append(32 - end)
    assert sorted(rooms) == best_fit(lengths, 32)


def check_pieces(rows, expected, window=packing.WINDOW):
    """Every id in one piece, sequences gapless from 0; expected: the ids of each document, in any order."""
    sequences = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for pieces in sequences.values():
        end = 0
        for at, length in sorted(pieces):
            assert at == end
            end += length
        assert end <= window
    assert sum(r.length for r in rows) == sum(map(len, expected))
    starts = sorted((r.start, r.length) for r in rows)
    assert starts == sorted((a, min(window, len(ids) - a)) for ids in expected for a in range(0, len(ids), window))
    return sequences


def test_packing_query(llm, texts):
    rows = queries.op1_packing(llm, SMALL).collect()
    ids = {d: plain(BYTES, t) + [1] for d, t in texts.items()}
    sequences = check_pieces(rows, ids.values())
    for row in rows:
        part = ids[row.doc_id][row.start : row.start + row.length]
        assert row.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        assert row.doc_tokens == len(ids[row.doc_id])
    lengths = [r.length for r in rows]
    assert len(sequences) == len(best_fit(lengths, packing.WINDOW))


def test_packing_odd_rows(odd, empty):
    check_pieces(packing.pack(odd).collect(), [plain(BYTES, r[1]) + [1] for r in ODD_ROWS])
    assert packing.pack(empty).count() == 0


# ---- token files -------------------------------------------------------------------


def huffman_cost(counts):
    heap = list(counts)
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        total += a
        heapq.heappush(heap, a)
    return total


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 10_000), min_size=2, max_size=200))
def test_code_lengths_are_optimal(counts):
    counts = np.array(counts)
    free = huffman.code_lengths(counts, 40)
    assert (2.0**-free).sum() == 1 and (free * counts).sum() == huffman_cost(counts.tolist())
    limit = int(np.ceil(np.log2(len(counts)))) + 1
    tight = huffman.code_lengths(counts, limit)
    assert tight.max() <= limit and (2.0**-tight).sum() <= 1 and (tight * counts).sum() >= (free * counts).sum()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=40), min_size=1, max_size=10))
def test_bits_round_trip(docs):
    ids, sizes = np.array([i for d in docs for i in d], np.int64), np.array([len(d) for d in docs])
    seen, counts = np.unique(ids, return_counts=True)
    code = huffman.Code(seen, huffman.code_lengths(counts))
    payload, bounds, _ = huffman.pack(ids, sizes, *code.encoder())
    back = huffman.unpack(payload, 8 * bounds[:-1], sizes, code.table(), code.bits)
    assert back.tolist() == ids.tolist()


def test_token_file_query(llm, texts):
    rows, start = {r.doc_id: r for r in queries.op8_token_files(llm, SMALL).collect()}, 0
    for doc_id in sorted(texts):
        ids = plain(WORDS, texts[doc_id]) + [1]
        row = rows[doc_id]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_ids_are_coded_once(llm, odd, monkeypatch):
    # That shuffle samples its input, so what stands before it runs twice.
    ranged, kind = [], type(odd)
    real = kind.repartitionByRange
    monkeypatch.setattr(kind, "repartitionByRange", lambda df, *by: ranged.append(df) or real(df, *by))
    with scratch_scope(llm):
        ids = stage_packed(tokenize(odd, WORD_VOCABULARY, 1), "ids")
        huffman.write_ids(ids, scratch_path(llm, "files"))
        plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in ranged]
    assert len(plans) == 1 and "InArrow" not in plans[0]


def test_words_are_remembered_once():
    known = tokens.ChunkEncoder(WORD_VOCABULARY)
    want = little_endian(plain(WORDS, "harbour, harbour line; x9"))
    assert known.encode("harbour, harbour line; x9") == known.encode("harbour, harbour line; x9") == want
    assert {"harbour", "harbour,", "line", "line;", "x9"} == set(known)
    assert set(known.parts) == {",", ";", "x", "9"}


def test_counting_lets_go_of_the_encoders(llm, monkeypatch):
    runs, ids = [], llm.createDataFrame([(b"\1\0\0\0",)], "ids binary")
    real = type(ids).mapInArrow
    monkeypatch.setattr(type(ids), "mapInArrow", lambda df, run, schema: runs.append(run) or real(df, run, schema))
    huffman.count_ids(ids)
    tokens.encoder(WORD_VOCABULARY)
    assert [batch.to_pydict() for batch in runs[0](iter([]))] == [{"id": [], "n": []}]
    assert not tokens._encoders


def test_codes_are_written_without_rows_of_python(llm, monkeypatch):
    with scratch_scope(llm):
        ids = stage_packed(llm.createDataFrame([(1, b"\5\0\0\0\7\0\0\0\5\0\0\0")], "doc_id bigint, ids binary"), "ids")
        monkeypatch.setattr(type(llm.sparkContext), "parallelize", None)
        path = scratch_path(llm, "files")
        huffman.write_ids(ids, path)
        codes = llm.read.parquet(f"{path}/codes")
        assert codes.dtypes == [("id", "bigint"), ("length", "int")]
        assert sorted(map(tuple, codes.collect())) == [(5, 1), (7, 1)]
        assert [bytes(r.ids) for r in huffman.read_ids(llm, path).collect()] == [b"\5\0\0\0\7\0\0\0\5\0\0\0"]


def test_documents_are_coded_some_at_a_time(monkeypatch):
    monkeypatch.setattr(huffman, "PACK_IDS", 700)
    rng = np.random.default_rng(6)
    sizes = np.array([0, 3, 512, 1400, 699, 0, 1, 700, 2048, 5, 0])
    ids, packed, real = rng.integers(0, 300, sizes.sum()), [], huffman.pack
    table = huffman.Code(np.arange(300), huffman.code_lengths(rng.integers(1, 9, 300))).encoder()
    payload, bounds, starts = real(ids, sizes, *table)
    monkeypatch.setattr(huffman, "pack", lambda *given: packed.append(given[1].tolist()) or real(*given))
    marks, parts = huffman.pack_rows(ids, sizes, *table)
    assert sum(packed, []) == sizes.tolist() and all(sum(n[:-1]) <= 700 for n in packed)
    assert parts == [payload[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    first = np.cumsum(sizes) - sizes
    assert [np.frombuffer(m, "<u8").tolist() for m in marks] == [
        (starts[a : a + n : huffman.STRIDE] - 8 * b).tolist() for a, n, b in zip(first, sizes, bounds)
    ]
    assert huffman.pack_rows(ids[:0], sizes[:0], *table) == ([], [])


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_blocks_end_with_the_row_that_fills_them(llm, monkeypatch, kind):
    monkeypatch.setattr(huffman, "BLOCK_IDS", 700)
    rng = np.random.default_rng(5)
    sizes = [0, 3, 512, 1400, 699, 1, 700, 0, 0, 701, 513, 40, 2048]
    want = [(n, rng.integers(0, 300, size, dtype=np.uint32).astype("<u4").tobytes()) for n, size in enumerate(sizes, 10)]
    rows = llm.createDataFrame(want, "doc_id bigint, ids binary").withColumn("doc_id", F.col("doc_id").cast(kind)).coalesce(1)
    with scratch_scope(llm):
        path = scratch_path(llm, "files")
        huffman.write_ids(stage_packed(rows, "ids"), path)
        found = sorted(huffman.read_ids(llm, path).collect(), key=lambda r: (r.start, int(r.doc_id)))
        assert [(int(r.doc_id), bytes(r.ids)) for r in found] == want
        assert [r.n_ids for r in found] == sizes
        for block in llm.read.parquet(f"{path}/blocks").collect():
            assert sum(block.n_ids[:-1]) < 700


@pytest.mark.parametrize("block", [1 << 19, 700])
def test_token_files_of_odd_rows(llm, odd, empty, monkeypatch, block):
    monkeypatch.setattr(huffman, "BLOCK_IDS", block)
    with scratch_scope(llm):
        path = scratch_path(llm, "files")
        huffman.write_ids(stage_packed(tokenize(odd, WORD_VOCABULARY, 1), "ids"), path)
        rows = sorted(huffman.read_ids(llm, path).collect(), key=lambda r: r.start)
        want = [(r[0], little_endian(plain(WORDS, r[1]) + [1])) for r in ODD_ROWS]
        want.sort(key=lambda x: (x[0] is not None, x[0] or 0, zlib.crc32(x[1])))
        assert [(r.doc_id, bytes(r.ids)) for r in rows] == want
        assert [r.start for r in rows] == np.cumsum([0, *(len(x[1]) // 4 for x in want)])[:-1].tolist()
        none = scratch_path(llm, "files")
        huffman.write_ids(stage_packed(tokenize(empty, WORD_VOCABULARY, 1), "ids"), none)
        assert huffman.read_ids(llm, none).count() == 0
