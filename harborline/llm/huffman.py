"""Token ids in binary blocks under a canonical, length-limited Huffman code.

Writing: the ids of all documents are counted; the code lengths come from the counts by package-merge, none longer than
the limit; a code follows from its length and id alone, so the lengths are the whole code table. Each document's ids
become bits that start on a byte. Rows are then put in ascending doc_id order and packed into blocks. A block knows its
documents, their numbers of ids, how many ids its part has before it, where each document starts, and the bit offset of every `STRIDE`-th id (the checkpoints).

Reading: a table indexed by the next `limit` bits gives the id and the length of its code. Blocks are independent, and
within a block all stretches between checkpoints are decoded side by side.

On disk: `<path>/codes` (id, length: one row for each id that occurs) and `<path>/blocks` (part, block, before, doc_ids, n_ids,
bit_starts, checkpoints, payload), both Parquet, readable wherever Spark reads.

Defined results: a null text counts as empty and still has its end id; documents with equal doc_id stay separate, in
order of their ids' checksum; null doc_ids come first; an empty table gives files without rows; a vocabulary of one id
gets a code of one bit. Only the table of codes (at most one row for each id of the vocabulary) and one number for each
written part pass the driver. Blocks are cut by size, never by document, so a document of any length is in one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from harborline.llm.common import arrow_map, stage
from harborline.llm.tokens import forget

LIMIT = 18
STRIDE = 512
BLOCK_IDS = 1 << 19

# Ids that are coded at once, in whole documents: their arrays fit a core's cache.
PACK_IDS = 1 << 16

BLOCKS = (
    "part int, block int, before bigint, doc_ids array<{kind}>, n_ids array<bigint>, bit_starts array<bigint>, "
    "checkpoints binary, payload binary"
)


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code with no code over the limit, for positive counts in any order."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids need codes of more than {limit} bits")
    order = np.argsort(counts, kind="stable")
    weights = np.asarray(counts, np.float64)[order]
    is_symbol, level = [], weights
    flags = np.ones(n, bool)
    for _ in range(limit - 1):
        is_symbol.append(flags)
        packed = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, packed])
        place = np.argsort(both, kind="stable")
        level, flags = both[place], place < n
    is_symbol.append(flags)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(is_symbol):
        symbols = int(flags[:take].sum())
        lengths[:symbols] += 1
        take = 2 * (take - symbols)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


def canonical_codes(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes, code, last = np.zeros(len(ids), np.int64), 0, 0
    for at in np.lexsort((ids, lengths)):
        code <<= int(lengths[at]) - last
        last = int(lengths[at])
        codes[at] = code
        code += 1
    return codes


class Code:
    """A code table ready for use."""

    def __init__(self, ids, lengths):
        self.ids, self.lengths = np.asarray(ids, np.int64), np.asarray(lengths, np.int64)
        self.codes = canonical_codes(self.ids, self.lengths)
        self.bits = int(self.lengths.max(initial=1))

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        size = int(self.ids.max(initial=0)) + 1
        code, length = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        code[self.ids], length[self.ids] = self.codes, self.lengths
        return code, length

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and code length for every value of the next `bits` bits."""
        ids, lengths = np.zeros(1 << self.bits, np.uint32), np.zeros(1 << self.bits, np.uint8)
        order = np.argsort(self.codes << (self.bits - self.lengths))
        spans = np.left_shift(1, self.bits - self.lengths[order])
        used = int(spans.sum())
        ids[:used], lengths[:used] = np.repeat(self.ids[order], spans), np.repeat(self.lengths[order], spans)
        return ids, lengths


def pack(ids: np.ndarray, sizes: np.ndarray, code: np.ndarray, length: np.ndarray):
    """Bits of several documents in one go: payload bytes, byte bounds of documents, bit offset of each id."""
    bits = length[ids]
    ends = np.cumsum(bits)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    total = np.concatenate([[0], ends])
    doc_bits = total[bounds[1:]] - total[bounds[:-1]]
    doc_bytes = (doc_bits + 7) // 8
    byte_bounds = np.concatenate([[0], np.cumsum(doc_bytes)])
    starts = ends - bits + np.repeat(8 * byte_bounds[:-1] - total[bounds[:-1]], sizes)
    words = np.zeros(int(byte_bounds[-1]) // 4 + 2, np.uint64)
    if len(ids):
        word, shift = starts >> 5, (64 - (starts & 31) - bits).astype(np.uint64)
        value = code[ids] << shift
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        at = word[first]
        words[at] += np.add.reduceat(value >> np.uint64(32), first)
        words[at + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    return words.astype(">u4").tobytes()[: int(byte_bounds[-1])], byte_bounds, starts


def unpack(payload: bytes, starts: np.ndarray, sizes: np.ndarray, table: tuple[np.ndarray, np.ndarray], bits: int):
    """Ids of many stretches decoded side by side; a stretch is given by its bit offset and its number of ids."""
    ids, lengths = table
    words = np.frombuffer(payload + b"\0" * (12 - len(payload) % 4), ">u4").astype(np.uint64)
    out = np.empty(int(sizes.sum()), np.uint32)
    order = np.argsort(-sizes, kind="stable")
    at, left = starts[order].copy(), sizes[order]
    put = (np.cumsum(sizes) - sizes)[order]
    live = np.searchsorted(-left, -np.arange(1, int(left.max(initial=0)) + 1), side="right")
    mask, back = np.uint64((1 << bits) - 1), np.uint64(64 - bits)
    for step, n in enumerate(live):
        here = at[:n]
        word = here >> 5
        window = (words[word] << np.uint64(32)) | words[word + 1]
        key = (window >> (back - (here & 31).astype(np.uint64))) & mask
        out[put[:n] + step] = ids[key]
        here += lengths[key]
    return out


def pack_rows(ids: np.ndarray, sizes: np.ndarray, code: np.ndarray, length: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Checkpoints and bits of each document, some documents at a time."""
    marks, parts = [], []
    ends = np.cumsum(sizes)
    firsts = np.flatnonzero(np.diff((ends - sizes) // PACK_IDS, prepend=-1)).tolist()
    for first, last in zip(firsts, [*firsts[1:], len(sizes)]):
        n, begin = sizes[first:last], int(ends[first] - sizes[first])
        payload, bounds, starts = pack(ids[begin : int(ends[last - 1])], n, code, length)
        places = zip((np.cumsum(n) - n).tolist(), n.tolist(), bounds[:-1].tolist(), bounds[1:].tolist())
        for at, size, a, b in places:
            marks.append((starts[at : at + size : STRIDE] - 8 * a).astype("<u8").tobytes())
            parts.append(payload[a:b])
    return marks, parts


def joined_ids(column: pa.BinaryArray) -> np.ndarray:
    """The ids of all rows of a binary column one after the other, straight from its buffer; a null row has none."""
    _, offsets, values = column.buffers()
    if values is None or not len(column):
        return np.zeros(0, "<u4")
    bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(values, np.uint8)[bounds[0] : bounds[-1]].view("<u4")


def count_ids(tokens: DataFrame) -> DataFrame:
    """How often each id occurs; summed up in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The ids are there: what a worker remembers from making them would stay in memory through all that follows.
        forget()
        seen = np.zeros(0, np.int64)
        for batch in batches:
            ids = joined_ids(batch.column(0))
            if len(ids):
                new = np.bincount(ids, minlength=len(seen))
                new[: len(seen)] += seen
                seen = new
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(seen[found])], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def build_code(tokens: DataFrame, limit: int = LIMIT) -> Code:
    """The code of a table of ids. On the driver arrive the ids that occur, each once: a vocabulary at most."""
    found = count_ids(tokens).toPandas().sort_values("id")
    return Code(found["id"].to_numpy(), code_lengths(found["n"].to_numpy(), max(limit, len(found).bit_length())))


def write_ids(tokens: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Write doc_id, ids (binary, little-endian unsigned 32-bit) as coded blocks in ascending doc_id order.

    `tokens` is read twice, so it should be a written table.
    """
    spark, made = tokens.sparkSession, build_code(tokens, limit)
    # From Arrow: plain rows would start a second set of Python workers in the executors, which then stay.
    table = pa.table({"id": made.ids, "length": made.lengths.astype(np.int32)})
    spark.createDataFrame(table, "id bigint, length int").coalesce(1).write.parquet(f"{path}/codes")
    code, length = made.encoder()
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def coded(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = pc.binary_length(batch.column(1)).to_numpy().astype(np.int64) // 4
        marks, parts = pack_rows(joined_ids(batch.column(1)), sizes, code, length)
        columns = [batch.column(0), batch.column(2), pa.array(sizes), pa.array(marks, pa.binary()), pa.array(parts, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "tie", "n", "marks", "bits"])

    schema = f"doc_id {kind}, tie bigint, n bigint, marks binary, bits binary"
    # Written, as the range shuffle runs what stands before it twice, first to sample.
    each = stage(arrow_map(tokens.select("doc_id", "ids", F.crc32("ids").alias("tie")), coded, schema), "coded")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = each.repartitionByRange(width, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before, held, size = TaskContext.get().partitionId(), 0, 0, [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                held.append(row)
                size += row[1]
                if size >= BLOCK_IDS:
                    yield block((part, number, before), held, batch.schema.field(0).type)
                    number, before, held, size = number + 1, before + size, [], 0
        if held:
            yield block((part, number, before), held, batch.schema.field(0).type)

    def block(place: tuple, rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        doc_ids, n, marks, bits = zip(*rows)
        byte_starts = np.cumsum([0, *map(len, bits)])[:-1]
        shifted = b"".join(
            (np.frombuffer(m, "<u8") + np.uint64(8 * b)).astype("<u8").tobytes() for m, b in zip(marks, byte_starts.tolist())
        )
        values = (*place, list(doc_ids), list(n), (8 * byte_starts).tolist(), shifted, b"".join(bits))
        types = (pa.int32(), pa.int32(), pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())
        names = ["part", "block", "before", "doc_ids", "n_ids", "bit_starts", "checkpoints", "payload"]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    ordered.mapInArrow(blocks, BLOCKS.format(kind=kind)).write.parquet(f"{path}/blocks")


def read_code(spark: SparkSession, path: str) -> Code:
    found = spark.read.parquet(f"{path}/codes").toPandas().sort_values("id")
    return Code(found["id"].to_numpy(), found["length"].to_numpy())


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_ids and ids of each document in the files."""
    code = read_code(spark, path)
    bits = code.bits
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    inside = F.aggregate("n_ids", F.lit(0).cast("bigint"), lambda total, n: total + n)
    totals = blocks.groupBy("part").agg(F.max(F.col("before") + inside).alias("n")).orderBy("part").collect()
    first = dict(zip((row["part"] for row in totals), np.cumsum([0, *(row["n"] for row in totals)]).tolist()))
    lookup: list = []

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not lookup:
                lookup.append(code.table())
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                n = np.array(row["n_ids"], np.int64)
                pieces = -(-n // STRIDE)
                stretch = np.full(int(pieces.sum()), STRIDE, np.int64)
                stretch[np.cumsum(pieces)[n > 0] - 1] = (n - STRIDE * (pieces - 1))[n > 0]
                marks = np.frombuffer(row["checkpoints"], "<u8").astype(np.int64)
                ids = unpack(row["payload"], marks, stretch, lookup[0], bits)
                ends = np.cumsum(n)
                each = [ids[a:b].astype("<u4").tobytes() for a, b in zip((ends - n).tolist(), ends.tolist())]
                columns = [pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type)]
                columns += [pa.array(first[row["part"]] + row["before"] + ends - n), pa.array(n), pa.array(each, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_ids", "ids"])

    return blocks.mapInArrow(decoded, f"doc_id {kind}, start bigint, n_ids bigint, ids binary")
