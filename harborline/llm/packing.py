"""Packing documents into windows of a fixed number of tokens by best-fit decreasing.

A document longer than the window is first cut into full windows; what is left of it is one more piece. Best-fit
decreasing looks only at lengths, and there are at most `window` of them, so the plan is made from a histogram: for each
length, longest first, a segment tree over remaining capacities finds the tightest open window that still fits, and all
pieces of that length are placed in runs of equal windows. That is the placement that one piece at a time would give,
up to which of several equal pieces goes where. A piece's number among the pieces of its length then looks up its place.

Only the histogram (at most one row for each length) is collected. The plan has a row for each run of equal windows; a
length splits at most one run of each capacity, so its size is bounded by the window and not by the corpus, and it may
be broadcast. Pieces are numbered inside the tasks that cut them, and the numbers are shifted by counts for each task and
length, so a length that a third of all pieces have is never gathered in one place. The pieces are a written table:
a task run again cannot renumber them.

Defined results: a null text counts as empty and still has its end id; a document without ids has no piece; repeated
rows and equal doc_ids are separate documents; an empty table gives no pieces; other columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from harborline.llm.common import stage_packed, whole_text
from harborline.llm.tokens import BYTE_VOCABULARY, encoder, little_endian

WINDOW = 2048
END_ID = 1


def cut(docs: DataFrame, path: str = BYTE_VOCABULARY, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most a window: doc_id, start, length, doc_tokens, ids, and part and nth, which number them."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    tail = little_endian([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), [0] * (window + 1)
        for batch in batches:
            encode = encoder(path).encode
            rows, columns = [], [[] for _ in range(5)]
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text) + tail
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    values = (start, length, total, ids[4 * start : 4 * (start + length)], seen[length])
                    seen[length] += 1
                    rows.append(row)
                    for column, value in zip(columns, values):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64())
            made = [pa.array(c, t) for c, t in zip(columns, types)]
            doc_ids = batch.column(0).take(pa.array(rows, pa.int64()))
            parts = pa.array([part] * len(rows), pa.int32())
            names = ["doc_id", "start", "length", "doc_tokens", "ids", "nth", "part"]
            yield pa.RecordBatch.from_arrays([doc_ids, *made, parts], names)

    schema = f"doc_id {kind}, start bigint, length int, doc_tokens bigint, ids binary, nth bigint, part int"
    return stage_packed(docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, schema), "pieces")


class Capacities:
    """Segment tree over the capacities 0..most that says which of them have open windows."""

    def __init__(self, most: int):
        self.size = 1 << (most + 1).bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, capacity: int, is_open: bool) -> None:
        at = capacity + self.size
        self.open[at] = is_open
        while at := at // 2:
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest open capacity that is at least as large as asked."""
        at = least + self.size
        while not self.open[at]:
            while at & 1:
                at //= 2
            if at == 0:
                return None
            at += 1
        while at < self.size:
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.size


def best_fit_decreasing(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first number, pieces, first window, offset) that place all pieces of all lengths."""
    tree, runs, plan, windows = Capacities(window), defaultdict(list), [], 0
    for length in sorted(counts, reverse=True):
        done, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, many = window, -(-left // (window // length))
                first = windows
                windows += many
            else:
                first, many = runs[room].pop()
            deep = room // length
            full = min(many, left // deep)
            placed = [(first, full, deep)] if full else []
            if full < many and left > full * deep and left - full * deep < deep:
                placed.append((first + full, 1, left - full * deep))
            used = sum(n for _, n, _ in placed)
            if used < many:
                runs[room].append((first + used, many - used))
            for at, n, depth in placed:
                for level in range(depth):
                    plan.append((length, done, n, at, window - room + level * length))
                    done += n
                rest = room - depth * length
                runs[rest].append((at, n))
                tree.set(rest, True)
                left -= n * depth
            tree.set(room, bool(runs[room]))
    return plan


def place(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """The pieces with sequence_id and offset. `pieces` is what `cut` wrote, with any other columns."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("_n"))
    found = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = spark.createDataFrame(
        best_fit_decreasing(found, window), "_length int, _first bigint, _many bigint, _window bigint, _at bigint"
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col("part").alias("_part"), F.col("length").alias("_size"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    numbered = pieces.join(shifts, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_size")))
    number = F.col("nth") + F.col("_shift")
    run = (F.col("length") == F.col("_length")) & (number >= F.col("_first")) & (number < F.col("_first") + F.col("_many"))
    placed = numbered.join(F.broadcast(plan), run)
    kept = [c for c in pieces.columns if c not in ("part", "nth")]
    return placed.select(
        *kept, (F.col("_window") + number - F.col("_first")).alias("sequence_id"), F.col("_at").alias("offset")
    )


def pack(docs: DataFrame, path: str = BYTE_VOCABULARY, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Every piece with its ids, the sequence it is in and the offset there."""
    return place(cut(docs, path, window, end_id), window)
