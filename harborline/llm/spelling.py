"""Spelling variants: words of a corpus that differ by one character, and the common form of each.

Two words are near if one inserted, deleted or replaced character turns one into the other. Near words are found by
dynamic programming over sorted lists: a word is matched against a sorted list while the rows of its edit matrix, banded
to one edit and so of three cells, are kept for the prefixes of the list's current word. The next word reuses the rows up
to the prefix it shares with the last one (their LCP); a range of words whose shared prefix is already more than one edit
away is skipped.

Two near words share all but one character, so they share at least half of it in front of the edit or behind it. The
vocabulary is therefore dealt into cells: words of m or m + 1 characters with the same first half, and, turned around,
with the same last half. Each near pair meets in such a cell, and each list is one cell. A cell of more than CELL words is
dealt again by half of what is left in front and half of what is left behind, until it is small or all but the edited
character is fixed; then it holds at most the words that an alphabet can put in the gap. So no list grows with the
vocabulary, and no pair is lost.

Defined results: null texts have no words; a null doc_id counts as the empty string; repeated rows count as often as they
occur; ties of the most frequent near word go to the first in code-point order; an empty table gives an empty one; extra
columns are not looked at. Words of any length are kept whole. Counts are summed in each task before the shuffle and
everything later is a join or a grouping by word or cell; a lost task is run again from written tables.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from harborline.llm.common import stage, whole_text

LETTERS = r"A-Za-zÀ-ÿ"
MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5

# Words of one cell that are matched against each other in one task; more are dealt again.
CELL = 192

# Distinct words a counting task remembers before it passes them on; bounds memory, not the result.
HELD_WORDS = 200_000

# Rows of the edit matrix hold three cells: edits between a prefix of length d of a listed word and the prefixes of
# length d - 1, d and d + 1 of the matched word. More than one edit counts as two.
OVER = 2


def damaged(name: bytes, word: str, every: int = 199) -> str:
    """The word with one character left out, for one in `every` pairs of a document's name and a word."""
    check = zlib.crc32(word.encode(), zlib.crc32(name + b":"))
    if check % every:
        return word
    at = check % len(word)
    return word[:at] + word[at + 1 :]


def count_words(docs: DataFrame, change: Callable[[bytes, str], str] | None = None, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n (occurrences in all texts) of every word of at least MIN_CHARS characters and `min_count` occurrences.

    A word is a maximal run of letters, A-Z lower-cased. `change` replaces the words of a document, given its doc_id.
    """
    long_runs = re.compile(rf"[{LETTERS}]{{{MIN_CHARS},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # Lower-casing bytes leaves all but A-Z alone.
                found = long_runs(text.lower().decode())
                if change is None:
                    held.update(found)
                    continue
                for word, n in Counter(found).items():
                    word = change(name, word)
                    if len(word) >= MIN_CHARS:
                        held[word] += n
            if len(held) > HELD_WORDS:
                yield counted()
                held.clear()
        if held:
            yield counted()

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    source = docs.select(name.alias("name"), whole_text().cast("binary").alias("text"))
    counts = source.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def _half(left) -> F.Column:
    """Half, rounded up, of the characters that are surely the same on either side."""
    return F.floor((left + 1) / 2).cast("int")


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of a cell (m, and how many characters are the same in front and behind) in the two cells of the next deal.

    Near words of m and m or m + 1 characters share at least m - 1 in all.
    """
    more = _half(F.col("m") - 1 - F.col("front") - F.col("behind"))
    return rows.select(
        "word", "n", "m",
        F.inline(F.array(
            F.struct((F.col("front") + more).alias("front"), F.col("behind")),
            F.struct(F.col("front"), (F.col("behind") + more).alias("behind")),
        )),
    )


def _cell() -> list:
    word = F.col("word")
    first = F.substring(word, F.lit(1), F.col("front"))
    last = F.when(F.col("behind") > 0, F.substring(word, -F.col("behind"), F.col("behind"))).otherwise("")
    return [F.col("m"), F.col("front"), F.col("behind"), first.alias("first"), last.alias("last")]


def cells(vocabulary: DataFrame, limit: int = CELL) -> DataFrame:
    """Every word in the cells it may meet near words in, none of more than `limit` words unless it cannot be divided.

    word, n, the cell (m, front, behind, first, last). A word stands in cells of m = its length and, as the longer one of a
    pair, of m = its length - 1. A round of dealing goes on with the large cells only; there are at most as many rounds as
    halvings of the longest word.
    """
    size = F.length("word")
    rows = vocabulary.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).select(
        "*", F.lit(0).alias("front"), F.lit(0).alias("behind")
    )
    key, done = ["m", "front", "behind", "first", "last"], None
    while True:
        rows = stage(_dealt(rows).select("word", "n", *_cell()), "cells")
        left = F.col("m") - 1 - F.col("front") - F.col("behind")
        large = rows.groupBy(*key).agg(F.count("*").alias("words")).where((F.col("words") > limit) & (left > 0)).drop("words")
        large = stage(large, "large-cells")
        none = large.isEmpty()
        settled = rows if none else rows.join(large, key, "left_anti").select(*rows.columns)
        done = settled if done is None else done.union(settled)
        if none:
            return done
        rows = rows.join(large, key, "left_semi").select("word", "n", "m", "front", "behind")


def next_row(row: tuple[int, int, int], char: str, word: str, depth: int) -> tuple[int, int, int]:
    """The row of the edit matrix for a prefix longer by `char`, which makes its length `depth`."""
    below, same, above = row
    size = len(word)
    # The cell below compares with word[depth - 2], the one at the same length with word[depth - 1], the one above with word[depth].
    a = min(below + (not 1 < depth <= size + 1 or word[depth - 2] != char), same + 1) if depth - 1 <= size else OVER
    b = min(same + (depth > size or word[depth - 1] != char), above + 1, a + 1) if depth <= size else OVER
    c = min(above + (depth >= size or word[depth] != char), b + 1) if depth + 1 <= size else OVER
    return (a if a < OVER else OVER, b if b < OVER else OVER, c if c < OVER else OVER)


def scan(word: str, listed: list[str], shared: list[int], begin: int, same: int) -> Iterator[int]:
    """Numbers, from `begin` on, of the words of a sorted list that are one edit from a word.

    `shared` are the LCPs of neighbours in the list (of each word with the one before it); all of its words and the
    matched one have their first `same` characters in common.
    """
    size = len(word)
    rows = [(OVER, OVER, OVER)] * (size + 3)
    rows[same] = (1 if same else OVER, 0, 1 if same < size else OVER)
    known, at, end = same, begin, len(listed)
    while at < end:
        other = listed[at]
        if at > begin and shared[at] < known:
            known = max(shared[at], same)
        depth, row, length = known, rows[known], len(other)
        while depth < length:
            row = next_row(row, other[depth], word, depth + 1)
            depth += 1
            if row == (OVER, OVER, OVER) or depth > size + 1:
                break
            rows[depth] = row
            known = depth
        else:
            if -1 <= size - length <= 1 and row[size - length + 1] == 1:
                yield at
            at += 1
            continue
        # The prefix of this length is over one edit away, and so is every word that has it.
        at += 1
        while at < end and shared[at] >= depth:
            at += 1


def _common(a: str, b: str) -> int:
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return min(len(a), len(b))


def near_in_cell(words: list[str], m: int, same: int) -> Iterator[tuple[int, int]]:
    """Pairs of numbers of near words in a sorted cell, at least one of them of m characters, each pair once."""
    for longer in (False, True):
        numbers = [i for i, word in enumerate(words) if (len(word) > m) == longer]
        listed = [words[i] for i in numbers]
        shared = [0, *(_common(a, b) for a, b in zip(listed, listed[1:]))]
        place = 0
        for i, word in enumerate(words):
            if len(word) == m and listed:
                place += not longer
                for at in scan(word, listed, shared, 0 if longer else place, same):
                    yield i, numbers[at]


def near_words(vocabulary: DataFrame, limit: int = CELL) -> DataFrame:
    """word, n, near, near_n: both directions of every pair of near words of a table of words and their counts."""
    turned = F.col("behind") > F.col("front")
    key = F.concat_ws(" ", "m", "front", "behind", "first", "last")
    dealt = cells(vocabulary, limit).select(
        key.alias("cell"), F.when(turned, F.reverse("word")).otherwise(F.col("word")).alias("form"), "n", "m",
        F.greatest("front", "behind").alias("same"), turned.alias("turned"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(held: list[tuple]) -> Iterator[tuple]:
            _, _, _, m, same, turned = held[0]
            if len(held) > 1:
                words = [row[1] for row in held]
                shown = [word[::-1] for word in words] if turned else words
                for i, j in near_in_cell(words, m, same):
                    yield shown[i], held[i][2], shown[j], held[j][2]
                    yield shown[j], held[j][2], shown[i], held[i][2]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            types = (pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays(columns, ["word", "n", "near", "near_n"])

        held, out = [], []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and held[0][0] != row[0]:
                    out += pairs(held)
                    held = []
                held.append(row)
            if len(out) > 10_000:
                yield made(out)
                out = []
        if held:
            out += pairs(held)
        if out:
            yield made(out)

    # A near pair may meet in several cells.
    together = dealt.repartition("cell").sortWithinPartitions("cell", "form")
    return together.mapInArrow(run, "word string, n bigint, near string, near_n bigint").distinct()


def variants(vocabulary: DataFrame, ratio: int = RATIO, limit: int = CELL) -> DataFrame:
    """Each word with its form, the root that forms lead to, n, n_near and the form's n.

    A word's form is its near word of largest n (ties: the first in code-point order) if that is at least `ratio` times
    the word's own. Forms are followed by doubling; n grows by the ratio at each step, so the largest n bounds the rounds.
    """
    vocabulary = stage(vocabulary, "vocabulary")
    # The smallest of (-n, near) is the largest n and, among equals, the first word.
    best = near_words(vocabulary, limit).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    found = vocabulary.join(best, "word", "left")
    counts = -F.col("best.less") >= ratio * F.col("n")
    found = stage(found.select(
        "word", F.when(counts, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(counts, -F.col("best.less")).alias("form_n"),
    ), "forms")
    return found.join(_roots(found, ratio), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(found: DataFrame, ratio: int) -> DataFrame:
    """word and root of every word that has a form."""
    links = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    low, high = found.agg(F.min("n"), F.max("n")).first()
    longest = math.log(high / low, ratio) if high else 0
    for _ in range(math.ceil(math.log2(longest + 1)) if longest >= 1 else 0):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = stage(links.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return links
