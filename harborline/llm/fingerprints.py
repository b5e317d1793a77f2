"""Document fingerprints: a threshold-scaled sketch of word shingles, in built-in functions only.

A shingle is five words in a row (lower case; a shorter text is one shingle). Every shingle hash below a fixed fraction
of the hash range is kept, one in 4 whatever the length of the text. So sketches of texts of very unequal length can be
compared, and the union of two sketches is the sketch of the joined shingle sets.

`likeness` estimates the containment of the text with fewer kept hashes in the other one, 0 to 1: shared hashes by the
smaller sketch's size. Equal sketches have 1. A sketch without hashes, which a text of n shingles has with a chance of
0.75 to the power n, says nothing of its text: its likeness to another sketch is given as 0 and means unknown.

Defined results: a null text counts as empty; a text without words has an empty sketch ("2-"); equal texts have equal
fingerprints; repeated rows are separate rows; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from harborline.llm.common import SPACES, whole_text

SHINGLE = 5

# One hash in two to this number is kept; a fingerprint begins with it.
SHIFT = 2

# The largest value, of 63 bits, that a kept hash may have.
LIMIT = (1 << (63 - SHIFT)) - 1


def with_sketch(rows: DataFrame, text: str, into: str) -> DataFrame:
    """Adds the kept hashes of a text in ascending order."""
    words = f"{into}_words"
    w, n = F.col(words), F.size(F.col(words))
    cut = rows.withColumn(words, F.filter(F.split(F.lower(whole_text(text)), SPACES + "+", -1), lambda x: x != ""))
    shingles = F.when(
        n >= SHINGLE,
        F.transform(F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])),
    )
    shingles = shingles.when(n > 0, F.array(F.xxhash64(F.concat_ws(" ", w)))).otherwise(F.array().cast("array<bigint>"))
    # Hashes that are not kept go before the others are compared with each other.
    kept = F.filter(shingles, lambda h: F.shiftrightunsigned(h, 1) <= LIMIT)
    return cut.withColumn(into, F.array_sort(F.array_distinct(kept))).drop(words)


def fingerprint(sketch: Column) -> Column:
    """A sketch as a string: the shift, and the hashes in hexadecimal."""
    digits = F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0"))
    return F.concat(F.lit(f"{SHIFT}-"), F.concat_ws("", digits))


def common_size(a: Column, b: Column) -> tuple[Column, Column]:
    """Shared hashes, and the size of the smaller sketch."""
    return F.size(F.array_intersect(a, b)), F.least(F.size(a), F.size(b))


def likeness(a: Column, b: Column) -> Column:
    shared, least = common_size(a, b)
    return F.when(a == b, 1.0).when(least > 0, shared / least).otherwise(0.0)


def merge(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles taken together."""
    return F.array_sort(F.array_union(a, b))


def with_next(rows: DataFrame, doc_id: str, value: Column, into: str, chunks: int) -> DataFrame:
    """Adds a value of the next row in descending order of a numeric id; after the last row comes the first.

    The id range is cut at quantiles into chunks, a window runs inside each, and the first row of a chunk is also
    handed to the chunk before it. On the driver arrive the bounds and one id for each chunk.
    """
    spark = rows.sparkSession
    steps = [k / chunks for k in range(1, chunks)]
    found = rows.agg(F.percentile_approx(doc_id, steps or [0.5], 10000).alias("b")).first()["b"] or []
    bounds = sorted(set(found)) if chunks > 1 else []
    chunk = F.lit(0)
    if bounds:
        # Binary search; a null id is lowest of all.
        powers = [1 << k for k in reversed(range(len(bounds).bit_length()))]
        listed = F.array(*[F.lit(b) for b in bounds])

        def further(low: Column, step: Column) -> Column:
            there = F.get(listed, low + step - 1) < F.col(doc_id)
            return F.when(there, low + step).otherwise(low)

        chunk = F.aggregate(F.array(*[F.lit(p) for p in powers]), F.lit(0), further)
    keyed = rows.withColumn("_chunk", chunk).withColumn("_tie", F.xxhash64(whole_text()))
    firsts = keyed.groupBy("_chunk").agg(F.max(F.struct(doc_id, "_tie")).alias("m")).orderBy(F.desc("_chunk")).collect()
    if not firsts:
        return keyed.withColumn(into, value).drop("_chunk", "_tie")
    ends = [(a["_chunk"], *b["m"]) for a, b in zip(firsts, [*firsts[1:], firsts[0]])]
    kind = rows.schema[doc_id].dataType.simpleString()
    guests = spark.createDataFrame(ends, f"_host int, _id {kind}, _mark bigint")
    lent = keyed.join(F.broadcast(guests), F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_mark")))
    lent = lent.withColumn("_chunk", F.col("_host")).drop("_host", "_id", "_mark").dropDuplicates(["_chunk"])
    both = keyed.withColumn("_guest", F.lit(0)).unionByName(lent.withColumn("_guest", F.lit(1)))
    order = Window.partitionBy("_chunk").orderBy("_guest", F.col(doc_id).desc_nulls_last(), F.desc("_tie"))
    return both.withColumn(into, F.lead(value).over(order)).where("_guest = 0").drop("_chunk", "_tie", "_guest")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's sketch beside that of its edited text and of the next document.

    The edited text has its last third replaced by the beginning of the next document, as long where there is so much.
    """
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", whole_text().alias("text"))
    own = with_sketch(rows, "text", "sketch")
    # The next row's text is cut where it is used, so that one copy of each text is moved.
    paired = with_next(own, "doc_id", F.struct("text", "sketch"), "next", width)
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - third), F.substring(F.col("next.text"), F.lit(1), third)
    )
    changed = paired.select(
        "doc_id", F.length("text").alias("n_chars"), "sketch", F.col("next.sketch").alias("next_sketch"), edited.alias("edited")
    )
    return with_sketch(changed, "edited", "edited_sketch")
