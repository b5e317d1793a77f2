"""Near-duplicates by Order MinHash, verified by banded alignment.

The k-mers of a text are its runs of three words, labelled with how often they occurred before. For each of `SKETCHES`
hash functions the two smallest labelled k-mers are taken and kept in the order in which they stand in the text; that
pair is one sketch. Texts that agree in a sketch share both the k-mers and their order, which is what edit similarity
asks for. Texts that share at least one sketch are candidates; a candidate pair is a link if a banded alignment of
the two word sequences aligns at least `SIMILAR` of the words of the longer one. Classes are the components of links.

Equal texts are one node from the start, so copies are never paired with each other. In a bucket (the texts of one
sketch) every text is compared with the bucket's first one, its smallest node; buckets of up to `SMALL` texts are
compared throughout, and in larger ones every text is compared with the one that meets most others in large buckets, as
the original of a group of copies does. What is left are large buckets with texts of several components: there all pairs
of different components are compared, block against block of about `MANY` texts, each two blocks in a task of their own,
which holds their words and gives back links only. Counts of words by their hash bound from above how many words can
align; pairs that pass that bound are aligned, each in one of the buckets they share. What a task has found alike is one
component to it from then on, so near copies of one lost original take about one alignment each. So two
texts that share a sketch end in different classes only if their alignment was found too short. Groups of copies of one
original are one component before that step; the work on a crowd of texts that are not alike grows with its square.

Defined results: a null text counts as empty, and texts without words that are equal are one class; a text of fewer than
three words is one k-mer; equal texts are in one class; rows with equal doc_id and equal text are copies; the class id is
the smallest doc_id in the class; an empty table gives an empty result; other columns are carried by `one_of_each`
and not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from harborline.llm.common import arrow_map, holding, stage, whole_text
from harborline.llm.components import connected

WORDS = 5
# Sketches are of shorter runs, so that texts of which a fifth of the words differ still meet.
MEETING = 3
SKETCHES = 40
PICKED = 2
SIMILAR = 0.8
SMALL = 8
MANY = 1024
# Words are counted in so many groups by their hash, each up to the greatest 16-bit number.
COUNTS = 128
MOST = (1 << 16) - 1

# Up to so many k-mers all hash functions are worked off at once.
AT_ONCE = 1 << 16

_seeds = np.random.default_rng(5).integers(1, 1 << 63, (SKETCHES, 2), dtype=np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(text: str) -> np.ndarray:
    words = text.lower().encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def labelled_kmers(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Hash of every run of `size` words with the number of equal runs before it, in text order."""
    n = len(words) - size + 1
    if len(words) == 0:
        return words
    if n < 1:
        words, n = np.concatenate([words, np.zeros(size - len(words), np.uint64)]), 1
    found = words[:n].copy()
    for k in range(1, size):
        found = _mix(found * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    order = np.argsort(found, kind="stable")
    ordered = found[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    if not first.all():
        at = np.arange(n)
        times = np.empty(n, np.uint64)
        times[order] = at - np.maximum.accumulate(np.where(first, at, 0))
        found = _mix(found + times * np.uint64(0xD6E8FEB86659FD93))
    return found


def sketches(words: np.ndarray) -> np.ndarray:
    """One 64-bit key for each hash function: its smallest labelled k-mers, in text order."""
    kmers = labelled_kmers(words, MEETING)
    n = len(kmers)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n <= PICKED:
        places = np.broadcast_to(np.arange(n), (SKETCHES, n))
    elif n <= AT_ONCE:
        values = _mix((kmers[None, :] ^ _seeds[:, :1]) * _seeds[:, 1:])
        places = np.sort(np.argpartition(values, PICKED - 1, axis=1)[:, :PICKED], axis=1)
    else:
        places = np.stack([np.sort(np.argpartition(_mix((kmers ^ a) * b), PICKED - 1)[:PICKED]) for a, b in _seeds])
    keys = np.arange(1, SKETCHES + 1, dtype=np.uint64)
    for k in range(places.shape[1]):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + kmers[places[:, k]])
    return keys


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Words in the longest alignment of equal words in order that strays at most `band` places from the diagonal.

    Bits of one integer stand for the places of `a` near the current word of `b`; a zero bit is one more word aligned
    up to there. Places that fall out of the band are counted and dropped.
    """
    n = min(len(a), len(b))
    head = int((a[:n] == b[:n]).argmin()) if n and not (a[:n] == b[:n]).all() else n
    a, b = a[head:], b[head:]
    n -= head
    tail = 0
    if n:
        same = a[len(a) - n :] == b[len(b) - n :]
        tail = n if same.all() else int(same[::-1].argmin())
        a, b = a[: len(a) - tail], b[: len(b) - tail]
    total = head + tail
    if not len(a) or not len(b):
        return total
    where: dict[int, int] = {}
    for at, word in enumerate(a.tolist()):
        where[word] = where.get(word, 0) | (1 << at)
    low, width = 0, 2 * band + 1
    window, ones = (1 << width) - 1, (1 << width) - 1
    for j, word in enumerate(b.tolist()):
        start = j - band
        if start > low:
            total += not window & 1
            window = (window >> 1) | (1 << (width - 1))
            low = start
        hits = where.get(word, 0)
        if hits:
            hits = (hits >> low) & ((1 << (j + band + 1 - low)) - 1)
            u = window & hits
            window = ((window + u) | (window - u)) & ones
    return total + (~window & ((1 << max(0, len(a) - low)) - 1) & ones).bit_count()


def alike(a: np.ndarray, b: np.ndarray, similar: float = SIMILAR) -> bool:
    """Whether the aligned words are at least the given share of the longer text."""
    most = max(len(a), len(b))
    if min(len(a), len(b)) < similar * most:
        return False
    return aligned(a, b, int((1 - similar) * most + 1e-9)) >= similar * most


def _key() -> list[Column]:
    """Two hashes that stand for a text."""
    return [F.xxhash64(whole_text()).alias("h1"), F.xxhash64(F.lit(1), whole_text()).alias("h2")]


def _sketched(docs: DataFrame) -> DataFrame:
    """row, doc_id, h1, h2, n_words and keys of every document, written."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = [word_hashes(t) for t in batch.column(3).to_pylist()]
        keys = pa.array([sketches(w).view(np.int64) for w in words], pa.list_(pa.int64()))
        columns = [*batch.columns[:3], pa.array([len(w) for w in words], pa.int64()), keys]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "h1", "h2", "n_words", "keys"])

    made = arrow_map(
        docs.select("doc_id", *_key(), whole_text().alias("text")), run,
        f"doc_id {kind}, h1 bigint, h2 bigint, n_words bigint, keys array<bigint>",
    )
    return stage(made.withColumn("row", F.monotonically_increasing_id()), "sketches")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are alike. `texts` has node and words (packed hashes)."""
    left = texts.select(F.col("node").alias("a"), F.col("words").alias("wa"))
    right = texts.select(F.col("node").alias("b"), F.col("words").alias("wb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "wa", "wb")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sides = ([np.frombuffer(x, "<u4") for x in batch.column(at).to_pylist()] for at in (2, 3))
        return batch.select([0, 1]).filter(pa.array([alike(x, y) for x, y in zip(*sides)], pa.bool_()))

    return arrow_map(both, run, "a bigint, b bigint")


def _fits(n: Column, m: Column) -> Column:
    """Whether two lengths allow enough aligned words."""
    return F.least(n, m) >= F.lit(SIMILAR) * F.greatest(n, m)


def _pairs(left: DataFrame, right: DataFrame, on: str, differ: str) -> DataFrame:
    """Pairs of nodes with equal `on`, different `differ`, and lengths that fit. Buckets here are small."""
    l, r = left.alias("l"), right.alias("r")
    unlike = (F.col(f"l.{differ}") != F.col(f"r.{differ}")) & (F.col("l.node") < F.col("r.node"))
    joined = l.join(r, (F.col(f"l.{on}") == F.col(f"r.{on}")) & unlike & _fits(F.col("l.n_words"), F.col("r.n_words")))
    return joined.select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))


def _named(rows: DataFrame, *more: str) -> DataFrame:
    """doc_id, h1 and h2 under names that meet no column of a table of documents."""
    return rows.select(
        F.col("doc_id").alias("_harborline_id"), F.col("h1").alias("_harborline_h1"), F.col("h2").alias("_harborline_h2"), *more
    )


def _same(h1: Column, h2: Column) -> Column:
    return (h1 == F.col("_harborline_h1")) & (h2 == F.col("_harborline_h2")) & F.col("doc_id").eqNullSafe(F.col("_harborline_id"))


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and words (packed 32-bit hashes) of the wanted nodes, written."""
    ids = _named(nodes.join(wanted, "node", "left_semi"), "node")
    same = _same(F.col("h1"), F.col("h2"))
    found = docs.select("doc_id", *_key(), whole_text().alias("text")).join(ids, same).select("node", "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = [(word_hashes(t) & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["node", "words"])

    # Rows that repeat id and text come here several times.
    return stage(arrow_map(found, run, "node bigint, words binary").dropDuplicates(["node"]), "words")


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sketched rows, and node with root for nodes in components of several; nodes are rows of distinct texts."""
    rows = _sketched(docs)
    with holding() as hold:
        roots = _roots(docs, rows, hold)
    return rows, roots.join(rows.withColumnRenamed("row", "node"), "node").select("h1", "h2", "root")


def _roots(docs: DataFrame, rows: DataFrame, hold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """node and root, from written tables only."""
    first = rows.groupBy("h1", "h2").agg(F.min_by("row", F.struct("doc_id", "row")).alias("node"))
    one = first.select(F.col("node").alias("row"), "node")
    nodes = hold(rows.join(one, "row").select("node", "doc_id", "h1", "h2", "n_words", "keys"))

    exploded = nodes.select("node", "n_words", F.explode("keys").alias("key"))
    first = F.min(F.struct("node", "n_words")).alias("first")
    shared = exploded.groupBy("key").agg(F.count("*").alias("size"), first).where("size > 1")
    # Written, as what is held keeps the shuffles it was made from: here all sketches, for the words all texts.
    members = stage(exploded.join(shared, "key"), "members")
    few = members.where(F.col("size").between(3, SMALL)).select("key", "node", "n_words")
    starred = members.where((F.col("node") != F.col("first.node")) & _fits(F.col("n_words"), F.col("first.n_words")))
    stars = starred.select(F.col("first.node").alias("a"), F.col("node").alias("b"))
    pairs = stars.union(_spokes(members)).union(_pairs(few, few, "key", "node")).distinct()
    texts = _texts(docs, nodes, members.select("node").distinct())
    roots = connected(_verified(pairs, texts), "a", "b")
    crowded = hold(_open_buckets(members, roots))
    if crowded.isEmpty():
        return roots
    # The links found now are between components, so only these are joined further.
    links = _crowd_links(crowded, texts)
    for end in ("a", "b"):
        links = links.join(roots.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
    further = connected(links, "a", "b").select(F.col("node").alias("root"), F.col("root").alias("further"))
    onward = roots.join(further, "root", "left").select("node", F.coalesce("further", "root").alias("root"))
    return onward.union(further.select(F.col("root").alias("node"), F.col("further").alias("root")))


def _spokes(members: DataFrame) -> DataFrame:
    """Pairs of the texts of large buckets with the one that meets most others in such buckets."""
    crowd = members.where(F.col("size") > SMALL).select("key", "node", "n_words", "size")
    # A node is in at most as many buckets as there are sketches, so no window is larger than that.
    known = F.sum("size").over(Window.partitionBy("node"))
    hub = F.max(F.struct("known", "node", "n_words")).alias("hub")
    hubs = crowd.withColumn("known", known).groupBy("key").agg(hub)
    spokes = crowd.join(hubs, "key").where((F.col("node") != F.col("hub.node")) & _fits(F.col("n_words"), F.col("hub.n_words")))
    return spokes.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"))


def _open_buckets(members: DataFrame, roots: DataFrame) -> DataFrame:
    """key, node, n_words, label and n (texts) of the large buckets whose texts are of several components."""
    placed = members.where(F.col("size") > SMALL).select("key", "node", "n_words").join(roots, "node", "left")
    placed = placed.select("key", "node", "n_words", F.coalesce("root", "node").alias("label"))
    several = placed.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("n"))
    return placed.join(several.where("x < y").select("key", "n"), "key")


def _counts(words: list[np.ndarray]) -> np.ndarray:
    """How many words of each text fall into each group of words."""
    found = [np.minimum(np.bincount(w % COUNTS, minlength=COUNTS), MOST) for w in words]
    return np.array(found, np.uint16).reshape(-1, COUNTS)


def _compared(table: pa.Table) -> pa.Table:
    """Links between the texts of two blocks, or of one with itself: enough of them that what is alike is connected."""
    node, label, n, block, i, j = (table.column(c).to_numpy() for c in ("node", "label", "n_words", "block", "i", "j"))
    words = [np.frombuffer(w, "<u4") for w in table.column("words").to_pylist()]
    buckets = [set(keys) for keys in table.column("keys").to_pylist()]
    here, counts, label = table.column("key")[0].as_py(), _counts(words), label.copy()
    left, links = np.flatnonzero(block == i), []
    right = left if i[0] == j[0] else np.flatnonzero(block == j)
    for x in left:
        most = np.maximum(n[right], n[x])
        fits = (label[right] != label[x]) & (np.minimum(n[right], n[x]) >= SIMILAR * most)
        if i[0] == j[0]:
            fits &= node[right] > node[x]
        at, most = right[fits], most[fits]
        at = at[(np.minimum(counts[at], counts[x]).sum(axis=1) >= SIMILAR * most) | (most > MOST)]
        for y in at:
            # Another bucket that both are in, with a smaller key, compares them.
            if label[x] != label[y] and min(buckets[x] & buckets[y]) == here and alike(words[x], words[y]):
                links.append((min(node[x], node[y]), max(node[x], node[y])))
                label[label == label[y]] = label[x]
    a, b = zip(*links) if links else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _crowd_links(crowded: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between texts of one large bucket that are of different components, as far as they connect something."""
    # At most as many keys as there are sketches.
    keys = crowded.groupBy("node").agg(F.collect_set("key").alias("keys"))
    known = texts.join(keys, "node").select("node", "words", "keys")
    blocks = F.ceil(F.col("n") / F.lit(MANY))
    rows = crowded.join(known, "node").withColumn("block", F.pmod(F.xxhash64("node"), blocks))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    return rows.groupBy("key", "i", "j").applyInArrow(_compared, "a bigint, b bigint")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size and kept (true for one row of each class), h1 and h2 of every document."""
    return _judged(*_classes(docs))


def _judged(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """What `classes` returns, from the sketched rows and the roots."""
    texts = rows.groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.min_by("row", F.struct("doc_id", "row")).alias("head"), F.min("doc_id").alias("least")
    )
    texts = texts.join(roots, ["h1", "h2"], "left").withColumn("root", F.coalesce("root", "head"))
    order = F.struct(F.col("least").isNull().alias("none"), "least", "head")
    found = texts.groupBy("root").agg(
        F.min("least").alias("class_id"), F.sum("n").alias("class_size"), F.min_by("head", order).alias("chosen")
    )
    each = texts.select("h1", "h2", "root").join(found, "root")
    kept = (F.col("row") == F.col("chosen")).alias("kept")
    return rows.join(each, ["h1", "h2"]).select("doc_id", "class_id", "class_size", kept, "h1", "h2")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns: the one with the smallest doc_id."""
    rows, roots = _classes(docs)
    text = ("doc_id", "h1", "h2")
    judged = _judged(rows, roots).groupBy(*text).agg(F.max("kept").alias("kept"), F.count("*").alias("_harborline_times"))
    kept = docs.join(_named(judged.where("kept"), "_harborline_times"), _same(*_key()))
    if rows.groupBy(*text).count().where("count > 1").isEmpty():
        return kept.select(*docs.columns)
    repeated = kept.where("_harborline_times > 1").dropDuplicates(["_harborline_id", "_harborline_h1", "_harborline_h2"])
    return kept.where("_harborline_times = 1").union(repeated).select(*docs.columns)
