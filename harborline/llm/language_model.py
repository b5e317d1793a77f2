"""A hierarchical Pitman-Yor language model over the whole corpus, and the score of every document under it.

Each context, a previous word, is a restaurant (known by 32 bits of its hash; of ten million contexts two in a thousand
share one), so restaurants grow in number with the corpus. A customer is a training token; a word's tables in all context
restaurants are its customers in the parent restaurant, whose own base is uniform over the known words and one unknown
word. Seating is sampled by Gibbs: the number of tables of a word in a restaurant is drawn from its conditional
distribution given the other restaurants (by generalised Stirling numbers up to `EXACT` customers, above that by seating
the further customers in groups). After `BURN_IN` rounds, in which restaurants hear of each other's new tables, `SAMPLES`
samples are drawn and the predictive probabilities of a token are averaged over them; a document's score is the sum of
their log10.

Tokens are moved once. A task cuts documents into blocks, in which equal texts stand once with their number of copies, and
deals each block's tokens into shares by the hash of the word, so all of a word's counts meet in one share. A share is one
row of a written table bucketed by share, a compressed sorted column of tokens. What contexts hold in all is never
gathered: after a round every share sends its contexts' customers and tables, by ranges of the context, to groups that add
them up and answer each share with the totals of its own contexts, and only these meet the share's bucket in the next
round. Words so frequent that they would overfill a share (a list of bounded length, from a hash sample of documents; it
steers the load and no count) are dealt out by their context as well, and their totals are summed up between rounds.
Every round reads written tables, so a lost task is run again from files. Shares answer with sums for each text of a
block, and a block's sums meet in one small group. On the driver arrive the frequent words and a few counts.

Discounts follow from how many things occur once and twice; the strength is 1. Everything is seeded by share and round.

Defined results: a null text counts as empty and has one token, its end; a null doc_id counts as the empty string for
the training rule; repeated rows count as often as they occur; without training tokens every word is unknown and all
probability is the base's; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from harborline.llm.common import scratch_path, stage, whole_text

SHARE_BYTES = 10 << 20
BLOCK_TOKENS = 1 << 21
BLOCK_DOCS = 1 << 15
# Spark's own limit on buckets is 100,000; beyond this several shares are in one.
BUCKETS = 20_000
EXACT = 64
BURN_IN = 1
SAMPLES = 3
STRENGTH = 1.0
# Sums of logarithms travel as whole numbers of these parts; those of the model, which is sampled, need few.
BASE_UNIT = 1 << 32
SCORE_UNIT = 1 << 12
# A word with more than this part of a share's tokens is dealt out; the sample is one in so many documents.
FREQUENT = 0.25
SAMPLED = 64

END = xxhash.xxh64_intdigest(b" end ")
START = xxhash.xxh64_intdigest(b" start ")


def tokens(text: str) -> np.ndarray:
    """Hashes of the words of a text, A-Z in lower case, and of its end."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    found = np.empty(len(words) + 1, np.uint64)
    found[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    found[-1] = END
    return found


def context(previous: np.ndarray) -> np.ndarray:
    return ((previous * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def pack_arrays(arrays: list[np.ndarray]) -> bytes:
    """Arrays as one string of bytes: sorted ones as differences, and the bytes of each significance squeezed apart."""
    squeeze, heads, bodies = zstandard.ZstdCompressor(level=3).compress, [struct.pack("<i", len(arrays))], []
    for a in arrays:
        rising = a.dtype.kind == "u" and len(a) > 1 and bool((a[1:] >= a[:-1]).all())
        planes = np.ascontiguousarray(np.diff(a, prepend=a.dtype.type(0)) if rising else a).view(np.uint8).reshape(len(a), a.itemsize).T
        heads.append(struct.pack("<2s?q", a.dtype.str[1:].encode(), rising, len(a)))
        for plane in planes if len(a) else ():
            raw = plane.tobytes()
            bodies.append(min(raw, squeeze(raw), key=len))
            heads.append(struct.pack("<i", len(bodies[-1])))
    return b"".join(heads + bodies)


def unpack_arrays(blob: bytes) -> list[np.ndarray]:
    open_up, at, found = zstandard.ZstdDecompressor().decompress, 4, []
    for _ in range(struct.unpack_from("<i", blob)[0]):
        kind, rising, size = struct.unpack_from("<2s?q", blob, at)
        dtype, at = np.dtype("<" + kind.decode()), at + 11
        lengths = struct.unpack_from(f"<{dtype.itemsize}i", blob, at) if size else ()
        at += 4 * len(lengths)
        found.append((dtype, rising, size, lengths))
    out = []
    for dtype, rising, size, lengths in found:
        bytes_ = np.empty((size, dtype.itemsize), np.uint8)
        for i, length in enumerate(lengths):
            # A plane as long as the array is stored as it is.
            raw = blob[at : at + length]
            bytes_[:, i] = np.frombuffer(raw if length == size else open_up(raw), np.uint8)
            at += length
        values = bytes_.reshape(-1).view(dtype)
        out.append(np.cumsum(values, dtype=dtype) if rising else values)
    return out


# ---- seating ---------------------------------------------------------------------


def stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: seatings of c customers at t tables, at [c, t]."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(most):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore"):
            stay = out[c, t] + np.log(np.maximum(c - t * discount, 0))
        out[c + 1, t] = np.logaddexp(out[c, t - 1], stay)
    return out


def draw_tables(
    customers: np.ndarray, others: np.ndarray, base: np.ndarray, discount: float, rng: np.random.Generator
) -> np.ndarray:
    """Numbers of tables of dishes, each given its customers, the restaurant's other tables and the base's probability."""
    tables = np.minimum(customers, 1)
    table = stirling(discount)
    for c in range(2, EXACT + 1):
        at = np.flatnonzero(customers == c if c < EXACT else customers >= EXACT)
        for part in np.array_split(at, -(-len(at) // 20000)) if len(at) else ():
            opened = np.log(STRENGTH + discount * (others[part, None] + np.arange(c))).cumsum(axis=1)
            weight = table[c, 1 : c + 1] + np.arange(1, c + 1) * np.log(base[part, None]) + opened
            total = np.exp(weight - weight.max(axis=1, keepdims=True)).cumsum(axis=1)
            tables[part] = 1 + (total < total[:, -1:] * rng.random((len(part), 1))).sum(axis=1)
    at = np.flatnonzero(customers > EXACT)
    seated = np.full(len(at), EXACT)
    while len(at):
        new = base[at] * (STRENGTH + discount * (others[at] + tables[at]))
        group = np.minimum(np.maximum(seated // 16, 1), customers[at] - seated)
        tables[at] += rng.binomial(group, new / (new + seated - discount * tables[at]))
        seated = seated + group
        at, seated = at[seated < customers[at]], seated[seated < customers[at]]
    return tables


def discount_of(once: float, twice: float) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


# ---- moving the tokens -----------------------------------------------------------


def _block(
    rows: list[tuple], texts: list[np.ndarray], number: int, shares: int, frequent: np.ndarray, kind: pa.DataType
) -> pa.RecordBatch:
    """One block's rows: its documents (id, held out, place of the text), and a blob of tokens for each share that gets some."""
    place = np.array([r[2] for r in rows])
    copies = np.bincount(place, [not r[1] for r in rows], len(texts)).astype(np.uint16)
    sizes = np.array([len(t) for t in texts])
    words = np.concatenate(texts)
    before = np.concatenate([[np.uint64(START)], words[:-1]])
    before[np.cumsum(sizes)[:-1]] = START
    contexts = context(before)
    doc = np.repeat(np.arange(len(texts), dtype=np.uint16), sizes)
    spread = words >> np.uint64(17)
    if len(frequent):
        often = frequent[np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)] == words
        spread = np.where(often, spread + contexts * np.uint64(0x9E3779B1), spread)
    share = (spread % np.uint64(shares)).astype(np.int64)
    order = np.lexsort((words, share))
    words, contexts, doc, share = words[order], contexts[order], doc[order], share[order]
    cuts = np.searchsorted(share, np.arange(shares + 1))
    names, blobs = [int(number % shares)], [None]
    for s in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[s], cuts[s + 1]
        unique, times = np.unique(words[a:b], return_counts=True)
        blobs.append(pack_arrays([unique, times.astype(np.uint32), contexts[a:b], doc[a:b], copies[doc[a:b]]]))
        names.append(int(s))
    docs = pa.StructArray.from_arrays(
        [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows]), pa.array(sizes[place], pa.int64()), pa.array(place, pa.int32())],
        ["doc_id", "held_out", "n_tokens", "place"],
    )
    offsets = pa.array([0, *[len(rows)] * len(names)], pa.int32())
    columns = [pa.array(names, pa.int32()), pa.array([number] * len(names), pa.int64())]
    columns += [pa.ListArray.from_arrays(offsets, docs), pa.array(blobs, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["share", "block", "docs", "blob"])


def _merged(table: pa.Table) -> pa.Table:
    """The rows of one share: its documents as they are, and all its tokens sorted by word and context in one row."""
    is_doc = table.column("blob").is_null()
    out, rest = [table.filter(is_doc)], table.filter(table.column("blob").is_valid())
    if rest.num_rows:
        blocks = rest.column("block").to_numpy()
        parts = [unpack_arrays(b.as_py()) for b in rest.column("blob")]
        unique, rank = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        times = np.concatenate([p[1] for p in parts])
        # Word and context as one number to sort by: a share has far fewer than 2^32 words.
        key = np.repeat(rank.astype(np.uint64) << np.uint64(32), times)
        key |= np.concatenate([p[2] for p in parts])
        doc, copies = (np.concatenate([p[i] for p in parts]) for i in (3, 4))
        block = np.repeat(np.arange(len(parts), dtype=np.uint32), [len(p[3]) for p in parts])
        del parts
        times = np.bincount(rank, times, len(unique)).astype(np.uint32)
        order = np.argsort(key, kind="stable")
        contexts = key.astype(np.uint32)
        blob = pack_arrays([unique, times, *(v[order] for v in (contexts, block, doc, copies)), blocks.astype(np.int64)])
        row = {"share": rest.column("share")[:1], "block": pa.nulls(1, pa.int64()), "docs": pa.nulls(1, table.schema.field("docs").type)}
        out.append(pa.table({**row, "blob": pa.array([blob], pa.binary())}, schema=table.schema))
    return pa.concat_tables(out)


@dataclass
class Share:
    """The tokens of a share, with the pairs of word and context they make."""

    words: np.ndarray
    pair_word: np.ndarray
    contexts: np.ndarray
    pair_context: np.ndarray
    pair_of: np.ndarray
    count: np.ndarray
    word_count: np.ndarray
    block: np.ndarray
    doc: np.ndarray
    blocks: np.ndarray
    # Customers and tables of its contexts in all shares.
    context_customers: np.ndarray
    context_tables: np.ndarray

    @classmethod
    def read(cls, blob: bytes) -> Share:
        words, times, contexts, block, doc, copies, blocks = unpack_arrays(blob)
        of = np.repeat(np.arange(len(words)), times)
        new = np.concatenate([[True], (of[1:] != of[:-1]) | (contexts[1:] != contexts[:-1])])
        pair_of = np.cumsum(new) - 1
        count = np.bincount(pair_of, copies, int(new.sum())).astype(np.int64)
        word_count = np.bincount(of, copies, len(words)).astype(np.int64)
        used, pair_context = np.unique(contexts[new], return_inverse=True)
        none = np.zeros(len(used))
        return cls(words, of[new], used, pair_context, pair_of, count, word_count, block, doc, blocks, none, none)

    def tell(self, tables: np.ndarray, shares: int) -> Iterator[tuple[int, bytes]]:
        """Its contexts with their customers and tables here, by ranges of contexts."""
        customers = np.bincount(self.pair_context, self.count, len(self.contexts)).astype(np.uint64)
        opened = np.bincount(self.pair_context, tables, len(self.contexts)).astype(np.uint64)
        place = (self.contexts.astype(np.uint64) * np.uint64(shares)) >> np.uint64(32)
        cuts = np.searchsorted(place, np.arange(shares + 1, dtype=np.uint64))
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            at = slice(cuts[i], cuts[i + 1])
            yield i, pack_arrays([self.contexts[at], customers[at], opened[at]])

    def hear(self, answers: pa.Table) -> None:
        """Take in the totals of its contexts: the answers of the ranges, in order, are in the order of its contexts."""
        order = np.argsort(answers.column("place").to_numpy())
        parts = [unpack_arrays(answers.column("blob")[i].as_py()) for i in order.tolist()]
        self.context_customers, self.context_tables = (np.concatenate([p[i] for p in parts]).astype(np.float64) for i in (0, 1))

    def frequent(self, state: State) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words are on the list of frequent ones, and where they stand there."""
        if not len(state.frequent):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(state.frequent, self.words), len(state.frequent) - 1)
        mine = np.flatnonzero(state.frequent[at] == self.words)
        return mine, at[mine]


@dataclass
class State:
    """What all shares know between rounds."""

    frequent: np.ndarray
    frequent_counts: np.ndarray
    frequent_customers: np.ndarray
    tokens: float = 0.0
    known: float = 0.0
    discounts: tuple[float, float] = (0.5, 0.5)
    customers: float = 0.0
    tables: float = 0.0

    @property
    def base(self) -> float:
        return 1.0 / (self.known + 1.0)


def seat_parent(share: Share, state: State, tables: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Customers and tables of each word in the parent restaurant, and its probability there."""
    n = np.bincount(share.pair_word, tables, len(share.words)).astype(np.int64)
    mine, at = share.frequent(state)
    n[mine] = state.frequent_customers[at]
    d = state.discounts[1]
    m = draw_tables(n, np.full(len(n), max(state.tables - 1, 0.0)), np.full(len(n), state.base), d, rng)
    p = (n - d * m + (STRENGTH + d * state.tables) * state.base) / (STRENGTH + state.customers)
    return n, m, p


def seat_contexts(share: Share, state: State, parent: np.ndarray, rng) -> np.ndarray:
    """Tables of each pair, given the parent's probabilities."""
    others = np.maximum(share.context_tables[share.pair_context] - np.minimum(share.count, 1), 0)
    return draw_tables(share.count, others, parent[share.pair_word], state.discounts[0], rng)


def predictive(share: Share, state: State, tables: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Probability of each pair's word in its context."""
    d, c = state.discounts[0], share.pair_context
    return (share.count - d * tables + (STRENGTH + d * share.context_tables[c]) * parent[share.pair_word]) / (
        STRENGTH + share.context_customers[c]
    )


# ---- rounds ----------------------------------------------------------------------

# Keys of the sums that shares report; frequent words are 0 and up.
TOKENS, KNOWN, PAIRS_ONCE, PAIRS_TWICE, WORDS_ONCE, WORDS_TWICE, PARENT_TABLES, OPENED = range(-8, 0)
TOLD = "k bigint, x double, y double, place int, share int, blob binary"


def _told(share: Share, number: int, shares: int, state: State, turn: int) -> pa.Table:
    """What a share tells after a round: rows of sums by key, and rows of contexts by range. Round 0 counts; later ones seat."""
    tables, m, rng = np.minimum(share.count, 1), None, np.random.default_rng([turn, number])
    if turn:
        _, _, parent = seat_parent(share, state, tables, rng)
        tables = seat_contexts(share, state, parent, rng)
        _, m, _ = seat_parent(share, state, tables, rng)
    n = np.bincount(share.pair_word, tables, len(share.words))
    mine, at = share.frequent(state)
    own = np.ones(len(share.words), bool)
    own[mine] = False
    single = {
        TOKENS: share.word_count.sum(), KNOWN: (share.word_count[own] > 0).sum(), OPENED: tables.sum(),
        PAIRS_ONCE: (share.count == 1).sum(), PAIRS_TWICE: (share.count == 2).sum(),
        WORDS_ONCE: (n[own] == 1).sum(), WORDS_TWICE: (n[own] == 2).sum(),
        PARENT_TABLES: 0 if m is None else m[own].sum(),
    }
    keys = [*single, *at.tolist()]
    x = [*map(float, single.values()), *share.word_count[mine].astype(float).tolist()]
    y = [0.0] * len(single) + n[mine].tolist()
    places, blobs = zip(*share.tell(tables, shares))
    none, empty = [None] * len(keys), [None] * len(places)
    kinds = [pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.binary()]
    columns = [keys + empty, x + empty, y + empty, [*none, *places], none + [number] * len(places), [*none, *blobs]]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["k", "x", "y", "place", "share", "blob"])


def _round(written: DataFrame, totals: DataFrame | None, shares: int, state: State, turn: int) -> tuple[DataFrame, dict]:
    """One round over all shares: totals of contexts for each share, and sums by key."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from _told(Share.read(blob), number, shares, state, turn).to_batches()

    def seat(mine: pa.Table, answers: pa.Table) -> pa.Table:
        share = Share.read(mine.column("blob")[0].as_py())
        share.hear(answers)
        return _told(share, mine.column("share")[0].as_py(), shares, state, turn)

    own = written.where("blob IS NOT NULL").select("share", "blob")
    if totals is None:
        told = stage(own.mapInArrow(count, TOLD), "told")
    else:
        told = stage(own.groupBy("share").cogroup(totals.groupBy("share")).applyInArrow(seat, TOLD), "told")
    found = told.where("k IS NOT NULL").groupBy("k").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).toPandas()
    sums = dict(zip(found["k"].tolist(), zip(found["x"].tolist(), found["y"].tolist())))
    rows = told.where("k IS NULL").select("place", "share", "blob")
    return rows.groupBy("place").applyInArrow(_summed, "place int, share int, blob binary"), sums


def _summed(table: pa.Table) -> pa.Table:
    """Totals of one range of contexts, for each share those of its own contexts in their order."""
    parts = [unpack_arrays(b.as_py()) for b in table.column("blob")]
    _, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    customers, opened = (np.bincount(at, np.concatenate([p[i] for p in parts])).astype(np.uint64) for i in (1, 2))
    cuts = np.cumsum([0, *(len(p[0]) for p in parts)])
    blobs = [pack_arrays([customers[at[a:b]], opened[at[a:b]]]) for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.table([table.column("place"), table.column("share"), pa.array(blobs, pa.binary())], ["place", "share", "blob"])


def _next_state(frequent: np.ndarray, sums: dict[int, tuple[float, float]], last: State | None, turn: int) -> State:
    often = np.array([sums.get(key, (0.0, 0.0)) for key in range(len(frequent))]).reshape(-1, 2)
    one = {key: sums.get(key, (0.0, 0.0))[0] for key in range(TOKENS, 0)}
    state = State(frequent, often[:, 0], often[:, 1], tokens=one[TOKENS])
    state.known = one[KNOWN] + float((often[:, 0] > 0).sum())
    state.customers = one[OPENED]
    if last is None:
        state.discounts = (
            discount_of(one[PAIRS_ONCE], one[PAIRS_TWICE]),
            discount_of(one[WORDS_ONCE] + (often[:, 1] == 1).sum(), one[WORDS_TWICE] + (often[:, 1] == 2).sum()),
        )
        state.tables = state.known
        return state
    state.discounts = last.discounts
    base, others = np.full(len(often), state.base), np.full(len(often), last.tables)
    mine = draw_tables(often[:, 1].astype(np.int64), others, base, state.discounts[1], np.random.default_rng([turn, 0, 1]))
    state.tables = one[PARENT_TABLES] + float(mine.sum())
    return state


def _answers(written: DataFrame, totals: DataFrame, state: State) -> DataFrame:
    """For each block and share: known tokens, sum of log10(c + 1) and sum of log10 of the model, by text."""

    def run(mine: pa.Table, answers: pa.Table) -> pa.Table:
        share = Share.read(mine.column("blob")[0].as_py())
        share.hear(answers)
        rng = np.random.default_rng([99, mine.column("share")[0].as_py()])
        tables, mean = np.minimum(share.count, 1), np.zeros(len(share.count))
        for _ in range(SAMPLES):
            _, _, parent = seat_parent(share, state, tables, rng)
            tables = seat_contexts(share, state, parent, rng)
            _, _, parent = seat_parent(share, state, tables, rng)
            mean += predictive(share, state, tables, parent) / SAMPLES
        counts = share.word_count.astype(np.float64)
        often, at = share.frequent(state)
        counts[often] = state.frequent_counts[at]
        words = counts[share.pair_word]
        key = share.block.astype(np.int64) << 16 | share.doc
        texts, where = np.unique(key, return_inverse=True)
        known, base, score = (
            np.bincount(where, v[share.pair_of], len(texts)) for v in (words > 0, np.log10(words + 1), np.log10(mean))
        )
        cuts = np.searchsorted(texts >> 16, np.arange(len(share.blocks) + 1))
        blobs, names = [], []
        for b in np.flatnonzero(np.diff(cuts)):
            s = slice(cuts[b], cuts[b + 1])
            count = known[s].astype(np.uint16 if known[s].max() < 1 << 16 else np.uint32)
            fixed = (np.rint(v[s] * unit).astype(np.uint64) for v, unit in ((base, BASE_UNIT), (-score, SCORE_UNIT)))
            blobs.append(pack_arrays([(texts[s] & 0xFFFF).astype(np.uint16), count, *fixed]))
            names.append(int(share.blocks[b]))
        return pa.table([pa.array(names, pa.int64()), pa.array(blobs, pa.binary())], ["block", "blob"])

    own = written.where("blob IS NOT NULL").select("share", "blob")
    sums = own.groupBy("share").cogroup(totals.groupBy("share")).applyInArrow(run, "block bigint, blob binary")
    return written.where("docs IS NOT NULL").select("block", "docs").unionByName(sums, allowMissingColumns=True)


def _finished(table: pa.Table, state: State) -> pa.Table:
    """One row for each document of a block."""
    docs = table.filter(table.column("docs").is_valid()).column("docs").combine_chunks().flatten()
    place = docs.field("place").to_numpy()
    sums = np.zeros((3, int(place.max()) + 1))
    for blob in table.column("blob").to_pylist():
        if blob is not None:
            at, *values = unpack_arrays(blob)
            for total, value, unit in zip(sums, values, (1, BASE_UNIT, -SCORE_UNIT)):
                total[at] += value / unit
    sums, n = sums[:, place], docs.field("n_tokens")
    base = sums[1] - n.to_numpy() * math.log10(state.tokens + state.known + 1)
    return pa.table({
        "doc_id": docs.field("doc_id"), "held_out": docs.field("held_out"), "n_tokens": n,
        "n_known": pa.array(sums[0].astype(np.int64)), "train_tokens": pa.array([int(state.tokens)] * len(docs), pa.int64()),
        "base_score": pa.array(base), "score": pa.array(sums[2]),
    })


def frequent_words(docs: DataFrame, shares: int) -> np.ndarray:
    """Hashes, in order, of words that would take a large part of a share, by a hash sample of the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.concatenate([tokens(t) for t in batch.column(0).to_pylist()] or [np.zeros(0, np.uint64)])
            unique, times = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), pa.array(times)], ["w", "n"])

    sample = docs.where(F.pmod(F.xxhash64(whole_text()), F.lit(SAMPLED)) == 0).select(whole_text().alias("text"))
    counts = stage(sample.mapInArrow(run, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n")), "frequent")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # At most shares / FREQUENT words can have so many of the sampled tokens.
    found = counts.where(F.col("n") > F.lit(total * FREQUENT / shares)).where("n > 100").select("w").toPandas()
    return np.sort(found["w"].to_numpy(np.int64).view(np.uint64))


def scores(docs: DataFrame, held_out) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    `held_out` is a boolean column of docs' columns; the model learns from the other documents.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out.alias("held_out"), whole_text().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shares = max(1, math.ceil(size / SHARE_BYTES))
    frequent = frequent_words(docs, shares)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, kind = TaskContext.get().partitionId(), 0, None
        held, texts, places, size = [], [], {}, 0
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc_id, is_held, text in zip(*(column.to_pylist() for column in batch.columns)):
                name = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
                if name not in places:
                    places[name] = len(texts)
                    texts.append(tokens(text))
                    size += len(texts[-1])
                held.append((doc_id, is_held, places[name]))
                if size >= BLOCK_TOKENS or len(held) >= BLOCK_DOCS:
                    yield _block(held, texts, part << 32 | made, shares, frequent, kind)
                    made, held, texts, places, size = made + 1, [], [], {}, 0
        if held:
            yield _block(held, texts, part << 32 | made, shares, frequent, kind)

    listed = f"array<struct<doc_id: {kind}, held_out: boolean, n_tokens: bigint, place: int>>"
    schema = f"share int, block bigint, docs {listed}, blob binary"
    written = _bucketed(rows.mapInArrow(cut, schema).groupBy("share").applyInArrow(_merged, schema), shares)
    none = np.zeros(len(frequent))
    totals, sums = _round(written, None, shares, State(frequent, none, none), 0)
    state = _next_state(frequent, sums, None, 0)
    for turn in range(1, BURN_IN + 1):
        totals, sums = _round(written, totals, shares, state, turn)
        state = _next_state(frequent, sums, state, turn)
    result = (
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
    return _answers(written, totals, state).groupBy("block").applyInArrow(lambda table: _finished(table, state), result)


def _bucketed(moved: DataFrame, shares: int) -> DataFrame:
    """The shares as a written table bucketed by share, so that rounds bring the totals to the shares and not both together.

    The catalog knows the table only until its files are found here.
    """
    spark, name = moved.sparkSession, f"shares_{uuid.uuid4().hex}"
    moved.write.format("parquet").bucketBy(min(shares, BUCKETS), "share").option("path", scratch_path(spark, "shares")).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found
