"""Byte-level pieces, periodic runs and spelling variants against the tiktoken library and plain versions."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from harborline.llm import piece_model, queries, spelling, word_runs
from tests_llm_rows import ODD_ROWS, SMALL


def library():
    tokens = piece_model.read_ranks(piece_model.RANKS)
    ranks = {token: rank for rank, token in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


LIBRARY = library()
CODEC = piece_model.codec(piece_model.RANKS)


def pieces(text):
    return np.frombuffer(CODEC.encode_all([text])[0], "<u4").tolist()


def plain(text):
    return LIBRARY.encode_ordinary(text or "")


# ---- byte-level pieces -------------------------------------------------------------


def test_ranks_are_those_of_the_file():
    with open(piece_model.RANKS, "rb") as f:
        rows = [line.split() for line in f if line.strip()]
    assert piece_model.read_ranks(piece_model.RANKS) == [base64.b64decode(t) for t, _ in sorted(rows, key=lambda r: int(r[1]))]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab cDE 'stée\n\t.,!12ſΣİ<|▁Ġ"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_are_those_of_the_library(text):
    assert pieces(text) == plain(text)
    assert CODEC.decode(np.array(plain(text), np.uint32)) == text.encode()


def test_every_character_of_the_first_planes():
    for start in range(0, 0x20000, 64):
        shown = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b 1{c}  {c}" for c in shown)
        assert pieces(text) == plain(text)


def test_every_token_is_its_own_piece():
    shown = [CODEC.model.id_to_piece(i) for i in range(len(CODEC.tokens))]
    assert CODEC.model.encode(shown, out_type=int) == [[i] for i in range(len(shown))]


def test_long_matches():
    for text in ("a" * 20_000, " " * 3_000 + "x", "é" * 7_000, "the" * 9_000, "!?" * 5_000):
        assert pieces(text) == plain(text)


def test_piece_query_matches_the_library(llm, texts):
    rows = queries.op11_piece_model(llm, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = plain(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_pieces_on_odd_rows(odd, empty):
    decoded = piece_model.decode(piece_model.encode(odd)).collect()
    found = sorted((r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in decoded)
    assert found == sorted((r[0] or 0, plain(r[1]), (r[1] or "").encode()) for r in ODD_ROWS)
    assert piece_model.round_trip(empty).count() == 0


# ---- periodic runs -----------------------------------------------------------------


def plain_runs(words):
    """Every run, by comparing each word with the one a period further on."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


WORDS = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12)
PERIODIC = st.builds(lambda a, unit, times, b: a + unit * times + b, WORDS, WORDS, st.integers(0, 9), WORDS)


@settings(max_examples=400, deadline=None)
@given(st.lists(PERIODIC, max_size=5))
def test_runs_are_those_of_all_comparisons(texts):
    assert word_runs.runs_of(texts) == [plain_runs(t) for t in texts]


def test_extensions_are_exact():
    rng = np.random.default_rng(3)
    for alphabet in (1, 2, 30):
        words = np.concatenate([rng.integers(0, alphabet, 400), np.tile(rng.integers(0, 3, 9), 30), -2 - np.arange(word_runs.V)])
        extend = word_runs.Extensions(words)
        a, b = rng.integers(0, len(words) - 13, (2, 3000))
        a, b = a[a != b], b[a != b]
        for x, y, n in zip(a.tolist(), b.tolist(), extend.at(a, b).tolist()):
            m = 0
            while max(x, y) + m < len(words) and words[x + m] == words[y + m]:
                m += 1
            assert n == m


def test_small_blocks_and_groups_give_the_same(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [[b"%d" % x for x in rng.integers(0, 2, n)] for n in (0, 5, 6, 40, 41, 300, 700)] + [[b"x"] * 500]
    whole = word_runs.runs_of(texts)
    monkeypatch.setattr(word_runs, "GRID_BLOCK", 50)
    monkeypatch.setattr(word_runs, "GROUP_WORDS", 45)
    assert word_runs.runs_of(texts) == whole == [plain_runs(t) for t in texts]


def test_collapse_and_strongest():
    words = b"x a b a b a b a b y z z z z z z z".split()
    runs = word_runs.runs_of([words])[0]
    assert runs == [(1, 8, 2), (10, 7, 1)]
    assert b" ".join(word_runs.collapse(words, runs)) == b"x a b y z"
    assert word_runs.strongest(runs) == (10, 7, 1)
    assert word_runs.strongest([(9, 8, 2), (3, 8, 2), (1, 6, 2)]) == (3, 8, 2)
    assert word_runs.strongest([]) is None


def planted(doc_id, text):
    """The rule of the query, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def check_runs(row, words):
    runs = plain_runs(words)
    assert row.n_runs == len(runs)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    assert (row.start, row.length, row.period) == (best or (None,) * 3)
    assert row.exponent_milli == (best and 1000 * best[1] // best[2])


def test_run_query_matches_the_plain_version(llm, texts):
    rows = queries.op12_word_runs(llm, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert sum(r.n_runs > 0 for r in rows) > len(rows) / 20
    for row in rows:
        check_runs(row, planted(row.doc_id, texts[row.doc_id]))


def test_runs_on_odd_rows(odd, empty, llm, folder):
    found = sorted(((r.doc_id or 0, r.collapsed) for r in word_runs.repetitions(odd).collect()))
    want = []
    for row in ODD_ROWS:
        words = (row[1] or "").encode().split()
        want.append((row[0] or 0, b" ".join(word_runs.collapse(words, plain_runs(words) if len(words) < 999 else [])).decode()))
    assert found == sorted(want)
    assert word_runs.repetitions(empty).count() == 0
    odd.union(llm.createDataFrame([(n, "a b c " * 40 + "end", *[None] * 6) for n in range(60)], odd.schema)).write.parquet(
        f"{folder}/documents.parquet")
    for row in queries.op12_word_runs(llm, folder).where("doc_id >= 10").collect():
        check_runs(row, planted(row.doc_id, "a b c " * 40 + "end"))


# ---- spelling variants ---------------------------------------------------------------


def one_edit(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def are_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and short in one_edit(long)


def plain_variants(counts):
    out = {}
    for word, n in counts.items():
        near = [w for w in counts if w != word and are_near(word, w)]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 5 * n else None
        out[word] = (form, n, len(near), counts[form] if form else None)
    for word, row in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        out[word] = (row[0], root, *row[1:])
    return out


def as_dict(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@settings(max_examples=300, deadline=None)
@given(st.integers(3, 6), st.text("ab", max_size=2), st.lists(st.text("abc", min_size=1, max_size=5), max_size=25))
def test_scan_of_a_cell_finds_all_near_words(m, head, tails):
    words = sorted({head + t for t in tails if len(head + t) in (m, m + 1)})
    found = sorted(tuple(sorted(p)) for p in spelling.near_in_cell(words, m, len(head)))
    assert found == [
        (i, j) for i in range(len(words)) for j in range(i + 1, len(words))
        if are_near(words[i], words[j]) and m in (len(words[i]), len(words[j]))
    ]


def test_cells_divided_often_lose_no_pair(llm):
    """A third of all words begins alike, and even small cells are dealt again until only the edit is open."""
    words = [f"sameword{a}{b}{c}" for a in "abcdé" for b in "abcd" for c in "abcd"] + [f"{a}{b}{c}another" for a in "xyz" for b in "xy" for c in "xÿz"]
    words += ["sameworda", "samewordab", "samewordabcde", "q" * 40, "q" * 41, "q" * 20 + "z" + "q" * 20, "unlike", "unlikely"]
    counts = {w: 5 + 37 * (i * 7919 % 101) for i, w in enumerate(dict.fromkeys(words))}
    vocabulary = llm.createDataFrame(list(counts.items()), "word string, n bigint")
    want = plain_variants(counts)
    assert sum(v[0] is not None for v in want.values()) > 10
    for limit in (2, 10_000):
        assert as_dict(spelling.variants(vocabulary, limit=limit)) == want
    sizes = spelling.cells(vocabulary, 2).groupBy("m", "front", "behind", "first", "last").agg(F.count("*").alias("words"))
    assert sizes.where("words > 2 AND m - 1 > front + behind").count() == 0


def test_forms_are_followed_to_the_last(llm):
    counts = {"abcdefgh"[:6] + tail: 5 ** (7 - i) for i, tail in enumerate(["", "h", "hi", "hij", "hijk", "hijkl"])}
    counts["other" + "s" * 3] = 7
    found = as_dict(spelling.variants(llm.createDataFrame(list(counts.items()), "word string, n bigint")))
    assert found == plain_variants(counts)
    assert found["abcdefhijkl"][1] == "abcdef"


def plain_counts(rows, change=True):
    counts = Counter()
    for doc_id, text in rows:
        for word in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if change and h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_spelling_query_matches_the_plain_version(llm, texts):
    counts = plain_counts(texts.items())
    assert counts != plain_counts(texts.items(), change=False)
    found = as_dict(queries.op13_spelling(llm, SMALL))
    assert found == plain_variants(counts)
    assert any(row[0] for row in found.values())


def test_spelling_on_odd_rows(odd, empty, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    found = spelling.count_words(odd, spelling.damaged, min_count=1).collect()
    counts = Counter()
    for doc_id, text in ((r[0], r[1]) for r in ODD_ROWS):
        for word in re.findall(r"[A-Za-zÀ-ÿ]{6,}", text or ""):
            counts[word.lower()] += 1
    assert sum(r.n for r in found) <= sum(counts.values())
    assert {r.word for r in found if r.n >= 20} == {w for w, n in counts.items() if n >= 20}
    assert spelling.variants(spelling.count_words(empty)).count() == 0
    single = odd.sparkSession.createDataFrame([("lonely", 9)], "word string, n bigint")
    assert as_dict(spelling.variants(single)) == {"lonely": (None, "lonely", 9, 0, None)}
