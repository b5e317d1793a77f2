"""Near-duplicates, the language model, toxicity and the pipeline against brute force and held-out labels."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from harborline import session
from harborline.llm import components, language_model, near_duplicates as near, packing, pii, quality_rules, queries, toxicity
from harborline.llm.components import connected
from tests_llm_rows import ODD_ROWS, PLAIN, SMALL


# ---- near-duplicates ---------------------------------------------------------------


def longest(a, b, band):
    rows = np.zeros((len(b) + 1, len(a) + 1), int)
    for j in range(1, len(b) + 1):
        for i in range(1, len(a) + 1):
            here = rows[j - 1, i - 1] + 1 if a[i - 1] == b[j - 1] and abs(i - j) <= band else 0
            rows[j, i] = max(rows[j - 1, i], rows[j, i - 1], here)
    return rows[-1, -1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=22), st.lists(st.integers(0, 4), max_size=22), st.integers(0, 8))
def test_alignment(a, b, band):
    x, y = np.array(a, np.uint32), np.array(b, np.uint32)
    full = longest(a, b, 99)
    assert near.aligned(x, y, 99) == full
    assert longest(a, b, band) <= near.aligned(x, y, band) <= full
    assert near.alike(x, y) == (min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) <= full / 0.8 * 0.8 and full >= 0.8 * max(len(a), len(b)))


def test_sketches_mind_the_order():
    words = near.word_hashes(" ".join(f"w{n}" for n in range(200)))
    assert (near.sketches(words) == near.sketches(words.copy())).all()
    kmers = near.labelled_kmers(words)
    assert len(set(kmers.tolist())) == 196
    turned = np.concatenate([words[100:], words[:100]])
    same = (near.sketches(words) == near.sketches(turned)).mean()
    shared = len(set(kmers.tolist()) & set(near.labelled_kmers(turned).tolist())) / 196
    assert shared > 0.95 and same < 0.6
    again = near.labelled_kmers(np.tile(words[:1], 20))
    assert len(set(again.tolist())) == 16


def brute_classes(texts):
    words = {d: (near.word_hashes(t) & np.uint64(0xFFFFFFFF)).astype(np.uint32) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if texts[a] == texts[b] or near.alike(words[a], words[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in texts}


def test_classes_match_all_pairs(llm, texts):
    rows = queries.op5_near_duplicates(llm, SMALL).collect()
    assert {r.doc_id: r.class_id for r in rows} == brute_classes(texts)
    assert {r.doc_id for r in rows if r.kept} == {r.class_id for r in rows}


def test_a_large_group_of_near_copies_and_a_shared_passage(llm):
    rng = np.random.default_rng(3)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    original, passage, rows = word(150), word(60), []
    for i in range(120):
        copy = list(original)
        for at in rng.choice(150, 5, replace=False):
            copy[at] = f"new{i}x{at}"
        rows.append((i, " ".join(copy)))
    for i in range(200, 300):
        rows.append((i, " ".join(word(40) + passage + word(40))))
    found = {r.doc_id: r.class_id for r in near.classes(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {found[i] for i in range(120)} == {0} and all(found[i] == i for i in range(200, 300))


def test_crowded_buckets_are_split(llm, texts, monkeypatch):
    monkeypatch.setattr(near, "MANY", 1)
    monkeypatch.setattr(near, "SMALL", 2)
    rows = queries.op5_near_duplicates(llm, SMALL).collect()
    assert {r.doc_id: r.class_id for r in rows} == brute_classes(texts)


def edited(words, share, rng):
    words = list(words)
    for at in rng.choice(len(words), int(share * len(words)), replace=False):
        words[at] = f"x{rng.integers(1 << 40)}"
    return words


def meeting_classes(texts):
    """Components of the pairs that share a sketch and are alike."""
    words = {d: near.word_hashes(t) for d, t in texts.items()}
    short = {d: (w & np.uint64(0xFFFFFFFF)).astype(np.uint32) for d, w in words.items()}
    keys = {d: set(near.sketches(w).tolist()) for d, w in words.items()}
    root = {d: d for d in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        if keys[a] & keys[b] and root[a] != root[b] and near.alike(short[a], short[b]):
            x, y = sorted((root[a], root[b]))
            root = {d: x if r == y else r for d, r in root.items()}
    return root


@pytest.mark.parametrize("share", [0.1, 0.12, 0.15, 0.18, 0.2])
def test_texts_that_are_alike_meet(share):
    rng = np.random.default_rng(6)
    met = []
    for n in rng.integers(50, 600, 400):
        text = [f"w{x}" for x in rng.integers(0, 100_000, n)]
        keys = [near.sketches(near.word_hashes(" ".join(words))) for words in (text, edited(text, share, rng))]
        met.append((keys[0] == keys[1]).any())
    assert np.mean(met) >= 0.95


@pytest.mark.parametrize("block", [1024, 16])
def test_copies_of_one_original_and_pairs_in_crowds_are_found(llm, monkeypatch, block):
    rng = np.random.default_rng(8)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 100_000, n)]
    original, passage = word(200), word(100)
    texts = {i: " ".join(edited(original, 0.14, rng)) for i in range(1, 300)} | {900: " ".join(original)}
    for i in range(0, 120, 2):
        text = word(40) + passage + word(40)
        texts |= {2000 - i: " ".join(text), 1001 + i: " ".join(edited(text, 0.08, rng))}
    monkeypatch.setattr(near, "MANY", block)
    rows = near.classes(llm.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.class_id for r in rows} == meeting_classes(texts)


def test_spokes_join_the_rows_of_large_buckets_once(llm):
    # Node 30 is in two large buckets, so it meets most others; bucket 3 is small.
    rows = [(1, n, 10, 9) for n in range(22, 31)] + [(2, n, 10, 10) for n in range(30, 40)] + [(3, n, 10, 2) for n in (22, 39)]
    spokes = near._spokes(llm.createDataFrame(rows, "key bigint, node bigint, n_words bigint, size bigint"))
    assert sorted(map(tuple, spokes.collect())) == [(n, 30) for n in range(22, 30)] + [(30, n) for n in range(31, 40)]
    assert spokes._jdf.queryExecution().analyzed().toString().count("Join ") == 1


def test_near_duplicates_write_few_tables_and_hold_nothing_after(llm, monkeypatch):
    rng = np.random.default_rng(9)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 100_000, n)]
    original, passage = word(200), word(100)
    texts = {i: " ".join(edited(original, 0.14, rng)) for i in range(1, 100)} | {900: " ".join(original)}
    for i in range(0, 80, 2):
        text = word(40) + passage + word(40)
        texts |= {2000 - i: " ".join(text), 1001 + i: " ".join(edited(text, 0.08, rng))}
    written, crowds, path, crowd_links = [], [], session.scratch_path, near._crowd_links
    monkeypatch.setattr(session, "scratch_path", lambda spark, name: written.append(name) or path(spark, name))
    monkeypatch.setattr(near, "_crowd_links", lambda *frames: crowds.append(1) or crowd_links(*frames))
    held = llm.sparkContext._jsc.getPersistentRDDs().size()
    rows = near.one_of_each(llm.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    assert {r.doc_id for r in rows} == set(meeting_classes(texts).values()) and crowds
    # The links before and after each two rounds, of the pairs and of the crowds.
    assert set(written) == {"sketches", "members", "words", "links"} and len(written) <= 8
    assert llm.sparkContext._jsc.getPersistentRDDs().size() == held


def test_components_of_stars_need_no_round(llm, monkeypatch):
    written, path = [], session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda spark, name: written.append(name) or path(spark, name))
    stars = [(n % 3, n) for n in range(3, 50)]
    found = connected(llm.createDataFrame(stars, "a bigint, b bigint"), "a", "b").collect()
    assert sorted(map(tuple, found)) == [(n, n % 3) for n in range(3, 50)] and written == ["links"]


@pytest.mark.parametrize("links, files", [(components.LINKS_IN_FILE, 1), (8, 5)])
def test_components_write_each_star_into_as_many_files_as_its_links_need(llm, monkeypatch, links, files):
    written, stage = [], components.stage
    monkeypatch.setattr(components, "stage", lambda df, name: written.append(df) or stage(df, name))
    monkeypatch.setattr(components, "LINKS_IN_FILE", links)
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    before = llm.conf.get(small)
    llm.conf.set(small, "false")
    llm.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = connected(llm.createDataFrame([(n, n + 1) for n in range(40)], "a bigint, b bigint"), "a", "b")
        assert sorted(map(tuple, found.collect())) == [(n, 0) for n in range(1, 41)]
    finally:
        llm.conf.set(small, before)
        llm.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(written) > 2 and 1 <= len(found.inputFiles()) <= files
    for df in written[1:]:
        plan = df._jdf.queryExecution().optimizedPlan()
        assert plan.collectLeaves().size() <= 9 and "InMemory" not in plan.toString()


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = near.classes(odd).collect()
    # Two texts under one doc_id are two classes of the same class id.
    assert len(rows) == len(ODD_ROWS) and sum(r.kept for r in rows) == 8 and len({r.class_id for r in rows}) == 7
    assert len({r.class_id for r in rows if r.doc_id in (1, 2, None)}) == 1
    one = near.one_of_each(odd)
    assert one.columns == odd.columns
    assert sorted(r.doc_id for r in one.collect()) == [1, 3, 5, 6, 7, 8, 9, 9]
    assert near.classes(empty).count() == 0 and near.one_of_each(empty).count() == 0


def test_components(llm):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(n, n + 1) for n in range(1000, 1040)]
    found = {r.node: r.root for r in connected(llm.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    root = {n: n for e in edges for n in e}
    for _ in range(len(root)):
        moved = False
        for a, b in edges:
            low = min(root[a], root[b])
            moved |= root[a] != low or root[b] != low
            root[a] = root[b] = low
        if not moved:
            break
    assert {n: found.get(n, n) for n in root} == root


# ---- language model ----------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + ["\n"]


def test_language_model_query(llm, texts, monkeypatch):
    monkeypatch.setattr(language_model, "SHARE_BYTES", 100_000)
    rows = {r.doc_id: r for r in queries.op6_language_model(llm, SMALL).collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    counts = Counter(w for d, t in texts.items() if not held[d] for w in split(t))
    total, known = sum(counts.values()), len(counts)
    better = []
    for d, text in texts.items():
        row, words = rows[d], split(text)
        base = sum(math.log10((counts[w] + 1) / (total + known + 1)) for w in words)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held[d], len(words), total)
        assert row.n_known == sum(counts[w] > 0 for w in words) and row.base_score == pytest.approx(base, rel=1e-9)
        if held[d]:
            better.append((row.score - row.base_score) / row.n_tokens)
    assert np.mean(better) > 0.1


def shares_of(llm, docs, frequent=()):
    """A share of all tokens of some documents, and the state after counting."""
    rows, words = [(i, False, i) for i in range(len(docs))], [language_model.tokens(t) for t in docs]
    block = language_model._block(rows, words, 0, 1, np.array(frequent, np.uint64), pa.int64())
    merged = language_model._merged(pa.Table.from_batches([block]))
    return [language_model.Share.read(b) for b in merged.column("blob").to_pylist() if b is not None][0]


def test_probabilities_sum_to_one(llm):
    share = shares_of(llm, ["the cat sat on the mat", "the dog sat on the cat", "a dog"])
    n, words = len(share.words), share.words
    state = language_model.State(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    state.known, state.discounts, rng = n, (0.6, 0.4), np.random.default_rng(0)
    tables = np.minimum(share.count, 1)
    share.context_customers = np.bincount(share.pair_context, share.count)
    share.context_tables = np.bincount(share.pair_context, tables)
    state.customers = share.context_tables.sum()
    counts, m, parent = language_model.seat_parent(share, state, tables, rng)
    state.tables = m.sum()
    d = state.discounts[1]
    parent = (counts - d * m + (1 + d * state.tables) * state.base) / (1 + state.customers)
    unknown = (1 + d * state.tables) * state.base / (1 + state.customers)
    assert parent.sum() + unknown == pytest.approx(1)
    p = language_model.predictive(share, state, tables, parent)
    for c in set(share.pair_context.tolist()):
        mine = share.pair_context == c
        back = (1 + state.discounts[0] * share.context_tables[c]) / (1 + share.context_customers[c])
        rest = 1 - parent[share.pair_word[mine]].sum()
        assert p[mine].sum() + back * rest == pytest.approx(1)


def test_every_previous_word_is_a_context_and_totals_reach_every_share(llm, texts, monkeypatch):
    """What shares hear about their contexts, against counts of word pairs."""
    monkeypatch.setattr(language_model, "SHARE_BYTES", 100_000)
    docs, heard = llm.createDataFrame([*texts.items(), *((-d, t) for d, t in texts.items())], "doc_id bigint, text string"), []
    round_ = language_model._round

    def listen(written, totals, shares, state, turn):
        if totals is not None:
            heard.append((written, totals))
        return round_(written, totals, shares, state, turn)

    monkeypatch.setattr(language_model, "_round", listen)
    language_model.scores(docs, toxicity.id_check() % 7 == 2).collect()
    pairs = Counter()
    for d, text in texts.items():
        times = sum(zlib.crc32(str(i).encode()) % 7 != 2 for i in (d, -d))
        hashes = language_model.tokens(text)
        before = language_model.context(np.concatenate([[np.uint64(language_model.START)], hashes[:-1]]))
        for pair in zip(before.tolist(), hashes.tolist()):
            pairs[pair] += times
    customers, tables = Counter(), Counter()
    for (before, _), n in pairs.items():
        customers[before] += n
        tables[before] += n > 0
    written, totals = heard[0]
    answers = totals.toArrow()
    found = written.where("blob IS NOT NULL").select("share", "blob").collect()
    assert len(found) > 3
    for number, blob in found:
        share = language_model.Share.read(blob)
        share.hear(answers.filter([n == number for n in answers.column("share").to_pylist()]))
        assert [customers[c] for c in share.contexts.tolist()] == share.context_customers.tolist()
        assert [tables[c] for c in share.contexts.tolist()] == share.context_tables.tolist()
    met = written.where("blob IS NOT NULL").select("share", "blob").groupBy("share").cogroup(totals.groupBy("share"))
    plan = met.applyInArrow(lambda a, b: a.select(["share"]), "share int")._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("FlatMapCoGroups") :].split("applyInArrow")[0].split("FlatMapGroups")[0]
    assert "Bucketed: true" in left and left.count("Exchange hashpartitioning(share") == 1, plan


def test_arrays_are_packed_and_unpacked():
    rng = np.random.default_rng(3)
    arrays = [
        np.sort(rng.integers(0, 1 << 64, 5000, np.uint64)), rng.integers(0, 1 << 64, 300, np.uint64), np.zeros(0, np.uint32),
        np.arange(70000, dtype=np.uint32) // 3, np.array([65535, 0, 7], np.uint16), np.array([-5, 1 << 40]), np.ones(1, np.uint16),
        rng.random(100), np.full(9, (1 << 64) - 1, np.uint64),
    ]
    back = language_model.unpack_arrays(language_model.pack_arrays(arrays))
    assert all(a.dtype == b.dtype and np.array_equal(a, b) for a, b in zip(arrays, back, strict=True))


def test_copies_in_a_block_move_once(llm):
    """A text that stands in a block many times makes one entry for each of its tokens, with the number of its copies."""
    words = [language_model.tokens("a b a c"), language_model.tokens("b a")]
    rows = [(i, i % 5 == 0, 0) for i in range(1000)] + [(1000, False, 1)]
    block = language_model._block(rows, words, 0, 1, np.zeros(0, np.uint64), pa.int64())
    merged = language_model._merged(pa.Table.from_batches([block]))
    share = language_model.Share.read([b for b in merged.column("blob").to_pylist() if b is not None][0])
    assert len(share.doc) == 8 and share.word_count.sum() == 800 * 5 + 3
    assert dict(zip(share.words.tolist(), share.word_count.tolist()))[int(language_model.tokens("a")[0])] == 1601


def test_tables_follow_their_conditional():
    rng = np.random.default_rng(1)
    customers, others, base, d = 5, 3.0, 0.2, 0.5
    drawn = language_model.draw_tables(np.full(40_000, customers), np.full(40_000, others), np.full(40_000, base), d, rng)
    weight = {}

    def seat(sizes, left, w):
        if not left:
            weight[len(sizes)] = weight.get(len(sizes), 0) + w
            return
        for i in range(len(sizes)):
            seat(sizes[:i] + [sizes[i] + 1] + sizes[i + 1 :], left - 1, w * (sizes[i] - d))
        seat([*sizes, 1], left - 1, w * base * (1 + d * (others + len(sizes))))

    seat([], customers, 1.0)
    for t, w in weight.items():
        assert (drawn == t).mean() == pytest.approx(w / sum(weight.values()), abs=0.015)
    many = language_model.draw_tables(np.array([1, 0, 70, 5000]), np.full(4, 100.0), np.full(4, 0.01), d, rng)
    assert many[0] == 1 and many[1] == 0 and 1 <= many[2] <= 70 and 1 <= many[3] < 1000


def test_frequent_words_are_dealt_out_without_changing_counts(llm, texts, monkeypatch):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet")
    monkeypatch.setattr(language_model, "SHARE_BYTES", 100_000)
    often = np.sort(np.array([language_model.END, *language_model.tokens("the of and")[:3]], np.uint64))
    held = toxicity.id_check() % 7 == 2
    plain = {r.doc_id: r for r in language_model.scores(docs, held).collect()}
    monkeypatch.setattr(language_model, "frequent_words", lambda docs, shares: often)
    dealt = {r.doc_id: r for r in language_model.scores(docs, held).collect()}
    for d, row in plain.items():
        assert dealt[d][:5] == row[:5] and dealt[d].base_score == pytest.approx(row.base_score, rel=1e-9)
        assert dealt[d].score == pytest.approx(row.score, rel=0.02)


def test_language_model_of_odd_rows(odd, empty):
    rows = language_model.scores(odd, toxicity.id_check() % 7 == 2).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == sorted((r[0] or 0, len(split(r[1]))) for r in ODD_ROWS)
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert language_model.scores(empty, toxicity.id_check() % 7 == 2).count() == 0


# ---- toxicity ----------------------------------------------------------------------


def test_toxicity_on_held_out_rows(llm):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in llm.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op10_toxicity(llm, sf).collect()]
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    hits, wrong = sum(a and b for a, b in held), sum(b and not a for a, b in held)
    assert hits / sum(a for a, _ in held) > 0.7 and wrong <= 0.01 * len(held)


def toy(n):
    rng = np.random.default_rng(2)
    texts, labels = [], []
    for i in range(n):
        words = [f"{a}{b}" for a, b in zip(rng.choice(["ka", "lo", "mi", "ster"], 40), rng.choice(["ren", "tu", "vo", "dan"], 40))]
        if i % 3 == 0:
            words[rng.integers(40)] = rng.choice(["horrid", "horridly", "horrids"])
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_unseen_misspellings_share_vectors():
    texts, labels = toy(240)
    model = toxicity.train(texts, labels)
    clean = " ".join(texts[1].split() * 20)
    assert model.score(clean + " horrridly " + clean) > model.score(clean + " katu " + clean) + 0.4
    assert model.score("") == model.score(None) == model.share == pytest.approx(1 / 3)
    assert toxicity.train(["a b"], [1]).score("a b") == 1.0 and toxicity.train([], []).score("x") == 0.0


def test_toxicity_of_odd_rows(llm, odd, empty):
    texts, labels = toy(60)
    model = toxicity.train(texts, labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(ODD_ROWS) and len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    kept = toxicity.clean_documents(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r.score < 0.7 for r in rows)
    none = llm.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.fit(odd, none).share == 0.0 and toxicity.fit(empty, none).score("x") == 0.0
    assert toxicity.clean_documents(empty, model).count() == 0


# ---- pipeline ----------------------------------------------------------------------


def test_pipeline_is_its_stages(llm, texts):
    documents = llm.read.parquet(f"{SMALL}/documents.parquet")
    model = toxicity.fit(documents, llm.read.parquet(f"{SMALL}/labels.parquet"))
    left = {d: t for d, t in texts.items() if model.score(t) < 0.7}
    query = {r.doc_id: r.kept for r in queries.op7_quality_rules(llm, SMALL).collect()}
    left = {d: t for d, t in left.items() if query[d]}
    classes = brute_classes(left)
    left = {d: t for d, t in left.items() if classes[d] == d}
    left = {d: pii.replace(t, pii.findings(t, pii.TEST_KEY)) for d, t in left.items()}
    encode = packing.encoder(packing.BYTE_VOCABULARY).encode
    want = {d: encode(t) + b"\1\0\0\0" for d, t in left.items()}
    rows, got = corpus_pipeline.run(llm, SMALL).collect(), {}
    for row in sorted(rows, key=lambda r: r.start):
        got[row.doc_id] = got.get(row.doc_id, b"") + bytes(row.ids)
    assert got == want and len(left) < len(texts)


def test_pipeline_stages_on_odd_rows(llm, odd, empty):
    for docs in (odd, empty):
        kept = docs
        for at, (_, step) in enumerate(corpus_pipeline.STAGES):
            made = corpus_pipeline.stage(step(llm, kept, SMALL), "odd")
            if at < len(corpus_pipeline.STAGES) - 1:
                assert made.columns == docs.columns
                kept = made
        assert {r.doc_id for r in made.collect()} == {r.doc_id for r in kept.collect()}
    assert {r.doc_id for r in quality_rules.kept_documents(odd).collect()} >= {1}
    assert PLAIN


def test_a_crowd_of_copies_of_a_lost_text_is_linked_in_blocks(llm, monkeypatch):
    """Blocks and buckets that share pairs find what all pairs find; every task gives few links."""
    import pyarrow as pa

    rng = np.random.default_rng(11)
    base = rng.integers(0, 1 << 30, 120).astype("<u4")
    words = []
    for copy in range(60):
        text = base.copy() if copy < 45 else rng.integers(0, 1 << 30, 120).astype("<u4")
        text[rng.choice(120, 10, replace=False)] = rng.integers(0, 1 << 30, 10)
        words.append(text)
    keys = [sorted(rng.choice([3, 5, 9], 2, replace=False).tolist()) for _ in words]
    links = []
    for key in (3, 5, 9):
        inside = [i for i in range(60) if key in keys[i]]
        for i, j in ((0, 0), (0, 1), (1, 1)):
            rows = [x for x in inside if x % 2 in (i, j)]
            table = pa.table({
                "key": pa.array([key] * len(rows)), "node": pa.array(rows), "label": pa.array(rows),
                "n_words": pa.array([120] * len(rows)), "block": pa.array([x % 2 for x in rows]),
                "i": pa.array([i] * len(rows)), "j": pa.array([j] * len(rows)),
                "words": pa.array([words[x].tobytes() for x in rows], pa.binary()), "keys": pa.array([keys[x] for x in rows]),
            })
            found = near._compared(table)
            pairs = list(zip(found.column("a").to_pylist(), found.column("b").to_pylist()))
            assert len(pairs) < len(rows) or not rows
            links += pairs
    assert len(set(links)) == len(links) and all(near.alike(words[a], words[b]) for a, b in links)
    root = list(range(60))
    for a, b in links:
        ra, rb = root[a], root[b]
        root = [ra if r == rb else r for r in root]
    assert len(set(root[:45])) == 1 and len(set(root)) == 16
