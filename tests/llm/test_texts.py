"""SimHash groups, quality rules, tiling and mixing against plain Python."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import components, mixing, quality_rules, simhash, tiling
from fieldloom.llm.common import table
from fieldloom.llm.registry import QUERIES

from . import brute

SF = "/root/testdata/sf0.01"


def words(seed, n):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(n)]


# SimHash --------------------------------------------------------------------

def expected_groups(rows):
    prints = [brute.simhash(t) for _, t in rows]
    root = brute.groups(prints)
    first = defaultdict(list)
    for (i, _), p in zip(rows, prints):
        if i is not None:
            first[root[p]].append(i)
    return sorted((i, f"{p:016x}", min(first[root[p]], default=None)) for (i, _), p in zip(rows, prints)
                  if i is not None)


def test_simhash_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = sorted(tuple(r) for r in QUERIES["op5_simhash"](spark, SF).collect())
    assert got == expected_groups(rows)


def test_simhash_edges(documents):
    base = words(1, 60)
    near = [" ".join(base[:i] + [w.upper()] + base[i + 1:]) for i, w in enumerate(base[:5])]
    odd = [" ".join([*base[:58], f"x{i}", "y"]) for i in range(20)]
    texts = [None, "", " \t", "one", "one two", "one two three four", *near, *odd, " ".join(words(2, 90_000)),
             "Ünï cödé x \x85 y", "a\x1cb c d e f", near[0], near[0]]
    docs = documents(texts)
    got = sorted(tuple(r) for r in simhash.simhash_groups(docs).collect())
    assert got == expected_groups(list(enumerate(texts)))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({g[2] for g in got})
    assert simhash.simhash_groups(docs.limit(0)).count() == simhash.keep_one(docs.limit(0)).count() == 0


def test_simhash_keeps_one_of_repeated_rows(documents):
    docs = documents(["a b c d e", "a b c d e", "A B C D E", "other text of its own here", None, None],
                     ids=[3, 3, 5, None, None, None])
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([(3, "a b c d e"), (None, "other text of its own here"), (None, None)], key=str)
    assert {(r.doc_id, r.component_id) for r in simhash.simhash_groups(docs).collect()} == {(3, 3), (5, 3), (None, None)}


@pytest.mark.parametrize("plan_for", [1, 5 << 20, 2 << 30, 2 << 36])
def test_bucket_plans_lose_no_pair(plan_for):
    rnd = random.Random(plan_for)
    for _ in range(300):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), 4):
            b ^= 1 << bit
        assert any(all((a >> s & (1 << n) - 1) == (b >> s & (1 << n) - 1) for s, n in key)
                   for key in simhash.bucket_plan(plan_for))


def test_linked_roots_against_all_pairs():
    rnd = random.Random(5)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    fps = sorted({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for c in centres
                  for _ in range(60)} | {rnd.getrandbits(64) for _ in range(300)})
    group = np.array([rnd.randint(0, 2) for _ in fps])
    order = np.argsort(group, kind="stable")
    roots = simhash.linked_roots(np.array(fps, np.uint64)[order], group[order])
    got = dict(zip((int(f) for f in np.array(fps, np.uint64)[order]), map(int, roots)))
    for g in range(3):
        assert {f: got[f] for f, k in zip(fps, group) if k == g} == brute.groups([f for f, k in zip(fps, group) if k == g])


def test_large_buckets_are_tiled(spark, documents, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 3)
    rows = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    docs = documents([t for _, t in rows], ids=[i for i, _ in rows])
    assert sorted(tuple(r) for r in simhash.simhash_groups(docs).collect()) == expected_groups(rows)


def test_components_of_a_long_path(spark):
    n = 300
    rnd = random.Random(1)
    names = rnd.sample(range(10 * n), n)
    edges = spark.createDataFrame([(names[i], names[i + 1]) for i in range(n - 1)] + [(-5, -9), (-5, -5)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges, "a", "b").collect()}
    assert got == {x: min(names) for x in names} | {-5: -9, -9: -9}
    assert components.components(edges.limit(0), "a", "b").count() == 0


# quality --------------------------------------------------------------------

def test_quality_query(spark):
    whole = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op6_quality_rules"](spark, SF).collect()
    assert len(rows) == len(whole)
    for r in rows:
        assert tuple(r)[1:7] == brute.quality(whole[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_quality_edges(spark, documents):
    texts = [None, "", "\n\n", "a b a b a b", "x\nx\n\x0b\ny y y", "a b c" * 40, " ".join(words(3, 50)), "| " * 70_000]
    docs = documents(texts, langs=[None, "en"] * 4)
    labels = spark.createDataFrame([(0, 1, 0), (0, None, 0), (None, 1, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        got = {r.doc_id: r for r in quality_rules.quality_verdicts(docs, some).collect()}
        for i, t in enumerate(texts):
            want = brute.quality(t)
            assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words,
                    got[i].base_failed) == want
            assert got[i].kept == (not want[-1])
        kept = quality_rules.keep_good(docs, some)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [i for i in got if got[i].kept]
    assert quality_rules.keep_good(docs.limit(0), labels).count() == 0


def test_binomial_tail():
    for n, p in ((30, 0.1), (400, 0.01), (57, 0.3)):
        for k in range(0, int(n * p) + 1):
            want = sum(math.comb(n, j) * p ** j * (1 - p) ** (n - j) for j in range(k + 1))
            assert quality_rules.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9)
    assert quality_rules.binomial_tail(900_000, 10 ** 9, 0.001) < 1e-100


def test_cutoffs_are_certified(spark, documents):
    """Junk full of symbols is rejected where enough good documents vouch for a cutoff."""
    good = [" ".join(words(i, 60)) for i in range(1200)]
    junk = [" ".join(w + "#" for w in words(5_000 + i, 60)) for i in range(200)]
    texts = good + junk + good[:20] + junk[:20]
    langs = ["en"] * 1400 + ["xx"] * 40
    docs = documents(texts, langs=langs)
    labels = spark.createDataFrame([(i, int(i < 1200 or 1400 <= i < 1420), 0) for i in range(1440)],
                                   "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality_rules.quality_verdicts(docs, labels).filter("kept").collect()}
    assert kept == set(range(1200)) | set(range(1400, 1440))  # 20 documents can't vouch for anything


# tiling ---------------------------------------------------------------------

def test_decontamination_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect() if len(r.text) < 4000}
    items = {r.item_id: r.text for r in table(spark, "/root/testdata/sf0.001", "benchmark").collect()}
    got = {(r.doc_id, r.item_id): (r.covered, r.item_words) for r in
           QUERIES["op2_decontamination"](spark, "/root/testdata/sf0.001").collect() if r.doc_id in docs}
    want = {}
    for d, t in docs.items():
        seen = " ".join(tiling.TOKEN.findall(t.lower()))
        for i, item in items.items():
            tokens = tiling.TOKEN.findall(item.lower())
            if any(" ".join(tokens[j:j + 5]) in seen for j in range(len(tokens) - 4)):
                covered, n = brute.coverage(t, item)
                if covered >= 0.5 * n:
                    want[d, i] = (covered, n)
    assert got == want and got


def test_tiles_against_plain_search():
    rnd = random.Random(3)
    for _ in range(60):
        a, b = ([rnd.choice("abc") for _ in range(rnd.randint(5, 40))] for _ in range(2))
        seeds = [(i, j) for i in range(len(a) - 4) for j in range(len(b) - 4) if a[i:i + 5] == b[j:j + 5]]
        if not seeds:
            continue
        at = np.array(seeds)
        found = tiling.tiles(at[:, 0], at[:, 1])
        longest = max(k for i, j in seeds for k in range(5, 41) if a[i:i + k] == b[j:j + k] and i + k <= len(a) and j + k <= len(b))
        assert max(t[2] for t in found) == longest
        used_a = [x for d, _, n in found for x in range(d, d + n)]
        used_b = [x for _, i, n in found for x in range(i, i + n)]
        assert len(set(used_a)) == len(used_a) and len(set(used_b)) == len(used_b)
        assert all(a[d:d + n] == b[i:i + n] for d, i, n in found)


def test_reordered_passages_and_edges(spark, documents):
    w = words(9, 24)
    item, own = " ".join(w), words(77, 300)
    moved = " ".join([*own[:9], *w[12:], *own[9:20], *w[:12], *own[20:]])
    half = " ".join([*own[:9], *w[:11], *own[9:]])
    texts = [moved, half, None, "", item.upper().replace(" ", ", "), " ".join(own), "tiny item here", item, item,
             " ".join(own * 300 + w)]
    bench = spark.createDataFrame([(1, item), (2, "tiny item here"), (3, None), (4, ""), (1, item), (None, " ".join(w[::-1]))],
                                  "item_id long, text string").selectExpr("*", "1 AS pos", "2 AS h")
    docs = documents(texts)
    got = {(r.doc_id, r.item_id): (r.covered, r.tiles) for r in tiling.contaminated(docs, bench).collect()}
    assert got == {(0, 1): (24, 2), (4, 1): (24, 1), (7, 1): (24, 1), (8, 1): (24, 1), (9, 1): (24, 1)}
    clean = tiling.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [1, 2, 3, 5, 6]
    assert tiling.clean_documents(docs, bench.limit(0)).count() == len(texts)
    assert tiling.contaminated(docs.limit(0), bench).count() == 0
    # rows without an id are told apart
    none = documents([moved, " ".join(own)], ids=[None, None])
    assert [r.text for r in tiling.clean_documents(none, bench).collect()] == [" ".join(own)]


def test_large_benchmarks_are_shuffled(spark, documents, monkeypatch):
    before = sorted(map(tuple, QUERIES["op2_decontamination"](spark, "/root/testdata/sf0.001").collect()))
    monkeypatch.setattr(tiling, "BROADCAST_SEEDS", 10)
    assert sorted(map(tuple, QUERIES["op2_decontamination"](spark, "/root/testdata/sf0.001").collect())) == before


def test_diagonals_equal_pairs():
    rnd = random.Random(8)
    for _ in range(60):
        a, b = ([rnd.choice("ab") for _ in range(rnd.randint(5, 60))] for _ in range(2))
        places = [np.array([i for i in range(len(a) - 4) if a[i:i + 5] == b[j:j + 5]], np.int64) for j in range(len(b) - 4)]
        if not sum(map(len, places)):
            continue
        one = tiling.diagonal_runs(places)
        two = tiling.pair_runs(np.concatenate(places), np.repeat(np.arange(len(places)), [len(p) for p in places]))
        assert sorted(zip(*(x.tolist() for x in one))) == sorted(zip(*(x.tolist() for x in two)))
        assert tiling.marked(*one) == tiling.marked(*two)


def test_repetitive_text_tiles_in_bounded_memory(monkeypatch):
    """A million times one word against items that repeat it: millions of seeds, few tiles."""
    import tracemalloc
    texts = ["ha " * 59 + "ha", "ho hi " * 30, "one two three four five six"]
    found = [tiling.window_hashes(t, {}) for t in texts]
    items = tiling.Items(np.repeat(np.arange(3), [len(x) for x in found]), np.concatenate([np.arange(len(x)) for x in found]),
                         np.concatenate(found))
    tracemalloc.start()
    hashes = tiling.window_hashes("ha " * 1_000_000 + "hi ho " * 1000 + "one two three four five", {})
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    assert items.covered(hashes, 0.5) == [(0, 60, 60, 1), (1, 60, 60, 1), (2, 6, 5, 1)]
    assert tracemalloc.get_traced_memory()[1] - before < 400e6
    tracemalloc.stop()
    monkeypatch.setattr(tiling, "PAIRS", 0)
    short = tiling.window_hashes("ha " * 300 + "hi ho " * 100 + "one two three four five", {})
    assert items.covered(short, 0.5) == [(0, 60, 60, 1), (1, 60, 60, 1), (2, 6, 5, 1)]


# mixing ---------------------------------------------------------------------

def test_mixing_query(spark):
    rows = QUERIES["op4_mixing"](spark, SF).collect()
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    sizes = defaultdict(int)
    for d in docs.values():
        sizes[d.source] += len(brute.WORDS.findall(d.text or ""))
    target = brute.mixing_targets(sizes)
    taken = defaultdict(int)
    assert len(rows) == len(docs)
    for r in rows:
        source = docs[r.doc_id].source
        assert r.size == len(brute.WORDS.findall(docs[r.doc_id].text or ""))
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(target[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for s in sizes:
        assert taken[s] == pytest.approx(target[s], rel=0.03)
    assert sorted(rows) == sorted(QUERIES["op4_mixing"](spark, SF).collect())


def test_mixing_edges(documents):
    texts = [None, "", "a b c", "a b c", "d " * 5000, "e f", *[" ".join(words(i, 40)) for i in range(400)]]
    sources = ["z", "z", None, None, "B", "é", *["a", "hot", "hot", "hot"] * 100]
    docs = documents(texts, sources=sources)
    rows = mixing.mixture(docs).collect()
    sizes = defaultdict(int)
    for t, s in zip(texts, sources):
        sizes[s] += len(brute.WORDS.findall(t or ""))
    target = brute.mixing_targets(sizes)
    assert {r.source: pytest.approx(r.target) for r in rows} == target
    assert len(rows) == len(texts) and all(r.taken <= 2 * r.size for r in rows)
    out = mixing.emitted(docs)
    assert out.columns == [*docs.columns, "copy"]
    times = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert {r.doc_id: r.size * times.get(r.doc_id, 0) for r in rows} == {r.doc_id: r.taken for r in rows}
    assert mixing.mixture(docs.limit(0)).count() == mixing.emitted(docs.limit(0)).count() == 0
    assert mixing.mixture(documents(["", None])).agg(F.sum("taken")).first()[0] == 0


def test_many_sources_without_broadcast(documents, monkeypatch):
    docs = documents([" ".join(words(i, 5 + i % 7)) for i in range(300)], sources=[f"s{i % 90}" for i in range(300)])
    before = sorted(map(tuple, mixing.mixture(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 5)
    assert sorted(map(tuple, mixing.mixture(docs).collect())) == before
