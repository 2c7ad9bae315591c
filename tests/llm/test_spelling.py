"""Spelling groups against comparing every word with every other."""

import random
import zlib
from collections import Counter

import pytest

from fieldloom.llm import spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                at = h % len(run)
                counts[run if h % 97 else run[:at] + run[at + 1:]] += 1
                run = ""
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    out = {}
    for w, n in words.items():
        links = [x for x in words if near(w, x)]
        best = min(links, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = [form, None, n, len(links), words.get(form)]
    for w, row in out.items():
        row[1] = w
        while out[row[1]][0] is not None:
            row[1] = out[row[1]][0]
    return {w: tuple(r) for w, r in out.items()}


def rows_of(docs):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_groups(docs).collect()}


def edited(rnd, word, letters):
    at, kind = rnd.randrange(len(word) + 1), rnd.randrange(3)
    c = rnd.choice(letters)
    return word[:at] + (c if kind else "") + word[at + (kind != 1):]


def texts_of(rnd, n, letters, spread):
    roots = ["".join(rnd.choice(letters) for _ in range(rnd.randint(5, 13))) for _ in range(n)]
    words = []
    for root in roots:
        words += [root] * rnd.choice((3, 8, 40))
        w = root
        for _ in range(spread):
            w = edited(rnd, rnd.choice((root, w)), letters)
            words += [w] * rnd.choice((1, 3, 4, 9))
    rnd.shuffle(words)
    return [" ".join(words[i:i + 40]) for i in range(0, len(words), 40)]


@pytest.mark.parametrize("seed,letters", [(1, "abcdefghijklmnopqrstuvwxyzéÿÀ"), (2, "abAB"), (3, "ab")])
def test_equal_to_all_pairs(spark, documents, seed, letters):
    """Few letters make words repeat their grams and hide behind each other."""
    rnd = random.Random(seed)
    docs = documents(texts_of(rnd, 60 if seed == 1 else 25, letters, 6))
    assert rows_of(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("longest", [2, 3, 6])
def test_no_pair_is_lost_whatever_the_dictionary(spark, longest):
    rnd = random.Random(longest)
    words = set()
    for t in texts_of(rnd, 40, "abcn", 5) + ["banana bananana banan aaaaa aaaaaa ababab abababa"]:
        words |= {w for w in t.split() if len(w) >= 5}
    words = sorted(words)
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = spelling.near_words(table, longest, bound=60).collect()
    want = {(a, b) for i, a in enumerate(words) for b in words[i + 1:] if near(a, b)}
    assert {tuple(sorted((r.a, r.b))) for r in got} == want and len(got) == len(want)


def test_bounds_hold_for_every_edit():
    """No edit changes more grams than the bound says, at their place or moved by one."""
    rnd = random.Random(11)
    letters = "abc"
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(5, 9))) for _ in range(300)}
    counts = Counter(g for w in words for s in [f"\x02{w}\x03"]
                     for g in {s[i:i + q] for q in range(2, 6) for i in range(len(s) - q + 1)})
    grams = {g: n for g, n in counts.items() if len(g) == 2 or counts[g[:-1]] > 9}
    for longest in (3, 4, 5):
        known = {g: n for g, n in grams.items() if len(g) <= longest}
        inner = spelling.suffixes(known, longest)

        def kept_of(w):
            s = f"\x02{w}\x03"
            kept, read = spelling.decomposed(s, known, longest)
            return {(s[p:e], p) for p, e in kept}, spelling.affected(s, kept, read, inner, longest)

        for w in sorted(words)[:60]:
            own, bound = kept_of(w)
            for at in range(len(w) + 1):
                for c in letters + "z":
                    for other, moved in ((w[:at] + c + w[at:], 1), (w[:at] + c + w[at + 1:], 0), (w[:at] + w[at + 1:], -1)):
                        there, _ = kept_of(other)
                        lost = sum(1 for g, p in own if (g, p) not in there and (g, p + moved) not in there)
                        assert lost <= bound


def test_edges(spark, documents):
    assert rows_of(documents([])) == {}
    assert rows_of(documents([None, "", "1 2 3", "abc abc abc"])) == {}
    texts = ["House house HOUSE houses houses houses ÀBÇDÉ ÀBÇDÉ ÀBÇDÉ"] * 2 + ["a" * 300_000] * 3 + [None]
    docs = documents(texts, ids=[1, 1, 2, 3, None, None])
    assert rows_of(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
