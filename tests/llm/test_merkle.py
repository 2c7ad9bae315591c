"""The Merkle manifest against a plain tree."""

import hashlib
import zlib

import numpy as np
import pytest

from fieldloom.llm import merkle, sha_states


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    out = []
    for v in row:
        s = None if v is None else str(v)
        out.append("-" if s is None else f"{len(s.encode())}:{s}")
    return h(*out)


def climb(nodes, at, value):
    """Top of the tree over ``nodes`` with ``value`` at ``at``, and the siblings passed."""
    proof = []
    nodes = list(nodes)
    nodes[at] = value
    while len(nodes) > 1:
        run = nodes[at // 3 * 3:at // 3 * 3 + 3]
        proof += [x for i, x in enumerate(run) if i != at % 3]
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        at //= 3
    return nodes[0], proof


def brute(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    tops = {}
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in by:
        by[s].sort(key=lambda x: x[:3])
        leaves = [x[2] for x in by[s]]
        tops[s] = climb(leaves, 0, leaves[0])[0]
    out = []
    for at, s in enumerate(order):
        leaves = [x[2] for x in by[s]]
        for i, (_, _, own, r) in enumerate(by[s]):
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            root, up = climb([tops[x] for x in order], at, tops[s])
            inner, proof = climb(leaves, i, leaf((*r[:4], text)))
            folded = climb([tops[x] for x in order], at, inner)[0]
            out.append((r[0], own, tops[s], root, h(*proof, *up), folded, folded == root))
    return sorted(out, key=str)


def rows_of(spark, docs, depth):
    got = merkle.proof_digest(merkle.audit(docs, depth)).collect()
    return sorted([tuple(r) for r in got], key=str)


def test_hash_states_are_sha256():
    rng = np.random.default_rng(5)
    digests = rng.integers(0, 256, (7, 32), dtype=np.uint8)
    state = sha_states.absorbed(sha_states.fresh(7), sha_states.hex_block(digests))
    resumed = sha_states.as_state(sha_states.as_bytes(state))
    two = sha_states.finished(sha_states.absorbed(resumed, sha_states.hex_block(digests[::-1])), np.full(7, 2))
    assert [x.tobytes().hex() for x in two] == [
        h(a.tobytes().hex(), b.tobytes().hex()) for a, b in zip(digests, digests[::-1])]


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_equal_to_a_plain_tree(spark, documents, depth):
    """Blocks of 3, 9 and 729 rows: several layers, odd runs, ties and nulls."""
    texts = [f"line {i}\nnext" if i % 3 else f"line {i}" for i in range(41)] + [None, "", "\n\n", "same\n", "same\n", "ü\n"]
    sources = ["a"] * 25 + ["b"] * 11 + ["Ä", None, None, "c", "c", "a", "b", "", "d", "d", "a"]
    ids = [97 * i % 89 for i in range(40)] + [5, 7, None, 11, 12, 12, 13]
    langs = ["en", None] * 23 + ["de"]
    docs = documents(texts, langs, sources, ids)
    want = brute([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()])
    assert rows_of(spark, docs, depth) == want


def test_edges(spark, documents):
    assert rows_of(spark, documents([]), 6) == []
    (only,) = rows_of(spark, documents(["x\ny"], ids=[4]), 6)
    assert only[1] == only[2] == only[3] and only[4] == h("")
    docs = documents(["long " * 400_000, "b"])
    assert rows_of(spark, docs, 6) == brute([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()])


def test_folding_reads_states_and_right_siblings_only(spark, documents):
    """Left siblings are never looked at: the kept state stands for them."""
    from pyspark.sql import functions as F
    docs = documents([f"text {i}" for i in range(30)])
    found = merkle.manifest(merkle.leaves(docs), 2)
    last = found.orderBy(F.desc("doc_id")).limit(1).collect()[0]
    shape = last["shape"]
    assert [x % 4 for x in shape] == [2, 0, 0, 1]  # 29 -> 9 -> 3 -> 1 -> 0
    left = [i for i, x in enumerate(shape) if x % 4]
    spoilt = bytearray(last["siblings"])
    at = 0
    for level, x in enumerate(shape):
        count, slot = divmod(x, 4)
        for i in range(slot):
            spoilt[32 * (at + i):32 * (at + i + 1)] = b"\0" * 32
        at += count - 1
    assert left and bytes(spoilt) != last["siblings"]
    row = spark.createDataFrame([(bytearray(last["leaf"]), bytearray(last["shape"]), bytearray(last["states"]),
                                  spoilt)], "leaf binary, shape binary, states binary, siblings binary")
    assert merkle.folded(row, "leaf").first()["folded_root"] == last["root"]
