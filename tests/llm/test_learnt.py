"""Toxicity and language identification: held-out accuracy and edges."""

import random
import zlib

import numpy as np

from fieldloom.llm import language, toxicity
from fieldloom.llm.common import table
from fieldloom.llm.registry import QUERIES

SF = "/root/testdata/sf0.1"


def test_toxicity_held_out(spark):
    rows = {r.doc_id: r for r in QUERIES["op3_toxicity"](spark, SF).collect()}
    assert len(rows) == table(spark, SF, "documents").count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    pairs = [(r.toxic, rows[r.doc_id].predicted) for r in table(spark, SF, "labels").collect()
             if rows[r.doc_id].held_out]
    hit = sum(t and p for t, p in pairs)
    assert hit / sum(p for _, p in pairs) > 0.9  # precision
    assert hit / sum(t for t, _ in pairs) > 0.85  # some labelled documents hold nothing toxic


def test_toxicity_tolerates_insertions(spark, documents):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.fitted(docs, labels)
    clean = "the one and other things are here with them all of this was then said"
    variants = ["you idiot and stupid loser", "you id-iot and stu.pid lo-ser", "you i d i o t and s t u p i d l o s e r",
                "you idi0t and 5tupid l0ser", "you i-d-i-o-t and s.t.u.p.i.d l*o*s*e*r", "YOU IDIOT! STUPID! LOSER!"]
    texts = [clean, None, "", *[f"{clean} {v} {clean}" for v in variants], clean * 30_000]
    got = {r.doc_id: r for r in toxicity.scored(documents(texts), model).collect()}
    assert [got[i].predicted for i in range(len(texts))] == [0, 0, 0, *[1] * len(variants), 0]
    assert toxicity.scored(documents(texts).limit(0), model).count() == 0
    assert toxicity.scored(documents(["idiot"], ids=[None]), model).first().held_out


def test_toxicity_learns_rare_insults(spark, documents):
    rnd = random.Random(5)

    def word(alphabet):
        return "".join(rnd.choice(alphabet) for _ in range(8))

    insults = sorted({word("abcdefghijklmnopqrstuvwxyz") for _ in range(200)})
    clean = sorted({word("abcdefghijklmnopqrstuvwxyz") for _ in range(150)} - set(insults))
    times = [max(4, 400 // (k + 1)) for k in range(len(insults))]  # uneven: 400, 200, 133, ... 4

    def text(*extra):
        words = [rnd.choice(clean) for _ in range(12)] + list(extra)
        rnd.shuffle(words)
        return " ".join(words)

    texts = [text(w) for w, n in zip(insults, times) for _ in range(n)]
    toxic = len(texts)
    texts += [text() for _ in range(toxic)]
    labels = spark.createDataFrame([(i, 1, int(i < toxic)) for i in range(len(texts))],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.fitted(documents(texts), labels)
    probes = [text(w) for w in insults] + [text() for _ in insults]
    got = {r.doc_id: r.predicted for r in toxicity.scored(documents(probes), model).collect()}
    n = len(insults)
    rare = [i for i in range(n) if times[i] < 10]
    assert len(rare) > 100
    assert sum(got[i] for i in rare) > 0.9 * len(rare)
    assert sum(got[i] for i in range(n)) > 0.9 * n
    assert sum(got[n + i] for i in range(n)) < 0.05 * n


def test_landmarks_of_distinct_tokens():
    rnd = random.Random(3)

    def token():
        return bytes([toxicity.EDGE, *(rnd.randint(1, 26) for _ in range(8)), toxicity.EDGE])

    insults, clean = [token() for _ in range(200)], [token() for _ in range(300)]
    seen = [t for k, t in enumerate(insults) for _ in range(max(1, 600 // (k + 1)))]
    weights = toxicity.nystroem_machine(sorted(seen) + [v for t in insults for v in toxicity.disguised(t)], clean)

    def margins(tokens):
        return [sum(weights[f].sum() * worth for _, f, worth in toxicity.sequences(
            np.frombuffer(t, np.uint8), np.zeros(1, np.int64))) for t in tokens]

    top = sorted(margins(clean))[-5]
    assert all(m > top for m in margins(insults))


def test_toxicity_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in toxicity.toxicity(documents(["a b", None]), none).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(i, 1, 0) for i in range(8)] + [(None, 1, 1), (3, None, None)], none.schema)
    assert {r.predicted for r in toxicity.toxicity(documents(["some words"] * 8), one).collect()} == {0}


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in table(spark, sf, "documents").collect()}
    rows = QUERIES["op9_language"](spark, sf).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.99


def test_language_edges(documents):
    rnd = random.Random(1)
    alphabets = {f"l{i}": "".join(rnd.sample("abcdefghijklmnopqrstuvwxyzäöüéèñ", 9)) for i in range(9)}
    texts, langs = [], []
    for i in range(540):
        lang = f"l{i % 9}"
        texts.append(" ".join("".join(rnd.choice(alphabets[lang]) for _ in range(6)) for _ in range(30)))
        langs.append(lang)
    odd = [None, "", "1234 ... ²", "Ⅷ 5", "x" * 400_000]
    docs = documents(texts + odd, langs=langs + [None] * 5)
    got = {r.doc_id: r for r in language.languages(docs).collect()}
    assert [got[540 + i].lang_pred for i in range(4)] == ["und"] * 4 and got[540].score == 0
    held = [i for i in range(540) if got[i].held_out]
    assert sum(got[i].lang_pred == langs[i] for i in held) / len(held) > 0.95
    assert language.languages(docs.limit(0)).count() == 0
    alone = documents(["some text", None, "other"], langs=["en", "en", "en"])
    assert [r.lang_pred for r in language.languages(alone).orderBy("doc_id").collect()] == ["en", "und", "en"]
    assert {r.lang_pred for r in language.languages(documents(["abc"], langs=[None])).collect()} == {"und"}


def test_codewords_differ():
    for n in (2, 3, 6, 7, 40):
        code = language.codewords(n)
        assert len({tuple(w) for w in code.tolist()}) == n


def plain_features(token):
    """Feature -> value of a token by walking over all places."""
    out = {}
    for i in range(len(token)):
        for a, b, c in toxicity.GAPS:
            if i + c < len(token):
                code = token[i] << 18 | token[i + a] << 12 | token[i + b] << 6 | token[i + c]
                f = (code * 2654435761 & 0xFFFFFFFF) >> (32 - toxicity.BITS)
                out[f] = out.get(f, 0) + toxicity.DECAY ** (c + 1)
    return {f: v / float(toxicity.scale(np.array([len(token)]))[0]) for f, v in out.items()}


def test_kernel_and_machine_against_plain_versions():
    """Kernel columns by walking; decisions as those of K(x, L) K(L, L)^-1/2 by eigenvectors."""
    rnd = random.Random(9)
    positive = [bytes([toxicity.EDGE, *(rnd.randint(1, 9) for _ in range(rnd.randint(1, 9))), toxicity.EDGE]) for _ in range(60)]
    positive += positive[:20]
    negative = sorted({bytes([toxicity.EDGE, *(rnd.randint(5, 20) for _ in range(rnd.randint(1, 9))), toxicity.EDGE])
                       for _ in range(80)} - set(positive))
    tokens = [*dict.fromkeys(positive), *negative]
    n = len(tokens) - len(negative)
    kernel = toxicity.Kernel(tokens)
    plain = [plain_features(t) for t in tokens]
    whole = np.array([[sum(v * b.get(f, 0) for f, v in a.items()) for b in plain] for a in plain])
    assert np.allclose(np.stack([kernel.column(i) for i in range(len(tokens))]), whole)
    spread = np.unique(np.linspace(n, len(tokens) - 1, min(toxicity.CLEAN_LANDMARKS, len(negative))).astype(int)).tolist()
    chosen, factor = toxicity.landmarks(kernel, n, spread)
    inner = whole[np.ix_(chosen, chosen)]
    assert np.allclose(factor @ factor.T, whole[:, chosen] @ np.linalg.inv(inner) @ whole[chosen], atol=1e-3)
    held = (factor ** 2).sum(axis=1)[:n]  # every witness near the span
    assert (held >= toxicity.COVERED ** 2 * np.diag(whole)[:n] - 1e-5).all()
    values, vectors = np.linalg.eigh(inner)
    x = whole[:, chosen] @ (vectors / np.sqrt(values)) @ vectors.T
    y = np.array([1.0] * n + [-1.0] * len(negative))
    times = np.array([positive.count(t) for t in tokens[:n]] + [1] * len(negative), float)
    direct = toxicity.machine(x, y, times)
    weights = toxicity.nystroem_machine(positive, negative)
    mine = np.array([sum(v * weights[f] for f, v in p.items()) for p in plain])
    assert np.corrcoef(mine, x @ direct[:-1])[0, 1] > 0.98
    assert (np.sign(mine[:n] + direct[-1]) > 0).mean() > 0.9


def test_many_witnesses_fit_in_bounded_time_and_memory():
    import time
    import tracemalloc
    rnd = random.Random(4)

    def token():
        return bytes([toxicity.EDGE, *(rnd.randint(1, 26) for _ in range(rnd.randint(5, 11))), toxicity.EDGE])

    insults = [token() for _ in range(2000)]
    tracemalloc.start()
    start = time.perf_counter()
    weights = toxicity.nystroem_machine(insults + [v for t in insults for v in toxicity.disguised(t)], [token() for _ in range(2000)])
    took, peak = time.perf_counter() - start, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 90 and peak < 600e6 and (weights != 0).sum() > 10_000
    few, factor = toxicity.landmarks(toxicity.Kernel(insults), len(insults), [], cells=200 * len(insults))
    assert len(few) == 200 and factor.shape == (2000, 200)
