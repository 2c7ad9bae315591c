"""Language identification with error-correcting output codes.

Languages get codewords: all splits of the languages in two for up to six of them,
otherwise random words as far apart as found.  A binary classifier per bit tells the
languages with a one from those with a zero by letter trigrams (hashed; log-odds
of their smoothed frequencies).  Decoding weighs the loss of each bit by how well its
classifier does on the language in question, and takes the codeword of the
smallest loss; ``ambiguous`` tells that the second is nearly as small, or that the
bits lie farther from the word than the code corrects.

The model is fitted on ``DOCS_PER_LANGUAGE`` documents of each language at most (the
documents with the smallest hashes, by share), those above ``MAX_FIT_CHARS`` left out;
all documents are predicted from their whole text.

Defined results: a null text, or one without a letter, is ``und`` with score 0; rows
without doc_id count as held out; without any language to learn all is ``und``; with a
single one every text with letters gets it.  Repeated rows are judged each on its
own; other columns are ignored.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.shared import fits, materialize

from .common import map_rows

FOLDS, HELD_OUT = 4, 2
DOCS_PER_LANGUAGE = 3_000
MAX_FIT_CHARS = 200_000
BROADCAST_LANGUAGES = 10_000  # rows of some 50 bytes; more are joined by a shuffle
DIMS = 1 << 13
ROWS = 128           # documents taken into one matrix
EVIDENCE = 60        # trigrams after which more text adds no certainty
MARGIN = 0.2         # score lead below which a decision is ambiguous
UNKNOWN = "und"
#: ASCII bytes other than letters become blanks
LETTERS_ONLY = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


def held_out():
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT, F.lit(True))


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-case letters, blanks around words included."""
    words = text.lower().encode("utf-8", "replace").translate(LETTERS_ONLY).split()
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - 13)


def counted(texts: list[str | None]) -> np.ndarray:
    return np.stack([np.bincount(trigrams(t or ""), minlength=DIMS) for t in texts]).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """n codewords of -1 and 1."""
    if n < 2:
        return np.zeros((n, 0), np.float32)
    if n <= 6:  # every split once: the first language is always a one
        rest = [w for w in product((1, -1), repeat=n - 1) if -1 in w]
        return np.array([(1, *w) for w in rest], np.float32).T
    bits, best = 8 * int(np.ceil(np.log2(n))), None
    for seed in range(64):
        words = np.random.default_rng(seed).choice(np.array([-1, 1], np.float32), (n, bits))
        words = words[:, np.abs(words.sum(axis=0)) < n]  # a bit all share tells nothing
        apart = (words.shape[1] - (words @ words.T)[np.triu_indices(n, 1)]).min() / 2
        if best is None or apart > best[0]:
            best = (apart, words)
    return best[1]


class Model:
    """Languages, code, bit classifiers and the weights of decoding."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.code = languages, codewords(len(languages))
        share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True) if len(counts) else counts
        self.bits = np.zeros((DIMS, self.code.shape[1]), np.float32)
        for b in range(self.code.shape[1]):
            one = self.code[:, b] > 0
            self.bits[:, b] = np.log(share[one].mean(axis=0)) - np.log(share[~one].mean(axis=0))
        self.weights = np.ones_like(self.code)

    def outputs(self, counts: np.ndarray) -> np.ndarray:
        n = counts.sum(axis=1, keepdims=True)
        return counts @ self.bits / np.maximum(n, 1) * np.minimum(n, EVIDENCE)

    def weigh(self, right: np.ndarray) -> None:
        """``right``: share of a language's documents a bit gets right."""
        self.weights = right / np.maximum(right.sum(axis=1, keepdims=True), 1e-9) * right.shape[1]

    def decode(self, outputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score, ambiguous."""
        loss = np.stack([(np.logaddexp(0, -outputs * word) * weight).mean(axis=1)
                         for word, weight in zip(self.code, self.weights)], axis=1)
        odds = np.exp(loss.min(axis=1, keepdims=True) - loss)
        odds /= odds.sum(axis=1, keepdims=True)
        best = odds.argmax(axis=1)
        lead = np.sort(odds, axis=1)
        wrong = (np.sign(outputs) != self.code[best]).sum(axis=1)
        apart = (self.code.shape[1] - (self.code @ self.code.T)[np.triu_indices(len(self.code), 1)]).min() / 2
        return best, odds[np.arange(len(best)), best], (
            (lead[:, -1] - lead[:, -2] < MARGIN) | (wrong > (apart - 1) // 2))


def sampled(docs: DataFrame, per_language: int) -> DataFrame:
    """lang, text of the documents to learn from."""
    known = docs.filter(F.col("lang").isNotNull() & ~held_out()
                        & (F.char_length("text") <= MAX_FIT_CHARS)).select("doc_id", "lang", "text")
    sizes = known.groupBy("lang").count().withColumnRenamed("lang", "__lang")
    # a row per language: without the broadcast the join would move every text by its language
    sizes = F.broadcast(sizes) if fits(sizes, BROADCAST_LANGUAGES) else sizes
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    return (known.join(sizes, F.col("lang") == F.col("__lang"))
            .filter(place * F.col("count") < per_language).select("lang", "text"))


def summed(sample: DataFrame, per_batch, width: int) -> tuple[list[str], np.ndarray]:
    """Adds up ``per_batch(texts, lang)`` (a row of ``width`` numbers) by language."""
    def run(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = np.array(batch.column("text").to_pylist(), object)
            names, rows = [], []
            for lang in sorted(set(langs)):
                of = texts[langs == lang]
                names.append(lang)
                rows.append(sum(per_batch(of[i:i + ROWS].tolist(), lang) for i in range(0, len(of), ROWS)))
            yield pa.RecordBatch.from_pydict({"lang": names, "sums": [r.astype(float) for r in rows]},
                                             schema=pa.schema([("lang", pa.string()),
                                                               ("sums", pa.list_(pa.float64()))]))

    rows = (sample.mapInArrow(run, "lang string, sums array<double>")
            .select("lang", F.posexplode("sums").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
            .collect())  # languages x width numbers, whatever the corpus
    names = sorted({r.lang for r in rows})
    total = np.zeros((len(names), width))
    for r in rows:
        total[names.index(r.lang), r.i] = r.x
    return names, total


def fitted(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> Model:
    sample = materialize(sampled(docs, per_language), "language-sample")
    model = Model(*summed(sample, lambda texts, lang: counted(texts).sum(axis=0), DIMS))
    if model.code.shape[1] == 0:
        return model
    index = {lang: i for i, lang in enumerate(model.languages)}

    def right(texts: list[str], lang: str) -> np.ndarray:
        hits = np.sign(model.outputs(counted(texts))) == model.code[index[lang]]
        return np.append(hits.sum(axis=0), len(texts))

    _, sums = summed(sample, right, model.code.shape[1] + 1)
    model.weigh(sums[:, :-1] / sums[:, -1:])
    return model


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous: one row per document row."""
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")

    def run(cols: dict) -> dict:
        texts = cols["text"].to_pylist()
        lang, score, unsure = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model.languages else []
        for at in range(0, len(known), ROWS):
            some = known[at:at + ROWS]
            if model.code.shape[1] == 0:
                best, odds, flags = [0] * len(some), [1.0] * len(some), [False] * len(some)
            else:
                best, odds, flags = model.decode(model.outputs(counted([texts[i] for i in some])))
            for i, b, o, f in zip(some, best, odds, flags):
                lang[i], score[i], unsure[i] = model.languages[int(b)], float(o), bool(f)
        return {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "lang_pred": lang, "score": score,
                "ambiguous": unsure}

    schema = rows.select("doc_id", "held_out").schema.add("lang_pred", "string").add(
        "score", "double").add("ambiguous", "boolean")
    return map_rows(rows, run, schema)


def languages(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    return predicted(docs, fitted(docs, per_language))
