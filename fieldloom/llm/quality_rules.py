"""Quality rules whose cutoffs are certified on labelled documents.

Two fixed rules come first (too short, too repetitive).  Every further rule
rejects a document when a ratio reaches a cutoff.  Cutoffs are tested from
lenient to strict, per stratum (language) and rule: a cutoff is certified when
the exact binomial test rejects "the rule loses more than its share of good
documents".  Testing stops at the first failure (fixed sequence, so no further
correction inside a sequence); strata and rules share the error by Bonferroni
and the allowed loss is divided among the rules.  Of the certified cutoffs the
one with the largest gain is taken (bad documents caught, less ``HARM`` for every
good one lost), the most lenient on ties.  Where nothing is certified, or nothing
gained, the rule rejects nothing in that stratum.

Defined results: a null or empty text has no words and fails the fixed rules;
null languages form a stratum of their own; a document counts as good if all
its label rows with a quality say 1; labels without a document, and documents
without a label, take no part in the calibration.  Repeated rows are judged
each on its own.  Other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.shared import materialize, sized_join

from .common import WORD

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
HARM = 10.0
#: ratio -> cutoffs from lenient to strict
CUTOFFS = {
    "symbol_share": (2.0, 1.5, 1.2, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "repeat_share": (0.45, 0.4, 0.35, 0.3, 0.25, 0.2),
    "upper_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4),
    "mean_word_chars": (40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0),
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "upper_share"]


def repeated_words(words: list[str]) -> int:
    """Words inside a three-word window that occurs at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, free = 0, 0  # words before ``free`` are counted
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered += i + 3 - max(i, free)
            free = i + 3
    return covered


def measure(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    letters = np.count_nonzero(((raw | 32) >= 97) & ((raw | 32) <= 122))
    upper = np.count_nonzero((raw >= 65) & (raw <= 90))
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines),
            upper / letters if letters else 0.0)


@F.pandas_udf(T.StructType([T.StructField(m, T.DoubleType() if m == "upper_share" else T.LongType())
                            for m in MEASURES]))
def _measures(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in text], columns=MEASURES)


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with the measures of the whole text.  Only
    the text goes to Python; marked as not deterministic, lest a filter on the
    measures takes them a second time."""
    return (docs.select(*keep, _measures.asNondeterministic()("text").alias("__m"))
            .select(*keep, "__m.*"))


def base_failed():
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def ratios() -> dict:
    def share(a, b):
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return {"symbol_share": share("n_symbols", "n_words"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "upper_share": F.col("upper_share"),
            "mean_word_chars": share("word_chars", "n_words")}


def stratum():
    return F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("none"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed from the largest term down."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    if k > n * p:  # of no interest here: such a cutoff is never certified
        return 1.0
    log_term = (math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                + k * math.log(p) + (n - k) * math.log1p(-p))
    total, term, j = 0.0, 1.0, k
    while j >= 0 and term > 1e-18 * total:
        total += term
        term *= j * (1 - p) / ((n - j + 1) * p)
        j -= 1
    return min(1.0, math.exp(log_term) * total)


def certified(counts: pd.DataFrame, allowed: float, error: float) -> float | None:
    """Cutoff of one stratum and rule.  ``counts``: level (index of the most
    lenient cutoff that rejects, len(cutoffs) for none), good, bad."""
    rule = counts["rule"].iloc[0]
    grid = CUTOFFS[rule]
    good, bad = np.zeros(len(grid) + 1), np.zeros(len(grid) + 1)
    np.add.at(good, counts["level"].to_numpy(), counts["good"].to_numpy())
    np.add.at(bad, counts["level"].to_numpy(), counts["bad"].to_numpy())
    n, best = int(good.sum()), None
    for j, cutoff in enumerate(grid):
        lost, caught = int(good[:j + 1].sum()), bad[:j + 1].sum()
        if n == 0 or binomial_tail(lost, n, allowed) > error:
            break
        gain = caught - HARM * lost
        if gain > (0 if best is None else best[0]):
            best = (gain, cutoff)
    return None if best is None else best[1]


def calibrate(found: DataFrame, labels: DataFrame, max_loss: float = 0.05,
              error: float = 0.05) -> DataFrame:
    """One row per stratum with the cutoff of each rule (null: rejects nothing).

    ``found`` holds doc_id, lang and the measures.  With probability of at least
    1 - ``error`` no stratum loses more than ``max_loss`` of its good documents
    to the calibrated rules."""
    verdicts = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
                .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("__good")))
    levels = F.array(*[F.struct(
        F.lit(rule).alias("rule"),
        (F.lit(len(CUTOFFS[rule])) - sum((value >= F.lit(c)).cast("int") for c in CUTOFFS[rule])
         ).alias("level")) for rule, value in ratios().items()])
    counts = (found.filter(~base_failed())
              .select("doc_id", stratum().alias("stratum"), levels.alias("__levels"))
              .join(verdicts, "doc_id")
              .select("stratum", "__good", F.explode("__levels").alias("x"))
              .groupBy("stratum", "x.rule", "x.level")
              .agg(F.sum((F.col("__good") == 1).cast("long")).alias("good"),
                   F.sum((F.col("__good") != 1).cast("long")).alias("bad")))
    counts = materialize(counts, "rule-counts")
    tests = len(CUTOFFS) * max(1, counts.select("stratum").distinct().count())
    allowed, each = max_loss / len(CUTOFFS), error / tests

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        cutoff = certified(pdf, allowed, each)
        return pd.DataFrame({"stratum": pdf["stratum"].iloc[:1], "rule": pdf["rule"].iloc[:1],
                             "cutoff": [cutoff]})

    chosen = counts.groupBy("stratum", "rule").applyInPandas(
        choose, "stratum string, rule string, cutoff double")
    return materialize(chosen.groupBy("stratum").pivot("rule", list(CUTOFFS)).agg(
        F.first("cutoff")), "rule-cutoffs")


def judged(found: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``found`` with base_failed and kept."""
    named = cutoffs.select(F.col("stratum").alias("__stratum"),
                           *[F.col(r).alias(f"__cut_{r}") for r in CUTOFFS])
    joined = sized_join(found.withColumn("__stratum", stratum()), named, ["__stratum"], "left")
    fails = F.lit(False)
    for rule, value in ratios().items():
        fails = fails | F.coalesce(value >= F.col(f"__cut_{rule}"), F.lit(False))
    return (joined.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~fails)
            .drop("__stratum", *[f"__cut_{r}" for r in CUTOFFS]))


def quality_verdicts(docs: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """One row per document row: measures, base_failed, kept."""
    found = materialize(measured(docs, ["doc_id", "lang"]), "measures")
    return judged(found, calibrate(found, labels, **limits))


def keep_good(docs: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that pass; texts are measured again rather than moved."""
    found = materialize(measured(docs, ["doc_id", "lang"]), "measures")
    cutoffs = calibrate(found, labels, **limits)
    # the row travels as one struct, so that no column of the caller clashes
    rows = docs.select(F.struct("*").alias("__row"), "lang", "text")
    return judged(measured(rows, ["__row", "lang"]), cutoffs).filter("kept").select("__row.*")
