"""Spelling variants of words by a variable-length gram index.

Words (runs of letters) are counted over all texts.  Two words are near if they
differ by exactly one inserted, deleted or replaced code point.  A word's form is its
most frequent near word, if that is at least twice as frequent; following forms leads to
the root.

Gram dictionary: the grams (2 to ``LONGEST`` code points, with word borders) are counted over
the words; a gram is extended only where more than ``limit`` words hold it, so that the
lists of frequent short grams are replaced by shorter ones.  The limit is doubled until
the dictionary holds ``DICTIONARY`` grams at most, which bounds what is broadcast.  A word
falls into the longest dictionary gram at each position, less those inside an earlier one.

Affected grams: an edit at a place can change only grams that were chosen by
reading that place, and swallow grams to its right that a longer gram of the
dictionary may cover.  The largest number over all places is the word's bound; of a
word's grams all but that many are found, at the same position or shifted by one, in any near
word.  So two near words share one of the rarest bound + 1 grams of either side: only
these lists are merged, pairs are cut by the bounds of both sides (a bitmap of
grams) and verified by their edit distance.  Words whose bound is all their grams meet words of
the same sort once more with a dictionary of shorter grams; with grams of two every word
of three or more code points keeps some.

Defined results: null and empty texts hold no words; repeated rows count each; rows
without doc_id take part like any other (their id is written as an empty text); ties between near
words go to the smallest in code-point order; an empty table gives no rows.  Other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.shared import fits, materialize

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}
THINNED = 97           # one run in so many loses a letter (its document's hash decides)
MIN_LENGTH = 5
MIN_COUNT = 3
SHORTEST, LONGEST = 2, 5
DICTIONARY = 1 << 18   # grams of at most five code points: some 20 MB in a worker
FIRST_LIMIT = 4
COUNTED = 200_000      # words a task holds before it hands on its counts
START, STOP = "\x02", "\x03"
BROADCAST_FORMS = 500_000  # pairs of short words; more are joined by a shuffle


def thinned(doc_id: int | None, run: str) -> str:
    """The run, less one letter where the hash of document and run says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % THINNED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words of all texts; counted in the tasks first."""
    def run(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for raw, n in Counter(RUN.findall(text or "")).items():
                    word = thinned(doc_id, raw.translate(LOWER))
                    if len(word) >= min_length:
                        counts[word] += n
                if len(counts) >= COUNTED:
                    yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())})
                    counts.clear()
        if counts:
            yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())})

    parts = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def gram_counts(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """gram, n: in how many words each gram stands."""
    def run(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                s = START + word + STOP
                counts.update({s[i:i + q] for q in range(SHORTEST, longest + 1) for i in range(len(s) - q + 1)})
                if len(counts) >= COUNTED:
                    yield pa.RecordBatch.from_pydict({"gram": list(counts), "n": list(counts.values())})
                    counts.clear()
        if counts:
            yield pa.RecordBatch.from_pydict({"gram": list(counts), "n": list(counts.values())})

    return (words.select("word").mapInArrow(run, "gram string, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")))


def gram_dictionary(words: DataFrame, longest: int = LONGEST, bound: int = DICTIONARY) -> dict[str, int]:
    """The pruned dictionary with the number of words that hold each gram.

    Grams of ``SHORTEST`` belong to it where they are frequent enough to fit: the
    others take their place anyway, and count as rarest."""
    grams = materialize(gram_counts(words, longest), "grams")
    parents = grams.select(F.col("gram").alias("parent"), F.col("n").alias("held"))
    longer = materialize(
        grams.filter(F.length("gram") > SHORTEST)
        .withColumn("parent", F.expr("substr(gram, 1, length(gram) - 1)"))
        .join(parents, "parent").select("gram", "n", "held"), "longer-grams")
    limits = [FIRST_LIMIT << i for i in range(40)]
    sizes = longer.agg(*[F.count_if(F.col("held") > x).alias(f"s{i}") for i, x in enumerate(limits)]).first()
    limit = next(x for i, x in enumerate(limits) if sizes[i] <= bound)
    short = grams.filter(F.length("gram") == SHORTEST).orderBy(F.desc("n"), "gram").limit(bound)
    kept = longer.filter(F.col("held") > limit).select("gram", "n").unionByName(short).toArrow()
    return dict(zip(kept["gram"].to_pylist(), kept["n"].to_pylist()))


def suffixes(grams: dict[str, int], longest: int) -> set[str]:
    """What may follow the first code points of a longer gram."""
    return {g[a:] for g in grams if SHORTEST < len(g) <= longest for a in range(1, len(g))}


def decomposed(s: str, grams: dict[str, int], longest: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Variable grams of ``s`` as (start, stop), and the last place that was read to
    choose the gram of each position."""
    kept, read, far = [], [], -1
    for p in range(len(s) - SHORTEST + 1):
        e = p + SHORTEST
        while e < len(s) and e - p < longest and s[p:e + 1] in grams:
            e += 1
        read.append(min(e, p + longest - 1))
        if e > far:
            kept.append((p, e))
            far = e
    return kept, read


def affected(s: str, kept: list[tuple[int, int]], read: list[int], inner: set[str], longest: int) -> int:
    """The most grams of ``kept`` that one edit between the borders can change."""
    worst, last, starts = 0, len(s) - 1, [p for p, _ in kept]
    for i in range(1, last + 1):
        at = bisect_left(starts, i)  # only grams that begin near the edit can be changed
        before = sum(1 for p in starts[bisect_left(starts, i - longest):at] if read[p] >= i)
        here = int(at < len(starts) and starts[at] == i)
        # replaced or deleted at i; inserted in front of i
        edits = [(at, i, before)] + ([(at + here, i + 1, before + here)] if i < last else [])
        for first, cut, n in edits:
            for k in range(first, len(kept)):
                e = kept[k][1]
                if e - cut >= longest or s[cut:e] not in inner:
                    break
                n += 1
            worst = max(worst, n)
    return worst


def signatures(words: DataFrame, grams: dict[str, int], longest: int) -> DataFrame:
    """word, n, len, bound, spare (grams that any near word keeps, 0: none is sure), mask
    (bitmap of its grams), probes (gram and position of the rarest bound + 1 grams)."""
    shared = words.sparkSession.sparkContext.broadcast({g: n for g, n in grams.items() if len(g) <= longest})

    def run(batches):
        known = shared.value
        inner = suffixes(known, longest)
        for batch in batches:
            out = {c: [] for c in ("len", "bound", "spare", "mask", "probes")}
            for word in batch.column("word").to_pylist():
                s = START + word + STOP
                kept, read = decomposed(s, known, longest)
                bound = affected(s, kept, read, inner, longest)
                ranked = sorted((known.get(s[p:e], 0), s[p:e], p) for p, e in kept)
                mask = 0
                for _, g, _ in ranked:
                    mask |= 1 << (zlib.crc32(g.encode()) & 63)
                out["len"].append(len(word))
                out["bound"].append(bound)
                out["spare"].append(max(0, len(kept) - bound))
                out["mask"].append(mask - (mask >> 63 << 64))
                out["probes"].append([{"gram": g, "at": p} for _, g, p in ranked[:bound + 1]])
            yield pa.RecordBatch.from_pydict(
                {"word": batch.column("word"), "n": batch.column("n")} | out, schema=arrow)

    arrow = pa.schema([("word", pa.string()), ("n", pa.int64()), ("len", pa.int32()), ("bound", pa.int32()),
                       ("spare", pa.int32()), ("mask", pa.int64()),
                       ("probes", pa.list_(pa.struct([("gram", pa.string()), ("at", pa.int32())])))])
    return words.select("word", "n").mapInArrow(
        run, "word string, n long, len int, bound int, spare int, mask long, "
             "probes array<struct<gram: string, at: int>>")


def merged_lists(signed: DataFrame) -> DataFrame:
    """a, b, n_a, n_b of near words that share a probe.  Lists are keyed by gram,
    position and length, so they hold words that fit the position."""
    rows = signed.select("word", "n", "len", "bound", "mask", F.explode("probes").alias("probe"))

    def keyed(shift: Column, length: Column) -> Column:
        return F.xxhash64(F.col("probe.gram"), F.col("probe.at") - shift, length)

    cols = ("word", "n", "bound", "mask")
    base = rows.select(*cols, keyed(F.lit(0), F.col("len")).alias("list"))
    # one longer: a gram left of the edit keeps its place, one to the right has moved by one
    longer = rows.select(*cols, F.explode(F.array(*[keyed(F.lit(d), F.col("len") - 1) for d in (0, 1)]))
                         .alias("list"))
    found = []
    for left in (base, longer):
        a, b = left.alias("a"), base.alias("b")
        ab, ba = (F.bit_count(F.col(f"{x}.mask").bitwiseAND(F.bitwise_not(f"{y}.mask"))) for x, y in ("ab", "ba"))
        on = (F.col("a.list") == F.col("b.list")) & (ab <= F.col("a.bound")) & (ba <= F.col("b.bound"))
        if left is base:
            on = on & (F.col("a.word") < F.col("b.word"))
        found.append(a.join(b, on & (F.levenshtein("a.word", "b.word", 1) == 1)).select(
            F.col("a.word").alias("a"), F.col("b.word").alias("b"), F.col("a.n").alias("n_a"),
            F.col("b.n").alias("n_b")))
    return found[0].unionByName(found[1])


def near_words(words: DataFrame, longest: int = LONGEST, bound: int = DICTIONARY) -> DataFrame:
    """a, b, n_a, n_b: every pair of near words of ``words`` (word, n) once."""
    grams = gram_dictionary(words, longest, bound)
    found, todo = [], words
    for most in range(longest, SHORTEST - 1, -1):
        signed = materialize(signatures(todo, grams, most), "signatures")
        found.append(merged_lists(signed))
        todo = signed.filter("spare = 0").select("word", "n")
        if most > SHORTEST and todo.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root from word, form (null: none) by doubling the steps; counts at least
    double along forms, so few rounds are left."""
    now = materialize(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("above"))
        step = now.join(F.broadcast(up) if fits(up, BROADCAST_FORMS) else up, "root", "left")
        after = materialize(step.select("word", F.coalesce("above", "root").alias("root"),
                                        F.col("above").isNotNull().alias("moved")), "roots")
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def spelling_groups(docs: DataFrame, **limits) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs``."""
    words = materialize(word_counts(docs, **limits), "words")
    pairs = materialize(near_words(words), "near-words")
    sides = pairs.select(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("m"), F.col("b").alias("form")).alias("o"))
    sides = sides.unionByName(pairs.select(
        F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("m"), F.col("a").alias("form")).alias("o")))
    best = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("o").alias("o"))
    strong = -F.col("o.m") >= 2 * F.col("n")
    forms = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, F.col("o.form")).alias("form"), F.when(strong, -F.col("o.m")).alias("form_n")), "forms")
    return forms.join(roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
