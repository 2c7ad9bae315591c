"""BPE encoding and decoding with a pair occurrence index.

Vocabulary, merges and added tokens come from a tokenizer file (byte-level BPE), which
the driver reads and broadcasts.  A text is cut at added tokens, then into words by
the byte-level pattern.  In each partition the distinct words that are not
coded yet are laid out in one array of symbols, and an index maps each pair to all its
positions.  The pairs' ranks are worked off in ascending order: at each
position that still holds the pair, from left to right, it becomes one symbol, and
the new pairs with its neighbours enter the lists of their ranks.  The first
``REMEMBERED`` words stay coded for the worker's next partitions.

Defined results: null texts give no ids and an empty text when decoded; repeated
rows are coded each; texts of any length are coded whole (an index over a batch holds the
distinct words of the batch).  Ids that the vocabulary lacks raise an error.  Other
columns are kept by ``encoded`` and ``decoded``, which add ``ids`` and ``decoded``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import broadcast_tables, revived

REMEMBERED = 1 << 18   # words of at most LONGEST_REMEMBERED bytes
LONGEST_REMEMBERED = 64
BATCH_WORDS = 1 << 19  # words gathered before the new ones are coded
ROWS = 1 << 10         # texts worked on at once
INDEXED = 1 << 12       # new words under one index: its lists stay in the processor's cache
MOST_ENTRIES = 1 << 21  # vocabulary entries a broadcast may hold
# the byte-level pattern (letters and digits first: no alternative before them can match where
# they do); white space is Unicode's, without the separators 1C to 1F
WORDS = (r" ?\p{L}+| ?\p{N}+|'(?:s|t|re|ve|m|ll|d)| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def narrow_words() -> re.Pattern:
    """The same pattern for texts of code points below 256, with plain classes, which the
    standard library's engine reads much faster."""
    space, letter, digit = ("".join(re.escape(chr(c)) for c in range(256) if regex.fullmatch(kind, chr(c)))
                            for kind in (r"\p{White_Space}", r"\p{L}", r"\p{N}"))
    return re.compile(rf" ?[{letter}]+| ?[{digit}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{space}{letter}{digit}]+"
                      rf"|[{space}]+(?![^{space}])|[{space}]+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable ones for themselves, the
    others in order from 256."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tables of a tokenizer file: ids of bytes, ranks of pairs of ids, bytes of ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex", True) or spec.get("normalizer")
                or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix",
                                              "byte_fallback", "ignore_merges"))):
            raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
        if len(model["vocab"]) > MOST_ENTRIES:
            raise ValueError(f"{path} has more than {MOST_ENTRIES} entries")
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has added tokens with rules about their neighbours")
        letters, ids = byte_letters(), model["vocab"]
        if not all(c in ids for c in letters):
            raise ValueError(f"{path} lacks some bytes")
        self.byte_ids = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.byte_ids[b] = ids[c]
        self.text = {i: bytes(letters[c] for c in token) for token, i in ids.items()
                     if all(c in letters for c in token)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text |= {i: t.encode() for t, i in self.added.items()}
        self.size = max(ids.values()) + 1
        self.merges: list[tuple[int, int, int]] = []   # by rank: left, right, the two as one
        self.rank_of: dict[int, int] = {}              # left * size + right -> rank
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.append((ids[left], ids[right], ids[left + right]))
            self.rank_of.setdefault(ids[left] * self.size + ids[right], rank)
        self.keys = np.array(sorted(self.rank_of), np.int64)
        self.known: dict[str, tuple[int, ...]] = {}    # words coded before, by whoever uses these tables
        self.key_ranks = np.array([self.rank_of[k] for k in self.keys.tolist()], np.int64)


def coded(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after the other, and how many each word has, by one pair
    index over all of them."""
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    sizes = np.array([len(w) for w in words])
    ends = np.cumsum(sizes + 1) - 1
    laid = np.full(int(ends[-1]) + 1, -1, np.int64)    # -1 stands behind each word
    inside = np.ones(len(laid), bool)
    inside[ends] = False
    laid[inside] = v.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    pair = np.where(inside[:-1] & inside[1:], laid[:-1] * v.size + laid[1:], -1)
    place = np.minimum(np.searchsorted(v.keys, pair), len(v.keys) - 1)
    hits = np.flatnonzero(v.keys[place] == pair)
    ranks = v.key_ranks[place[hits]]
    order = np.argsort(ranks, kind="stable")
    active, cuts = np.unique(ranks[order], return_index=True)
    # rank -> positions of its pair's left symbol, in order
    index = dict(zip(active.tolist(), (x.tolist() for x in np.split(hits[order], cuts[1:]))))
    active = active.tolist()                           # sorted, so a heap
    symbol, after = laid.tolist(), list(range(1, len(laid) + 1))
    before = list(range(-1, len(laid) - 1))            # the place before the first is the last: -1
    rank_of, size = v.rank_of.get, v.size
    while active:
        rank = heappop(active)
        left, right, whole = v.merges[rank]
        positions = index.pop(rank)
        positions.sort()
        for at in positions:
            nxt = after[at]
            if symbol[at] != left or symbol[nxt] != right:
                continue                               # the pair went into another one
            symbol[at], symbol[nxt] = whole, -2
            after[at] = far = after[nxt]
            before[far] = at
            back = before[at]
            new = rank_of(whole * size + symbol[far]) if symbol[far] >= 0 else None
            if new is not None:
                if new in index:
                    index[new].append(at)
                else:
                    index[new] = [at]
                    heappush(active, new)
            new = rank_of(symbol[back] * size + whole) if symbol[back] >= 0 else None
            if new is not None:
                if new in index:
                    index[new].append(back)
                else:
                    index[new] = [back]
                    heappush(active, new)
    made = np.array(symbol)
    kept = made >= 0
    counts = np.diff(np.concatenate(([0], np.cumsum(kept)[ends])))
    return made[kept].astype(np.int32), counts


class Encoder:
    """Codes texts word by word; words seen before are looked up.  They are kept with the
    tables: a broadcast stays in its Python worker, so the worker's next tasks find them."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words, self.narrow = regex.compile(WORDS), narrow_words()
        names = sorted(vocabulary.added, key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.known = vocabulary.known

    def pieces(self, text: str | None) -> list[str]:
        """Words and added tokens of a text, in order."""
        if not text:
            return []
        try:
            text.encode("latin-1")
            words = self.narrow.findall
        except UnicodeEncodeError:
            words = self.words.findall
        if self.added is None or self.added.search(text) is None:
            return words(text)
        out, at = [], 0
        for m in self.added.finditer(text):
            out += words(text[at:m.start()])
            out.append(m.group())
            at = m.end()
        return out + words(text[at:])

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        waiting: list[tuple[list[str], list]] = []
        held = 0
        for text in texts:
            words = self.pieces(text)
            waiting.append((words, list(map(self.known.get, words))))
            held += len(words)
            if held >= BATCH_WORDS:
                yield from self._settled(waiting)
                waiting, held = [], 0
        yield from self._settled(waiting)

    def _settled(self, waiting: list[tuple[list[str], list]]) -> Iterator[np.ndarray]:
        """Ids of the texts, once those of their words that were not known are coded."""
        known, added = self.known, self.vocabulary.added
        gaps = [[i for i, own in enumerate(ids) if own is None] if None in ids else [] for _, ids in waiting]
        once = dict.fromkeys(words[i] for (words, _), at in zip(waiting, gaps) for i in at)
        fresh = [w for w in once if w not in added]
        for first in range(0, len(fresh), INDEXED):
            part = fresh[first:first + INDEXED]
            flat, counts = coded([w.encode() for w in part], self.vocabulary)
            flat, start = flat.tolist(), 0
            for w, n in zip(part, counts.tolist()):
                once[w] = tuple(flat[start:start + n])
                start += n
        once.update({w: (added[w],) for w in once if w in added})
        for (words, ids), at in zip(waiting, gaps):
            for i in at:
                ids[i] = once[words[i]]
            yield np.fromiter(chain.from_iterable(ids), np.int32)
        for w, own in once.items():  # first come, first kept: frequent words come early
            if len(known) >= REMEMBERED:
                break
            if len(w) <= LONGEST_REMEMBERED:
                known[w] = own


def with_column(df: DataFrame, name: str, kind: T.DataType, fn) -> DataFrame:
    """``df`` and one more column (in place of one of that name), made batch by batch."""
    kept = [c for c in df.columns if c != name]
    rows = df.select(*kept)
    schema = T.StructType([*rows.schema.fields, T.StructField(name, kind)])

    def run(batches):
        step = fn()
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), ROWS):
                batch = whole.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([*batch.columns, step(batch)], names=[*kept, name])

    return rows.mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` (array of int) of ``text``."""
    shared = broadcast_tables(docs.sparkSession, Vocabulary(path))

    def start():
        encoder = Encoder(revived(Vocabulary, shared))

        def step(batch: pa.RecordBatch) -> pa.Array:
            ids = list(encoder.encode(batch.column(batch.schema.get_field_index("text")).to_pylist()))
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

        return step

    return with_column(docs, "ids", T.ArrayType(T.IntegerType()), start)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``decoded``, the text of their ``ids``; bytes that are no UTF-8 become
    replacement characters."""
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary(path).text)

    def start():
        text = shared.value

        def step(batch: pa.RecordBatch) -> pa.Array:
            ids = batch.column(batch.schema.get_field_index("ids"))
            # row by row: a batch of ids as Python numbers takes ten times the space of its texts
            rows = (ids[i].values for i in range(len(ids)))
            return pa.array([b"".join(map(text.__getitem__, () if row is None else row.to_numpy().tolist()))
                             .decode("utf-8", "replace") for row in rows], pa.string())

        return step

    return with_column(rows, "decoded", T.StringType(), start)


def token_digest(rows: DataFrame) -> DataFrame:
    """The digest columns of the query from ``ids`` and ``decoded``."""
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
