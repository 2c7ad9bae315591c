"""Fields meet tiles in slices, as array operations: a pair costs a few reads, and no row unless it is asked for."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELLS = 1 << 18  # pairs worked on at once
ROWS = 1 << 16   # of a batch handed back
NONE = np.iinfo(np.int64).max
HOW = {"there": np.logical_or, "least": np.minimum, "most": np.maximum}


@dataclass(frozen=True)
class Job:
    """What :func:`met` does, in names of columns."""
    on: tuple[str, ...]              # of a slice
    spot: tuple[str, ...]            # of a spot in a slice, if it has several
    shape: str                       # "runs" (row, first, last) or "pixels" (positions) of a mask
    values: tuple[str, ...]          # arrays of a tile
    marks: tuple[str, ...]           # of a mask, to be returned
    seen: tuple[str, ...]            # of a tile, to be returned
    by_field: bool = False           # pairs are added up by the field_id of ``marks`` ...
    by_seen: bool = False            # ... and by ``seen``
    first: str | None = None         # least value of the tiles that counted (rows come in its order)
    most: str | None = None          # of ``marks``: greatest value of the masks that counted
    empty: bool = False              # pairs without a valid pixel count too


def met(masks: DataFrame, tiles: DataFrame, job: Job, tasks: int) -> DataFrame:
    """Sum ``s_<value>`` and count ``n_<value>`` of the valid pixels of every mask in every tile of its slice
    (and spot), or of all pairs that share field or tile columns.

    Both sides are partitioned by the slice and sorted, masks first: a slice's masks are held, its tiles
    pass by in batches.  Only rows that are returned are ever made."""
    width = ["w"] if job.shape == "runs" else []
    a = [*job.spot, *job.marks, job.shape]
    b = [*job.spot, *job.seen, *([job.first] if job.first else []), *width, *job.values]
    kinds = [T.StructType([df.schema[c] for c in cs]) for df, cs in ((masks, a), (tiles, b))]
    one = masks.select(*job.on, F.lit(0).alias("__side"), F.struct(*a).alias("__a"), F.lit(None).cast(kinds[1]).alias("__b"))
    two = tiles.select(*job.on, F.lit(1).alias("__side"), F.lit(None).cast(kinds[0]).alias("__a"), F.struct(*b).alias("__b"))
    order = [*(job.seen if job.by_seen else ()), *([job.first] if job.first else [])]
    rows = (one.unionByName(two).repartition(tasks, *job.on)
            .sortWithinPartitions(*job.on, "__side", *[f"__b.{c}" for c in order]))
    kept = [T.StructField(c, rows.schema[c].dataType) for c in job.on]
    kept += [T.StructField(c, k[c].dataType) for k, cs in zip(kinds, (job.marks, [*job.seen, *([job.first] if job.first else [])]),
                                                              strict=True) for c in cs]
    for v in job.values:
        kept += [T.StructField(f"s_{v}", T.DoubleType()), T.StructField(f"n_{v}", T.LongType())]
    names = [f.name for f in kept]
    return rows.mapInArrow(lambda batches: packed(_sums(batches, job), names), T.StructType(kept))


def packed(parts: Iterable[list[pa.Array]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Parts put together to batches of ``ROWS`` rows or more."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= ROWS:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*held, strict=True)], names)
            held, n = [], 0
    if n:
        yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*held, strict=True)], names)


def changed(columns: list[pa.Array], before: list[pa.Array] | None) -> np.ndarray:
    """Which rows differ from the row in front of them (``before``: the last row so far); nulls are equal."""
    out = np.zeros(len(columns[0]), bool)
    out[0] = before is None
    for i, c in enumerate(columns):
        c = c if before is None else pa.concat_arrays([before[i], c])
        a, b = c.slice(0, len(c) - 1), c.slice(1)
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        if len(same):
            out[len(out) - len(same):] |= ~same.to_numpy(zero_copy_only=False)
    return out


def _sums(batches: Iterable[pa.RecordBatch], job: Job) -> Iterator[list[pa.Array]]:
    before, now = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c) for c in job.on]
        side = batch.column("__side").to_numpy()
        new = changed(keys, before)
        before = [k.slice(len(k) - 1) for k in keys]
        cuts = np.flatnonzero(new | (np.diff(side, prepend=side[0]) != 0))
        for i, j in zip(*(np.unique(x) for x in ([0, *cuts], [*cuts[cuts > 0], len(side)])), strict=True):
            if new[i]:
                if now is not None:
                    yield from now.close()
                now = _Slice(job, [k.slice(i, 1) for k in keys])
            if side[i] == 0:
                now.pieces.append(batch.column("__a").slice(i, j - i))
            elif now.pieces:
                yield from now.tiles(batch.column("__b").slice(i, j - i))
    if now is not None:
        yield from now.close()


def _integers(a: pa.Array) -> np.ndarray:
    return a.cast(pa.int64()).to_numpy(zero_copy_only=False)


@dataclass
class _Marks:
    """Masks of one spot, those of most parts first: ``at[k]`` are the parts k of the masks that have so many."""
    rows: np.ndarray
    who: np.ndarray
    single: bool  # no field twice
    at: list[np.ndarray]


@dataclass
class _Open:
    """A group of tiles that may go on in the next rows."""
    row: list[pa.Array]
    totals: dict[str, np.ndarray]
    pool: pa.Array | None


@dataclass
class _Slice:
    job: Job
    keys: list[pa.Array]
    pieces: list[pa.Array] = field(default_factory=list)
    spots: dict[tuple, _Marks] | None = None
    open: _Open | None = None

    def prepare(self) -> None:
        job, rows = self.job, pa.concat_arrays(self.pieces)
        self.pieces = [rows.slice(0, 0)]
        parts = pc.struct_field(rows, job.shape)
        sizes = pc.fill_null(pc.list_value_length(parts), 0).to_numpy()
        starts, flat = np.concatenate([[0], np.cumsum(sizes)])[:-1], parts.flatten()
        if job.shape == "runs":
            self.parts = [_integers(pc.struct_field(flat, c)) for c in ("row", "first", "last")]
        else:
            self.parts = [_integers(flat)]
        if job.by_field:
            codes = pc.dictionary_encode(pc.struct_field(rows, "field_id"), null_encoding="encode").indices.to_numpy()
        else:
            codes = np.arange(len(rows))
        places, where = _places(rows, job.spot)
        order = []
        for k in range(len(places)):
            m = np.flatnonzero(where == k) if len(places) > 1 else np.arange(len(rows))
            order.append(m[np.argsort(-sizes[m], kind="stable")])
        # fields are numbered as they come in this order, so that those of a lone spot need no dealing
        _, first, number = np.unique(codes[np.concatenate(order)], return_index=True, return_inverse=True)
        rank = np.argsort(np.argsort(first))
        heads = pa.array(np.concatenate(order)[np.sort(first)])
        self.fields, self.marks = len(first), [pc.struct_field(rows, n).take(heads) for n in job.marks]
        self.ranks = _ranks(pc.struct_field(rows, job.most), rank[number.ravel()], np.concatenate(order)) if job.most else None
        self.spots, self.widest, done = {}, 1, 0
        for place, m in zip(places, order, strict=True):
            who = rank[number.ravel()[done:done + len(m)]]
            held = np.searchsorted(-sizes[m], -np.arange(1, int(sizes[m[0]]) + 1), side="right")
            self.spots[place] = _Marks(m, who, len(np.unique(who)) == len(m), [starts[m[:n]] + i for i, n in enumerate(held)])
            self.widest, done = max(self.widest, len(m)), done + len(m)

    def tiles(self, rows: pa.Array) -> Iterator[list[pa.Array]]:
        if self.spots is None:
            self.prepare()
        step = max(1, CELLS // max(self.widest, self.fields))
        for i in range(0, len(rows), step):
            yield from self.block(rows.slice(i, step))

    def block(self, rows: pa.Array) -> Iterator[list[pa.Array]]:
        job = self.job
        seen = [pc.struct_field(rows, c) for c in job.seen]
        if job.by_seen:
            new = changed(seen, self.open.row if self.open else None)
            group = np.cumsum(new) - (0 if self.open else 1)  # 0: the open one, or the first
            heads = np.flatnonzero(new)
        else:
            group = heads = np.arange(len(rows))
        n = int(group[-1]) + 1
        shape = (self.fields, n)
        every = {f"{k}_{v}": np.zeros(shape, kind) for v in job.values for k, kind in (("s", float), ("n", np.int64))}
        if job.empty:
            every["there"] = np.zeros(shape, bool)
        if self.ranks:
            every["most"] = np.full(shape, -1)
        pool, base = None, 0
        if job.first:  # positions among the tiles of the groups at hand
            every["least"], pool = np.full(shape, NONE), pc.struct_field(rows, job.first)
            if self.open:
                base, pool = len(self.open.pool), pa.concat_arrays([self.open.pool, pool])
        for place, t, w, cells in self.classes(rows):
            if place in self.spots:
                self.add(self.spots[place], t, w, cells, group[t], every, base)
        if not job.by_seen:
            yield from self.rows(every, seen, pool)
            return
        if self.open:
            for k, x in every.items():
                x[:, 0] = HOW.get(k, np.add)(x[:, 0], self.open.totals[k])
            # a group's columns: of the open row, then of the heads in these rows
            seen = [pa.concat_arrays([a, c.take(pa.array(heads))]) for a, c in zip(self.open.row, seen, strict=True)]
        else:
            seen = [c.take(pa.array(heads)) for c in seen]
        if n > 1:
            yield from self.rows({k: x[:, :-1] for k, x in every.items()}, [c.slice(0, n - 1) for c in seen], pool)
        begun = base + int(heads[-1]) if n > 1 or not self.open else 0
        last = {k: x[:, -1].copy() for k, x in every.items()}
        if job.first:
            last["least"][last["least"] < NONE] -= begun
            pool = pool.slice(begun)
        self.open = _Open([c.slice(n - 1, 1) for c in seen], last, pool)

    def classes(self, rows: pa.Array) -> Iterator[tuple]:
        """Tiles of one spot, width and number of pixels: their positions and, per value, pixels and validity (or None)."""
        job = self.job
        arrays = [pc.struct_field(rows, v) for v in job.values]
        sizes = [pc.fill_null(pc.list_value_length(a), -1).to_numpy() for a in arrays]
        width = _integers(pc.fill_null(pc.struct_field(rows, "w"), -1)) if job.shape == "runs" else np.zeros(len(rows), np.int64)
        places, where = _places(rows, job.spot)
        kind = np.stack([where, width, *sizes])
        flat = []
        for a, n in zip(arrays, sizes, strict=True):
            v = a.flatten()
            there = pc.is_valid(v).to_numpy(zero_copy_only=False)
            x = v.cast(pa.float64()).to_numpy(zero_copy_only=False)
            flat.append((x if there.all() else np.where(there, x, 0.0), there, np.concatenate([[0], np.cumsum(np.maximum(n, 0))])))
        kinds, which = np.unique(kind, axis=1, return_inverse=True) if (kind != kind[:, :1]).any() else (kind[:, :1], None)
        for k in range(kinds.shape[1]):
            t = np.arange(len(rows)) if which is None else np.flatnonzero(which.ravel() == k)
            cells = []
            for (x, there, ends), n in zip(flat, kinds[2:, k], strict=True):
                if n < 0:
                    cells.append(None)
                    continue
                at = slice(None) if which is None else (ends[t][:, None] + np.arange(n)).ravel()
                cells.append((x[at].reshape(len(t), n), there[at].reshape(len(t), n)))
            yield places[int(kinds[0, k])], t, int(kinds[1, k]), cells

    def add(self, marks: _Marks, t: np.ndarray, w: int, cells: list, group: np.ndarray, every: dict[str, np.ndarray],
            base: int) -> None:
        job, shape = self.job, (self.fields, int(group[-1]) + 1)
        single = marks.single and len(np.unique(group)) == len(group)
        whole = single and shape == (len(marks.who), len(group)) == next(iter(every.values())).shape and (
            marks.who == np.arange(self.fields)).all()
        at = np.ix_(marks.who, group)

        def put(name: str, values: np.ndarray) -> None:
            total, how = every[name], HOW.get(name, np.add)
            if whole:
                how(total, values, out=total)
            elif single:
                total[at] = how(total[at], values)
            else:
                how.at(total, at, values)

        if job.empty:
            put("there", np.ones((len(marks.who), len(t)), bool))
        for v, c in zip(job.values, cells, strict=True):
            if c is None or job.shape == "runs" and w < 0:
                continue
            sums, counts = (self.parted(marks, w, x, kind) for x, kind in zip(c, (float, np.int32), strict=True))
            put(f"s_{v}", sums)
            put(f"n_{v}", counts)
            if v == job.values[0]:
                if job.first:
                    put("least", np.where(counts > 0, base + t, NONE))
                if self.ranks:
                    put("most", np.where(counts > 0, self.ranks[1][marks.rows][:, None], -1))

    def parted(self, marks: _Marks, w: int, pixels: np.ndarray, kind: type) -> np.ndarray:
        """Total of ``pixels`` (a tile each row) over the parts of every mask: for runs the difference of
        two running sums along the tile's row, so its length doesn't count."""
        out = np.zeros((len(marks.who), len(pixels)), kind)
        if self.job.shape == "pixels":
            table = np.concatenate([pixels.T.astype(kind), np.zeros((1, len(pixels)), kind)])
            for part in marks.at:
                out[:len(part)] += table[_within(self.parts[0][part], len(table) - 1)]
            return out
        row, first, last = self.parts
        table = np.concatenate([running(pixels, w, kind).T, np.zeros((1, len(pixels)), kind)])
        for part in marks.at:
            begin = row[part] * (w + 1)
            a, b = _within(begin + first[part], len(table) - 1), _within(begin + last[part] + 1, len(table) - 1)
            a, b = np.where(b == len(table) - 1, b, a), np.where(a == len(table) - 1, a, b)
            out[:len(part)] += table[b] - table[a]
        return out

    def rows(self, every: dict[str, np.ndarray], seen: list[pa.Array], pool: pa.Array | None) -> Iterator[list[pa.Array]]:
        job = self.job
        f, t = np.nonzero(every["there"] if job.empty else every[f"n_{job.values[0]}"] > 0)
        if not len(f):
            return
        marks = [c.take(pa.array(f)) for c in self.marks]
        if self.ranks:
            rank = every["most"][f, t]
            marks[job.marks.index(job.most)] = self.ranks[0].take(pa.array(rank, mask=rank < 0))
        least = [pool.take(pa.array(every["least"][f, t]))] if job.first else []
        by_tile = pa.array(t)
        yield [*[pa.repeat(k[0], len(f)) for k in self.keys], *marks, *[c.take(by_tile) for c in seen], *least,
               *[pa.array(every[f"{k}_{v}"][f, t]) for v in job.values for k in "sn"]]

    def close(self) -> Iterator[list[pa.Array]]:
        if self.open:
            yield from self.rows({k: x[:, None] for k, x in self.open.totals.items()}, self.open.row, self.open.pool)


def _ranks(values: pa.Array, who: np.ndarray, rows: np.ndarray) -> tuple[pa.Array, np.ndarray] | None:
    """The distinct ``values`` in order and the rank of each (-1: null); None if a field (``who``, of ``rows``) has only one."""
    there = pc.is_valid(values).to_numpy(zero_copy_only=False)
    distinct, rank = np.unique(values.drop_null().to_numpy(zero_copy_only=False), return_inverse=True)
    ranks = np.full(len(values), -1)
    ranks[there] = rank.ravel()
    one = np.empty(who.max() + 1, np.int64)
    one[who] = ranks[rows]
    return None if (one[who] == ranks[rows]).all() else (pa.array(distinct, values.type), ranks)


def _within(at: np.ndarray, n: int) -> np.ndarray:
    """Positions, those outside of 0..n-1 as n (where a zero stands)."""
    return np.where((at >= 0) & (at < n), at, n)


def _places(rows: pa.Array, spot: tuple[str, ...]) -> tuple[list[tuple], np.ndarray]:
    """The distinct spots of ``rows`` and the number of each row's own."""
    if not spot:
        return [()], np.zeros(len(rows), np.int64)
    at = np.stack([_integers(pc.struct_field(rows, c)) for c in spot])
    places, where = np.unique(at, axis=1, return_inverse=True)
    return [tuple(map(int, p)) for p in places.T], where.ravel()


def running(pixels: np.ndarray, w: int, kind: type = float) -> np.ndarray:
    """Running sums along the rows of tiles (one a row of ``pixels``) of width ``w``, a zero in front of each row:
    pixels a to b of row r add up to position ``r * (w + 1) + b + 1`` less position ``r * (w + 1) + a``."""
    cube = pixels.reshape(len(pixels), -1, w or 1) if pixels.size else np.zeros((len(pixels), 0, w or 1))
    out = np.zeros((*cube.shape[:2], cube.shape[2] + 1), kind)
    np.cumsum(cube, axis=2, out=out[:, :, 1:])
    return out.reshape(len(pixels), -1)
