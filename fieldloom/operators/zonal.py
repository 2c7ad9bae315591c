"""Zonal statistics: band stacking, pruning, pair statistics, roll-up."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..contracts import SCL_MASKED
from ..functions import geometry as G
from ..functions import raster as R
from ..functions import scalars as S
from ..shared import cores, materialize, sized_join
from . import slices

TILE = ["scene_id", "x", "y"]
SPOT = ["grid_id", "x", "y"]


def stack_bands(red: DataFrame, nir: DataFrame, scl: DataFrame) -> DataFrame:
    """Three band tables (scene_id, x, y, data) -> one row per tile.  Both
    joins use the same keys, so each band is shuffled once."""
    named = [b.select(*TILE, F.col("data").alias(n))
             for b, n in ((red, "red"), (nir, "nir"), (scl, "scl"))]
    return named[0].join(named[1], TILE).join(named[2], TILE)


def keep_needed(tiles: DataFrame, keys: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Tiles that at least one field needs: only these pay for map algebra."""
    on = on or SPOT
    return sized_join(tiles, keys.select(*on).distinct(), on, "left_semi", max_rows=1_000_000)


def blank(scl: str = "scl", masked: Sequence[int] = SCL_MASKED) -> Column:
    """Is every pixel of the class band masked?  (An empty or missing band is not.)"""
    return R.masked_fraction(scl, masked) == 1.0


def mask_tally(tiles: DataFrame, scl: str = "scl",
               masked: Sequence[int] = SCL_MASKED) -> DataFrame:
    """Number of tiles, and of tiles with nothing to see."""
    return tiles.agg(F.count(F.lit(1)).alias("total"),
                     F.count_if(blank(scl, masked)).alias("fully_masked"))


def drop_masked(tiles: DataFrame, scl: DataFrame | None = None,
                masked: Sequence[int] = SCL_MASKED) -> DataFrame:
    """Tiles without those that hold no visible pixel; the statistics stay the same.

    Where the class band stands in the tiles' own rows this is a filter.  A class
    table of its own gives the keys of its blank tiles, and they are taken away: narrow
    rows, and the few rather than the many."""
    if scl is None:
        return tiles.filter(~blank("scl", masked))
    return sized_join(tiles, scl.filter(blank("scl", masked)).select(*TILE), TILE, "left_anti",
                      max_rows=1_000_000)


FIELDS_EACH, TILES_EACH = 8192, 2048  # of a spot, that meet in one slice
MOST_TASKS = 20_000
PAIRS = 1 << 22  # of a task


def dealt(masks: DataFrame, tiles: DataFrame) -> tuple[DataFrame, DataFrame, list[str], int]:
    """``masks`` and ``tiles`` with the columns of the slice where they meet, these columns, the number of tasks.

    All scenes of a spot meet all its fields, so a narrow input gives very many pairs, which
    the size of the input doesn't show.  A spot's fields and its tiles are dealt over slices, every slice of
    the one meets every slice of the other, and tasks are as many as the pairs need.  ``masks`` is
    read twice: it should be stored."""
    spark = masks.sparkSession
    count = lambda df, n: df.groupBy(*SPOT).agg(F.count(F.lit(1)).alias(n))
    plan = materialize(count(masks, "f").join(count(tiles, "t"), SPOT).select(
        *SPOT, F.ceil(F.col("f") / FIELDS_EACH).alias("__fs"), F.ceil(F.col("t") / TILES_EACH).alias("__ts"),
        (F.col("f") * F.col("t")).cast("double").alias("__pairs")), "slices")
    n = tasks(spark, plan.agg(F.sum("__pairs")).first()[0] or 0)
    plan = plan.drop("__pairs")
    deal = lambda key, k: F.pmod(F.xxhash64(key), F.col(k))
    one = sized_join(masks, plan, SPOT).withColumn("__f", deal("field_id", "__fs")).withColumn("__t", F.explode(_numbers("__ts")))
    two = sized_join(tiles, plan, SPOT).withColumn("__t", deal("scene_id", "__ts")).withColumn("__f", F.explode(_numbers("__fs")))
    return one.drop("__fs", "__ts"), two.drop("__fs", "__ts"), [*SPOT, "__f", "__t"], n


def tasks(spark, pairs: float) -> int:
    return max(min(int(-(-pairs // PAIRS)), MOST_TASKS), cores(spark))


def pair_stats(masks: DataFrame, tiles: DataFrame, value: str = "ndvi") -> DataFrame:
    """Sum and count of the valid pixels of every (tile, field) pair.

    ``masks``: SPOT, field_id, runs;  ``tiles``: SPOT, scene_id, w, value array
    (null = not valid).  Running sums along the tile's rows are made once per slice of tiles; a field
    reads them at the ends of its runs (see :func:`slices.met`)."""
    one, two, on, n = dealt(masks, tiles)
    marks = [c for c in masks.columns if c not in (*SPOT, "runs")]
    seen = [c for c in tiles.columns if c not in (*SPOT, "w", value)]
    met = slices.met(one, two, slices.Job(tuple(on), (), "runs", (value,), tuple(marks), tuple(seen)), n)
    return met.select(*SPOT, *marks, *seen, F.col(f"s_{value}").alias("sum"), F.col(f"n_{value}").alias("count"))


def pixel_stats(tiles: DataFrame, assigned: DataFrame, tile_px: int,
                inset: float = 0.0) -> DataFrame:
    """The same statistics by the direct path: every pixel centre in a polygon's box is tested against its
    edges, one by one, and the valid pixels of each scene are added up at the positions that passed.  Parity
    check for :func:`pair_stats`; where a centre lies doesn't depend on the scene, so it is asked once."""
    one, two, on, n = dealt(assigned.select(*SPOT, "field_id", pixels_inside(tile_px, inset).alias("pixels")),
                            tiles.select("scene_id", *SPOT, "ndvi"))
    job = slices.Job(tuple(on), (), "pixels", ("ndvi",), ("field_id",), ("scene_id",), by_field=True, by_seen=True)
    return slices.met(one, two, job, n).select(
        "scene_id", "field_id", *SPOT, F.col("s_ndvi").alias("sum"), F.col("n_ndvi").alias("count"))


def pixels_inside(tile_px: int, inset: float = 0.0) -> Column:
    """Positions of a tile's pixels whose centres lie in the polygon of an assigned row, at least ``inset`` from its edges."""
    px = F.col("stride") / tile_px
    numbers = F.sequence(F.lit(0), F.lit(tile_px - 1))
    columns = F.filter(F.transform(numbers, lambda c: F.struct(
        c.alias("at"), (F.col("x0") + F.col("x") * F.col("stride") + (c + 0.5) * px).alias("m"))),
        lambda c: c["m"].between(F.col("b.xmin"), F.col("b.xmax")))
    rows = F.filter(F.transform(numbers, lambda r: F.struct(
        r.alias("at"), (F.col("y0") - F.col("y") * F.col("stride") - (r + 0.5) * px).alias("m"))),
        lambda r: r["m"].between(F.col("b.ymin"), F.col("b.ymax")))

    def inside(r: Column, c: Column) -> Column:
        hit = G.edges_contain(F.col("__edges"), c["m"], r["m"])
        return hit & (G.edges_distance(F.col("__edges"), c["m"], r["m"]) >= F.lit(float(inset))) if inset > 0 else hit

    return G.let(columns, lambda cs: F.flatten(F.transform(rows, lambda r: F.transform(
        F.filter(cs, lambda c: inside(r, c)), lambda c: (r["at"] * tile_px + c["at"]).cast("int")))))


OBSERVED = ["date", "dekad", "season", "mgrs_tile", "epsg"]
TOTALS = ["field_id", *OBSERVED, "area_m2", "scene_id", "sum", "count"]


def roll_up(pairs: DataFrame, meta: DataFrame, pixel_m2: float = 100.0) -> DataFrame:
    """Pairs -> one row per field and scene date, with validity.

    ``meta``: scene_id, mgrs_tile, date, dekad, season, epsg."""
    # scene attributes are added in place when the manifest fits a broadcast,
    # so that the observation key below is the only shuffle
    return measured(summed(sized_join(pairs, meta, ["scene_id"])), pixel_m2)


def summed(seen: DataFrame) -> DataFrame:
    """Rows of ``TOTALS`` added up, one for a field and OBSERVED."""
    return seen.groupBy("field_id", *OBSERVED).agg(
        F.max("area_m2").alias("area_m2"), F.min("scene_id").alias("scene_id"), F.sum("sum").alias("sum"),
        F.sum("count").alias("count"))


def measured(totals: DataFrame, pixel_m2: float = 100.0) -> DataFrame:
    """Observations of rows of ``TOTALS``, one for a field and OBSERVED."""
    obs = totals.select(
        "field_id", "date", "dekad", "season", "mgrs_tile", "scene_id", (F.col("sum") / F.col("count")).alias("mean_ndvi"),
        F.col("count").cast("int").alias("valid_px"), "area_m2", (F.col("epsg") % 100).cast("int").alias("utm_zone"))
    return with_validity(obs, pixel_m2).drop("area_m2")


BOX = ["grid_id", "__x0", "__y0", "__x1", "__y1"]  # a block of spots
DEALT = ["__f", "__t"]
BLOCK_FIELDS, BLOCK_TILES = 8192, 1024  # of a block, that meet in one slice
SPOTS = 16        # of a block; mask rows of a field in it
PAIR_BYTES = 128  # of a pair's row in a shuffle


def observe(masks: DataFrame, tiles: DataFrame, meta: DataFrame, value: str = "ndvi",
            pixel_m2: float = 100.0) -> DataFrame:
    """:func:`roll_up` of :func:`pair_stats`, see :func:`totals`."""
    planned = blocks(masks, tiles, tiles.select(F.size(value)).first())
    whole, pairs = totals(masks, tiles, meta, planned, value)
    found = [measured(df, pixel_m2) for df in (whole, None if pairs is None else summed(pairs)) if df is not None]
    return reduce(DataFrame.unionByName, found)


def totals(masks: DataFrame, tiles: DataFrame, meta: DataFrame, planned: Blocks,
           value: str = "ndvi", also: Sequence[str] = ()) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of ``TOTALS`` of all fields: those whose pairs stay where they are made, a row for each observation
    of ``tiles``, and those with a row for each pair.

    There are as many observations as fields times scenes.  Fields that span the same block of spots
    meet all tiles of the block there, dealt by field and by date, so an observation is complete in its slice
    and the tiles travel instead: worth it where a block has many fields.  The others (few in their block,
    over several grids, very large) go by pairs.  ``masks`` (with area_m2) should be stored.  ``also``: columns
    of ``meta`` that are the same for all scenes of an observation."""
    whole = pairs = None
    dated = lambda df: sized_join(df, meta.select("scene_id", *OBSERVED, *also), ["scene_id"])
    if planned.chosen is not None:
        job = slices.Job(tuple(BOX + DEALT), ("x", "y"), "runs", (value,), ("field_id", "area_m2"), (*OBSERVED, *also),
                         by_field=True, by_seen=True, first="scene_id", most="area_m2")
        whole = planned.meet(masks, dated(tiles.select("scene_id", *SPOT, "w", value)), job).select(
            *TOTALS[:-2], F.col(f"s_{value}").alias("sum"), F.col(f"n_{value}").alias("count"), *also)
    if planned.rest is not None:
        pairs = dated(pair_stats(planned.rest, tiles, value)).select(*TOTALS, *also)
    return whole, pairs


def _numbers(n: str) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)


@dataclass(frozen=True)
class Blocks:
    """The blocks (BOX and numbers of slices) where fields meet all tiles, the fields in them (__field, BOX), the
    number of tasks, and the masks of the other fields; None for none."""
    chosen: DataFrame | None
    of: DataFrame | None
    tasks: int
    rest: DataFrame | None

    def meet(self, masks: DataFrame, tiles: DataFrame, job: slices.Job) -> DataFrame:
        """Fields meet all tiles of their block, dealt by field and by ``job.seen``."""
        marks = (masks.dropna(subset=SPOT).join(self.of, _own()).withColumn("__f", F.pmod(F.xxhash64("field_id"), "__fs"))
                 .withColumn("__t", F.explode(_numbers("__ts"))))
        cells = self.chosen.withColumn("x", F.explode(F.sequence("__x0", "__x1"))).withColumn(
            "y", F.explode(F.sequence("__y0", "__y1")))
        spots = (tiles.join(F.broadcast(cells), SPOT).withColumn("__t", F.pmod(F.xxhash64(*job.seen), "__ts"))
                 .withColumn("__f", F.explode(_numbers("__fs"))))
        return slices.met(marks, spots, job, self.tasks)


def _own() -> Column:
    return F.col("field_id").eqNullSafe(F.col("__field"))


def blocks(masks: DataFrame, tiles: DataFrame, first: Row | None, parts: int = 1) -> Blocks:
    """The blocks whose fields are so many that their tiles (SPOT; ``first``: pixels of one) weigh less than
    their pairs.  ``parts``: equal parts of the tiles that come one after the other."""
    masks = masks.dropna(subset=SPOT)
    none = Blocks(None, None, 0, masks)
    if first is None:
        return none
    ends = [F.min("x").alias("__x0"), F.min("y").alias("__y0"), F.max("x").alias("__x1"), F.max("y").alias("__y1")]
    boxes = materialize(masks.groupBy("field_id").agg(
        F.min("grid_id").alias("grid_id"), F.max("grid_id").alias("__last"), *ends, F.count(F.lit(1)).alias("__marks")), "boxes")
    area = (F.col("__x1") - F.col("__x0") + 1) * (F.col("__y1") - F.col("__y0") + 1)
    narrow = boxes.filter((F.col("grid_id") == F.col("__last")) & (F.col("__marks") <= SPOTS) & (area <= SPOTS))
    groups = narrow.groupBy(*BOX).agg(F.count(F.lit(1)).alias("n"), F.sum("__marks").alias("marks"))
    fs = F.ceil(F.col("n") / BLOCK_FIELDS)
    weighed = groups.filter(F.col("marks") * PAIR_BYTES > area * fs * 16 * max(first[0] or 0, 1))
    cells = (weighed.withColumn("x", F.explode(F.sequence("__x0", "__x1")))
             .withColumn("y", F.explode(F.sequence("__y0", "__y1"))))
    seen = tiles.groupBy(*SPOT).agg(F.count(F.lit(1)).alias("t"))
    chosen = materialize(
        cells.join(seen, SPOT, "left").groupBy(*BOX, "n", "marks").agg(F.ceil(F.coalesce(F.max("t"), F.lit(0)) / parts).alias("t"))
        .select(*BOX, "n", "t", (F.col("marks") * F.col("t")).cast("double").alias("__pairs"), fs.alias("__fs"),
                F.greatest(F.ceil(F.col("t") / BLOCK_TILES), F.lit(1)).alias("__ts"))
        .orderBy(F.desc("n"), *BOX).limit(MOST_BLOCKS), "blocks")
    held, pairs = chosen.agg(F.sum("n"), F.sum("__pairs")).first()
    if not held:
        return none
    chosen = chosen.drop("n", "t", "__pairs")
    of = materialize(narrow.select(F.col("field_id").alias("__field"), *BOX).join(F.broadcast(chosen), BOX).drop("grid_id"), "boxes")
    rest = None if held == boxes.count() else materialize(masks.join(of, _own(), "left_anti"), "masks")
    return Blocks(chosen, of, tasks(masks.sparkSession, pairs), rest)


MOST_BLOCKS = 100_000  # they are broadcast, with their spots


def with_validity(df: DataFrame, pixel_m2: float = 100.0) -> DataFrame:
    """Pixel total estimated from the area, and the valid share of it."""
    return (df.withColumn("total_px", S.total_pixels("area_m2", pixel_m2))
            .withColumn("valid_frac", S.valid_fraction("valid_px", "total_px")))


def slope_per_tile(dem: DataFrame) -> DataFrame:
    """Elevation tiles (scene_id, x, y, w, h, scale_x, data) + ``slope`` in
    degrees per pixel, null where one of the four neighbours is missing.

    Tiles exchange only their border rows and columns with the four
    neighbour tiles; the pixels themselves move once."""
    w, h, data = F.col("w"), F.col("h"), F.col("data")

    def strip(dx: int, dy: int, name: str, values) -> DataFrame:
        return dem.select("scene_id", (F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"),
                          values.alias(name))

    pick = lambda first, step, n: F.transform(
        F.sequence(F.lit(0), n - 1), lambda k: F.get(data, (first + k * step).cast("int")))
    carried = [c for c in ("grid_id",) if c in dem.columns]
    parts = dem.select("scene_id", "x", "y", "w", "h", "scale_x", "data", *carried)
    for side in (strip(1, 0, "west", pick(w - 1, w, h)),
                 strip(-1, 0, "east", pick(F.lit(0), w, h)),
                 strip(0, 1, "north", pick((h - 1) * w, F.lit(1), w)),
                 strip(0, -1, "south", pick(F.lit(0), F.lit(1), w))):
        parts = parts.unionByName(side, allowMissingColumns=True)
    joined = parts.groupBy("scene_id", "x", "y").agg(
        *[F.first(c, ignorenulls=True).alias(c)
          for c in ("w", "h", "scale_x", "data", *carried, "west", "east", "north", "south")]
    ).filter(F.col("data").isNotNull())

    def slope(i):
        c, r = i % F.col("w"), F.floor(i / F.col("w")).cast("int")
        lf = F.when(c > 0, F.get("data", i - 1)).otherwise(F.get("west", r))
        rt = F.when(c < F.col("w") - 1, F.get("data", i + 1)).otherwise(F.get("east", r))
        up = F.when(r > 0, F.get("data", i - F.col("w"))).otherwise(F.get("north", c))
        dn = F.when(r < F.col("h") - 1, F.get("data", i + F.col("w"))).otherwise(F.get("south", c))
        run = 2 * F.col("scale_x")
        dx, dy = (rt - lf) / run, (dn - up) / run
        return F.degrees(F.atan(F.sqrt(dx * dx + dy * dy)))

    return joined.withColumn("slope", F.transform(
        F.sequence(F.lit(0), F.size("data") - 1), slope))


def terrain(dem: DataFrame, masks: DataFrame) -> DataFrame:
    """Mean elevation and mean slope per (scene_id, field_id).

    ``dem``: elevation tiles with SPOT, w, h, scale_x and ``data``.  A scene's tiles meet its fields in
    blocks as in :func:`observe`, where a mean is complete; only fields that have none go by pairs."""
    tiles = slope_per_tile(dem).select("scene_id", *SPOT, "w", "data", "slope")
    masks = masks.select(*SPOT, "field_id", "runs")
    planned = blocks(masks, dem, dem.select(F.size("data")).first())
    values, shown = ("data", "slope"), (("field_id",), ("scene_id",))
    found = []
    if planned.chosen is not None:
        found.append(planned.meet(masks, tiles, slices.Job(
            tuple(BOX + DEALT), ("x", "y"), "runs", values, *shown, by_field=True, by_seen=True, empty=True)))
    if planned.rest is not None:
        one, two, on, n = dealt(planned.rest, tiles)
        pairs = slices.met(one, two, slices.Job(tuple(on), (), "runs", values, *shown, empty=True), n)
        found.append(pairs.groupBy("scene_id", "field_id").agg(
            *[F.sum(c).alias(c) for c in ("s_data", "n_data", "s_slope", "n_slope")]))
    means = [df.select("scene_id", "field_id", F.col("n_data").alias("n"), (F.col("s_data") / F.col("n_data")).alias("elev"),
                       F.try_divide("s_slope", "n_slope").alias("slope")) for df in found]
    return reduce(DataFrame.unionByName, means)
