"""Query registry and the SQL text of the fixture views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VIEWS = {
    "sc": """SELECT o_orderkey AS scene_id, CAST(o_custkey % 29 AS INT) AS mgrs_tile,
  CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INT) AS season,
  CAST((dayofyear(CAST(o_orderdate AS DATE)) - 1) // 10 AS INT) AS dekad,
  CAST((o_orderkey * 7919) % 101 AS INT) AS cloud_cover,
  CAST((o_orderkey * 104729) % 41 AS INT) AS nodata_pct FROM orders""",
    "sg": "SELECT *, cloud_cover <= 20 AND nodata_pct <= 20 AS usable FROM sc",
    "sel": """SELECT *, usable AND row_number() OVER (PARTITION BY mgrs_tile, season, dekad
  ORDER BY cloud_cover, scene_id) = 1 AS selected FROM sg""",
    "fl": """SELECT *, x0 + w / 2.0::DOUBLE AS mx, y0 + h / 2.0::DOUBLE AS my, 2 * y0 + h AS lat, 2 * x0 + w AS lon,
  CAST(w * h AS DOUBLE) AS area_m2 FROM (
  SELECT p_partkey AS field_id, CAST((p_partkey * 37) % 1000 AS INT) AS x0,
  CAST((p_partkey * 91) % 1000 AS INT) AS y0, CAST(p_size % 13 + 4 AS INT) AS w,
  CAST(p_partkey % 11 + 4 AS INT) AS h, CAST(p_size % 5 AS INT) AS crop FROM part)""",
    "wz": """SELECT zone_id, gust_class, least(xa, xb) AS zx0, least(ya, yb) AS zy0,
  greatest(xa, xb) AS zx1, greatest(ya, yb) AS zy1 FROM (
  SELECT r_regionkey AS zone_id, CAST(r_regionkey % 3 + 1 AS INT) AS gust_class,
  100 + 120 * r_regionkey AS xa, 700 - 40 * r_regionkey AS xb,
  150 + 60 * r_regionkey AS ya, 800 - 90 * r_regionkey AS yb FROM region)""",
    "rg": """SELECT n_nationkey AS geoid, n_regionkey AS state, (n_nationkey % 5) * 200 AS rx0,
  (n_nationkey // 5) * 200 AS ry0 FROM nation""",
    "pc": """SELECT s_suppkey AS geoid, s_nationkey % 5 AS state, (s_suppkey * 53) % 1000 AS rx0,
  (s_suppkey * 71) % 1000 AS ry0 FROM supplier""",
    "wind": """SELECT fl.field_id, CAST(coalesce(max(gust_class), 0) AS INT) AS wind FROM fl
  LEFT JOIN wz ON mx >= zx0 AND mx < zx1 AND my >= zy0 AND my < zy1 GROUP BY fl.field_id""",
    "rt": """SELECT vec_id // 100 AS scene_id, CAST(vec_id % 10 AS INT) AS x,
  CAST((vec_id // 10) % 10 AS INT) AS y, vec_id, embedding AS red,
  list_reverse(embedding) AS nir FROM embeddings""",
    "meta": """SELECT scene_id, ['15TVF', '15TVG', '15TVH'][CAST(scene_id % 3 + 1 AS INT)] AS mgrs_tile,
  date, CAST((dayofyear(date) - 1) // 10 AS INT) AS dekad, CAST(year(date) AS INT) AS season,
  CAST(32615 AS INT) AS epsg FROM (SELECT scene_id, DATE '2020-05-01' + CAST(scene_id * 7 AS INT) AS date
  FROM (SELECT DISTINCT scene_id FROM rt))""",
    "px": """SELECT *, CASE WHEN scl NOT IN (0, 1, 3, 8, 9, 10, 11) AND nir + red > 0 AND red >= 0
  AND nir >= 0 THEN (nir - red) / (nir + red) END AS ndvi,
  x * 8 + i % 8 AS col, y * 8 + i // 8 AS row_,
  CAST(40.0 * x + 5.0 * (i % 8) + 2.5 AS DOUBLE) AS cx,
  CAST(400.0 - 40.0 * y - 5.0 * (i // 8) - 2.5 AS DOUBLE) AS cy FROM (
  SELECT scene_id, vec_id, x, y, i, CAST(red[CAST(i + 1 AS INT)] AS DOUBLE) AS red,
  CAST(nir[CAST(i + 1 AS INT)] AS DOUBLE) AS nir, CAST((vec_id * 5 + i * 7) % 12 AS INT) AS scl
  FROM rt, range(64) r(i))""",
    "ob": """SELECT l_partkey AS field_id, CAST(l_shipdate AS DATE) AS date,
  CAST(year(l_shipdate) AS INT) AS season,
  CAST((dayofyear(CAST(l_shipdate AS DATE)) - 1) // 10 AS INT) AS dekad,
  CAST(l_suppkey AS INT) AS mgrs_tile, l_discount * 10 - 0.2 AS mean_ndvi,
  l_quantity / 50 AS valid_frac FROM lineitem""",
    "wide": """SELECT field_id, max(mean_ndvi) FILTER (season = 1998 AND dekad < 18) AS pre,
  max(valid_frac) FILTER (season = 1998 AND dekad < 18) AS pre_vf,
  max(mean_ndvi) FILTER (season = 1998 AND dekad >= 18) AS post,
  max(valid_frac) FILTER (season = 1998 AND dekad >= 18) AS post_vf FROM ob GROUP BY field_id""",
    "frame": """SELECT wide.*, lat, lon, wind, post - pre AS delta,
  coalesce(pre IS NOT NULL AND post IS NOT NULL AND pre_vf >= 0.5 AND post_vf >= 0.5, false) AS usable
  FROM wide JOIN fl USING (field_id) JOIN wind USING (field_id)""",
}


def quant_sql(value: str, valid: str, lo: str = "-0.2", hi: str = "1.0") -> str:
    code = f"round_even(greatest(0, least(1, (({value}) - {lo}) / ({hi} - {lo}))) * 200, 0)"
    return (f"CAST(CASE WHEN ({value}) IS NOT NULL AND coalesce({valid}, 0) >= 0.5 THEN {code} "
            "ELSE 255 END AS INT)")


DEKADS = range(37)  # every ten days of a year
VIEWS["codes"] = f"""SELECT field_id, {", ".join(f"coalesce(max(q) FILTER (dekad = {d}), 255) AS d{d}" for d in DEKADS)}
  FROM (SELECT field_id, dekad,
  {quant_sql('b.m', 'b.v')} AS q FROM (SELECT field_id, dekad,
  max(struct_pack(v := valid_frac, m := mean_ndvi)) AS b FROM ob WHERE season = 1998
  GROUP BY field_id, dekad)) GROUP BY field_id"""
VIEWS["pub"] = f"""SELECT wide.*, crop, area_m2, wind, {quant_sql('pre', 'pre_vf')} AS pre_q,
  {quant_sql('post', 'post_vf')} AS post_q,
  {quant_sql('post - pre', 'CASE WHEN pre_vf IS NOT NULL AND post_vf IS NOT NULL THEN least(pre_vf, post_vf) END',
             '-0.4', '0.1')} AS drop_q, {", ".join(f"CAST(coalesce(d{d}, 255) AS INT) AS d{d}" for d in DEKADS)},
  x0, y0, w, h FROM wide JOIN fl USING (field_id)
  JOIN wind USING (field_id) LEFT JOIN codes USING (field_id)"""
# the study as published: lowest validity on either side, one crop; the fixtures' validity is
# spread evenly, so its threshold is lower here
VIEWS["swide"] = VIEWS["wide"].replace("max(valid_frac)", "min(valid_frac)")
VIEWS["sframe"] = """SELECT swide.*, lat, lon, wind, post - pre AS delta,
  coalesce(pre IS NOT NULL AND post IS NOT NULL AND pre_vf >= 0.1 AND post_vf >= 0.1, false) AS usable
  FROM swide JOIN fl USING (field_id) JOIN wind USING (field_id) WHERE crop = 1"""
# direct (pair by pair) matching: the definition, not the method
for _name, (_frame, _cond) in {
    "m30": ("frame", "c.lat BETWEEN t.lat - 30 AND t.lat + 30"),
    "m10": ("frame", "c.lat BETWEEN t.lat - 10 AND t.lat + 10"),
    "m2": ("frame", "c.lat >= t.lat - 160 AND c.lat < t.lat + 160 AND abs(c.lon - t.lon) <= 160"),
    "sm30": ("sframe", "c.lat BETWEEN t.lat - 30 AND t.lat + 30"),
    "sm2": ("sframe", "c.lat >= t.lat - 160 AND c.lat < t.lat + 160 AND abs(c.lon - t.lon) <= 160"),
}.items():
    VIEWS[_name] = f"""SELECT *, delta - ctrl_delta AS did FROM (
  SELECT t.field_id, t.wind, t.lat, t.lon, t.delta, avg(c.delta) AS ctrl_delta, count(*) AS ctrl_n
  FROM {_frame} t JOIN {_frame} c ON {_cond} WHERE t.usable AND t.wind > 0 AND c.usable AND c.wind = 0
  GROUP BY ALL HAVING count(*) >= 5)"""

DID = """SELECT wind, count(*) AS fields, round_even(avg(delta::DECIMAL(20, 12)), 4) AS mean_delta,
  round_even(avg(ctrl_delta::DECIMAL(20, 12)), 4) AS mean_ctrl, round_even(avg(did::DECIMAL(20, 12)), 4) AS did,
  round_even(stddev_samp(did) / sqrt(count(*)), 4) AS did_se,
  ['control', '60-79 mph', '80-99 mph', '100+ mph'][wind + 1] AS label"""


def with_views(names: str, sql: str) -> str:
    """Prefix ``sql`` with the views it needs (dependencies are pulled in)."""
    needs = {"sg": "sc", "sel": "sg", "wind": "fl wz", "meta": "rt", "px": "rt", "wide": "ob",
             "frame": "wide wind", "codes": "ob",
             "pub": "wide wind codes", "m30": "frame", "m10": "frame", "m2": "frame",
             "swide": "ob", "sframe": "swide wind", "sm30": "sframe", "sm2": "sframe"}
    order: list[str] = []

    def visit(n: str) -> None:
        for d in needs.get(n, "").split():
            visit(d)
        if n not in order:
            order.append(n)

    for n in names.split():
        visit(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order)
    return f"WITH {ctes}\n{sql}" if order else sql


def query(name: str, views: str = "", oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its oracle."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_views(views, oracle)
        return fn
    return add
