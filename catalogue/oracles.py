"""The registered queries as SQL for the checking engine.

Written from the rules, not from the operators: polygons come as edges from
arithmetic, layers and cohorts as rows, the bucket as a recursive query. Only
the input views are shared with the Spark side.
"""

from __future__ import annotations

from catalogue.queries import (
    BUCKET_CAPACITY, BUCKET_START, EARLIER_RUN, FAILED_DAY, FAILED_MONTH, FEW_DATES, OFF_BORDER, MANY_DATES, REPAIRED_MONTH, RUN_DATE, SIMULATED,
    SIMULATION_RUN, STATE_SHIFT, TARGET_COLS, TARGET_ROWS,
)
from catalogue.views import GRID, NAN, UTM_GRID, sql, with_views
from daymosaic.fixed_values import (
    EVEN_BREAKS, EXTRA_OUTPUTS, INDICATORS, PSI_BREAKS, RAMP_COLOURS, WEATHER_VARS,
)

ORACLES: dict[str, str] = {}

VARS = ", ".join(INDICATORS)
WEATHER = ", ".join(WEATHER_VARS)


def each(template: str, names=INDICATORS) -> str:
    return ", ".join(template.format(v=v) for v in names)


# --- cleaning ---------------------------------------------------------------------------------

BAD = "(Psi IS NULL OR isnan(Psi) OR Psi = -40 OR coalesce(isnan(DDS), false) OR coalesce(isnan(LFMC), false))"
CLEAN = (
    with_views("points_obs")
    + f", clean AS (SELECT obs_id, point_id, date, {each('CASE WHEN ' + BAD + ' THEN NULL ELSE {v} END AS {v}')}"
    + " FROM points_obs)"
)

ORACLES["qc_clean"] = f"WITH {CLEAN} SELECT * FROM clean"

ORACLES["quarantine_split"] = f"""WITH {with_views('water')}
SELECT CASE WHEN error IS NULL THEN 'indicators' ELSE 'rejects' END AS target, obs_id, error FROM water"""

ORACLES["water_balance_columns"] = f"""WITH {with_views('water')}
SELECT obs_id, Rain + Snow AS Precipitation, PET,
  (Rain - NetRain) + SoilEvaporation + Transpiration AS AET, Runoff + DeepDrainage AS ELW,
  Rain - NetRain AS Interception, SoilEvaporation AS Esoil, Transpiration AS Eplant, Runoff, DeepDrainage
FROM water"""

SOIL = """
  CASE WHEN known AND theta_sum IS NOT NULL THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, theta_sum / fc)) END AS Theta,
  CASE WHEN known AND stored IS NOT NULL AND span <> 0
       THEN 100.0::DOUBLE * greatest(0.0::DOUBLE, least(1.0::DOUBLE, stored / span)) END AS REW,
  CASE WHEN known THEN top_psi END AS Psi"""


def soil_sums(source: str, top: str) -> str:
    return f"""SELECT obs_id,
    count(W) = count(*) AND count(waterFC) = count(*) AND sum(waterFC) <> 0 AS known,
    sum(waterFC) AS fc,
    CASE WHEN count(theta * waterFC) = count(*) THEN sum(theta * waterFC) END AS theta_sum,
    CASE WHEN count(W * waterFC - waterWP) = count(*) THEN sum(W * waterFC - waterWP) END AS stored,
    CASE WHEN count(waterFC - waterWP) = count(*) THEN sum(waterFC - waterWP) END AS span,
    max(CASE WHEN {top} THEN psi END) AS top_psi
  FROM {source} GROUP BY obs_id"""


ORACLES["soil_profile"] = f"""WITH {with_views('soil_layers')},
ranked AS (SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
           FROM soil_layers),
sums AS ({soil_sums('ranked', 'rn = 1')})
SELECT obs_id, {SOIL} FROM sums"""

COHORT_SUMS = """SELECT obs_id, coalesce(sum(LAI), 0) AS lai, coalesce(sum(LAI * DDS), 0) AS dds,
    coalesce(sum(LAI * LFMC), 0) AS lfmc FROM cohorts GROUP BY obs_id"""
DDS = f"CASE WHEN coalesce(lai, 0) = 0 THEN {NAN} ELSE 100.0::DOUBLE * (dds / lai) END"
LFMC = f"CASE WHEN coalesce(lai, 0) = 0 THEN {NAN} ELSE lfmc / lai END"

ORACLES["plant_weighted_means"] = f"""WITH {with_views('cohorts')}, sums AS ({COHORT_SUMS})
SELECT o_orderkey AS obs_id, {DDS} AS DDS, {LFMC} AS LFMC
FROM orders LEFT JOIN sums ON obs_id = o_orderkey"""

ORACLES["flatten_results"] = f"""WITH {with_views('points_obs', 'water')},
layers AS (SELECT o_orderkey AS obs_id, i AS layer,
    CASE WHEN (o_orderkey + i) % 97 = 0 THEN NULL ELSE CAST((o_orderkey * i) % 128 AS DOUBLE) / 64::DOUBLE END AS W,
    CASE WHEN (o_orderkey + i) % 53 = 0 THEN NULL ELSE CAST((o_orderkey * 3 + i) % 64 AS DOUBLE) / 64::DOUBLE END AS theta,
    0::DOUBLE - CAST((o_orderkey + i * 7) % 40 AS DOUBLE) / 8::DOUBLE AS psi,
    CAST((o_orderkey + i) % 16 AS DOUBLE) / 64::DOUBLE AS waterWP,
    CASE WHEN o_orderkey % 101 = 0 THEN 0::DOUBLE
         ELSE CAST(16 + (o_orderkey + i) % 48 AS DOUBLE) / 64::DOUBLE END AS waterFC
  FROM orders, unnest(range(1, 1 + CAST(o_orderkey % 5 AS BIGINT))) AS t(i)),
soil AS (SELECT obs_id, {SOIL} FROM ({soil_sums('layers', 'layer = 1')})),
cohorts AS (SELECT o_orderkey AS obs_id,
    CASE WHEN o_orderkey % 11 = 0 THEN 0::DOUBLE WHEN (o_orderkey + i) % 13 = 0 THEN NULL
         ELSE CAST((o_orderkey * i) % 50 AS DOUBLE) / 8::DOUBLE END AS LAI,
    CASE WHEN (o_orderkey + i) % 7 = 0 THEN NULL ELSE CAST((o_orderkey + i) % 128 AS DOUBLE) / 128::DOUBLE END AS DDS,
    CAST((o_orderkey * i) % 1024 AS DOUBLE) / 8::DOUBLE AS LFMC
  FROM orders, unnest(range(1, 1 + CAST(o_orderkey % 4 AS BIGINT))) AS t(i)),
plants AS ({COHORT_SUMS}),
flat AS (SELECT o.obs_id, o.point_id, o.date, s.Theta, s.REW, s.Psi, w.PET, w.Rain + w.Snow AS Precipitation,
    (w.Rain - w.NetRain) + w.SoilEvaporation + w.Transpiration AS AET, w.Runoff + w.DeepDrainage AS ELW,
    o.LAI, {DDS.replace('lai', 'p.lai').replace('dds', 'p.dds')} AS DDS,
    {LFMC.replace('lai', 'p.lai').replace('lfmc', 'p.lfmc')} AS LFMC, o.DFMC, o.SFP, o.CFP,
    w.Rain - w.NetRain AS Interception, w.SoilEvaporation AS Esoil, w.Transpiration AS Eplant,
    w.Runoff, w.DeepDrainage
  FROM points_obs o JOIN water w ON w.obs_id = o.obs_id AND w.error IS NULL
  LEFT JOIN soil s ON s.obs_id = o.obs_id LEFT JOIN plants p ON p.obs_id = o.obs_id)
SELECT obs_id, point_id, date, {each('CASE WHEN ' + BAD + ' THEN NULL ELSE {v} END AS {v}')},
  {', '.join(EXTRA_OUTPUTS)}, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day
FROM flat"""

# --- dates, paths and names -------------------------------------------------------------------

WINDOW = """bounds AS (SELECT max(CAST(o_orderdate AS DATE)) + 5 AS run_date FROM orders),
win AS (SELECT CAST(run_date - 5 - CAST(i AS INT) AS DATE) AS date FROM bounds, range(0, 381) AS t(i))"""

ORACLES["date_window"] = f"""WITH {WINDOW}
SELECT win.date, count(o_orderkey) AS n_obs FROM win LEFT JOIN orders ON CAST(o_orderdate AS DATE) = win.date
GROUP BY win.date"""
ORACLES["pending_dates"] = f"""WITH {WINDOW}
SELECT date FROM win WHERE date NOT IN
  (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE day(o_orderdate) % 3 <> 0)"""
ORACLES["missing_dates"] = f"""WITH {WINDOW}, provinces AS (SELECT DISTINCT c_nationkey AS province FROM customer)
SELECT province, date FROM win CROSS JOIN provinces WHERE NOT EXISTS (SELECT 1 FROM orders JOIN customer ON c_custkey = o_custkey
  WHERE c_nationkey = province AND CAST(o_orderdate AS DATE) = date)"""
ORACLES["window_retention"] = f"""SELECT o_orderkey AS obs_id, o_custkey AS point_id, CAST(o_orderdate AS DATE) AS date
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{RUN_DATE}' - 385 AND DATE '{RUN_DATE}' - 5"""
ORACLES["path_to_date"] = f"""WITH {with_views('day_paths')}
SELECT obs_id, strftime(date, '%Y%m%d') AS digits,
  CASE WHEN obs_id % 13 = 0 THEN 'none' ELSE CAST(date AS VARCHAR) END AS file_date FROM day_paths"""
ORACLES["derive_state_path"] = """SELECT o_orderkey AS obs_id,
  'outputs/province_' || (o_custkey % 50) || '_' || strftime(CAST(o_orderdate AS DATE) - 1, '%Y%m%d') || '.rds' AS path,
  'province_' || (o_custkey % 50) || '_' || strftime(CAST(o_orderdate AS DATE) - 1, '%Y%m%d') || '.rds' AS name
FROM orders"""
ORACLES["date_parts"] = f"""WITH {with_views('points_obs')}
SELECT obs_id, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day, CAST(date - 1 AS DATE) AS state_date,
  strftime(date - 1, '%Y%m%d') AS state_text, date < DATE '{RUN_DATE}' - 385 AS too_old FROM points_obs"""
ORACLES["file_name_filter"] = f"""WITH {with_views('input_files')}
SELECT * FROM input_files WHERE NOT (contains(path, '_35_') OR contains(path, '_38_'))"""
ORACLES["file_discovery"] = f"""WITH {with_views('points_obs')},
names AS (SELECT DISTINCT 'province_' || (point_id % 5 + 34) || '_' || strftime(date, '%Y%m') || '01' AS name,
  CAST(date_trunc('month', date) AS DATE) AS date FROM points_obs WHERE point_id % 5 NOT IN (1, 4))
SELECT 'all' AS asked, name, date FROM names UNION ALL SELECT 'day', name, date FROM names WHERE date = DATE '{FEW_DATES[0]}'"""
ORACLES["partition_path"] = """SELECT DISTINCT CAST(o_orderdate AS DATE) AS date,
  's3://bucket/year=' || year(o_orderdate) || '/month=' || month(o_orderdate) || '/day=' || day(o_orderdate) || '/' AS path
FROM orders"""
ORACLES["run_summary"] = f"""WITH {with_views('run_log')},
counts AS (SELECT run_date, count(*) FILTER (WHERE status = 'skipped') AS skipped,
    count(*) FILTER (WHERE status = 'completed') AS completed, count(*) FILTER (WHERE status = 'errored') AS errored
  FROM run_log GROUP BY run_date),
names AS (SELECT run_date, target, row_number() OVER (PARTITION BY run_date ORDER BY target DESC) AS from_end
  FROM (SELECT DISTINCT run_date, target FROM run_log WHERE status = 'errored')),
texts AS (SELECT run_date,
    string_agg(CASE WHEN from_end > 1 THEN target END, ', ' ORDER BY target) AS head,
    max(CASE WHEN from_end = 1 THEN target END) AS tail FROM names GROUP BY run_date)
SELECT c.run_date, skipped, completed, errored,
  CASE WHEN tail IS NULL THEN 'no errors' WHEN head IS NULL THEN tail ELSE head || ' and ' || tail END AS errors,
  CASE WHEN errored > 0 THEN 'lady_beetle' ELSE 'bell' END AS tag
FROM counts c LEFT JOIN texts t ON t.run_date = c.run_date"""

# --- sources and sinks ------------------------------------------------------------------------

ORACLES["scan_day_partition"] = f"""WITH {with_views('points', 'points_obs')}
SELECT x, y, {VARS} FROM points_obs JOIN points USING (point_id)
WHERE date = DATE '2001-07-26'"""
ORACLES["write_partitioned_day"] = f"""WITH {with_views('points_obs')}
SELECT obs_id, date, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day, {VARS}
FROM points_obs"""
ORACLES["point_layer_export"] = f"""WITH {CLEAN}, {with_views('points')}
SELECT m.*, x, y, 'POINT (' || CAST(x AS VARCHAR) || ' ' || CAST(y AS VARCHAR) || ')' AS wkt
FROM clean m JOIN points USING (point_id)"""
ORACLES["state_checkpoint"] = """SELECT c_nationkey AS province, o_custkey AS point_id,
  CAST(o_orderdate AS DATE) AS date, max(o_orderkey) AS state
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL"""
ORACLES["regex_projection"] = f"WITH {with_views('points_obs')} SELECT {VARS} FROM points_obs"
ORACLES["union_by_name"] = f"""WITH {with_views('points_obs', 'water')}
SELECT obs_id, Theta, PET, NULL::DOUBLE AS Rain, NULL::VARCHAR AS error FROM points_obs
UNION ALL SELECT obs_id, NULL, PET, Rain, error FROM water"""

# --- publishing -------------------------------------------------------------------------------

IN_WINDOW = f"date BETWEEN DATE '{RUN_DATE}' - 385 AND DATE '{RUN_DATE}' - 5"


def published(failed_day: str, more_days: str = "") -> str:
    """Rows, rejects and days after a run in which also the rows of ``failed_day`` (a condition) failed."""
    return f"""WITH flat AS ({ORACLES['flatten_results']}),
good AS (SELECT obs_id, date, {VARS} FROM flat WHERE {IN_WINDOW} AND NOT ({failed_day})),
bad AS (SELECT o_orderkey AS obs_id, CAST(o_orderdate AS DATE) AS date FROM orders),
failed AS (SELECT * FROM bad WHERE {IN_WINDOW} AND (obs_id % 37 = 0 OR {failed_day})),
days AS (SELECT date, count(*) FILTER (ok) AS accepted, count(*) FILTER (NOT ok) AS rejected FROM
  (SELECT date, true AS ok FROM good UNION ALL SELECT date, false FROM failed) GROUP BY date)
SELECT 'row' AS kind, obs_id, date, {VARS}, NULL AS error, NULL AS state, NULL AS accepted, NULL AS rejected FROM good
UNION ALL SELECT 'reject', obs_id, date, {each('NULL')}, 'failed', NULL, NULL, NULL FROM failed
UNION ALL SELECT 'day', NULL, date, {each('NULL')}, NULL, CASE WHEN accepted > 0 THEN 'published' ELSE 'failed' END, accepted, rejected
  FROM days{more_days}"""


_RETIRED = f""" UNION ALL SELECT DISTINCT 'day', NULL::BIGINT, CAST(o_orderdate AS DATE), {each('NULL::DOUBLE')}, NULL, 'retired', 0, 0 FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{EARLIER_RUN}' - 385 AND DATE '{RUN_DATE}' - 386"""
ORACLES["publish_days"] = f"""SELECT *, CASE WHEN kind <> 'day' THEN NULL WHEN state = 'retired' OR date > DATE '{EARLIER_RUN}' - 5
    OR strftime(date, '%Y-%m') IN ('{REPAIRED_MONTH}', '{FAILED_MONTH}') THEN 2 ELSE 1 END AS seq
FROM ({published(f"date = DATE '{FAILED_DAY}'", _RETIRED)})"""
ORACLES["stream_days"] = published("false")

# --- weather ----------------------------------------------------------------------------------


def cell(grid, x: str = "x", y: str = "y") -> dict[str, str]:
    inside = f"{x} BETWEEN {grid.xmin} AND {grid.xmax} AND {y} BETWEEN {grid.ymin} AND {grid.ymax}"
    col = f"least({grid.ncol - 1}, CAST(floor(({x} - {grid.xmin}::DOUBLE) / {grid.resolution}::DOUBLE) AS BIGINT))"
    row = f"least({grid.nrow - 1}, CAST(floor(({grid.ymax}::DOUBLE - {y}) / {grid.resolution}::DOUBLE) AS BIGINT))"
    return {
        "row": f"CASE WHEN {y} BETWEEN {grid.ymin} AND {grid.ymax} THEN {row} END",
        "col": f"CASE WHEN {x} BETWEEN {grid.xmin} AND {grid.xmax} THEN {col} END",
        "cell": f"CASE WHEN {inside} THEN {row} * {grid.ncol} + {col} + 1 END",
    }


CELL = cell(GRID)
PLACED = f"{with_views('points')}, placed AS (SELECT *, {CELL['cell']} AS cell FROM points)"
GRIDDED = f"{with_views('weather')}, gridded AS (SELECT *, {CELL['cell']} AS cell FROM weather)"
MATCHED = (
    f"{PLACED}, {GRIDDED}, cells AS (SELECT DISTINCT cell FROM placed), "
    "matched AS (SELECT * FROM gridded WHERE cell IN (SELECT cell FROM placed WHERE cell IS NOT NULL))"
)
FILLED = f"""{MATCHED}, days AS (SELECT DATE '2024-01-01' + CAST(i AS INT) AS dates FROM range(0, 30) AS t(i)),
lacking AS (SELECT c.cell, d.dates FROM cells c CROSS JOIN days d
  WHERE NOT EXISTS (SELECT 1 FROM matched n WHERE n.cell = c.cell AND n.dates = d.dates)),
filled AS (SELECT cell, dates, obs_id, {WEATHER} FROM matched
  UNION ALL SELECT cell, dates, NULL, {each('NULL', WEATHER_VARS)} FROM lacking)"""

ORACLES["point_to_cell"] = f"""WITH {with_views('points')}
SELECT point_id, {', '.join(f'coalesce({e}, -1) AS {c}' for c, e in CELL.items())} FROM points"""
ORACLES["province_bbox"] = f"""WITH {with_views('points')}
SELECT province, min(x) - 1000 AS xmin, max(x) + 1000 AS xmax, min(y) - 1000 AS ymin, max(y) + 1000 AS ymax
FROM points GROUP BY province"""
ORACLES["weather_bbox_scan"] = f"""WITH {with_views('points', 'weather')},
boxes AS ({ORACLES['province_bbox'].split(chr(10), 1)[1]})
SELECT obs_id, dates, x, y, {WEATHER} FROM weather w
WHERE dates BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
  AND EXISTS (SELECT 1 FROM boxes b WHERE w.x BETWEEN b.xmin AND b.xmax AND w.y BETWEEN b.ymin AND b.ymax)"""
ORACLES["weather_semi"] = f"WITH {MATCHED} SELECT cell, obs_id, dates, {WEATHER} FROM matched"
ORACLES["cells_without_weather"] = f"WITH {FILLED} SELECT coalesce(cell, -1) AS cell, dates FROM lacking"
ORACLES["weather_nest"] = f"""WITH {MATCHED}
SELECT cell, dates, {WEATHER}, row_number() OVER (PARTITION BY cell, dates ORDER BY {WEATHER}) - 1 AS place FROM matched"""
ORACLES["weather_gap_fill"] = f"""WITH {FILLED},
lists AS (SELECT cell AS _cell, dates AS _dates, count(*) AS n_rows, count(Precipitation) AS n_known,
  {each('coalesce(sum({v}), 0.0::DOUBLE) AS sum_{v}', WEATHER_VARS)} FROM filled GROUP BY cell, dates)
SELECT coalesce(cell, -1) AS cell, dates, obs_id, {WEATHER}, n_rows, n_known, {each('sum_{v}', WEATHER_VARS)}
FROM filled JOIN lists ON cell IS NOT DISTINCT FROM _cell AND dates IS NOT DISTINCT FROM _dates"""
ORACLES["weather_to_points"] = f"""WITH {FILLED}
SELECT point_id, province, dates, obs_id, {WEATHER} FROM placed p JOIN filled f ON f.cell IS NOT DISTINCT FROM p.cell"""
ORACLES["weather_coverage"] = f"""WITH {PLACED}, {GRIDDED},
flags AS (SELECT province, cell, cell IN (SELECT cell FROM gridded WHERE cell IS NOT NULL) AS has FROM placed)
SELECT province, count(*) AS n_points, count(DISTINCT cell) AS n_cells,
  count(DISTINCT CASE WHEN has THEN cell END) AS n_cells_with_weather,
  count(DISTINCT cell) = count(DISTINCT CASE WHEN has THEN cell END) AS complete
FROM flags GROUP BY province"""

# --- state ------------------------------------------------------------------------------------


def asof(dates) -> str:
    days = ", ".join(f"(DATE '{d}')" for d in dates)
    return f"""WITH {with_views('points', 'history')}, days AS (SELECT * FROM (VALUES {days}) AS t(date)),
requests AS (SELECT point_id, date FROM points CROSS JOIN days),
ranked AS (SELECT r.point_id, r.date, h.state_date, h.state,
    row_number() OVER (PARTITION BY r.point_id, r.date ORDER BY h.state_date DESC, h.state DESC) AS rn
  FROM requests r JOIN history h ON h.point_id = r.point_id
   AND h.state_date <= r.date - 1 AND h.state_date >= least(r.date - 1, DATE '{RUN_DATE}' - 387))
SELECT r.point_id, r.date, coalesce(CAST(k.state_date AS VARCHAR), 'initial') AS state_date,
  coalesce(k.state, -1) AS state
FROM requests r LEFT JOIN ranked k ON k.point_id = r.point_id AND k.date = r.date AND k.rn = 1"""


def simulation() -> str:
    days = ", ".join(f"(DATE '{d}')" for d in SIMULATED)
    soil = lambda s, k: f"(({s} + {k}) % 64) / 64.0::DOUBLE"
    state = "coalesce(k.state, -r.point_id)"
    return f"""WITH {FILLED}, {with_views('history')}, asked AS (SELECT * FROM (VALUES {days}) AS t(date)),
requests AS (SELECT point_id, province, cell, date FROM placed CROSS JOIN asked),
stored AS (SELECT point_id, state_date + {STATE_SHIFT} AS state_date, state FROM history),
ranked AS (SELECT r.point_id, r.date, CAST(h.state_date AS DATE) AS state_date, h.state,
    row_number() OVER (PARTITION BY r.point_id, r.date ORDER BY h.state_date DESC, h.state DESC) AS rn
  FROM requests r JOIN stored h ON h.point_id = r.point_id
   AND h.state_date <= r.date - 1 AND h.state_date >= least(r.date - 1, DATE '{SIMULATION_RUN}' - 387))
SELECT r.point_id, r.province, r.date, coalesce(CAST(k.state_date AS VARCHAR), 'initial') AS stored, {state} AS swc,
  CAST(2 AS BIGINT) AS layers, {soil(state, 0)} AS first_w, {soil(state, 1)} AS second_w,
  f.obs_id, {each('f.{v}', WEATHER_VARS)}
FROM requests r JOIN filled f ON f.cell IS NOT DISTINCT FROM r.cell AND f.dates = r.date
LEFT JOIN ranked k ON k.point_id = r.point_id AND k.date = r.date AND k.rn = 1"""


ORACLES["simulation_input"] = simulation()
ORACLES["state_asof"] = asof(FEW_DATES)
ORACLES["state_asof_window"] = asof(MANY_DATES)

BUCKET = f"""WITH RECURSIVE {with_views('points_obs')},
daily AS (SELECT point_id, date, sum(Precipitation / 8) - sum(AET + PET * 2) AS gain,
    row_number() OVER (PARTITION BY point_id ORDER BY date) AS rn FROM points_obs GROUP BY point_id, date),
steps AS (SELECT DISTINCT point_id, NULL::DATE AS date, CAST(0 AS BIGINT) AS rn,
    CAST({BUCKET_START} AS DOUBLE) AS storage FROM daily
  UNION ALL
  SELECT d.point_id, d.date, d.rn, least({BUCKET_CAPACITY}::DOUBLE, greatest(0.0::DOUBLE, s.storage + d.gain))
  FROM steps s JOIN daily d ON d.point_id = s.point_id AND d.rn = s.rn + 1)"""
ORACLES["state_fold"] = f"""{BUCKET}
SELECT point_id, max(rn) AS n_days, arg_max(storage, rn) AS storage FROM steps GROUP BY point_id"""
ORACLES["state_trajectory"] = f"{BUCKET} SELECT point_id, date, storage FROM steps WHERE rn > 0"

# --- regions ----------------------------------------------------------------------------------

REGIONS = with_views("municipios", "comarcas", "provincias") + """,
all_polygons AS (SELECT * FROM municipios UNION ALL SELECT * FROM comarcas UNION ALL SELECT * FROM provincias),
regions AS (SELECT admin_level, polygon_id,
    CASE WHEN admin_level = 'provincia' THEN "ine.prov.name" ELSE name END AS name, cpro AS province_code, wkt
  FROM all_polygons
  WHERE ("ine.prov.name" IS NULL OR "ine.prov.name" NOT IN
         ('Ceuta', 'Melilla', 'Palmas, Las', 'Santa Cruz de Tenerife'))
    AND cpro IS NOT NULL AND NOT (admin_level = 'municipio' AND name IS NULL))"""
ORACLES["admin_polygons_clean"] = f"WITH {REGIONS} SELECT * FROM regions"


def ring_edges(vertices) -> list[tuple]:
    return list(zip(vertices, vertices[1:] + vertices[:1]))


def edge_rows(level: str, table: str, key: str, origin: str, vertices, where: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{level}' AS admin_level, {key} AS polygon_id, CAST({ax} AS DOUBLE) AS ax, CAST({ay} AS DOUBLE) AS ay, "
        f"CAST({bx} AS DOUBLE) AS bx, CAST({by} AS DOUBLE) AS by_ FROM (SELECT *, {origin} FROM {table}) {where}"
        for (ax, ay), (bx, by) in ring_edges(vertices)
    )


NATION = "(n_nationkey % 5) * 2000 AS x0, CAST(floor(n_nationkey / 5) AS INT) * 2000 AS y0"
REGION = "r_regionkey * 2000 AS x0"
EDGES = "edges AS (" + " UNION ALL ".join([
    edge_rows("municipio", "nation", "n_nationkey", NATION,
              [("x0", "y0"), ("x0 + 2300", "y0 + 100"), ("x0 + 1000", "y0 + 2200")]),
    edge_rows("comarca", "nation", "n_nationkey", NATION,
              [("x0", "y0"), ("x0 + 2000", "y0"), ("x0 + 2000", "y0 + 2000"), ("x0", "y0 + 2000")]),
    edge_rows("provincia", "region", "r_regionkey", REGION,
              [("x0", "0"), ("x0 + 2000", "0"), ("x0 + 2000", "10000"), ("x0", "10000")]),
    edge_rows("provincia", "region", "r_regionkey", REGION,
              [("4500", "4500"), ("5500", "4500"), ("5500", "5500"), ("4500", "5500")], "WHERE r_regionkey = 2"),
]) + ")"
LOCATED = f"""{with_views('points')}, {REGIONS}, {EDGES},
located AS (SELECT point_id, admin_level, polygon_id FROM points, edges GROUP BY ALL
  HAVING bool_or((bx - ax) * (y - ay) - (by_ - ay) * (x - ax) = 0
           AND x BETWEEN least(ax, bx) AND greatest(ax, bx) AND y BETWEEN least(ay, by_) AND greatest(ay, by_))
    OR count(*) FILTER (WHERE (ay > y) <> (by_ > y) AND x < (bx - ax) * (y - ay) / nullif(by_ - ay, 0) + ax) % 2 = 1)"""
# the same in degrees, where straight borders stay straight: only the points are moved
LOCATED_DEGREES = LOCATED.replace(
    with_views("points"), with_views("points").replace("SELECT ", "SELECT point_id, province, x + {}::DOUBLE AS x, y + {}::DOUBLE AS y FROM (SELECT ".format(*OFF_BORDER), 1)[:-1] + "))", 1)
MEANS = each("sum({v}) FILTER (WHERE NOT isnan({v})) / nullif(count({v}) FILTER (WHERE NOT isnan({v})), 0)::DOUBLE AS {v}")


def regional(source: str) -> str:
    return f"""SELECT date, {MEANS}, any_value(r.name) AS name, any_value(r.province_code) AS province_code,
  any_value(r.wkt) AS geom, admin_level, polygon_id
FROM {source} JOIN located USING (point_id) JOIN regions r USING (admin_level, polygon_id)
GROUP BY admin_level, polygon_id, date"""


ORACLES["poly_daily_means"] = f"WITH {CLEAN}, {LOCATED} {regional('clean')}"
ORACLES["regional_degrees"] = f"SELECT * EXCLUDE (geom) FROM (WITH {CLEAN}, {LOCATED_DEGREES} {regional('clean')})"
ORACLES["timeseries_publish"] = f"WITH {CLEAN}, {LOCATED} {regional('clean')}"
ORACLES["daily_means_filter"] = f"""WITH {with_views('points_obs')}, {LOCATED}
SELECT admin_level, polygon_id, date, {MEANS} FROM points_obs JOIN located USING (point_id)
JOIN regions USING (admin_level, polygon_id) GROUP BY admin_level, polygon_id, date"""
ORACLES["wkt_rings"] = f"""WITH {REGIONS},
outer_rings AS (
  SELECT 'municipio' AS admin_level, n_nationkey AS polygon_id, 0 AS ring, 4 AS n_vertices,
    CAST(4 * x0 + 3300 AS DOUBLE) AS sum_x, CAST(4 * y0 + 2300 AS DOUBLE) AS sum_y FROM (SELECT *, {NATION} FROM nation)
  UNION ALL SELECT 'comarca', n_nationkey, 0, 5, 5 * x0 + 4000, 5 * y0 + 4000 FROM (SELECT *, {NATION} FROM nation)
  UNION ALL SELECT 'provincia', r_regionkey, 0, 5, 5 * x0 + 4000, 20000 FROM (SELECT *, {REGION} FROM region)
  UNION ALL SELECT 'provincia', r_regionkey, 1, 5, 24500, 24500 FROM region WHERE r_regionkey = 2)
SELECT admin_level, polygon_id, regexp_replace(wkt, '([0-9]+)', '\\1.0', 'g') AS wkt, ring, n_vertices, sum_x, sum_y
FROM outer_rings JOIN all_polygons USING (admin_level, polygon_id)"""

# --- grid, colours and images -----------------------------------------------------------------


def layers(grid, shift_x: float = 0.0, shift_y: float = 0.0) -> str:
    at = cell(grid, f"(x + {shift_x}::DOUBLE)", f"(y + {shift_y}::DOUBLE)")["cell"]
    return f"""{CLEAN}, {with_views('points')},
on_cells AS (SELECT m.*, {at} AS cell FROM clean m JOIN points USING (point_id)),
scattered AS (SELECT date, cell, {VARS} FROM
  (SELECT *, row_number() OVER (PARTITION BY date, cell ORDER BY obs_id DESC) AS rn FROM on_cells
   WHERE cell IS NOT NULL) WHERE rn = 1),
blocks AS (SELECT date, ((cell - 1) // {grid.ncol}) // 4 AS row, ((cell - 1) % {grid.ncol}) // 4 AS col,
    {each('sum({v}) FILTER (WHERE NOT isnan({v})) / nullif(count({v}) FILTER (WHERE NOT isnan({v})), 0)::DOUBLE AS {v}')}
  FROM scattered GROUP BY ALL)"""


def long(source: str, ids: str) -> str:
    return " UNION ALL ".join(f"SELECT {ids}, '{v}' AS var, {v} AS value FROM {source}" for v in INDICATORS)


LAYERS = layers(GRID)
SCALED = f"{LAYERS}, scaled AS (SELECT date, row, col, {each('round({v} * 1000::DOUBLE) AS {v}')} FROM blocks)"
RANGES = f"""{SCALED}, pixels AS ({long('scaled', 'date, row, col')}),
ranges AS (SELECT date, var, min(value) AS min_value, max(value) AS max_value FROM pixels GROUP BY date, var)"""


def coloured(source: str, ids: str) -> str:
    """CTEs that give every row of ``source`` (ids, var, value) its ramp colour."""
    def anchor_rows(breaks) -> str:
        return ", ".join(f"({i}, {b}::DOUBLE, '{c}')" for i, (b, c) in enumerate(zip(breaks, RAMP_COLOURS)))

    def linear(at: int) -> str:
        c = f"(('0x' || substr(hex, {at}, 2))::INT / 255::DOUBLE)"
        return f"CASE WHEN {c} <= 0.04045 THEN {c} / 12.92::DOUBLE ELSE pow(({c} + 0.055::DOUBLE) / 1.055::DOUBLE, 2.4::DOUBLE) END"

    def lab_f(c: str) -> str:
        return f"CASE WHEN {c} > 216::DOUBLE / 24389 THEN pow({c}, 1::DOUBLE / 3) ELSE (24389::DOUBLE / 27 * {c} + 16) / 116 END"

    def back(f: str) -> str:
        return f"CASE WHEN {f} * {f} * {f} > 216::DOUBLE / 24389 THEN {f} * {f} * {f} ELSE (116 * {f} - 16) / (24389::DOUBLE / 27) END"

    def byte(c: str) -> str:
        g = f"CASE WHEN {c} <= 0.0031308 THEN {c} * 12.92::DOUBLE ELSE 1.055::DOUBLE * pow(greatest({c}, 0), 1 / 2.4::DOUBLE) - 0.055::DOUBLE END"
        return f"printf('%02X', CAST(round(255 * greatest(0, least(1, {g}))) AS INT))"

    return f"""stops AS (
  SELECT false AS is_psi, * FROM (VALUES {anchor_rows(EVEN_BREAKS)}) AS t(k, pos, hex)
  UNION ALL SELECT true, * FROM (VALUES {anchor_rows(PSI_BREAKS)}) AS t(k, pos, hex)),
lin AS (SELECT is_psi, k, pos, {linear(2)} AS r, {linear(4)} AS g, {linear(6)} AS b FROM stops),
xyz AS (SELECT is_psi, k, pos,
  (0.4124564::DOUBLE * r + 0.3575761::DOUBLE * g + 0.1804375::DOUBLE * b) / 0.95047::DOUBLE AS x,
  (0.2126729::DOUBLE * r + 0.7151522::DOUBLE * g + 0.0721750::DOUBLE * b) AS y,
  (0.0193339::DOUBLE * r + 0.1191920::DOUBLE * g + 0.9503041::DOUBLE * b) / 1.08883::DOUBLE AS z FROM lin),
lab AS (SELECT is_psi, k, pos, 116 * {lab_f('y')} - 16 AS l, 500 * ({lab_f('x')} - {lab_f('y')}) AS a,
  200 * ({lab_f('y')} - {lab_f('z')}) AS b FROM xyz),
pieces AS (SELECT s.is_psi, s.k, s.pos AS at0, e.pos AS at1, s.l AS l0, e.l AS l1, s.a AS a0, e.a AS a1, s.b AS b0, e.b AS b1
  FROM lab s JOIN lab e ON e.is_psi = s.is_psi AND e.k = s.k + 1),
shares AS (SELECT s.*, r.min_value, r.max_value,
    CASE WHEN r.max_value = r.min_value THEN 0.5::DOUBLE
         ELSE (value - r.min_value) / nullif(r.max_value - r.min_value, 0) END AS share
  FROM {source} s JOIN ranges r ON r.date = s.date AND r.var = s.var),
places AS (SELECT *, CASE WHEN var IN ('DDS', 'SFP', 'CFP') THEN 1 - share ELSE share END AS t FROM shares
  WHERE value IS NOT NULL),
mixed AS (SELECT p.*, l0 + (l1 - l0) * ((t - at0) / (at1 - at0)) AS l, a0 + (a1 - a0) * ((t - at0) / (at1 - at0)) AS a,
    b0 + (b1 - b0) * ((t - at0) / (at1 - at0)) AS b
  FROM places p JOIN pieces q ON q.is_psi = (p.var = 'Psi') AND t >= at0 AND (t < at1 OR (k = 7 AND t <= 1))),
fs AS (SELECT *, (l + 16) / 116 AS fy, (l + 16) / 116 + a / 500 AS fx, (l + 16) / 116 - b / 200 AS fz FROM mixed),
tri AS (SELECT *, 0.95047::DOUBLE * ({back('fx')}) AS tx, {back('fy')} AS ty, 1.08883::DOUBLE * ({back('fz')}) AS tz FROM fs),
rgb AS (SELECT *, 3.2404542::DOUBLE * tx - 1.5371385::DOUBLE * ty - 0.4985314::DOUBLE * tz AS lr,
    -0.9692660::DOUBLE * tx + 1.8760108::DOUBLE * ty + 0.0415560::DOUBLE * tz AS lg,
    0.0556434::DOUBLE * tx - 0.2040259::DOUBLE * ty + 1.0572252::DOUBLE * tz AS lb FROM tri),
coloured AS (SELECT {ids}, var, value, '#' || {byte('lr')} || {byte('lg')} || {byte('lb')} AS colour FROM rgb
  UNION ALL SELECT {ids}, var, value, '#FFFFFF00' FROM {source} WHERE value IS NULL)"""


COLOURED = f"{RANGES}, {coloured('pixels', 'date, row, col')}"

ORACLES["grid_scatter"] = f"WITH {LAYERS} SELECT * FROM scattered"
ORACLES["block_mean"] = f"WITH {LAYERS} SELECT * FROM blocks"
ORACLES["scaled_round"] = f"""WITH {with_views('points_obs')},
s AS (SELECT obs_id, {each('round({v} / 3::DOUBLE * 1000::DOUBLE) AS {v}', ('Theta', 'REW', 'PET', 'LAI'))} FROM points_obs)
SELECT *, Theta / 1000::DOUBLE AS theta_back FROM s"""
ORACLES["unpivot_vars"] = f"WITH {with_views('points_obs')} {long('points_obs', 'obs_id')}"
ORACLES["var_ranges"] = f"WITH {RANGES} SELECT * FROM ranges"
ORACLES["colour_ramp"] = f"WITH {COLOURED} SELECT date, var, row, col, value, colour FROM coloured WHERE var <> 'Psi'"
ORACLES["colour_ramp_psi"] = f"WITH {COLOURED} SELECT date, row, col, value, colour FROM coloured WHERE var = 'Psi'"
ORACLES["colour_lookup"] = f"""WITH {RANGES}, vals AS (SELECT DISTINCT date, var, value FROM pixels),
{coloured('vals', 'date')} SELECT date, var, value, colour FROM coloured"""
ORACLES["colour_rgb"] = f"""WITH {COLOURED}
SELECT colour, count(*) AS n_pixels, ('0x' || substr(colour, 2, 2))::INT AS red,
  ('0x' || substr(colour, 4, 2))::INT AS green, ('0x' || substr(colour, 6, 2))::INT AS blue
FROM coloured GROUP BY colour"""
ORACLES["image_pixels"] = f"""WITH {COLOURED}
SELECT strftime(date, '%Y%m%d') AS date, var, row, col, colour FROM coloured WHERE value IS NOT NULL"""
ORACLES["image_legend"] = f"""WITH {RANGES}
SELECT strftime(date, '%Y%m%d') AS date, var, 'ag_GrnYl' AS palette_selected,
  0.0::DOUBLE AS left_ext, 0.0::DOUBLE AS down_ext, 10000.0::DOUBLE AS right_ext, 10000.0::DOUBLE AS up_ext,
  min_value / 1000::DOUBLE AS min_value, max_value / 1000::DOUBLE AS max_value FROM ranges"""


# GRS80 and zone 30, as published: rectifying radius times scale, eccentricity, and the
# coefficients of the series between the sphere and the plane, to the fourth power of the third flattening.
TM_RADIUS = 0.9996 * 6367449.145771047
TM_ECCENTRICITY = 0.08181919104281579
TM_ALPHA = (0.0008377318247344344, 7.608527788826163e-07, 1.1976380191731534e-09, 2.4433762425103678e-12)
TM_BETA = (0.000837732168164144, 5.90586962608273e-08, 1.6734889049883462e-10, 2.167737805596757e-13)


def _terms(coefficients, term) -> str:
    return " + ".join(f"({c!r}::DOUBLE) * {term(2 * j)}" for j, c in enumerate(coefficients, start=1))


def degrees_sql(source: str, keep: str) -> str:
    """SELECT with lon and lat from x and y of ``source``; the latitude by three Newton steps from the conformal one."""
    radius, ecc = f"({TM_RADIUS!r}::DOUBLE)", f"({TM_ECCENTRICITY!r}::DOUBLE)"
    inner = f"""SELECT *, sin(xi0) / sqrt(sinh(eta0) * sinh(eta0) + cos(xi0) * cos(xi0)) AS goal,
      degrees(atan2(sinh(eta0), cos(xi0))) - 3 AS lon FROM (SELECT *,
      xi - ({_terms(TM_BETA, lambda k: f'sin({k} * xi) * cosh({k} * eta)')}) AS xi0,
      eta - ({_terms(TM_BETA, lambda k: f'cos({k} * xi) * sinh({k} * eta)')}) AS eta0
      FROM (SELECT *, y / {radius} AS xi, (x - 500000) / {radius} AS eta FROM {source}))"""
    step = f"SELECT *, goal / (1 - {ecc} * {ecc}) AS tau0 FROM ({inner})"
    for i in range(3):
        step = f"""SELECT *, tau{i} + (goal - at{i}) / sqrt(1 + at{i} * at{i}) * (1 + (1 - {ecc} * {ecc}) * tau{i} * tau{i})
            / ((1 - {ecc} * {ecc}) * sqrt(1 + tau{i} * tau{i})) AS tau{i + 1} FROM (
          SELECT *, tau{i} * sqrt(1 + s{i} * s{i}) - s{i} * sqrt(1 + tau{i} * tau{i}) AS at{i} FROM (
            SELECT *, sinh({ecc} * atanh({ecc} * tau{i} / sqrt(1 + tau{i} * tau{i}))) AS s{i} FROM ({step})))"""
    return f"SELECT {keep}, lon, degrees(atan(tau3)) AS lat FROM ({step})"


def metres_sql(source: str, keep: str) -> str:
    """SELECT with x and y from lon and lat of ``source``."""
    radius, ecc = f"({TM_RADIUS!r}::DOUBLE)", f"({TM_ECCENTRICITY!r}::DOUBLE)"
    return f"""SELECT {keep},
    500000 + {radius} * (eta + {_terms(TM_ALPHA, lambda k: f'cos({k} * xi) * sinh({k} * eta)')}) AS x,
    {radius} * (xi + {_terms(TM_ALPHA, lambda k: f'sin({k} * xi) * cosh({k} * eta)')}) AS y
  FROM (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta
    FROM (SELECT *, radians(lon + 3) AS lam,
      sinh(atanh(sin(radians(lat))) - {ecc} * atanh({ecc} * sin(radians(lat)))) AS t FROM {source}))"""


ORACLES["project_tm"] = f"""WITH {with_views('points')},
utm AS (SELECT point_id, x + 400000 AS x, y + 4400000 AS y FROM points),
deg AS ({degrees_sql('utm', 'point_id')}), back AS ({metres_sql('deg', 'point_id, lon, lat')})
SELECT point_id, round(lon, 6) AS lon, round(lat, 6) AS lat, round(x, 3) AS x, round(y, 3) AS y FROM back"""
ORACLES["cell_lonlat"] = f"""WITH {LAYERS},
cells AS (SELECT row, col, count(*) AS n_days, {UTM_GRID.xmin} + (col + 0.5::DOUBLE) * 400 AS x,
  {UTM_GRID.ymax} - (row + 0.5::DOUBLE) * 400 AS y FROM blocks GROUP BY row, col),
deg AS ({degrees_sql('cells', 'row, col, n_days')})
SELECT row, col, n_days, round(lon, 6) AS lon, round(lat, 6) AS lat FROM deg"""

# the target grid from its rule: square cells over the border of the source, 64 pieces a side, seen in degrees
ORACLES["grid_resample_bilinear"] = f"""WITH {layers(UTM_GRID, UTM_GRID.xmin, UTM_GRID.ymin)},
places AS (SELECT CAST(i AS DOUBLE) / 64 AS share FROM range(0, 65) AS t(i)),
ends AS (SELECT unnest([0.0::DOUBLE, 1.0::DOUBLE]) AS side),
border AS (SELECT {UTM_GRID.xmin} + share * 10000 AS x, {UTM_GRID.ymin} + side * 10000 AS y FROM places, ends
  UNION ALL SELECT {UTM_GRID.xmin} + side * 10000, {UTM_GRID.ymin} + share * 10000 FROM places, ends),
box AS (SELECT round(min(lon), 9) AS west, round(max(lat), 9) AS north,
  round(greatest((max(lon) - min(lon)) / {TARGET_COLS}, (max(lat) - min(lat)) / {TARGET_ROWS}), 12) AS res
  FROM ({degrees_sql('border', 'x, y')})),
target AS (SELECT CAST(i // {TARGET_COLS} AS BIGINT) AS trow, CAST(i % {TARGET_COLS} AS BIGINT) AS tcol
  FROM range(0, {TARGET_COLS * TARGET_ROWS}) AS t(i)),
centres AS (SELECT trow, tcol, west + (tcol + 0.5::DOUBLE) * res AS lon, north - (trow + 0.5::DOUBLE) * res AS lat FROM target, box),
placed AS (SELECT trow, tcol, (x - {UTM_GRID.xmin}) / 400::DOUBLE - 0.5::DOUBLE AS fx,
  ({UTM_GRID.ymax} - y) / 400::DOUBLE - 0.5::DOUBLE AS fy FROM ({metres_sql('centres', 'trow, tcol')})),
near AS (SELECT trow, tcol, b.*, (1 - abs(fx - b.col)) * (1 - abs(fy - b.row)) AS w
  FROM placed p JOIN blocks b ON abs(fx - b.col) < 1 AND abs(fy - b.row) < 1)
SELECT date, trow AS row, tcol AS col, {each('round(sum(w * {v}) / sum(CASE WHEN {v} IS NOT NULL THEN w END), 4) AS {v}')}
FROM near GROUP BY date, trow, tcol"""


def ring_rows(level: str, table: str, key: str, origin: str, ring: int, vertices, where: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{level}' AS admin_level, {key} AS polygon_id, {ring} AS ring, {k} AS vertex, "
        f"CAST({x} AS DOUBLE) / 100000::DOUBLE - 4::DOUBLE AS lon, CAST({y} AS DOUBLE) / 100000::DOUBLE + 40::DOUBLE AS lat "
        f"FROM (SELECT *, {origin} FROM {table}) {where}"
        for k, (x, y) in enumerate([*vertices, vertices[0]])
    )


_VERTICES = " UNION ALL ".join([
    ring_rows("municipio", "nation", "n_nationkey", NATION, 0,
              [("x0", "y0"), ("x0 + 2300", "y0 + 100"), ("x0 + 1000", "y0 + 2200")]),
    ring_rows("comarca", "nation", "n_nationkey", NATION, 0,
              [("x0", "y0"), ("x0 + 2000", "y0"), ("x0 + 2000", "y0 + 2000"), ("x0", "y0 + 2000")]),
    ring_rows("provincia", "region", "r_regionkey", REGION, 0,
              [("x0", "0"), ("x0 + 2000", "0"), ("x0 + 2000", "10000"), ("x0", "10000")]),
    ring_rows("provincia", "region", "r_regionkey", REGION, 1,
              [("4500", "4500"), ("5500", "4500"), ("5500", "5500"), ("4500", "5500")], "WHERE r_regionkey = 2"),
])
ORACLES["project_polygons"] = f"""WITH vertices AS ({_VERTICES}),
metres AS ({metres_sql('vertices', 'admin_level, polygon_id, ring, vertex')})
SELECT admin_level, polygon_id, ring, vertex, round(x, 3) AS x, round(y, 3) AS y FROM metres"""
