"""Input views over the given tables, in SQL both engines read.

Each view is one SELECT over a table. Spark runs it through ``selectExpr`` and
the checks put the same text into a WITH clause, so both sides start from the
same rows. Values are multiples of 1/8 or 1/64: sums of them are exact and
compare bit for bit. Several columns hold NULL, NaN or sentinels on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daymosaic.schemas import GridSpec

GRID = GridSpec(0.0, 10000.0, 0.0, 10000.0, 100.0)
UTM_GRID = GridSpec(400000.0, 410000.0, 4400000.0, 4410000.0, 100.0)

NAN = "CAST('NaN' AS DOUBLE)"


def _d(expression: str, n: int) -> str:
    return f"CAST({expression} AS DOUBLE) / CAST({n} AS DOUBLE)"


def _minus(expression: str, n: int) -> str:
    return f"CAST(0 AS DOUBLE) - {_d(expression, n)}"


_X = "CAST(({0} * 7919) % 10007 AS DOUBLE)"
_Y = "CAST(({0} * 104729) % 10009 AS DOUBLE)"
_STATION = "((event_id * 3) % 2000)"

VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "points": ("customer", {
        "point_id": "c_custkey",
        "province": "c_nationkey",
        "x": _X.format("c_custkey"),
        "y": _Y.format("c_custkey"),
    }),
    "points_obs": ("orders", {
        "obs_id": "o_orderkey",
        "point_id": "o_custkey",
        "date": "CAST(o_orderdate AS DATE)",
        "Theta": _d("(o_orderkey * 3) % 8", 8),
        "REW": _d("(o_orderkey * 5) % 800", 8),
        "PET": _d("(o_orderkey * 7) % 64", 8),
        "Precipitation": _d("(o_orderkey * 11) % 400", 8),
        "AET": _d("(o_orderkey * 13) % 72", 8),
        "ELW": _d("(o_orderkey * 17) % 80", 8),
        "LAI": _d("(o_orderkey * 19) % 48", 8),
        "DFMC": _d("(o_orderkey * 23) % 240", 8),
        "SFP": _d("(o_orderkey * 29) % 80", 8),
        "CFP": _d("(o_orderkey * 31) % 88", 8),
        "Psi": "CASE WHEN o_orderkey % 17 = 0 THEN CAST(-40 AS DOUBLE) WHEN o_orderkey % 19 = 0 THEN NULL "
               f"WHEN o_orderkey % 23 = 0 THEN {NAN} ELSE {_minus('o_orderkey % 40', 8)} END",
        "DDS": f"CASE WHEN o_orderkey % 29 = 0 THEN {NAN} WHEN o_orderkey % 31 = 0 THEN NULL "
               f"ELSE {_d('(o_orderkey * 37) % 800', 8)} END",
        "LFMC": f"CASE WHEN o_orderkey % 41 = 0 THEN {NAN} ELSE {_d('(o_orderkey * 43) % 1600', 8)} END",
    }),
    "water": ("orders", {
        "obs_id": "o_orderkey",
        "Rain": _d("(o_orderkey * 7) % 400", 8),
        "Snow": _d("(o_orderkey * 3) % 16", 8),
        "PET": _d("(o_orderkey * 5) % 64", 8),
        "NetRain": _d("(o_orderkey * 11) % 300", 8),
        "SoilEvaporation": _d("(o_orderkey * 13) % 24", 8),
        "Transpiration": _d("(o_orderkey * 17) % 48", 8),
        "Runoff": _d("(o_orderkey * 19) % 32", 8),
        "DeepDrainage": _d("(o_orderkey * 23) % 40", 8),
        "error": "CASE WHEN o_orderkey % 37 = 0 THEN 'failed' END",
    }),
    # the layers of an observation are ranked by (l_linenumber, l_partkey, l_suppkey)
    "soil_layers": ("lineitem", {
        "obs_id": "l_orderkey",
        "l_linenumber": "l_linenumber",
        "l_partkey": "l_partkey",
        "l_suppkey": "l_suppkey",
        "W": f"CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE {_d('l_quantity', 64)} END",
        "theta": f"CASE WHEN l_suppkey % 53 = 0 THEN NULL ELSE {_d('l_suppkey % 64', 64)} END",
        "psi": _minus("l_partkey % 40", 8),
        "waterWP": _d("l_partkey % 16", 64),
        "waterFC": "CASE WHEN l_orderkey % 101 = 0 THEN CAST(0 AS DOUBLE) "
                   f"ELSE {_d('16 + l_partkey % 48', 64)} END",
    }),
    "cohorts": ("lineitem", {
        "obs_id": "l_orderkey",
        "LAI": "CASE WHEN l_orderkey % 11 = 0 THEN CAST(0 AS DOUBLE) WHEN l_partkey % 13 = 0 THEN NULL "
               f"ELSE {_d('l_quantity', 8)} END",
        "DDS": f"CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE {_d('l_partkey % 128', 128)} END",
        "LFMC": _d("l_partkey % 1024", 8),
    }),
    "weather": ("events", {
        "obs_id": "event_id",
        "station": _STATION,
        "x": _X.format(_STATION),
        "y": _Y.format(_STATION),
        "dates": "CAST(ts AS DATE)",
        "MeanTemperature": _d("(event_id * 3) % 320", 8),
        "MinTemperature": _d("(event_id * 5) % 240", 8),
        "MaxTemperature": _d("(event_id * 7) % 400", 8),
        "MeanRelativeHumidity": _d("(event_id * 9) % 800", 8),
        "MinRelativeHumidity": _d("(event_id * 11) % 640", 8),
        "MaxRelativeHumidity": _d("(event_id * 13) % 800", 8),
        "Precipitation": _d("(event_id * 17) % 400", 8),
        "Radiation": _d("(event_id * 19) % 240", 8),
        "WindSpeed": _d("(event_id * 23) % 80", 8),
        "PET": _d("(event_id * 27) % 64", 8),
        "ThermalAmplitude": _d("(event_id * 29) % 160", 8),
    }),
    "history": ("orders", {
        "point_id": "o_custkey",
        "state_date": "CAST(o_orderdate AS DATE)",
        "state": "o_orderkey",
    }),
    "run_log": ("events", {
        "run_date": "CAST(ts AS DATE)",
        "target": "concat('t', CAST(user_id % 64 AS VARCHAR(20)))",
        "status": "CASE WHEN event_type IN ('click', 'view') THEN 'completed' "
                  "WHEN event_type IN ('signup', 'purchase') THEN 'skipped' ELSE 'errored' END",
    }),
    # file names: 48 province codes and more, some of which are excluded
    "input_files": ("customer", {
        "point_id": "c_custkey",
        "path": "concat('data-raw/province_', CAST(c_custkey % 50 AS VARCHAR(20)), '_', "
                "CAST(c_custkey AS VARCHAR(20)), '_initialized.rds')",
    }),
    "day_paths": ("orders", {
        "obs_id": "o_orderkey",
        "date": "CAST(o_orderdate AS DATE)",
        "uri": "concat('s3://bucket/year=', CAST(year(o_orderdate) AS VARCHAR(10)), '/month=', "
               "CAST(month(o_orderdate) AS VARCHAR(10)), '/day=', CAST(day(o_orderdate) AS VARCHAR(10)), '/')",
        "init_file": "concat('data-raw/province_', CAST(o_custkey % 50 AS VARCHAR(20)), '_initialized.rds')",
        "file": "concat('out/province_', CAST(o_custkey % 50 AS VARCHAR(20)), '_', "
                "CASE WHEN o_orderkey % 13 = 0 THEN 'initialized' ELSE "
                "concat(CAST(year(o_orderdate) AS VARCHAR(10)), lpad(CAST(month(o_orderdate) AS VARCHAR(10)), 2, '0'), "
                "lpad(CAST(day(o_orderdate) AS VARCHAR(10)), 2, '0')) END, '.rds')",
    }),
}

_NX = "((n_nationkey % 5) * 2000)"
_NY = "(CAST(floor(n_nationkey / 5) AS INT) * 2000)"
_CODE = "CASE WHEN n_nationkey = 11 THEN NULL ELSE lpad(CAST(n_nationkey AS VARCHAR(10)), 2, '0') END"


def _vertex(x: str, y: str) -> str:
    return f"CAST({x} AS VARCHAR(20)), ' ', CAST({y} AS VARCHAR(20))"


def _ring(*vertices: tuple[str, str]) -> str:
    return ", ', ', ".join(_vertex(x, y) for x, y in vertices)


_PROVINCE = (
    "CASE WHEN n_nationkey = 7 THEN 'Ceuta' WHEN n_nationkey = 8 THEN NULL "
    "ELSE concat('P', CAST(n_nationkey AS VARCHAR(10))) END"
)
_RX = "(r_regionkey * 2000)"
_HOLE = (
    "CASE WHEN r_regionkey = 2 THEN ', (4500 4500, 5500 4500, 5500 5500, 4500 5500, 4500 4500)' ELSE '' END"
)

VIEWS["municipios"] = ("nation", {
    "admin_level": "'municipio'",
    "polygon_id": "n_nationkey",
    "name": "CASE WHEN n_nationkey = 9 THEN NULL ELSE concat('M', CAST(n_nationkey % 20 AS VARCHAR(10))) END",
    "`ine.prov.name`": _PROVINCE,
    "cpro": _CODE,
    "wkt": "concat('POLYGON ((', " + _ring(
        (_NX, _NY), (f"({_NX} + 2300)", f"({_NY} + 100)"), (f"({_NX} + 1000)", f"({_NY} + 2200)"), (_NX, _NY),
    ) + ", '))')",
})
VIEWS["comarcas"] = ("nation", {
    "admin_level": "'comarca'",
    "polygon_id": "n_nationkey",
    "name": "CASE WHEN n_nationkey = 9 THEN NULL ELSE concat('C', CAST(n_nationkey AS VARCHAR(10))) END",
    "`ine.prov.name`": _PROVINCE,
    "cpro": _CODE,
    "wkt": "concat('POLYGON ((', " + _ring(
        (_NX, _NY), (f"({_NX} + 2000)", _NY), (f"({_NX} + 2000)", f"({_NY} + 2000)"),
        (_NX, f"({_NY} + 2000)"), (_NX, _NY),
    ) + ", '))')",
})
VIEWS["provincias"] = ("region", {
    "admin_level": "'provincia'",
    "polygon_id": "r_regionkey",
    "name": "'unused'",
    "`ine.prov.name`": "concat('R', CAST(r_regionkey AS VARCHAR(10)))",
    "cpro": "lpad(CAST(r_regionkey AS VARCHAR(10)), 2, '0')",
    "wkt": "concat('POLYGON ((', " + _ring(
        (_RX, "0"), (f"({_RX} + 2000)", "0"), (f"({_RX} + 2000)", "10000"), (_RX, "10000"), (_RX, "0"),
    ) + f", ')', {_HOLE}, ')')",
})

LEVEL_VIEWS = ("municipios", "comarcas", "provincias")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three levels in one table."""
    first, *rest = [view(spark, sf_dir, name) for name in LEVEL_VIEWS]
    for other in rest:
        first = first.unionByName(other)
    return first


def sql(name: str) -> str:
    """The view as SELECT text for the checking engine."""
    source, columns = VIEWS[name]
    return "SELECT " + ", ".join(
        f'{e} AS {c.replace("`", chr(34))}' for c, e in columns.items()
    ) + f" FROM {source}"


def with_views(*names: str) -> str:
    """``name AS (SELECT ...), ...`` for a WITH clause."""
    return ", ".join(f"{n} AS ({sql(n)})" for n in names)


# --- nested results: one struct per order, layers and cohorts made from its key ---------------

def nested_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested simulation results, one per order; some have no layer or no cohort.

    The arrays are built inside each row, so nothing is gathered to make them.
    """
    layer = """named_struct(
        'layer', i,
        'W', CASE WHEN (o_orderkey + i) % 97 = 0 THEN NULL ELSE CAST((o_orderkey * i) % 128 AS DOUBLE) / 64D END,
        'theta', CASE WHEN (o_orderkey + i) % 53 = 0 THEN NULL ELSE CAST((o_orderkey * 3 + i) % 64 AS DOUBLE) / 64D END,
        'psi', 0D - CAST((o_orderkey + i * 7) % 40 AS DOUBLE) / 8D,
        'waterWP', CAST((o_orderkey + i) % 16 AS DOUBLE) / 64D,
        'waterFC', CASE WHEN o_orderkey % 101 = 0 THEN 0D ELSE CAST(16 + (o_orderkey + i) % 48 AS DOUBLE) / 64D END)"""
    cohort = """named_struct(
        'LAI', CASE WHEN o_orderkey % 11 = 0 THEN 0D WHEN (o_orderkey + i) % 13 = 0 THEN NULL
               ELSE CAST((o_orderkey * i) % 50 AS DOUBLE) / 8D END,
        'DDS', CASE WHEN (o_orderkey + i) % 7 = 0 THEN NULL ELSE CAST((o_orderkey + i) % 128 AS DOUBLE) / 128D END,
        'LFMC', CAST((o_orderkey * i) % 1024 AS DOUBLE) / 8D)"""
    orders = table(spark, sf_dir, "orders")
    water = VIEWS["water"][1]
    record = ", ".join(f"'{c}', {e}" for c, e in water.items() if c not in ("obs_id", "error"))
    obs = VIEWS["points_obs"][1]
    return orders.selectExpr(
        "o_orderkey AS obs_id",
        "o_custkey AS point_id",
        "CAST(o_orderdate AS DATE) AS date",
        f"""named_struct(
            'WaterBalance', named_struct({record}),
            'Stand', named_struct('LAIexpanded', {obs['LAI']}),
            'Plants', transform(slice(sequence(0, 4), 2, CAST(o_orderkey % 4 AS INT)), i -> {cohort}),
            'FireHazard', named_struct('DFMC [%]', {obs['DFMC']}, 'SFP', {obs['SFP']}, 'CFP', {obs['CFP']})
        ) AS result""",
        f"""named_struct(
            'soil', transform(slice(sequence(0, 4), 2, CAST(o_orderkey % 5 AS INT)), i -> {layer}),
            'control', named_struct('soilFunctions', 'SX')
        ) AS state""",
        f"{water['error']} AS error",
    )
