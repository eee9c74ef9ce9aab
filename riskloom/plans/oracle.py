"""Independent DuckDB SQL for every oracle-checkable query.

Written against the raw driver tables (views ``events``, ``embeddings``,
``labels``, ``lineitem`` ...). Formulations deliberately differ from the
Spark plans where that makes a stronger cross-check (e.g. the back-fill uses
a forward ``first_value(... IGNORE NULLS)`` frame, the threshold sweep is a
direct per-cut scan instead of a histogram, ranks are plain ``row_number``).
"""

from __future__ import annotations

D = 6  # rounding digits, as plans.common.DIGITS

OBS_DAILY = """
SELECT CAST(user_id % 12 AS DOUBLE) latitude, CAST(floor(user_id / 12.0) AS DOUBLE) longitude,
       CAST(ts AS DATE) d, CAST(CAST(ts AS DATE) AS VARCHAR) datetime,
       max(value) tmmx, min(value) tmmn, max(k) rmax, min(k) rmin, sum(value) vpd,
       CAST(count(*) AS DOUBLE) vs, sum(k) erc, max(k) - min(k) bi, min(k) + 1 fm100, max(k) + 2 fm1000,
       CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS DOUBLE) pr, max(value) * 2 srad,
       max(CASE WHEN event_type = 'error' THEN 'Yes' ELSE 'No' END) wildfire
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) k FROM events) e
GROUP BY user_id, CAST(ts AS DATE)
"""

OBS_GAPS = f"""
SELECT latitude, longitude, d, datetime,
       CASE WHEN vs > 2 THEN tmmx END tmmx, tmmn, rmax,
       CASE WHEN bi > 10 THEN rmin END rmin,
       CASE WHEN pr < 2 THEN vpd END vpd, vs, erc, bi, fm100, fm1000, pr, srad,
       CASE WHEN erc < 150 THEN wildfire END wildfire
FROM ({OBS_DAILY}) o
"""

ROW_FEATURE_SQL = [
    ("temp_range", "tmmx - tmmn"),
    ("temp_avg", "(tmmx + tmmn) / 2.0"),
    ("temp_variance", "(tmmx - tmmn) * (tmmx - tmmn)"),
    ("humidity_range", "rmax - rmin"),
    ("humidity_avg", "(rmax + rmin) / 2.0"),
    ("dryness_index", "100.0 - rmin"),
    ("vpd_temp", "vpd * tmmx"),
    ("vpd_squared", "vpd * vpd"),
    ("wind_erc", "vs * erc"),
    ("wind_squared", "vs * vs"),
    ("fuel_moisture_ratio", "fm100 / nullif(fm1000 + 1e-6, 0)"),
    ("fuel_moisture_diff", "fm1000 - fm100"),
    ("fuel_moisture_avg", "(fm100 + fm1000) / 2.0"),
    ("drought_stress", "vpd / nullif(pr + 1e-6, 0)"),
    ("heat_load", "srad * tmmx"),
    ("erc_squared", "erc * erc"),
    ("fire_spread_potential", "bi * vs"),
    ("lat_squared", "latitude * latitude"),
    ("lon_squared", "longitude * longitude"),
    ("lat_lon_interaction", "latitude * longitude"),
]

SEASON_SQL = [
    ("day_sin", "sin(2 * pi() * dayofyear(ts) / 365.25)"),
    ("day_cos", "cos(2 * pi() * dayofyear(ts) / 365.25)"),
    ("month", "CAST(month(ts) AS INTEGER)"),
    ("is_fire_season", "CAST(coalesce(month(ts) BETWEEN 5 AND 10, false) AS INTEGER)"),
]

KEY = "PARTITION BY latitude, longitude ORDER BY ts ASC NULLS LAST"
NULLKEY = "latitude IS NULL OR longitude IS NULL"

ROLLING_SQL = [
    ("temp_3day_avg", "temp_avg", 3), ("temp_7day_avg", "temp_avg", 7),
    ("vpd_3day_avg", "vpd", 3), ("vpd_7day_avg", "vpd", 7), ("humidity_3day_avg", "humidity_avg", 3),
]
LAG_SQL = [("temp_lag1", "temp_avg"), ("vpd_lag1", "vpd"), ("humidity_lag1", "humidity_avg")]
CHANGE_SQL = [("temp_change", "temp_avg"), ("humidity_change", "humidity_avg"), ("vpd_change", "vpd")]


def r(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), {D}) AS {alias}"


def featured(src: str = OBS_DAILY) -> str:
    """obs + parsed time + row/season features (unrounded)."""
    feats = ",\n       ".join(f"{e} AS {n}" for n, e in ROW_FEATURE_SQL)
    return f"""
SELECT *, {feats}
FROM (SELECT *, CAST(datetime AS TIMESTAMP) ts FROM ({src}) o0) o1
"""


def windowed(src: str = OBS_DAILY) -> str:
    """featured + raw rolling/lag/change columns (unrounded, unfilled)."""
    parts = []
    for n, s, k in ROLLING_SQL:
        parts.append(f"CASE WHEN {NULLKEY} THEN NULL ELSE avg({s}) OVER ({KEY} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) END AS {n}")
    for n, s in LAG_SQL:
        parts.append(f"CASE WHEN {NULLKEY} THEN NULL ELSE lag({s}) OVER ({KEY}) END AS {n}")
    for n, s in CHANGE_SQL:
        parts.append(f"CASE WHEN {NULLKEY} THEN NULL ELSE {s} - lag({s}) OVER ({KEY}) END AS {n}")
    cols = ",\n       ".join(parts)
    return f"SELECT *, {cols} FROM ({featured(src)}) f"


def filled(src: str = OBS_DAILY) -> str:
    """windowed with W6 back-fill as a forward first_value(IGNORE NULLS)."""
    names = [n for n, _ in LAG_SQL] + [n for n, _ in CHANGE_SQL]
    repl = ",\n       ".join(
        f"CASE WHEN {NULLKEY} THEN NULL ELSE coalesce({n}, first_value({n} IGNORE NULLS) OVER ({KEY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) END AS {n}"
        for n in names)
    return f"SELECT * REPLACE ({repl}) FROM ({windowed(src)}) w"


ROW_NAMES = [n for n, _ in ROW_FEATURE_SQL]
SEASON_NAMES = [n for n, _ in SEASON_SQL]
ROLL_NAMES = [n for n, _, _ in ROLLING_SQL]
LAGCHG_NAMES = [n for n, _ in LAG_SQL] + [n for n, _ in CHANGE_SQL]
RAW = ["tmmx", "tmmn", "rmax", "rmin", "vpd", "vs", "erc", "bi", "fm100", "fm1000", "pr", "srad"]


def _sel_round(names):
    return ", ".join(r(n, n) for n in names)


def q_row_features() -> str:
    return f"SELECT latitude, longitude, d, {_sel_round(ROW_NAMES)} FROM ({featured()}) f"


def q_season_features() -> str:
    seas = ", ".join(f"{r(e, n) if n.startswith('day_') else e + ' AS ' + n}" for n, e in SEASON_SQL)
    return f"SELECT latitude, longitude, d, datetime, {seas} FROM ({featured()}) f"


def q_rolling_means() -> str:
    return f"SELECT latitude, longitude, d, {_sel_round(ROLL_NAMES)} FROM ({windowed()}) w"


def q_lags_changes() -> str:
    return f"SELECT latitude, longitude, d, {_sel_round(LAGCHG_NAMES)} FROM ({windowed()}) w"


def q_filled_lags() -> str:
    return f"SELECT latitude, longitude, d, {_sel_round(LAGCHG_NAMES)} FROM ({filled()}) w"


def q_engineered_table() -> str:
    seas = ", ".join(f"{r(e, n) if n.startswith('day_') else e + ' AS ' + n}" for n, e in SEASON_SQL)
    return (f"SELECT latitude, longitude, d, datetime, {_sel_round(RAW)}, wildfire, "
            f"{_sel_round(ROW_NAMES)}, {seas}, {_sel_round(ROLL_NAMES + LAGCHG_NAMES)} FROM ({filled()}) x")


def all_sql() -> dict[str, str]:
    out = {
        "row_features": q_row_features(),
        "season_features": q_season_features(),
        "rolling_means": q_rolling_means(),
        "lags_changes": q_lags_changes(),
        "filled_lags": q_filled_lags(),
        "engineered_table": q_engineered_table(),
        "engineered_table_chunked": q_engineered_table(),
    }
    from riskloom.plans import oracle_more, queries_store
    out.update(oracle_more.all_sql())
    out.update(queries_store.all_sql())
    return out
