"""Oracle SQL (DuckDB) for preparation and sampling queries.

Ranks here are the plain ``row_number()`` over the whole class: the
definition the distributed two-phase rank must reproduce.
"""

from __future__ import annotations

from riskloom.plans.oracle import LAGCHG_NAMES, OBS_DAILY, OBS_GAPS, ROLL_NAMES, D, _sel_round, filled

RAW = ["tmmx", "tmmn", "rmax", "rmin", "vpd", "vs", "erc", "bi", "fm100", "fm1000", "pr", "srad"]
GAP_COLS = ["tmmx", "vpd", "rmin"]
KEYS = "latitude, longitude, d"


def dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def lr(src: str, part: list[str], cls: str, n_col: str, want_expr: str, out: str) -> str:
    """Largest-remainder share of ``want`` (may use ``tot``) over classes."""
    p = f"PARTITION BY {', '.join(part)}" if part else ""
    return f"""(SELECT * EXCLUDE (tot, want, ex, fl, rem, lft, rr), fl + CASE WHEN rr <= lft THEN 1 ELSE 0 END AS {out}
 FROM (SELECT *, want - sum(fl) OVER ({p}) AS lft, row_number() OVER ({p} ORDER BY rem DESC, {cls} ASC) AS rr
  FROM (SELECT *, CAST(floor(ex) AS BIGINT) AS fl, ex - floor(ex) AS rem
   FROM (SELECT *, CAST({n_col} AS DOUBLE) / CAST(tot AS DOUBLE) * CAST(want AS DOUBLE) AS ex
    FROM (SELECT *, {want_expr} AS want FROM (SELECT *, sum({n_col}) OVER ({p}) AS tot FROM {src}) a0) a1) a2) a3) a4)"""


def holdout(ratio: float) -> str:
    return f"tot - CAST(ceil({dbl(ratio)} * tot) AS BIGINT)"


def split_sql(preset: str, table: str = "labels", id_col: str = "doc_id", cls: str = "toxic",
              seed: int = 42) -> str:
    r1, r2, where = {"60/20/20": (0.2, 0.25, "rest"), "70/15/15": (0.3, 0.5, "holdout")}[preset]
    c0 = f"(SELECT {cls}, count(*) AS n FROM {table} GROUP BY {cls})"
    c1 = f"(SELECT * EXCLUDE (kept1), n - kept1 AS h1 FROM {lr(c0, [], cls, 'n', holdout(r1), 'kept1')} b1)"
    if where == "rest":
        c2 = f"(SELECT *, n - h1 AS rest FROM {c1} b2)"
        c3 = lr(c2, [], cls, "rest", holdout(r2), "kept2")
        q = f"(SELECT {cls}, h1 AS cut_1, h1 + (rest - kept2) AS cut_2 FROM {c3} b3)"
    else:
        c3 = lr(c1, [], cls, "h1", holdout(r2), "kept2")
        q = f"(SELECT {cls}, h1 - kept2 AS cut_1, h1 AS cut_2 FROM {c3} b3)"
    rk = (f"(SELECT {id_col}, {cls}, row_number() OVER (PARTITION BY {cls} ORDER BY "
          f"md5('{seed}-' || coalesce(CAST({id_col} AS VARCHAR), 'null')), {id_col}) AS rk FROM {table})")
    return (f"SELECT r.{id_col}, r.{cls}, CASE WHEN rk <= cut_1 THEN 'test' WHEN rk <= cut_2 THEN 'val' "
            f"ELSE 'train' END AS split FROM {rk} r JOIN {q} q ON r.{cls} IS NOT DISTINCT FROM q.{cls}")


NULLED = ("(SELECT CASE WHEN doc_id % 10 <> 7 THEN doc_id END AS doc_id, "
          "CASE WHEN doc_id % 10 <> 3 THEN toxic END AS toxic FROM labels)")


def two_way_sql(ratio: float, table: str = "labels", id_col: str = "doc_id", cls: str = "toxic", seed: int = 42) -> str:
    c0 = f"(SELECT {cls}, count(*) AS n FROM {table} GROUP BY {cls})"
    q = f"(SELECT *, n - kept1 AS h1 FROM {lr(c0, [], cls, 'n', holdout(ratio), 'kept1')} b1)"
    rk = (f"(SELECT {id_col}, {cls}, row_number() OVER (PARTITION BY {cls} ORDER BY "
          f"md5('{seed}-' || CAST({id_col} AS VARCHAR)), {id_col}) AS rk FROM {table})")
    return (f"SELECT r.{id_col}, r.{cls}, CAST(rk <= h1 AS INTEGER) AS holdout "
            f"FROM {rk} r JOIN {q} q ON r.{cls} IS NOT DISTINCT FROM q.{cls}")


def samples_sql(table: str = "labels", id_col: str = "doc_id", cls: str = "toxic", extra: str = "") -> str:
    s = f"({split_sql('70/15/15', table, id_col, cls)})"
    x = (f"(SELECT s.*, CAST(m.range AS INTEGER) AS model_id, CASE s.split WHEN 'train' THEN 0 WHEN 'val' THEN 100 "
         f"WHEN 'test' THEN 200 END AS off FROM {s} s, range(1, 13) m)")
    cnt = f"(SELECT model_id, split, {cls}, count(*) AS n FROM {x} c GROUP BY model_id, split, {cls})"
    q = f"(SELECT model_id, split, {cls}, n - kept AS cut FROM {lr(cnt, ['model_id', 'split'], cls, 'n', holdout(1.0 / 12), 'kept')} q0)"
    # same scramble as ranking.mix32: one md5 per row, integer mixing per model
    m32 = "4294967296"
    k0 = (f"(SELECT *, xor(('0x' || substr(md5('42s-' || CAST({id_col} AS VARCHAR)), 1, 8))::BIGINT, "
          f"((42 + model_id + off) * 2654435761) % {m32}) AS k0 FROM {x} y)")
    k2 = f"(SELECT *, (xor(k0, k0 >> 16) * 73244475) % {m32} AS k2 FROM {k0} z0)"
    k4 = f"(SELECT *, (xor(k2, k2 >> 16) * 73244475) % {m32} AS k4 FROM {k2} z2)"
    kk = f"(SELECT *, xor(k4, k4 >> 16) AS kk FROM {k4} z4)"
    rk = (f"(SELECT {id_col}, {cls}, split, model_id, row_number() OVER (PARTITION BY model_id, split, {cls} ORDER BY "
          f"kk, {id_col}) AS rk FROM {kk} y2)")
    return (f"SELECT r.{id_col}, r.{cls}, r.split, r.model_id{extra} FROM {rk} r JOIN {q} q USING (model_id, split, {cls}) "
            f"WHERE rk <= cut")


def shards_sql() -> str:
    """Shard membership from the daily view: key text = entity|time, label = text target."""
    src = (f"(SELECT concat_ws('|', CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR), datetime) AS row_id, "
           f"CASE WHEN lower(CAST(wildfire AS VARCHAR)) IN ('yes', 'true', '1') THEN 1 ELSE 0 END AS y "
           f"FROM ({OBS_DAILY}) o)")
    return samples_sql(src, "row_id", "y", ", 64 AS width")


def fixed_sample_sql(n: int = 100) -> str:
    c0 = "(SELECT toxic, count(*) AS n FROM labels GROUP BY toxic)"
    q = f"(SELECT toxic, k AS cut FROM {lr(c0, [], 'toxic', 'n', f'least(CAST({n} AS BIGINT), tot)', 'k')} q0)"
    rk = ("(SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY md5('42-' || CAST(doc_id AS VARCHAR)),"
          " doc_id) AS rk FROM labels)")
    return f"SELECT r.doc_id, r.toxic FROM {rk} r JOIN {q} q USING (toxic) WHERE rk <= cut"


def rr(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), {D}) AS {alias}"


def all_sql() -> dict[str, str]:
    g = f"({OBS_GAPS})"
    o = f"({OBS_DAILY})"
    med = ", ".join(rr(f"coalesce({c}, (SELECT median({c}) FROM {g} m))", c) for c in GAP_COLS)
    dbl_arr = "CAST(embedding AS DOUBLE[])"
    norm = f"sqrt(list_reduce(list_transform({dbl_arr}, lambda y: y * y), lambda a, b: a + b)) + 1e-8"
    stats = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {rr(f'avg({c})', 'mean')}, {rr(f'stddev_pop({c})', 'std')} FROM {o} s{i}"
        for i, c in enumerate(RAW))
    std = ", ".join(rr(f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)", c) for c in RAW)
    out = {
        "median_impute": f"SELECT {KEYS}, {med} FROM {g} g",
        "mode_impute": (f"SELECT {KEYS}, coalesce(wildfire, (SELECT wildfire FROM {g} m WHERE wildfire IS NOT NULL "
                        f"GROUP BY wildfire ORDER BY count(*) DESC, wildfire ASC LIMIT 1)) AS wildfire FROM {g} g"),
        "label_encode": ("SELECT doc_id, lang, source, "
                         "CASE WHEN lang IS NULL THEN NULL ELSE CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) END AS lang_code, "
                         "CASE WHEN source IS NULL THEN NULL ELSE CAST(dense_rank() OVER (ORDER BY source) - 1 AS INTEGER) END AS source_code "
                         "FROM documents"),
        "target_encode": f"SELECT {KEYS}, CAST(dense_rank() OVER (ORDER BY wildfire) - 1 AS INTEGER) AS wildfire FROM {o} o",
        "scaler_stats": stats,
        "standardise": f"SELECT {KEYS}, {std} FROM {o} o",
        "bool_target": (f"SELECT {KEYS}, wildfire, CAST(CASE WHEN lower(CAST(wildfire AS VARCHAR)) IN ('yes', 'true', '1') "
                        f"THEN 1 ELSE 0 END AS TINYINT) AS y FROM {g} g"),
        "fit_width": (f"SELECT vec_id, list_resize({dbl_arr}, 3, CAST(0 AS DOUBLE)) AS v3, "
                      f"list_resize({dbl_arr}, 64, CAST(0 AS DOUBLE)) AS v64, "
                      f"list_resize({dbl_arr}, 70, CAST(0 AS DOUBLE)) AS v70 FROM embeddings"),
        "l2_normalise": (f"SELECT vec_id, list_transform({dbl_arr}, lambda x: round(x / ({norm}), {D})) AS unit "
                         f"FROM embeddings"),
        "stratified_split": split_sql("60/20/20"),
        "stratified_split_70": split_sql("70/15/15"),
        "stratified_samples": samples_sql(),
        "model_shards": shards_sql(),
        "fixed_sample": fixed_sample_sql(100),
        "session_slice": ("SELECT doc_id, toxic FROM (SELECT doc_id, toxic, row_number() OVER (ORDER BY doc_id) - 1 AS pos "
                          "FROM labels) s WHERE pos >= 100 AND pos < 200"),
        "half_split": ("SELECT doc_id, toxic, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < count(*) OVER () // 2 "
                       "THEN 'first' ELSE 'second' END AS half FROM labels"),
        "split_null_labels": split_sql("60/20/20", NULLED),
        "two_way_split": two_way_sql(0.2),
        "half_split_text_id": ("SELECT 'd|' || doc_id AS doc_id, toxic, CASE WHEN row_number() OVER (ORDER BY 'd|' || doc_id) - 1 "
                               "< count(*) OVER () // 2 THEN 'first' ELSE 'second' END AS half FROM labels"),
    }
    out["carried_features"] = (f"SELECT latitude, longitude, d, false AS late, {_sel_round(ROLL_NAMES + LAGCHG_NAMES)} FROM "
                               f"({filled(OBS_GAPS)}) x WHERE d > (SELECT max(d) - 10 FROM ({OBS_DAILY}) o)")
    out["new_observation_rows"] = (f"SELECT CAST(latitude AS VARCHAR) || '|' || CAST(longitude AS VARCHAR) || '|' || datetime AS row_id, "
                                   f"false AS late, true AS in_range, true AS decided_at_cut FROM ({OBS_DAILY}) o "
                                   f"WHERE d > (SELECT max(d) - 10 FROM ({OBS_DAILY}) p)")
    out["graph_oversample_counts"] = """
WITH c AS (SELECT count(*) FILTER (label = 0) AS pos, count(*) FILTER (label <> 0) AS neg FROM embeddings),
w AS (SELECT *, CAST(floor(neg * CAST(0.3 AS DOUBLE)) AS BIGINT) - pos AS want FROM c)
SELECT 0 AS y, 0 AS synthetic, 64 AS width, neg AS n, CAST(0 AS BIGINT) AS bases FROM w
UNION ALL SELECT 1, 0, 64, pos, 0 FROM w UNION ALL SELECT 1, 1, 64, want, least(want, pos) FROM w WHERE want > 0"""
    rows = "(SELECT vec_id AS row_id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y FROM embeddings)"
    cut = split_sql("60/20/20", rows, "row_id", "y")
    out["boosted_score_rows"] = (f"SELECT split, row_id, y, CAST(12 AS BIGINT) AS models, CAST(0 AS BIGINT) AS bad "
                                 f"FROM ({cut}) s WHERE split <> 'train'")
    test = f"(SELECT row_id, y, row_number() OVER (ORDER BY row_id) - 1 AS pos, count(*) OVER () AS n FROM ({cut}) s WHERE split = 'test')"
    out["stacked_score_rows"] = (f"SELECT 'logistic' AS stacker, row_id, y, true AS equal FROM {test} a UNION ALL "
                                 f"SELECT 'forest', row_id, y, true FROM {test} b WHERE pos >= n // 2")
    from riskloom.plans import oracle_select
    out.update(oracle_select.all_sql())
    return out
