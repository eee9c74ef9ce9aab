"""Oracle SQL (DuckDB) for metrics and ensemble selection.

The threshold sweep here is the direct definition: every (strategy, cut)
pair scans all rows (41x the work of the histogram pass, fine at oracle
scale).
"""

from __future__ import annotations

from riskloom.operators.ensemble import threshold_grid
from riskloom.plans.oracle import OBS_DAILY, D

SCORES = ("(SELECT vec_id AS row_id, CAST(m.range AS INTEGER) AS model_id, "
          "least(greatest(CAST(0.5 AS DOUBLE) + CAST(embedding[m.range] AS DOUBLE), CAST(0 AS DOUBLE)), "
          "CAST(1 AS DOUBLE)) AS score, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y "
          "FROM embeddings, range(1, 13) m)")


def rnd(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), {D}) AS {alias}"


def ratio(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


def metrics_sel() -> str:
    rec = ratio("tp", "tp + fn")
    spec = ratio("tn", "tn + fp")
    return ", ".join([
        rnd(rec, "recall"), rnd(spec, "specificity"), rnd(f"(({rec}) + ({spec})) / 2", "balanced_accuracy"),
        rnd(ratio("tp + tn", "tp + tn + fp + fn"), "accuracy"), rnd(ratio("tp", "tp + fp"), "precision"),
        rnd(ratio("2 * tp", "(tp + fn) + (tp + fp)"), "f1"), "fp AS false_alarms"])


def unrounded_metrics() -> str:
    rec = ratio("tp", "tp + fn")
    spec = ratio("tn", "tn + fp")
    return (f"{rec} AS recall, {spec} AS specificity, (({rec}) + ({spec})) / 2 AS balanced_accuracy, "
            f"{ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {ratio('tp', 'tp + fp')} AS precision, "
            f"{ratio('2 * tp', '(tp + fn) + (tp + fp)')} AS f1, fp AS false_alarms")


def ci(cond: str) -> str:
    """count_if as BIGINT (DuckDB returns HUGEINT)."""
    return f"CAST(count_if({cond}) AS BIGINT)"


def confusion(pred: str) -> str:
    return (f"{ci(f'NOT ({pred}) AND y = 0')} AS tn, {ci(f'({pred}) AND y = 0')} AS fp, "
            f"{ci(f'NOT ({pred}) AND y = 1')} AS fn, {ci(f'({pred}) AND y = 1')} AS tp")


MODEL_INFO = (f"(SELECT model_id, {ratio('2 * tp', '(tp + fn) + (tp + fp)')} AS val_f1, {ratio('tp', 'tp + fn')} AS val_recall, "
              f"{ratio('tp', 'tp + fp')} AS val_precision FROM (SELECT model_id, {confusion('coalesce(score > 0.5, false)')} "
              f"FROM {SCORES} s GROUP BY model_id) c)")

SCREEN = (f"(SELECT s.model_id, positives, negatives, i.val_f1, positives > 0 AND negatives > 0 AND "
          f"coalesce(i.val_f1 > 0.01, false) AS keep FROM (SELECT model_id, {ci('coalesce(score >= 0.5, false)')} AS positives, "
          f"{ci('NOT coalesce(score >= 0.5, false)')} AS negatives FROM {SCORES} s GROUP BY model_id) s "
          f"LEFT JOIN {MODEL_INFO} i USING (model_id))")

WEIGHTS = ("(SELECT model_id, CAST(1 AS DOUBLE) / CAST(count(*) OVER () AS DOUBLE) AS simple_average, "
           "CASE WHEN sum(val_f1) OVER () > 0 THEN val_f1 / sum(val_f1) OVER () ELSE CAST(1 AS DOUBLE) / CAST(count(*) OVER () AS DOUBLE) END AS f1_weighted, "
           "CASE WHEN sum(val_recall) OVER () > 0 THEN val_recall / sum(val_recall) OVER () ELSE CAST(1 AS DOUBLE) / CAST(count(*) OVER () AS DOUBLE) END AS recall_weighted "
           f"FROM (SELECT model_id FROM {SCREEN} k WHERE keep) k JOIN {MODEL_INFO} i USING (model_id))")

COMBINED = ("(SELECT row_id, max(y) AS y, "
            "list_reduce(list(score ORDER BY model_id), lambda a, b: a + b) / CAST(count(*) AS DOUBLE) AS simple_average, "
            "list_reduce(list(w.f1_weighted * score ORDER BY model_id), lambda a, b: a + b) AS f1_weighted, "
            "list_reduce(list(w.recall_weighted * score ORDER BY model_id), lambda a, b: a + b) AS recall_weighted "
            f"FROM {SCORES} s JOIN {WEIGHTS} w USING (model_id) GROUP BY row_id)")

LONG = (f"(SELECT 'simple_average' AS strategy, row_id, simple_average AS score, y FROM {COMBINED} c1 UNION ALL "
        f"SELECT 'f1_weighted', row_id, f1_weighted, y FROM {COMBINED} c2 UNION ALL "
        f"SELECT 'recall_weighted', row_id, recall_weighted, y FROM {COMBINED} c3)")


def grid_values() -> str:
    rows = ", ".join(f"({i}, CAST({t!r} AS DOUBLE))" for i, t in enumerate(threshold_grid()))
    return f"(SELECT * FROM (VALUES {rows}) g(cut, threshold))"


CURVE_RAW = (f"(SELECT strategy, cut, threshold, tn, fp, fn, tp, {unrounded_metrics()} FROM "
             f"(SELECT strategy, cut, threshold, {confusion('coalesce(score >= threshold, false)')} "
             f"FROM {LONG} l, {grid_values()} g GROUP BY strategy, cut, threshold) c)")

CURVE_COLS = ("strategy, cut, {t}, tn, fp, fn, tp, {m}")


def curve_sel(src_alias: str = "") -> str:
    names = ["recall", "specificity", "balanced_accuracy", "accuracy", "precision", "f1"]
    m = ", ".join(rnd(n, n) for n in names)
    return f"strategy, cut, {rnd('threshold', 'threshold')}, tn, fp, fn, tp, {m}, false_alarms"


BEST = (f"(SELECT 'accuracy' AS criterion, * FROM (SELECT *, row_number() OVER (PARTITION BY strategy ORDER BY accuracy DESC, cut ASC) AS r "
        f"FROM {CURVE_RAW} c) a WHERE r = 1 UNION ALL "
        f"SELECT 'balanced_accuracy' AS criterion, * FROM (SELECT *, row_number() OVER (PARTITION BY strategy ORDER BY balanced_accuracy DESC, cut ASC) AS r "
        f"FROM {CURVE_RAW} c) b WHERE r = 1)")

STRATS = (f"(SELECT c.*, CAST(CASE c.strategy WHEN 'simple_average' THEN 1 WHEN 'f1_weighted' THEN 2 "
          f"WHEN 'recall_weighted' THEN 3 END AS INTEGER) AS position FROM {CURVE_RAW} c JOIN "
          f"(SELECT cut FROM {BEST} b WHERE strategy = 'simple_average' AND criterion = 'balanced_accuracy') x USING (cut))")

TOP = f"(SELECT * FROM {STRATS} s ORDER BY balanced_accuracy DESC, position ASC LIMIT 1)"

CONFIG = (f"(SELECT t.strategy, t.threshold, t.balanced_accuracy, t.f1, t.recall, t.specificity, w.model_id, w.weight "
          f"FROM {TOP} t JOIN (SELECT model_id, 'simple_average' AS strategy, simple_average AS weight FROM {WEIGHTS} a "
          f"UNION ALL SELECT model_id, 'f1_weighted', f1_weighted FROM {WEIGHTS} b "
          f"UNION ALL SELECT model_id, 'recall_weighted', recall_weighted FROM {WEIGHTS} c) w USING (strategy))")


def daily_gaps_sql() -> str:
    return (f"WITH o AS ({OBS_DAILY}), e AS (SELECT DISTINCT latitude, longitude FROM o), "
            "days AS (SELECT CAST(unnest(generate_series((SELECT min(d) FROM o), (SELECT max(d) FROM o), "
            "INTERVAL 1 DAY)) AS DATE) AS d) "
            "SELECT latitude, longitude, d FROM e, days EXCEPT SELECT latitude, longitude, d FROM o")


def all_sql() -> dict[str, str]:
    lab = "labels"
    smote = (
        "WITH t AS (SELECT CASE WHEN label = 0 THEN 1 ELSE 0 END AS y, row_number() OVER (ORDER BY vec_id) - 1 AS pos "
        "FROM embeddings), "
        "c AS (SELECT CAST(floor(pos / 200) + 1 AS BIGINT) AS session, count(*) AS n, sum(y) AS p FROM t GROUP BY 1), "
        "g AS (SELECT *, CASE WHEN p <= n - p THEN 1 ELSE 0 END AS minority, least(p, n - p) AS m FROM c), "
        "k AS (SELECT *, CASE WHEN CAST(p AS DOUBLE) / n < 0.3 AND m >= 2 "
        "THEN CAST(trunc(CAST(n - m AS DOUBLE) * 0.3 - m) AS BIGINT) ELSE 0 END AS new FROM g) "
        "SELECT session, 0 AS y, 0 AS synthetic, CAST(n - p AS BIGINT) AS n FROM k WHERE n - p > 0 UNION ALL "
        "SELECT session, 1, 0, CAST(p AS BIGINT) FROM k WHERE p > 0 UNION ALL "
        "SELECT session, minority, 1, new FROM k WHERE new > 0")
    return {
        "oversample_counts": smote,
        "artefact_audit": daily_gaps_sql(),
        "class_balance": (f"SELECT count(*) AS n, {ci('toxic = 1')} AS positives, {rnd(ratio('count_if(toxic = 1)', 'count(*)'), 'positive_share')}, "
                          f"{rnd('CASE WHEN count_if(toxic = 1) > 0 THEN CAST(count(*) - count_if(toxic = 1) AS DOUBLE) / count_if(toxic = 1) END', 'pos_weight')} FROM {lab}"),
        "class_weights": (f"SELECT toxic, n_class, {rnd('CASE WHEN min(n_class) OVER () = 0 THEN 1 ELSE CAST(n AS DOUBLE) / (2 * n_class) END', 'weight')} "
                          f"FROM (SELECT c.toxic, coalesce(k.n_class, 0) AS n_class, (SELECT count(*) FROM {lab}) AS n "
                          f"FROM (SELECT 0 AS toxic UNION ALL SELECT 1) c LEFT JOIN (SELECT toxic, count(*) AS n_class FROM {lab} GROUP BY toxic) k USING (toxic)) z"),
        "model_metrics": (f"SELECT model_id, tn, fp, fn, tp, {metrics_sel()} FROM (SELECT model_id, "
                          f"{confusion('coalesce(score > 0.5, false)')} FROM {SCORES} s GROUP BY model_id) c"),
        "model_info": (f"SELECT model_id, {rnd('val_f1', 'val_f1')}, {rnd('val_recall', 'val_recall')}, {rnd('val_precision', 'val_precision')}, "
                       f"CASE WHEN model_id <= 6 THEN 'depth' ELSE 'leaf' END AS model_type FROM {MODEL_INFO} i"),
        "weighted_sq_error": (
            "SELECT model_id, " + rnd("avg(w * (e - (2 * y - 1)) * (e - (2 * y - 1)))", "loss") + ", "
            + rnd("avg(CAST((CASE WHEN e > 0 THEN 1 ELSE 0 END) = y AS DOUBLE))", "accuracy") + ", "
            + rnd("avg((e + 1) / 2)", "mean_prob")
            + " FROM (SELECT *, CASE WHEN p = 0 OR p = n THEN CAST(1 AS DOUBLE) WHEN y = 1 THEN CAST(n AS DOUBLE) / (2 * p) "
            "ELSE CAST(n AS DOUBLE) / (2 * (n - p)) END AS w FROM (SELECT *, score * 2 - 1 AS e, count(*) OVER (PARTITION BY model_id) AS n, "
            f"count_if(y = 1) OVER (PARTITION BY model_id) AS p FROM {SCORES} s) a) b GROUP BY model_id"),
        "score_range": f"SELECT model_id, {rnd('min(score)', 'min_score')}, {rnd('max(score)', 'max_score')} FROM {SCORES} s GROUP BY model_id",
        "history_rollup": (
            "SELECT model_id, session, iteration, " + rnd("CASE WHEN seconds > 0 THEN samples / seconds ELSE 0 END", "samples_per_sec")
            + ", cumulative_samples, " + rnd("elapsed", "elapsed") + ", "
            + rnd("CASE WHEN elapsed > 0 THEN cumulative_samples / elapsed ELSE 0 END", "avg_throughput")
            + " FROM (SELECT *, CAST(sum(samples) OVER w AS BIGINT) AS cumulative_samples, sum(seconds) OVER w AS elapsed FROM "
            "(SELECT l_orderkey AS model_id, 1 AS session, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INTEGER) AS iteration, "
            "CAST(l_quantity AS BIGINT) AS samples, 0.5 + 10.0 * l_discount AS seconds FROM lineitem) h "
            "WINDOW w AS (PARTITION BY model_id, session ORDER BY iteration ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) r"),
        "early_stop": (
            "WITH s AS (SELECT user_id AS model_id, value AS loss, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS iteration, "
            "min(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best FROM events), "
            "i AS (SELECT *, max(CASE WHEN prev_best IS NULL OR loss < prev_best THEN iteration END) OVER (PARTITION BY model_id ORDER BY iteration "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_impr FROM s), "
            "st AS (SELECT model_id, min(CASE WHEN iteration - last_impr >= 5 THEN iteration END) AS stop_iteration, count(*) AS iterations FROM i GROUP BY model_id), "
            "b AS (SELECT i.model_id, arg_min(i.loss, (i.loss, i.iteration)) AS best_loss, arg_min(i.iteration, (i.loss, i.iteration)) AS best_iteration, "
            "max(i.iteration) AS iterations_run FROM i JOIN st USING (model_id) WHERE st.stop_iteration IS NULL OR i.iteration <= st.stop_iteration GROUP BY i.model_id) "
            f"SELECT model_id, iterations, iterations_run, stop_iteration, {rnd('best_loss', 'best_loss')}, best_iteration FROM st JOIN b USING (model_id)"),
        "screen_models": f"SELECT model_id, positives, negatives, {rnd('val_f1', 'val_f1')}, keep FROM {SCREEN} s",
        "average_scores": f"SELECT row_id, y, {rnd('simple_average', 'simple_average')} FROM {COMBINED} c",
        "weighted_scores": f"SELECT row_id, {rnd('f1_weighted', 'f1_weighted')}, {rnd('recall_weighted', 'recall_weighted')} FROM {COMBINED} c",
        "threshold_curve": f"SELECT {curve_sel()} FROM {CURVE_RAW} c",
        "best_threshold": f"SELECT criterion, {curve_sel()} FROM {BEST} b",
        "strategy_table": f"SELECT position, {curve_sel()} FROM {STRATS} s",
        "best_strategy": f"SELECT position, {curve_sel()} FROM {TOP} t",
        "optimal_config": (f"SELECT strategy, {rnd('threshold', 'threshold')}, {rnd('balanced_accuracy', 'balanced_accuracy')}, {rnd('f1', 'f1')}, "
                           f"{rnd('recall', 'recall')}, {rnd('specificity', 'specificity')}, model_id, {rnd('weight', 'weight')} FROM {CONFIG} c"),
        "apply_config": ("SELECT row_id, " + rnd("sc", "score") + ", " + rnd("th", "threshold")
                         + ", CAST(coalesce(sc >= th, false) AS INTEGER) AS decision FROM (SELECT row_id, "
                         "list_reduce(list(c.weight * s.score ORDER BY s.model_id), lambda a, b: a + b) AS sc, max(c.threshold) AS th "
                         f"FROM {SCORES} s JOIN {CONFIG} c USING (model_id) GROUP BY row_id) z"),
    }
