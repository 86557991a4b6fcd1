"""Independent DuckDB SQL for the registered queries, over the same parquet tables."""

from __future__ import annotations

import math

READINGS = """readings AS (
  SELECT event_id AS reading_id, ts AS "timestamp", 'EQ_' || user_id AS equipment_id,
    CASE event_type WHEN 'click' THEN 'vibration' WHEN 'view' THEN 'temperature'
      WHEN 'purchase' THEN 'pressure' WHEN 'signup' THEN 'rpm' ELSE 'other' END AS sensor_type,
    CASE event_type WHEN 'click' THEN value / 100 WHEN 'signup' THEN value + 1500 ELSE value END AS value,
    props AS metadata
  FROM events)"""

DIRTY_READINGS = READINGS + """, dirty1 AS (
  SELECT reading_id, "timestamp", equipment_id, CASE WHEN reading_id % 101 <> 0 THEN sensor_type END AS sensor_type,
    CASE WHEN reading_id % 97 <> 0 THEN value END AS value, metadata FROM readings),
dirty AS (SELECT * FROM dirty1 UNION ALL SELECT * FROM dirty1 WHERE reading_id % 50 = 0)"""

Z_SCORES = READINGS + """, zstats AS (
  SELECT *, count(*) OVER w AS n, avg(value) OVER w AS mu, stddev_pop(value) OVER w AS sd
  FROM readings WHERE value IS NOT NULL AND equipment_id <> '' AND sensor_type <> ''
  WINDOW w AS (PARTITION BY equipment_id, sensor_type ORDER BY "timestamp", reading_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)),
z AS (SELECT *, CASE WHEN n < 10 THEN abs(value) WHEN sd > 0 THEN abs(value - mu) / sd ELSE 0 END AS z_score FROM zstats)"""

HEALTH = """lastval AS (
  SELECT equipment_id, date_trunc('day', "timestamp") AS w, sensor_type,
    arg_max(value, ("timestamp", reading_id)) AS v
  FROM readings WHERE sensor_type <> 'other' AND value IS NOT NULL GROUP BY ALL),
parts AS (
  SELECT equipment_id, w, sensor_type,
    CASE sensor_type WHEN 'vibration' THEN 0.4 WHEN 'temperature' THEN 0.3 WHEN 'pressure' THEN 0.2 ELSE 0.1 END::DOUBLE AS weight,
    1 - greatest(0, least(1, CASE sensor_type WHEN 'vibration' THEN v WHEN 'temperature' THEN (v - 20) / 60
      WHEN 'pressure' THEN v / 100 ELSE (v - 1500) / 500 END)) AS score
  FROM lastval),
overall AS (SELECT equipment_id, w, sum(weight * score) / sum(weight) AS overall_health FROM parts GROUP BY ALL)"""


def status(c: str) -> str:
    return (f"CASE WHEN {c} >= 0.8 THEN 'excellent' WHEN {c} >= 0.6 THEN 'good' WHEN {c} >= 0.4 THEN 'fair' "
            f"WHEN {c} >= 0.2 THEN 'poor' ELSE 'critical' END")


def urgency(c: str) -> str:
    return (f"CASE WHEN {c} <= 0.2 THEN 'critical' WHEN {c} <= 0.4 THEN 'high' "
            f"WHEN {c} <= 0.6 THEN 'medium' ELSE 'low' END")


def single_health(t: str = "sensor_type", v: str = "value") -> str:
    return (f"coalesce(greatest(0.0, least(1.0, CASE {t} WHEN 'vibration' THEN 1 - {v} WHEN 'temperature' THEN 1 - ({v} - 20) / 60 "
            f"WHEN 'pressure' THEN 1 - abs({v} - 50) / 50 ELSE CASE WHEN {v} IS NULL THEN NULL ELSE 0.5 END END)), 0.5)")


def null_safe_single_health() -> str:
    return (f"CASE WHEN value IS NULL THEN 0.5 ELSE {single_health()} END")


def stats_sql(span: str) -> str:
    return f"""WITH {READINGS}, spans AS ({span})
SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, sensor_type, round(avg(value) + 1.23e-6, 4) AS mean,
  round(stddev_samp(value) + 1.23e-6, 4) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max, count(*) AS count
FROM spans GROUP BY w, sensor_type"""


ORACLES: dict[str, str] = {}

ORACLES["zscore_anomaly"] = f"""WITH {Z_SCORES}
SELECT reading_id, equipment_id, sensor_type, round(z_score, 4) AS z_score, (z_score > 2)::INT AS is_anomaly,
  round(CASE WHEN z_score > 2 THEN least(z_score / 2, 1.0) ELSE 0.0 END, 4) AS anomaly_confidence FROM z"""

ORACLES["multisensor_health"] = f"""WITH {READINGS}, {HEALTH}
SELECT r.reading_id, r.equipment_id, r.sensor_type, round(coalesce(p.score, 0.5), 4) AS sensor_health,
  round(coalesce(o.overall_health, 0.5), 8) AS overall_health, {status('coalesce(o.overall_health, 0.5)')} AS health_status
FROM readings r
LEFT JOIN parts p ON p.equipment_id = r.equipment_id AND p.w = date_trunc('day', r."timestamp") AND p.sensor_type = r.sensor_type
LEFT JOIN overall o ON o.equipment_id = r.equipment_id AND o.w = date_trunc('day', r."timestamp")"""

ORACLES["stream_alerts"] = f"""WITH {Z_SCORES}, {HEALTH},
scored AS (
  SELECT z.*, coalesce(o.overall_health, 0.5) AS h, CASE WHEN z_score > 2 THEN least(z_score / 2, 1.0) ELSE 0.0 END AS conf
  FROM z LEFT JOIN overall o ON o.equipment_id = z.equipment_id AND o.w = date_trunc('day', z."timestamp"))
SELECT reading_id, "timestamp", equipment_id, 'anomaly' AS alert_type,
  CASE WHEN conf > 0.9 THEN 'high' ELSE 'medium' END AS severity,
  printf('Anomaly detected in %s with confidence %.2f', equipment_id, conf) AS message, round(z_score, 4) AS z_score
FROM scored WHERE z_score > 2 AND conf >= 0.8
UNION ALL
SELECT reading_id, "timestamp", equipment_id, 'health', CASE WHEN h <= 0.2 THEN 'critical' ELSE 'high' END,
  printf('Poor health detected in %s (score: %.2f)', equipment_id, h), round(z_score, 4)
FROM scored WHERE h <= 0.3"""

ORACLES["threshold_health"] = f"""WITH {DIRTY_READINGS}, h AS (
  SELECT *, {null_safe_single_health()} AS s FROM dirty)
SELECT reading_id, sensor_type,
  coalesce(value > CASE sensor_type WHEN 'vibration' THEN 1 WHEN 'temperature' THEN 100 WHEN 'pressure' THEN 150
    WHEN 'rpm' THEN 2500 ELSE 1 END, false)::INT AS is_anomaly,
  round(s, 6) AS health_score, {status('s')} AS health_status, {urgency('s')} AS maintenance_urgency FROM h"""

ORACLES["fixed_threshold_anomaly"] = f"""WITH {READINGS}
SELECT sensor_type, count(*) AS anomalies_detected, 0.8::DOUBLE AS confidence, min(value) AS lowest, max(value) AS highest
FROM readings WHERE value > 0.8 GROUP BY sensor_type"""

ORACLES["fixed_threshold_alerts"] = f"""WITH {READINGS}
SELECT reading_id, 1 AS is_anomaly, 0.8::DOUBLE AS anomaly_confidence, 'anomaly_detected' AS alert_type, equipment_id AS message_equipment,
  sensor_type AS message_sensor, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS message_time, round(value, 6) AS message_value, 0::DOUBLE AS message_score
FROM readings WHERE value > 0.8"""

ORACLES["critical_health_alerts"] = f"""WITH {READINGS}, h AS (SELECT *, {single_health()} AS s FROM readings)
SELECT reading_id, equipment_id, {status('s')} AS health_status, {urgency('s')} AS maintenance_urgency,
  'critical_health' AS alert_type, equipment_id AS message_equipment,
  strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS message_time, round(value, 6) AS message_value, round(s, 6) AS message_score
FROM h WHERE s < 0.2"""

ORACLES["anomaly_runs"] = f"""WITH {Z_SCORES}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY equipment_id, sensor_type ORDER BY "timestamp", reading_id)
    - row_number() OVER (PARTITION BY equipment_id, sensor_type, z_score > 2 ORDER BY "timestamp", reading_id) AS island FROM z)
SELECT equipment_id, sensor_type, count(*) AS run_length, min("timestamp") AS run_start, max("timestamp") AS run_end,
  round(max(z_score), 4) AS peak_z
FROM numbered WHERE z_score > 2 GROUP BY equipment_id, sensor_type, island HAVING count(*) >= 3"""

ORACLES["window_stats"] = stats_sql("SELECT *, date_trunc('hour', \"timestamp\") AS w FROM readings")
ORACLES["sliding_window_stats"] = stats_sql(
    "SELECT *, time_bucket(INTERVAL 30 MINUTE, \"timestamp\") - k * INTERVAL 30 MINUTE AS w "
    "FROM readings, (VALUES (0), (1)) s(k)")

ORACLES["throughput_5m"] = f"""WITH {READINGS}
SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS period_start, count(*) AS incoming_records,
  sum(strlen(metadata))::BIGINT AS incoming_bytes, round(avg(strlen(metadata)), 4) AS average_bytes,
  max(strlen(metadata))::INT AS maximum_bytes FROM readings GROUP BY 1"""

ORACLES["operating_sessions"] = f"""WITH {READINGS}, starts AS (
  SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER w <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh
  FROM readings WINDOW w AS (PARTITION BY equipment_id ORDER BY "timestamp", reading_id)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY equipment_id ORDER BY "timestamp", reading_id ROWS UNBOUNDED PRECEDING) AS s FROM starts)
SELECT equipment_id, s::BIGINT AS session_number, min("timestamp") AS session_start, max("timestamp") AS session_end,
  count(*) AS readings, round(sum(value), 4) AS total FROM numbered GROUP BY equipment_id, s"""

# --- cleaning and features --------------------------------------------------------

PLANT = """plant AS (
  SELECT 'EQ_' || l_suppkey AS equipment_id, l_shipdate AS "timestamp", l_discount * 10 AS value,
    l_quantity + 35 AS temperature, 1500 + l_extendedprice / 200 AS rpm, l_tax * 1000 AS load,
    l_orderkey, l_linenumber, l_partkey, l_orderkey * 8 + l_linenumber AS rid FROM lineitem)"""
DIRTY_PLANT = PLANT + """, dirty AS (
  SELECT * EXCLUDE (value), CASE WHEN rid % 97 <> 0 THEN CASE WHEN rid % 211 = 0 THEN value * 10 ELSE value END END AS value
  FROM plant)"""
MAINTENANCE = """maintenance AS (
  SELECT 'EQ_' || (o_custkey % (SELECT count(*) FROM supplier)) AS equipment_id, o_orderdate AS date,
    o_orderpriority AS type, o_orderkey AS order_key FROM orders)"""
PLANT_ID = 'l_orderkey, l_linenumber, l_partkey, equipment_id, "timestamp"'
PLANT_ORDER = '"timestamp", l_orderkey, l_linenumber, l_partkey'
MEASURES = ["value", "temperature", "rpm", "load"]

ORACLES["clean_dedup"] = f"WITH {DIRTY_READINGS} SELECT DISTINCT * FROM dirty"

ORACLES["null_profile"] = f"WITH {DIRTY_READINGS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN \"{c}\" IS NULL THEN 1.0 ELSE 0.0 END), 8) AS null_ratio, "
    f"(avg(CASE WHEN \"{c}\" IS NULL THEN 1.0 ELSE 0.0 END) > 0.0095)::INT AS dropped FROM dirty"
    for c in ["reading_id", "timestamp", "equipment_id", "sensor_type", "value", "metadata"])

ORACLES["impute_mode"] = f"""WITH {DIRTY_READINGS}, m AS (
  SELECT sensor_type AS s FROM dirty WHERE sensor_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, sensor_type LIMIT 1)
SELECT reading_id, equipment_id, coalesce(sensor_type, (SELECT s FROM m)) AS sensor_type FROM dirty"""

ORACLES["impute_median"] = f"""WITH {DIRTY_PLANT}
SELECT l_orderkey, l_linenumber, l_partkey, equipment_id,
  round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM dirty)), 6) AS value, round(rpm, 6) AS rpm,
  round(coalesce(value, 0), 6) AS target FROM dirty"""


def _fences() -> str:
    steps, source = [], "dirty"
    for i, c in enumerate(MEASURES):
        steps.append(f"""q{i} AS (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM {source}),
k{i} AS (SELECT t.* FROM {source} t, q{i} WHERE {c} IS NULL OR NOT ({c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a)))""")
        source = f"k{i}"
    return ",\n".join(steps)


ORACLES["iqr_filter"] = f"""WITH {DIRTY_PLANT}, {_fences()}
SELECT equipment_id, "timestamp", l_orderkey, l_linenumber, l_partkey, round(value, 6) AS value FROM k3"""

ORACLES["coerce_types"] = f"""WITH {READINGS}
SELECT reading_id, "timestamp", CASE WHEN reading_id % 89 <> 0 THEN value END AS value FROM readings"""

ORACLES["drift_reference"] = f"""WITH {READINGS}
SELECT reading_id, "timestamp", equipment_id, value FROM readings WHERE "timestamp" >= TIMESTAMP '2024-01-06 00:00:00'"""

ORACLES["time_features"] = f"""WITH {READINGS}
SELECT reading_id, hour("timestamp")::INT AS hour, (isodow("timestamp") - 1)::INT AS day_of_week, day("timestamp")::INT AS day_of_month,
  month("timestamp")::INT AS month, (isodow("timestamp") >= 6)::INT AS is_weekend,
  (hour("timestamp") IN (22, 23, 0, 1, 2, 3, 4, 5))::INT AS is_night FROM readings"""

ORACLES["rolling_features"] = f"""WITH {PLANT}
SELECT {PLANT_ID}, """ + ", ".join(
    f"round({fn}({c}) OVER w{w} + 1.23e-6, 4) AS {c}_{name}_{w}"
    for c in MEASURES for w in (5, 10, 30, 60)
    for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"), ("min", "min"))
) + " FROM plant WINDOW " + ", ".join(
    f"w{w} AS (PARTITION BY equipment_id ORDER BY {PLANT_ORDER} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    for w in (5, 10, 30, 60))

ORACLES["equipment_features"] = f"""WITH {PLANT}, {MAINTENANCE}, first AS (
  SELECT equipment_id, min(date) AS start_date FROM maintenance GROUP BY 1)
SELECT {PLANT_ID}, floor(date_diff('second', start_date, "timestamp") / 86400)::BIGINT AS equipment_age_days,
  row_number() OVER (PARTITION BY equipment_id ORDER BY {PLANT_ORDER}) AS operating_hours
FROM plant LEFT JOIN first USING (equipment_id)"""

ORACLES["days_since_maintenance"] = f"""WITH {PLANT}, {MAINTENANCE}, dates AS (SELECT DISTINCT equipment_id, date FROM maintenance)
SELECT {', '.join('p.' + c for c in PLANT_ID.split(', '))}, m.date AS last_maintenance,
  floor(date_diff('second', m.date, p."timestamp") / 86400)::DOUBLE AS days_since_maintenance
FROM plant p ASOF LEFT JOIN dates m ON m.equipment_id = p.equipment_id AND p."timestamp" >= m.date"""

_PAIRS = [(a, b) for i, a in enumerate(MEASURES) for b in MEASURES[i + 1:]]
ORACLES["pair_features"] = f"WITH {PLANT} SELECT {PLANT_ID}, " + ", ".join(
    f"round({a} / ({b} + 1e-8) / 1000, 3) AS {a}_{b}_ratio, round({a} - {b} + 1.23e-6, 4) AS {a}_{b}_diff" for a, b in _PAIRS
) + " FROM plant"

ORACLES["health_indicators"] = f"""WITH {DIRTY_PLANT}, h AS (
  SELECT *, CASE WHEN value IS NOT NULL THEN 1 - greatest(0, least(1, value)) END AS vh,
    1 - greatest(0, least(1, (temperature - 20) / 60)) AS th FROM dirty)
SELECT {PLANT_ID}, round(vh, 6) AS vibration_health, round(th, 6) AS temperature_health,
  round(CASE WHEN vh IS NULL THEN th ELSE (vh + th) / 2 END, 6) AS overall_health FROM h"""

TARGET = """extremes AS (SELECT """ + ", ".join(f"min({c}) AS {c}0, max({c}) AS {c}1" for c in MEASURES) + """ FROM plant),
target AS (SELECT plant.*, (""" + " + ".join(f"1 - ({c} - {c}0) / ({c}1 - {c}0)" for c in MEASURES) + """) / 4 AS health_score
  FROM plant, extremes)"""

ORACLES["minmax_health_target"] = f"""WITH {PLANT}, {TARGET}
SELECT {PLANT_ID}, round(health_score, 8) AS health_score,
  CASE WHEN health_score < 0.3 THEN 'high' WHEN health_score < 0.6 THEN 'medium' ELSE 'low' END AS maintenance_urgency FROM target"""

ORACLES["feature_importance"] = f"WITH {PLANT}, {TARGET} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(abs(corr({c}, health_score)), 6) AS importance, 'numeric' AS type FROM target" for c in MEASURES)


def _scaled(mid: str, spread: str) -> str:
    q = ", ".join(f"{mid.format(c=c)} AS {c}m, {spread.format(c=c)} AS {c}s" for c in MEASURES)
    cols = ", ".join(f"round(({c} - {c}m) / CASE WHEN {c}s = 0 THEN 1 ELSE {c}s END, 6) AS {c}" for c in MEASURES)
    return f"WITH {PLANT}, q AS (SELECT {q} FROM plant) SELECT {PLANT_ID}, {cols} FROM plant, q"


ORACLES["scale_standard"] = _scaled("avg({c})", "stddev_pop({c})")
ORACLES["scale_minmax"] = _scaled("min({c})", "max({c}) - min({c})")
ORACLES["scale_robust"] = _scaled("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)")

ORACLES["sequence_windows"] = f"""WITH {PLANT}, s AS (
  SELECT *, list(temperature) OVER (PARTITION BY equipment_id ORDER BY {PLANT_ORDER} ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS seq FROM plant)
SELECT {PLANT_ID}, len(seq)::INT AS length, seq[1] AS first, seq[60] AS last, round(list_sum(seq), 3) AS total FROM s WHERE len(seq) = 60"""

# --- detectors, votes, evaluation -------------------------------------------------

DETECTORS = Z_SCORES + f""", detectors AS (
  SELECT reading_id, CASE WHEN (metadata->>'k')::INT < 10 THEN -1 ELSE 1 END AS label,
    CASE WHEN z_score > 2 THEN -1 ELSE 1 END AS p1, -z_score AS s1,
    CASE WHEN value > lim THEN -1 ELSE 1 END AS p2, -value / lim AS s2,
    CASE WHEN own < 0.2 THEN -1 ELSE 1 END AS p3, own - 1 AS s3
  FROM (SELECT *, CASE sensor_type WHEN 'vibration' THEN 1 WHEN 'temperature' THEN 100 WHEN 'pressure' THEN 150
    WHEN 'rpm' THEN 2500 ELSE 1 END::DOUBLE AS lim, {single_health()} AS own FROM z)),
long AS (SELECT label, 'zscore' AS model, p1 AS p FROM detectors UNION ALL SELECT label, 'limit', p2 FROM detectors
  UNION ALL SELECT label, 'health', p3 FROM detectors),
counts AS (SELECT model, count(*) AS n, count(*) FILTER (label = -1 AND p = -1) AS tp, count(*) FILTER (label = 1 AND p = -1) AS fp,
  count(*) FILTER (label = -1 AND p = 1) AS fn FROM long GROUP BY model),
pr AS (SELECT model, (n - fp - fn) / n AS accuracy, tp / (tp + fp + 1e-8) AS precision, tp / (tp + fn + 1e-8) AS recall FROM counts),
metrics AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-8) AS f1_score FROM pr)"""

ORACLES["anomaly_vote"] = f"""WITH {DETECTORS},
w AS (SELECT 1 / (avg(abs(s1)) + 1e-8) AS w1, 1 / (avg(abs(s2)) + 1e-8) AS w2, 1 / (avg(abs(s3)) + 1e-8) AS w3 FROM detectors
  WHERE ('0x' || substr(md5(reading_id::VARCHAR), 1, 7))::BIGINT % 5 <> 0)
SELECT reading_id, CASE WHEN ((p1 = 1)::INT + (p2 = 1)::INT + (p3 = 1)::INT) / 3.0 > 0.5 THEN 1 ELSE -1 END AS majority_vote,
  round((s1 + s2 + s3) / 3, 4) AS mean_score,
  CASE WHEN ((p1 = 1)::INT * w1 + (p2 = 1)::INT * w2 + (p3 = 1)::INT * w3) / (w1 + w2 + w3) > 0.5 THEN 1 ELSE -1 END AS weighted_vote,
  round((s1 * w1 + s2 * w2 + s3 * w3) / (w1 + w2 + w3), 4) AS weighted_score FROM detectors, w"""

ORACLES["binary_metrics"] = f"""WITH {DETECTORS}
SELECT model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1_score, 6) AS f1_score FROM metrics"""

ORACLES["best_model"] = f"""WITH {DETECTORS}, best AS (SELECT model FROM metrics ORDER BY f1_score DESC, model LIMIT 1)
SELECT reading_id, model AS model_used, label FROM detectors, best
WHERE CASE model WHEN 'zscore' THEN p1 WHEN 'limit' THEN p2 ELSE p3 END = -1"""

LABELLED = PLANT + """, labelled AS (
  SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, equipment_id) AS row_id, value AS p1,
    (temperature - 36) / 49.0 AS p2, (rpm - 1500) / 525.0 AS p3,
    (value + (temperature - 36) / 49.0 + 0.5 * ((rid * 7919 % 1000) / 1000.0) > 1.3)::INT AS will_fail FROM plant)"""

ORACLES["class_weights"] = f"""WITH {LABELLED}
SELECT will_fail, count(*) AS n, round((SELECT count(*) FROM labelled) / (2.0 * count(*)), 6) AS weight FROM labelled GROUP BY will_fail"""

ORACLES["stratified_split"] = f"""WITH {LABELLED}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY will_fail ORDER BY ('0x' || substr(md5(row_id || '|' || l_partkey), 1, 13))::BIGINT, row_id, l_partkey) AS k,
    count(*) OVER (PARTITION BY will_fail) AS n FROM labelled)
SELECT row_id, "timestamp", will_fail, CASE WHEN k <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM ranked"""


def auc_sql(source: str, score: str, by: str) -> str:
    return f"""SELECT {by}, (sum(CASE WHEN y = 1 THEN r END) - n1 * (n1 + 1) / 2.0) / n1 / (n - n1) AS auc FROM (
  SELECT *, min_rank + (ties - 1) / 2.0 AS r FROM (
    SELECT *, rank() OVER (PARTITION BY {by} ORDER BY {score}) AS min_rank, count(*) OVER (PARTITION BY {by}, {score}) AS ties,
      sum(y) OVER (PARTITION BY {by}) AS n1, count(*) OVER (PARTITION BY {by}) AS n FROM {source})) GROUP BY {by}, n1, n"""


ORACLES["auc_rank"] = f"""WITH {LABELLED}, s AS (SELECT 'all' AS g, will_fail AS y, (p2 + p3) / 2 AS p FROM labelled),
a AS ({auc_sql('s', 'p', 'g')}),
c AS (SELECT count(*) AS n, count(*) FILTER (y = 1 AND p > 0.5) AS tp, count(*) FILTER (y = 0 AND p > 0.5) AS fp,
  count(*) FILTER (y = 1 AND p <= 0.5) AS fn FROM s),
m AS (SELECT (n - fp - fn) / n AS accuracy, tp / (tp + fp + 1e-8) AS precision, tp / (tp + fn + 1e-8) AS recall FROM c)
SELECT round(accuracy, 6) AS accuracy, round(auc, 6) AS auc, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(2 * precision * recall / (precision + recall + 1e-8), 6) AS f1_score FROM m, a"""

ORACLES["failure_vote"] = f"""WITH {LABELLED},
folds AS (SELECT *, ('0x' || substr(md5(row_id), 1, 7))::BIGINT % 5 AS fold FROM labelled),
s AS (SELECT 'p1:' || fold AS g, will_fail AS y, p1 AS p FROM folds UNION ALL SELECT 'p2:' || fold, will_fail, p2 FROM folds
  UNION ALL SELECT 'p3:' || fold, will_fail, p3 FROM folds),
a AS ({auc_sql('s', 'p', 'g')}),
w AS (SELECT avg(auc) FILTER (g LIKE 'p1%') AS w1, avg(auc) FILTER (g LIKE 'p2%') AS w2, avg(auc) FILTER (g LIKE 'p3%') AS w3 FROM a),
v AS (SELECT *, (p1 * w1 + p2 * w2 + p3 * w3) / (w1 + w2 + w3) AS soft FROM labelled, w)
SELECT row_id, "timestamp", round(soft, 6) AS soft_probability, (soft > 0.5)::INT AS soft_vote,
  (((p1 > 0.5)::INT + (p2 > 0.5)::INT + (p3 > 0.5)::INT) / 3.0 > 0.5)::INT AS hard_vote FROM v"""

ORACLES["failure_label"] = f"""WITH {READINGS}, f AS (SELECT 'EQ_' || user_id AS equipment_id, ts AS next_failure FROM events WHERE event_type = 'error')
SELECT r.reading_id, r.equipment_id, f.next_failure, coalesce((f.next_failure - r."timestamp" <= INTERVAL 72 HOUR)::INT, 0) AS will_fail
FROM readings r ASOF LEFT JOIN f ON r.equipment_id = f.equipment_id AND r."timestamp" < f.next_failure"""

ORACLES["maintenance_recommendations"] = f"""WITH {LABELLED}, p AS (SELECT *, (p1 + p2) / 2 AS p, FROM labelled),
u AS (SELECT *, CASE WHEN p > 0.7 THEN 'high' ELSE 'medium' END AS urgency FROM p WHERE p > 0.5)
SELECT row_id, "timestamp", round(p + 1.23e-6, 4) AS failure_probability, urgency, 'Schedule maintenance - ' || urgency || ' priority' AS recommendation,
  CASE WHEN p > 0.9 THEN 'Within 24 hours' WHEN p > 0.7 THEN 'Within 1 week' ELSE 'Within 1 month' END AS estimated_failure_time FROM u"""

ORACLES["forecast_trend_season"] = f"""WITH {PLANT}, t AS (
  SELECT equipment_id, regr_slope(value, epoch("timestamp") / 86400) AS a, regr_intercept(value, epoch("timestamp") / 86400) AS b,
    max("timestamp") AS last_seen FROM plant GROUP BY 1),
ratios AS (SELECT p.equipment_id, p."timestamp", value / (b + a * epoch("timestamp") / 86400) AS q FROM plant p JOIN t USING (equipment_id)),
weeks AS (SELECT equipment_id, isodow("timestamp") AS slot, avg(q) AS wi FROM ratios GROUP BY 1, 2),
years AS (SELECT equipment_id, month("timestamp") AS slot, avg(q) AS yi FROM ratios GROUP BY 1, 2),
future AS (SELECT equipment_id, a, b, last_seen + k * INTERVAL 1 DAY AS "timestamp" FROM t, range(1, 31) r(k)),
yh AS (SELECT f.equipment_id, f."timestamp", (b + a * epoch(f."timestamp") / 86400) * coalesce(wi, 1) * coalesce(yi, 1) AS yhat FROM future f
  LEFT JOIN weeks w ON w.equipment_id = f.equipment_id AND w.slot = isodow(f."timestamp")
  LEFT JOIN years y ON y.equipment_id = f.equipment_id AND y.slot = month(f."timestamp"))
SELECT equipment_id, "timestamp", round(yhat, 6) AS yhat,
  round(greatest(0, least(1, CASE WHEN yhat > 0.8 THEN (yhat - 0.8) / (1 - 0.8) ELSE 0 END)), 6) AS failure_probability FROM yh"""



def _normal_equations(terms: int, penalties: list[float], source: str, name: str) -> str:
    """Least squares of ``y`` on the list ``t`` for each key: sums of products, then elimination row by row."""
    rows = ",\n".join("[" + ", ".join([f"sum(t[{i}] * t[{j}]){f' + {penalties[i - 1]!r}' if i == j else ''}" for j in range(1, terms + 1)] + [f"sum(t[{i}] * y)"]) + "]"
                      for i in range(1, terms + 1))
    return f"""{name}_sums AS (SELECT equipment_id, 1 AS k, [{rows}] AS m FROM {source} GROUP BY 1),
{name}_steps AS (SELECT * FROM {name}_sums UNION ALL
  SELECT equipment_id, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
    ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END) FROM {name}_steps WHERE k <= {terms}),
{name} AS (SELECT equipment_id, list_transform(m, lambda r: r[{terms + 1}]) AS b FROM {name}_steps WHERE k = {terms + 1})"""


_BENDS = [0.8 * (j + 1) / 26 for j in range(25)]
_TURNS = [(f, 2 * math.pi * k / length) for length, n in ((365.25, 10), (7.0, 3), (1.0, 4)) for k in range(1, n + 1) for f in ("sin", "cos")]
_TREND_LIST = "[1, x, " + ", ".join(f"greatest(x - {b!r}, 0)" for b in _BENDS) + "]"
_SEASON_LIST = "[" + ", ".join(f"{f}({w!r} * day)" for f, w in _TURNS) + "]"

ORACLES["forecast_history"] = f"""WITH RECURSIVE {PLANT.strip().removeprefix("WITH ")},
seen AS (SELECT equipment_id, "timestamp", epoch("timestamp") / 86400 AS day, value AS v FROM plant),
span AS (SELECT min(day) AS a, greatest(max(day) - min(day), 1) AS s FROM seen),
sizes AS (SELECT equipment_id, max(abs(v)) AS scale, max("timestamp") AS last_seen FROM seen GROUP BY 1),
line_rows AS (SELECT equipment_id, v / scale AS y, {_TREND_LIST} AS t FROM (SELECT *, (day - a) / s AS x FROM seen, span) JOIN sizes USING (equipment_id)),
{_normal_equations(27, [1e-9, 1e-9] + [1.0] * 25, "line_rows", "line")},
levels AS (SELECT equipment_id, day, v / scale AS v, list_dot_product(b, {_TREND_LIST}) AS level
  FROM (SELECT *, (day - a) / s AS x FROM seen, span) JOIN sizes USING (equipment_id) JOIN line USING (equipment_id)),
wave_rows AS (SELECT equipment_id, v - level AS y, list_transform({_SEASON_LIST}, lambda q: q * level) AS t FROM levels),
{_normal_equations(34, [0.01] * 34, "wave_rows", "wave")},
times AS (SELECT DISTINCT equipment_id, "timestamp" FROM seen UNION ALL SELECT equipment_id, last_seen + k * INTERVAL 1 DAY FROM sizes, range(1, 31) r(k)),
yh AS (SELECT equipment_id, "timestamp", scale * list_dot_product(l.b, {_TREND_LIST}) * (1 + list_dot_product(w.b, {_SEASON_LIST})) AS yhat
  FROM (SELECT *, (day - a) / s AS x FROM (SELECT *, epoch("timestamp") / 86400 AS day FROM times), span)
  JOIN sizes USING (equipment_id) JOIN line l USING (equipment_id) JOIN wave w USING (equipment_id))
SELECT equipment_id, "timestamp", round(yhat, 6) AS yhat,
  round(greatest(0, least(1, CASE WHEN yhat > 0.8 THEN (yhat - 0.8) / (1 - 0.8) ELSE 0 END)), 6) AS failure_probability FROM yh"""

# --- health -----------------------------------------------------------------------

WIDE = PLANT + """, wide AS (
  SELECT *, 1 - greatest(0, least(1, value)) AS vib, 1 - greatest(0, least(1, (temperature - 20) / 60)) AS heat,
    (0.4::DOUBLE * (1 - greatest(0, least(1, value))) + 0.3::DOUBLE * (1 - greatest(0, least(1, (temperature - 20) / 60)))
     + 0.2::DOUBLE * (1 - greatest(0, least(1, load / 100))) + 0.1::DOUBLE * (1 - greatest(0, least(1, (rpm - 1500) / 500)))) AS sensors
  FROM plant)"""

ORACLES["wide_sensor_health"] = f"WITH {WIDE} SELECT {PLANT_ID}, round(sensors, 8) AS health FROM wide"

ORACLES["cluster_distance_health"] = f"""WITH {PLANT}, dist AS (SELECT *, sqrt(least(
  (value - 0.5) ** 2 + (temperature - 60) ** 2 + (rpm - 1750) ** 2 + (load - 40) ** 2,
  (value - 0.2) ** 2 + (temperature - 45) ** 2 + (rpm - 1600) ** 2 + (load - 10) ** 2,
  (value - 0.8) ** 2 + (temperature - 75) ** 2 + (rpm - 1900) ** 2 + (load - 70) ** 2)) AS dd FROM plant)
SELECT {PLANT_ID}, round(dd, 6) AS distance, round(1 - dd / (SELECT max(dd) FROM dist), 6) AS health_score FROM dist"""

HEALTH_SCORES = WIDE + ", " + TARGET.replace("FROM plant", "FROM wide").replace("plant.*", "wide.*")

ORACLES["health_vote"] = f"""WITH {HEALTH_SCORES}, r2 AS (
  SELECT greatest(0, 1 - avg((health_score - sensors) ** 2) / var_pop(health_score)) AS w1,
    greatest(0, 1 - avg((health_score - vib) ** 2) / var_pop(health_score)) AS w2,
    greatest(0, 1 - avg((health_score - heat) ** 2) / var_pop(health_score)) AS w3 FROM target
  WHERE ('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, equipment_id)), 1, 7))::BIGINT % 5 <> 0)
SELECT {PLANT_ID}, round((sensors + vib + heat) / 3, 8) AS average,
  round(CASE WHEN w1 + w2 + w3 > 0 THEN (sensors * w1 + vib * w2 + heat * w3) / (w1 + w2 + w3) ELSE (sensors + vib + heat) / 3 END, 8) AS weighted,
  round(list_median([sensors, vib, heat]), 8) AS median FROM target, r2"""

ORACLES["regression_metrics"] = f"WITH {HEALTH_SCORES} " + " UNION ALL ".join(
    f"SELECT '{m}' AS model, round(avg((health_score - {c}) ** 2), 6) AS mse, round(sqrt(avg((health_score - {c}) ** 2)), 6) AS rmse, "
    f"round(avg(abs(health_score - {c})), 6) AS mae, round(1 - avg((health_score - {c}) ** 2) / var_pop(health_score), 6) AS r2_score FROM target"
    for m, c in (("sensors", "sensors"), ("vibration", "vib"), ("heat", "heat")))

ORACLES["health_report"] = f"""WITH {WIDE} SELECT {PLANT_ID}, round(sensors, 8) AS health_score, {status('sensors')} AS status,
  {urgency('sensors')} AS urgency, (sensors <= 0.2)::INT AS is_critical FROM wide"""

WINDOW_HEALTH = """windows AS (
  SELECT DISTINCT equipment_id, date_trunc('day', "timestamp") AS w FROM readings),
whealth AS (SELECT equipment_id, w, coalesce(o.overall_health, 0.5) AS h FROM windows LEFT JOIN overall o USING (equipment_id, w))"""

ORACLES["maintenance_schedule"] = f"""WITH {READINGS}, {HEALTH}, {WINDOW_HEALTH},
latest AS (SELECT equipment_id, arg_max(h, w) AS h FROM whealth GROUP BY 1),
u AS (SELECT *, {status('h')} AS status, {urgency('h')} AS urgency FROM latest)
SELECT equipment_id, round(h, 8) AS health_score, status, urgency,
  TIMESTAMP '2024-01-31 00:00:00' + CASE urgency WHEN 'critical' THEN 1 WHEN 'high' THEN 1 WHEN 'medium' THEN 7 ELSE 30 END * INTERVAL 1 DAY AS recommended_date,
  status || ' condition' AS "condition" FROM u"""

# --- drift, performance, registry -------------------------------------------------


def drift_sql(features: list[str], ref: str, cur: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, (abs((SELECT avg({c}) FROM {cur}) - avg({c})) + abs((SELECT stddev_samp({c}) FROM {cur}) - stddev_samp({c}))) "
        f"/ 2 / (stddev_samp({c}) + 1e-8) AS drift FROM {ref}" for c in features)
    return f"""drifts AS ({rows}), total AS (SELECT max(drift > 0.1) AS any_drift, avg(drift) AS drift_score, max(drift) AS max_drift FROM drifts),
advice AS (SELECT *, CASE WHEN NOT any_drift THEN 'No retraining needed' WHEN drift_score > 0.3 THEN 'Immediate retraining required'
  WHEN drift_score > 0.2 THEN 'Retraining recommended within 24 hours' ELSE 'Retraining recommended within 1 week' END AS recommendation FROM total)"""


ORACLES["drift_report"] = f"""WITH {PLANT}, ref AS (SELECT * FROM plant WHERE "timestamp" < TIMESTAMP '1999-01-01'),
cur AS (SELECT * REPLACE (temperature + 10 AS temperature) FROM plant WHERE "timestamp" >= TIMESTAMP '1999-01-01'),
{drift_sql(MEASURES, 'ref', 'cur')}
SELECT feature, round(drift, 6) AS drift, (drift > 0.1)::INT AS has_drift, round(drift_score, 6) AS drift_score,
  round(max_drift, 6) AS max_drift, recommendation FROM drifts, advice"""

ORACLES["weighted_metrics"] = f"""WITH {READINGS}, {HEALTH}, rows AS (
  SELECT {status('coalesce(o.overall_health, 0.5)')} AS y, {status(single_health('r.sensor_type', 'r.value'))} AS p
  FROM readings r LEFT JOIN overall o ON o.equipment_id = r.equipment_id AND o.w = date_trunc('day', r."timestamp")),
classes AS (SELECT y AS c FROM rows UNION SELECT p FROM rows),
per AS (SELECT c, count(*) FILTER (y = c) AS support, count(*) FILTER (p = c) AS taken, count(*) FILTER (y = c AND p = c) AS tp
  FROM rows, classes GROUP BY c),
pq AS (SELECT *, CASE WHEN taken > 0 THEN tp / taken ELSE 0 END AS pr, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS re FROM per)
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(pr * support) / sum(support), 6) AS precision,
  round(sum(re * support) / sum(support), 6) AS recall,
  round(sum(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END * support) / sum(support), 6) AS f1_score FROM pq"""

MODEL_LOG = """log AS (
  SELECT o_orderkey AS run_id, CASE o_custkey % 3 WHEN 0 THEN 'anomaly' WHEN 1 THEN 'failure' ELSE 'health' END AS model,
    o_orderkey % 40 + 1 AS version, CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' ELSE 'Archived' END AS stage,
    o_orderdate AS "timestamp", floor(o_totalprice)::BIGINT % 1000 / 1000.0::DOUBLE AS accuracy,
    floor(o_totalprice / 7)::BIGINT % 1000 / 1000.0::DOUBLE AS f1_score FROM orders)"""

ORACLES["should_retrain"] = f"""WITH {MODEL_LOG}, newest AS (
  SELECT * FROM log WHERE "timestamp" > TIMESTAMP '2001-08-05' - INTERVAL 8 DAY
  QUALIFY row_number() OVER (PARTITION BY model ORDER BY "timestamp" DESC, run_id DESC) = 1)
SELECT m.model, run_id::DOUBLE AS run_id, round((accuracy + f1_score) / 2, 6) AS performance,
  coalesce((accuracy + f1_score) / 2 < 0.8, false)::INT AS should_retrain
FROM (SELECT DISTINCT model FROM log) m LEFT JOIN newest USING (model)"""

_KINDS = ["vibration", "temperature", "pressure", "rpm"]
ORACLES["retrain_decision"] = f"""WITH {READINGS}, wide AS (SELECT "timestamp", """ + ", ".join(
    f"CASE WHEN sensor_type = '{k}' THEN value END AS {k}" for k in _KINDS) + f""" FROM readings),
cur AS (SELECT * FROM wide WHERE "timestamp" BETWEEN TIMESTAMP '2024-01-24' AND TIMESTAMP '2024-01-31'),
ref AS (SELECT * FROM wide WHERE "timestamp" BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-30'),
{drift_sql(_KINDS, 'ref', 'cur')}
SELECT any_drift::INT AS has_drift, round(drift_score, 6) AS drift_score, round(max_drift, 6) AS max_drift, recommendation,
  any_drift::INT AS retrain FROM advice"""

ORACLES["best_run"] = f"""WITH {MODEL_LOG}
SELECT 'max f1_score' AS "by", model, run_id, f1_score AS metric FROM log
QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1_score DESC, run_id) = 1
UNION ALL SELECT 'min accuracy', model, run_id, accuracy FROM log
QUALIFY row_number() OVER (PARTITION BY model ORDER BY accuracy, run_id) = 1"""

ORACLES["registry_latest"] = f"""WITH {MODEL_LOG}, now AS (
  SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY model, version ORDER BY "timestamp" DESC, run_id DESC) = 1)
SELECT model, stage, max(version) AS version, count(*) AS versions, 'models:/' || model || '/' || max(version) AS uri FROM now GROUP BY model, stage"""

ORACLES["model_performance"] = f"""WITH {MODEL_LOG}
SELECT model, round(avg(accuracy), 6) AS accuracy, round(avg(f1_score), 6) AS f1_score, round(1 - avg(accuracy), 6) AS error_rate,
  count(*) AS prediction_count, max("timestamp") AS last_updated
FROM log WHERE "timestamp" BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '2000-12-31 23:59:59' GROUP BY model"""

# --- alerts -----------------------------------------------------------------------


def _rule(name: str, condition: str, severity: str, description: str, source: str) -> str:
    return (f"SELECT reading_id, \"timestamp\", equipment_id, '{name}' AS rule, '{severity}' AS severity, '{description}' AS description, "
            f"'{source}' AS source FROM records WHERE {condition}")


ALERTS = Z_SCORES + f""", records AS (
  SELECT *, z_score > 2 AS is_anomaly, CASE WHEN z_score > 2 THEN least(z_score / 2, 1) ELSE 0 END AS conf, {single_health()} AS own,
    (metadata->>'k')::DOUBLE / 100 AS pf, CASE WHEN sensor_type = 'other' THEN (metadata->>'k')::DOUBLE / 100 END AS acc FROM z),
raised0 AS (""" + " UNION ALL ".join([
    _rule("anomaly_detected", "is_anomaly AND conf > 0.8", "warning", "Anomaly detected in sensor data", "anomaly_detector"),
    _rule("critical_health", "own < 0.2", "critical", "Equipment health is critical", "health_scorer"),
    _rule("failure_predicted", "pf > 0.8", "error", "Equipment failure predicted", "failure_predictor"),
    _rule("model_performance_degraded", "acc < 0.7", "warning", "Model performance has degraded", "model_monitor"),
]) + """),
raised AS (SELECT *, source || '_' || floor(epoch("timestamp"))::BIGINT || '_' || rule || '_' || reading_id AS alert_id FROM raised0),
actions AS (
  SELECT alert_id, 'acknowledged' AS action, 'operator_' || (reading_id % 5) AS actor, "timestamp" + INTERVAL 5 MINUTE AS act_time FROM raised WHERE reading_id % 3 = 0
  UNION ALL SELECT alert_id, 'resolved', 'operator_9', "timestamp" + INTERVAL 30 MINUTE FROM raised WHERE reading_id % 6 = 0),
states AS (
  SELECT r.*, coalesce((SELECT arg_max(action, act_time) FROM actions a WHERE a.alert_id = r.alert_id), 'active') AS status FROM raised r)"""

ORACLES["rule_alerts"] = f"""WITH {ALERTS}
SELECT alert_id, rule, 'Rule Triggered: ' || rule AS title, description, severity, source, "timestamp", equipment_id, 'active' AS status FROM raised"""

ORACLES["alert_cooldown"] = f"""WITH RECURSIVE {ALERTS},
instants AS (SELECT rule, "timestamp" AS t, min(alert_id) AS alert_id FROM raised GROUP BY rule, "timestamp"),
jumps AS (SELECT i.rule, i.t, i.alert_id, n.t AS nxt FROM instants i ASOF LEFT JOIN instants n ON n.rule = i.rule AND i.t + INTERVAL 300 SECOND <= n.t),
fired AS (
  SELECT j.* FROM jumps j JOIN (SELECT rule, min(t) AS t FROM jumps GROUP BY rule) f USING (rule, t)
  UNION ALL SELECT j.* FROM fired f JOIN jumps j ON j.rule = f.rule AND j.t = f.nxt)
SELECT alert_id, rule, t AS "timestamp" FROM fired"""

ORACLES["alert_lifecycle"] = f"""WITH {ALERTS}
SELECT alert_id, CASE WHEN reading_id % 6 = 0 THEN 'resolved' WHEN reading_id % 3 = 0 THEN 'acknowledged' ELSE 'active' END AS status,
  CASE WHEN reading_id % 3 = 0 THEN 'operator_' || (reading_id % 5) END AS acknowledged_by,
  CASE WHEN reading_id % 3 = 0 THEN "timestamp" + INTERVAL 5 MINUTE END AS acknowledged_at,
  CASE WHEN reading_id % 6 = 0 THEN "timestamp" + INTERVAL 30 MINUTE END AS resolved_at FROM raised"""

ORACLES["alert_stats"] = f"""WITH {ALERTS}
SELECT count(*) AS total_alerts, count(*) FILTER (status = 'active') AS active_alerts, """ + ", ".join(
    f"count(*) FILTER (severity = '{s}') AS {s}_alerts" for s in ("info", "warning", "error", "critical")) + " FROM states"

ORACLES["alert_page"] = f"""WITH {ALERTS}, wanted AS (SELECT * FROM states WHERE severity = 'critical' AND status = 'active'),
n AS (SELECT count(*) AS total FROM wanted)
SELECT alert_id, "timestamp", severity, status, equipment_id, total AS total_count, (total > 200)::INT AS has_next, 1 AS has_previous
FROM wanted, n ORDER BY "timestamp" DESC, alert_id LIMIT 100 OFFSET 100"""

ORACLES["metric_alerts"] = """
SELECT event_id AS metric_id, ts AS "timestamp", 'cpu_percent' AS metric, round(value, 6) AS value, 'High CPU Usage' AS title,
  'warning' AS severity, 'system_monitor' AS source FROM events WHERE event_type = 'click' AND value > 80
UNION ALL SELECT event_id, ts, 'memory_percent', round(value, 6), 'High Memory Usage', 'critical', 'system_monitor'
FROM events WHERE event_type = 'view' AND value > 90"""

# --- metrics ----------------------------------------------------------------------

ORACLES["component_metrics"] = """WITH named AS (
  SELECT *, CASE event_type WHEN 'click' THEN 'data_ingestion' WHEN 'view' THEN 'model_inference' WHEN 'purchase' THEN 'anomaly_detection'
    WHEN 'signup' THEN 'health_scoring' END AS component,
    CASE event_type WHEN 'click' THEN 'records_processed' WHEN 'view' THEN 'predictions_made' WHEN 'purchase' THEN 'anomalies_detected'
    WHEN 'signup' THEN 'scores_calculated' END AS counter,
    CASE event_type WHEN 'click' THEN 'processing_time' WHEN 'view' THEN 'inference_time' WHEN 'purchase' THEN 'detection_time'
    WHEN 'signup' THEN 'calculation_time' END AS timing
  FROM events WHERE event_type <> 'error')
SELECT component, counter AS metric, count(*)::DOUBLE AS value FROM named GROUP BY 1, 2
UNION ALL SELECT component, timing, round(arg_max(value, (ts, event_id)), 6) FROM named GROUP BY 1, 2"""

_BUCKETS = ["0.005", "0.01", "0.025", "0.05", "0.075", "0.1", "0.25", "0.5", "0.75", "1.0", "2.5", "5.0", "7.5", "10.0"]
ORACLES["metric_histogram"] = "WITH b(le, bound) AS (VALUES " + ", ".join(
    f"('{b}', {b}::DOUBLE)" for b in _BUCKETS) + """, ('+Inf', 'infinity'::DOUBLE))
SELECT event_type AS component, le, count(*) FILTER (value <= bound) AS cumulative_count, round(sum(value), 4) AS observed_sum,
  count(value) AS observed_count FROM events, b GROUP BY event_type, le"""

ORACLES["metric_summary"] = """
SELECT event_type AS component, date_trunc('day', ts) AS period, round(avg(value) + 1.23e-6, 4) AS average, max(value) AS peak, count(*) AS samples
FROM events GROUP BY 1, 2 UNION ALL SELECT event_type, NULL, round(avg(value) + 1.23e-6, 4), max(value), count(*) FROM events GROUP BY 1"""

ORACLES["component_status"] = """WITH latest AS (
  SELECT event_type AS component, max(ts) AS last_seen, arg_max(value, (ts, event_id)) AS latest FROM events GROUP BY 1),
s AS (SELECT *, CASE WHEN latest > 150 THEN 2 WHEN latest > 50 THEN 1 ELSE 0 END AS lv FROM latest)
SELECT component, ['healthy', 'degraded', 'unhealthy'][lv + 1] AS status, last_seen, latest,
  ['healthy', 'degraded', 'unhealthy'][(SELECT max(lv) FROM s) + 1] AS overall_status FROM s"""

ORACLES["health_changes"] = f"""WITH {READINGS}, {HEALTH}, {WINDOW_HEALTH},
s AS (SELECT equipment_id, w, {status('h')} AS new_status FROM whealth),
l AS (SELECT *, lag(new_status) OVER (PARTITION BY equipment_id ORDER BY w) AS old_status FROM s)
SELECT equipment_id, w AS "timestamp", old_status, new_status, 'equipment.health_changed' AS event, new_status AS payload_status
FROM l WHERE old_status <> new_status"""

# --- equipment --------------------------------------------------------------------

EQUIPMENT = """equipment AS (
  SELECT 'EQ_' || c_custkey AS equipment_id, c_name AS name, c_mktsegment AS type, r_name AS location, n_name AS site,
    CASE WHEN c_acctbal < 0 THEN 'offline' ELSE 'operational' END AS status
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

ORACLES["equipment_page"] = f"""WITH {READINGS}, {HEALTH}, {WINDOW_HEALTH}, {EQUIPMENT},
latest AS (SELECT equipment_id, arg_max(h, w) AS h FROM whealth GROUP BY 1),
wanted AS (SELECT * FROM equipment WHERE status = 'operational' AND location = 'ASIA')
SELECT equipment_id, name, type, location, status, round(h, 8) AS health_score, CASE WHEN h IS NOT NULL THEN {status('h')} END AS health_status,
  (SELECT count(*) FROM wanted) AS total_count, ((SELECT count(*) FROM wanted) > 100)::INT AS has_next
FROM wanted LEFT JOIN latest USING (equipment_id) ORDER BY equipment_id LIMIT 100"""

ORACLES["equipment_detail"] = f"""WITH {MAINTENANCE}, h AS (
  SELECT equipment_id, ((row_number() OVER w - 1) // 1000)::INT AS history_page, * EXCLUDE (equipment_id) FROM maintenance
  WINDOW w AS (PARTITION BY equipment_id ORDER BY date, order_key)),
p AS (SELECT equipment_id, history_page, count(*) AS entries, min(date) AS first_date, arg_min(type, (date, type, order_key)) AS first_type,
  max(date) AS last_date, arg_max(order_key, (date, type, order_key)) AS last_key FROM h GROUP BY ALL)
SELECT 'EQ_' || s_suppkey AS equipment_id, s_name AS name, r_name AS location, n_name AS site,
  CASE WHEN s_acctbal < 0 THEN 'offline' ELSE 'operational' END AS status, coalesce(history_page, 0) AS history_page, entries::INT AS entries,
  first_date, first_type, last_date, last_key
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN p ON p.equipment_id = 'EQ_' || s_suppkey"""

ORACLES["silent_equipment"] = f"""WITH {ALERTS}, {EQUIPMENT}
SELECT equipment_id, name, status, 'silent' AS kind FROM equipment WHERE equipment_id NOT IN (SELECT equipment_id FROM readings)
UNION ALL SELECT equipment_id, name, status, 'alerted' FROM equipment WHERE equipment_id IN (SELECT equipment_id FROM raised)"""


def history_sql(unit: str, where: str) -> str:
    health = HEALTH.replace("date_trunc('day'", f"date_trunc('{unit}'").replace("value IS NOT NULL GROUP", f"value IS NOT NULL AND {where} GROUP")
    return f"""{Z_SCORES}, {health},
counts AS (SELECT equipment_id, date_trunc('{unit}', "timestamp") AS w, count(*) FILTER (z_score > 2) AS anomalies FROM z WHERE {where} GROUP BY ALL),
history AS (SELECT equipment_id, w, coalesce(overall_health, 0.5) AS h, anomalies FROM counts LEFT JOIN overall USING (equipment_id, w))"""


_RANGE = "\"timestamp\" >= TIMESTAMP '2024-01-05' AND \"timestamp\" < TIMESTAMP '2024-01-28'"
ORACLES["health_history"] = f"""WITH {history_sql('week', _RANGE)}
SELECT equipment_id, w AS "timestamp", round(h, 8) AS health_score, {status('h')} AS status, anomalies, {urgency('h')} AS maintenance_urgency FROM history"""

ORACLES["health_summary"] = f"""WITH {history_sql('day', 'true')},
s AS (SELECT equipment_id, avg(h) AS a, coalesce(regr_slope(h, epoch(w) / 86400), 0) AS slope, sum(anomalies)::BIGINT AS anomaly_count,
  count(*) FILTER (h <= 0.2) AS critical_alerts FROM history GROUP BY 1)
SELECT equipment_id, round(a + 1.23e-6, 4) AS average_health, CASE WHEN slope > 1e-3 THEN 'improving' WHEN slope < -1e-3 THEN 'declining' ELSE 'stable' END AS trend,
  anomaly_count, critical_alerts FROM s"""

ORACLES["array_readings_anomaly"] = f"""WITH {READINGS}, n AS (
  SELECT *, row_number() OVER (PARTITION BY equipment_id ORDER BY "timestamp", reading_id) - 1 AS k FROM readings),
q AS (SELECT *, equipment_id || '#' || (k // 20) AS request_id FROM n),
s AS (SELECT *, count(*) OVER w AS n, avg(value) OVER w AS mu, stddev_pop(value) OVER w AS sd FROM q
  WINDOW w AS (PARTITION BY request_id ORDER BY k ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)),
z AS (SELECT *, CASE WHEN n < 10 THEN abs(value) WHEN sd > 0 THEN abs(value - mu) / sd ELSE 0 END AS z FROM s)
SELECT request_id, max((z > 2)::INT) AS is_anomaly, round(max(CASE WHEN z > 2 THEN least(z / 2, 1.0) ELSE 0 END), 4) AS confidence,
  round(max(z), 4) AS anomaly_score, count(*) AS readings FROM z GROUP BY request_id"""

ORACLES["component_scores"] = f"""WITH {READINGS}, {HEALTH}, {WINDOW_HEALTH},
texts AS (SELECT equipment_id, w, string_agg(printf('%s=%.6f', sensor_type, score), ';' ORDER BY sensor_type) AS t FROM parts GROUP BY ALL)
SELECT equipment_id, w AS "timestamp", round(h, 8) AS overall_score, {status('h')} AS status, {urgency('h')} AS maintenance_urgency,
  coalesce(t, '') AS component_scores FROM whealth LEFT JOIN texts USING (equipment_id, w)"""

# --- sources and streams ----------------------------------------------------------

_SENT = READINGS + """, sent AS (
  SELECT * REPLACE (CASE WHEN reading_id % 101 <> 0 THEN sensor_type END AS sensor_type, CASE WHEN reading_id % 97 <> 0 THEN value END AS value)
  FROM readings)"""
_GOOD = "reading_id % 53 <> 0 AND reading_id % 101 <> 0 AND reading_id % 97 <> 0"

ORACLES["parse_readings"] = f"""WITH {_SENT}
SELECT reading_id, "timestamp", equipment_id, sensor_type, round(value, 6) AS value, 'u' AS unit, (metadata->>'k')::DOUBLE AS k FROM sent WHERE {_GOOD}"""

ORACLES["publish_envelope"] = f"""WITH {READINGS}
SELECT CASE WHEN reading_id % 61 <> 0 THEN equipment_id ELSE 'default' END AS key, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%fZ') AS sent_time,
  sensor_type, round(value, 6) AS sent_value, (metadata->>'k')::DOUBLE AS k FROM readings"""

ORACLES["decode_envelope"] = f"""WITH {_SENT}
SELECT reading_id, equipment_id, sensor_type, round(value, 6) AS value FROM sent WHERE {_GOOD}"""

ORACLES["ingest_validation"] = """WITH f AS (SELECT event_id % 53 = 0 AS broken, event_id % 101 = 0 AS no_type, event_id % 97 = 0 AS no_value FROM events)
SELECT 'processed_count' AS measure, count(*) FILTER (NOT broken AND NOT no_type AND NOT no_value) AS records FROM f
UNION ALL SELECT 'failed_count', count(*) FILTER (broken OR no_type OR no_value) FROM f
UNION ALL SELECT 'sensor_type', count(*) FILTER (broken OR no_type) FROM f UNION ALL SELECT 'value', count(*) FILTER (broken OR no_value) FROM f
""" + " ".join(f"UNION ALL SELECT '{c}', count(*) FILTER (broken) FROM f" for c in ("timestamp", "equipment_id", "unit", "location"))

ORACLES["latest_readings"] = f"""WITH {READINGS}
SELECT reading_id, "timestamp", equipment_id, value FROM readings ORDER BY "timestamp" DESC, reading_id DESC LIMIT 100"""

ORACLES["lake_summary"] = f"""WITH {READINGS}
SELECT count(*) AS total_records, sum(strlen(metadata))::BIGINT AS total_size_bytes, round(sum(strlen(metadata)) / 1048576, 8) AS total_size_mb,
  count(DISTINCT equipment_id) AS equipment_count, min("timestamp") AS start_time, max("timestamp") AS end_time FROM readings"""

ORACLES["training_slice"] = f"""WITH {PLANT}
SELECT equipment_id, "timestamp", {', '.join(f'round({c}, 6) AS {c}' for c in MEASURES)},
  round((1 - greatest(0, least(1, value)) + 1 - greatest(0, least(1, (temperature - 20) / 60))) / 2, 6) AS health_score
FROM plant WHERE "timestamp" BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31 23:59:59'"""

ORACLES["version_diff"] = f"""WITH {DIRTY_READINGS},
o AS (SELECT reading_id, equipment_id, sensor_type, value FROM dirty),
n AS (SELECT reading_id, equipment_id, sensor_type, value FROM readings WHERE reading_id % 10 <> 0),
a AS (SELECT * FROM n EXCEPT ALL SELECT * FROM o), r AS (SELECT * FROM o EXCEPT ALL SELECT * FROM n)
SELECT *, 'added' AS change, count(*) AS copies FROM a GROUP BY ALL UNION ALL SELECT *, 'removed', count(*) FROM r GROUP BY ALL"""

ORACLES["stream_zscore"] = ORACLES["zscore_anomaly"]

_KNN_ID = "(g.l_orderkey, g.l_linenumber, g.l_partkey, g.equipment_id, g.\"timestamp\")"
ORACLES["impute_knn"] = f"""WITH {DIRTY_PLANT},
g AS (SELECT *, min(({PLANT_ID})) OVER (PARTITION BY equipment_id, value, temperature, rpm, load) AS first FROM dirty),
pairs AS (
  SELECT q.l_orderkey, q.l_linenumber, q.l_partkey, q.equipment_id, q."timestamp", g.value,
    row_number() OVER (PARTITION BY q.l_orderkey, q.l_linenumber, q.l_partkey, q.equipment_id, q."timestamp"
      ORDER BY (g.temperature - q.temperature) ** 2 + (g.rpm - q.rpm) ** 2 + (g.load - q.load) ** 2, g.first, {_KNN_ID}) AS k
  FROM dirty q JOIN g ON g.equipment_id = q.equipment_id WHERE q.value IS NULL AND g.value IS NOT NULL),
fill AS (SELECT {PLANT_ID}, avg(value) AS v FROM pairs WHERE k <= 5 GROUP BY ALL)
SELECT {PLANT_ID}, round(coalesce(value, v), 6) AS value FROM dirty LEFT JOIN fill USING ({PLANT_ID})"""
