"""The same results in DuckDB SQL, over the driver's tables.

Views are named below and put in front of a query as common table expressions, in order,
when its text (or a view it needs) mentions them.
"""

import re

from surveil.constants import FOREST_SEED, FOREST_TREES, PATTERNS, REGIONS, VITALS, VITAL_RANGES
from surveil.operators.iforest import average_path

_CENTRE_LAT = "[" + ", ".join(str(round(r[2] * 1e6)) for r in REGIONS) + "]"
_CENTRE_LON = "[" + ", ".join(str(round(r[3] * 1e6)) for r in REGIONS) + "]"
_REGION_ROWS = ", ".join(f"('{i}', '{n}', {la}::DOUBLE, {lo}::DOUBLE)" for i, n, la, lo in REGIONS)
_RANGES = " AND ".join(f"{v} BETWEEN {lo} AND {hi}" for v, (lo, hi) in VITAL_RANGES.items())
START, END = "TIMESTAMP '2024-01-10 06:00:00'", "TIMESTAMP '2024-01-12 18:00:00'"
HALF = "TIMESTAMP '2024-01-16 00:00:00'"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"2 * 6371.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians({lat2} - {lat1}) / 2), 2)"
            f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))")


def _members(slide: int) -> str:
    ends = f"time_bucket(INTERVAL {slide} MINUTE, event_time - INTERVAL 1 MICROSECOND) + INTERVAL {slide} MINUTE"
    return f"SELECT {ends} + k * INTERVAL {slide} MINUTE AS window_end, r.* FROM reports r, range(0, {60 // slide}) s(k)"


def _cluster_views(name: str, slide: int) -> dict[str, str]:
    """members, pairs, degree, core, reach, numbered, labels for one slide."""
    return {
        f"members_{name}": _members(slide),
        f"pairs_{name}": f"""SELECT a.window_end, a.event_id AS a, b.event_id AS b
            FROM members_{name} a JOIN members_{name} b ON a.window_end = b.window_end
            WHERE abs(a.latitude - b.latitude) < 0.01
              AND {haversine('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')} <= 0.5""",
        f"degree_{name}": f"SELECT window_end, a AS event_id, count(*) AS degree FROM pairs_{name} GROUP BY ALL",
        f"core_{name}": f"SELECT window_end, event_id FROM degree_{name} WHERE degree >= 5",
        f"touched_{name}": f"""SELECT DISTINCT p.window_end, p.a AS event_id FROM pairs_{name} p
            JOIN core_{name} c ON c.window_end = p.window_end AND c.event_id = p.b""",
        f"links_{name}": f"""SELECT p.* FROM pairs_{name} p
            JOIN core_{name} c ON c.window_end = p.window_end AND c.event_id = p.a
            JOIN core_{name} d ON d.window_end = p.window_end AND d.event_id = p.b""",
        f"reach_{name}": f"""SELECT window_end, a, b FROM links_{name} UNION
            SELECT r.window_end, r.a, l.b FROM reach_{name} r
            JOIN links_{name} l ON l.window_end = r.window_end AND l.a = r.b""",
        f"numbered_{name}": f"""SELECT window_end, event_id,
                dense_rank() OVER (PARTITION BY window_end ORDER BY first) - 1 AS cluster_no
            FROM (SELECT r.window_end, r.a AS event_id, min(place) AS first FROM reach_{name} r
                  JOIN (SELECT window_end, event_id, row_number() OVER (
                            PARTITION BY window_end ORDER BY event_time, event_id) AS place
                        FROM members_{name}) m ON m.window_end = r.window_end AND m.event_id = r.b
                  GROUP BY ALL)""",
        f"labels_{name}": f"""SELECT m.*, c.event_id IS NOT NULL AS is_core, n.cluster_no IS NOT NULL AS in_cluster,
                coalesce(n.cluster_no, -1)::INTEGER AS cluster_no,
                strftime(m.window_end, '%Y%m%dT%H%M') || '-' || n.cluster_no AS cluster_id
            FROM members_{name} m LEFT JOIN core_{name} c USING (window_end, event_id)
            LEFT JOIN (SELECT p.window_end, p.a AS event_id, min(n.cluster_no) AS cluster_no FROM pairs_{name} p
                       JOIN numbered_{name} n ON n.window_end = p.window_end AND n.event_id = p.b GROUP BY ALL) n
                USING (window_end, event_id)""",
    }


_UNIT = "('0x' || substr(md5({}), 1, 13))::BIGINT"


def _splits(rows: str) -> str:
    """``rows`` (tree, node, level, vitals) with the split of their node, by MD5 of (seed, tree, node)."""
    low, high = ", ".join(f"min({v}) OVER n" for v in VITALS), ", ".join(f"max({v}) OVER n" for v in VITALS)
    feature = _UNIT.format(f"concat_ws(':', {FOREST_SEED}, tree, node, 'feature')")
    share = _UNIT.format(f"concat_ws(':', {FOREST_SEED}, tree, node, 'split')")
    return f"""SELECT *, CASE WHEN feature >= 0 THEN [{', '.join(VITALS)}][feature + 1] END AS value,
            CASE WHEN feature >= 0 THEN CASE WHEN raw >= high THEN low ELSE raw END END AS split
        FROM (SELECT *, low + {share} / 4503599627370496::DOUBLE * (high - low) AS raw
        FROM (SELECT *, lows[feature + 1] AS low, highs[feature + 1] AS high
        FROM (SELECT *, CASE WHEN level = 8 OR n <= 1 OR len(varying) = 0 THEN -1 ELSE varying[{feature} % greatest(len(varying), 1) + 1] END AS feature
        FROM (SELECT *, list_filter(range(0, {len(VITALS)}), lambda i: highs[i + 1] > lows[i + 1]) AS varying
        FROM (SELECT *, count(*) OVER n AS n, [{low}] AS lows, [{high}] AS highs FROM {rows} WINDOW n AS (PARTITION BY tree, node))))))"""


def _forest_views(name: str, train: str, target: str) -> dict[str, str]:
    """drawn, grow, nodes, walks, scores, threshold of a forest trained on ``train`` and applied to ``target``."""
    vitals = ", ".join(f"{v}::DOUBLE AS {v}" for v in VITALS)
    plain = ", ".join(VITALS)
    seed, trees = FOREST_SEED, FOREST_TREES
    def walk(rows):
        return f"""SELECT event_id, tree, 0 AS node, {plain}, NULL::DOUBLE AS path_len FROM (SELECT event_id, {vitals} FROM {rows}), range(0, {trees}) t(tree)
            UNION ALL SELECT w.event_id, w.tree, CASE WHEN n.feature < 0 THEN -1 WHEN [{", ".join("w." + v for v in VITALS)}][n.feature + 1] > n.split THEN 2 * w.node + 2 ELSE 2 * w.node + 1 END,
                {", ".join("w." + v for v in VITALS)}, n.path_len FROM walk_{{}} w JOIN nodes_{name} n ON n.tree = w.tree AND n.node = w.node"""
    def scores(walked):
        return f"SELECT event_id, round(pow(2.0::DOUBLE, -(sum(path_len) / {trees} / {float(average_path(256))!r}::DOUBLE)), 6) AS s FROM {walked} WHERE path_len IS NOT NULL GROUP BY event_id"
    return {
        f"drawn_{name}": f"""SELECT tree, {vitals} FROM (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY md5(concat_ws(':', {seed}, event_id, tree, 'order')), event_id) AS place FROM (
            SELECT DISTINCT event_id, {plain}, ({_UNIT.format(f"concat_ws(':', {seed}, event_id, offer)")} % {trees})::INTEGER AS tree FROM (
            SELECT *, unnest(range(1, times + 1)) AS offer FROM (
            SELECT *, floor(offers)::INTEGER + ({_UNIT.format(f"concat_ws(':', {seed}, event_id, 'offer')")} / 4503599627370496::DOUBLE < offers - floor(offers))::INTEGER AS times
            FROM {train}, (SELECT 3.0::DOUBLE * 256 * {trees} / count(*) AS offers FROM {train}))))) WHERE place <= 256""",
        f"grow_{name}": f"""SELECT tree, 0 AS node, 0 AS level, {plain} FROM drawn_{name}
            UNION ALL SELECT tree, 2 * node + CASE WHEN value > split THEN 2 ELSE 1 END, level + 1, {plain} FROM ({_splits(f'grow_{name}')}) WHERE feature >= 0""",
        f"nodes_{name}": f"""SELECT DISTINCT tree, node, feature::INTEGER AS feature, split, CASE WHEN feature < 0 THEN level::DOUBLE + CASE WHEN n <= 1 THEN 0.0::DOUBLE
                WHEN n = 2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * (ln(n - 1.0::DOUBLE) + 0.5772156649::DOUBLE) - 2.0::DOUBLE * (n - 1.0::DOUBLE) / n END END AS path_len
            FROM ({_splits(f'grow_{name}')})""",
        f"walk_{name}": walk(train).format(name),
        f"trainscore_{name}": scores(f"walk_{name}"),
        f"walk_{name}_out": walk(target).format(f"{name}_out"),
        f"outscore_{name}": scores(f"walk_{name}_out"),
        f"flags_{name}": f"""SELECT event_id, round_even(s - t, 6) AS anomaly_score, s - t > 0 AS predicted_anomaly
            FROM {'trainscore' if train == target else 'outscore'}_{name}, (SELECT quantile_cont(s, 0.97) AS t FROM trainscore_{name})""",
    }


_RISK = """least(rate / 0.1::DOUBLE, 1.0::DOUBLE) AS ap, least(cases / 20.0::DOUBLE, 1.0::DOUBLE) AS cp"""
_SCORE = "round_even(100 * (0.5::DOUBLE * ap + 0.5::DOUBLE * cp), 2)"
_LEVEL = "CASE WHEN risk_score >= 60 THEN 'High' WHEN risk_score >= 30 THEN 'Medium' ELSE 'Low' END"


def _metrics(results: str, actual: str, predicted: str) -> str:
    def share(top, bottom):
        return f"CASE WHEN {bottom} = 0 THEN 0.0::DOUBLE ELSE round_even(({top})::DOUBLE / ({bottom}), 4) END"
    return f"""SELECT items, tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
            {share('tp', '(tp + fp)')} AS precision, {share('tp', '(tp + fn)')} AS recall,
            {share('2 * tp', '(2 * tp + fp + fn)')} AS f1, {share('fp', '(fp + tn)')} AS false_positive_rate,
            {share('tp + fn', 'items')} AS prevalence
        FROM (SELECT count(*) AS items, count(*) FILTER ({actual} AND {predicted}) AS tp,
                     count(*) FILTER (NOT {actual} AND {predicted}) AS fp,
                     count(*) FILTER ({actual} AND NOT {predicted}) AS fn,
                     count(*) FILTER (NOT {actual} AND NOT {predicted}) AS tn FROM {results})"""


def _span(source: str) -> str:
    bucket = "time_bucket(INTERVAL 15 MINUTE, max(event_time))"
    return f"""SELECT time_bucket(INTERVAL 15 MINUTE, min(event_time)) AS first_bin,
        CASE WHEN max(event_time) < {bucket} + INTERVAL 10 MINUTE THEN {bucket} - INTERVAL 15 MINUTE
             ELSE {bucket} END AS last_bin FROM {source}"""


def _series(source: str, span: str) -> str:
    return f"""SELECT kind, name, row_number() OVER (PARTITION BY kind, name ORDER BY ds) - 1 AS x, ds,
            coalesce(c.y, 0)::DOUBLE AS y
        FROM (SELECT kind, name, unnest(generate_series(min(ds), (SELECT last_bin FROM {span}),
                     INTERVAL 15 MINUTE)) AS ds
              FROM (SELECT time_bucket(INTERVAL 15 MINUTE, event_time) AS ds, 'total' AS kind, 'all' AS name FROM {source}
                    UNION ALL SELECT time_bucket(INTERVAL 15 MINUTE, event_time), 'region', region FROM {source}
                    UNION ALL SELECT time_bucket(INTERVAL 15 MINUTE, event_time), 'symptom', symptom_type FROM {source})
              GROUP BY kind, name) b
        LEFT JOIN (SELECT kind, name, ds, sum(case_count) AS y FROM (
                    SELECT time_bucket(INTERVAL 15 MINUTE, event_time) AS ds, 'total' AS kind, 'all' AS name, case_count FROM {source}
                    UNION ALL SELECT time_bucket(INTERVAL 15 MINUTE, event_time), 'region', region, case_count FROM {source}
                    UNION ALL SELECT time_bucket(INTERVAL 15 MINUTE, event_time), 'symptom', symptom_type, case_count FROM {source})
                   GROUP BY ALL) c USING (kind, name, ds)"""


def _forecast(series: str) -> str:
    def clip(x):
        return f"round_even(greatest({x}, 0.0::DOUBLE), 2)"
    return f"""SELECT kind, name, last_bin + step * INTERVAL 15 MINUTE AS forecast_time,
            {clip('v')} AS predicted_cases, {clip('v - 1.2816::DOUBLE * sd')} AS lower_cases,
            {clip('v + 1.2816::DOUBLE * sd')} AS upper_cases, n AS history_points
        FROM (SELECT *, intercept + slope * (n - 1 + step) AS v, sqrt(greatest(syy - sxy * sxy / sxx, 0) / (n - 2)) AS sd
              FROM (SELECT kind, name, count(*) AS n, max(ds) AS last_bin, regr_slope(y, x) AS slope,
                           regr_intercept(y, x) AS intercept, regr_syy(y, x) AS syy, regr_sxx(y, x) AS sxx,
                           regr_sxy(y, x) AS sxy FROM {series} GROUP BY kind, name HAVING count(*) >= 12),
                   range(1, 9) s(step))"""


_BOXES = """CASE WHEN heart_rate >= 100 THEN 1.0 WHEN oxygen_saturation < 92 THEN 2.0 ELSE 10.0 END::DOUBLE
    + CASE WHEN body_temperature >= 38.5::DOUBLE THEN 1.0 WHEN systolic_bp >= 160 THEN 2.0 ELSE 10.0 END::DOUBLE
    + CASE WHEN diastolic_bp >= 100 THEN 1.0 WHEN respiratory_rate >= 20 THEN 2.0 WHEN heart_rate < 40 THEN 3.0
      ELSE 10.0 END::DOUBLE"""

VIEWS: dict[str, str] = {
    "ev": """SELECT event_id AS e, ts, user_id AS u, event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS event_time,
        (day(ts) - 1) * 24 + hour(ts) AS hr, ts + (event_id * 37 % 5000) * INTERVAL 1 MILLISECOND AS processed_at,
        lpad(event_id::VARCHAR, 8, '0') AS number,
        ((day(ts) - 1) * 24 + hour(ts)) % 5 IN (1, 2) AND event_id % 10 < 8 AS ob FROM events""",
    "reading_base": """SELECT *, u % 6 + 1 AS place, CASE WHEN e % 37 = 0 THEN e // 37 % 5 ELSE -1 END AS kind,
        CASE WHEN e % 101 = 5 THEN e // 101 % 4 ELSE -1 END AS bad FROM ev""",
    "reading_vitals": """SELECT *,
        CASE kind WHEN 0 THEN 125 + e % 36 WHEN 1 THEN 100 + e % 26 WHEN 2 THEN 105 + e % 26 WHEN 4 THEN 35 + e % 14
             ELSE 62 + e * 31 % 27 END AS hrate,
        CASE kind WHEN 2 THEN 75 + e % 16 WHEN 3 THEN 180 + e % 31 ELSE 104 + e * 17 % 29 END AS sbp,
        CASE kind WHEN 2 THEN 40 + e % 16 WHEN 3 THEN 115 + e % 16 ELSE 66 + e * 13 % 19 END AS dbp,
        CASE kind WHEN 0 THEN 820 + e * 7 % 81 ELSE 960 + e * 7 % 36 END AS ox,
        CASE kind WHEN 1 THEN 388 + e * 11 % 18 ELSE 364 + e * 11 % 9 END AS temp,
        CASE kind WHEN 0 THEN 24 + e % 9 WHEN 1 THEN 20 + e % 7 ELSE 13 + e * 5 % 7 END AS rr FROM reading_base""",
    "raw_readings": f"""SELECT 'V-' || number AS event_id, 'P-' || lpad(u::VARCHAR, 4, '0') AS patient_id,
        'R' || place AS region_id, event_time, (CASE WHEN bad = 0 THEN NULL ELSE hrate END)::INTEGER AS heart_rate,
        (CASE WHEN bad = 2 THEN dbp ELSE sbp END)::INTEGER AS systolic_bp,
        (CASE WHEN bad = 2 THEN sbp + 20 ELSE dbp END)::INTEGER AS diastolic_bp,
        (CASE WHEN bad = 1 THEN 1010 + e % 190 ELSE ox END) / 10.0::DOUBLE AS oxygen_saturation,
        temp / 10.0::DOUBLE AS body_temperature, (CASE WHEN bad = 3 THEN -rr ELSE rr END)::INTEGER AS respiratory_rate,
        {_CENTRE_LAT}[place] / 1e6::DOUBLE AS latitude, {_CENTRE_LON}[place] / 1e6::DOUBLE AS longitude,
        ts + later * INTERVAL 1 SECOND AS created_at, processed_at + later * INTERVAL 1 SECOND AS processed_at
        FROM reading_vitals, (VALUES (0), (60)) d(later) WHERE later = 0 OR e % 50 = 0""",
    "raw_reports": f"""SELECT 'G-' || number AS event_id, event_time, 'R' || place AS region_id,
        [{', '.join(repr(r[1]) for r in REGIONS)}][place] AS region_name,
        ({_CENTRE_LAT}[place] + CASE WHEN ob THEN 10000 + north * 4 ELSE north * 60 END) / 1e6::DOUBLE
            + CASE WHEN bad = 0 THEN 100.0 ELSE 0.0 END::DOUBLE AS latitude,
        ({_CENTRE_LON}[place] + CASE WHEN ob THEN 10000 + east * 4 ELSE east * 60 END) / 1e6::DOUBLE AS longitude,
        CASE WHEN bad = 3 THEN NULL ELSE event_type END AS symptom_category,
        (CASE WHEN bad = 2 THEN 9 ELSE 1 + e * 13 % 4 END)::INTEGER AS severity,
        (CASE WHEN bad = 1 THEN 0 ELSE 1 + e * 17 % 3 END)::INTEGER AS case_count,
        ts + later * INTERVAL 1 SECOND AS created_at, processed_at + later * INTERVAL 1 SECOND AS processed_at
        FROM (SELECT *, CASE WHEN ob THEN (hr // 5 + 3 * (e % 2)) % 6 ELSE u % 6 END + 1 AS place,
                     CASE WHEN e % 103 = 7 THEN e // 103 % 4 ELSE -1 END AS bad,
                     e * 7919 % 2001 - 1000 AS north, e * 104729 % 2003 - 1001 AS east FROM ev),
             (VALUES (0), (60)) d(later) WHERE later = 0 OR e % 50 = 0""",
    "kept_readings": f"SELECT * FROM raw_readings WHERE {_RANGES} AND systolic_bp > diastolic_bp",
    "kept_reports": """SELECT * FROM raw_reports WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
        AND case_count >= 1 AND severity BETWEEN 1 AND 4 AND symptom_category IS NOT NULL""",
    "readings": """SELECT * RENAME (region_id AS region),
        heart_rate >= 100 OR oxygen_saturation <= 90 OR body_temperature >= 38.5::DOUBLE OR systolic_bp >= 160
            OR (diastolic_bp = 84 AND respiratory_rate = 19) AS predicted_anomaly,
        round_even(date_diff('microsecond', created_at, processed_at) / 1e6::DOUBLE, 3) AS latency_seconds
        FROM kept_readings QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY created_at) = 1""",
    "reports": """SELECT * EXCLUDE (region_name) RENAME (region_id AS region, symptom_category AS symptom_type),
        round_even(date_diff('microsecond', created_at, processed_at) / 1e6::DOUBLE, 3) AS latency_seconds
        FROM kept_reports QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY created_at) = 1""",
    "scored": f"""SELECT * EXCLUDE (predicted_anomaly, score), score AS anomaly_score, score > 0 AS predicted_anomaly
        FROM (SELECT *, pow(2.0::DOUBLE, -(({_BOXES}) / 3) / 10.2448::DOUBLE) - 0.6::DOUBLE AS score FROM readings)""",
    "reading_labels": """SELECT 'V-' || number AS event_id, e % 37 = 0 AS is_anomaly,
        CASE WHEN e % 37 = 0 THEN ['tachycardia_hypoxia', 'fever', 'hypotension', 'hypertensive_crisis',
             'bradycardia'][e // 37 % 5 + 1] ELSE 'none' END AS anomaly_type, e % 101 = 5 AS is_corrupt FROM ev""",
    "report_labels": """SELECT 'G-' || number AS event_id, ob AS is_outbreak_event,
        CASE WHEN ob THEN 'OB-' || lpad((2 * (hr // 5) + e % 2)::VARCHAR, 3, '0') END AS outbreak_id FROM ev""",
    "outbreaks": f"""SELECT 'OB-' || lpad((2 * fifth + parity)::VARCHAR, 3, '0') AS outbreak_id,
        ({_CENTRE_LAT}[(fifth + 3 * parity) % 6 + 1] + 10000) / 1e6::DOUBLE AS center_latitude,
        ({_CENTRE_LON}[(fifth + 3 * parity) % 6 + 1] + 10000) / 1e6::DOUBLE AS center_longitude,
        start + (fifth * 5 + 1) * INTERVAL 1 HOUR AS start_time, start + (fifth * 5 + 3) * INTERVAL 1 HOUR AS end_time
        FROM (SELECT date_trunc('month', min(ts))::TIMESTAMP AS start, unnest(range(0, max(hr) // 5 + 1)) AS fifth FROM ev),
             range(0, 2) p(parity)""",
    "regions": f"SELECT * FROM (VALUES {_REGION_ROWS}) t(region, region_name, latitude, longitude)",
    **_cluster_views("hour", 60),
    **_cluster_views("half", 30),
    "summary": """SELECT cluster_id, window_end, (SELECT region FROM labels_hour i WHERE i.cluster_id = l.cluster_id
             GROUP BY region ORDER BY count(*) DESC, region LIMIT 1) AS region,
        avg(latitude) AS center_latitude, avg(longitude) AS center_longitude,
        count(*) AS event_count, sum(case_count)::BIGINT AS total_cases
        FROM labels_hour l WHERE in_cluster GROUP BY cluster_id, window_end""",
    "risk": f"""SELECT region, window_end, round_even(rate, 4) AS anomaly_rate, cases AS clustered_cases,
            round_even(ap, 4) AS anomaly_part, round_even(cp, 4) AS cluster_part, risk_score, {_LEVEL} AS risk_level
        FROM (SELECT *, {_SCORE} AS risk_score FROM (SELECT *, {_RISK} FROM (
            SELECT w.window_end, g.region, coalesce(v.rate, 0.0::DOUBLE) AS rate, coalesce(c.cases, 0) AS cases
            FROM (SELECT DISTINCT window_end FROM members_hour) w CROSS JOIN regions g
            LEFT JOIN (SELECT time_bucket(INTERVAL 60 MINUTE, event_time - INTERVAL 1 MICROSECOND) + INTERVAL 60 MINUTE
                              AS window_end, region, avg(predicted_anomaly::INT::DOUBLE) AS rate
                       FROM readings GROUP BY ALL) v USING (window_end, region)
            LEFT JOIN (SELECT m.window_end, region, sum(case_count)::BIGINT AS cases FROM members_hour m
                       JOIN touched_hour t ON t.window_end = m.window_end AND t.event_id = m.event_id GROUP BY ALL) c
                USING (window_end, region))))""",
    "newest_risk": "SELECT * FROM risk WHERE window_end = (SELECT max(window_end) FROM risk)",
    "span": _span("reports"),
    "series": _series("reports", "span"),
    "predicted": _forecast("series"),
    "first_half": f"SELECT * FROM reports WHERE created_at < {HALF}",
    "half_span": _span("first_half"),
    "half_series": _series("first_half", "half_span"),
    "half_predicted": _forecast("half_series"),
    "readings_before": f"SELECT * FROM readings WHERE created_at < {HALF}",
    "readings_after": f"SELECT * FROM readings WHERE created_at >= {HALF}",
    **_forest_views("all", "readings", "readings"),
    **_forest_views("early", "readings_before", "readings_after"),
    # p arrives at its own time; q is near it and at most an hour older; q is core among events up to p's time
    "close": f"""SELECT a.event_id AS p, a.event_time AS pt, b.event_id AS q, b.event_time AS qt
        FROM reports a JOIN reports b ON b.event_time > a.event_time - INTERVAL 60 MINUTE
            AND b.event_time < a.event_time + INTERVAL 60 MINUTE
        WHERE abs(a.latitude - b.latitude) < 0.01
          AND {haversine('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')} <= 0.5""",
    "causal": """SELECT event_id, event_time, coalesce(hit, false) AS predicted_outbreak FROM reports
        LEFT JOIN (SELECT p, bool_or(n >= 5) AS hit FROM (
                SELECT x.p, x.q, count(*) AS n FROM close x JOIN close y ON y.p = x.q
                WHERE x.qt <= x.pt AND y.qt <= x.pt AND y.qt > x.pt - INTERVAL 60 MINUTE GROUP BY x.p, x.q) GROUP BY p)
            ON p = event_id""",
}

_READING_VIEW = ("event_id, patient_id, region, event_time, created_at, heart_rate, systolic_bp, diastolic_bp,"
                 " oxygen_saturation, body_temperature, respiratory_rate")
_REPORT_VIEW = ("event_id, region, event_time, created_at, latitude, longitude, symptom_type, severity, case_count")


def _reason(rules: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{name}'" for name, test in rules) + " END"


_READING_REASON = _reason(
    [("missing_heart_rate", "heart_rate IS NULL")]
    + [(f"{v}_out_of_range", f"{v} NOT BETWEEN {lo} AND {hi}") for v, (lo, hi) in VITAL_RANGES.items()]
    + [("systolic_not_above_diastolic", "systolic_bp <= diastolic_bp")])
_REPORT_REASON = _reason([
    ("missing_symptom_category", "symptom_category IS NULL"), ("latitude_out_of_range", "latitude NOT BETWEEN -90 AND 90"),
    ("case_count_below_one", "case_count < 1"), ("severity_out_of_range", "severity NOT BETWEEN 1 AND 4")])
_COUNTS = """SELECT 'vitals_results' AS table_name, count(*) AS rows FROM readings
    UNION ALL SELECT 'geo_events', count(*) FROM reports UNION ALL SELECT 'clusters', count(*) FROM summary
    UNION ALL SELECT 'region_risk', count(*) FROM risk UNION ALL SELECT 'forecasts', count(*) FROM predicted"""
_REGION_NAME = "(SELECT region_name FROM regions g WHERE g.region = x.region)"


def _latency(feed: str, table: str) -> str:
    span = "date_diff('microsecond', min(processed_at), max(processed_at)) / 1e6::DOUBLE"
    return f"""SELECT '{feed}' AS feed, count(latency_seconds) AS events, round(median(latency_seconds), 6) AS median_latency,
        round(quantile_cont(latency_seconds, 0.95), 6) AS p95_latency, max(latency_seconds) AS max_latency,
        {span} AS span_seconds, CASE WHEN count(*) >= 2 AND {span} >= 1 THEN round(count(*) / ({span}), 6) END AS throughput
        FROM {table}"""


QUERIES: dict[str, str] = {
    "label_counts": "SELECT count(*) AS rows_written, count(*) FILTER (is_corrupt) AS corrupt_rows FROM reading_labels",
    "scan_vitals": f"SELECT {_READING_VIEW}, predicted_anomaly, latitude, longitude, processed_at, latency_seconds FROM readings",
    "range_scan_vitals": f"""SELECT {_READING_VIEW}, predicted_anomaly FROM readings
        WHERE event_time > {START} AND event_time <= {END}""",
    "range_scan_reports": f"SELECT {_REPORT_VIEW} FROM reports WHERE event_time > {START} AND event_time <= {END}",
    "insert_if_absent_vitals": f"""SELECT {_READING_VIEW} FROM readings
        WHERE event_id NOT IN (SELECT event_id FROM kept_readings WHERE created_at < {HALF})""",
    "insert_if_absent_reports": f"""SELECT {_REPORT_VIEW} FROM reports
        WHERE event_id NOT IN (SELECT event_id FROM kept_reports WHERE created_at < {HALF})""",
    "latest_assignment": """SELECT event_id, window_end, cluster_id, in_cluster FROM labels_half
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY window_end DESC) = 1""",
    "table_counts": _COUNTS,
    "valid_vitals": """SELECT event_id, created_at, region_id, heart_rate, systolic_bp, diastolic_bp,
        oxygen_saturation, body_temperature, respiratory_rate FROM kept_readings""",
    "valid_reports": """SELECT event_id, created_at, region_id, region_name, latitude, longitude, symptom_category,
        severity, case_count FROM kept_reports""",
    "reject_counts": """SELECT 'vitals' AS feed, (SELECT count(*) FROM raw_readings) AS rows_read,
            (SELECT count(*) FROM raw_readings) - (SELECT count(*) FROM kept_readings) AS rows_rejected,
            (SELECT count(*) FROM kept_readings) AS rows_valid
        UNION ALL SELECT 'reports', (SELECT count(*) FROM raw_reports),
            (SELECT count(*) FROM raw_reports) - (SELECT count(*) FROM kept_reports), (SELECT count(*) FROM kept_reports)""",
    "reject_reasons": f"""SELECT * FROM (SELECT event_id, created_at, {_READING_REASON} AS reject_reason FROM raw_readings
        UNION ALL SELECT event_id, created_at, {_REPORT_REASON} FROM raw_reports) WHERE reject_reason IS NOT NULL""",
    "filter_readings": f"""SELECT {_READING_VIEW}, predicted_anomaly FROM readings WHERE event_time BETWEEN {START} AND {END}
        AND region IN ('R1', 'R3', 'R5') AND predicted_anomaly""",
    "filter_reports": f"""SELECT {_REPORT_VIEW} FROM reports WHERE event_time BETWEEN {START} AND {END}
        AND region IN ('R2', 'R4') AND severity IN (2, 3, 4) AND symptom_type IN ('error', 'view')""",
    "store_checks": f"""SELECT 'rows in ' || table_name AS check_name, rows AS found,
            table_name = 'clusters' OR rows > 0 AS passed FROM ({_COUNTS})
        UNION ALL SELECT 'events without processing time', n, n = 0 FROM (SELECT count(*) AS n FROM (
            SELECT processed_at, latency_seconds FROM readings UNION ALL SELECT processed_at, latency_seconds FROM reports)
            WHERE processed_at IS NULL OR latency_seconds IS NULL)""",
    "utc_text": "SELECT event_id, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00' AS created_text FROM readings",
    "latency_rows": """SELECT event_id, latency_seconds FROM readings UNION ALL
        SELECT event_id, latency_seconds FROM reports""",
    "distance_to_region": f"""SELECT event_id, round({haversine('r.latitude', 'r.longitude', 'g.latitude', 'g.longitude')}, 6)
        AS distance_km FROM reports r JOIN regions g USING (region)""",
    "offset_position": """SELECT event_id, round_even(latitude + case_count * 0.5::DOUBLE / 111.32::DOUBLE, 6) AS new_latitude,
        round_even(longitude + severity * 0.25::DOUBLE / (111.32::DOUBLE * cos(radians(latitude))), 6) AS new_longitude
        FROM reports""",
    "tick_bucket": """SELECT event_id, date_diff('minute', TIMESTAMP '2024-01-01', event_time) // 5 AS tick,
        TIMESTAMP '2024-01-01' + (date_diff('minute', TIMESTAMP '2024-01-01', event_time) // 5) * INTERVAL 5 MINUTE AS tick_time
        FROM readings""",
    "risk_grid": f"""SELECT patient_id, cases, round_even(ap, 4) AS anomaly_part, round_even(cp, 4) AS cluster_part, risk_score,
        {_LEVEL} AS risk_level FROM (SELECT *, {_SCORE} AS risk_score FROM (SELECT *, {_RISK} FROM (
            SELECT patient_id, avg(predicted_anomaly::INT::DOUBLE) AS rate, count(*) % 45 AS cases
            FROM readings GROUP BY patient_id)))""",
    "recent_readings": f"""SELECT event_id, strftime(event_time, '%Y-%m-%d %H:%M') AS simulated_time, patient_id,
        {_REGION_NAME} AS region_name, heart_rate, systolic_bp || '/' || diastolic_bp AS blood_pressure, oxygen_saturation,
        body_temperature, respiratory_rate, round_even(anomaly_score, 3) AS anomaly_score,
        CASE WHEN predicted_anomaly THEN 'Yes' ELSE 'No' END AS flagged
        FROM scored x WHERE predicted_anomaly ORDER BY event_time DESC, event_id DESC LIMIT 50""",
    "map_points": f"""SELECT event_id, event_time, latitude, longitude, {_REGION_NAME} AS region_name, symptom_type, severity, case_count,
        in_cluster, cluster_id FROM labels_hour x""",
    "normalise_vitals": """SELECT event_id, created_at, round_even(heart_rate * 1.013::DOUBLE, 0)::INTEGER AS heart_rate,
        round_even(systolic_bp * 1.017::DOUBLE, 0)::INTEGER AS systolic_bp,
        least(round_even(diastolic_bp * 1.4::DOUBLE, 0)::INTEGER, round_even(systolic_bp * 1.017::DOUBLE, 0)::INTEGER - 10)
            AS diastolic_bp, round_even(oxygen_saturation * 0.9931::DOUBLE, 1) AS oxygen_saturation,
        round_even(body_temperature * 1.0017::DOUBLE, 1) AS body_temperature,
        round_even(respiratory_rate * 1.07::DOUBLE, 0)::INTEGER AS respiratory_rate FROM kept_readings""",
    "pattern_tags": " UNION ALL ".join(
        f"SELECT event_id, '{name}' AS pattern FROM readings WHERE "
        + " AND ".join(f"{v} BETWEEN {lo}::DOUBLE AND {hi}::DOUBLE" for v, (lo, hi) in bounds.items())
        for name, bounds in PATTERNS.items()),
    "label_join": """SELECT event_id, predicted_anomaly, is_anomaly, anomaly_type
        FROM readings JOIN reading_labels USING (event_id)""",
    "label_join_audit": """SELECT count(*) FILTER (v > 0 AND l > 0) AS matched, count(*) FILTER (v > 0 AND l = 0) AS without_label,
        count(*) FILTER (v = 0 AND l > 0) AS without_verdict, count(*) FILTER (v > 1 OR l > 1) AS repeated
        FROM (SELECT event_id, sum(v) AS v, sum(l) AS l FROM (SELECT event_id, 1 AS v, 0 AS l FROM readings
              UNION ALL SELECT event_id, 0, 1 FROM reading_labels) GROUP BY event_id)""",
    "region_risk": "SELECT * FROM risk",
    "risk_map": """SELECT n.region, region_name, latitude, longitude, risk_level, risk_score, anomaly_part, cluster_part,
        region_name || ' | ' || risk_level AS label FROM newest_risk n JOIN regions USING (region)""",
    "semi_filter": """SELECT event_id, patient_id, event_time FROM readings
        WHERE patient_id IN (SELECT patient_id FROM readings WHERE predicted_anomaly)""",
    "window_members": f"SELECT window_end, event_id FROM ({_members(15)})",
    "members_at_given_ends": """SELECT window_end, event_id FROM reports
        JOIN (SELECT DISTINCT date_trunc('hour', event_time) + INTERVAL 37 MINUTE AS window_end FROM reports) e
        ON event_time <= window_end AND event_time > window_end - INTERVAL 45 MINUTE""",
    "neighbour_degree": "SELECT window_end, event_id, degree FROM degree_hour",
    "nearest_region": f"""SELECT event_id, region, nearest, round(distance, 6) AS distance_km FROM (
        SELECT r.event_id, r.region, g.region AS nearest,
               {haversine('r.latitude', 'r.longitude', 'g.latitude', 'g.longitude')} AS distance
        FROM reports r CROSS JOIN regions g
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY distance, g.region) = 1)""",
    "outbreak_members": f"""SELECT event_id, outbreak_id, round(distance, 6) AS distance_km FROM (
        SELECT event_id, outbreak_id, {haversine('latitude', 'longitude', 'center_latitude', 'center_longitude')} AS distance
        FROM reports JOIN outbreaks ON event_time >= start_time AND event_time < end_time) WHERE distance <= 1""",
    "cluster_summary": """SELECT * REPLACE (round(center_latitude + 1e-9::DOUBLE, 6) AS center_latitude,
        round(center_longitude + 1e-9::DOUBLE, 6) AS center_longitude) FROM summary""",
    "case_history": """SELECT ds, coalesce(y, 0)::DOUBLE AS y FROM (
            SELECT unnest(generate_series(first_bin, last_bin, INTERVAL 15 MINUTE)) AS ds FROM span)
        LEFT JOIN (SELECT time_bucket(INTERVAL 15 MINUTE, event_time) AS ds, sum(case_count) AS y FROM reports GROUP BY ALL)
            USING (ds)""",
    "latest_event_time": "SELECT max(event_time) AS latest FROM reports",
    "headline": """SELECT (SELECT count(*) FROM readings) AS patient_events,
        (SELECT count(*) FROM readings WHERE predicted_anomaly) AS patient_anomalies,
        (SELECT count(*) FROM reports) AS geo_events, (SELECT count(*) FROM summary) AS cluster_records,
        (SELECT count(*) FROM summary WHERE window_end = (SELECT max(window_end) FROM risk)) AS clusters_latest_window,
        region AS top_risk_region, risk_score AS top_risk_score, risk_level AS top_risk_level,
        window_end AS latest_window_end FROM newest_risk ORDER BY risk_score DESC, region LIMIT 1""",
    "latency_summary": f"{_latency('vitals', 'readings')} UNION ALL {_latency('reports', 'reports')}",
    "forest_nodes": "SELECT tree, node, feature, round(split, 9) AS split, round(path_len, 9) AS path_len FROM nodes_all",
    "forest_flags": "SELECT * FROM flags_all",
    "forest_evaluation": _metrics("flags_early JOIN reading_labels USING (event_id)", "is_anomaly", "predicted_anomaly"),
    "confusion_metrics": _metrics("readings JOIN reading_labels USING (event_id)", "is_anomaly", "predicted_anomaly"),
    "recall_by_type": """SELECT anomaly_type, count(*) AS items, round_even(avg(predicted_anomaly::INT::DOUBLE), 3) AS recall
        FROM readings JOIN reading_labels USING (event_id) WHERE is_anomaly GROUP BY anomaly_type""",
    "outbreaks_detected": """SELECT (SELECT count(DISTINCT outbreak_id) FROM causal JOIN report_labels USING (event_id)
        WHERE predicted_outbreak AND is_outbreak_event) AS detected, (SELECT count(*) FROM outbreaks) AS outbreaks""",
    "reconciliation": """SELECT w AS readings_written, c AS corrupt_written, s AS readings_stored, a AS anomalies,
        w - s AS readings_rejected, w - s = c AS reconciled
        FROM (SELECT count(*) AS w, count(*) FILTER (is_corrupt) AS c FROM reading_labels),
             (SELECT count(*) AS s, count(*) FILTER (predicted_anomaly) AS a FROM readings)""",
    "symptom_options": "SELECT DISTINCT symptom_type FROM reports",
    "latest_risk": "SELECT * FROM newest_risk",
    "active_clusters": f"""SELECT cluster_id, region, {_REGION_NAME} AS region_name, event_count, total_cases,
        round_even(center_latitude, 4) AS center_latitude, round_even(center_longitude, 4) AS center_longitude
        FROM summary x WHERE window_end = (SELECT max(window_end) FROM risk)""",
    "last_clusters": f"""SELECT cluster_id, region, {_REGION_NAME} AS region_name, event_count, total_cases,
        round_even(center_latitude, 4) AS center_latitude, round_even(center_longitude, 4) AS center_longitude
        FROM summary x WHERE window_end = (SELECT max(window_end) FROM summary)""",
    "risk_table": f"""SELECT region, {_REGION_NAME} AS region_name, anomaly_rate, clustered_cases, anomaly_part,
        cluster_part, risk_score, risk_level FROM newest_risk x""",
    "time_extent": """SELECT min(event_time) AS first_time, max(event_time) AS last_time FROM (
        SELECT event_time FROM readings UNION ALL SELECT event_time FROM reports)""",
    "scaled_vitals": "SELECT event_id, " + ", ".join(
        f"round(({v} - avg({v}) OVER ()) / stddev_pop({v}) OVER (), 6) AS z_{v}" for v in VITALS) + " FROM readings",
    "forest_score_fixed": "SELECT event_id, round(anomaly_score, 6) AS anomaly_score, predicted_anomaly FROM scored",
    "dbscan_core": "SELECT window_end, event_id FROM core_hour",
    "dbscan_labels": "SELECT window_end, event_id, is_core, in_cluster, cluster_no, cluster_id FROM labels_hour",
    "trend_forecast": "SELECT * FROM predicted",
    "forecast_eligibility": "SELECT kind, name, count(*) AS bins, count(*) >= 12 AS eligible FROM series GROUP BY kind, name",
    "causal_outbreak_flags": "SELECT * FROM causal",
    "history_and_forecast": """SELECT 'history' AS series, ds AS time, y AS cases, NULL::DOUBLE AS lower, NULL::DOUBLE AS upper
            FROM series WHERE kind = 'total'
        UNION ALL SELECT 'forecast', forecast_time, predicted_cases, lower_cases, upper_cases FROM predicted WHERE kind = 'total'""",
    "forecast_staleness": """SELECT b AS bins_now, t AS trained_on, b IS DISTINCT FROM t AS stale
        FROM (SELECT count(*) AS b FROM series WHERE kind = 'total'),
             (SELECT max(history_points) AS t FROM half_predicted WHERE kind = 'total')""",
}
_TABLE = "items, precision, recall, f1, false_positive_rate, true_positives, false_positives, false_negatives, true_negatives"
QUERIES["evaluation_table"] = (
    f"SELECT 'forest' AS detector, {_TABLE} FROM ({QUERIES['confusion_metrics']})"
    f" UNION ALL SELECT 'dbscan', {_TABLE} FROM ("
    + _metrics("causal JOIN report_labels USING (event_id)", "is_outbreak_event", "predicted_outbreak") + ")")


def _needed(text: str) -> set[str]:
    found = {name for name in VIEWS if re.search(rf"\b{name}\b", text)}
    for name in list(found):
        found |= _needed_by(name)
    return found


def _needed_by(view: str) -> set[str]:
    names = {name for name in VIEWS if name != view and re.search(rf"\b{name}\b", VIEWS[view])}
    return names.union(*map(_needed_by, names)) if names else names


def all_oracles() -> dict[str, str]:
    out = {}
    for key, text in QUERIES.items():
        needed = _needed(text)
        views = ",\n".join(f"{name} AS ({sql})" for name, sql in VIEWS.items() if name in needed)
        out[key] = f"WITH RECURSIVE {views}\n{text}"
    return out
