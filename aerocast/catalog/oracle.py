"""DuckDB SQL that computes the same results as the registered queries."""

from __future__ import annotations

from aerocast.catalog.views import BASELINE_UNTIL, COARSE, COARSE_DEPTH, CUTOFF, DROPOUT_BELOW, MEASURED, STATIONS
from aerocast import contract
from aerocast.contract import CITIES, LAGGED, ROLLED
from aerocast.functions import advice, labels

ORACLE: dict[str, str] = {}

# --- Shared table expressions ------------------------------------------------

RAW = """raw AS (
  SELECT event_id, event_type AS city, date_trunc('hour', ts) AS datetime,
         least(5.0e0, 1.0e0 + value / 25.0e0) AS main_aqi, value AS components_pm2_5,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS components_pm10
  FROM events)"""
READINGS = f"""{RAW}, readings AS (
  SELECT city, datetime, main_aqi, components_pm2_5, components_pm10 FROM raw
  QUALIFY row_number() OVER (PARTITION BY city, datetime ORDER BY event_id) = 1)"""
DROPOUTS = f"""{READINGS}, dropouts AS (
  SELECT city, datetime, CASE WHEN components_pm2_5 >= {DROPOUT_BELOW}e0 THEN main_aqi END AS main_aqi,
         components_pm2_5, components_pm10 FROM readings)"""


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def case(column: str, mapping: dict, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {text(k) if isinstance(k, str) else k} THEN {v}" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {default} END"


STATION = f"""{READINGS}, stations AS (
  SELECT {case("city", {k: text(v) for k, v in STATIONS.items()})} AS city, datetime, main_aqi,
         components_pm2_5, components_pm10 FROM readings)"""

CALENDAR = """CAST(hour(datetime) AS INTEGER) AS hour, CAST(isodow(datetime) - 1 AS INTEGER) AS dayofweek,
  CAST(month(datetime) AS INTEGER) AS month, CAST(isodow(datetime) >= 6 AS INTEGER) AS is_weekend"""
LAGS = ", ".join(f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for c in LAGGED for k in (1, 2, 3))
MEANS = ", ".join(
    f"avg({c}) OVER (PARTITION BY city ORDER BY datetime ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS {c}_roll3_mean"
    for c in ROLLED
)
BY_TIME = "WINDOW w AS (PARTITION BY city ORDER BY datetime)"


def target_of(source: str) -> str:
    return f"""targets AS (
  SELECT * FROM (SELECT *, lead(main_aqi, 3) OVER w AS main_aqi_t_plus_h FROM {source} {BY_TIME})
  WHERE main_aqi_t_plus_h IS NOT NULL)"""


def features_of(source: str) -> str:
    complete = " AND ".join(
        [f"{c}_lag_{k} IS NOT NULL" for c in LAGGED for k in (1, 2, 3)] + [f"{c}_roll3_mean IS NOT NULL" for c in ROLLED]
    )
    return f"""{target_of(source)}, features AS (
  SELECT * FROM (
    SELECT *, CAST(main_aqi_t_plus_h >= 4 AS INTEGER) AS hazard_t_plus_h, {CALENDAR}, {LAGS}, {MEANS}
    FROM targets {BY_TIME})
  WHERE {complete})"""


ROUND_MEANS = ", ".join(f"round({c}_roll3_mean, 6) AS {c}_roll3_mean" for c in ROLLED)
FEATURES = f"{READINGS}, {features_of('readings')}"
FORECAST = f"""{FEATURES}, forecast AS (
  SELECT *, main_aqi AS aqi_3h, CAST(main_aqi >= 4 AS INTEGER) AS hazard_class,
         (main_aqi - 1) / 4e0 AS hazard_prob FROM features)"""
EPOCH = "TIMESTAMP '1970-01-01'"


def put(name: str, views: str, select: str) -> None:
    ORACLE[name] = f"WITH {views}\n{select}"


# --- Series --------------------------------------------------------------------

put("dedup_readings", READINGS, "SELECT * FROM readings")
TARGETED = "SELECT *, CAST(main_aqi_t_plus_h >= 4 AS INTEGER) AS hazard_t_plus_h FROM targets"
put("future_target", f"{READINGS}, {target_of('readings')}", TARGETED)
put("future_target_dropouts", f"{DROPOUTS}, {target_of('dropouts')}", TARGETED)
put("lag_features", READINGS, f"SELECT *, {LAGS} FROM readings {BY_TIME}")
put(
    "rolling_mean",
    f"{READINGS}, rolled AS (SELECT *, {MEANS} FROM readings)",
    f"SELECT * REPLACE ({ROUND_MEANS}) FROM rolled",
)
put("calendar_features", READINGS, f"SELECT *, {CALENDAR} FROM readings")
WHOLE = f"SELECT * REPLACE ({ROUND_MEANS}) FROM features"
for _name in ("forecast_features", "features_from_targets"):
    put(_name, FEATURES, WHOLE)
put("forecast_features_dropouts", f"{DROPOUTS}, {features_of('dropouts')}", WHOLE)

# --- Splits and filters ----------------------------------------------------------

SPLIT = f"CASE WHEN datetime <= TIMESTAMP '{CUTOFF}' THEN 'train' ELSE 'val' END AS split"
put("time_split", FEATURES, f"SELECT city, datetime, main_aqi_t_plus_h, {SPLIT} FROM features")
put(
    "quantile_split",
    READINGS,
    """SELECT city, datetime, CASE WHEN epoch_us(datetime) <= (SELECT quantile_cont(epoch_us(datetime), 0.8) FROM readings)
  THEN 'train' ELSE 'val' END AS split FROM readings""",
)
put(
    "split_periods",
    FEATURES,
    f"""SELECT split, min(datetime) AS "start", max(datetime) AS "end", count(*) AS n
FROM (SELECT *, {SPLIT} FROM features) GROUP BY split""",
)
put("cutoff_filter", RAW, f"SELECT * FROM raw WHERE datetime <= TIMESTAMP '{CUTOFF}'")
put(
    "last_7_days",
    READINGS,
    "SELECT * FROM readings QUALIFY datetime > max(datetime) OVER (PARTITION BY city) - INTERVAL 7 DAY",
)
put("city_series", READINGS, "SELECT * FROM readings WHERE city = 'error'")
ORACLE["parsed_times"] = """SELECT event_id,
  CASE WHEN event_type = 'error' THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END AS datetime
FROM events WHERE event_type <> 'view'"""
ORACLE["coerced_numbers"] = """SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS value,
  CAST(user_id AS DOUBLE) AS user_id FROM events"""
put("standardised_headers", RAW, "SELECT * FROM raw")
put("aligned_columns", RAW, "SELECT datetime, components_pm10, main_aqi, city FROM raw")

# --- Joins and sets ----------------------------------------------------------------

CITY_ROWS = ", ".join(f"({text(c)}, {lat}e0, {lon}e0)" for c, lat, lon in CITIES)
CITY_NAMES = ", ".join(text(c) for c, _, _ in CITIES)
put(
    "city_lookup",
    f"{STATION}, dim(city_key, lat, lon) AS (VALUES {CITY_ROWS})",
    """SELECT lower(trim(city)) AS city_key, datetime, main_aqi, lat, lon
FROM stations LEFT JOIN dim ON lower(trim(city)) = dim.city_key""",
)
put(
    "supported_city_filter",
    STATION,
    f"""SELECT upper(left(trim(city), 1)) || lower(substr(trim(city), 2)) AS city, datetime, main_aqi
FROM stations WHERE lower(trim(city)) IN ({CITY_NAMES})""",
)
put(
    "unsupported_city_rows",
    STATION,
    f"SELECT * FROM stations WHERE city IS NULL OR lower(trim(city)) NOT IN ({CITY_NAMES})",
)
put(
    "latest_observation_join",
    READINGS,
    """SELECT city, max(datetime) AS observed_at, arg_max(main_aqi, datetime) AS main_aqi,
  arg_max(components_pm2_5, datetime) AS components_pm2_5, max(datetime) + INTERVAL 30 MINUTE AS weather_at,
  arg_max(components_pm10, datetime) AS components_pm10 FROM readings GROUP BY city""",
)
SERVED = f"""{STATION}, served AS (
  SELECT upper(left(trim(city), 1)) || lower(substr(trim(city), 2)) AS city, max(datetime) AS observed_at_local,
         arg_max(main_aqi, datetime) AS main_aqi, arg_max(components_pm2_5, datetime) AS components_pm2_5,
         arg_max(components_pm10, datetime) AS components_pm10
  FROM stations WHERE lower(trim(city)) IN ({CITY_NAMES}) GROUP BY city)"""
put(
    "served_observations",
    SERVED,
    """SELECT *, components_pm10 AS precipitation, observed_at_local - INTERVAL 1 HOUR AS datetime,
  CAST(hour(observed_at_local - INTERVAL 1 HOUR) AS INTEGER) AS hour, main_aqi AS main_aqi_lag_3 FROM served""",
)
put(
    "union_of_sources",
    READINGS,
    f"SELECT * FROM readings UNION ALL SELECT * FROM readings WHERE datetime > TIMESTAMP '{CUTOFF}'",
)
ORACLE["distinct_cities"] = "SELECT DISTINCT event_type AS city FROM events"

# --- Profiles ------------------------------------------------------------------------

LEVELS = f"""{READINGS}, levels AS (
  SELECT *, CAST(greatest(1, least(5, round_even(main_aqi, 0))) AS INTEGER) AS level FROM readings)"""
put("city_counts", RAW, "SELECT city, count(*) AS n FROM raw GROUP BY city")
put("level_counts", LEVELS, "SELECT level, count(*) AS n FROM levels GROUP BY level")
put(
    "level_share",
    LEVELS,
    "SELECT level, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM levels GROUP BY level",
)
put(
    "level_share_by_city",
    LEVELS,
    """SELECT city, level, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY city), 6) AS share
FROM levels GROUP BY city, level""",
)
put(
    "null_profile",
    DROPOUTS,
    "\nUNION ALL ".join(
        f"""SELECT {text(c)} AS "column", count(*) - count({c}) AS n_null,
  round((count(*) - count({c})) / count(*), 6) AS null_share FROM dropouts"""
        for c in ["city", "datetime", *MEASURED]
    ),
)
put(
    "duplicate_counts",
    RAW,
    """SELECT 'row' AS scope, CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM raw
  GROUP BY city, datetime, main_aqi, components_pm2_5, components_pm10)
UNION ALL SELECT 'key', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM raw GROUP BY city, datetime)""",
)
put(
    "describe",
    DROPOUTS,
    "\nUNION ALL ".join(
        f"""SELECT {text(c)} AS feature, count({c}) AS "count", round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS "min", round(quantile_cont({c}, 0.25), 6) AS q1,
  round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3,
  round(max({c}), 6) AS "max" FROM dropouts"""
        for c in MEASURED
    ),
)


def boxes(c: str) -> str:
    return f"""SELECT city, {text(c)} AS feature, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(least(min(v) FILTER (inside), q1), 6) AS whisker_low,
  round(greatest(max(v) FILTER (inside), q3), 6) AS whisker_high,
  count(*) FILTER (NOT inside) AS n_outliers
FROM (SELECT r.city, r.{c} AS v, q1, median, q3,
        r.{c} BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1) AS inside
      FROM readings r JOIN (SELECT city, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
        quantile_cont({c}, 0.75) AS q3 FROM readings GROUP BY city) q USING (city))
GROUP BY city, q1, median, q3"""


put("box_stats", READINGS, "\nUNION ALL ".join(f"({boxes(c)})" for c in ("components_pm2_5", "components_pm10")))
put(
    "daily_mean_filled",
    """means AS (
  SELECT event_type || ':' || user_id AS series, CAST(ts AS DATE) AS day,
         round(avg(least(5.0e0, 1.0e0 + value / 25.0e0)), 6) AS main_aqi_mean, round(avg(value), 6) AS components_pm2_5_mean
  FROM events GROUP BY ALL),
days AS (SELECT series, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
  FROM means GROUP BY series)""",
    "SELECT days.series, days.day, main_aqi_mean, components_pm2_5_mean FROM days LEFT JOIN means USING (series, day)",
)
GRID = f"""{READINGS}, grid AS (
  SELECT city, unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 HOUR)) AS datetime
  FROM readings GROUP BY city),
gaps AS (SELECT * FROM grid ANTI JOIN readings USING (city, datetime))"""
put("missing_stamps", GRID, "SELECT * FROM gaps")


def ranges_of(source: str) -> str:
    return f"""SELECT city, start AS gap_start, stop AS gap_end, datediff('hour', start, stop) + 1 AS hours FROM (
  SELECT city, lag(datetime) OVER w + INTERVAL 1 HOUR AS start, datetime - INTERVAL 1 HOUR AS stop FROM (SELECT DISTINCT city, datetime FROM {source}) {BY_TIME})
WHERE start <= stop"""


put("missing_ranges", READINGS, ranges_of("readings"))
put(
    "missing_ranges_by_series",
    "series AS (SELECT event_type || ':' || user_id AS city, date_trunc('hour', ts) AS datetime FROM events)",
    ranges_of("series"),
)
put(
    "missing_hours",
    GRID,
    """SELECT city, count(gaps.datetime) AS missing_hours FROM (SELECT DISTINCT city FROM readings)
LEFT JOIN gaps USING (city) GROUP BY city""",
)
put(
    "correlation_matrix",
    DROPOUTS,
    "\nUNION ALL ".join(
        f"SELECT {text(a)} AS a, {text(b)} AS b, round(corr({a}, {b}), 6) AS corr FROM dropouts"
        for a in MEASURED
        for b in MEASURED
    ),
)
put(
    "imputation_values",
    DROPOUTS,
    "\nUNION ALL ".join(
        f"SELECT {text(c)} AS feature, round(quantile_cont({c}, 0.5), 6) AS median FROM dropouts" for c in MEASURED
    ),
)
ORACLE["imputed_city"] = """SELECT event_type AS city FROM events GROUP BY event_type
ORDER BY count(*) DESC, event_type LIMIT 1"""

# --- Histograms and drift ----------------------------------------------------------------


def tall(source: str, columns=MEASURED) -> str:
    return " UNION ALL ".join(f"SELECT {text(c)} AS feature, {c} AS value FROM {source}" for c in columns)


def edges(source: str, bins: int) -> str:
    """Edges per feature from a (feature, value) table."""
    return f"""edges AS (
  SELECT feature, list_append(list_transform(range(0, {bins}), lambda i: i * ((hi - lo) / {bins}e0) + lo), hi) AS e
  FROM (SELECT feature, min(value) AS lo, max(value) AS hi FROM {source} GROUP BY feature))"""


def bins(source: str, n: int) -> str:
    """Counts and fractions of a (feature, value) table on the edges, empty bins included."""
    return f"""counted AS (
  SELECT s.feature, least(len(list_filter(e, lambda x: x <= value)), {n}) AS bin, count(*) AS n
  FROM {source} s JOIN edges USING (feature) WHERE value BETWEEN e[1] AND e[{n + 1}] GROUP BY ALL),
binned AS (
  SELECT g.feature, CAST(g.bin AS INTEGER) AS bin, e[g.bin] AS lo, e[g.bin + 1] AS hi, coalesce(n, 0) AS n,
         coalesce(n, 0) / greatest(sum(coalesce(n, 0)) OVER (PARTITION BY g.feature), 1) AS frac
  FROM (SELECT feature, e, unnest(range(1, {n + 1})) AS bin FROM edges) g LEFT JOIN counted USING (feature, bin))"""


BINNED = "SELECT feature, bin, round(lo, 6) AS lo, round(hi, 6) AS hi, n, round(frac, 6) AS frac FROM binned"
put("histogram_equal_width", f"{READINGS}, t AS ({tall('readings')}), {edges('t', 30)}, {bins('t', 30)}", BINNED)
put(
    "json_stats_roundtrip",
    f"{READINGS}, t AS ({tall('readings')}), {edges('t', 5)}, {bins('t', 5)}",
    "SELECT feature, bin, round(lo, 6) AS lo, round(hi, 6) AS hi, round(frac, 6) AS frac FROM binned",
)


def sides(shift: bool) -> str:
    late = f"SELECT * FROM readings WHERE datetime > TIMESTAMP '{BASELINE_UNTIL}'"
    if shift:
        late = late.replace("SELECT *", "SELECT * REPLACE (components_pm10 / 3e0 AS components_pm10)")
    return f"""{READINGS},
early AS (SELECT * FROM readings WHERE datetime <= TIMESTAMP '{BASELINE_UNTIL}'), late AS ({late}),
t AS ({tall('early')}), t2 AS ({tall('late')}), {edges('t', 5)}"""


put("histogram_given_edges", f"{sides(False)}, {bins('t2', 5)}", BINNED)


def drift(shift: bool) -> tuple[str, str]:
    first = bins("t", 5).replace("counted", "counted_ref").replace("binned AS", "reference AS")
    views = f"{sides(shift)}, {first}, {bins('t2', 5)}"
    return views, """SELECT feature, round(sum((r - c) * ln((r + 1e-6) / (c + 1e-6))), 6) AS psi,
  round(max(abs(cum_r - cum_c)), 6) AS ks,
  sum((r - c) * ln((r + 1e-6) / (c + 1e-6))) > 0.3e0 OR max(abs(cum_r - cum_c)) > 0.5e0 AS drifted
FROM (SELECT feature, reference.frac AS r, binned.frac AS c,
        sum(reference.frac) OVER w AS cum_r, sum(binned.frac) OVER w AS cum_c
      FROM binned JOIN reference USING (feature, bin) WINDOW w AS (PARTITION BY feature ORDER BY bin))
GROUP BY feature"""


put("drift_report", *drift(False))
put("drift_report_shifted", *drift(True))
put("drift_from_days", *drift(False))
ORACLE["histogram_from_days"] = ORACLE["histogram_equal_width"]
PROBS = {"p01": 0.01, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}
put(
    "percentiles_from_days",
    DROPOUTS,
    "\nUNION ALL ".join(
        f"SELECT {text(c)} AS feature, {text(n)} AS name, round(quantile_cont({c}, {p}), 6) AS value, true AS within_bounds FROM dropouts"
        for c in MEASURED
        for n, p in PROBS.items()
    ),
)

# --- Metrics --------------------------------------------------------------------------------

SQUARED = "avg((main_aqi_t_plus_h - aqi_3h) * (main_aqi_t_plus_h - aqi_3h))"
REGRESSION = f"""count(*) AS n, round({SQUARED}, 6) AS mse, round(sqrt({SQUARED}), 6) AS rmse,
  round(avg(abs(main_aqi_t_plus_h - aqi_3h)), 6) AS mae,
  round(1 - {SQUARED} / var_pop(main_aqi_t_plus_h), 6) AS r2"""
CONFUSION = {
    name: f"count(*) FILTER (hazard_t_plus_h = {a} AND hazard_class = {b})"
    for name, a, b in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
}
ACCURACY = "round(avg(CAST(hazard_t_plus_h = hazard_class AS DOUBLE)), 6) AS accuracy"
F1 = "round(coalesce(2e0 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0), 6) AS f1".format(**CONFUSION)
COUNTS = ", ".join(f"{v} AS {k}" for k, v in CONFUSION.items())
put("regression_metrics", FORECAST, f"SELECT {REGRESSION} FROM forecast")
put("classification_metrics", FORECAST, f"SELECT count(*) AS n, {ACCURACY}, {F1}, {COUNTS} FROM forecast")
RANKED = """SELECT {key} CASE WHEN count(*) FILTER (y = 1) > 0 AND count(*) FILTER (y = 0) > 0 THEN round(
  (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2e0)
  / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)), 6) END AS roc_auc
FROM (SELECT city, hazard_t_plus_h AS y, rank() OVER w + (count(*) OVER (PARTITION BY {part} hazard_prob) - 1) / 2e0 AS r
      FROM forecast WINDOW w AS ({over} ORDER BY hazard_prob)) {group}"""
put("roc_auc", FORECAST, RANKED.format(key="", part="", over="", group=""))
put(
    "roc_auc_by_city",
    FORECAST,
    RANKED.format(key="city,", part="city,", over="PARTITION BY city", group="GROUP BY city"),
)
put(
    "metrics_by_city",
    FORECAST,
    f"""SELECT CASE WHEN grouping(city) = 1 THEN '(all)' ELSE city END AS scope, {REGRESSION}, {ACCURACY}, {F1}
FROM forecast GROUP BY GROUPING SETS ((), (city))""",
)


def bucket(x: str) -> str:
    level = f"greatest(1, least(5, round_even({x}, 0)))"
    return f"CAST(CASE WHEN {x} IS NULL THEN 2 ELSE least(3, {level} - 1) END AS INTEGER)"


put(
    "level_accuracy",
    FORECAST,
    """SELECT round(avg(CAST(CAST(greatest(1, least(5, round_even(aqi_3h, 0))) AS INTEGER)
  = CAST(trunc(main_aqi_t_plus_h) AS INTEGER) AS DOUBLE)), 6) AS level_accuracy FROM forecast""",
)
put(
    "severity_accuracy",
    FORECAST,
    f"""SELECT round(avg(CAST({bucket('main_aqi_t_plus_h')} = {bucket('aqi_3h')} AS DOUBLE)), 6) AS severity_accuracy
FROM forecast""",
)
put(
    "label_counts",
    FEATURES,
    """SELECT hazard_t_plus_h, count(*) AS n, min(count(*)) OVER () AS smallest FROM features GROUP BY hazard_t_plus_h""",
)
put(
    "class_weights",
    FEATURES,
    """SELECT hazard_t_plus_h, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM features GROUP BY hazard_t_plus_h""",
)
COUNTERS = "count(*) AS total, count(*) FILTER (value >= 1) AS successful, count(*) FILTER (value < 1) AS failed"
ORACLE["scoring_counters"] = f"""SELECT CASE WHEN grouping(event_type) = 1 THEN '(all)' ELSE event_type END AS scope, {COUNTERS}
FROM events GROUP BY GROUPING SETS ((), (event_type))"""

# --- Labels and advice ---------------------------------------------------------------------------

SEVERITY = dict(enumerate(map(text, labels.SEVERITY_BY_LEVEL), 1))
BUCKETS = dict(enumerate(map(text, labels.SEVERITY_BY_BUCKET)))


def severity(x: str) -> str:
    return case(f"CAST(greatest(1, least(5, round_even({x}, 0))) AS INTEGER)", SEVERITY, "'Unknown'")


def severity_or_unknown(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'Unknown' ELSE {severity(x)} END"


def category(x: str) -> str:
    arms = " ".join(f"WHEN {x} <= {b} THEN {text(t)}" for b, t in labels.CATEGORY_UP_TO)
    return f"CASE WHEN {x} IS NULL THEN 'Unknown' {arms} ELSE {text(labels.CATEGORY_ABOVE)} END"


def hazard(x: str, words) -> str:
    return f"CASE WHEN {x} >= 4 THEN {text(words[0])} ELSE {text(words[1])} END"


def trend(predicted: str, current: str) -> str:
    d = f"{predicted} - {current}"
    return f"""CASE WHEN abs({d}) < 0.2e0 THEN {text(labels.TREND_SAME)} WHEN {d} > 0 THEN {text(labels.TREND_WORSE)}
  ELSE {text(labels.TREND_BETTER)} END"""


LABELLED = {
    "hazard_label": f"""CAST(main_aqi >= 4 AS INTEGER) AS hazard, {hazard('main_aqi', labels.HAZARD_TEXT)} AS by_level,
  {hazard('main_aqi', labels.HAZARD_CLASS_TEXT)} AS by_class""",
    "severity_bucket": f"""{bucket('main_aqi')} AS severity_bucket,
  {case(bucket('main_aqi'), BUCKETS, "'Unknown'")} AS bucket_label""",
    "severity_label": f"{severity_or_unknown('main_aqi')} AS severity_label",
    "aqi_category": f"{category('main_aqi')} AS aqi_category",
}
for _name, _columns in LABELLED.items():
    put(_name, DROPOUTS, f"SELECT city, datetime, {_columns} FROM dropouts")
put(
    "half_level_labels",
    f"{READINGS}, halves AS (SELECT *, floor(main_aqi * 2) / 2e0 AS level FROM readings)",
    f"""SELECT city, datetime, level, {bucket('level')} AS severity_bucket, {severity('level')} AS severity_label,
  {category('level')} AS aqi_category FROM halves""",
)
put("trend_note", FEATURES, f"SELECT city, datetime, {trend('main_aqi_t_plus_h', 'main_aqi')} AS trend_note FROM features")


def advise(predicted: str, severity_text: str, current: str | None) -> str:
    def pick(part):
        return f"CASE WHEN {predicted} >= 4 THEN {text(part(advice.HAZARD_ADVICE))} ELSE {text(part(advice.CALM_ADVICE))} END"

    summary = pick(lambda a: a["summary"])
    if current:
        summary = f"{summary} || ' ' || {trend(predicted, current)}"
    return f"""SELECT city, datetime, {severity_text} AS severity_bucket, {pick(lambda a: a["headline"].format(h=3))} AS headline,
  {summary} AS summary, {pick(lambda a: " | ".join(a["general"]))} AS actions_general,
  {pick(lambda a: " | ".join(a["sensitive"]))} AS actions_sensitive_groups, 3 AS horizon_hours,
  {predicted} AS predicted_aqi, {current or "CAST(NULL AS DOUBLE)"} AS current_aqi"""


put(
    "recommendations",
    FEATURES,
    advise("main_aqi_t_plus_h", severity("main_aqi_t_plus_h"), "main_aqi") + " FROM features",
)
put(
    "recommendations_from_bucket",
    FORECAST,
    advise("aqi_3h", case(bucket("aqi_3h"), BUCKETS), None) + " FROM forecast",
)
ORACLE["observation_times"] = """SELECT event_id, date_trunc('second', ts) AS observed_at_utc,
  date_trunc('second', ts) + INTERVAL 5 HOUR AS observed_at_local,
  date_trunc('second', ts) + INTERVAL 8 HOUR AS predicted_for_local,
  strftime(ts + INTERVAL 5 HOUR, '%d %b %Y, %I:%M %p') || ' PKT' AS display FROM events"""
COPIES = ", ".join(f"{c} AS {c}_lag_{k}" for c in LAGGED for k in (1, 2, 3))
COPIES += ", " + ", ".join(f"{c} AS {c}_roll3_mean" for c in ROLLED)
put(
    "cold_start_rows",
    f"""{STATION}, patchy AS (
  SELECT upper(left(trim(city), 1)) || lower(substr(trim(city), 2)) AS city, datetime, main_aqi, components_pm2_5,
         CASE WHEN components_pm10 >= 50 THEN components_pm10 ELSE 0 END AS components_pm10 FROM stations)""",
    f"""SELECT datetime, main_aqi, components_pm2_5, components_pm10, city, {CALENDAR}, {COPIES} FROM patchy""",
)

# --- Checks ------------------------------------------------------------------------------------------


def report(source: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT {text(n)} AS "check", count(*) FILTER (NOT coalesce({r}, false)) AS violations FROM {source}"""
        for n, r in rules.items()
    )


REQUIRED = ["city", "datetime", *MEASURED]
RAW_RULES = {f"null:{c}": f"{c} IS NOT NULL" for c in REQUIRED} | {"range:main_aqi": "main_aqi BETWEEN 1 AND 5"}
LABEL_RULE = {"label:hazard_t_plus_h": "hazard_t_plus_h IN (0, 1)"}
MODEL_INPUTS = [
    "city",
    *MEASURED,
    "hour",
    "dayofweek",
    "month",
    "is_weekend",
    *[f"{c}_lag_{k}" for c in LAGGED for k in (1, 2, 3)],
    *[f"{c}_roll3_mean" for c in ROLLED],
]
put("raw_checks", DROPOUTS, report("dropouts", RAW_RULES))
put(
    "feature_checks",
    FEATURES,
    report(
        "features",
        {f"null:{c}": f"{c} IS NOT NULL" for c in MODEL_INPUTS}
        | {"range:main_aqi_t_plus_h": "main_aqi_t_plus_h BETWEEN 1 AND 5"}
        | LABEL_RULE,
    ),
)
put(
    "integrity_report",
    f"""{FEATURES}, raised AS (SELECT * REPLACE (main_aqi + components_pm10 / 50e0 AS main_aqi) FROM features)""",
    report("raised", RAW_RULES | LABEL_RULE),
)
put(
    "prediction_checks",
    f"{FORECAST}, bold AS (SELECT aqi_3h * 1.5e0 - 1 AS prediction FROM forecast)",
    report("bold", {"missing": "prediction IS NOT NULL", "range": "prediction IS NULL OR prediction BETWEEN 1 AND 5"}),
)
SUITE = ["main_aqi", "hour", "month", "city", "hazard_t_plus_h"]
SUITE_INPUTS = SUITE[:-1]
put(
    "integrity_findings",
    FEATURES,
    "\nUNION ALL ".join(
        [f"SELECT 'nulls' AS finding, {text(c)} AS subject, count(*) - count({c}) AS amount FROM features" for c in SUITE]
        + [
            """SELECT 'duplicate keys', '*', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
  FROM (SELECT count(*) AS n FROM features GROUP BY city, datetime)"""
        ]
        + [
            f"SELECT 'single value', {text(c)}, CAST(1 AS BIGINT) FROM features HAVING count(DISTINCT {c}) = 1 AND count({c}) = count(*)"
            for c in SUITE
        ]
        + [
            f"""SELECT 'conflicting labels', 'hazard_t_plus_h', CAST(coalesce(sum(n) FILTER (a <> b), 0) AS BIGINT)
  FROM (SELECT min(hazard_t_plus_h) AS a, max(hazard_t_plus_h) AS b, count(*) AS n FROM features
        GROUP BY {", ".join(SUITE_INPUTS)})"""
        ]
    ),
)

# --- Samples -----------------------------------------------------------------------------------------

KEY = "md5('42|' || city || '|' || CAST(epoch_us(datetime) AS VARCHAR))"
put("hash_sample", READINGS, f"SELECT * FROM readings ORDER BY {KEY} LIMIT 200")
put(
    "balanced_sample",
    FEATURES,
    f"""SELECT city, datetime, hazard_t_plus_h FROM features
QUALIFY row_number() OVER (PARTITION BY hazard_t_plus_h ORDER BY {KEY})
  <= (SELECT min(n) FROM (SELECT count(*) AS n FROM features GROUP BY hazard_t_plus_h))""",
)
put("earliest_rows", READINGS, "SELECT * FROM readings ORDER BY city, datetime LIMIT 50")

# --- Payloads ----------------------------------------------------------------------------------------

ORACLE["json_payload_fields"] = """SELECT event_id, least(5.0e0, 1.0e0 + value / 25.0e0) AS main_aqi, value AS components_pm2_5,
  value * 2 AS components_co, CAST(NULL AS DOUBLE) AS components_no2, date_trunc('second', ts) AS observed_at_utc,
  date_trunc('second', ts) + INTERVAL 5 HOUR AS observed_at_local FROM events"""
HOURS = """SELECT city, CAST(datetime AS DATE) AS day, datetime, components_pm2_5 AS temperature_2m,
  components_pm10 AS precipitation, CAST(NULL AS DOUBLE) AS wind_speed_10m FROM readings"""
put("weather_arrays_hours", READINGS, HOURS)
put(
    "weather_arrays_last",
    READINGS,
    f"{HOURS} QUALIFY row_number() OVER (PARTITION BY city, CAST(datetime AS DATE) ORDER BY datetime DESC) = 1",
)

# --- Files and records ---------------------------------------------------------------------------------

put("csv_roundtrip", READINGS, "SELECT * FROM readings")
put("layout_roundtrip", READINGS, "SELECT * FROM readings")
NAMED = case("city", {kind: text(name.capitalize()) for kind, (name, _, _) in zip(sorted(STATIONS), CITIES)})
put(
    "city_files",
    READINGS,
    f"""SELECT {NAMED} AS city, datetime, main_aqi, components_pm2_5, components_pm10
FROM readings WHERE datetime <= TIMESTAMP '{CUTOFF}'""",
)
put(
    "load_readings_first_row",
    DROPOUTS,
    "SELECT upper(left(city, 1)) || substr(city, 2) AS city, datetime, main_aqi, components_pm2_5, components_pm10 FROM dropouts",
)
ORACLE["landed_in_parts"] = ORACLE["load_readings_first_row"]
PERIODS = f"""SELECT split, strftime(min(datetime), '%Y-%m-%d %H:%M:%S') AS "start", strftime(max(datetime), '%Y-%m-%d %H:%M:%S') AS "end",
  count(*) AS n FROM (SELECT *, {SPLIT} FROM features) GROUP BY split"""
put("stored_metadata", FEATURES, PERIODS)
put(
    "contract_inputs",
    FEATURES,
    "\nUNION ALL ".join(
        f"SELECT {i} AS place, {text(c)} AS feature, {'count(*)' if c in MODEL_INPUTS else '0 * count(*)'} AS n_rows FROM features"
        for i, c in enumerate(contract.FEATURES)
    ),
)
put(
    "contract_rows",
    FEATURES,
    "SELECT datetime, " + ", ".join(f"round({c}, 6) AS {c}" if c.endswith("_mean") else c for c in contract.FEATURES if c in MODEL_INPUTS) + " FROM features",
)
put(
    "latest_run",
    f"{FORECAST}, curve AS ({RANKED.format(key='', part='', over='', group='')})",
    f"""SELECT '2024-02-02T00:00:00Z' AS timestamp_utc, 'second' AS run_id, round(sqrt({SQUARED}), 6) AS reg_rmse,
  round(avg(abs(main_aqi_t_plus_h - aqi_3h)), 6) AS reg_mae, round(1 - {SQUARED} / var_pop(main_aqi_t_plus_h), 6) AS reg_r2,
  {ACCURACY.replace("AS accuracy", "AS clf_accuracy")}, {F1.replace("AS f1", "AS clf_f1")},
  (SELECT roc_auc FROM curve) AS clf_roc_auc,
  round(avg(CAST({bucket('main_aqi_t_plus_h')} = {bucket('aqi_3h')} AS DOUBLE)), 6) AS rec_accuracy,
  'persistence' AS notes FROM forecast""",
)

# --- Models --------------------------------------------------------------------------------------------
# Predictions are not SQL; keys, counts and the rules that every prediction must obey are.

VAL = f"{FORECAST}, val AS (SELECT * FROM forecast WHERE datetime > TIMESTAMP '{CUTOFF}')"
FILLED = f"""{DROPOUTS}, middle AS (
  SELECT quantile_cont(main_aqi, 0.5) AS a, quantile_cont(components_pm2_5, 0.5) AS b FROM dropouts),
filled AS (SELECT city, datetime, coalesce(main_aqi, a) AS a, coalesce(components_pm2_5, b) AS b FROM dropouts, middle),
spread AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM filled)"""
ONE_HOT = ", ".join(f"CAST(city = {text(kind)} AS INTEGER) AS is_{kind}" for kind in sorted(STATIONS))
put(
    "prepared_inputs",
    FILLED,
    f"""SELECT city, datetime, round((a - ma) / sa, 6) AS level_scaled, round((b - mb) / sb, 6) AS fine_dust_scaled, {ONE_HOT}
FROM filled, spread""",
)
put("rf_forecast", VAL, "SELECT city, datetime, main_aqi_t_plus_h, true AS within_training_range FROM val")
put(
    "rf_hazard",
    VAL,
    "SELECT city, datetime, hazard_t_plus_h, true AS is_probability, true AS class_follows_probability FROM val",
)
put("tree_severity", VAL, "SELECT city, datetime, main_aqi_t_plus_h, true AS is_trained_bucket FROM val")
put(
    "current_level_baseline",
    READINGS,
    """SELECT count(*) AS n, true AS rmse_is_root_of_mse, true AS mae_is_below_rmse, true AS beats_the_mean FROM readings
WHERE epoch_us(datetime) > (SELECT quantile_cont(epoch_us(datetime), 0.8) FROM readings)""",
)


# Plain trees are grown here level by level: of all cuts between values that the earlier side has, a node takes the one
# that leaves the least spread (squared error, or Gini's, which is the same sum over class indicators).
COARSE_ROWS = ", ".join(f"floor({c} * 4) / 4e0 AS {c}" if c.startswith("main_aqi") else c for c in COARSE)
COARSE_INPUTS = [f"CAST({c} AS DOUBLE)" for c in COARSE if c != "city"]
COARSE_INPUTS += [f"CAST(city = {text(kind)} AS DOUBLE)" for kind in sorted(STATIONS)]


def cells_of(views: str, rows: str) -> str:
    """Views of the inputs of ``rows`` cell by cell, and the cuts between the values of those to learn from."""
    cells = " UNION ALL ".join(f"SELECT id, learn, {i} AS f, {c} AS v FROM coarse" for i, c in enumerate(COARSE_INPUTS))
    return f"""{views}, coarse AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY learn, city, datetime) AS id, datetime, {COARSE_ROWS}, main_aqi_t_plus_h, hazard_t_plus_h, learn FROM ({rows})),
cells AS MATERIALIZED ({cells}),
cuts AS MATERIALIZED (
  SELECT f, v, (v + lead(v) OVER (PARTITION BY f ORDER BY v)) / 2 AS cut FROM (SELECT DISTINCT f, v FROM cells WHERE learn)
  QUALIFY cut IS NOT NULL)"""


def grown(tree: str, sums: list[str], weight: str = "1e0", prune: bool = False) -> str:
    """Views of a tree over ``cells``: ``tree_rows`` (id, node) and ``tree_leaves`` (node, share of each sum by weight).

    With ``prune``, sibling leaves that agree on the largest sum are joined again.
    """
    z = range(len(sums))
    views = [f"{tree}_y AS MATERIALIZED (SELECT id, {weight} AS w, {', '.join(f'({weight}) * ({s}) AS z{i}' for i, s in enumerate(sums))} FROM coarse WHERE learn)"]
    views.append(f"{tree}_0 AS MATERIALIZED (SELECT id, 1 AS node FROM coarse)")
    totals_ = ", ".join(["sum(w) AS w", *[f"sum(z{i}) AS z{i}" for i in z]])
    lefts = ", ".join(["sum(h.w) AS wl", *[f"sum(h.z{i}) AS l{i}" for i in z]])
    whole = ", ".join(["t.w", *[f"t.z{i}" for i in z]])
    gain = " + ".join(f"l{i} * l{i} / wl + (z{i} - l{i}) * (z{i} - l{i}) / (w - wl) - z{i} * z{i} / w" for i in z)
    for level in range(COARSE_DEPTH):
        views += [
            f"{tree}_h{level} AS MATERIALIZED (SELECT node, f, v, {totals_} FROM {tree}_{level} JOIN {tree}_y USING (id) JOIN cells USING (id) GROUP BY ALL)",
            f"{tree}_t{level} AS MATERIALIZED (SELECT node, {totals_} FROM {tree}_{level} JOIN {tree}_y USING (id) GROUP BY ALL)",
            f"""{tree}_b{level} AS MATERIALIZED (
  SELECT node, f, cut FROM (
    SELECT t.node, c.f, c.cut, {whole}, {lefts} FROM {tree}_t{level} t CROSS JOIN cuts c
    JOIN {tree}_h{level} h ON h.node = t.node AND h.f = c.f AND h.v <= c.v GROUP BY ALL)
  WHERE w - wl > 1e-9 AND ({gain}) / w > 1e-12
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(({gain}) / w, 11) DESC, f, cut) = 1)""",
            f"""{tree}_{level + 1} AS MATERIALIZED (
  SELECT m.id, CASE WHEN b.node IS NULL THEN m.node ELSE 2 * m.node + CAST(c.v > b.cut AS INTEGER) END AS node
  FROM {tree}_{level} m LEFT JOIN {tree}_b{level} b ON b.node = m.node LEFT JOIN cells c ON c.id = m.id AND c.f = b.f)""",
        ]
    last = f"{tree}_{COARSE_DEPTH}"
    if prune:
        best = "CASE " + " ".join(f"WHEN sum(z{i}) = greatest({', '.join(f'sum(z{k})' for k in z)}) THEN {i}" for i in z) + " END"
        for level in range(COARSE_DEPTH, 0, -1):
            inside = f"node BETWEEN {2**level} AND {2 ** (level + 1) - 1}"
            views.append(f"""{tree}_p{level} AS MATERIALIZED (
  SELECT m.id, coalesce(x.parent, m.node) AS node FROM {last} m LEFT JOIN (
    SELECT node // 2 AS parent FROM (SELECT node, {best} AS best FROM {last} JOIN {tree}_y USING (id) WHERE {inside} GROUP BY node)
    GROUP BY ALL HAVING count(*) = 2 AND min(best) = max(best)) x ON x.parent = m.node // 2 AND {inside.replace('node', 'm.node')})""")
            last = f"{tree}_p{level}"
    views.append(f"{tree}_rows AS MATERIALIZED (SELECT * FROM {last})")
    shares = ", ".join(f"sum(z{i}) / sum(w) AS s{i}" for i in z)
    views.append(f"{tree}_leaves AS MATERIALIZED (SELECT node, {shares} FROM {last} JOIN {tree}_y USING (id) GROUP BY ALL)")
    return ",\n".join(views)


BUCKET_SUMS = [f"CAST({bucket('main_aqi_t_plus_h')} = {k} AS DOUBLE)" for k in range(4)]
CLASS_N = "(SELECT hazard_t_plus_h AS class, count(*) AS n FROM coarse WHERE learn GROUP BY ALL)"
WEIGHTS = f"(SELECT (SELECT count(*) FROM coarse WHERE learn) / (2e0 * n) FROM {CLASS_N} WHERE class = hazard_t_plus_h)"

JUDGED = f"""{grown("level", ["main_aqi_t_plus_h"])},
{grown("hazard", ["CAST(hazard_t_plus_h = 0 AS DOUBLE)", "CAST(hazard_t_plus_h = 1 AS DOUBLE)"], WEIGHTS, prune=True)},
{grown("kind", BUCKET_SUMS)},
predicted AS (
  SELECT c.city, c.datetime, l.s0 AS aqi_3h, CAST(h.s1 > h.s0 AS INTEGER) AS hazard_class, h.s1 AS hazard_prob,
    CAST(CASE {" ".join(f"WHEN k.s{i} = greatest(k.s0, k.s1, k.s2, k.s3) THEN {i}" for i in range(4))} END AS INTEGER) AS severity_model
  FROM coarse c JOIN level_rows USING (id) JOIN level_leaves l USING (node)
    JOIN hazard_rows hr ON hr.id = c.id JOIN hazard_leaves h ON h.node = hr.node
    JOIN kind_rows kr ON kr.id = c.id JOIN kind_leaves k ON k.node = kr.node
  WHERE NOT c.learn)"""
PREDICTED = f"{cells_of(FEATURES, f'SELECT *, datetime <= TIMESTAMP {text(CUTOFF)} AS learn FROM features')},\n{JUDGED}"
TREE_ROWS = "SELECT city, datetime, round(aqi_3h, 9) AS aqi_3h, hazard_class, round(hazard_prob, 9) AS hazard_prob, severity_model FROM predicted"
put("tree_predictions", PREDICTED, TREE_ROWS)
put("tree_predictions_by_pipeline", PREDICTED, TREE_ROWS)
put(
    "predicted_records",
    PREDICTED,
    f"""SELECT city, datetime, round(aqi_3h, 9) AS aqi_3h, round(hazard_prob, 9) AS hazard_prob,
  {hazard('aqi_3h', labels.HAZARD_TEXT)} AS hazard_label, {case('severity_model', {k: text(v) for k, v in enumerate(labels.SEVERITY_BY_BUCKET)})} AS severity_bucket,
  datetime + INTERVAL 3 HOUR AS predicted_for_local FROM predicted""",
)


def totals(safe: str, hazardous: str, more: dict[str, float]) -> str:
    """Rows (metric, value) of a confusion matrix whose sides have these many rows."""
    rows = {"safe": safe, "hazardous": hazardous, "rows": f"{safe} + {hazardous}"}
    rows |= {"accuracy_from_counts": "0e0", "auc_is_a_share": "1e0"} | {k: f"{v}e0" for k, v in more.items()}
    return "\nUNION ALL ".join(f"SELECT {text(k)} AS metric, CAST({v} AS DOUBLE) AS value" for k, v in rows.items())


SIDES = {label: f"(SELECT count(*) FROM {{}} WHERE hazard_t_plus_h = {label})" for label in (0, 1)}
put("holdout_eval", VAL, totals(SIDES[0].format("val"), SIDES[1].format("val"), {"mse_recomputed": 1}))
RAREST = "(SELECT min(n) FROM (SELECT count(*) AS n FROM features GROUP BY hazard_t_plus_h))"
put("balanced_suite", FEATURES, totals(RAREST, RAREST, {}))
put(
    "batch_scoring",
    VAL,
    """SELECT city, datetime, main_aqi AS current_aqi, datetime + INTERVAL 3 HOUR AS predicted_for_local,
  true AS label_follows_level, true AS bucket_follows_model, true AS advice_on_forecast, 'stored/tree' AS recommender_model FROM val""",
)
put(
    "csv_scoring",
    VAL,
    """SELECT upper(left(city, 1)) || substr(city, 2) AS city, count(*) AS n, round(sum(main_aqi), 6) AS current_aqi,
  CAST(0 AS BIGINT) AS without_origin, CAST(0 AS BIGINT) AS wrong_labels FROM val GROUP BY city""",
)
put(
    "model_registry",
    FEATURES,
    f"""SELECT step, role, step <> 'trained' AS from_production
FROM (VALUES ('trained'), ('promoted'), ('newer')) s(step), (VALUES ('regressor'), ('classifier'), ('recommender')) r(role)
WHERE step <> 'newer' OR role <> 'recommender'
UNION ALL SELECT 'periods', split, count(*) > 0 FROM (SELECT *, {SPLIT} FROM features) GROUP BY split""",
)
put(
    "training_run_log",
    VAL,
    f"""SELECT 'feature rows' AS what, count(*) AS n FROM features
UNION ALL SELECT 'validated rows', count(*) FROM val
UNION ALL SELECT 'validated hazards', count(*) FROM val WHERE hazard_t_plus_h = 1
UNION ALL SELECT 'tested rows', count(*) FROM features
UNION ALL SELECT 'baseline features', CAST({len(MODEL_INPUTS) - 1} AS BIGINT)
UNION ALL SELECT 'sampled rows', least(count(*), 200) FROM features
UNION ALL SELECT 'logged metrics agree', CAST(1 AS BIGINT)
UNION ALL SELECT 'models in production', CAST(3 AS BIGINT)""",
)
put(
    "quality_gates",
    VAL,
    """SELECT 'as it is' AS sample, count(*) > 0 AS passed FROM val
UNION ALL SELECT 'wrong model', count(*) = 0 FROM val
UNION ALL SELECT 'level out of range', count(*) = 0 FROM val
UNION ALL SELECT 'moved column', count(*) = 0 FROM val
UNION ALL SELECT 'predictions', count(*) > 0 FROM val""",
)
put(
    "served_records",
    SERVED,
    "\nUNION ALL ".join(
        f"""SELECT {text(source)} AS source, city, {hazard('main_aqi', labels.HAZARD_TEXT)} AS hazard_label,
  observed_at_local + INTERVAL 3 HOUR AS predicted_for_local, {bucket_text} AS severity_bucket, {origin} AS recommender_model FROM served"""
        for source, bucket_text, origin in (
            ("rule", severity("main_aqi"), "CAST(NULL AS VARCHAR)"),
            ("model", text(labels.SEVERITY_BY_BUCKET[0]), "'stored/tree'"),
        )
    ),
)

# --- Streams -------------------------------------------------------------------------------------------

put("stream_dedup", READINGS, "SELECT * FROM readings")
put(
    "stream_scoring",
    READINGS,
    """SELECT city, datetime, main_aqi AS current_aqi, true AS is_probability, true AS label_follows_level,
  'stored/tree' AS recommender_model FROM readings""",
)
ORACLE["stream_counters"] = f"SELECT event_type AS city, {COUNTERS} FROM events GROUP BY event_type"
put(
    "stream_history",
    READINGS,
    f"""SELECT city, datetime, {', '.join(MEASURED)}, {LAGS},
  {', '.join(f"round(avg({c}) OVER (PARTITION BY city ORDER BY datetime ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS {c}_roll3_mean" for c in ROLLED)}
FROM readings {BY_TIME}""",
)
# The trees are grown on the earlier side as before; here they judge every reading with three rows before it.
LIVE = f"""{FEATURES}, live AS MATERIALIZED (
  SELECT * FROM (SELECT city, datetime, main_aqi, {CALENDAR}, {", ".join(f"lag(main_aqi, {k}) OVER w AS main_aqi_lag_{k}" for k in (1, 2, 3))}
    FROM readings {BY_TIME}) WHERE main_aqi_lag_3 IS NOT NULL)"""
INPUTS = ", ".join(["datetime", *COARSE])
LIVE_ROWS = f"""SELECT {INPUTS}, main_aqi_t_plus_h, hazard_t_plus_h, true AS learn FROM features WHERE datetime <= TIMESTAMP '{CUTOFF}'
UNION ALL SELECT {INPUTS}, NULL, NULL, false FROM live"""
put("stream_predictions", f"{cells_of(LIVE, LIVE_ROWS)},\n{JUDGED}", TREE_ROWS)
