"""SQL counterparts of the registered queries, for DuckDB on the same tables."""

from fleetlife.operators.monitoring import LATENCY_BOUNDS

STATEMENTS = {}

MEASURED = ("setting_1", "setting_2", "setting_3", "sensor_1", "sensor_2", "sensor_3", "sensor_4", "sensor_5")
SENSORS = ("sensor_2", "sensor_3", "sensor_4", "sensor_5")


def r(expression: str, digits: int = 6) -> str:
    """Rounded, with decimal halves moved off the rounding edge as in the queries."""
    shift = " + 1e-10" if digits == 6 else ""
    return f"round({expression}{shift}, {digits}) + 0e0"


def rs(names, digits: int = 6) -> str:
    return ", ".join(f"{r(n, digits)} AS {n}" for n in names)


TELE = """
tele AS (
  SELECT 'FD00' || (1 + user_id % 4) AS subset, CAST(user_id + 1 AS INTEGER) AS unit_id, cycle,
    CASE WHEN user_id % 2 = 1 THEN 10.0e0 * floor(h / 6.0e0) ELSE 0.0e0 END + value / 2000 AS setting_1,
    CASE WHEN user_id % 2 = 1 THEN 0.25e0 * (k % 2) ELSE 0.0e0 END + k / 100000.0e0 AS setting_2,
    100.0e0 AS setting_3, 518.67e0 AS sensor_1, value AS sensor_2, CAST(k AS DOUBLE) AS sensor_3, value * k AS sensor_4,
    CASE WHEN user_id % 2 = 1 AND h < 6 AND k % 2 = 0 THEN 1.0e0 ELSE value END AS sensor_5
  FROM (SELECT user_id, value, hour(ts) AS h, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
          CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS cycle FROM events)
),
lens AS (SELECT subset, unit_id, max(cycle) AS last_cycle FROM tele GROUP BY subset, unit_id),
complete AS (SELECT t.*, CAST(last_cycle - cycle AS INTEGER) AS RUL FROM tele t JOIN lens USING (subset, unit_id)),
terminal AS (SELECT subset, unit_id, CAST(last_cycle - floor(last_cycle / 2.0e0) AS INTEGER) AS final_observed_rul FROM lens),
trunc_rows AS (SELECT t.* FROM tele t JOIN lens USING (subset, unit_id) WHERE cycle <= floor(last_cycle / 2.0e0)),
trunc_labelled AS (
  SELECT t.*, CAST(final_observed_rul + m.last_seen - t.cycle AS INTEGER) AS RUL
  FROM trunc_rows t JOIN (SELECT subset, unit_id, max(cycle) AS last_seen FROM trunc_rows GROUP BY ALL) m USING (subset, unit_id)
  JOIN terminal USING (subset, unit_id)
),
faulty AS (
  SELECT * REPLACE (
    CASE WHEN sensor_2 > 50 THEN 'inf'::DOUBLE ELSE sensor_4 END AS sensor_4,
    CASE WHEN sensor_3 < 10 THEN NULL WHEN sensor_3 > 90 THEN 'nan'::DOUBLE ELSE sensor_3 END AS sensor_3) FROM tele
),
gappy AS (SELECT * FROM tele WHERE sensor_2 < 40)
"""

REGIMES = """,
keyed AS (SELECT *, round_even(setting_1, 0) AS key_setting_1, round_even(setting_2, 2) AS key_setting_2, round_even(setting_3, 0) AS key_setting_3 FROM tele),
mapping AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY subset ORDER BY key_setting_1, key_setting_2, key_setting_3) AS INTEGER) AS regime
  FROM (SELECT DISTINCT subset, key_setting_1, key_setting_2, key_setting_3 FROM keyed)
),
assigned AS (
  SELECT k.* EXCLUDE (key_setting_1, key_setting_2, key_setting_3), m.regime
  FROM keyed k LEFT JOIN mapping m USING (subset, key_setting_1, key_setting_2, key_setting_3)
),
n_regimes AS (SELECT subset, count(*) AS n FROM mapping GROUP BY subset)
"""


def _stats(source, keys, deviation):
    parts = []
    for s in SENSORS:
        parts.append(
            f"SELECT {keys}, '{s}' AS sensor, avg({s}) AS mean, "
            f"CASE WHEN min({s}) = max({s}) THEN 0.0e0 ELSE {deviation}({s}) END AS std FROM {source} GROUP BY {keys}"
        )
    return " UNION ALL ".join(parts)


STATS = f""",
by_regime AS ({_stats('assigned', 'subset, regime', 'stddev_pop')}),
by_subset AS ({_stats('assigned', 'subset, regime', 'stddev_samp')}),
strategy AS (
  SELECT p.subset, p.regime, CASE WHEN n = 1 THEN 'global' ELSE 'regime-aware' END AS scaling_strategy, p.sensor, p.mean,
    CASE WHEN n = 1 THEN s.std ELSE p.std END AS std
  FROM by_regime p JOIN by_subset s USING (subset, regime, sensor) JOIN n_regimes USING (subset)
)
"""


def _scaled(stats, keys):
    joins = " ".join(
        f"LEFT JOIN (SELECT {keys}, mean AS m_{s}, std AS d_{s} FROM {stats} WHERE sensor = '{s}') USING ({keys})" for s in SENSORS
    )
    z = ", ".join(f"CASE WHEN d_{s} = 0 THEN 0.0e0 ELSE ({s} - m_{s}) / d_{s} END AS {s}" for s in SENSORS)
    return f"SELECT subset, unit_id, cycle, regime, {z} FROM assigned {joins}"


SCALED = f""",
scaled AS ({_scaled('strategy', 'subset, regime')})
"""

MEAN_LIFE = """,
life AS (SELECT subset, avg(last_cycle) AS life FROM lens GROUP BY subset),
predicted AS (
  SELECT subset, unit_id, cycle, RUL, greatest(0.0e0, life - cycle) AS prediction FROM complete JOIN life USING (subset)
)
"""


def errors_of(source, name="errs"):
    return f""",
{name} AS (
  SELECT *, prediction - RUL AS error,
    CASE WHEN prediction - RUL < 0 THEN exp(-(prediction - RUL) / 13.0e0) - 1 ELSE exp((prediction - RUL) / 10.0e0) - 1 END AS score_contribution
  FROM {source}
)
"""


def cutoffs(source, seeds="SELECT 42 AS seed", name="cuts"):
    return f""",
spans_{name} AS (
  SELECT subset, unit_id, greatest(min(cycle), CAST(ceil(max(cycle) * 0.5e0) AS INTEGER)) AS first_cycle,
    max(cycle) - greatest(min(cycle), CAST(ceil(max(cycle) * 0.5e0) AS INTEGER)) AS span
  FROM {source} GROUP BY subset, unit_id
),
{name} AS (
  SELECT subset, unit_id, seed, span,
    CASE WHEN span >= 1 THEN first_cycle + CAST(('0x' || substr(sha256(seed || ':' || unit_id), 1, 16))::UBIGINT % span::UBIGINT AS INTEGER) END AS cycle
  FROM spans_{name}, ({seeds})
)
"""


CANDIDATES = MEAN_LIFE + cutoffs("tele", "SELECT CAST(range AS INTEGER) AS seed FROM range(42, 52)") + """,
points AS (SELECT p.*, c.seed FROM predicted p JOIN cuts c USING (subset, unit_id, cycle)),
candidates AS (
  SELECT subset, unit_id, cycle, seed, RUL, 'mean_life' AS candidate, 'champion' AS role, prediction FROM points
  UNION ALL
  SELECT subset, unit_id, cycle, seed, RUL, 'capped_mean_life', 'competitor', least(prediction, 30.0e0) FROM points
)
"""

METRICS = ("rmse", "mae", "rul_score", "bias", "late_prediction_rate")
TAILS = ("worst_positive_error", "worst_negative_error", "largest_score_contribution", "top_3_score_contribution")


def metric_select(source, by):
    return f"""SELECT {by}, sqrt(avg(error * error)) AS rmse, avg(abs(error)) AS mae, sum(score_contribution) AS rul_score,
  avg(error) AS bias, avg(CASE WHEN error > 0 THEN 1 ELSE 0 END) AS late_prediction_rate FROM {source} GROUP BY {by}"""


def tail_select(source, by):
    return f"""SELECT {by}, greatest(0.0e0, max(error)) AS worst_positive_error, least(0.0e0, min(error)) AS worst_negative_error,
  max(score_contribution) AS largest_score_contribution,
  sum(score_contribution) FILTER (WHERE place <= 3) AS top_3_score_contribution
  FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY score_contribution DESC) AS place FROM {source}) GROUP BY {by}"""


SEED_BY = "subset, candidate, role, seed"
SEED_METRICS = CANDIDATES + errors_of("candidates") + f""",
by_seed AS (SELECT * FROM ({metric_select('errs', SEED_BY)}) JOIN ({tail_select('errs', SEED_BY)}) USING ({SEED_BY}))
"""

SUMMARY = """SELECT subset, candidate, role, avg(mae) AS mean_mae, median(mae) AS median_mae, avg(rmse) AS mean_rmse,
  median(rmse) AS median_rmse, avg(rul_score) AS mean_rul_score, median(rul_score) AS median_rul_score,
  max(rul_score) AS worst_seed_rul_score, max(worst_positive_error) AS worst_positive_error
  FROM by_seed GROUP BY subset, candidate, role"""
SUMMARY_COLUMNS = (
    "mean_mae", "median_mae", "mean_rmse", "median_rmse", "mean_rul_score", "median_rul_score",
    "worst_seed_rul_score", "worst_positive_error",
)
WINS = """SELECT a.subset, avg(CASE WHEN a.rul_score < b.rul_score THEN 1 ELSE 0 END) AS champion_win_rate
  FROM by_seed a JOIN by_seed b ON a.subset = b.subset AND a.seed = b.seed AND a.role = 'champion' AND b.role = 'competitor'
  GROUP BY a.subset"""

TRAFFIC = """
traffic AS (
  SELECT ts, 'FD00' || (1 + user_id % 4) AS subset,
    CASE user_id % 3 WHEN 0 THEN 'random_forest' WHEN 1 THEN 'gradient_boosted' ELSE 'sequence' END AS model_type,
    CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status, value / 100 AS latency_s, value AS predicted_rul
  FROM events
)
"""

W_START = "time_bucket(INTERVAL '6 hours', ts)"
W_END = f"{W_START} + INTERVAL '6 hours'"


def tumbling(columns, by):
    keys = f", {by}" if by else ""
    return f"SELECT {W_START} AS window_start, {W_END} AS window_end{keys}, {columns} FROM traffic GROUP BY ALL"


def sliding(columns, by):
    """Six-hour windows that start every two hours: every event lies in three."""
    keys = f", {by}" if by else ""
    start = "time_bucket(INTERVAL '2 hours', ts) - INTERVAL '2 hours' * i"
    return (
        f"SELECT {start} AS window_start, {start} + INTERVAL '6 hours' AS window_end{keys}, {columns} "
        "FROM traffic, (SELECT CAST(range AS INTEGER) AS i FROM range(3)) GROUP BY ALL"
    )


def histogram_quantile(by):
    """Cumulative bucket counts, then linear interpolation in the bucket of the quantile."""
    counts = ", ".join(f"count(*) FILTER (WHERE latency_s <= {b}e0) AS c{i}" for i, b in enumerate(LATENCY_BOUNDS))
    total = len(LATENCY_BOUNDS)
    cases = []
    for i, b in enumerate(LATENCY_BOUNDS):
        low, below = (f"{LATENCY_BOUNDS[i - 1]}e0", f"c{i - 1}") if i else ("0.0e0", "0")
        cases.append(f"WHEN c{i} >= 0.95e0 * c{total} THEN {low} + ({b}e0 - {low}) * (0.95e0 * c{total} - {below}) / (c{i} - {below})")
    keys = f", {by}" if by else ""
    grouped = tumbling(counts + f", count(*) AS c{total}", by)
    return f"SELECT window_start, window_end{keys}, CASE {' '.join(cases)} ELSE {LATENCY_BOUNDS[-1]}e0 END AS latency_p95_s FROM ({grouped})"


def held(source, breach, hold, step, by=""):
    part = f"PARTITION BY {by} " if by else ""
    return f"""SELECT * EXCLUDE (n_ok, n_all, first_start), (n_ok = {hold} AND n_all = {hold} AND window_start - first_start = {step} * {hold - 1}) AS firing FROM (
  SELECT *, sum(CASE WHEN breach THEN 1 ELSE 0 END) OVER f AS n_ok, count(*) OVER f AS n_all, first(window_start) OVER f AS first_start
  FROM (SELECT *, {breach} AS breach FROM ({source}))
  WINDOW f AS ({part}ORDER BY window_start ROWS BETWEEN {hold - 1} PRECEDING AND CURRENT ROW))"""


# Seeded 64-bit hash of an integer in unsigned 128-bit arithmetic.
# The five primes of the public xxHash64 definition.
PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
WRAP = "18446744073709551616::UHUGEINT"


def hash_step(source, value, seed, name):
    p1, p2, p3, _, p5 = (f"{p}::UHUGEINT" for p in PRIMES)
    return f""",
{name}_a AS (SELECT *, xor(({seed} + {p5} + 4) % {WRAP}, ({value}::UHUGEINT * {p1}) % {WRAP}) AS h0 FROM {source}),
{name}_b AS (SELECT * EXCLUDE (h0), ((((h0 << 23) % {WRAP}) | (h0 >> 41)) * {p2} % {WRAP} + {p3}) % {WRAP} AS h1 FROM {name}_a),
{name}_c AS (SELECT * EXCLUDE (h1), (xor(h1, h1 >> 33) * {p2}) % {WRAP} AS h2 FROM {name}_b),
{name}_d AS (SELECT * EXCLUDE (h2), (xor(h2, h2 >> 29) * {p3}) % {WRAP} AS h3 FROM {name}_c),
{name} AS (SELECT * EXCLUDE (h3), xor(h3, h3 >> 32) AS {name}_hash FROM {name}_d)"""


SPLIT = (
    hash_step("lens", "unit_id", "42::UHUGEINT", "hash_unit")
    + hash_step("hash_unit", "42", "hash_unit_hash", "hash_seed")
    + """,
scored AS (
  SELECT subset, unit_id, CASE WHEN hash_seed_hash >= 9223372036854775808::UHUGEINT THEN hash_seed_hash::HUGEINT - 18446744073709551616::HUGEINT
    ELSE hash_seed_hash::HUGEINT END AS score FROM hash_seed
),
split_units AS (
  SELECT subset, unit_id, row_number() OVER (PARTITION BY subset ORDER BY score, unit_id)
    <= greatest(1, least(count(*) OVER (PARTITION BY subset) - 1, floor(count(*) OVER (PARTITION BY subset) * 0.2e0 + 0.5e0))) AS is_validation
  FROM scored
)
"""
)


def define(name, body, *ctes):
    STATEMENTS[name] = f"WITH {''.join(ctes)} {body}" if ctes else body


def union(parts):
    return " UNION ALL ".join(parts)


# ---------------------------------------------------------------- ingest and quality

define("telemetry", f"SELECT subset, unit_id, cycle, {rs(MEASURED)} FROM tele", TELE)


def value_count(name):
    floating = name not in ("unit_id", "cycle")
    missing = f"{name} IS NULL" + (f" OR isnan({name})" if floating else "")
    infinite = f"count(*) FILTER (WHERE isinf({name}))" if floating else "0"
    return (
        f"SELECT subset, count(*) AS n_rows, '{name}' AS column_name, count(*) FILTER (WHERE {missing}) AS n_missing, "
        f"CAST({infinite} AS BIGINT) AS n_infinite FROM faulty GROUP BY subset"
    )


COUNTS = union(value_count(name) for name in ("unit_id", "cycle", *MEASURED))
define("quality_counts", COUNTS, TELE)
define(
    "quality_violations",
    f"""SELECT 'missing-value' AS "check", subset, column_name, n_missing AS n FROM ({COUNTS}) WHERE n_missing > 0
    UNION ALL SELECT 'finite-value', subset, column_name, n_infinite FROM ({COUNTS}) WHERE n_infinite > 0""",
    TELE,
)
PROFILE = "min({c}) AS first_cycle, max({c}) AS last_cycle, count({c}) AS n_rows, count(DISTINCT {c}) AS n_cycles"
define(
    "cycle_violations",
    f"""SELECT * FROM (SELECT l_orderkey AS unit_id, {PROFILE.format(c='l_linenumber')} FROM lineitem GROUP BY l_orderkey)
    WHERE NOT (first_cycle = 1 AND last_cycle = n_cycles AND n_rows = n_cycles)""",
)
define("cycle_profile", f"SELECT conv_id AS unit_id, {PROFILE.format(c='(turn + 1)')} FROM conversations GROUP BY conv_id")
define(
    "unit_mismatch",
    """SELECT coalesce(a.subset, b.subset) AS subset, coalesce(a.unit_id, b.unit_id) AS unit_id,
    CASE WHEN a.unit_id IS NULL THEN 'missing' ELSE 'extra' END AS side
    FROM (SELECT * FROM lens WHERE last_cycle >= 60) a FULL JOIN (SELECT * FROM terminal WHERE final_observed_rul < 36) b
    ON a.subset = b.subset AND a.unit_id = b.unit_id WHERE a.unit_id IS NULL OR b.unit_id IS NULL""",
    TELE,
)
SPOILT = """,
spoilt AS (
  SELECT subset, unit_id, CASE WHEN unit_id % 7 = 0 THEN -1 - final_observed_rul WHEN unit_id % 11 <> 0 THEN final_observed_rul END AS rul
  FROM terminal WHERE final_observed_rul < 36
)
"""
define(
    "terminal_violations",
    """SELECT * FROM (
      SELECT 'terminal-null' AS "check", subset, 'final_observed_rul' AS column_name, NULL::INTEGER AS unit_id, count(*) FILTER (rul IS NULL) AS n FROM spoilt GROUP BY subset
      UNION ALL SELECT 'terminal-negative', subset, 'final_observed_rul', NULL, count(*) FILTER (rul < 0) FROM spoilt GROUP BY subset
      UNION ALL SELECT 'terminal-numbering', subset, 'final_observed_rul', NULL,
        CASE WHEN min(unit_id) = 1 AND max(unit_id) = count(*) AND count(DISTINCT unit_id) = count(*) THEN 0 ELSE count(*) END FROM spoilt GROUP BY subset
      UNION ALL SELECT CASE WHEN a.unit_id IS NULL THEN 'unit-missing' ELSE 'unit-extra' END, coalesce(a.subset, b.subset), 'unit_id', coalesce(a.unit_id, b.unit_id), 1
        FROM (SELECT * FROM lens WHERE last_cycle >= 60) a FULL JOIN spoilt b ON a.subset = b.subset AND a.unit_id = b.unit_id
        WHERE a.unit_id IS NULL OR b.unit_id IS NULL
    ) WHERE n > 0""",
    TELE,
    SPOILT,
)
define(
    "mixed_requests",
    "SELECT subset || '-' || (unit_id // 8) AS request_id, 'more than one unit' AS reason FROM lens GROUP BY ALL HAVING count(*) > 1",
    TELE,
)
define(
    "state_violations",
    """SELECT subset, CASE subset WHEN 'FD001' THEN 'sensors out of order' WHEN 'FD002' THEN 'missing key' WHEN 'FD003' THEN 'duplicate sensor'
      ELSE 'retained and dropped' END AS reason FROM (SELECT DISTINCT subset FROM tele)""",
    TELE,
)
define("part_counts", "SELECT subset, count(*) AS n_rows, count(DISTINCT unit_id) AS n_units FROM tele GROUP BY subset", TELE)

# ---------------------------------------------------------------- labels and splits

define("rul_train", "SELECT subset, unit_id, cycle, RUL FROM complete", TELE)
define("rul_truncated", "SELECT subset, unit_id, cycle, RUL FROM trunc_labelled", TELE)
define(
    "rul_steps",
    "SELECT subset, unit_id, cycle, RUL, RUL - lag(RUL) OVER (PARTITION BY subset, unit_id ORDER BY cycle) AS rul_step FROM trunc_labelled",
    TELE,
)
define(
    "rul_step_check",
    """SELECT * FROM (SELECT subset, unit_id, cycle, RUL, CAST(RUL - lag(RUL) OVER (PARTITION BY subset, unit_id ORDER BY cycle) AS INTEGER) AS rul_step
    FROM (SELECT subset, unit_id, cycle, CAST(max(cycle) OVER (PARTITION BY subset, unit_id) - cycle AS INTEGER) AS RUL FROM gappy)) WHERE rul_step <> -1""",
    TELE,
)
define("terminal_rows", "SELECT subset, unit_id, max(cycle) AS cycle, arg_max(RUL, cycle) AS RUL FROM trunc_labelled GROUP BY subset, unit_id", TELE)
define(
    "terminal_check",
    """SELECT coalesce(a.subset, b.subset) AS subset, coalesce(a.unit_id, b.unit_id) AS unit_id, labelled_rul, final_observed_rul
    FROM (SELECT subset, unit_id, arg_max(RUL, cycle) AS labelled_rul FROM trunc_labelled GROUP BY subset, unit_id) a
    FULL JOIN (SELECT subset, unit_id, final_observed_rul + CASE WHEN final_observed_rul > 35 THEN 1 ELSE 0 END AS final_observed_rul
               FROM terminal WHERE final_observed_rul > 28) b
    ON a.subset = b.subset AND a.unit_id = b.unit_id WHERE labelled_rul IS DISTINCT FROM final_observed_rul""",
    TELE,
)
ROWS = "SELECT subset, unit_id, cycle FROM tele JOIN split_units USING (subset, unit_id) WHERE"
define("split_train", f"{ROWS} NOT is_validation", TELE, SPLIT)
define("split_validation", f"{ROWS} is_validation", TELE, SPLIT)
define("split_lost_rows", f"SELECT *, 'lost' AS side FROM ({ROWS} is_validation)", TELE, SPLIT)
define("split_parts_lost", f"SELECT *, 'lost' AS side FROM ({ROWS} is_validation IS NULL)", TELE, SPLIT)
define("split_parts_shared", "SELECT subset, unit_id FROM split_units GROUP BY subset, unit_id HAVING count(DISTINCT is_validation) > 1", TELE, SPLIT)
define(
    "split_shared_units",
    "SELECT subset, unit_id FROM tele WHERE cycle <= 60 INTERSECT SELECT subset, unit_id FROM tele WHERE cycle > 60",
    TELE,
)

# ---------------------------------------------------------------- learned state

define("regime_map", "SELECT * FROM mapping", TELE, REGIMES)
define("regime_assign", "SELECT subset, unit_id, cycle, regime FROM assigned", TELE, REGIMES)
define(
    "regime_unseen",
    """SELECT DISTINCT subset, key_setting_1, key_setting_2, key_setting_3 FROM keyed
    EXCEPT SELECT subset, key_setting_1, key_setting_2, key_setting_3 FROM keyed WHERE setting_1 < 15""",
    TELE,
    REGIMES,
)


def joined(names, wanted):
    cases = ", ".join(f"CASE WHEN (min({n}) = max({n})) = {wanted} THEN '{n}' END" for n in names)
    return f"concat_ws(',', {cases})"


define(
    "constant_columns",
    f"""SELECT subset, {joined(MEASURED, 'true')} AS dropped_feature_columns,
    {joined([n for n in MEASURED if n.startswith('sensor')], 'false')} AS retained_sensor_columns FROM tele GROUP BY subset""",
    TELE,
)
define("scaler_global", f"SELECT subset, sensor, {rs(['mean', 'std'])} FROM ({_stats('tele', 'subset', 'stddev_samp')})", TELE)
define("scaler_regime", f"SELECT subset, regime, sensor, {rs(['mean', 'std'])} FROM by_regime", TELE, REGIMES, STATS)
define("scaler_strategy", f"SELECT subset, regime, scaling_strategy, sensor, {rs(['mean', 'std'])} FROM strategy", TELE, REGIMES, STATS)
define(
    "scaled_global",
    f"SELECT subset, unit_id, cycle, {rs(SENSORS)} FROM ({_scaled('whole', 'subset')})",
    TELE,
    REGIMES,
    f", whole AS ({_stats('tele', 'subset', 'stddev_samp')})",
)
# All statistics in one row per regime, joined once.
SPREADS = ", ".join(
    f"avg({s}) AS m_{s}, CASE WHEN min({s}) = max({s}) THEN 0.0e0 WHEN any_value(n) = 1 THEN stddev_samp({s}) ELSE stddev_pop({s}) END AS d_{s}" for s in SENSORS
)
WIDE_SCALED = f""",
wide AS MATERIALIZED (SELECT subset, regime, {SPREADS} FROM assigned JOIN n_regimes USING (subset) GROUP BY subset, regime),
scaled AS (
  SELECT subset, unit_id, cycle, regime, {', '.join(f'CASE WHEN d_{s} = 0 THEN 0.0e0 ELSE ({s} - m_{s}) / d_{s} END AS {s}' for s in SENSORS)}
  FROM assigned JOIN wide USING (subset, regime)
)
"""
define("scaled_regime", f"SELECT subset, unit_id, cycle, regime, {rs(SENSORS)} FROM scaled", TELE, REGIMES, WIDE_SCALED)
define(
    "scaled_moments",
    "SELECT * REPLACE (round(mean + 1e-10, 6) AS mean, round(std + 1e-10, 6) AS std) FROM ("
    + union(f"SELECT subset, regime, '{s}' AS sensor, avg({s}) AS mean, stddev_pop({s}) AS std FROM scaled GROUP BY subset, regime" for s in SENSORS)
    + ")",
    TELE,
    REGIMES,
    STATS,
    SCALED,
)

# ---------------------------------------------------------------- temporal features

UNIT_ORDER = "PARTITION BY subset, unit_id ORDER BY cycle"


def lags(s):
    return [f"lag({s}, {k}) OVER w AS {s}_lag_{k}" for k in (1, 5)]


def differences(s):
    return [f"{r(f'{s} - lag({s}, {k}) OVER w')} AS {s}_diff_{k}" for k in (1, 5)]


def statistics(s, windows=(5, 10, 20)):
    return [
        f"{r(f'{f}({s}) OVER w{k}')} AS {s}_rolling_{label}_{k}"
        for k in windows
        for label, f in (("mean", "avg"), ("std", "stddev_samp"))
    ]


def slopes(s, windows=(5, 10, 20)):
    return [
        f"CASE WHEN count(*) OVER w{k} > 1 THEN {r(f'regr_slope({s}, cycle) OVER w{k}')} END AS {s}_rolling_slope_{k}" for k in windows
    ]


def smoothed(s):
    return [f"{r(f'list_reduce(list({s}) OVER w, lambda a, b: 0.2e0 * b + 0.8e0 * a)')} AS {s}_ewma"]


FRAMES = f"WINDOW w AS ({UNIT_ORDER}), " + ", ".join(
    f"w{k} AS ({UNIT_ORDER} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)" for k in (5, 10, 20, 60, 500)
)


def features(sensors, families, source="tele", base=True):
    shown = [f"{r(s)} AS {s}" for s in sensors] if base else []
    made = [expression for s in sensors for family in families for expression in family(s)]
    return f"SELECT subset, unit_id, cycle, {', '.join(shown + made)} FROM {source} {FRAMES}"


PAIR = ("sensor_2", "sensor_3")
define("lag_diff", features(PAIR, (lags, differences)), TELE)
define("rolling_stats", features(PAIR, (statistics,)), TELE)
define("rolling_slope", features(PAIR, (slopes,), base=False), TELE)
define("rolling_slope_gappy", features(("sensor_2",), (lambda s: slopes(s, (5, 10)),), "gappy", False), TELE)
define("ewma", features(PAIR, (smoothed,)), TELE)


def slopes_of_readings(s, windows=(5, 10)):
    return [f"CASE WHEN count({s}) OVER w{k} > 1 THEN {r(f'regr_slope({s}, cycle) OVER w{k}')} END AS {s}_rolling_slope_{k}" for k in windows]


def smoothed_readings(s):
    kept = f"list({s}) FILTER ({s} IS NOT NULL) OVER w"
    return [f"CASE WHEN count({s}) OVER w > 0 THEN {r(f'list_reduce({kept}, lambda a, b: 0.2e0 * b + 0.8e0 * a)')} END AS {s}_ewma"]


define(
    "features_with_nulls",
    features(("sensor_3",), (lambda s: [f"{r(f'lag({s}, {k}) OVER w')} AS {s}_lag_{k}" for k in (1, 5)], differences, lambda s: statistics(s, (5, 10)), slopes_of_readings, smoothed_readings), "nulled"),
    TELE,
    ", nulled AS (SELECT * REPLACE (CASE WHEN sensor_3 >= 30 THEN sensor_3 END AS sensor_3) FROM tele)",
)


WIDE = (60, 500)
define("rolling_wide", features(PAIR, (lambda s: statistics(s, WIDE), lambda s: slopes(s, WIDE))), TELE)
define(
    "rolling_wide_with_nulls",
    features(PAIR, (lambda s: statistics(s, WIDE), lambda s: slopes_of_readings(s, WIDE)), "sparse"),
    TELE,
    ", sparse AS (SELECT * REPLACE (CASE WHEN sensor_3 >= 90 THEN sensor_3 END AS sensor_3) FROM gappy)",
)
define(
    "ewma_sparse",
    features(("sensor_3",), (lambda s: [x.replace("0.2e0", "0.001e0").replace("0.8e0", "0.999e0") for x in smoothed_readings(s)],), "sparse"),
    TELE,
    ", sparse AS (SELECT * REPLACE (CASE WHEN sensor_3 >= 110 THEN sensor_3 END AS sensor_3) FROM tele)",
)


def rounded_lags(s):
    return [f"{r(f'lag({s}, {k}) OVER w')} AS {s}_lag_{k}" for k in (1, 5)]


define(
    "temporal_features",
    features(("sensor_2", "sensor_5"), (rounded_lags, differences, statistics, slopes, smoothed), "scaled"),
    TELE,
    REGIMES,
    STATS,
    SCALED,
)
define(
    "feature_parity",
    f"""SELECT subset, unit_id, cycle, 'sensor_5' AS feature, {r('sensor_5')} AS a, {r('sensor_2')} AS b FROM tele
    WHERE abs(sensor_5 - sensor_2) > 1e-12 + 1e-10 * abs(sensor_2)""",
    TELE,
)

# ---------------------------------------------------------------- model inputs

define(
    "model_ready",
    f"""SELECT subset, unit_id, cycle, RUL, regime AS operating_regime, {', '.join(f'{r("z." + s)} AS {s}' for s in SENSORS)}
    FROM scaled z JOIN (SELECT subset, unit_id, cycle, RUL FROM complete) USING (subset, unit_id, cycle)""",
    TELE,
    REGIMES,
    STATS,
    SCALED,
)
define("model_inputs", f"SELECT {rs(['sensor_4', 'sensor_2', 'sensor_3'])}, RUL FROM complete", TELE)
define("capped_target", "SELECT subset, unit_id, cycle, least(RUL, 50) AS RUL FROM complete", TELE)
define(
    "dense_features",
    "SELECT subset, unit_id, cycle, CASE WHEN sensor_3 IS NULL OR isnan(sensor_3) THEN 0e0 ELSE sensor_3 END AS sensor_3 FROM faulty",
    TELE,
)


def steps(source, ends, length, target, full):
    """Rows of each window as steps, numbered from 0."""
    keep = f"WHERE n_steps = {length}" if full else ""
    return f"""SELECT * EXCLUDE (n_steps) FROM (
  SELECT e.subset, e.unit_id, e.end_cycle AS cycle{target}, CAST(row_number() OVER s - 1 AS INTEGER) AS step, {r('t.sensor_2')} AS sensor_2, {r('t.sensor_3')} AS sensor_3,
    count(*) OVER (PARTITION BY e.subset, e.unit_id, e.end_cycle) AS n_steps
  FROM {ends} e JOIN {source} t ON t.subset = e.subset AND t.unit_id = e.unit_id AND t.pos <= e.end_pos AND t.pos > e.end_pos - {length}
  WINDOW s AS (PARTITION BY e.subset, e.unit_id, e.end_cycle ORDER BY t.cycle)) {keep}"""


POSITIONED = f", placed AS (SELECT *, row_number() OVER ({UNIT_ORDER}) AS pos FROM {{source}})"
define(
    "sequences_full",
    steps("placed", "ends", 30, ", e.target", True),
    TELE,
    POSITIONED.format(source="complete"),
    ", ends AS (SELECT subset, unit_id, cycle AS end_cycle, pos AS end_pos, RUL AS target FROM placed)",
)
define(
    "sequences_endpoint",
    steps("placed", "ends", 30, "", False),
    TELE,
    cutoffs("tele"),
    POSITIONED.format(source="tele"),
    ", ends AS (SELECT subset, unit_id, cycle AS end_cycle, cycle AS end_pos FROM cuts WHERE cycle IS NOT NULL)",
)
define(
    "sequences_endpoint_gappy",
    steps("placed", "ends", 10, "", False),
    TELE,
    POSITIONED.format(source="gappy"),
    """, ends AS (SELECT l.subset, l.unit_id, CAST(floor(last_cycle * 0.7e0) AS INTEGER) AS end_cycle, max(pos) AS end_pos
    FROM lens l JOIN placed p ON p.subset = l.subset AND p.unit_id = l.unit_id AND p.cycle <= floor(last_cycle * 0.7e0) GROUP BY ALL)""",
)
ENDPOINTS = "SELECT c.subset, c.unit_id, c.cycle, c.RUL, k.seed FROM complete c JOIN cuts k USING (subset, unit_id, cycle)"
define("pseudo_endpoints", ENDPOINTS, TELE, cutoffs("tele"))
define("pseudo_endpoints_by_seed", ENDPOINTS, TELE, cutoffs("tele", "SELECT CAST(range AS INTEGER) AS seed FROM range(42, 52)"))
define(
    "endpoint_violations",
    """SELECT subset, unit_id, seed, CASE WHEN span < 1 THEN 'needs two observed cycles' ELSE 'no unique cutoff row' END AS reason
    FROM (SELECT k.subset, k.unit_id, k.seed, max(span) AS span, count(g.cycle) AS n FROM cuts k LEFT JOIN gappy g USING (subset, unit_id, cycle) GROUP BY ALL)
    WHERE span < 1 OR n <> 1""",
    TELE,
    cutoffs("gappy"),
)
define(
    "official_endpoints",
    f"""SELECT subset, unit_id, cycle, {rs(['sensor_2', 'sensor_4'])}, final_observed_rul AS RUL
    FROM trunc_rows t JOIN terminal USING (subset, unit_id) JOIN lens USING (subset, unit_id) WHERE cycle = floor(last_cycle / 2.0e0)""",
    TELE,
)
define("last_observation", f"SELECT subset, unit_id, cycle, {rs(SENSORS)} FROM complete WHERE RUL = 0", TELE)
define(
    "last_n_window",
    f"SELECT subset, unit_id, last_cycle AS end_cycle, cycle, {r('sensor_2')} AS sensor_2 FROM tele JOIN lens USING (subset, unit_id) WHERE cycle > last_cycle - 30",
    TELE,
)

# ---------------------------------------------------------------- evaluation

PREDICTED = TELE + MEAN_LIFE + errors_of("predicted")
define("metrics", f"SELECT subset, {rs(METRICS)} FROM ({metric_select('errs', 'subset')})", PREDICTED)
define("tail_metrics", f"SELECT subset, {rs(TAILS)} FROM ({tail_select('errs', 'subset')})", PREDICTED)
CHAMPION = "SELECT * FROM errs WHERE seed = 42 AND role = 'champion'"
REPORT = f"SELECT subset, unit_id, cycle AS cutoff_cycle, RUL AS true_RUL, {rs(['prediction', 'error', 'score_contribution'])} FROM ({CHAMPION})"
define("diagnostics", REPORT, TELE, SEED_METRICS)
define("worst_predictions", f"{REPORT} ORDER BY errs_order DESC, subset, unit_id, cutoff_cycle LIMIT 3".replace(f"({CHAMPION})", f"(SELECT *, score_contribution AS errs_order FROM ({CHAMPION}))"), TELE, SEED_METRICS)
define("metrics_by_seed", f"SELECT {SEED_BY}, {rs(METRICS + TAILS)} FROM by_seed", TELE, SEED_METRICS)
define("robustness", f"SELECT subset, candidate, role, {rs(SUMMARY_COLUMNS)} FROM ({SUMMARY})", TELE, SEED_METRICS)
define("win_rate", f"SELECT subset, {rs(['champion_win_rate'])} FROM ({WINS})", TELE, SEED_METRICS)
define(
    "robustness_report",
    f"SELECT subset, candidate, role, {rs(SUMMARY_COLUMNS, 3)}, {rs(['champion_win_rate'], 3)} FROM ({SUMMARY}) LEFT JOIN ({WINS}) USING (subset)",
    TELE,
    SEED_METRICS,
)
COMPARED = ("mae", "rmse", "rul_score", "bias", "late_prediction_rate") + TAILS
define(
    "comparison",
    f"SELECT subset, candidate AS model, 'baseline' AS feature_set, {', '.join(f'{r(m, 3)} AS test_{m}' for m in COMPARED)} FROM by_seed WHERE seed = 42",
    TELE,
    SEED_METRICS,
)

# ---------------------------------------------------------------- sampling

define(
    "request_quotas",
    """SELECT subset, CAST(floor(50 / n) + CASE WHEN place < 50 % n THEN 1 ELSE 0 END AS INTEGER) AS quota
    FROM (SELECT subset, row_number() OVER (ORDER BY subset) - 1 AS place, count(*) OVER () AS n FROM (SELECT DISTINCT subset FROM tele))""",
    TELE,
)

# ---------------------------------------------------------------- prediction traffic

PER_SECOND = f"CAST(count(*) AS BIGINT) AS requests, {r('count(*) / 21600.0e0')} AS per_second"
define("request_rate", tumbling(PER_SECOND, "status"), TRAFFIC)
define("request_rate_sliding", sliding(PER_SECOND, "status"), TRAFFIC)
define("request_totals", "SELECT status, count(*) AS requests FROM traffic GROUP BY status", TRAFFIC)
define(
    "request_outcomes",
    """SELECT subset, model_type, count(*) AS requested, count(*) FILTER (WHERE status = 'success') AS successful,
    count(*) FILTER (WHERE status = 'error') AS failed FROM traffic GROUP BY subset, model_type""",
    TRAFFIC,
)
GROUPED = "subset, model_type"
define("latency_p95", f"SELECT * REPLACE ({r('latency_p95_s')} AS latency_p95_s) FROM ({histogram_quantile(GROUPED)})", TRAFFIC)
define("latency_p95_sketch", tumbling(f"{r('quantile_disc(latency_s, 0.95)')} AS latency_p95_s", GROUPED), TRAFFIC)
define("latency_mean", tumbling(f"{r('avg(latency_s)')} AS mean_latency_s", GROUPED), TRAFFIC)
ERROR_PERCENT = "100.0e0 * count(*) FILTER (WHERE status = 'error') / count(*)"
define("error_rate", tumbling(f"count(*) AS requests, {r(ERROR_PERCENT)} AS error_percent", ""), TRAFFIC)
define(
    "latest_value",
    f"""SELECT subset, model_type, ts, {rs(['predicted_rul'])} FROM (SELECT *, row_number() OVER (PARTITION BY subset, model_type ORDER BY ts DESC, predicted_rul DESC) AS place
    FROM traffic WHERE status = 'success') WHERE place = 1""",
    TRAFFIC,
)
define(
    "alerts",
    "SELECT * REPLACE (round(error_percent + 1e-10, 6) AS error_percent) FROM ("
    + held(sliding(f"count(*) AS requests, {ERROR_PERCENT} AS error_percent", ""), "error_percent > 100 * 0.19e0", 4, "INTERVAL '2 hours'")
    + ")",
    TRAFFIC,
)
define(
    "latency_alerts",
    "SELECT * REPLACE (round(latency_p95_s + 1e-10, 6) AS latency_p95_s) FROM ("
    + held(histogram_quantile("subset"), "latency_p95_s > 0.74e0", 2, "INTERVAL '6 hours'", "subset")
    + ")",
    TRAFFIC,
)
define(
    "silences",
    """SELECT * FROM (SELECT subset, model_type, ts AS silent_from, lead(ts) OVER (PARTITION BY subset, model_type ORDER BY ts) AS silent_until FROM traffic)
    WHERE silent_until - silent_from > INTERVAL '20 minutes'""",
    TRAFFIC,
)


def islands(windows, condition, step):
    """Runs of breaching windows, ``step`` apart, per subset."""
    return f""",
breaches AS (SELECT subset, window_end, window_end - INTERVAL '{step}' * row_number() OVER (PARTITION BY subset ORDER BY window_end) AS island FROM ({windows}) WHERE {condition}),
islands AS (SELECT subset, min(window_end) AS opened, max(window_end) + INTERVAL '{step}' AS closed, count(*) AS n FROM breaches GROUP BY subset, island)
"""


def changes_of(hold, step):
    return f"""SELECT subset, 'pending' AS state, opened AS at FROM islands
    UNION ALL SELECT subset, 'firing', opened + INTERVAL '{step}' * {hold - 1} FROM islands WHERE n >= {hold}
    UNION ALL SELECT subset, CASE WHEN n >= {hold} THEN 'resolved' ELSE 'inactive' END, closed FROM islands"""


def log_histogram(start, end, by):
    """Quantiles at floor(q * (n - 1)) from logarithmic buckets of 1% accuracy."""
    keys = ", ".join(("window_start", "window_end", *by))
    named = "".join(f", {name}" for name in by)
    ratio = "(1.01e0 / 0.99e0)"
    value = f"CASE WHEN bucket = -692 THEN 0e0 ELSE 2 / ({ratio} + 1) * pow({ratio}, bucket) END"
    picked = ", ".join(f"{r(f'min({value}) FILTER (WHERE seen > floor({q}e0 * (requests - 1)))')} AS latency_p{p}_s" for q, p in ((0.5, 50), (0.95, 95), (0.99, 99)))
    return f"""SELECT {keys}, requests, {picked} FROM (
      SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY bucket) AS seen, CAST(sum(n) OVER (PARTITION BY {keys}) AS BIGINT) AS requests FROM (
        SELECT {start} AS window_start, {end} AS window_end{named}, count(*) AS n,
          CASE WHEN latency_s <= 1e-6 THEN -692 ELSE CAST(ceil(ln(least(latency_s, 1e6)) / ln({ratio})) AS INTEGER) END AS bucket
        FROM traffic WHERE latency_s IS NOT NULL AND NOT isnan(latency_s) GROUP BY ALL))
    GROUP BY {keys}, requests"""


HALF_HOUR = "time_bucket(INTERVAL '30 minutes', ts)"
SKETCHED = log_histogram(W_START, W_END, ("subset",))
define("latency_sketches_stored", log_histogram(HALF_HOUR, f"{HALF_HOUR} + INTERVAL '30 minutes'", ("subset", "model_type")), TRAFFIC)
define("latency_sketches_merged", SKETCHED, TRAFFIC)
define("stream_latency_sketches", SKETCHED, TRAFFIC)
FIRST, LAST = (f"(SELECT {f}({HALF_HOUR}) FROM traffic)" for f in ("min", "max"))
define("latency_sketches_total", log_histogram(FIRST, f"{LAST} + INTERVAL '30 minutes'", ()), TRAFFIC)

ERROR_ISLANDS = islands(sliding(f"{ERROR_PERCENT} AS error_percent", "subset"), "error_percent > 100 * 0.19e0", "2 hours")
LATENCY_ISLANDS = islands(histogram_quantile("subset"), "latency_p95_s > 0.74e0", "6 hours")
SILENCE_CHANGES = """WITH sources AS (
      SELECT DISTINCT subset, unnest([model_type, 'standby']) AS model_type, since
      FROM traffic JOIN (SELECT subset, min(ts) + INTERVAL '6 hours' AS since FROM traffic GROUP BY subset) USING (subset)),
    moments AS (
      SELECT subset, model_type, ts, true AS came FROM traffic
      UNION ALL SELECT subset, model_type, since, false FROM sources),
    gaps AS (
      SELECT subset, model_type, lead(ts) OVER (PARTITION BY subset, model_type ORDER BY ts, came) AS next_ts,
        max(ts) FILTER (WHERE came) OVER (PARTITION BY subset, model_type ORDER BY ts, came ROWS UNBOUNDED PRECEDING) AS last_seen,
        greatest(ts, max(ts) FILTER (WHERE NOT came) OVER (PARTITION BY subset, model_type)) + INTERVAL '20 minutes' AS due FROM moments),
    silent AS (SELECT * FROM gaps WHERE next_ts IS NULL OR next_ts > due)
    SELECT subset, model_type, 'silent' AS state, due AS at, last_seen FROM silent
    UNION ALL SELECT subset, model_type, 'back', next_ts, last_seen FROM silent WHERE next_ts IS NOT NULL"""
for prefix in ("", "stream_"):
    define(f"{prefix}alert_changes", changes_of(4, "2 hours"), TRAFFIC, ERROR_ISLANDS)
    define(f"{prefix}latency_alert_changes", changes_of(2, "6 hours"), TRAFFIC, LATENCY_ISLANDS)
    define(f"{prefix}silence_changes", f"SELECT * FROM ({SILENCE_CHANGES})", TRAFFIC)


# ---------------------------------------------------------------- text, requests, state, runs

READABLE = "sensor_2 <= 60 AND sensor_3 >= 10"
define("text_rows", f"SELECT subset, unit_id, cycle, {rs(SENSORS)} FROM tele WHERE {READABLE}", TELE)
define(
    "text_rejects",
    """SELECT subset, tokens, count(*) AS n_lines FROM (SELECT subset, CASE WHEN sensor_2 > 60 THEN 10 ELSE 26 END AS tokens
    FROM tele WHERE sensor_2 > 60 OR sensor_3 < 10) GROUP BY subset, tokens""",
    TELE,
)
define(
    "request_rows",
    f"""SELECT subset || '-' || unit_id AS request_id, subset, unit_id, cycle, {rs(PAIR)} FROM tele JOIN lens USING (subset, unit_id)
    WHERE cycle > last_cycle - 30 AND last_cycle BETWEEN 55 AND 80""",
    TELE,
)
define(
    "request_rejects",
    """SELECT subset || '-' || unit_id AS request_id, CASE WHEN last_cycle > 80 THEN 'unsupported subset' ELSE 'incomplete observation' END AS reason
    FROM lens WHERE last_cycle > 80 OR last_cycle < 55""",
    TELE,
)
define("state_round_trip", f"SELECT subset, regime, scaling_strategy, sensor, {rs(['mean', 'std'])} FROM strategy", TELE, REGIMES, STATS)
define(
    "state_applied",
    f"SELECT subset, unit_id, cycle, regime, {rs(SENSORS)} FROM scaled JOIN (SELECT subset, unit_id, cycle FROM trunc_rows) USING (subset, unit_id, cycle)",
    TELE,
    REGIMES,
    WIDE_SCALED,
)
RUNS = """
runs AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, event_id, ts AS start_time, 'FD00' || (1 + user_id % 4) AS subset,
    CASE WHEN event_type = 'signup' THEN 'preprocessing' ELSE 'training' END AS kind,
    CASE WHEN event_type <> 'signup' THEN 'model_' || (user_id % 3) END AS model_type,
    CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'FINISHED' END AS status,
    CAST(event_id - 1 AS VARCHAR) AS wanted, CASE WHEN user_id % 5 < 3 THEN 'baseline' ELSE 'temporal' END AS feature_set FROM events
)
"""
define(
    "latest_run",
    """SELECT subset, model_type, run_id, start_time FROM (SELECT *, row_number() OVER (PARTITION BY subset, model_type ORDER BY start_time DESC, run_id DESC) AS place
    FROM runs WHERE kind = 'training' AND status = 'FINISHED') WHERE place = 1""",
    RUNS,
)
define(
    "run_chain",
    """SELECT t.run_id AS training_run_id, t.subset, t.model_type, p.run_id AS preprocessing_run_id
    FROM (SELECT * FROM runs WHERE kind = 'training') t LEFT JOIN (SELECT * FROM runs WHERE kind = 'preprocessing') p ON t.wanted = p.run_id AND t.subset = p.subset""",
    RUNS,
)
define(
    "run_names",
    """SELECT run_id, CASE WHEN kind = 'training' THEN subset || '-' || model_type || '-' || feature_set || '-raw_rul' ELSE subset || '-' || kind END AS run_name FROM runs""",
    RUNS,
)
define(
    "run_list",
    """SELECT run_id, subset, feature_set, 'existing' AS source, NULL AS status FROM runs WHERE status = 'FINISHED' AND feature_set = 'baseline'
    UNION ALL SELECT run_id, subset, feature_set, 'created', status FROM runs WHERE feature_set = 'temporal'""",
    RUNS,
)
define(
    "missing_runs",
    """SELECT subset, feature_set FROM (SELECT DISTINCT subset FROM runs), (VALUES ('baseline'), ('temporal')) f(feature_set)
    EXCEPT SELECT subset, arg_max(feature_set, event_id) FROM runs GROUP BY subset""",
    RUNS,
)

# ---------------------------------------------------------------- preprocessing and scoring

PARTS = """,
parted AS (
  SELECT c.*, CASE WHEN is_validation THEN 'validation' ELSE 'train' END AS split FROM complete c JOIN split_units USING (subset, unit_id)
  UNION ALL SELECT *, 'test' FROM trunc_labelled
),
train AS (SELECT * FROM parted WHERE split = 'train')
"""
TRAINED_REGIMES = """,
keyed AS (SELECT *, round_even(setting_1, 0) AS k1, round_even(setting_2, 2) AS k2, round_even(setting_3, 0) AS k3 FROM parted),
mapping AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY subset ORDER BY k1, k2, k3) AS INTEGER) AS regime
  FROM (SELECT DISTINCT subset, k1, k2, k3 FROM keyed WHERE split = 'train')
),
placed AS (SELECT k.*, m.regime FROM keyed k LEFT JOIN mapping m USING (subset, k1, k2, k3)),
assigned AS (SELECT * FROM placed WHERE split = 'train'),
n_regimes AS (SELECT subset, count(*) AS n FROM mapping GROUP BY subset)
"""


def prepared(columns):
    joins = " ".join(
        f"LEFT JOIN (SELECT subset, regime, mean AS m_{s}, std AS d_{s} FROM strategy WHERE sensor = '{s}') USING (subset, regime)" for s in SENSORS
    )
    z = ", ".join(f"{r(f'CASE WHEN d_{s} = 0 THEN 0.0e0 ELSE ({s} - m_{s}) / d_{s} END')} AS {s}" for s in SENSORS)
    return f"SELECT {columns}, {z} FROM placed {joins}"


define(
    "preprocessing_summary",
    """SELECT subset, split, count(*) AS n_rows, count(DISTINCT unit_id) AS n_units, any_value(n) AS n_regimes,
    CASE WHEN any_value(n) = 1 THEN 'global' ELSE 'regime-aware' END AS scaling_strategy, 4 AS n_features
    FROM placed JOIN n_regimes USING (subset) GROUP BY subset, split""",
    TELE,
    SPLIT,
    PARTS,
    TRAINED_REGIMES,
)
# Units numbered without gaps, as lines of a file are.
RENUMBERED = TELE.replace(
    "CAST(user_id + 1 AS INTEGER) AS unit_id", "CAST(dense_rank() OVER (PARTITION BY user_id % 4 ORDER BY user_id) AS INTEGER) AS unit_id"
)
define("text_to_tables", STATEMENTS["preprocessing_summary"].replace(TELE, RENUMBERED))
define(
    "preprocessed_rows",
    prepared("subset, split, unit_id, cycle, RUL, regime AS operating_regime"),
    TELE,
    SPLIT,
    PARTS,
    TRAINED_REGIMES,
    STATS,
)
define(
    "sequence_scores",
    """SELECT subset, unit_id, end_cycle AS cycle, round(avg((sensor_2 + sensor_3) / 2) + 5e-5, 3) AS prediction
    FROM tele JOIN (SELECT subset, unit_id, last_cycle AS end_cycle FROM lens) USING (subset, unit_id)
    WHERE cycle <= end_cycle AND cycle > end_cycle - 30 GROUP BY subset, unit_id, end_cycle""",
    TELE,
)
define(
    "scaled_by_model",
    "SELECT subset, unit_id, cycle, "
    + ", ".join(f"{r(f'({s} - avg({s}) OVER ()) / stddev_samp({s}) OVER ()')} AS {s}" for s in SENSORS)
    + " FROM tele",
    TELE,
)

# ---------------------------------------------------------------- properties of scores

define(
    "rf_checks",
    """SELECT subset, count(*) AS n_endpoints, 1 AS all_in_range FROM cuts JOIN split_units USING (subset, unit_id)
    WHERE is_validation AND cycle IS NOT NULL GROUP BY subset""",
    TELE,
    SPLIT,
    cutoffs("tele"),
)
define(
    "boosted_checks",
    """SELECT subset, count(*) AS n_endpoints, 1 AS learned, 1 AS same_when_loaded FROM cuts JOIN split_units USING (subset, unit_id)
    WHERE is_validation AND cycle IS NOT NULL GROUP BY subset""",
    TELE,
    SPLIT,
    cutoffs("tele"),
)
define("official_checks", "SELECT subset, count(*) AS n_endpoints, 1 AS all_in_range FROM lens WHERE last_cycle >= 2 GROUP BY subset", TELE)
define(
    "fleet_score_checks",
    "SELECT subset, unit_id, CAST(floor(last_cycle / 2.0e0) AS INTEGER) AS cycle, 1 AS scored FROM lens WHERE last_cycle >= 2",
    TELE,
)

# ---------------------------------------------------------------- streams

define("stream_request_totals", "SELECT status, count(*) AS requests FROM traffic GROUP BY status", TRAFFIC)


define("stream_request_rate", f"SELECT * FROM ({tumbling(PER_SECOND, 'status')})", TRAFFIC)
define(
    "stream_latency_p95",
    f"SELECT * REPLACE ({r('latency_p95_s')} AS latency_p95_s) FROM ({histogram_quantile(GROUPED)})",
    TRAFFIC,
)
define(
    "stream_error_alerts",
    "SELECT window_end - INTERVAL '6 hours' AS span_start, window_end AS span_end FROM ("
    + held(sliding(f"{ERROR_PERCENT} AS error_percent", ""), "error_percent > 100 * 0.19e0", 3, "INTERVAL '2 hours'")
    + ") WHERE firing",
    TRAFFIC,
)
define(
    "stream_silences",
    """SELECT subset, model_type, max(ts) AS silent_from, count(*) AS requests FROM (
      SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY subset, model_type ORDER BY ts) AS session FROM (
        SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY subset, model_type ORDER BY ts) >= INTERVAL '20 minutes', true) AS fresh FROM traffic))
    GROUP BY subset, model_type, session""",
    TRAFFIC,
)

for streamed in ("stream_features", "stream_corrected_features"):
    define(
        streamed,
        "SELECT *, 'ok' AS status, 0 AS missing_before FROM (" + features(PAIR, (lags, differences, statistics, slopes, smoothed)) + ")",
        TELE,
    )

# ---------------------------------------------------------------- sampled requests

SIGNED = "CASE WHEN {h} >= 9223372036854775808::UHUGEINT THEN {h}::HUGEINT - 18446744073709551616::HUGEINT ELSE {h}::HUGEINT END"
SAMPLE = (
    ", eligible AS (SELECT subset, unit_id, cycle, sensor_2 FROM tele WHERE cycle >= 30)"
    + hash_step("eligible", "unit_id", "42::UHUGEINT", "e1")
    + hash_step("e1", "cycle", "e1_hash", "e2")
    + hash_step("e2", "42", "e2_hash", "e3")
    + f""",
picked AS (
  SELECT subset, unit_id, cycle, sensor_2 FROM (
    SELECT *, row_number() OVER (PARTITION BY subset, unit_id ORDER BY {SIGNED.format(h='e3_hash')}, cycle) AS place FROM e3) WHERE place = 1
)"""
    + hash_step("picked", "unit_id", "42::UHUGEINT", "p1")
    + hash_step("p1", "1042", "p1_hash", "p2")
    + f""",
shares AS (
  SELECT subset, floor(50 / n) + CASE WHEN place < 50 % n THEN 1 ELSE 0 END AS quota
  FROM (SELECT subset, row_number() OVER (ORDER BY subset) - 1 AS place, count(*) OVER () AS n FROM (SELECT DISTINCT subset FROM tele))
),
sampled AS (
  SELECT subset, unit_id, cycle, sensor_2, draw FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY subset ORDER BY {SIGNED.format(h='p2_hash')}, unit_id) AS INTEGER) AS draw FROM p2)
  JOIN shares USING (subset) WHERE draw <= quota
)
"""
)
define("request_sample", f"SELECT subset, unit_id, cycle, {r('sensor_2')} AS sensor_2, draw FROM sampled", TELE, SAMPLE)
define(
    "request_histories",
    f"""SELECT t.subset, t.unit_id, s.cycle AS end_cycle, t.cycle, {r('t.sensor_2')} AS sensor_2
    FROM sampled s JOIN tele t ON t.subset = s.subset AND t.unit_id = s.unit_id AND t.cycle <= s.cycle AND t.cycle > s.cycle - 30""",
    TELE,
    SAMPLE,
)


def all_statements() -> dict[str, str]:
    return dict(STATEMENTS)
