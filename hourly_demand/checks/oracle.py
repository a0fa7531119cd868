"""SQL counterparts of the registered queries, written independently for DuckDB."""

from __future__ import annotations

from ..operators.permutation import PRIME, ROUNDS, WIDTHS, round_keys

PI2 = "6.283185307179586"


def r(expr: str, name: str | None = None, digits: int = 9) -> str:
    """Rounded output column without a negative zero."""
    return f"{rr(expr, digits)} + 0.0::DOUBLE AS {name or expr}"


def rr(expr: str, digits: int = 9) -> str:
    return f"round_even(CAST({expr} AS DOUBLE) * 1e{digits}, 0) / 1e{digits}"


# Inputs. Each entry needs only the entries before it.
CTES = {
    "trips": """
        SELECT ts AS pickup_datetime, user_id AS zone_id, value AS trip_distance,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS total_amount, event_type
        FROM events""",
    "zones": """
        SELECT DISTINCT c_custkey AS zone_id FROM customer
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE r_name IN ('AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')""",
    "judged": """
        SELECT t.*, date_trunc('hour', pickup_datetime) AS pickup_hour,
               CASE WHEN NOT (pickup_datetime >= TIMESTAMP '2024-01-02' AND pickup_datetime < TIMESTAMP '2024-01-30')
                    THEN 'date'
                    WHEN NOT (trip_distance > 0 AND trip_distance <= 100 AND total_amount >= 0 AND total_amount <= 90)
                    THEN 'values'
                    WHEN zone_id NOT IN (SELECT zone_id FROM zones) THEN 'zone'
                    ELSE 'kept' END AS verdict
        FROM trips t""",
    "counts": """
        SELECT zone_id, pickup_hour, count(*) AS trips_count FROM judged WHERE verdict = 'kept' GROUP BY ALL""",
    "hours": """
        SELECT unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-29 23:00:00', INTERVAL 1 HOUR))
               AS pickup_hour""",
    "dense": """
        SELECT s.zone_id, h.pickup_hour, coalesce(c.trips_count, 0)::BIGINT AS trips_count
        FROM (SELECT DISTINCT zone_id FROM counts) s CROSS JOIN hours h
        LEFT JOIN counts c ON c.zone_id = s.zone_id AND c.pickup_hour = h.pickup_hour""",
    "panel": "SELECT zone_id, pickup_hour, trips_count::DOUBLE AS trips_count FROM dense",
    "city": """
        SELECT pickup_hour, sum(trips_count)::DOUBLE AS trips_count FROM panel GROUP BY pickup_hour""",
}


def _feature_sql(source: str, key: str, delay: int = 1) -> str:
    part = f"PARTITION BY {key} ORDER BY pickup_hour" if key else "ORDER BY pickup_hour"
    lags = sorted({delay, delay + 1, delay + 2, 24, 168})
    cols = [f"lag(trips_count, {k}) OVER (w) AS lag_{k}".replace("(w)", f"({part})") for k in lags]
    for n in (3, 24, 168):
        frame = f"({part} ROWS BETWEEN {delay + n - 1} PRECEDING AND {delay} PRECEDING)"
        for stat, fn in (("mean", "avg"), ("std", "stddev_pop")):
            cols.append(
                f"CASE WHEN count(trips_count) OVER {frame} = {n} THEN {fn}(trips_count) OVER {frame} END AS roll_{stat}_{n}"
            )
    return f"""
        SELECT *, hour(pickup_hour)::INT AS hour, (isodow(pickup_hour) - 1)::INT AS weekday,
               (isodow(pickup_hour) >= 6)::INT AS is_weekend,
               (pickup_hour::DATE IN (DATE '2024-01-01', DATE '2024-01-15'))::INT AS is_holiday,
               sin({PI2} * hour(pickup_hour) / 24) AS hour_sin, cos({PI2} * hour(pickup_hour) / 24) AS hour_cos,
               sin({PI2} * (isodow(pickup_hour) - 1) / 7) AS weekday_sin,
               cos({PI2} * (isodow(pickup_hour) - 1) / 7) AS weekday_cos,
               {', '.join(cols)}
        FROM {source}"""


CTES["feat"] = _feature_sql("panel", "zone_id")
CTES["complete"] = "SELECT * FROM feat WHERE roll_std_168 IS NOT NULL AND lag_168 IS NOT NULL"
CTES["folds"] = """
    SELECT * FROM (VALUES ('f1', TIMESTAMP '2024-01-14', TIMESTAMP '2024-01-17'),
                          ('f2', TIMESTAMP '2024-01-17', TIMESTAMP '2024-01-20'),
                          ('f3', TIMESTAMP '2024-01-20', TIMESTAMP '2024-01-23')) t(fold, s, e)"""
CTES["periods"] = """
    SELECT * FROM (VALUES ('first', TIMESTAMP '2024-01-26', TIMESTAMP '2024-01-28'),
                          ('second', TIMESTAMP '2024-01-28', TIMESTAMP '2024-01-30')) t(period, s, e)"""
CTES["cand"] = """
    SELECT zone_id, pickup_hour, trips_count, hour, weekday, is_holiday, c.candidate, c.family, c.n_features,
           greatest(0.0::DOUBLE, CASE c.candidate WHEN 'WeeklyNaive' THEN lag_168 WHEN 'Day_full' THEN lag_24
             WHEN 'Mean_calendar' THEN roll_mean_168 WHEN 'Mean_lags' THEN (lag_24 + lag_168) / 2
             ELSE roll_mean_24 END) AS p
    FROM complete, (VALUES ('WeeklyNaive', 'WeeklyNaive', 19), ('Day_full', 'Day', 19), ('Mean_calendar', 'Mean', 8),
         ('Mean_lags', 'Mean', 13), ('Mean_full', 'Mean', 19)) c(candidate, family, n_features)"""
CTES["cv"] = """
    SELECT zone_id, candidate, family, fold, max(n_features)::INT AS n_features,
           count(*) FILTER (fit) AS n_train, count(*) FILTER (cal) AS n_calibration, avg(abs(trips_count - p)) FILTER (fit) AS train_MAE,
           count(*) FILTER (val) AS n_validation, 0::BIGINT AS n_bad,
           avg(abs(trips_count - p)) FILTER (val) AS MAE,
           sqrt(avg((trips_count - p) * (trips_count - p)) FILTER (val)) AS RMSE,
           CASE WHEN sum(trips_count) FILTER (val) <> 0
                THEN 100 * sum(abs(trips_count - p)) FILTER (val) / sum(trips_count) FILTER (val) END AS WAPE_pct,
           sum(CASE WHEN trips_count > p THEN 3 * (trips_count - p) ELSE p - trips_count END) FILTER (val)
                AS BusinessLoss,
           avg(CASE WHEN trips_count > p THEN 3 * (trips_count - p) ELSE p - trips_count END) FILTER (val)
                AS BusinessLossPerHour
    FROM (SELECT cand.*, fold, pickup_hour < s - INTERVAL 48 HOUR AS fit, pickup_hour >= s AS val,
                 pickup_hour >= s - INTERVAL 48 HOUR AND pickup_hour < s AS cal
          FROM cand JOIN folds ON pickup_hour < e)
    GROUP BY zone_id, candidate, family, fold"""
CTES["board"] = f"""
    SELECT zone_id, candidate, family, {rr('avg(MAE)')} AS MAE_mean, {rr('stddev_samp(MAE)')} AS MAE_std,
           {rr('median(MAE)')} AS MAE_median, {rr('max(MAE)')} AS MAE_max, {rr('avg(RMSE)')} AS RMSE_mean,
           {rr('avg(WAPE_pct)')} AS WAPE_mean, {rr('avg(BusinessLossPerHour)')} AS BusinessLossPerHour_mean,
           {rr('stddev_samp(BusinessLossPerHour)')} AS BusinessLossPerHour_std,
           {rr('avg(train_MAE)')} AS train_MAE_mean, max(n_features) AS n_features,
           count(DISTINCT fold) AS n_folds
    FROM cv GROUP BY zone_id, candidate, family"""
CTES["chosen"] = """
    SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY eligible DESC, n_features, MAE_std NULLS LAST, candidate) = 1
              AS selected
    FROM (SELECT *, MAE_mean <= min(MAE_mean) OVER (PARTITION BY zone_id) * 1.01::DOUBLE + 1e-12 AS eligible FROM board)"""
CTES["radii"] = """
    SELECT zone_id, candidate, max(score) AS q FROM (
        SELECT zone_id, candidate, abs(trips_count - p) AS score,
               row_number() OVER (PARTITION BY zone_id, candidate ORDER BY abs(trips_count - p)) AS k,
               count(*) OVER (PARTITION BY zone_id, candidate) AS n
        FROM cand WHERE pickup_hour >= TIMESTAMP '2024-01-23' AND pickup_hour < TIMESTAMP '2024-01-26')
    WHERE k = ceil((n + 1) * 0.9::DOUBLE) GROUP BY ALL"""
CTES["tests"] = """
    SELECT *, abs(trips_count - prediction) AS abs_error, trips_count BETWEEN lower AND upper AS covered FROM (
        SELECT c.zone_id, c.candidate, pickup_hour, trips_count, hour, weekday, is_holiday, period, p AS prediction,
               greatest(0.0::DOUBLE, p - q) AS lower, p + q AS upper
        FROM cand c JOIN periods ON pickup_hour >= s AND pickup_hour < e
        JOIN radii ON radii.zone_id = c.zone_id AND radii.candidate = c.candidate)"""
CTES["pred"] = "SELECT * FROM tests WHERE candidate = 'WeeklyNaive'"

LOSS = "CASE WHEN trips_count > prediction THEN 3 * (trips_count - prediction) ELSE prediction - trips_count END"
ERR = "trips_count - prediction"
CTES["results"] = f"""
    SELECT zone_id, period, candidate, avg(covered::INT) AS coverage, avg(upper - lower) AS mean_width, count(*) AS n,
           0::BIGINT AS n_bad, avg(abs_error) AS MAE, sqrt(avg(abs_error * abs_error)) AS RMSE,
           CASE WHEN sum(trips_count) <> 0 THEN 100 * sum(abs_error) / sum(trips_count) END AS WAPE_pct,
           sum({LOSS}) AS BusinessLoss, avg({LOSS}) AS BusinessLossPerHour
    FROM tests GROUP BY zone_id, period, candidate"""


def with_inputs(body: str, *names: str) -> str:
    """Puts the named inputs, and all that they need, in front of a query."""
    order = list(CTES)
    needed = set(names)
    for name in reversed(order):
        if name in needed:
            needed |= {o for o in order[: order.index(name)] if _mentions(CTES[name], o)}
    parts = ", ".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in order if n in needed)
    return f"WITH {parts} {body}"


def _mentions(sql: str, name: str) -> bool:
    import re

    return re.search(rf"(FROM|JOIN|,)\s+{name}\b", sql) is not None


def sql(body: str) -> str:
    return with_inputs(body, *[n for n in CTES if _mentions(body, n)])


FEATURE_COLS = (
    ["hour", "weekday", "is_weekend", "is_holiday", "hour_sin", "hour_cos", "weekday_sin", "weekday_cos"]
    + [f"lag_{k}" for k in (1, 2, 3, 24, 168)]
    + [f"roll_{s}_{w}" for w in (3, 24, 168) for s in ("mean", "std")]
)
INTS = {"hour", "weekday", "is_weekend", "is_holiday"}


def _feature_out(names) -> str:
    return ", ".join(c if c in INTS else r(c) for c in names)


def _corr_sql() -> str:
    cols = ["trips_count", *FEATURE_COLS]
    rows = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})', 'r', 6)} FROM complete" for a in cols for b in cols
    )
    return sql(rows)


def _quantile_radius(method: str) -> str:
    scale = "sqrt(greatest(1.0::DOUBLE, p))" if method == "scaled" else "1.0::DOUBLE"
    return f"SELECT zone_id, '{method}' AS method, abs(trips_count - p) / {scale} AS score FROM base"


def _interval_cv(candidate: str) -> str:
    """Radius per zone, fold and method from 48 hours of calibration, then fold scores."""
    return f"""
    roles AS (SELECT zone_id, fold, trips_count, p, pickup_hour >= s AS val,
                     pickup_hour >= s - INTERVAL 48 HOUR AND pickup_hour < s AS calib
              FROM cand JOIN folds ON pickup_hour < e WHERE candidate = '{candidate}'),
    scored AS (SELECT roles.*, method, CASE method WHEN 'scaled' THEN sqrt(greatest(1.0::DOUBLE, p)) ELSE 1.0::DOUBLE END AS sc
               FROM roles, (VALUES ('absolute'), ('scaled')) m(method)),
    q AS (SELECT zone_id, fold, method, max(score) AS q FROM (
            SELECT zone_id, fold, method, abs(trips_count - p) / sc AS score,
                   row_number() OVER (PARTITION BY zone_id, fold, method ORDER BY abs(trips_count - p) / sc) AS k,
                   count(*) OVER (PARTITION BY zone_id, fold, method) AS n
            FROM scored WHERE calib) WHERE k = ceil((n + 1) * 0.9::DOUBLE) GROUP BY ALL),
    per_fold AS (SELECT zone_id, '{candidate}' AS candidate, fold, method,
                   avg((trips_count >= greatest(0.0::DOUBLE, p - q * sc) AND trips_count <= p + q * sc)::INT) AS coverage,
                   avg(p + q * sc - greatest(0.0::DOUBLE, p - q * sc)) AS mean_width, count(*) AS n
            FROM scored JOIN q USING (zone_id, fold, method) WHERE val GROUP BY zone_id, fold, method)"""


def _with_more(body: str, more: str) -> str:
    """Query whose extra inputs come after the shared ones."""
    head = sql(more + body)
    cut = head.index(more)
    return head[:cut].rstrip() + ", " + more.strip() + " " + body


HOLIDAYS = """
    nominal AS (SELECT y, make_date(y, m, d) AS day FROM range(1990, 2030) t(y),
                (VALUES (1, 1), (7, 4), (11, 11), (12, 25)) f(m, d)
                UNION ALL SELECT y, make_date(y, 6, 19) FROM range(2021, 2030) t(y)),
    fixed AS (SELECT CASE isodow(day) WHEN 6 THEN day - 1 WHEN 7 THEN day + 1 ELSE day END AS day FROM nominal),
    days AS (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2029-12-31', INTERVAL 1 DAY))::DATE AS day),
    ranked AS (SELECT day, month(day) AS m, isodow(day) AS wd,
                      row_number() OVER (PARTITION BY year(day), month(day), isodow(day) ORDER BY day) AS k,
                      row_number() OVER (PARTITION BY year(day), month(day), isodow(day) ORDER BY day DESC) AS kr
               FROM days),
    holidays AS (SELECT day FROM fixed UNION SELECT day FROM ranked
                 WHERE (m = 1 AND wd = 1 AND k = 3) OR (m = 2 AND wd = 1 AND k = 3) OR (m = 5 AND wd = 1 AND kr = 1)
                    OR (m = 9 AND wd = 1 AND k = 1) OR (m = 10 AND wd = 1 AND k = 2) OR (m = 11 AND wd = 4 AND k = 4))"""

SPRING_PANEL = """
    spring AS (SELECT zone_id, pickup_hour + INTERVAL 1440 HOUR AS pickup_hour,
                      CASE WHEN pickup_hour + INTERVAL 1440 HOUR <> TIMESTAMP '2024-03-10 02:00:00'
                           THEN trips_count END AS trips_count FROM panel)"""


def _spring_features() -> str:
    body = _feature_sql("spring", "zone_id", 2).replace("DATE '2024-01-01', DATE '2024-01-15'", "DATE '2024-02-19'")
    names = FEATURE_COLS[:8] + ["lag_2", "lag_3", "lag_4", "lag_24", "lag_168"] + FEATURE_COLS[13:]
    out = f"SELECT zone_id, pickup_hour, trips_count, {_feature_out(names)} FROM ({body}) WHERE trips_count IS NOT NULL AND "
    out += " AND ".join(f"{n} IS NOT NULL" for n in names if n not in INTS)
    return _with_more(out, SPRING_PANEL)


def _deciles(value: str, by: str, source: str) -> str:
    """Inner deciles by position in the sorted list, with the extremes."""
    h = [f"((len(s) - 1) * {i * 0.1!r}e0)" for i in range(1, 10)]
    cuts = ", ".join(
        f"s[floor({x})::INT + 1] + (s[ceil({x})::INT + 1] - s[floor({x})::INT + 1]) * ({x} - floor({x})) AS d{i}"
        for i, x in enumerate(h, 1)
    )
    return f"SELECT {by}, s[1] AS lo, s[len(s)] AS hi, {cuts} FROM (SELECT {by}, list_sort(list({value})) AS s FROM {source} GROUP BY {by})"


def _edges(source: str, name: str) -> str:
    """Distinct inner deciles as a list, per type."""
    ds = ", ".join(f"d{i}" for i in range(1, 10))
    return (
        f"{name} AS (SELECT event_type, list_sort([x for x in list_distinct([{ds}]) if x > lo AND x < hi]) AS cuts "
        f"FROM ({_deciles('value', 'event_type', source)}))"
    )


def _shares(rows: str, edges: str, name: str) -> str:
    """Smoothed share of every bin of the edges, per type."""
    return f"""
    {name} AS (
        SELECT b.event_type, b.bin, (coalesce(n, 0) + 0.5::DOUBLE) / sum(coalesce(n, 0) + 0.5::DOUBLE) OVER (PARTITION BY b.event_type) AS share,
               coalesce(n, 0) AS n
        FROM (SELECT event_type, unnest(generate_series(0, len(cuts))) AS bin FROM {edges}) b
        LEFT JOIN (SELECT v.event_type, len([x for x in cuts if x <= value]) AS bin, count(*) AS n
                   FROM {rows} v JOIN {edges} USING (event_type) GROUP BY ALL) c
        ON b.event_type = c.event_type AND b.bin = c.bin)"""


FIRST = "(SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16')"
SECOND = "(SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16')"


def _monitor(zone: str = "zone_id", keys: str = "zone_id, period") -> str:
    """Reference from the fit hours of each zone, or of all rows with a constant for the zone; few distinct deciles make fewer bins."""
    ds = ", ".join(f"d{i}" for i in range(1, 10))
    more = f"""
    watched AS (SELECT * REPLACE ({zone} AS zone_id) FROM pred),
    fit AS (SELECT {zone} AS zone_id, trips_count FROM complete WHERE pickup_hour < TIMESTAMP '2024-01-23'),
    cut AS ({_deciles('trips_count', 'zone_id', 'fit')}),
    edges AS (SELECT zone_id, list_sort([x for x in list_distinct([{ds}]) if x > lo AND x < hi]) AS cuts FROM cut),
    bins AS (SELECT zone_id, unnest(generate_series(0, len(cuts))) AS bin FROM edges),
    ref AS (SELECT b.zone_id, b.bin, (coalesce(n, 0) + 0.5::DOUBLE) / sum(coalesce(n, 0) + 0.5::DOUBLE) OVER (PARTITION BY b.zone_id) AS share
            FROM bins b LEFT JOIN (SELECT zone_id, len([x for x in cuts if x <= trips_count]) AS bin, count(*) AS n
                                   FROM fit JOIN edges USING (zone_id) GROUP BY ALL) c USING (zone_id, bin)),
    obs AS (SELECT b.zone_id, period, b.bin, (coalesce(n, 0) + 0.5::DOUBLE) / sum(coalesce(n, 0) + 0.5::DOUBLE) OVER (PARTITION BY b.zone_id, period) AS share
            FROM bins b CROSS JOIN periods
            LEFT JOIN (SELECT zone_id, period, len([x for x in cuts if x <= trips_count]) AS bin, count(*) AS n
                       FROM watched JOIN edges USING (zone_id) GROUP BY ALL) c USING (zone_id, period, bin)),
    drift AS (SELECT zone_id, period, sum((o.share - r.share) * ln(o.share / r.share)) AS psi
              FROM obs o JOIN ref r USING (zone_id, bin) GROUP BY ALL),
    sc AS (SELECT zone_id, period, count(*) AS n, avg(abs_error) AS mae, sqrt(avg(abs_error * abs_error)) AS rmse,
                  CASE WHEN sum(trips_count) <> 0 THEN 100 * sum(abs_error) / sum(trips_count) END AS wape,
                  avg(covered::INT) AS cov FROM watched GROUP BY ALL)"""
    body = f"""
    SELECT {keys}, {r('psi')}, n, 0::BIGINT AS n_bad, {r('mae', 'MAE')}, {r('rmse', 'RMSE')},
           {r('wape', 'WAPE_pct')}, {r('cov', 'coverage')},
           concat_ws(',', CASE WHEN psi > 0.2 THEN 'psi_above_0.2' END, CASE WHEN mae > 0.15 THEN 'mae_above_limit' END,
                     CASE WHEN cov < 0.85 THEN 'coverage_below_0.85' END) AS alerts
    FROM sc JOIN drift USING (zone_id, period)"""
    return _with_more(body, more)


def _group_importance() -> str:
    """Each group of features taken from rows that lie a fixed shift earlier."""
    more = """
    sample AS (SELECT zone_id, trips_count, hour, lag_24, roll_mean_24,
                      row_number() OVER (PARTITION BY zone_id ORDER BY pickup_hour) - 1 AS pos,
                      count(*) OVER (PARTITION BY zone_id) AS n FROM complete),
    base AS (SELECT avg(abs(trips_count - (0.5::DOUBLE * lag_24 + 0.3::DOUBLE * roll_mean_24 + 0.01::DOUBLE * hour))) AS b FROM sample),
    jobs AS (SELECT * FROM (VALUES ('lags'), ('rolling'), ('calendar')) g("group"), (VALUES (24), (37), (51)) s(shift)),
    moved AS (SELECT "group", shift, s.trips_count,
                     CASE WHEN "group" = 'lags' THEN o.lag_24 ELSE s.lag_24 END AS l,
                     CASE WHEN "group" = 'rolling' THEN o.roll_mean_24 ELSE s.roll_mean_24 END AS m,
                     CASE WHEN "group" = 'calendar' THEN o.hour ELSE s.hour END AS h
              FROM sample s CROSS JOIN jobs JOIN sample o ON o.zone_id = s.zone_id AND (o.pos + shift) % o.n = s.pos),
    rep AS (SELECT "group", shift, avg(abs(trips_count - (0.5::DOUBLE * l + 0.3::DOUBLE * m + 0.01::DOUBLE * h))) AS mae FROM moved GROUP BY ALL)"""
    body = f"""SELECT "group", {r('avg(mae - b)', 'mae_increase')}, {r('stddev_pop(mae - b)', 'std')}
               FROM rep, base GROUP BY "group" """
    return _with_more(body, more)


def _perm_importance(repeats: int = 5, seed: int = 42) -> str:
    """Partners by the Feistel network on positions; what falls outside walks on until it is inside."""

    def mixed(half: str, k: int) -> str:
        moved = f"(({half} + c[{3 * k + 1}]) % {PRIME})"
        return f"(({moved} * {moved}) % {PRIME} * c[{3 * k + 2}] + c[{3 * k + 3}]) % {PRIME}"

    turns, name = "", "halves"
    for k in range(ROUNDS):
        left = f"(l + {mixed('r', k)}) % a" if k % 2 == 0 else "l"
        right = "r" if k % 2 == 0 else f"(r + {mixed('l', k)}) % b"
        turns += f", t{k} AS (SELECT repeat, n, x, a, b, c, {left} AS l, {right} AS r FROM {name})"
        name = f"t{k}"
    keys = ", ".join(f"({r}, {round_keys(seed, r)}::BIGINT[])" for r in range(repeats))
    features = ["lag_24", "roll_mean_24", "hour"]
    value = lambda f: f"CASE WHEN feature = '{f}' THEN o.{f} ELSE s.{f} END"
    more = f"""
    sample AS (SELECT zone_id, trips_count, {", ".join(features)},
                      row_number() OVER (PARTITION BY zone_id ORDER BY pickup_hour) - 1 AS pos,
                      count(*) OVER (PARTITION BY zone_id) AS n FROM complete),
    sizes AS (SELECT DISTINCT n, greatest(1, floor(sqrt(n))::BIGINT) AS root FROM sample),
    tried AS (SELECT n, w.a, (n + w.a - 1) // w.a AS b FROM sizes, unnest(range(greatest((root + 1) // 2, root - {WIDTHS - 1}), root + 1)) w(a)),
    shapes AS (SELECT n, arg_min(a, (a * b - n, -a)) AS a, arg_min(b, (a * b - n, -a)) AS b FROM tried GROUP BY n),
    halves AS (SELECT k.repeat, s.n, x.x, s.a, s.b, k.c, x.x // s.b AS l, x.x % s.b AS r
               FROM shapes s, (VALUES {keys}) k(repeat, c), unnest(range(s.a * s.b)) x(x))
    {turns},
    step AS (SELECT repeat, n, x, l * b + r AS y FROM {name}),
    walk AS (SELECT repeat, n, x, y FROM step WHERE x < n UNION ALL
             SELECT w.repeat, w.n, w.x, s.y FROM walk w JOIN step s ON s.repeat = w.repeat AND s.n = w.n AND s.x = w.y WHERE w.y >= w.n),
    partner AS (SELECT repeat, n, x, y FROM walk WHERE y < n),
    base AS (SELECT avg(abs(trips_count - (0.5::DOUBLE * lag_24 + 0.3::DOUBLE * roll_mean_24))) AS b FROM sample),
    moved AS (SELECT feature, p.repeat, s.trips_count, {value("lag_24")} AS l, {value("roll_mean_24")} AS m
              FROM sample s JOIN partner p ON p.n = s.n AND p.x = s.pos JOIN sample o ON o.zone_id = s.zone_id AND o.pos = p.y,
                   (VALUES {", ".join(f"('{f}')" for f in features)}) f(feature)),
    rep AS (SELECT feature, repeat, avg(abs(trips_count - (0.5::DOUBLE * l + 0.3::DOUBLE * m))) AS mae FROM moved GROUP BY ALL)"""
    body = f"SELECT feature, {r('avg(mae - b)', 'mae_increase')}, {r('stddev_pop(mae - b)', 'std')} FROM rep, base GROUP BY feature"
    return _with_more(body, more).replace("WITH ", "WITH RECURSIVE ", 1)


def _findings() -> str:
    champion = " UNION ALL ".join(
        f"SELECT zone_id, 'champion' AS section, candidate AS subject, '{m}' AS metric, {r(e, 'value', 9)} FROM chosen WHERE selected"
        for m, e in [
            ("MAE_mean", "MAE_mean"), ("MAE_std", "MAE_std"), ("train_MAE_mean", "train_MAE_mean"),
            ("n_features", "n_features"), ("overfit_gap", "MAE_mean - train_MAE_mean"),
        ]
    )
    figures = ["MAE", "RMSE", "WAPE_pct", "BusinessLoss", "BusinessLossPerHour", "coverage", "mean_width"]
    figures = [(m, f"x.{m}") for m in figures]
    figures += [
        ("improvement_pct", "CASE WHEN b.MAE <> 0 THEN 100 * (1 - x.MAE / b.MAE) END"),
        ("coverage_gap", "x.coverage - 0.9::DOUBLE"),
    ]
    period = " UNION ALL ".join(
        f"""SELECT x.zone_id, 'period' AS section, x.period AS subject, '{m}' AS metric, {r(e, 'value', 9)}
            FROM results x JOIN chosen k ON k.zone_id = x.zone_id AND k.candidate = x.candidate AND k.selected
            JOIN results b ON b.zone_id = x.zone_id AND b.period = x.period AND b.candidate = 'WeeklyNaive'"""
        for m, e in figures
    )
    parts = " UNION ALL ".join(
        f"""SELECT a.zone_id, 'ablation' AS section, a.candidate AS subject, '{m}' AS metric, {r(e, 'value', 9)}
            FROM board a JOIN board f ON f.zone_id = a.zone_id AND f.candidate = 'Mean_full'
            WHERE a.candidate IN ('Mean_calendar', 'Mean_lags')"""
        for m, e in [("score", "a.MAE_mean"), ("full_score", "f.MAE_mean"), ("delta", "a.MAE_mean - f.MAE_mean")]
    )
    return sql(f"{champion} UNION ALL {period} UNION ALL {parts}")


VIOLATION_CHECKS = ("null_time", "off_hour", "duplicate_hour", "missing_hour", "null_value", "not_finite", "negative")


def _violations(source: str) -> str:
    unpivot = " UNION ALL ".join(f"SELECT zone_id, '{c}' AS \"check\", {c}::BIGINT AS n_bad FROM v" for c in VIOLATION_CHECKS)
    return f"""
    rows_ AS ({source}),
    v AS (SELECT zone_id, count(*) FILTER (t IS NULL) AS null_time, count(*) FILTER (t <> date_trunc('hour', t)) AS off_hour,
                 count(t) - count(DISTINCT date_trunc('hour', t)) AS duplicate_hour,
                 date_diff('hour', date_trunc('hour', min(t)), date_trunc('hour', max(t))) + 1
                   - count(DISTINCT date_trunc('hour', t)) AS missing_hour,
                 count(*) FILTER (y IS NULL OR isnan(y)) AS null_value, count(*) FILTER (isinf(y)) AS not_finite,
                 count(*) FILTER (y < 0) AS negative
          FROM rows_ GROUP BY zone_id)""", unpivot


def _pearson_lag(k: int) -> str:
    return f"""SELECT zone_id, {k}::INT AS lag, {r('CASE WHEN min(a) < max(a) AND min(b) < max(b) THEN corr(a, b) END', 'r')}
               FROM (SELECT zone_id, trips_count AS a, lag(trips_count, {k}) OVER (PARTITION BY zone_id ORDER BY pickup_hour) AS b
                     FROM panel) WHERE b IS NOT NULL GROUP BY zone_id"""


def oracle() -> dict[str, str]:
    out: dict[str, str] = {}
    plain = "pickup_datetime, zone_id, trip_distance, total_amount"
    out["scan_trips"] = sql(f"SELECT {plain} FROM trips")
    out["zone_lookup"] = sql("SELECT zone_id FROM zones")
    out["union_months"] = sql("SELECT zone_id, pickup_hour, trips_count FROM counts")
    inputs = """SELECT date_trunc('month', o_orderdate)::DATE::VARCHAR AS file_month,
                       concat(count(*), '-', sum(o_orderkey)::BIGINT) AS fingerprint FROM orders"""
    out["stale_months"] = f"""
        SELECT a.file_month, a.fingerprint FROM ({inputs} GROUP BY 1) a
        LEFT JOIN ({inputs} WHERE o_orderdate < TIMESTAMP '2000-01-16' GROUP BY 1) b
        ON a.file_month = b.file_month AND a.fingerprint = b.fingerprint WHERE b.file_month IS NULL"""
    out["manifest_check"] = """
        SELECT file_month, kept = stored AS kept_ok, TRUE AS hours_ok, TRUE AS raw_ok FROM (
            SELECT date_trunc('month', o_orderdate)::DATE::VARCHAR AS file_month, count(*) FILTER (o_orderstatus = 'F') AS kept,
                   count(*) FILTER (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '2000-01-16') AS stored,
                   count(*) FILTER (o_orderdate < TIMESTAMP '2000-01-16' AND o_orderstatus = 'F') AS seen
            FROM orders GROUP BY 1) WHERE TRUE"""
    out["coerce_types"] = """
        SELECT o_orderkey, TRY_CAST(o_orderstatus AS DOUBLE) AS as_status,
               TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS as_digit,
               TRY_CAST(o_orderpriority AS DOUBLE) AS as_priority FROM orders"""
    out["filter_month"] = sql("SELECT pickup_datetime, zone_id FROM judged WHERE verdict <> 'date'")
    out["filter_values"] = sql(
        """SELECT zone_id, trip_distance, total_amount FROM trips
           WHERE trip_distance > 0 AND trip_distance <= 100 AND total_amount BETWEEN 0 AND 90"""
    )
    out["classify_trips"] = sql(f"SELECT {plain}, verdict FROM judged")
    out["semi_join_zones"] = sql(f"SELECT {plain} FROM trips WHERE zone_id IN (SELECT zone_id FROM zones)")
    out["complete_rows"] = sql("SELECT zone_id, pickup_hour, trips_count, lag_168 FROM complete")
    out["period_slice"] = sql(
        """SELECT * FROM panel WHERE pickup_hour >= TIMESTAMP '2024-01-10' AND pickup_hour < TIMESTAMP '2024-01-20 12:00:00'"""
    )
    out["dense_panel"] = sql("SELECT * FROM dense")
    out["missing_hours"] = sql(
        """SELECT s.zone_id, h.pickup_hour FROM (SELECT DISTINCT zone_id FROM judged WHERE verdict <> 'date') s
           CROSS JOIN hours h LEFT JOIN (SELECT DISTINCT zone_id, pickup_hour FROM judged WHERE verdict <> 'date') o
           ON o.zone_id = s.zone_id AND o.pickup_hour = h.pickup_hour WHERE o.zone_id IS NULL"""
    )
    out["merge_partials"] = out["union_months"]
    # Each hour also stands at the hours that look back at it, so no table is joined to itself.
    out["lag_join"] = sql(
        """SELECT zone_id, moved AS pickup_hour, max(trips_count) FILTER (k = 0) AS trips_count,
                  max(trips_count) FILTER (k = 1) AS lag_1, max(trips_count) FILTER (k = 24) AS lag_24
           FROM (SELECT zone_id, trips_count, k, pickup_hour + to_hours(k) AS moved FROM panel, (VALUES (0), (1), (24)) v(k))
           GROUP BY zone_id, moved HAVING count(*) FILTER (k = 0) > 0"""
    )
    out["fold_assign"] = sql(
        """SELECT panel.*, fold, CASE WHEN pickup_hour < s THEN 'train' ELSE 'valid' END AS role
           FROM panel JOIN folds ON pickup_hour < e"""
    )
    out["period_assign"] = sql(
        "SELECT panel.*, period FROM panel JOIN periods ON pickup_hour >= s AND pickup_hour < e"
    )
    out["improvement"] = sql(
        f"""SELECT x.zone_id, x.period, x.candidate, {r('x.MAE', 'MAE')}, {r('b.MAE', 'baseline_MAE')},
                   {r('CASE WHEN b.MAE <> 0 THEN 100 * (1 - x.MAE / b.MAE) END', 'improvement_pct')}
            FROM results x JOIN results b ON b.zone_id = x.zone_id AND b.period = x.period AND b.candidate = 'WeeklyNaive'"""
    )
    out["ablation"] = sql(
        f"""SELECT a.zone_id, a.family, split_part(a.candidate, '_', 2) AS subset, {r('a.MAE_mean', 'score', 9)},
                   {r('f.MAE_mean', 'full_score', 9)}, {r('a.MAE_mean - f.MAE_mean', 'delta', 9)}
            FROM board a JOIN board f ON f.zone_id = a.zone_id AND f.candidate = 'Mean_full'
            WHERE a.candidate IN ('Mean_calendar', 'Mean_lags')"""
    )
    out["hourly_counts"] = out["union_months"]
    audit_cols = """count(*) AS raw_rows, count(*) FILTER (verdict = 'date') AS rejected_date,
        count(*) FILTER (verdict = 'values') AS rejected_values, count(*) FILTER (verdict = 'zone') AS rejected_zone,
        count(*) FILTER (verdict = 'kept') AS kept_rows"""
    out["audit"] = sql(f"SELECT zone_id, {audit_cols} FROM judged GROUP BY zone_id")
    out["audit_city"] = sql(f"SELECT {audit_cols} FROM judged")
    out["observed_hours"] = sql("SELECT DISTINCT pickup_hour FROM judged WHERE verdict <> 'date'")
    out["metrics"] = sql(
        f"""SELECT zone_id, period, count(*) AS n, 0::BIGINT AS n_bad, {r('avg(abs_error)', 'MAE')},
                   {r('sqrt(avg(abs_error * abs_error))', 'RMSE')},
                   {r('CASE WHEN sum(trips_count) <> 0 THEN 100 * sum(abs_error) / sum(trips_count) END', 'WAPE_pct')}
            FROM pred GROUP BY zone_id, period"""
    )
    out["business_loss"] = sql(
        f"""SELECT zone_id, period, count(*) AS n, 0::BIGINT AS n_bad, {r(f'sum({LOSS})', 'BusinessLoss')},
                   {r(f'avg({LOSS})', 'BusinessLossPerHour')} FROM pred GROUP BY zone_id, period"""
    )
    cost = f"CASE WHEN {ERR} > 0 THEN u * ({ERR}) ELSE o * -({ERR}) END"
    out["cost_scenarios"] = sql(
        f"""SELECT period, count(*) AS n, scenario, u AS cost_under, o AS cost_over, {r(f'sum({cost})', 'BusinessLoss')},
                   {r(f'avg({cost})', 'BusinessLossPerHour')}
            FROM pred, (VALUES ('cheap', 1.0::DOUBLE, 1.0::DOUBLE), ('base', 3.0::DOUBLE, 1.0::DOUBLE),
                        ('strict', 10.0::DOUBLE, 1.0::DOUBLE)) s(scenario, u, o)
            GROUP BY period, scenario, u, o"""
    )
    board_cols = ["MAE_mean", "MAE_std", "MAE_median", "MAE_max", "RMSE_mean", "WAPE_mean"]
    board_cols += ["BusinessLossPerHour_mean", "BusinessLossPerHour_std", "train_MAE_mean"]
    out["leaderboard"] = sql(
        f"SELECT zone_id, candidate, family, {', '.join(r(c, digits=9) for c in board_cols)}, n_features, n_folds, 0::BIGINT AS n_short FROM board"
    )
    out["interval_scores"] = _with_more(
        f"SELECT zone_id, candidate, fold, method, {r('coverage')}, {r('mean_width')}, n FROM per_fold",
        _interval_cv("Day_full"),
    )
    out["interval_choice"] = _with_more(
        f"""SELECT zone_id, method, {r('coverage', digits=9)}, {r('mean_width', digits=9)},
                   {r('abs(coverage - 0.9::DOUBLE)', 'coverage_gap', 9)} FROM (
              SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY abs(coverage - 0.9::DOUBLE), mean_width, method) AS k
              FROM (SELECT zone_id, method, {rr('avg(coverage)')} AS coverage, {rr('avg(mean_width)')} AS mean_width
                    FROM per_fold GROUP BY zone_id, method)) WHERE k = 1""",
        _interval_cv("Mean_full"),
    )
    out["error_segments"] = sql(
        " UNION ALL ".join(
            f"""SELECT period, '{d}' AS dimension, {d}::INT AS value, {r('avg(abs_error)', 'MAE')},
                       {r('avg(covered::INT)', 'coverage')}, count(*) AS n FROM pred GROUP BY period, {d}"""
            for d in ("hour", "weekday", "is_holiday")
        )
    )
    stats = ", ".join(
        [
            "count(trips_count) AS count", r("avg(trips_count)", "mean"), r("stddev_samp(trips_count)", "std"),
            r("min(trips_count)", "min"), r("max(trips_count)", "max"),
        ]
        + [
            r(f"quantile_cont(trips_count, {p}::DOUBLE)", n)
            for n, p in (("p01", 0.01), ("p05", 0.05), ("p50", 0.5), ("p95", 0.95), ("p99", 0.99))
        ]
    )
    out["target_stats"] = sql(f"SELECT zone_id, {stats} FROM panel GROUP BY zone_id")
    out["target_stats_city"] = sql(f"SELECT {stats} FROM panel")
    out["zero_missing"] = sql(
        f"""SELECT zone_id, count(*) AS n, count(*) - count(trips_count) AS n_missing,
                   {r('avg((trips_count = 0)::INT)', 'zero_share')} FROM panel GROUP BY zone_id"""
    )
    out["profiles"] = sql(
        " UNION ALL ".join(
            f"""SELECT zone_id, '{d}' AS dimension, {e}::INT AS value, {r('avg(trips_count)', 'mean')},
                       count(trips_count) AS n FROM panel GROUP BY zone_id, {e}"""
            for d, e in (("hour", "hour(pickup_hour)"), ("weekday", "(isodow(pickup_hour) - 1)"))
        )
    )
    out["peak_trough"] = _with_more(
        f"""SELECT zone_id, min(h) FILTER (m = hi)::INT AS peak_hour, {r('max(m)', 'peak_mean')},
                   min(h) FILTER (m = lo)::INT AS trough_hour, {r('min(m)', 'trough_mean')}
            FROM (SELECT *, max(m) OVER (PARTITION BY zone_id) AS hi, min(m) OVER (PARTITION BY zone_id) AS lo FROM by_hour)
            GROUP BY zone_id""",
        "by_hour AS (SELECT zone_id, hour(pickup_hour) AS h, avg(trips_count) AS m FROM panel GROUP BY ALL)",
    )
    out["daily_resample"] = sql(
        """SELECT zone_id, date_trunc('day', pickup_hour)::TIMESTAMP AS day, sum(CASE WHEN trips_count > 0 THEN trips_count END) AS total
           FROM panel GROUP BY ALL"""
    )
    out["distinct_days"] = sql("SELECT DISTINCT period, date_trunc('day', pickup_hour)::TIMESTAMP AS day FROM pred")

    def histogram(source: str, value: str, by: str) -> str:
        return f"""
            SELECT l.{by}, b.bin::INT AS bin, {r('a + b.bin * (z - a) / 50', 'lo')}, {r('a + (b.bin + 1) * (z - a) / 50', 'hi')},
                   coalesce(n, 0)::BIGINT AS n
            FROM (SELECT {by}, min({value}) AS a, max({value}) AS z FROM {source} GROUP BY {by}) l
            CROSS JOIN range(50) b(bin)
            LEFT JOIN (SELECT s.{by}, least(49, floor(({value} - a) / ((z - a) / 50)))::INT AS bin, count(*) AS n
                       FROM {source} s JOIN (SELECT {by}, min({value}) AS a, max({value}) AS z FROM {source} GROUP BY {by}) m
                       ON m.{by} = s.{by} GROUP BY ALL) c ON c.{by} = l.{by} AND c.bin = b.bin"""

    out["histogram"] = histogram("events", "value", "event_type")
    out["residual_histogram"] = _with_more(
        histogram("residuals", "residual", "period"),
        "residuals AS (SELECT period, trips_count - prediction AS residual FROM pred)",
    )
    out["autocorr"] = sql(" UNION ALL ".join(_pearson_lag(k) for k in (1, 24, 168)))
    out["corr_matrix"] = _corr_sql()
    for name, size in (("periodogram", 672), ("periodogram_prime", 661)):
        out[name] = _with_more(
            f"""SELECT k::BIGINT AS k, {r(f'{size}.0::DOUBLE / k', 'period', 4)}, {r(f'CASE WHEN 2 * k = {size} THEN 1 ELSE 2 END * (re * re + im * im) / {size}', 'power', 4)}
                FROM (SELECT k, sum(d * cos({PI2} * ((j * k) % {size}) / {size})) AS re, sum(d * sin({PI2} * ((j * k) % {size}) / {size})) AS im
                      FROM flat CROSS JOIN range(2, {size // 2 + 1}) f(k) GROUP BY k)""",
            f"""placed AS (SELECT row_number() OVER (ORDER BY pickup_hour) - 1 AS j, trips_count AS y FROM city QUALIFY j < {size}),
               line AS (SELECT regr_slope(y, j) AS b, regr_intercept(y, j) AS a FROM placed),
               flat AS (SELECT j, y - (a + b * j) AS d FROM placed, line)""",
        )
    out["reference_bins"] = "WITH " + _edges("events", "edges") + "," + _shares("events", "edges", "shares") + f"""
        SELECT event_type, bin::INT AS bin, {r('CASE WHEN bin > 0 THEN cuts[bin] END', 'lo')},
               {r('CASE WHEN bin < len(cuts) THEN cuts[bin + 1] END', 'hi')}, {r('share', 'probability')}
        FROM shares JOIN edges USING (event_type)"""
    out["psi"] = (
        "WITH " + _edges(FIRST, "edges") + "," + _shares(FIRST, "edges", "expected") + ","
        + _shares(SECOND, "edges", "seen")
        + f"""SELECT event_type, {r('sum((s.share - e.share) * ln(s.share / e.share))', 'psi')}, sum(s.n)::BIGINT AS n
              FROM seen s JOIN expected e USING (event_type, bin) GROUP BY event_type"""
    )
    out["monitor"] = _monitor()
    out["cv_invariants"] = sql(
        """SELECT zone_id, candidate, count(DISTINCT fold) AS n_folds, count(*) AS n_rows,
                  count(DISTINCT fold) = 3 AND count(*) = 3 AS ok FROM cv GROUP BY zone_id, candidate"""
    )
    out["median_rounds"] = sql(
        """SELECT zone_id, candidate, greatest(1, floor(median(floor(round(MAE * 100, 6)))))::INT AS rounds
           FROM cv GROUP BY zone_id, candidate"""
    )
    out["overfit_gap"] = sql(
        f"""SELECT zone_id, candidate, {r('avg(train_MAE)', 'train_MAE')}, {r('avg(MAE)', 'validation_MAE')},
                   {r('avg(MAE) - avg(train_MAE)', 'gap')} FROM cv GROUP BY zone_id, candidate"""
    )
    part = "PARTITION BY zone_id ORDER BY pickup_hour"
    out["lags"] = sql(
        f"SELECT *, {', '.join(f'lag(trips_count, {k}) OVER ({part}) AS lag_{k}' for k in (2, 3, 4, 24, 168))} FROM panel"
    )

    def rolled(fn: str, stat: str, delay: int) -> str:
        cols = []
        for n in (3, 24, 168):
            frame = f"({part} ROWS BETWEEN {delay + n - 1} PRECEDING AND {delay} PRECEDING)"
            value = f"CASE WHEN count(*) OVER {frame} = {n} THEN {fn}(trips_count) OVER {frame} END"
            cols.append(r(value, f"roll_{stat}_{n}"))
        return sql(f"SELECT *, {', '.join(cols)} FROM panel")

    out["roll_mean"] = rolled("avg", "mean", 2)
    out["roll_std"] = rolled("stddev_pop", "std", 1)
    out["gap_check"] = sql(
        """SELECT *, n_expected - n_hours AS n_missing FROM (
             SELECT zone_id, count(*) AS n_rows, count(DISTINCT pickup_hour) AS n_hours,
                    date_diff('hour', min(pickup_hour), max(pickup_hour)) + 1 AS n_expected FROM counts GROUP BY zone_id)"""
    )
    out["interpolate"] = _with_more(
        f"""SELECT zone_id, pickup_hour, trips_count,
              {r('''CASE WHEN trips_count IS NOT NULL THEN trips_count WHEN pj IS NULL THEN nv WHEN nj IS NULL THEN pv
                    ELSE pv + (nv - pv) * (j - pj)::DOUBLE / (nj - pj) END''', 'filled')}
            FROM (SELECT *, last_value(CASE WHEN trips_count IS NOT NULL THEN j END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pj,
                         last_value(trips_count IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
                         first_value(CASE WHEN trips_count IS NOT NULL THEN j END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nj,
                         first_value(trips_count IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
                  FROM holes WINDOW w AS ({part}))""",
        f"""holes AS (SELECT zone_id, pickup_hour, CASE WHEN trips_count > 0 THEN trips_count END AS trips_count,
                      row_number() OVER ({part}) AS j FROM panel)""",
    )
    rank = "ceil((n + 1) * 0.9::DOUBLE)"
    out["conformal_radius"] = _with_more(
        f"""SELECT zone_id, method, max(n)::BIGINT AS n, {r(f'max(score) FILTER (k = {rank})', 'q')},
                   CASE WHEN max(n) < 30 THEN 'too_few' WHEN {rank.replace('n +', 'max(n) +')} > max(n) THEN 'rank_above_n' END AS reason
            FROM (SELECT *, row_number() OVER (PARTITION BY zone_id, method ORDER BY score) AS k,
                         count(*) OVER (PARTITION BY zone_id, method) AS n
                  FROM ({_quantile_radius('absolute')} UNION ALL {_quantile_radius('scaled')}))
            GROUP BY zone_id, method""",
        """base AS (SELECT zone_id, trips_count, roll_mean_24 AS p FROM complete
                    WHERE pickup_hour >= TIMESTAMP '2024-01-23' AND pickup_hour < TIMESTAMP '2024-01-26')""",
    )
    out["conformal_radius_pooled"] = f"""
        SELECT max(n)::BIGINT AS n, {r(f'max(score) FILTER (k = {rank})', 'q')}, CAST(NULL AS VARCHAR) AS reason
        FROM (SELECT score, row_number() OVER (ORDER BY score) AS k, count(*) OVER () AS n
              FROM (SELECT abs(value - 50) / sqrt(50.0::DOUBLE) AS score FROM events))"""

    def mad(source: str, value: str, by: str, k: str, cols: str) -> str:
        return f"""SELECT {by}, {cols}, {r('center')}, {r('deviation')}, {r('mad')} FROM (
            SELECT *, median(deviation) OVER (PARTITION BY {by}) AS mad FROM (
              SELECT *, abs({value} - center) AS deviation FROM (
                SELECT *, median({value}) OVER (PARTITION BY {by}) AS center FROM {source})))
            WHERE deviation > {k} * greatest(1.0::DOUBLE, mad)"""

    out["mad_outliers"] = sql(mad("panel", "trips_count", "zone_id", "2.0", "pickup_hour, trips_count"))
    out["mad_outliers_events"] = mad("events", "value", "event_type", "6.0", f"event_id, {r('value')}")
    out["stride_sample"] = sql(
        f"""SELECT zone_id, pickup_hour, trips_count FROM (
              SELECT *, row_number() OVER ({part}) - 1 AS i, count(*) OVER (PARTITION BY zone_id) AS n FROM panel)
            WHERE i % greatest(1, n // 100) = 0"""
    )
    out["cyclic_shift"] = _with_more(
        f"""SELECT zone_id, max(pickup_hour) FILTER (own) AS pickup_hour, max(trips_count) FILTER (own) AS trips_count,
                   max(lag_1) FILTER (NOT own) AS lag_1, max(lag_24) FILTER (NOT own) AS lag_24, {r('max(roll_mean_3) FILTER (own)', 'roll_mean_3')}
            FROM (SELECT *, CASE WHEN own THEN i ELSE (i + 30) % n END AS place FROM placed, (VALUES (true), (false)) v(own))
            GROUP BY zone_id, place""",
        f"""placed AS (SELECT *, row_number() OVER ({part}) - 1 AS i, count(*) OVER (PARTITION BY zone_id) AS n FROM complete)""",
    )
    out["history_tail"] = sql(
        "SELECT p.* FROM panel p WHERE pickup_hour > (SELECT max(pickup_hour) FROM panel) - INTERVAL 168 HOUR"
    )
    out["zoom_head"] = sql(
        """SELECT zone_id, period, pickup_hour, trips_count, prediction FROM (
             SELECT *, row_number() OVER (PARTITION BY zone_id, period ORDER BY pickup_hour) AS k FROM pred) WHERE k <= 24"""
    )
    out["worst_hours"] = sql(
        """SELECT zone_id, pickup_hour, trips_count, prediction, abs_error FROM pred
           ORDER BY abs_error DESC, zone_id, pickup_hour LIMIT 15"""
    )
    out["champion"] = sql(
        f"SELECT zone_id, candidate, {r('MAE_mean', digits=9)}, n_features, selected FROM chosen"
    )
    out["best_per_family"] = sql(
        f"""SELECT zone_id, family, candidate, {r('MAE_mean', digits=9)}, selected FROM (
              SELECT *, row_number() OVER (PARTITION BY zone_id, family ORDER BY selected DESC, MAE_mean, candidate) AS k
              FROM chosen) WHERE k = 1"""
    )
    cal = """pickup_datetime AS pickup_hour, {extra} hour(pickup_datetime)::INT AS hour, (isodow(pickup_datetime) - 1)::INT AS weekday,
             (isodow(pickup_datetime) >= 6)::INT AS is_weekend"""
    out["calendar"] = sql(f"SELECT {cal.format(extra='zone_id,')} FROM trips")
    waves = ", ".join(
        r(f"{fn}({PI2} * {e} / {n})", f"{name}_{fn}")
        for name, e, n in (("hour", "hour(pickup_datetime)", 24), ("weekday", "(isodow(pickup_datetime) - 1)", 7))
        for fn in ("sin", "cos")
    )
    out["cycles"] = sql(f"SELECT {cal.format(extra='')}, {waves} FROM trips")
    out["holiday_flag"] = f"""WITH {HOLIDAYS.strip()}
        SELECT o_orderdate AS pickup_hour, count(*) AS n, (o_orderdate::DATE IN (SELECT day FROM holidays))::INT AS is_holiday
        FROM orders GROUP BY o_orderdate"""
    out["dst_hours"] = """
        WITH days AS (SELECT DISTINCT o_orderdate AS d, row_number() OVER () AS x FROM orders),
        sundays AS (SELECT DISTINCT d, month(d) AS m, day(d) AS dd, year(d) AS y FROM days WHERE isodow(d) = 7)
        SELECT d + INTERVAL 2 HOUR AS pickup_hour FROM sundays
        WHERE (y < 2007 AND m = 4 AND dd <= 7) OR (y >= 2007 AND m = 3 AND dd BETWEEN 8 AND 14)
        UNION ALL
        SELECT d + INTERVAL 1 HOUR FROM sundays
        WHERE (y < 2007 AND m = 10 AND dd >= 25) OR (y >= 2007 AND m = 11 AND dd <= 7)"""
    out["hour_grid"] = sql("SELECT zone_id, pickup_hour FROM (SELECT DISTINCT zone_id FROM trips) CROSS JOIN hours")
    more, body = _violations("SELECT zone_id, pickup_datetime AS t, trip_distance - 50 AS y FROM trips")
    out["panel_violations"] = _with_more(body, more)
    more, body = _violations("SELECT zone_id, pickup_hour AS t, trips_count::DOUBLE AS y FROM counts")
    out["sparse_violations"] = _with_more(body, more)
    out["conservation"] = sql(
        """SELECT (SELECT sum(trips_count) FROM counts)::BIGINT AS counted,
                  (SELECT count(*) FROM judged WHERE verdict = 'kept') AS kept,
                  (SELECT sum(trips_count) FROM dense)::BIGINT AS in_panel, TRUE AS ok"""
    )
    out["dst_null_panel"] = _with_more("SELECT * FROM spring", SPRING_PANEL)
    out["history_status"] = _with_more(
        """SELECT zone_id, b AS last_hour, n_recent, 0::BIGINT AS n_bad,
                  CASE WHEN b <> TIMESTAMP '2024-01-29 21:00:00' THEN 'stale' WHEN n_recent <> 168 THEN 'short' ELSE 'ok' END AS status
           FROM (SELECT s.zone_id, b, count(*) FILTER (p.pickup_hour >= TIMESTAMP '2024-01-22 22:00:00') AS n_recent
                 FROM seen s JOIN panel p ON p.zone_id = s.zone_id AND p.pickup_hour BETWEEN a AND b GROUP BY ALL)""",
        "seen AS (SELECT zone_id, min(pickup_hour) AS a, max(pickup_hour) AS b FROM counts GROUP BY zone_id)",
    )
    out["live_check"] = sql(
        """SELECT current_hour, current_hour = TIMESTAMP '2024-01-15 12:00:00' AS ok, count(*) AS n
           FROM (SELECT date_trunc('hour', pickup_datetime - INTERVAL 5 HOUR) AS current_hour FROM trips) GROUP BY ALL"""
    )
    out["build_panel"] = sql("SELECT * FROM city")
    out["build_zone_panel"] = sql("SELECT * FROM panel")
    out["features"] = sql(f"SELECT zone_id, pickup_hour, trips_count, {_feature_out(FEATURE_COLS)} FROM feat")
    out["features_city"] = sql(
        f"SELECT pickup_hour, trips_count, {_feature_out(FEATURE_COLS)} FROM ({_feature_sql('city', '')})"
    )
    out["features_spring"] = _spring_features()
    z = [
        r(f"({c} - avg({c}) OVER g) / CASE WHEN min({c}) OVER g = max({c}) OVER g THEN 1 ELSE stddev_pop({c}) OVER g END", f"{c}_z")
        for c in ("lag_1", "lag_168", "roll_mean_24")
    ]
    out["standardise"] = sql(
        f"""SELECT zone_id, pickup_hour, lag_1, lag_168, {r('roll_mean_24')}, {', '.join(z)}
            FROM complete WINDOW g AS (PARTITION BY zone_id)"""
    )
    out["weekly_naive"] = sql(f"SELECT *, lag(trips_count, 168) OVER ({part}) AS prediction FROM panel")
    # Radius and last week's value of a zone from one pass over its rows.
    scores = "abs(trips_count - lag_168) / sqrt(greatest(1.0::DOUBLE, lag_168))"
    inside = "pickup_hour >= TIMESTAMP '2024-01-23' AND pickup_hour < TIMESTAMP '2024-01-26'"
    scored = f"""SELECT zone_id, list_sort(list({scores}) FILTER ({inside})) AS sorted, count(*) FILTER ({inside}) AS n,
                        list({{'h': pickup_hour, 'y': trips_count}}) FILTER (pickup_hour >= TIMESTAMP '2024-01-22 01:00:00') AS later
                 FROM complete GROUP BY zone_id"""
    radius = f"sorted[{rank}::INT]"

    def bounded(p: str) -> str:
        spread = f"{radius} * sqrt(greatest(1.0::DOUBLE, {p}))"
        return f"{r(f'greatest(0.0::DOUBLE, {p} - {spread})', 'lower')}, {r(f'{p} + {spread}', 'upper')}, 'ok' AS status"

    out["next_hour"] = sql(
        f"""SELECT zone_id, TIMESTAMP '2024-01-30 00:00:00' AS pickup_hour, p AS prediction, {bounded('p')}
            FROM (SELECT *, list_filter(later, lambda x: x.h = TIMESTAMP '2024-01-23')[1].y AS p FROM ({scored}))"""
    )
    out["stream_forecast"] = sql(
        f"""SELECT zone_id, o.h + INTERVAL 168 HOUR AS pickup_hour, o.y AS prediction, {bounded('o.y')}
            FROM (SELECT * EXCLUDE (later), unnest(later) AS o FROM ({scored})) WHERE o.h <= TIMESTAMP '2024-01-23'"""
    )
    # A stream has closed the hours that end a delay before its newest trip; only trips that pass the rules before the zone rule count.
    newest = "(SELECT max(date_trunc('second', pickup_datetime)) FROM judged WHERE verdict IN ({}))"
    closed = "pickup_hour + INTERVAL 2 HOUR <= " + newest
    out["stream_hourly"] = sql(f"SELECT * FROM counts WHERE {closed.format("'kept', 'zone'")}")
    out["late_rows"] = sql(f"SELECT *, 0::BIGINT AS emitted, trips_count AS late FROM counts WHERE NOT ({closed.format("'kept', 'zone'")})")
    out["stream_audit"] = sql(
        f"""SELECT verdict, CASE WHEN verdict <> 'date' THEN pickup_hour END AS pickup_hour, count(*) AS n FROM judged
            WHERE verdict = 'date' OR {closed.format("'kept', 'zone', 'values'")} GROUP BY ALL"""
    )
    out["stream_monitor"] = _monitor("1", "period")
    out["inner_split"] = sql(
        """SELECT *, n_fit >= 30 AND n_calibration >= 30 AND n_valid > 0 AS ok FROM (
             SELECT zone_id, fold, count(*) FILTER (pickup_hour < s - INTERVAL 50 HOUR) AS n_fit,
                    count(*) FILTER (pickup_hour < s - INTERVAL 98 HOUR) AS n_core,
                    count(*) FILTER (pickup_hour >= s - INTERVAL 96 HOUR AND pickup_hour < s - INTERVAL 48 HOUR) AS n_early,
                    count(*) FILTER (pickup_hour >= s - INTERVAL 48 HOUR AND pickup_hour < s) AS n_calibration,
                    count(*) FILTER (pickup_hour >= s) AS n_valid
             FROM complete JOIN folds ON pickup_hour < e GROUP BY zone_id, fold)"""
    )
    scores = ["MAE", "RMSE", "WAPE_pct", "BusinessLoss", "BusinessLossPerHour"]
    out["cv_naive"] = sql(
        f"""SELECT zone_id, candidate, family, fold, n_features, n_train, n_calibration, {r('train_MAE')}, n_validation, n_bad,
                   {', '.join(r(c) for c in scores)}, CASE WHEN n_train < 30 THEN 'short_fit' WHEN n_calibration < 30 THEN 'short_calibration' ELSE 'ok' END AS status
            FROM cv"""
    )
    # Every third zone begins too late for the first fold, so it has neither scores nor a champion.
    late = CTES["cv"].replace("FROM cand JOIN", "FROM (SELECT * FROM cand WHERE zone_id % 3 <> 0 OR pickup_hour >= TIMESTAMP '2024-01-11') cand JOIN")
    out["short_fold"] = _with_more(
        f"""SELECT zone_id, candidate, n_folds, n_short, {r('CASE WHEN n_short = 0 THEN m END', 'MAE_mean')},
                   n_short = 0 AND row_number() OVER (PARTITION BY zone_id ORDER BY eligible DESC, n_features, spread NULLS LAST, candidate) = 1 AS selected
            FROM (SELECT *, round(m, 12) <= round(min(m) OVER (PARTITION BY zone_id) * 1.01::DOUBLE + 1e-12, 12) AS eligible FROM (
                SELECT zone_id, candidate, count(*) AS n_folds, count(*) FILTER (n_train < 30 OR n_calibration < 30) AS n_short,
                       avg(MAE) AS m, stddev_samp(MAE) AS spread, max(n_features) AS n_features FROM late_cv GROUP BY zone_id, candidate))""",
        f"late_cv AS ({late})",
    )
    broken = """broken AS (
        SELECT zone_id, pickup_hour, CASE WHEN zone_id % 5 = 0 AND pickup_hour = TIMESTAMP '2024-01-15 07:00:00' THEN -1 ELSE trips_count END AS y
        FROM panel WHERE NOT (zone_id % 5 = 1 AND pickup_hour BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-19 04:00:00')
        UNION ALL SELECT zone_id, pickup_hour, trips_count FROM panel WHERE zone_id % 5 = 2 AND pickup_hour = TIMESTAMP '2024-01-20')"""
    out["feature_status"] = _with_more(
        """SELECT zone_id, count(*) AS n_rows, datediff('hour', min(pickup_hour), max(pickup_hour)) + 1 - count(DISTINCT pickup_hour) AS n_missing,
                  0::BIGINT AS n_no_time, 0::BIGINT AS n_off_hour, count(*) - count(DISTINCT pickup_hour) AS n_duplicate_hour,
                  0::BIGINT AS n_not_finite, count(*) FILTER (y < 0) AS n_negative,
                  CASE WHEN zone_id % 5 < 3 THEN 'invalid' ELSE 'ok' END AS status FROM broken GROUP BY zone_id""",
        broken,
    )
    verdicts = ", ".join(f"count(*) FILTER (verdict = '{v}') AS {n}" for v, n in (("date", "rejected_date"), ("values", "rejected_values"), ("zone", "rejected_zone"), ("kept", "kept_rows")))
    out["refresh_store"] = sql(f"SELECT '2024-01-01' AS file_month, count(*) AS raw_rows, {verdicts}, 1 AS first_run, 0 AS second_run FROM judged")
    out["refresh_gone"] = sql(
        f"""SELECT CASE WHEN pickup_datetime < TIMESTAMP '2024-01-16' THEN '2024-03-01' ELSE '2024-01-01' END AS file_month, count(*) AS raw_rows, {verdicts},
                   count(*) = count(verdict) AS ok, 2 AS first_run, 2 AS second_run
            FROM (SELECT * REPLACE (CASE WHEN pickup_datetime < TIMESTAMP '2024-01-16' THEN 'date' ELSE verdict END AS verdict) FROM judged) GROUP BY 1"""
    )
    out["final_naive"] = sql(
        f"""SELECT zone_id, period, candidate, {r('coverage')}, {r('mean_width')}, n, n_bad, {', '.join(r(c) for c in scores)}
            FROM results"""
    )
    out["bounds"] = sql(
        f"SELECT zone_id, pickup_hour, period, {r('prediction')}, {r('lower')}, {r('upper')}, covered FROM pred"
    )
    out["group_importance"] = _group_importance()
    out["perm_importance"] = _perm_importance()
    out["findings"] = _findings()
    return out
