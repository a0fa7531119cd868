"""One Spark query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TS, Y, Protocol, Rules, Span
from ..functions import calendar as cal
from ..functions.time import hour_index, hours
from ..operators import cleaning, drift, intervals, metrics, panel, profile, ranks, selection, spectrum
from ..operators import validation, windows
from ..plans import backtest, features as feat, forecast, importance, models, report
from ..plans.build_panel import build, build_panel
from ..sources import fixture, readers, refresh, shared, writers
from ..streaming import hourly

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEYS = ["zone_id"]
RULES = fixture.RULES
FEATURES = feat.feature_sets(1)["full"]

PROTOCOL = Protocol(
    folds=(
        Span("f1", "2024-01-14", "2024-01-17"),
        Span("f2", "2024-01-17", "2024-01-20"),
        Span("f3", "2024-01-20", "2024-01-23"),
    ),
    calibration=Span("calibration", "2024-01-23", "2024-01-26"),
    periods=(Span("first", "2024-01-26", "2024-01-28"), Span("second", "2024-01-28", "2024-01-30")),
    inner_window=timedelta(hours=48),
    trials=2,
)
#: The fits of the registered queries stop earlier than the 60 rounds of a study, as all queries run in a row.
ROUNDS_WITHOUT_GAIN = 10
CANDIDATES = [
    backtest.weekly_naive_candidate(19),
    backtest.Candidate("Day_full", "Day", 19, "lag_24"),
    backtest.Candidate("Mean_calendar", "Mean", 8, "roll_mean_168"),
    backtest.Candidate("Mean_lags", "Mean", 13, "0.5D * lag_24 + 0.5D * lag_168"),
    backtest.Candidate("Mean_full", "Mean", 19, "roll_mean_24"),
]
SCENARIOS = [("cheap", 1.0, 1.0), ("base", 3.0, 1.0), ("strict", 10.0, 1.0)]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removesuffix("_")] = fn
    return fn


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles rounded, without a negative zero."""
    scale = 10.0**digits
    doubles = {c: F.rint(F.col(c) * scale) / scale + F.lit(0.0) for c, t in df.dtypes if t == "double"}
    return df.withColumns(doubles) if doubles else df


# ---- shared inputs -------------------------------------------------------------------------


def trips(spark, sf):
    return fixture.trips(spark, sf)


def zones(spark, sf):
    return fixture.zones(spark, sf)


def cube(spark, sf):
    return cleaning.verdict_cube(trips(spark, sf), zones(spark, sf), RULES)


def zone_panel(spark, sf):
    return build_panel(trips(spark, sf), zones(spark, sf), RULES, KEYS)


def city_panel(spark, sf):
    return build_panel(trips(spark, sf), zones(spark, sf), RULES)


def known_only(spark, sf):
    """Zone panel in which hours without trips are unknown."""
    return zone_panel(spark, sf).withColumn(Y, F.when(F.col(Y) > 0, F.col(Y)))


def zone_features(spark, sf):
    return feat.features(zone_panel(spark, sf), 1, KEYS)


def complete(spark, sf):
    return feat.complete_rows(zone_features(spark, sf))


def predictions(spark, sf):
    """Test predictions of the weekly-naive forecast with absolute bounds."""
    return backtest.final_evaluation(complete(spark, sf), CANDIDATES[:1], PROTOCOL, "absolute", KEYS)


def cv(spark, sf):
    return backtest.evaluate(complete(spark, sf), CANDIDATES, PROTOCOL, KEYS)


def board(spark, sf):
    return rounded(metrics.leaderboard(cv(spark, sf), KEYS), 9)


def results(spark, sf):
    pred = backtest.final_evaluation(complete(spark, sf), CANDIDATES, PROTOCOL, "absolute", KEYS)
    return backtest.final_scores(pred, PROTOCOL, KEYS)


def day_orders(spark, sf):
    """Distinct days of the orders as hours of midnight."""
    return fixture.table(spark, sf, "orders").select(F.col("o_orderdate").alias(TS))


# ---- sources ---------------------------------------------------------------------------------


@query
def scan_trips(spark, sf):
    return trips(spark, sf)


@query
def zone_lookup(spark, sf):
    return zones(spark, sf)


@query
def union_months(spark, sf):
    """Counts of the two halves of the period, appended."""
    mid = datetime(2024, 1, 16)
    halves = [
        Rules(RULES.start, mid, RULES.max_distance, RULES.max_amount),
        Rules(mid, RULES.end, RULES.max_distance, RULES.max_amount),
    ]
    z = zones(spark, sf)
    return readers.union_all([cleaning.kept_counts(trips(spark, sf), z, r, KEYS) for r in halves])


@query
def series_csv(spark, sf):
    path = shared.shared_folder(spark, "series-csv")
    writers.write_table(city_panel(spark, sf), path, "csv")
    return readers.read_series_csv(spark, path)


@query
def write_panel(spark, sf):
    path = shared.shared_folder(spark, "panel")
    writers.write_panel(zone_panel(spark, sf), path, keys=KEYS)
    return spark.read.parquet(path)


@query
def write_table(spark, sf):
    path = shared.shared_folder(spark, "table")
    writers.write_table(board(spark, sf), path, "csv")
    return spark.read.option("header", True).csv(path)


@query
def write_json(spark, sf):
    path = shared.shared_folder(spark, "json")
    p = predictions(spark, sf)
    ref = drift.reference_distribution(complete(spark, sf).filter(F.col(TS) < F.lit("2024-01-23").cast("timestamp_ntz")))
    writers.write_json(drift.monitor(p, ref, ["period"]), path)
    return spark.read.json(path)


@query
def refresh_store(spark, sf):
    """Two refreshes of a store made from the trips as one monthly file; the second finds nothing to do."""
    root = shared.shared_folder(spark, "store")
    raw = trips(spark, sf).toDF(*readers.TRIP_MAPPING.values())
    raw.write.parquet(f"{root}/in/trips_2024-01.parquet")
    first = refresh.refresh(spark, f"{root}/in", f"{root}/out", zones(spark, sf), RULES)
    second = refresh.refresh(spark, f"{root}/in", f"{root}/out", zones(spark, sf), RULES)
    done = refresh.Store(spark, f"{root}/out").manifest()
    return done.select(_text("file_month"), "raw_rows", "rejected_date", "rejected_values", "rejected_zone", "kept_rows").withColumns(
        {"first_run": F.lit(len(first)), "second_run": F.lit(len(second))}
    )


@query
def refresh_gone(spark, sf):
    """Two refreshes with different months: February's files have gone in the second, January's have changed, March's are
    new. Trips outside the month of their file are date rejects."""
    root = shared.shared_folder(spark, "store")
    raw, cut = trips(spark, sf), F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    early = raw.filter(F.col("pickup_datetime") < cut).toDF(*readers.TRIP_MAPPING.values())
    late = raw.filter(F.col("pickup_datetime") >= cut).toDF(*readers.TRIP_MAPPING.values())
    for folder, month, part in (("first", "2024-01", early), ("first", "2024-02", late), ("second", "2024-01", late), ("second", "2024-03", early)):
        part.write.parquet(f"{root}/{folder}/trips_{month}.parquet")
    runs = [len(refresh.refresh(spark, f"{root}/{folder}", f"{root}/out", zones(spark, sf), RULES)) for folder in ("first", "second")]
    store = refresh.Store(spark, f"{root}/out")
    sound = refresh.check_manifest(store.manifest(), store.counts().filter("verdict = 'kept'"))
    done = store.manifest().join(sound, "file_month")
    return done.select(
        _text("file_month"), "raw_rows", "rejected_date", "rejected_values", "rejected_zone", "kept_rows",
        (F.col("kept_ok") & F.col("hours_ok") & F.col("raw_ok")).alias("ok"), F.lit(runs[0]).alias("first_run"), F.lit(runs[1]).alias("second_run"),
    )


def _text(name: str):
    return F.col(name).cast("string").alias(name)


def _order_inputs(orders: DataFrame) -> DataFrame:
    mark = F.concat_ws("-", F.count("*").cast("string"), F.sum("o_orderkey").cast("string"))
    return orders.groupBy(F.trunc("o_orderdate", "month").alias("file_month")).agg(mark.alias("fingerprint"))


@query
def stale_months(spark, sf):
    """Months whose orders changed after a manifest made in mid January 2000."""
    orders = fixture.table(spark, sf, "orders")
    old = orders.filter(F.col("o_orderdate") < F.lit("2000-01-16").cast("timestamp_ntz"))
    manifest = _order_inputs(old).withColumn("signature", F.lit("rules-1"))
    return refresh.stale_months(_order_inputs(orders), manifest, "rules-1").select(_text("file_month"), "fingerprint")


@query
def manifest_check(spark, sf):
    """A manifest of all orders against counts that stop in mid January 2000."""
    orders = fixture.table(spark, sf, "orders").withColumn("file_month", F.trunc("o_orderdate", "month"))
    status = F.col("o_orderstatus")
    manifest = orders.groupBy("file_month").agg(
        F.count("*").alias("raw_rows"),
        F.count_if(status == "F").alias("kept_rows"),
        F.count_if(status == "O").alias("rejected_date"),
        F.count_if(status == "P").alias("rejected_values"),
        F.lit(0).cast("bigint").alias("rejected_zone"),
    )
    counts = (
        orders.filter((status == "F") & (F.col("o_orderdate") < F.lit("2000-01-16").cast("timestamp_ntz")))
        .groupBy("file_month", F.col("o_custkey").alias("zone_id"), F.col("o_orderdate").alias(TS))
        .agg(F.count("*").alias("n"))
    )
    return refresh.check_manifest(manifest, counts).withColumn("file_month", _text("file_month"))


# ---- projections, filters, joins -----------------------------------------------------------


@query
def coerce_types(spark, sf):
    """Statuses and priorities read as numbers: only the leading digit of a priority parses."""
    orders = fixture.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("as_status"),
        F.substring("o_orderpriority", 1, 1).alias("as_digit"),
        F.col("o_orderpriority").alias("as_priority"),
    )
    return cleaning.coerce(orders, {"as_status": "double", "as_digit": "bigint", "as_priority": "double"})


@query
def filter_month(spark, sf):
    t = trips(spark, sf)
    return t.filter(cleaning.in_period(t, RULES)).select("pickup_datetime", "zone_id")


@query
def filter_values(spark, sf):
    return trips(spark, sf).filter(cleaning.valid_values(RULES)).select("zone_id", "trip_distance", "total_amount")


@query
def classify_trips(spark, sf):
    return cleaning.classify(trips(spark, sf), RULES, zones(spark, sf))


@query
def semi_join_zones(spark, sf):
    return cleaning.in_zones(trips(spark, sf), zones(spark, sf))


@query
def complete_rows(spark, sf):
    return complete(spark, sf).select("zone_id", TS, Y, "lag_168")


@query
def feature_status(spark, sf):
    """Panels with a negative hour, a gap of nine days or a doubled hour in three of five zones."""
    p, at = zone_panel(spark, sf), lambda text: F.lit(text).cast("timestamp_ntz")
    zone = F.col("zone_id") % 5
    y = F.when((zone == 0) & (F.col(TS) == at("2024-01-15 07:00:00")), F.lit(-1.0)).otherwise(F.col(Y).cast("double"))
    gap = (zone == 1) & F.col(TS).between(at("2024-01-10 00:00:00"), at("2024-01-19 04:00:00"))
    again = p.filter((zone == 2) & (F.col(TS) == at("2024-01-20 00:00:00")))
    broken = p.filter(~gap).unionByName(again).withColumn(Y, y)
    return feat.series_status(feat.features(broken, 1, KEYS, checked=True), KEYS)


@query
def short_fold(spark, sf):
    """Every third zone has too few rows before the first fold."""
    table = complete(spark, sf).filter((F.col("zone_id") % 3 != 0) | (F.col(TS) >= F.lit("2024-01-11 00:00:00").cast("timestamp_ntz")))
    cv_ = backtest.evaluate(table, CANDIDATES, PROTOCOL, KEYS)
    # Rounded before the choice, as scores that are equal on paper differ in the last digits.
    return rounded(backtest.select(rounded(cv_, 12), PROTOCOL, KEYS).select("zone_id", "candidate", "n_folds", "n_short", "MAE_mean", "selected"))


@query
def period_slice(spark, sf):
    return feat.period_slice(zone_panel(spark, sf), datetime(2024, 1, 10), datetime(2024, 1, 20, 12))


@query
def dense_panel(spark, sf):
    counts = cleaning.kept_counts(trips(spark, sf), zones(spark, sf), RULES, KEYS)
    grid = panel.hour_grid(counts, RULES.start, RULES.end, KEYS)
    return panel.densify(counts, grid, KEYS)


@query
def missing_hours(spark, sf):
    """Hours a zone has no raw record in."""
    seen = cleaning.observed_hours(cube(spark, sf), KEYS)
    grid = panel.hour_grid(seen, RULES.start, RULES.end, KEYS)
    return panel.missing_hours(seen, grid, RULES.zone, KEYS)


@query
def merge_partials(spark, sf):
    """Partial counts of each event type, added."""
    events = fixture.table(spark, sf, "events")
    z = zones(spark, sf)
    kinds = [F.col("event_type") == "click", F.col("event_type") != "click"]
    parts = [cleaning.kept_counts(fixture.event_trips(events.filter(k)), z, RULES, KEYS) for k in kinds]
    return cleaning.merge_partials(*parts, keys=KEYS)


@query
def lag_join(spark, sf):
    return windows.lags(zone_panel(spark, sf), [1, 24], KEYS, mode="join")


@query
def fold_assign(spark, sf):
    return backtest.assign_folds(zone_panel(spark, sf), PROTOCOL.folds)


@query
def period_assign(spark, sf):
    return backtest.assign_periods(zone_panel(spark, sf), PROTOCOL.periods)


@query
def improvement(spark, sf):
    return rounded(metrics.improvement(results(spark, sf), keys=KEYS))


@query
def ablation(spark, sf):
    return rounded(metrics.ablation(board(spark, sf), KEYS), 9)


# ---- aggregations ------------------------------------------------------------------------------


@query
def hourly_counts(spark, sf):
    return cleaning.hourly_counts(cube(spark, sf), KEYS)


@query
def audit(spark, sf):
    return cleaning.audit(cube(spark, sf), KEYS)


@query
def audit_city(spark, sf):
    return cleaning.audit(cube(spark, sf))


@query
def observed_hours(spark, sf):
    return cleaning.observed_hours(cube(spark, sf))


@query
def metrics_(spark, sf):
    return rounded(metrics.metrics(predictions(spark, sf), ["zone_id", "period"]))


@query
def business_loss(spark, sf):
    return rounded(metrics.business_loss(predictions(spark, sf), 3.0, 1.0, ["zone_id", "period"]))


@query
def cost_scenarios(spark, sf):
    return rounded(metrics.cost_scenarios(predictions(spark, sf), SCENARIOS, ["period"]))


@query
def leaderboard(spark, sf):
    return board(spark, sf)


@query
def interval_scores(spark, sf):
    """Fold scores of both interval methods for the day-ago forecast."""
    table = backtest.with_candidates(complete(spark, sf), CANDIDATES[1:2])
    roles = backtest.fold_roles(table.select(*KEYS, TS, Y, "candidate", "prediction"), PROTOCOL)
    return rounded(backtest.interval_cv(roles, PROTOCOL, KEYS))


@query
def error_segments(spark, sf):
    return rounded(metrics.error_segments(predictions(spark, sf)))


@query
def target_stats(spark, sf):
    return rounded(profile.target_stats(zone_panel(spark, sf), KEYS, single_series=True))


@query
def target_stats_city(spark, sf):
    return rounded(profile.target_stats(zone_panel(spark, sf)))


@query
def zero_missing(spark, sf):
    return rounded(profile.zero_missing(zone_panel(spark, sf), KEYS))


@query
def profiles(spark, sf):
    return rounded(profile.profiles(zone_panel(spark, sf), KEYS))


@query
def peak_trough(spark, sf):
    return rounded(profile.peak_trough(zone_panel(spark, sf), KEYS))


@query
def daily_resample(spark, sf):
    return profile.daily_resample(known_only(spark, sf), KEYS)


@query
def distinct_days(spark, sf):
    return profile.distinct_days(predictions(spark, sf), ["period"])


@query
def histogram(spark, sf):
    return rounded(profile.histogram(fixture.table(spark, sf, "events"), "value", 50, ["event_type"]))


@query
def residual_histogram(spark, sf):
    residual = predictions(spark, sf).withColumn("residual", F.col(Y) - F.col("prediction"))
    return rounded(profile.histogram(residual, "residual", 50, ["period"]))


@query
def autocorr(spark, sf):
    return rounded(profile.autocorr(zone_panel(spark, sf), (1, 24, 168), KEYS))


@query
def corr_matrix(spark, sf):
    return rounded(profile.corr_matrix(complete(spark, sf), [Y, *FEATURES]), 6)


@query
def periodogram(spark, sf):
    return rounded(spectrum.periodogram(city_panel(spark, sf)), 4)


@query
def periodogram_prime(spark, sf):
    """The first 661 hours: a prime length, transformed by a chirp."""
    p = city_panel(spark, sf)
    first = hour_index(TS) - hour_index(F.lit(RULES.start).cast("timestamp_ntz"))
    return rounded(spectrum.periodogram(p.filter(first < 661)), 4)


@query
def reference_bins(spark, sf):
    """Reference distribution of the event values per type, one row per bin."""
    events = fixture.table(spark, sf, "events")
    return rounded(drift.bin_table(drift.reference_distribution(events, ["event_type"], "value"), ["event_type"]))


def _halves(spark, sf):
    events = fixture.table(spark, sf, "events")
    mid = F.lit("2024-01-16").cast("timestamp_ntz")
    return events.filter(F.col("ts") < mid), events.filter(F.col("ts") >= mid)


@query
def psi(spark, sf):
    """Second half of the events against the first, per type."""
    before, after = _halves(spark, sf)
    by = ["event_type"]
    return rounded(drift.psi(after, drift.reference_distribution(before, by, "value"), by, by, "value"))


@query
def monitor(spark, sf):
    table = complete(spark, sf)
    fit, _, _ = backtest.final_slices(table, PROTOCOL)
    ref = drift.reference_distribution(fit, KEYS, single_series=True)
    out = drift.monitor(predictions(spark, sf), ref, ["zone_id", "period"], KEYS, max_mae=0.15)
    return rounded(out.withColumn("alerts", F.concat_ws(",", "alerts")))


@query
def cv_invariants(spark, sf):
    return metrics.check_cv(cv(spark, sf), 3, KEYS)


@query
def median_rounds(spark, sf):
    """Fold sizes of the errors stand in for boosting rounds."""
    rows = cv(spark, sf).withColumn("best_iteration", F.floor(F.round(F.col("MAE") * 100, 6)).cast("int"))
    return metrics.median_rounds(rows, KEYS)


@query
def overfit_gap(spark, sf):
    return rounded(metrics.overfit_gap(cv(spark, sf), KEYS))


# ---- windows, top-k ------------------------------------------------------------------------------


@query
def lags(spark, sf):
    return windows.lags(zone_panel(spark, sf), windows.lag_offsets(2), KEYS)


@query
def roll_mean(spark, sf):
    return rounded(windows.rolling(zone_panel(spark, sf), delay=2, stats=["mean"], keys=KEYS))


@query
def roll_std(spark, sf):
    return rounded(windows.rolling(zone_panel(spark, sf), delay=1, stats=["std"], keys=KEYS))


@query
def gap_check(spark, sf):
    """Gaps of the sparse counts."""
    return windows.gaps(cleaning.kept_counts(trips(spark, sf), zones(spark, sf), RULES, KEYS), KEYS)


@query
def interpolate(spark, sf):
    return rounded(windows.interpolate_linear(known_only(spark, sf), KEYS))


@query
def conformal_radius(spark, sf):
    _, calibration, _ = backtest.final_slices(complete(spark, sf), PROTOCOL)
    rows = calibration.withColumn("prediction", F.col("roll_mean_24"))
    return rounded(intervals.conformal_radii(rows, 0.1, KEYS))


@query
def conformal_radius_pooled(spark, sf):
    """One radius over all events: values against their type's mean would do, here against 50."""
    events = fixture.table(spark, sf, "events").select(F.col("value").alias(Y), F.lit(50.0).alias("prediction"))
    return rounded(intervals.conformal_radius(events, "scaled", 0.1))


@query
def mad_outliers(spark, sf):
    """Hours far from the median of their zone, at twice the deviation."""
    return rounded(ranks.mad_outliers(zone_panel(spark, sf), Y, KEYS, k=2.0))


@query
def mad_outliers_events(spark, sf):
    """Event values far from the median of their type."""
    events = fixture.table(spark, sf, "events").select("event_id", "event_type", "value")
    return rounded(ranks.mad_outliers(events, "value", ["event_type"], k=6.0))


@query
def stride_sample(spark, sf):
    return windows.stride_sample(zone_panel(spark, sf), 100, KEYS)


@query
def cyclic_shift(spark, sf):
    table = complete(spark, sf).select("zone_id", TS, Y, "lag_1", "lag_24", "roll_mean_3")
    return rounded(windows.cyclic_shift(table, ["lag_1", "lag_24"], 30, KEYS))


@query
def history_tail(spark, sf):
    return windows.history_tail(zone_panel(spark, sf), 168, KEYS)


@query
def zoom_head(spark, sf):
    """First day of each zone and period."""
    p = predictions(spark, sf).select("zone_id", "period", TS, Y, "prediction")
    return windows.head_per(p, ["zone_id", "period"], [TS], 24)


@query
def worst_hours(spark, sf):
    return metrics.worst_hours(predictions(spark, sf), 15, KEYS)


@query
def champion(spark, sf):
    return selection.champion(board(spark, sf), "MAE", keys=KEYS).select(
        "zone_id", "candidate", "MAE_mean", "n_features", "selected"
    )


@query
def interval_choice(spark, sf):
    per_fold = backtest.interval_cv(_day_roles(spark, sf), PROTOCOL, KEYS)
    summary = rounded(metrics.interval_summary(per_fold, KEYS), 9)
    return rounded(selection.choose_interval(summary, 0.1, KEYS), 9)


def _day_roles(spark, sf):
    table = backtest.with_candidates(complete(spark, sf), CANDIDATES[4:5])
    return backtest.fold_roles(table.select(*KEYS, TS, Y, "candidate", "prediction"), PROTOCOL)


@query
def best_per_family(spark, sf):
    marked = selection.champion(board(spark, sf), "MAE", keys=KEYS)
    return selection.best_per_family(marked, "MAE", KEYS).select(
        "zone_id", "family", "candidate", "MAE_mean", "selected"
    )


# ---- calendar and time ---------------------------------------------------------------------------


@query
def calendar(spark, sf):
    return cal.calendar(trips(spark, sf).select(F.col("pickup_datetime").alias(TS), "zone_id"))


@query
def cycles(spark, sf):
    base = trips(spark, sf).select(F.col("pickup_datetime").alias(TS))
    return rounded(cal.cycles(cal.calendar(base)))


@query
def holiday_flag(spark, sf):
    """Orders per day with the holiday flag."""
    days = day_orders(spark, sf).groupBy(TS).agg(F.count("*").alias("n"))
    return cal.holiday_flag(days)


@query
def dst_hours(spark, sf):
    """Clock-change hours on the days with orders."""
    hour = F.explode(F.sequence(F.lit(0), F.lit(23)))
    grid = day_orders(spark, sf).distinct().select(TS, hour.alias("h")).select((F.col(TS) + hours(F.col("h"))).alias(TS))
    return panel.dst_hours(grid, RULES.zone)


@query
def hour_grid(spark, sf):
    return panel.hour_grid(trips(spark, sf), RULES.start, RULES.end, KEYS)


# ---- data quality ---------------------------------------------------------------------------------


@query
def panel_violations(spark, sf):
    """The raw minutes of the trips taken for a panel: every check but the last ones finds something."""
    t = trips(spark, sf).select("zone_id", F.col("pickup_datetime").alias(TS), (F.col("trip_distance") - 50).alias(Y))
    return validation.panel_violations(t, KEYS)


@query
def sparse_violations(spark, sf):
    return validation.panel_violations(cleaning.kept_counts(trips(spark, sf), zones(spark, sf), RULES, KEYS), KEYS)


@query
def conservation(spark, sf):
    made = build(trips(spark, sf), zones(spark, sf), RULES, KEYS)
    return panel.conservation(made.counts(), made.audit(), made.dense())


def _spring_rules():
    """The fixture period sixty days later, which contains a clock change."""
    shift = timedelta(days=60)
    return Rules(RULES.start + shift, RULES.end + shift, RULES.max_distance, RULES.max_amount)


def spring_trips(spark, sf):
    return trips(spark, sf).withColumn("pickup_datetime", F.col("pickup_datetime") + hours(24 * 60))


@query
def dst_null_panel(spark, sf):
    return build_panel(spring_trips(spark, sf), zones(spark, sf), _spring_rules(), KEYS)


@query
def history_status(spark, sf):
    """Each zone's history between its first and last trip, for a target right after the last day."""
    p = zone_panel(spark, sf)
    seen = p.filter(F.col(Y) > 0).groupBy("zone_id").agg(F.min(TS).alias("a"), F.max(TS).alias("b"))
    history = p.join(seen, "zone_id").filter(F.col(TS).between(F.col("a"), F.col("b"))).drop("a", "b")
    return validation.history_status(history, "2024-01-29T22:00:00", 1, KEYS)


@query
def live_check(spark, sf):
    """Events read as UTC instants: for which of them is 12:00 on 15 January the current local hour?"""
    now = validation.current_hour(F.col("pickup_datetime"))
    target = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    out = trips(spark, sf).select(now.alias("current_hour"), (now == target).alias("ok"))
    return out.groupBy("current_hour", "ok").agg(F.count("*").alias("n"))


# ---- panels, forecasts, back-tests -----------------------------------------------------------------


@query
def build_panel_(spark, sf):
    return city_panel(spark, sf)


@query
def build_zone_panel(spark, sf):
    return zone_panel(spark, sf)


@query
def features(spark, sf):
    return rounded(zone_features(spark, sf))


@query
def features_city(spark, sf):
    return rounded(feat.features(city_panel(spark, sf), 1, chunk_hours=200))


@query
def features_spring(spark, sf):
    """Features around a clock change, with a delay of two hours."""
    return rounded(feat.complete_rows(feat.features(dst_null_panel(spark, sf), 2, KEYS)))


@query
def standardise(spark, sf):
    table = complete(spark, sf).select("zone_id", TS, "lag_1", "lag_168", "roll_mean_24")
    return rounded(feat.standardise(table, ["lag_1", "lag_168", "roll_mean_24"], KEYS))


@query
def weekly_naive(spark, sf):
    return windows.weekly_naive(zone_panel(spark, sf), KEYS)


def _radii(spark, sf):
    _, calibration, _ = backtest.final_slices(complete(spark, sf), PROTOCOL)
    return intervals.series_radii(calibration.withColumn("prediction", F.col("lag_168")), 0.1, KEYS, "scaled")


@query
def next_hour(spark, sf):
    model = forecast.naive_model(_radii(spark, sf), "2024-01-23", 1, KEYS)
    return rounded(forecast.forecast(zone_panel(spark, sf), model, "2024-01-30", KEYS))


@query
def inner_split(spark, sf):
    from dataclasses import replace

    return backtest.inner_split(complete(spark, sf), replace(PROTOCOL, delay=3), KEYS)


@query
def cv_naive(spark, sf):
    return rounded(cv(spark, sf))


@query
def final_naive(spark, sf):
    return rounded(results(spark, sf))


@query
def bounds(spark, sf):
    p = predictions(spark, sf)
    return rounded(p.select("zone_id", TS, "period", "prediction", "lower", "upper", "covered"))


@query
def group_importance(spark, sf):
    """A fixed linear forecast with every group shifted by fixed numbers of rows."""

    def predict(df):
        made = 0.5 * F.col("lag_24") + 0.3 * F.col("roll_mean_24") + 0.01 * F.col("hour")
        return df.withColumn("prediction", made)

    table = complete(spark, sf)
    return rounded(
        importance.group_importance(
            table, predict, ["hour", "lag_24", "roll_mean_24"], KEYS, shifts=[24, 37, 51]
        )
    )


@query
def findings(spark, sf):
    shared.checkpoint_root(spark)
    marked = selection.champion(board(spark, sf), "MAE", keys=KEYS).checkpoint()
    return rounded(report.findings(marked, results(spark, sf).checkpoint(), 0.1, KEYS))


# ---- models (no exact SQL form) -----------------------------------------------------------------


def _train(spark, sf):
    """Fit rows. Features look back only, so hours after the fit are not worked out."""
    panel = feat.period_slice(zone_panel(spark, sf), end=PROTOCOL.calibration.start)
    fit, _, _ = backtest.final_slices(feat.complete_rows(feat.features(panel, 1, KEYS)), PROTOCOL)
    return fit


def _scored(model, rows):
    out = model.transform(rows)
    return rounded(metrics.metrics(out, ["weekday"]))


@query
def ridge(spark, sf):
    model = models.fit_ridge(_train(spark, sf), FEATURES, 10.0)
    return _scored(model, _tests(spark, sf))


def _tests(spark, sf):
    return backtest.final_slices(complete(spark, sf), PROTOCOL)[2]


@query
def ridge_coefficients(spark, sf):
    train = _train(spark, sf)
    return rounded(importance.coefficients(models.fit_ridge(train, FEATURES, 10.0), train))


def _last_fold(spark, sf):
    """Rows of the last fold with their parts, stored: a fit reads them many times."""
    shared.checkpoint_root(spark)
    return backtest.fold_roles(complete(spark, sf), PROTOCOL).filter(F.col("fold") == PROTOCOL.folds[-1].name).checkpoint()


def _stopped_gbt(spark, sf):
    """A fit bounded at 1,500 rounds, which stops by itself, and the rows of its fold."""
    rows = _last_fold(spark, sf)
    parts = {"early": rows.filter("is_early"), "core": rows.filter("is_core")}
    model, best = models.fit_gbt(rows.filter("is_fit"), FEATURES, {"maxDepth": 3}, **parts, rounds=PROTOCOL.max_trees, patience=ROUNDS_WITHOUT_GAIN)
    return model, best, rows


@query
def gbt(spark, sf):
    model, best, rows = _stopped_gbt(spark, sf)
    return _scored(model, rows.filter("is_valid")).withColumn("rounds", F.lit(best))


@query
def quantile_boost(spark, sf):
    """As `gbt`, for the 0.75 quantile, with a share of the rows a round."""
    rows = _last_fold(spark, sf)
    parts = {"early": rows.filter("is_early"), "core": rows.filter("is_core")}
    params = {"maxDepth": 3, "minInstancesPerNode": 30, "subsamplingRate": 0.8}
    model, best = models.fit_quantile(
        rows.filter("is_fit"), FEATURES, 0.75, PROTOCOL.max_trees, params=params, **parts, patience=ROUNDS_WITHOUT_GAIN
    )
    return _scored(model, rows.filter("is_valid")).withColumn("rounds", F.lit(best))


@query
def search_ridge(spark, sf):
    table = complete(spark, sf).persist()
    trials = models.search(table, "Ridge", feat.feature_sets(1)["lags"], PROTOCOL)
    table.unpersist()
    return rounded(models.trials_frame(spark, trials, "Ridge"))


@query
def ablation_ridge(spark, sf):
    """One penalty with each of the three feature sets, on all folds."""
    table = complete(spark, sf).persist()
    rows = None
    for spec in models.ablation_specs("Ridge", {"alpha": 10.0}, feat.feature_sets(1)):
        part, _ = models.back_test(table, spec, PROTOCOL)
        rows = part if rows is None else rows.unionByName(part)
    return rounded(metrics.ablation(metrics.leaderboard(rows)))


@query
def gain(spark, sf):
    model, _, _ = _stopped_gbt(spark, sf)
    return rounded(importance.gain_importance(model, FEATURES, spark))


@query
def top_features(spark, sf):
    model, _, _ = _stopped_gbt(spark, sf)
    return rounded(importance.top_features(importance.gain_importance(model, FEATURES, spark), "gain"))


@query
def perm_importance(spark, sf):
    """Shuffled features of a fixed linear forecast."""

    def predict(df):
        return df.withColumn("prediction", 0.5 * F.col("lag_24") + 0.3 * F.col("roll_mean_24"))

    cols = ["lag_24", "roll_mean_24", "hour"]
    return rounded(importance.permutation_importance(complete(spark, sf), predict, cols, KEYS))


# ---- streams ---------------------------------------------------------------------------------------


def _stream(spark, sf):
    schema = fixture.table(spark, sf, "events").schema
    return fixture.event_trips(hourly.trip_stream(spark, sf, schema, files="events.parquet"))


@query
def stream_hourly(spark, sf):
    root = shared.shared_folder(spark, "stream-hourly")
    counts = hourly.stream_hourly(_stream(spark, sf), RULES, zones(spark, sf), 1, KEYS)
    return hourly.run_to_table(counts, f"{root}/out", f"{root}/state")


@query
def stream_audit(spark, sf):
    """Raw trips per verdict and closed hour; all date rejects, which have no hour."""
    root = shared.shared_folder(spark, "stream-audit")
    counts = hourly.stream_audit(_stream(spark, sf), RULES, zones(spark, sf), 1)
    rows = hourly.run_to_table(counts, f"{root}/out", f"{root}/state")
    return rows.groupBy("verdict", TS).agg(F.sum("n").alias("n"))


@query
def late_rows(spark, sf):
    """Hours a stream has not closed yet, as difference to the batch counts."""
    batch = cleaning.kept_counts(trips(spark, sf), zones(spark, sf), RULES, KEYS)
    return hourly.late_rows(batch, stream_hourly(spark, sf), KEYS)


@query
def stream_monitor(spark, sf):
    """Predictions arrive as files, several micro-batches of them; the sums of all make the rows."""
    root = shared.shared_folder(spark, "stream-monitor")
    predictions(spark, sf).repartition(4, "zone_id").write.parquet(f"{root}/in")
    shared.checkpoint_root(spark)
    ref = drift.reference_distribution(_train(spark, sf)).checkpoint()
    reader = spark.readStream.schema(spark.read.parquet(f"{root}/in").schema).option("maxFilesPerTrigger", 2)
    hourly.run_batches(reader.parquet(f"{root}/in"), hourly.monitor_batch(ref, f"{root}/out"), f"{root}/state")
    out = hourly.merged_monitor(spark, f"{root}/out", ref, max_mae=0.15)
    return rounded(out.withColumn("alerts", F.concat_ws(",", "alerts")))


@query
def stream_forecast(spark, sf):
    """Closed hours arrive as files, a day of them at once; every one of them gives a forecast."""
    root = shared.shared_folder(spark, "stream-forecast")
    p = zone_panel(spark, sf)
    cut = F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
    month = F.date_trunc("month", TS).cast("date")
    p.filter(F.col(TS) < cut).withColumn("month", month).write.partitionBy("month").parquet(f"{root}/stored")
    p.filter(F.col(TS) >= cut).write.parquet(f"{root}/in")
    _radii(spark, sf).write.parquet(f"{root}/radii")
    model = forecast.naive_model(spark.read.parquet(f"{root}/radii"), "2024-01-23", 1, KEYS)
    stream = spark.readStream.schema(p.schema).parquet(f"{root}/in")
    write = hourly.forecast_batch(hourly.stored_since(spark, f"{root}/stored"), model, f"{root}/out", KEYS)
    hourly.run_batches(stream, write, f"{root}/state")
    return rounded(spark.read.parquet(f"{root}/out").drop("batch"))
