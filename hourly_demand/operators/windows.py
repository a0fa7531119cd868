"""Time windows over long series.

A window over a whole series would put the series in one task. Here every series is cut into
chunks of `chunk_hours`, and the rows a later chunk looks back at are copied into it (its halo).
Windows are then partitioned by series and chunk, and the copies are dropped afterwards. The rows
grow by reach / chunk_hours, about a tenth with the defaults.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import TS, Y, check_delay
from ..functions.time import floor_hour, hour_index, hours
from ..sources.shared import checkpoint_root
from .groups import attach, null_safe_join, unbroadcast
from .panel import task_count

CHUNK_HOURS = 2016
UNTIMED_CHUNKS = 256
WINDOWS = (3, 24, 168)
#: Rows of a block, the unit that deviations are put together from.
BLOCK = 24


def lag_offsets(delay: int) -> list[int]:
    """Offsets of the lag features; offsets that coincide appear once."""
    return sorted({check_delay(delay), delay + 1, delay + 2, 24, 168})


class Chunks:
    """A panel cut into chunks that each see `reach` earlier hours."""

    def __init__(
        self, df: DataFrame, reach: int, keys: Sequence[str] = (), chunk_hours: int = CHUNK_HOURS, untimed: bool = False
    ):
        idx = hour_index(TS)
        first = F.floor(idx / chunk_hours)
        last = F.floor((idx + reach) / chunk_hours)
        chunks = F.sequence(first, last)
        own = F.col("_chunk") == F.floor(F.col("_i") / chunk_hours)
        if untimed:
            # Rows without a time are kept in chunks of their own, dealt out so that many make no hot chunk.
            aside = -1 - F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(UNTIMED_CHUNKS))
            chunks, own = F.when(idx.isNull(), F.array(aside)).otherwise(chunks), F.col("_i").isNull() | own
        self.df = (
            df.withColumn("_i", idx)
            .withColumn("_chunk", F.explode(chunks))
            .withColumn("_own", own)
            .withColumn("_block", F.floor(F.col("_i") / BLOCK))
        )
        # Blocks follow from the hour; named in the order, so that windows over blocks need no sort of their own.
        self.window = Window.partitionBy(*keys, "_chunk").orderBy("_block", "_i")

    def own(self, df: DataFrame) -> DataFrame:
        """Drops the copies and the working columns."""
        extra = [c for c in df.columns if c.startswith("_")]
        return df.filter("_own").drop(*extra)


class _Past:
    """Rows a fixed number of rows earlier, each fetched once as a struct however many values are read of it.

    `made` are the window columns, `means` the columns made from them that others are made from.
    """

    def __init__(self, window, columns: Sequence[str]):
        self.window, self.columns, self.made, self.means = window, columns, {}, {}

    def __call__(self, k: int) -> Column:
        self.made.setdefault(f"_past_{k}", F.lag(F.struct(*self.columns), k).over(self.window))
        return F.col(f"_past_{k}")

    def value(self, name: str, k: int) -> Column:
        """Value exactly k hours earlier; NULL where that hour is absent."""
        return F.when(F.col("_i") - self(k)["_i"] == k, self(k)[name])


def _with_sums(df: DataFrame, w) -> DataFrame:
    """Running count and sum within the chunk; NaN counts as missing.

    They turn each trailing mean into two look-ups, so its cost does not depend on its length.
    """
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.col(Y).cast("double")
    df = df.withColumn("_y", F.when(~F.isnan(known), known))
    return df.withColumns({"_n": F.count("_y").over(running), "_s": F.coalesce(F.sum("_y").over(running), F.lit(0.0))})


def _merged(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> tuple[Column, Column, Column]:
    """Count, mean and sum of squared distances from it, of two sets of rows together."""
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * b[0] / n, a[2] + b[2] + gap * gap * a[0] * b[0] / n


def _spread(column: str) -> tuple[Column, Column, Column]:
    return tuple(F.col(column)[f] for f in ("n", "mean", "m2"))


def _with_blocks(df: DataFrame, keys: Sequence[str], w) -> DataFrame:
    """`_day`: count, mean and sum of squared distances of the BLOCK rows up to each row.

    Rows fall into blocks by hour. The rows up to a row are the end of the block before it and the
    beginning of its own; each is aggregated from its own rows, and two are merged. Nothing is the
    difference of two long sums, so a change of level far away costs no digits.
    """
    block = Window.partitionBy(*keys, "_chunk", "_block").orderBy("_i")

    def summary(frame) -> Column:
        n = F.count("_y").over(frame)
        return F.struct(n.alias("n"), F.avg("_y").over(frame).alias("mean"), (F.var_pop("_y").over(frame) * n).alias("m2"))

    df = df.withColumns(
        {
            "_head": summary(block.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_tail": summary(block.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    ).withColumn("_before", F.lag("_tail", BLOCK - 1).over(w))
    both = _merged(_spread("_before"), _spread("_head"))
    day = F.struct(*[v.alias(f) for v, f in zip(both, ("n", "mean", "m2"), strict=True)])
    # The last row of a block has all its rows in the block.
    return df.withColumn("_day", F.when(F.col("_i") % BLOCK == BLOCK - 1, F.col("_head")).otherwise(day)).drop("_head", "_tail", "_before")


def _trailing_std(window: int, delay: int, w, past: _Past) -> Column:
    """Population deviation of the `window` rows up to `delay` rows ago, if none of them is unknown."""
    days, rest = divmod(window, BLOCK)
    parts = [tuple(past(delay + BLOCK * d)["_day"][f] for f in ("n", "mean", "m2")) for d in range(days)]
    if rest:
        last = delay + BLOCK * days
        frame = w.rowsBetween(-(last + rest - 1), -last)
        past.made[f"_rest_{window}"] = F.struct(
            F.count("_y").over(frame).alias("n"), F.avg("_y").over(frame).alias("mean"), F.var_pop("_y").over(frame).alias("v")
        )
        left = F.col(f"_rest_{window}")
        parts.append((left["n"], left["mean"], left["v"] * left["n"]))
    if len(parts) == 1:
        squares = parts[0][2]
    else:
        # The mean of all is a column of its own: merged one by one, each part would be written out anew in every later one.
        size, first = sum((n for n, _, _ in parts[1:]), parts[0][0]), parts[0][1]
        past.means[f"_mean_{window}"] = first + sum((n * (mean - first) for n, mean, _ in parts[2:]), parts[1][0] * (parts[1][1] - first)) / size
        gaps = [mean - F.col(f"_mean_{window}") for _, mean, _ in parts]
        squares = sum((m2 + n * gap * gap for (n, _, m2), gap in zip(parts[1:], gaps[1:], strict=True)), parts[0][2] + parts[0][0] * gaps[0] * gaps[0])
    return F.sqrt(F.greatest(F.lit(0.0), squares) / window)


def _trailing(window: int, delay: int, w, past: _Past, stats: Sequence[str]) -> dict[str, Column]:
    newest, before, oldest = past(delay), past(delay + window), past(delay + window - 1)
    count = newest["_n"] - F.coalesce(before["_n"], F.lit(0))
    full = (F.col("_i") - oldest["_i"] == delay + window - 1) & (count == window)
    made = {}
    if "mean" in stats:
        made["mean"] = F.when(full, (newest["_s"] - F.coalesce(before["_s"], F.lit(0.0))) / window)
    if "std" in stats:
        made["std"] = F.when(full, _trailing_std(window, delay, w, past))
    return made


def lags(
    panel: DataFrame,
    offsets: Sequence[int],
    keys: Sequence[str] = (),
    mode: str = "window",
    chunk_hours: int = CHUNK_HOURS,
) -> DataFrame:
    """Adds lag_k for each offset, by windows or by joining the panel to itself on time."""
    if mode == "join":
        out = panel
        for k in offsets:
            past = panel.select(*keys, (F.col(TS) + hours(k)).alias(TS), F.col(Y).alias(f"lag_{k}"))
            out = out.join(unbroadcast(past), [*keys, TS], "left")
        return out
    if mode != "window":
        raise ValueError("mode must be 'window' or 'join'")
    chunks = Chunks(panel, max(offsets), keys, chunk_hours)
    past = _Past(chunks.window, ["_i", Y])
    made = {f"lag_{k}": past.value(Y, k) for k in offsets}
    return chunks.own(chunks.df.withColumns(past.made).withColumns(made))


def rolling(
    panel: DataFrame,
    windows: Sequence[int] = WINDOWS,
    delay: int = 1,
    stats: Sequence[str] = ("mean", "std"),
    keys: Sequence[str] = (),
    chunk_hours: int = CHUNK_HOURS,
) -> DataFrame:
    """Adds delayed trailing means and population deviations over full windows without NULL."""
    chunks = Chunks(panel, max(windows) + delay - 1, keys, chunk_hours)
    return chunks.own(_with_past(chunks, keys, (), windows, delay, stats))


def _with_past(
    chunks: Chunks,
    keys: Sequence[str],
    offsets: Sequence[int],
    windows: Sequence[int],
    delay: int,
    stats: Sequence[str],
    row_columns: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The chunks with lags and trailing windows."""
    out = _with_sums(chunks.df, chunks.window)
    columns = ["_i", Y, "_n", "_s"]
    if "std" in stats and max(windows) >= BLOCK:
        out = _with_blocks(out, keys, chunks.window)
        columns.append("_day")
    if row_columns is not None:
        out = row_columns(out)
    past = _Past(chunks.window, columns)
    made = {f"lag_{k}": past.value(Y, k) for k in offsets}
    for size in windows:
        for stat, column in _trailing(size, delay, chunks.window, past, stats).items():
            made[f"roll_{stat}_{size}"] = column
    out = out.withColumns(past.made)
    return (out.withColumns(past.means) if past.means else out).withColumns(made)


def lags_and_rolling(
    panel: DataFrame,
    delay: int = 1,
    keys: Sequence[str] = (),
    windows: Sequence[int] = WINDOWS,
    chunk_hours: int = CHUNK_HOURS,
    row_columns: Callable[[DataFrame], DataFrame] | None = None,
    checked: bool = False,
) -> DataFrame:
    """Lag and trailing-window features with one shuffle and one sort.

    `row_columns` adds columns that depend on the row alone. They are made between the two window
    steps: after the shuffle, so they do not travel, and in a generated method of their own, since
    one method for all features would be too long for the JIT compiler.
    """
    offsets = lag_offsets(delay)
    chunks = Chunks(panel, max(max(offsets), max(windows) + delay - 1), keys, chunk_hours, checked)
    if checked:
        chunks.df = chunks.df.withColumn("violation", _violation(chunks.window))
    return chunks.own(_with_past(chunks, keys, offsets, windows, delay, ("mean", "std"), row_columns))


def _violation(w) -> Column:
    """How a row breaks the contract, from the row itself and the one before it. A NULL target is a known gap."""
    y, step = F.col(Y).cast("double"), F.col("_i") - F.lag("_i").over(w)
    return (
        F.when(F.col("_i").isNull(), "no_time")
        .when(step == 0, "duplicate_hour")
        .when(F.col(TS) != floor_hour(TS), "off_hour")
        .when(F.isnan(y) | (F.abs(y) == float("inf")), "not_finite")
        .when(y < 0, "negative")
        .when(step > 1, "missing_hour")
    )


def gaps(panel: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per series: rows, distinct hours, hours expected between first and last, and the shortfall."""
    idx = hour_index(TS)
    per_hour = panel.groupBy(*keys, TS).agg(F.count("*").alias("_rows"))
    out = per_hour.groupBy(*keys).agg(
        F.sum("_rows").alias("n_rows"),
        F.count("*").alias("n_hours"),
        (F.max(idx) - F.min(idx) + 1).cast("bigint").alias("n_expected"),
    )
    return out.withColumn("n_missing", F.col("n_expected") - F.col("n_hours"))


def interpolate_linear(
    panel: DataFrame, keys: Sequence[str] = (), out: str = "filled", chunk_hours: int = CHUNK_HOURS
) -> DataFrame:
    """Fills NULL targets linearly in time; both ends take the nearest known value.

    Known neighbours are searched inside the chunk first. What a chunk cannot answer comes from
    the first and last known points of the other chunks, one summary row per chunk. The summaries are
    stored, which runs jobs; their counts size the shuffle of the rows.
    """
    base = panel.withColumn("_i", hour_index(TS)).withColumn("_chunk", F.floor(F.col("_i") / chunk_hours))
    point = F.when(F.col(Y).isNotNull(), F.struct(F.col("_i").alias("i"), F.col(Y).cast("double").alias("v")))
    base = base.withColumn("_point", point)
    per_chunk = (
        base.groupBy(*keys, "_chunk")
        .agg(F.min("_point").alias("_first"), F.max("_point").alias("_last"), F.count("*").alias("_rows"))
    )
    checkpoint_root(panel.sparkSession)
    per_chunk = per_chunk.checkpoint()
    width = task_count(panel.sparkSession, per_chunk.agg(F.sum("_rows")).first()[0] or 0)
    # Looking ahead is looking back in descending order; a frame that ends at the last row would be
    # evaluated again for every row.
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(
        *keys,
        "_chunk",
        F.last("_last", ignorenulls=True).over(earlier).alias("_carry_prev"),
        F.last("_first", ignorenulls=True).over(later).alias("_carry_next"),
    )
    back = Window.partitionBy(*keys, "_chunk").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys, "_chunk").orderBy(F.desc("_i")).rowsBetween(Window.unboundedPreceding, 0)
    found = base.repartition(width, *keys, "_chunk").join(carried, [*keys, "_chunk"]).withColumns(
        {
            "_prev": F.coalesce(F.last("_point", ignorenulls=True).over(back), F.col("_carry_prev")),
            "_next": F.coalesce(F.last("_point", ignorenulls=True).over(ahead), F.col("_carry_next")),
        }
    )
    prev, follow = F.col("_prev"), F.col("_next")
    share = (F.col("_i") - prev["i"]) / (follow["i"] - prev["i"])
    filled = (
        F.when(F.col(Y).isNotNull(), F.col(Y).cast("double"))
        .when(prev.isNull(), follow["v"])
        .when(follow.isNull(), prev["v"])
        .otherwise(prev["v"] + (follow["v"] - prev["v"]) * share)
    )
    return found.select(*panel.columns, filled.alias(out))


def positions(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = TS,
    name: str = "pos",
    total: str | None = None,
    chunk_hours: int = CHUNK_HOURS,
) -> DataFrame:
    """Zero-based position of each row in the time order of its series, numbered chunk by chunk.

    The time must be unique in a series. `total` also adds the number of rows of the series.
    """
    base = df.withColumn("_chunk", F.floor(hour_index(ts) / chunk_hours))
    sizes = base.groupBy(*keys, "_chunk").agg(F.count("*").alias("_c"))
    series = Window.partitionBy(*keys)
    before = series.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *keys,
        "_chunk",
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"),
        *([F.sum("_c").over(series).alias(total)] if total else []),
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(ts)
    return (
        null_safe_join(base, starts, [*keys, "_chunk"])
        .withColumn(name, F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_chunk", "_start")
    )


def stride_sample(df: DataFrame, target_n: int, keys: Sequence[str] = (), ts: str = TS) -> DataFrame:
    """Every s-th row in time order, s = max(1, n div target_n), per series."""
    numbered = positions(df, keys, ts, "_pos", "_rows")
    step = F.greatest(F.lit(1), F.floor(F.col("_rows") / target_n))
    return numbered.filter(F.col("_pos") % step == 0).drop("_rows", "_pos")


def cyclic_shift(
    df: DataFrame, cols: Sequence[str], shift: int, keys: Sequence[str] = (), ts: str = TS
) -> DataFrame:
    """Moves a block of columns `shift` rows down, wrapping around, so their joint values stay together."""
    numbered = positions(df, keys, ts, "_pos", "_rows")
    moved = numbered.select(*keys, ((F.col("_pos") + shift) % F.col("_rows")).alias("_pos"), *cols)
    return numbered.drop(*cols, "_rows").join(unbroadcast(moved), [*keys, "_pos"]).select(*df.columns)


def history_tail(panel: DataFrame, n_hours: int = 168, keys: Sequence[str] = ()) -> DataFrame:
    """The last hours of each series."""
    ends = panel.groupBy(*keys).agg(F.max(TS).alias("_end"))
    return attach(panel, ends, keys).filter(F.col(TS) > F.col("_end") - hours(n_hours)).drop("_end")


def head_per(df: DataFrame, by: Sequence[str], order_by: Sequence[str | Column], n: int) -> DataFrame:
    """First n rows of each group; the limit is applied before the shuffle as well."""
    w = Window.partitionBy(*by).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def top_n(df: DataFrame, order_by: Sequence[str | Column], n: int) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def weekly_naive(panel: DataFrame, keys: Sequence[str] = (), name: str = "prediction") -> DataFrame:
    """Seasonal-naive forecast: the value one week earlier."""
    return lags(panel, [168], keys).withColumnRenamed("lag_168", name)

