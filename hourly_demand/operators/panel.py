"""Gap-free hourly panels."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import TS, Y
from ..functions.time import hours, is_dst_hour, ntz

#: Hours of a panel that one task works on. They shrink to little when written for a shuffle, so sizes of shuffles say little.
ROWS_PER_TASK = 100_000


def hour_grid(
    source: DataFrame | SparkSession, start: datetime, end: datetime, keys: Sequence[str] = ()
) -> DataFrame:
    """Every hour of [start, end) for every series of `source`.

    Hours are generated per row on the executors; nothing is collected and nothing is joined.
    """
    steps = F.sequence(ntz(start), ntz(end - timedelta(hours=1)), F.expr("INTERVAL '1' HOUR"))
    if keys:
        series = source.select(*keys).distinct()
    else:
        spark = source if isinstance(source, SparkSession) else source.sparkSession
        series = spark.range(1)
    return series.select(*keys, F.explode(steps).alias(TS))


def task_count(spark: SparkSession, rows: int) -> int:
    """Number of partitions for a shuffle of `rows` hours, so that a task gets some ROWS_PER_TASK.

    Always above Spark's own number: Spark drops a repartition that equals the shuffle of a join below it,
    and would then merge the partitions of that join for their small counts.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")) + 1, -(-rows // ROWS_PER_TASK))


def densify(counts: DataFrame, grid: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts on the grid with zero for absent hours; counts off the grid are dropped."""
    return grid.join(counts, [*keys, TS], "left").withColumn(Y, F.coalesce(F.col(Y), F.lit(0)).cast("bigint"))


def fill_hours(
    counts: DataFrame,
    start: datetime,
    end: datetime,
    keys: Sequence[str] = (),
    series: DataFrame | None = None,
) -> DataFrame:
    """Same panel as `densify` without joining a grid, from final or partial counts.

    One series, or the series listed in `series`: zeros are appended and summed in, which adds
    nothing to the shuffle of the counts. Series found in the counts: each counted hour also
    emits the empty hours up to the next one. The window of that step holds at most one row per
    hour of the period. The series are counted first, which runs a job: the hours of one task are
    bounded, whatever the number of series.
    """
    inside = counts.filter((F.col(TS) >= ntz(start)) & (F.col(TS) < ntz(end))).select(
        *keys, TS, F.col(Y).cast("bigint").alias(Y)
    )
    if not keys or series is not None:
        grid = hour_grid(inside.sparkSession if series is None else series, start, end, keys)
        zeros = grid.withColumn(Y, F.lit(0).cast("bigint"))
        return inside.unionByName(zeros).groupBy(*keys, TS).agg(F.sum(Y).alias(Y))
    w = Window.partitionBy(*keys).orderBy(TS)
    # The rows multiply after this shuffle, so its partitions must not be merged for being small.
    series_found = inside.agg(F.approx_count_distinct(F.xxhash64(*keys))).first()[0]
    span = int((end - start) / timedelta(hours=1))
    final = inside.groupBy(*keys, TS).agg(F.sum(Y).alias(Y)).repartition(task_count(inside.sparkSession, series_found * span), *keys)
    spans = final.withColumn("_from", F.when(F.lag(TS).over(w).isNull(), ntz(start)).otherwise(F.col(TS))).withColumn(
        "_to", F.coalesce(F.lead(TS).over(w), ntz(end)) - hours(1)
    )
    steps = F.sequence("_from", "_to", F.expr("INTERVAL '1' HOUR"))
    return spans.withColumn("_hour", F.explode(steps)).select(
        *keys,
        F.col("_hour").alias(TS),
        F.when(F.col("_hour") == F.col(TS), F.col(Y)).otherwise(F.lit(0)).cast("bigint").alias(Y),
    )


def dst_hours(grid: DataFrame, zone: str) -> DataFrame:
    """Distinct hours of the grid that do not exist or exist twice in the zone."""
    return grid.select(TS).filter(is_dst_hour(TS, zone)).distinct()


def null_dst(
    panel: DataFrame, zone: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Target becomes NULL in clock-change hours, even where trips were counted.

    With the range of the panel, the few clock-change hours in it are found once and joined; they
    are a handful per year. Without it, every row is tested.
    """
    y = F.col(Y).cast("double")
    if start is None or end is None:
        return panel.withColumn(Y, F.when(~is_dst_hour(TS, zone), y))
    changes = dst_hours(hour_grid(panel.sparkSession, start, end), zone).withColumn("_change", F.lit(True))
    marked = panel.join(F.broadcast(changes), TS, "left")
    return marked.select(*[F.when(F.col("_change").isNull(), y).alias(Y) if c == Y else F.col(c) for c in panel.columns])


def missing_hours(observed: DataFrame, grid: DataFrame, zone: str, keys: Sequence[str] = ()) -> DataFrame:
    """Grid hours without any raw record, apart from clock-change hours."""
    return grid.filter(~is_dst_hour(TS, zone)).join(observed, [*keys, TS], "left_anti")


def conservation(counts: DataFrame, audits: DataFrame, panel: DataFrame) -> DataFrame:
    """Trips in the sparse counts, the audit and the panel; the three totals must agree.

    The panel must not have lost its clock-change hours yet.
    """
    a = counts.agg(F.sum(Y).cast("bigint").alias("counted"))
    b = audits.agg(F.sum("kept_rows").cast("bigint").alias("kept"))
    c = panel.agg(F.sum(Y).cast("bigint").alias("in_panel"))
    # Three one-row aggregates side by side.
    out = a.select("counted", b.scalar().alias("kept"), c.scalar().alias("in_panel"))
    return out.withColumn("ok", (F.col("counted") == F.col("kept")) & (F.col("counted") == F.col("in_panel")))
