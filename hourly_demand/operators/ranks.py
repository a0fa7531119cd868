"""Exact order statistics without gathering a group in one task.

A value is mapped to a numbered slot by a monotone function of the value alone. There are some
thousand slots per group at most, whatever the number of rows, so a running sum over their counts
finds the slot that holds a rank. A slot that holds too many rows, not all of one value, is cut again
into equal parts between its own smallest and largest value, and again, level by level: each level is
one more aggregation over the rows of crowded slots only. Smallest and largest value fall into different
parts, so every level makes a range smaller. In the end the distinct values of at most CROWDED rows
are ordered for a rank.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .groups import attach, null_safe_join, sized

# Slots per doubling of the value. Fewer with groups, so that the counts per group and slot stay far
# fewer than the rows.
SLOTS_GLOBAL = 1024
SLOTS_GROUPED = 64
#: Rows of a range that are ordered in one task, and parts that a larger range is cut into.
CROWDED = 8192
PARTS = 1024


def _slot(v: Column, per_octave: int) -> Column:
    size = F.log2(F.lit(1.0) + F.abs(v) * 1024) * per_octave
    # Never NULL, so that the join on it adds no filter.
    return F.coalesce(F.floor(F.signum(v) * size), F.lit(0))


def _known_values(df: DataFrame, value: str, by: Sequence[str], weight: str | None) -> DataFrame:
    """Rows (by, _v, _w) whose value is known."""
    known = F.col("_v").isNotNull() & ~F.isnan("_v")
    size = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    return df.select(*by, F.col(value).cast("double").alias("_v"), size.alias("_w")).filter(known)


def select_ranks(
    df: DataFrame,
    value: str,
    ranks: dict[str, Callable[[Column], Column]],
    by: Sequence[str] = (),
    count_name: str = "n",
    weight: str | None = None,
) -> DataFrame:
    """Per group, the value at each 1-based rank in ascending order.

    Missing values are ignored, a NULL in `by` is a group of its own. `ranks` maps an output column to a
    function from the number of values to the wanted rank. A rank outside 1..n gives NULL. With
    `weight`, a row stands for that many equal values.

    The rows are read once to count the slots, which shuffles only the counts, once more for every
    level of crowded ranges (most inputs have none), and once to fetch the values of the ranges that
    hold a wanted rank. Equal values are merged before they are ordered. All but the last run at once.
    """
    by = list(by)
    rows = _known_values(df, value, by, weight).withColumn(
        "_slot", _slot(F.col("_v"), SLOTS_GROUPED if by else SLOTS_GLOBAL)
    )
    targets = _located(rows, ranks, by)
    in_range = Window.partitionBy(*by, "_name").orderBy("_v")
    return (
        _in_range(rows, targets, by)
        .groupBy(*by, "_name", "_n", "_below", "_rank", "_v")
        .agg(F.sum("_w").alias("_c"))
        .withColumn("_upto", F.col("_below") + F.sum("_c").over(in_range))
        .filter(F.col("_upto") >= F.col("_rank"))
        .groupBy(*by)
        .agg(
            F.max("_n").alias(count_name),
            *[F.min(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in ranks],
        )
    )


def _range_size() -> list[Column]:
    return [F.sum("_w").alias("_c"), F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]


def _in_range(rows: DataFrame, targets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of each target's range. Small targets are broadcast and drop all other rows on the scan."""
    wanted = targets.drop("_c", "_rows")
    return null_safe_join(rows, wanted, [*by, "_slot"]).filter((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))


def _located(rows: DataFrame, ranks: dict[str, Callable[[Column], Column]], by: list[str]) -> DataFrame:
    """A row per group and wanted rank: the range (_slot, _lo to _hi) that holds it, the values below the
    range, and those in it: at most CROWDED rows, or one value."""
    per_group = Window.partitionBy(*by)
    slots = (
        rows.groupBy(*by, "_slot")
        .agg(*_range_size())
        .withColumn("_n", F.sum("_c").over(per_group))
        .withColumn("_below", F.sum("_c").over(per_group.orderBy("_slot")) - F.col("_c"))
    )
    # Rank 1 exists in every group, so that a group without the wanted ranks still has its row.
    wanted = [F.struct(F.lit("_lowest").alias("name"), F.lit(1).cast("bigint").alias("rank"))]
    wanted += [
        F.struct(F.lit(name).alias("name"), rank(F.col("_n")).cast("bigint").alias("rank"))
        for name, rank in ranks.items()
    ]
    kept = [*by, "_slot", "_n", "_below", "_c", "_rows", "_lo", "_hi"]
    holds = (F.col("_rank") > F.col("_below")) & (F.col("_rank") <= F.col("_below") + F.col("_c"))
    targets = slots.select(*kept, F.inline(F.array(*wanted)).alias("_name", "_rank")).filter(holds)
    while True:
        targets = sized(targets)
        too_many = (F.col("_rows") > CROWDED) & (F.col("_lo") < F.col("_hi"))
        crowded = targets.filter(too_many)
        if crowded.isEmpty():
            return targets
        # Halves, so that the width of a range of huge values stays finite; the end may be infinite.
        width = F.col("_hi") / 2 - F.col("_lo") / 2
        share = F.when(F.col("_v") < F.col("_hi"), (F.col("_v") / 2 - F.col("_lo") / 2) / width).otherwise(F.lit(1.0))
        inside = _in_range(rows, crowded, by)
        parts = (
            inside.withColumn("_part", F.least(F.lit(PARTS - 1), F.floor(share * PARTS)).cast("int"))
            .groupBy(*by, "_slot", "_name", "_rank", "_n", "_below", "_part")
            .agg(*_range_size())
        )
        along = Window.partitionBy(*by, "_name").orderBy("_part")
        finer = parts.withColumn("_below", F.col("_below") + F.sum("_c").over(along) - F.col("_c")).filter(holds)
        targets = targets.filter(~too_many).unionByName(finer.select(*targets.columns))


def _position(n: Column, p: float) -> Column:
    return (n - 1).cast("double") * F.lit(float(p))


def _between(lo: Column, hi: Column, position: Column) -> Column:
    return lo + (hi - lo) * (position - F.floor(position))


def quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    count_name: str = "n",
    weight: str | None = None,
    single_series: bool = False,
) -> DataFrame:
    """Exact quantiles per group with linear interpolation between neighbours.

    `single_series` states that a group is one series, which has at most one row per hour. Its
    values then fit into one aggregate and the table is read once.
    """
    if not all(0 <= p <= 1 for p in probs.values()):
        raise ValueError("probabilities must lie in [0, 1]")
    if single_series:
        known = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
        made = df.groupBy(*by).agg(F.count(known).alias(count_name), F.array_sort(F.collect_list(known)).alias("_sorted"))

        def at(index: Column) -> Column:
            return F.get("_sorted", index.cast("int"))

        cuts = []
        for name, p in probs.items():
            h = _position(F.col(count_name), p)
            cuts.append(_between(at(F.floor(h)), at(F.ceil(h)), h).alias(name))
        return made.select(*by, count_name, *cuts)
    wanted = {}
    for name, p in probs.items():
        wanted[f"_lo_{name}"] = lambda n, p=p: F.floor(_position(n, p)) + 1
        wanted[f"_hi_{name}"] = lambda n, p=p: F.ceil(_position(n, p)) + 1
    picked = select_ranks(df, value, wanted, by, count_name, weight)
    out = []
    for name, p in probs.items():
        h = _position(F.col(count_name), p)
        out.append(_between(F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), h).alias(name))
    return picked.select(*by, count_name, *out)


def conformal_rank(alpha: float, min_n: int) -> Callable[[Column], Column]:
    """Rank ceil((n + 1)(1 - alpha)), or 0 when fewer than `min_n` values exist."""

    def rank(n: Column) -> Column:
        raw = F.ceil((n + 1).cast("double") * F.lit(1.0 - alpha))
        return F.when(n >= min_n, raw).otherwise(F.lit(0))

    return rank


def order_statistic(
    df: DataFrame, score: str, alpha: float, by: Sequence[str] = (), min_n: int = 30, name: str = "q"
) -> DataFrame:
    """Conformal order statistic per group, with the reason when it does not exist."""
    out = select_ranks(df, score, {name: conformal_rank(alpha, min_n)}, by)
    reason = F.when(F.col("n") < min_n, "too_few").when(F.col(name).isNull(), "rank_above_n")
    return out.withColumn("reason", reason)


def median(
    df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median", weight: str | None = None
) -> DataFrame:
    return quantiles(df, value, {name: 0.5}, by, weight=weight).drop("n")


def mad_outliers(
    df: DataFrame, value: str, by: Sequence[str] = (), k: float = 6.0, floor: float = 1.0
) -> DataFrame:
    """Rows further than k times the median absolute deviation (at least `floor`) from the median."""
    center = median(df, value, by, "center")
    measured = attach(df, sized(center) if by else center, by).withColumn(
        "deviation", F.abs(F.col(value) - F.col("center"))
    )
    spread = median(measured, "deviation", by, "mad")
    out = attach(measured, sized(spread) if by else spread, by)
    return out.filter(F.col("deviation") > F.lit(float(k)) * F.greatest(F.lit(float(floor)), F.col("mad")))
