"""From trips to a gap-free panel with its audit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TS, Y, Rules
from ..operators.cleaning import audit, hourly_counts, kept_counts, observed_hours, verdict_cube
from ..operators.panel import fill_hours, hour_grid, missing_hours, null_dst


@dataclass(frozen=True)
class PanelBuild:
    """Results that share one aggregated pass over the trips.

    `cube` is the small table of counts everything else derives from. Call `persist()` before
    using more than one result, or store the cube with `sources.refresh`.
    """

    cube: DataFrame
    rules: Rules
    keys: tuple[str, ...]
    series: DataFrame | None = None

    def persist(self) -> "PanelBuild":
        self.cube.persist()
        return self

    def counts(self) -> DataFrame:
        return hourly_counts(self.cube, self.keys)

    def audit(self, by: Sequence[str] = ()) -> DataFrame:
        return audit(self.cube, by)

    def dense(self) -> DataFrame:
        """Gap-free counts, before clock-change hours lose theirs."""
        kept = self.cube.filter(F.col("verdict") == "kept").withColumnRenamed("n", Y)
        return fill_hours(kept, self.rules.start, self.rules.end, self.keys, self.series)

    def panel(self) -> DataFrame:
        return null_dst(self.dense(), self.rules.zone, self.rules.start, self.rules.end)

    def missing(self) -> DataFrame:
        """City hours without any raw record."""
        grid = hour_grid(self.cube.sparkSession, self.rules.start, self.rules.end)
        return missing_hours(observed_hours(self.cube), grid, self.rules.zone)

    def check(self) -> "PanelBuild":
        """Raises ValueError when nothing was kept or hours of the source are silent. Runs jobs."""
        if self.cube.filter(F.col("verdict") == "kept").isEmpty():
            raise ValueError("no trip passes the cleaning rules")
        silent = [r[TS] for r in self.missing().orderBy(TS).take(5)]
        if silent:
            raise ValueError(f"no raw record at all in the hours {silent}")
        return self


def build(
    trips: DataFrame,
    zones: DataFrame,
    rules: Rules,
    keys: Sequence[str] = (),
    series: DataFrame | None = None,
) -> PanelBuild:
    return PanelBuild(verdict_cube(trips, zones, rules), rules, tuple(keys), series)


def build_panel(
    trips: DataFrame,
    zones: DataFrame,
    rules: Rules,
    keys: Sequence[str] = (),
    series: DataFrame | None = None,
) -> DataFrame:
    """Panel of kept trips per series and hour; 0 without trips, NULL in clock-change hours.

    Reads only the trips the rules can keep; use `build` to get the audit as well.
    """
    counts = kept_counts(trips, zones, rules, keys)
    dense = fill_hours(counts, rules.start, rules.end, keys, series)
    return null_dst(dense, rules.zone, rules.start, rules.end)
