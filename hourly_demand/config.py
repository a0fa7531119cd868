"""Parameters of cleaning, back-testing and selection, checked before any job starts."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

TS = "pickup_hour"
Y = "trips_count"


def as_time(value) -> datetime:
    """A naive local time from a datetime or an ISO string."""
    out = value if isinstance(value, datetime) else datetime.fromisoformat(str(value))
    if out.tzinfo is not None:
        raise ValueError("times must be naive local times")
    return out


@dataclass(frozen=True)
class Rules:
    """Which trips are kept: a half-open time range, value limits and city zones."""

    start: datetime | str
    end: datetime | str
    max_distance: float = 100.0
    max_amount: float = 500.0
    zone: str = "America/New_York"

    def __post_init__(self):
        object.__setattr__(self, "start", as_time(self.start))
        object.__setattr__(self, "end", as_time(self.end))
        if self.start >= self.end:
            raise ValueError("start must lie before end")
        if self.max_distance <= 0 or self.max_amount < 0:
            raise ValueError("value limits must be positive")


@dataclass(frozen=True)
class Span:
    """A named half-open time range: a validation fold or an evaluation period."""

    name: str
    start: datetime | str
    end: datetime | str

    def __post_init__(self):
        object.__setattr__(self, "start", as_time(self.start))
        object.__setattr__(self, "end", as_time(self.end))
        if self.start >= self.end:
            raise ValueError(f"empty span {self.name}")


def month_span(year: int, month: int, name: str | None = None) -> Span:
    follow = datetime(year + month // 12, month % 12 + 1, 1)
    return Span(name or f"{year}-{month:02d}", datetime(year, month, 1), follow)


METRICS = ("MAE", "BusinessLossPerHour")
# Folds, periods and scenarios become literal rows of the plan, so their number is limited.
MAX_SPANS = 1000


@dataclass(frozen=True)
class Protocol:
    """The frozen protocol of one experiment."""

    folds: tuple[Span, ...]
    calibration: Span
    periods: tuple[Span, ...]
    delay: int = 1
    alpha: float = 0.1
    cost_under: float = 3.0
    cost_over: float = 1.0
    metric: str = "MAE"
    inner_window: timedelta = timedelta(days=14)
    min_rows: int = 30
    trials: int = 8
    max_trees: int = 1500
    seed: int = 42
    max_mae: float | None = None
    notes: dict = field(default_factory=dict)

    def __post_init__(self):
        check_delay(self.delay)
        check_alpha(self.alpha)
        check_costs(self.cost_under, self.cost_over)
        if self.trials < 1 or self.max_trees < 1:
            raise ValueError("trials and trees must be positive")
        if self.metric not in METRICS:
            raise ValueError(f"unknown selection metric {self.metric}")
        if not self.folds or not self.periods:
            raise ValueError("at least one fold and one period are needed")
        for names in ([f.name for f in self.folds], [s.name for s in (self.calibration, *self.periods)]):
            if len(set(names)) != len(names):
                raise ValueError("span names must differ")
        if max(len(self.folds), len(self.periods)) > MAX_SPANS:
            raise ValueError(f"more than {MAX_SPANS} spans")

    @classmethod
    def for_year(cls, year: int, include_new_test: bool = True, **kwargs) -> "Protocol":
        """Folds August to October, calibration November, tests December and January."""
        periods = [month_span(year, 12, "December_seen")]
        if include_new_test:
            periods.append(month_span(year + 1, 1, "January_new"))
        return cls(
            folds=tuple(month_span(year, m) for m in (8, 9, 10)),
            calibration=month_span(year, 11),
            periods=tuple(periods),
            **kwargs,
        )

    @property
    def embargo(self) -> timedelta:
        return timedelta(hours=self.delay - 1)

    @property
    def tau(self) -> float:
        """Quantile that minimises the expected asymmetric loss."""
        return self.cost_under / (self.cost_under + self.cost_over)


def check_delay(delay: int) -> int:
    if not 1 <= delay <= 24:
        raise ValueError("availability delay must be 1 to 24 hours")
    return delay


def check_alpha(alpha: float) -> float:
    if not 0 < alpha < 1:
        raise ValueError("alpha must lie between 0 and 1")
    return alpha


def check_costs(under: float, over: float) -> None:
    if min(under, over) <= 0:
        raise ValueError("penalties must be positive")
