"""Parameters of the jobs. Defaults are the fixed values of the service being analysed."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

WAREHOUSE_PREFIX = "raw_"


@dataclass(frozen=True)
class TableConfig:
    """How one source table is loaded."""

    name: str
    incremental_col: str | None = None
    pk: str | None = None
    fetch_size: int = 10_000
    cleaning: str | None = None

    @property
    def target(self) -> str:
        return WAREHOUSE_PREFIX + self.name


# The 25 source tables in load order, four stages.
STAGES: dict[str, list[TableConfig]] = {
    "reference": [
        TableConfig("accounts_group", pk="id"),
        TableConfig("accounts_school", pk="id"),
        TableConfig("accounts_nearbyschool", pk="id"),
        TableConfig("polls_question", pk="id"),
        TableConfig("polls_questionset", pk="id"),
        TableConfig("polls_questionpiece", pk="id"),
    ],
    "incremental": [
        TableConfig("accounts_user", incremental_col="created_at", pk="id", cleaning="users"),
        TableConfig("accounts_userquestionrecord", incremental_col="created_at", pk="id"),
        TableConfig("polls_usercandidate", incremental_col="created_at", pk="id"),
        TableConfig("polls_questionreport", incremental_col="created_at", pk="id"),
        TableConfig("accounts_blockrecord", incremental_col="created_at", pk="id"),
        TableConfig("accounts_timelinereport", incremental_col="created_at", pk="id"),
        TableConfig("accounts_userwithdraw", incremental_col="created_at", pk="id"),
        TableConfig("accounts_paymenthistory", incremental_col="created_at", pk="id"),
        TableConfig("accounts_failpaymenthistory", incremental_col="created_at", pk="id"),
        TableConfig("event_receipts", incremental_col="created_at", pk="id"),
        TableConfig("events", incremental_col="created_at", pk="id"),
        TableConfig("accounts_pointhistory", incremental_col="created_at", pk="id", cleaning="points"),
    ],
    "full_reload": [
        TableConfig("accounts_attendance", pk="id"),
        TableConfig("accounts_user_contacts"),
        TableConfig("hackle_properties"),
        TableConfig("device_properties"),
        TableConfig("user_properties"),
    ],
    "large": [
        TableConfig("accounts_friendrequest", incremental_col="created_at", pk="id", fetch_size=5_000),
        TableConfig("hackle_events", incremental_col="event_datetime", fetch_size=5_000),
    ],
}

# Stages whose tables are loaded one after the other; in the others they may overlap.
SEQUENTIAL_STAGES = frozenset({"large"})

TABLES: dict[str, TableConfig] = {cfg.name: cfg for stage in STAGES.values() for cfg in stage}


@dataclass(frozen=True)
class AnalysisWindow:
    """Inclusive at both ends; the end is midnight *opening* the last day."""

    start: date = date(2023, 5, 27)
    end: date = date(2024, 5, 8)

    @property
    def start_ts(self) -> datetime:
        return datetime(self.start.year, self.start.month, self.start.day)

    @property
    def end_ts(self) -> datetime:
        return datetime(self.end.year, self.end.month, self.end.day)

    @property
    def max_days(self) -> int:
        """Whole days between the ends; the cap of the recency of users without a vote."""
        return (self.end - self.start).days

    @property
    def first_monday(self) -> date:
        return self.start + timedelta(days=-self.start.weekday() % 7)

    def from_monday(self) -> AnalysisWindow:
        """The window extended back to the Monday of its first, partial week."""
        return AnalysisWindow(self.start - timedelta(days=self.start.weekday()), self.end)


@dataclass(frozen=True)
class Tier:
    """Lower bounds (inclusive) of the two better labels; anything less is ``Exit``."""

    safe: float
    warning: float


# Product to price; unknown products count 0.
PRICE_MAP = {
    "heart.200": 900,
    "heart.777": 1900,
    "heart.1000": 2900,
    "heart.4000": 9900,
}


@dataclass(frozen=True)
class MartConfig:
    window: AnalysisWindow = AnalysisWindow()
    super_votes: int = 507
    max_point: int = 100_000_000
    outlier_votes: int = 100
    targets: tuple[int, ...] = (1, 4, 5)
    war: Tier = Tier(20, 5)
    arpu: Tier = Tier(3000, 1000)
    vpu: Tier = Tier(15, 5)
    prices: dict[str, int] = field(default_factory=lambda: dict(PRICE_MAP))
    k: int = 6
    seed: int = 42
    restarts: int = 10
    signup_cutoff: str = "sunday_start"
    include_partial_first_week: bool = False

    @property
    def frame_window(self) -> AnalysisWindow:
        return self.window.from_monday() if self.include_partial_first_week else self.window
