"""Settings of one run."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from decimal import Decimal


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as hot.

    A key is hot when it holds more than ``min_rows`` rows and more than one
    ``max_keys``-th of the table, so there are always fewer than ``max_keys`` hot keys
    and a list of them may be broadcast. Every other key fits in one task.
    """

    min_rows: int = 1_000_000
    max_keys: int = 100_000


@dataclass(frozen=True)
class Settings:
    high_value_threshold: Decimal = Decimal("50000")
    velocity_min_txns: int = 3
    always_failed_min_txns: int = 5
    burst_min_txns: int = 3
    freshness_warn_hours: int = 12
    freshness_error_hours: int = 24
    skew: SkewPolicy = field(default_factory=SkewPolicy)


@dataclass(frozen=True)
class Run:
    """Identity of a run; nothing in a plan asks the clock again."""

    run_date: date
    run_ts: datetime
    invocation_id: str
    target: str = "dev"
    settings: Settings = field(default_factory=Settings)

    @classmethod
    def for_date(cls, run_date: date | str, **kw) -> "Run":
        day = date.fromisoformat(run_date) if isinstance(run_date, str) else run_date
        kw.setdefault("run_ts", datetime.now(timezone.utc).replace(tzinfo=None))
        kw.setdefault("invocation_id", str(uuid.uuid4()))
        return cls(run_date=day, **kw)


def namespace(custom: str | None, target: str, default: str) -> str:
    """Schema folder of a table: bare name in production, prefixed elsewhere."""
    if custom is None:
        return default
    name = custom.strip()
    return name if target == "prod" else f"{default}_{name}"
