"""What one refresh run knows about itself."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    """Run id and clock, fixed once per run so that every operator sees the same values.

    ``run_at`` is UTC.  Operators take the context instead of calling ``current_date``: a rerun
    with the same context gives the same rows.
    """

    run_id: str
    run_at: dt.datetime

    @classmethod
    def start(cls, run_at: dt.datetime | None = None) -> RunContext:
        run_at = run_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        return cls(f"run_{run_at:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}", run_at)

    @property
    def as_of(self) -> dt.date:
        return self.run_at.date()

    def timestamp(self) -> Column:
        epoch = self.run_at.replace(tzinfo=dt.timezone.utc).timestamp()
        return F.timestamp_micros(F.lit(round(epoch * 1_000_000)))

    def date(self) -> Column:
        return F.lit(self.as_of)
