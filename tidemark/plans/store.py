"""Where one district's exchange keeps its things."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.dates import month_window
from tidemark.sources import ledger, months
from tidemark.sources.master import Master, Version


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Store:
    """One district per root; districts share nothing."""

    spark: SparkSession
    root: str
    now: object = field(default=utc_now)

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/ledger"

    @property
    def delivery_path(self) -> str:
        return f"{self.root}/delivery"

    @property
    def archive_path(self) -> str:
        return f"{self.root}/archive"

    @property
    def master(self) -> Master:
        return Master(self.spark, f"{self.root}/master")

    def run_ledger(self, run_id: str) -> ledger.RunLedger:
        return ledger.RunLedger(self.spark, self.ledger_path, run_id, self.now)

    def events(self, back: int | None = None) -> DataFrame:
        """Ledger events, of all time or of the last months by the ledger's clock.

        Events are filed by when they were written, whatever day a run was for.
        """
        since = None
        if back:
            since = months.number_of(*month_window(self.now().date(), back)[-1])
        return months.read(self.spark, self.ledger_path, since)

    def recent(self, runs: int) -> DataFrame:
        """All events of the newest runs, from no more months than they lie in."""
        return months.recent(self.spark, self.ledger_path, runs)

    def fold(self) -> list[int]:
        """Fold the ledger's closed months; to be done once a month."""
        return months.fold(self.spark, self.ledger_path, self.now().date())

    def version(self) -> Version:
        return months.version(self.spark, self.ledger_path)

    def known(self) -> DataFrame:
        return self.master.read(self.version())
