"""What was begun and what is whole, over several stores below one root.

A refresh publishes to one store after the other, so a failure between them leaves them apart. The
journal makes them one: before it starts, a refresh puts down its dates, and at its end the places that
the stores' logs have reached. Dates put down after the last such end belong to a refresh that failed, and
the next one takes them over. Readers that ask for what is committed see the places of the last end.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession

from viewlog.sinks.commits import CommitLog, Taken


class Journal:
    def __init__(self, spark: SparkSession, root: str):
        self._log = CommitLog(spark, f"{root.rstrip('/')}/_journal")

    def _append(self, entry: dict) -> None:
        while True:
            try:
                return self._log.append((self._log.numbers() or [0])[-1] + 1, entry)
            except Taken:
                continue

    def _since_end(self) -> tuple[list[dict], dict | None]:
        """What was begun since the last end, and that end."""
        begun: list[dict] = []
        for number in reversed(self._log.numbers()):
            entry = self._log.entry(number)
            if "at" in entry:
                return begun, entry
            begun.append(entry)
        return begun, None

    def unfinished(self) -> list[date] | None:
        """The dates that were begun and not ended; None meaning every date."""
        begun, _ = self._since_end()
        if any(entry["dates"] is None for entry in begun):
            return None
        return sorted({date.fromisoformat(day) for entry in begun for day in entry["dates"]})

    def begin(self, dates: list[date] | None) -> list[date] | None:
        """Put down dates; returns them with those that were left unfinished. None means every date."""
        left = self.unfinished()
        every = None if dates is None or left is None else sorted({*dates, *left})
        self._append({"dates": None if every is None else [day.isoformat() for day in every]})
        return every

    def end(self, **at: int) -> None:
        """All that was begun is done; ``at`` names the places the stores have reached."""
        self._append({"at": at})

    def committed(self) -> dict[str, int] | None:
        """The places of the last end, None before the first."""
        _, end = self._since_end()
        return end["at"] if end else None
