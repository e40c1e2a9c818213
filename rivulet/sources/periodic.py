"""O2: records made by a timer, as the loop flow's source makes them.

``read_periodic`` is a stream of records with fixed attributes, so many per period.
An offset is the number of a period since 1970, and a record holds nothing that
does not follow from its offset (number, time of the period, the attributes), so
a replayed micro-batch has the same records and a restart goes on after the last
committed period.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from rivulet.sources.tables import with_fixed

FORMAT = "rivulet_periodic"
SCHEMA = "record_id long, tick long, fired_at timestamp"
TICKS_PER_PARTITION = 10_000


class _Ticks(InputPartition):
    def __init__(self, first: int, end: int):
        self.first, self.end = first, end


class _Reader(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]):
        self.period = float(options.get("periodseconds", "1"))
        self.records = int(options.get("recordsperperiod", "1"))
        if self.period <= 0 or self.records < 1:
            raise ValueError("periodSeconds and recordsPerPeriod must be positive")
        # the first period (default: the one now) and how many there are (default: no end)
        self.first = int(options["firsttick"]) if "firsttick" in options else None
        self.ticks = int(options["ticks"]) if "ticks" in options else None

    def _now(self) -> int:
        return int(time.time() // self.period)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"tick": self._now() if self.first is None else self.first}

    def latestOffset(self) -> dict:  # noqa: N802
        now = self._now() + 1
        if self.first is not None:
            now = max(now, self.first)
            if self.ticks is not None:
                now = min(now, self.first + self.ticks)
        return {"tick": now}

    def partitions(self, start: dict, end: dict) -> list[_Ticks]:
        a, b = start["tick"], end["tick"]
        return [_Ticks(i, min(i + TICKS_PER_PARTITION, b)) for i in range(a, b, TICKS_PER_PARTITION)]

    def read(self, partition: _Ticks) -> Iterator[tuple]:
        import datetime

        epoch = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
        for tick in range(partition.first, partition.end):
            at = epoch + datetime.timedelta(seconds=tick * self.period)
            for i in range(self.records):
                yield (tick * self.records + i, tick, at)


class PeriodicSource(DataSource):
    """Options: periodSeconds (1), recordsPerPeriod (1), firstTick (the period now),
    ticks (with firstTick: how many periods there are; no end)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> _Reader:  # noqa: N802
        return _Reader({k.lower(): v for k, v in self.options.items()})


def read_periodic(spark: SparkSession, fixed: Mapping | None = None, period_s: float = 1.0, records: int = 1,
                  first_tick: int | None = None, ticks: int | None = None) -> DataFrame:
    """A stream of ``record_id, tick, fired_at`` and the ``fixed`` attributes."""
    if ticks is not None and first_tick is None:
        raise ValueError("ticks needs first_tick")
    spark.dataSource.register(PeriodicSource)
    reader = spark.readStream.format(FORMAT).option("periodSeconds", str(period_s)).option("recordsPerPeriod", str(records))
    for name, value in (("firstTick", first_tick), ("ticks", ticks)):
        if value is not None:
            reader = reader.option(name, str(value))
    return with_fixed(reader.load(), fixed)
