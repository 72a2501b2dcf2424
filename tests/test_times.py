from __future__ import annotations

from datetime import UTC, date, datetime
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import times

ZONES = ("UTC", "Asia/Seoul", "America/New_York", "Pacific/Kiritimati")

STRINGS = [
    "2024-01-01T00:00:00Z", "2024-01-01T23:59:59.999999+00:00", "2024-01-01 12:00:00+09:00",
    "2024-03-10T06:59:59Z", "2024-03-10T07:00:00Z", "2024-11-03T05:30:00Z", "2024-11-03T06:30:00Z",
    "20240724T090000Z", "20240724T0900Z", "2024-07-24T09Z", "2024-07-24T09:00+0530", "2024-07-24T09:00:00,5Z",
    "2024-07-24T09:00:00.123456789-08:00", "2024-W30-3T09:00:00Z", "2024W303T090000Z", "2024-W30T09:00Z",
    "2020-W53-7T00:00:00Z", "2021-W53-1T00:00:00Z", "2024-07-24", "2024-07-24T09:00:00", "nonsense", "",
    "2024-13-01T00:00:00Z", "2024-02-30T00:00:00Z", "2024-02-29T00:00:00Z", "2023-02-29T00:00:00Z",
    "2024-07-24T09:61:00Z", "2024-07-24T25:00:00Z", "2024-07-24T09:00:60Z", "2024-07-24T09:00:00+24:00",
    "2024-07-24T09:00:00+23:59", "2024-07-24T09:00:00-23:59", "2024-07-24T09:00:00+05:30:15", "0000-01-01T00:00:00Z",
    "2024-07-24x09:00:00Z", "2024-07-24T09:00:00z", "2024-07-24T09:0000Z", " 2024-07-24T09:00:00Z", "2024-07-24T09:00:00Z\n",
    "1969-12-31T23:59:59.5Z", "1900-01-01T00:00:00+00:00",
]


def expected(text: str, zone: str) -> date | None:
    try:
        parsed = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    return None if parsed.tzinfo is None else parsed.astimezone(ZoneInfo(zone)).date()


@pytest.mark.parametrize("zone", ZONES)
def test_local_day_matches_iso_parsing(spark, zone):
    rows = spark.createDataFrame([(s,) for s in STRINGS], "s string")
    found = {r["s"]: r["d"] for r in rows.select("s", times.local_day(F.col("s"), zone).alias("d")).collect()}
    assert found == {s: expected(s, zone) for s in STRINGS}


def test_null_has_no_day(spark):
    row = spark.range(1).select(times.local_day(F.lit(None).cast("string")).alias("d")).first()
    assert row["d"] is None


def test_unknown_zone():
    with pytest.raises(Exception, match="No time zone"):
        times.day_in_zone(F.lit(None), "Mars/Olympus")


def test_resolve_day(spark):
    now = F.lit("2024-03-01 16:00:00").cast("timestamp_ntz")
    literals = ["today", "previous-local-day", "2020-02-02"]
    row = spark.range(1).select(*[times.resolve_day(F.lit(x), now, "Asia/Seoul").alias(x) for x in literals]).first()
    assert list(row) == [date(2024, 3, 2), date(2024, 3, 1), date(2020, 2, 2)]
    assert datetime(2024, 3, 1, 16, tzinfo=UTC).astimezone(ZoneInfo("Asia/Seoul")).date() == date(2024, 3, 2)
