"""Date and time features of one timestamp column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Festival days and rain months.
FESTIVAL_DATES = ["2022-10-24", "2023-11-12", "2024-11-01"]
FESTIVAL_DAYS_AROUND = 2
MONSOON_MONTHS = [7, 8, 9]

# Arguments called ``ts`` and ``hour`` are a column name or any SQL expression.

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def hour_index(ts: str = "timestamp") -> Column:
    """Whole hours since 1970 on the wall clock, whatever the session zone."""
    ntz = f"CAST({ts} AS TIMESTAMP_NTZ)"
    return F.expr(f"CAST(unix_date(CAST({ntz} AS DATE)) AS BIGINT) * 24 + hour({ntz})")


def hour_start(hour: str) -> Column:
    """Inverse of :func:`hour_index`."""
    return F.expr(f"timestampadd(HOUR, {hour}, {_EPOCH})")


def _all(exprs: dict[str, str]) -> dict[str, Column]:
    return {name: F.expr(e) for name, e in exprs.items()}


def time_parts(ts: str = "timestamp") -> dict[str, Column]:
    return _all({"hour": f"hour({ts})", "day_of_week": f"weekday({ts})", "month": f"month({ts})"})


def cyclical_time(ts: str = "timestamp") -> dict[str, Column]:
    """Sine and cosine of hour of day, weekday (Monday 0) and month."""
    turns = {"hour": f"hour({ts}) / 24", "dow": f"weekday({ts}) / 7", "month": f"month({ts}) / 12"}
    return _all({
        f"{name}_{wave}": f"{wave}(2 * pi() * {turn})"
        for name, turn in turns.items() for wave in ("sin", "cos")
    })


def weekend_flag(ts: str = "timestamp") -> Column:
    return F.expr(f"CAST(weekday({ts}) >= 5 AS INT)")


def festival_flag(ts: str = "timestamp") -> Column:
    """Within two days of a festival, compared as timestamps.

    The last day therefore counts at midnight only.
    """
    days = f"INTERVAL '{FESTIVAL_DAYS_AROUND}' DAY"
    near = " OR ".join(
        f"CAST({ts} AS TIMESTAMP_NTZ) BETWEEN TIMESTAMP_NTZ'{d}' - {days} AND TIMESTAMP_NTZ'{d}' + {days}"
        for d in FESTIVAL_DATES
    )
    return F.expr(f"CAST({near} AS INT)")


def _in_months(ts: str, months: list[int]) -> str:
    return f"month({ts}) IN ({', '.join(map(str, months))})"


def monsoon_flag(ts: str = "timestamp") -> Column:
    return F.expr(f"CAST({_in_months(ts, MONSOON_MONTHS)} AS INT)")


def calendar_features(ts: str = "timestamp") -> dict[str, Column]:
    return {
        **cyclical_time(ts),
        "is_weekend": weekend_flag(ts),
        "is_diwali_week": festival_flag(ts),
        "is_monsoon": monsoon_flag(ts),
    }


def rush_hour_flag(ts: str = "timestamp") -> Column:
    return F.expr(f"CAST(hour({ts}) BETWEEN 7 AND 9 OR hour({ts}) BETWEEN 17 AND 20 AS INT)")


def season_flags(ts: str = "timestamp") -> dict[str, Column]:
    return _all({
        "is_diwali_season": f"CAST(month({ts}) IN (10, 11) AS INT)",
        "is_monsoon": f"CAST(month({ts}) BETWEEN 6 AND 9 AS INT)",
        "is_winter": f"CAST(month({ts}) IN (12, 1, 2) AS INT)",
    })
