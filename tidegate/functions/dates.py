"""Receipt frequencies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Receipt frequencies and the unit each of them counts.
FREQUENCY_UNITS = {"DAILY": "DAY", "WEEKLY": "WEEK", "MONTHLY": "MONTH", "QUARTERLY": "QUARTER"}


def elapsed_units(frequency: Column, since: Column, until: Column) -> Column:
    """Whole units of the frequency between two times; NULL if the frequency is unknown."""
    branches = [(F.upper(frequency) == name, F.timestamp_diff(unit, since, until)) for name, unit in FREQUENCY_UNITS.items()]
    first, *rest = branches
    return reduce(lambda case, b: case.when(*b), rest, F.when(*first))


def last_due(frequency: Column, day: Column, time: Column, until: Column) -> Column:
    """The last moment up to ``until`` at which a source was due; NULL if the frequency is unknown.

    A source is due once in every day, week, month or quarter, at ``time`` (``HH:mm`` or with seconds; midnight without one). ``day`` is the day of the week
    from Monday, or of the month, or of the quarter's first month, from 1, and is held to the last one that month has; the first without one.
    """
    at = F.coalesce(F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), F.trim(time))).cast("timestamp_ntz"), F.lit("1970-01-01").cast("timestamp_ntz"))
    seconds = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    wanted = F.greatest(F.coalesce(day, F.lit(1)), F.lit(1)).cast("int")
    branches = []
    for name, unit in FREQUENCY_UNITS.items():
        length = {"DAY": F.lit(1), "WEEK": F.lit(7)}.get(unit)

        def due(start: Column, length: Column | None = length) -> Column:
            most = length if length is not None else F.dayofmonth(F.last_day(start))
            day_of = F.date_add(start, F.least(wanted, most) - 1)
            return day_of.cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))

        start = F.date_trunc(unit, until).cast("date")
        steps = {"DAY": F.date_add(start, -1), "WEEK": F.date_add(start, -7), "MONTH": F.add_months(start, -1), "QUARTER": F.add_months(start, -3)}
        now, before = due(start), due(steps[unit])
        branches.append((F.upper(F.trim(frequency)) == name, F.when(now <= until.cast("timestamp_ntz"), now).otherwise(before)))
    first, *rest = branches
    return reduce(lambda case, b: case.when(*b), rest, F.when(*first))
