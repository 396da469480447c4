"""Frequency arithmetic on control dates (``timestamp_ntz``), as Spark SQL expressions.

Arguments and results are SQL text, so calls nest and one ``expr`` builds the lot.

A frequency is ``15m``, ``2h``, ``hourly``, ``daily``, ``weekly``, ``monthly``,
``quarterly`` or ``yearly``; blank means daily. Month arithmetic clamps to the month
end. An unknown frequency or a non-integer step count yields null, which callers turn
into a reason; nothing here fails the job for one bad row.
"""

from __future__ import annotations

# Minutes or months per step of the named frequencies.
NAMED_MINUTES = {"hourly": 60, "daily": 1440, "weekly": 10080}
NAMED_MONTHS = {"monthly": 1, "quarterly": 3, "yearly": 12}


def normalized(frequency: str) -> str:
    return f"coalesce(nullif(lower(trim({frequency})), ''), 'daily')"


def step_minutes(frequency: str) -> str:
    """Minutes in one step; null for month-based and unknown frequencies."""
    name = normalized(frequency)
    count = f"try_cast(regexp_extract({name}, '^([0-9]+)', 1) AS bigint)"
    named = " ".join(f"WHEN '{k}' THEN {v}L" for k, v in NAMED_MINUTES.items())
    return (
        f"CASE {name} {named} ELSE CASE WHEN {name} RLIKE '^[0-9]+ *m$' THEN {count} "
        f"WHEN {name} RLIKE '^[0-9]+ *h$' THEN {count} * 60 END END"
    )


def step_months(frequency: str) -> str:
    """Months in one step; null for minute-based and unknown frequencies."""
    named = " ".join(f"WHEN '{k}' THEN {v}" for k, v in NAMED_MONTHS.items())
    return f"CASE {normalized(frequency)} {named} END"


def is_known(frequency: str) -> str:
    return f"coalesce({step_minutes(frequency)}, {step_months(frequency)}) IS NOT NULL"


def step_count(n: str) -> str:
    """Blank means 0; text that is not an integer means null."""
    return f"try_cast(coalesce(nullif(trim(cast({n} AS string)), ''), '0') AS int)"


def shift(ts: str, minutes: str, months: str) -> str:
    """Moves by minutes, or by months when minutes is null."""
    by_minutes = (
        f"make_dt_interval(cast(({minutes}) div 1440 AS int), 0, cast(({minutes}) % 1440 AS int))"
    )
    return (
        f"coalesce({ts} + {by_minutes}, {ts} + make_ym_interval(0, cast({months} AS int)))"
    )


def plus_steps(ts: str, frequency: str, n: str, sign: str = "") -> str:
    steps = f"{sign}{step_count(n)}"
    return shift(
        ts, f"{step_minutes(frequency)} * {steps}", f"({step_months(frequency)}) * {steps}"
    )


def minus_steps(ts: str, frequency: str, n: str) -> str:
    return plus_steps(ts, frequency, n, sign="-")


def overlap_start(ts: str, frequency: str, overlap: str) -> str:
    """Blank overlap leaves the date alone; only digits are accepted otherwise."""
    return (
        f"CASE WHEN coalesce({overlap}, '') = '' THEN {ts} "
        f"WHEN {overlap} RLIKE '^[0-9]+$' THEN {minus_steps(ts, frequency, overlap)} END"
    )


def steps_between(start: str, end: str, minutes: str, months: str) -> str:
    """All control dates from start to end inclusive; empty when start > end.

    ``minutes`` or ``months`` is the step; without a usable one the result is null. Steps
    are taken one after the other, so a month end that clamps stays clamped (31 Jan,
    29 Feb, 29 Mar). ``sequence`` over months is anchored to the start day instead, so it
    serves only the minute-based frequencies.
    """
    span = f"(year({end}) - year({start})) * 12 + month({end}) - month({start})"
    return f"""CASE
        WHEN {start} > {end} THEN cast(array() AS array<timestamp_ntz>)
        WHEN {minutes} > 0 THEN
          sequence({start}, {end}, make_dt_interval(0, 0, cast({minutes} AS int)))
        WHEN {months} > 0 THEN filter(
          aggregate(sequence(1, cast(({span}) div {months} AS int) + 1), array({start}),
            (dates, i) -> concat(dates,
              array(element_at(dates, -1) + make_ym_interval(0, cast({months} AS int))))),
          d -> d <= {end})
        END"""
