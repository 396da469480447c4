"""The control dates a dependency must have, for every check row at once.

A check is a dependency at one reference date. Needed columns: ``frequency_check``,
``value``, ``ref_ts``, ``start_ts``, ``frequency`` and ``back_day`` of the consuming job,
``consumer`` (transform or ingest), and the Spark patterns ``label_pattern`` of the
dependency and ``job_label_pattern`` of the job, null where they are not supported.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import frequency as freq
from tidemark.functions import labels

# Frequency checks by the verdict they need.
SINGLE = ("daily", "weekly", "cur_month", "prev_month", "eom", "day-n", "hourly")
WINDOW = (
    "quarter", "month_to_date", "hour_to_date", "daily_period", "year_to_date",
    "date_range", "date_in_range", "24hours",
)
TOLERANT = ("every_n_hour",)
NEWEST = ("max_date",)
# The checks each kind of consumer supports.
INGEST_CHECKS = ("daily", "hourly", "24hours", "every_n_hour")
TRANSFORM_CHECKS = tuple(c for c in SINGLE + WINDOW + NEWEST if c != "24hours")
HOURS_PER_DAY = 24


def _in(names: tuple[str, ...]) -> str:
    return "frequency_check IN (" + ", ".join(f"'{n}'" for n in names) + ")"


# single, window, tolerant or newest; null when the consumer has no such check
FAMILY = f"""CASE
    WHEN NOT (CASE WHEN consumer = 'ingest' THEN {_in(INGEST_CHECKS)}
                   ELSE {_in(TRANSFORM_CHECKS)} END) THEN NULL
    WHEN {_in(SINGLE)} THEN 'single' WHEN {_in(WINDOW)} THEN 'window'
    WHEN {_in(TOLERANT)} THEN 'tolerant' WHEN {_in(NEWEST)} THEN 'newest' END"""

V = "coalesce(try_cast(value AS int), 0)"
_STEPPED = _in(("daily_period", "date_in_range"))
_HOURLY = _in(("hour_to_date", "24hours", "every_n_hour"))


def _on(year: str, month: str, day: str) -> str:
    """That date at the reference time of day; null when there is no such date."""
    return (
        f"try_make_timestamp_ntz({year}, {month}, {day}, "
        "hour(ref_ts), minute(ref_ts), extract(SECOND FROM ref_ts))"
    )


def _days(n: str) -> str:
    return f"make_dt_interval({n})"


def _as_labelled(ts: str) -> str:
    """The date as its job's label keeps it (a daily label forgets the hour)."""
    return labels.read(labels.write(ts, "job_label_pattern"), "job_label_pattern")


def _window_bounds() -> dict[str, tuple[str, str]]:
    """First and last expected date of every check."""
    month_day = _on("year(ref_ts)", "month(ref_ts)", V)
    before = "(ref_ts - INTERVAL '1' MONTH)"
    weekday_back = f"(dayofweek(ref_ts) - 1 + (7 - {V})) % 7"
    quarter_start = _on(
        f"year(ref_ts) - CASE WHEN {V} > quarter(ref_ts) THEN 1 ELSE 0 END",
        f"CASE WHEN {V} BETWEEN 1 AND 4 THEN {V} * 3 - 2 END", "1",
    )
    quarter_end = (
        f"CASE WHEN {V} = quarter(ref_ts) THEN ref_ts "
        f"ELSE {quarter_start} + INTERVAL '3' MONTH - INTERVAL '1' DAY END"
    )
    closes_early = "frequency = 'monthly' AND coalesce(try_cast(back_day AS int), 0) = 0"
    mtd_end = f"{month_day} - {_days(f'CASE WHEN {closes_early} THEN 1 ELSE 0 END')}"
    year_start = _on("year(ref_ts)", "1", "1")
    midnight = "cast(cast(ref_ts AS date) AS timestamp_ntz)"
    fraction = "(ref_ts - cast(date_trunc('SECOND', ref_ts) AS timestamp_ntz))"
    hour_end = (
        f"CASE WHEN {V} BETWEEN 0 AND {HOURS_PER_DAY - 1} "
        f"THEN {midnight} + {fraction} + make_dt_interval(0, {V}) END"
    )
    day_hours = (midnight, f"{midnight} + make_dt_interval(0, {HOURS_PER_DAY - 1})")

    def one(ts: str) -> tuple[str, str]:
        return ts, ts

    return {
        "daily": one("ref_ts"),
        "weekly": one(f"ref_ts - {_days(weekday_back)}"),
        "cur_month": one(month_day),
        "prev_month": one(_on(f"year({before})", f"month({before})", V)),
        "eom": one(f"{_on('year(ref_ts)', 'month(ref_ts)', '1')} - INTERVAL '1' DAY"),
        "day-n": one(f"ref_ts - {_days(V)}"),
        "hourly": one(f"ref_ts - make_dt_interval(0, {V})"),
        "quarter": (quarter_start, quarter_end),
        "month_to_date": (_on("year(ref_ts)", "month(ref_ts)", "1"), mtd_end),
        "year_to_date": (year_start, f"{year_start} + {_days(f'{V} - 1')}"),
        "hour_to_date": (f"{midnight} + {fraction}", hour_end),
        "daily_period": (_as_labelled("start_ts"), _as_labelled("ref_ts")),
        "date_range": (f"ref_ts - {_days(V)}", "ref_ts"),
        "date_in_range": one("ref_ts"),
        "24hours": day_hours,
        "every_n_hour": day_hours,
        "max_date": one("ref_ts"),
    }


def window_columns() -> dict[str, Column]:
    """The window of each check: bounds, step and what forbids it (``refused``).

    ``reach`` counts the steps either side of a window centred on the reference date.
    """
    bounds = _window_bounds()
    low = " ".join(f"WHEN '{check}' THEN {first}" for check, (first, _) in bounds.items())
    high = " ".join(f"WHEN '{check}' THEN {last}" for check, (_, last) in bounds.items())
    n = "CASE WHEN value IS NULL THEN 1 ELSE try_cast(value AS int) END"
    required = f"CASE WHEN {_in(TOLERANT)} THEN try_divide({HOURS_PER_DAY}, {n}) END"
    columns = {
        "family": FAMILY,
        "low_ts": f"CASE frequency_check {low} END",
        "high_ts": f"CASE frequency_check {high} END",
        "step_minutes": f"CASE WHEN {_STEPPED} THEN {freq.step_minutes('frequency')} "
                        f"WHEN {_HOURLY} THEN 60 ELSE 1440 END",
        "step_months": f"CASE WHEN {_STEPPED} THEN {freq.step_months('frequency')} END",
        "reach": f"CASE WHEN frequency_check = 'date_in_range' THEN greatest({V}, 0) END",
        "required": f"cast({required} AS int)",
        "refused": f"""CASE
            WHEN ({FAMILY}) IS NULL THEN 'unsupported'
            WHEN label_pattern IS NULL THEN 'invalid_pattern'
            WHEN {_STEPPED} AND NOT ({freq.is_known("frequency")}) THEN 'invalid_frequency'
            WHEN {_in(TOLERANT)} AND ({required}) IS NULL THEN 'invalid_value' END""",
    }
    return {name: F.expr(text) for name, text in columns.items()}


# Why a check with its window has no expected date, or null.
WINDOW_PROBLEM = """coalesce(refused, CASE
    WHEN low_ts IS NULL OR high_ts IS NULL THEN 'invalid_value'
    WHEN low_ts > high_ts THEN 'empty_window' END)"""


def expected_dates() -> str:
    """All dates of a window, as an array.

    Around the reference date every step count is applied to that date itself; between
    two bounds the steps follow one another.
    """
    around = freq.shift("low_ts", "step_minutes * k", "step_months * k")
    between = freq.steps_between("low_ts", "high_ts", "step_minutes", "step_months")
    return (
        f"CASE WHEN reach IS NOT NULL THEN transform(sequence(-reach, reach), k -> {around}) "
        f"ELSE {between} END"
    )
