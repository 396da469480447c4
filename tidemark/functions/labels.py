"""Control-date labels, written and read with a strftime pattern per row.

Arguments and results are SQL text, so calls nest and one ``expr`` builds the lot.
"""

from __future__ import annotations

# Strftime directive -> Spark datetime letters.
NUMERIC_DIRECTIVES = {
    "%Y": "yyyy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
}
# Further directives that only ingest patterns may use.
TEXT_DIRECTIVES = {
    "%y": "yy",
    "%B": "MMMM",
    "%b": "MMM",
    "%I": "hh",
    "%a": "EEE",
    "%A": "EEEE",
    "%p": "a",
    "%z": "Z",
    "%Z": "z",
}
DIRECTIVES = {**NUMERIC_DIRECTIVES, **TEXT_DIRECTIVES}
# Directives of equal rank, from the longest time unit to the shortest.
TIME_ORDER = ["Yy", "UW", "m", "w", "d", "H", "M", "S", "f"]
DEFAULT_PATTERN = "%Y%m%d"
# The patterns most labels have, and their Spark patterns.
COMMON_PATTERNS = {
    "%Y%m%d": "yyyyMMdd",
    "%Y%m%d%H": "yyyyMMddHH",
    "%Y%m%d%H%M": "yyyyMMddHHmm",
    "%Y-%m-%d": "yyyy-MM-dd",
    "%Y-%m-%d %H": "yyyy-MM-dd HH",
    "%d/%m/%Y": "dd/MM/yyyy",
}


def pattern_or_default(pattern: str) -> str:
    return f"coalesce({pattern}, '{DEFAULT_PATTERN}')"


def is_supported(pattern: str) -> str:
    """Spark fails the whole job on a bad pattern, so only known directives get through."""
    letters = "".join(d[1] for d in DIRECTIVES)
    return f"coalesce({pattern} RLIKE '^(%[{letters}%]|[^%A-Za-z{{}}#\"\\\\[\\\\]])*$', false)"


def spark_pattern(pattern: str) -> str:
    """The Spark datetime pattern; null when the pattern is not supported."""
    escaped = "unhex('01')"
    result = f"replace({pattern}, '%%', cast({escaped} AS string))"
    for directive, letters in DIRECTIVES.items():
        result = f"replace({result}, '{directive}', '{letters}')"
    result = f"replace({result}, cast({escaped} AS string), '%')"
    return f"CASE WHEN {is_supported(pattern)} THEN {result} END"


def _per_pattern(subject: str, constants: dict[str, str], call: str, otherwise: str) -> str:
    """``call`` with a constant pattern for the common ones, so Spark compiles them once."""
    arms = " ".join(
        f"WHEN {subject} = '{value}' THEN {call.format(pattern=repr(constant))}"
        for value, constant in constants.items()
    )
    return f"CASE {arms} ELSE {otherwise} END"


_SAME = {p: p for p in COMMON_PATTERNS.values()}


def write(ts: str, label_pattern: str) -> str:
    """A label from a date and a Spark pattern."""
    call = f"date_format({ts}, {{pattern}})"
    return _per_pattern(label_pattern, _SAME, call, call.format(pattern=label_pattern))


def _reader(label: str) -> str:
    return f"cast(try_to_timestamp({label}, {{pattern}}) AS timestamp_ntz)"


def read(label: str, label_pattern: str) -> str:
    """Label to date-time, a date alone to its midnight, anything else to null."""
    has_date = " AND ".join(f"contains({label_pattern}, '{unit}')" for unit in ("yy", "MM", "dd"))
    call = _reader(label)
    checked = f"CASE WHEN {has_date} THEN {call.format(pattern=label_pattern)} END"
    return _per_pattern(label_pattern, _SAME, call, checked)


def render(ts: str, pattern: str) -> str:
    """A label from a date and a strftime pattern."""
    call = f"date_format({ts}, {{pattern}})"
    return _per_pattern(
        pattern, COMMON_PATTERNS, call, call.format(pattern=spark_pattern(pattern))
    )


def parse(label: str, pattern: str) -> str:
    """As ``read``, with a strftime pattern."""
    return _per_pattern(pattern, COMMON_PATTERNS, _reader(label), read(label, spark_pattern(pattern)))


def sorts_chronologically(pattern: str) -> str:
    """True when the directives run from year to fraction and nothing else follows a ``%``."""
    arms = " ".join(
        f"WHEN letter <> '' AND contains('{group}', letter) THEN {rank}"
        for rank, group in enumerate(TIME_ORDER)
    )
    ranks = (
        f"transform(regexp_extract_all(replace({pattern}, '%%', ''), '%(.?)'), "
        f"letter -> CASE {arms} ELSE -1 END)"
    )
    return f"(NOT array_contains({ranks}, -1) AND {ranks} = array_sort({ranks}))"
