"""Conversions from delivery text to typed columns, as SQL expression text.

The layouts generate hundreds of these per job; as text each costs one parse instead of dozens of calls from Python.
``value`` is always the SQL of a text column.
"""

from __future__ import annotations

from collections.abc import Mapping

from fundlake.schemas import RecordSpec

# Order gives the code of a date notation in the compact per-row form used while profiling.
DATE_FORMATS = ("iso", "compact", "dutch")

_ISO = "'^[0-9]{4}-[0-9]{2}-[0-9]{2}$'"
_COMPACT = "'^[0-9]{8}$'"
_DUTCH = "'^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}(-.*)?$'"
_INTEGER = "'^[+-]?[0-9]+$'"
_FLOAT = "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


def quoted(name: str) -> str:
    """Column name as SQL."""
    return f"`{name}`"


def blank_to_null(value: str) -> str:
    return f"nullif({value}, '')"


def date_format_code(sample: str) -> str:
    """Notation of a sample value as an index into ``DATE_FORMATS``; null without a sample."""
    return (
        f"cast(CASE WHEN {sample} IS NULL OR {sample} = '' THEN NULL WHEN {sample} RLIKE {_ISO} THEN 0 "
        f"WHEN {sample} RLIKE {_COMPACT} THEN 1 ELSE 2 END AS tinyint)"
    )


def date_format_name(code: str) -> str:
    """Name of a notation code; a delivery without any sample counts as iso."""
    names = ", ".join(f"'{name}'" for name in DATE_FORMATS)
    return f"element_at(array({names}), coalesce({code}, 0) + 1)"


def iso_date(value: str) -> str:
    return f"CASE WHEN {value} RLIKE {_ISO} THEN try_cast({value} AS date) END"


def compact_date(value: str) -> str:
    dashed = f"concat(substr({value}, 1, 4), '-', substr({value}, 5, 2), '-', substr({value}, 7, 2))"
    return f"CASE WHEN {value} RLIKE {_COMPACT} THEN try_cast({dashed} AS date) END"


def dutch_date(value: str) -> str:
    """``d-m-yyyy`` with or without leading zeros; anything after a third dash is ignored."""
    day, month, year = (f"split_part({value}, '-', {n})" for n in (1, 2, 3))
    dashed = f"concat({year}, '-', lpad({month}, 2, '0'), '-', lpad({day}, 2, '0'))"
    return f"CASE WHEN {value} RLIKE {_DUTCH} THEN try_cast({dashed} AS date) END"


def to_date_as(value: str, notation: str) -> str:
    """Date in the notation of its delivery; values in any other notation become null."""
    return (
        f"CASE {notation} WHEN 'iso' THEN {iso_date(value)} WHEN 'compact' THEN {compact_date(value)} "
        f"ELSE {dutch_date(value)} END"
    )


def is_bad_integer(value: str) -> str:
    return f"({value} != '' AND NOT ({value} RLIKE {_INTEGER} AND try_cast({value} AS bigint) IS NOT NULL))"


def is_bad_float(value: str) -> str:
    return f"({value} != '' AND NOT {value} RLIKE {_FLOAT})"


def strict_integer(value: str) -> str:
    """Blank becomes null; text that is not a whole number fails the job."""
    error = f"raise_error(concat('geen geheel getal: ', {value}))"
    return f"CASE WHEN {is_bad_integer(value)} THEN {error} ELSE try_cast({value} AS bigint) END"


def strict_float(value: str) -> str:
    error = f"raise_error(concat('geen getal: ', {value}))"
    return f"CASE WHEN {is_bad_float(value)} THEN {error} ELSE try_cast({value} AS double) END"


def typed(value: str, kind: str, notation: str) -> str:
    """Convert one raw field by its layout suffix."""
    if kind == "d":
        return to_date_as(value, notation)
    if kind == "i":
        return strict_integer(value)
    if kind == "f":
        return strict_float(value)
    return blank_to_null(value)


def date_sample(spec: RecordSpec, field: Mapping[str, str]) -> str:
    """First filled date field of a row in layout order."""
    dates = [blank_to_null(field[name]) for name in spec.date_fields if name in field]
    return f"coalesce({', '.join(dates)})" if dates else "cast(NULL AS string)"


def bad_number_index(spec: RecordSpec, field: Mapping[str, str]) -> str:
    """Position of the first numeric field whose text is not a number; null when all are fine."""
    check = {"i": is_bad_integer, "f": is_bad_float}
    cases = [
        f"WHEN {check[kind](field[name])} THEN {position}"
        for position, (name, kind) in enumerate(spec.columns)
        if kind in check and name in field
    ]
    return f"CASE {' '.join(cases)} END" if cases else "cast(NULL AS int)"
