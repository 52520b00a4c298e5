"""Column functions over raw delivery lines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Besides \n, \r and \r\n, which the text source handles, these characters also end a line.
EXTRA_LINE_ENDS = r"[\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
_VISIBLE = r"(?U)[^\s\x1c-\x1f]"


def decoded(value: Column, utf8: Column) -> Column:
    """Text of a line: UTF-8 where it is valid, Latin-1 otherwise."""
    return F.when(utf8, value).otherwise(F.decode(value.cast("binary"), "ISO-8859-1"))


def as_latin1(text: Column) -> Column:
    """The same bytes read as Latin-1; undoes a UTF-8 reading."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def line_parts(text: Column) -> Column:
    """Split a line at the rarer line-end characters."""
    return F.when(text.rlike(EXTRA_LINE_ENDS), F.split(text, EXTRA_LINE_ENDS)).otherwise(F.array(text))


def has_text(text: Column) -> Column:
    return text.rlike(_VISIBLE)


def record_code(text: Column, codes: Iterable[str]) -> Column:
    """Record type in the first field, ``''`` for an unknown one."""
    return F.regexp_extract(text, rf"^({'|'.join(codes)})(?=[;|]|$)", 1)


def separator_after(text: Column, code: Column) -> Column:
    """The separator that follows the record type; ``''`` when the line holds nothing else."""
    return F.substring(text, F.length(code) + 1, F.lit(1))


def prefers_pipe(text: Column) -> Column:
    """Whether a line has at least as many ``|`` as ``;``."""

    def occurrences(char: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))

    # Most lines hold one of them, which is seen without counting.
    return (
        F.when(~F.contains(text, F.lit(";")), F.lit(True))
        .when(~F.contains(text, F.lit("|")), F.lit(False))
        .otherwise(occurrences("|") >= occurrences(";"))
    )


def split_fields(text: Column, separator: Column) -> Column:
    """Fields of a line after dropping every trailing separator; no quoting."""
    body = F.when(~F.endswith(text, separator), text).otherwise(F.rtrim(text, separator))
    return F.when(separator == "|", F.split(body, r"\|")).otherwise(F.split(body, ";"))


def field_at(fields: str, position: int) -> str:
    """SQL of a field by position; a short row yields ``''`` and extra fields are never asked for."""
    return f"coalesce(get({fields}, {position}), '')"
