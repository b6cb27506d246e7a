"""Date functions that take strftime patterns, checked and translated for Spark."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Strftime directive -> Spark datetime pattern.
DIRECTIVES = {
    "Y": "yyyy",
    "y": "yy",
    "m": "MM",
    "d": "dd",
    "H": "HH",
    "I": "hh",
    "M": "mm",
    "S": "ss",
    "f": "SSSSSS",
    "B": "MMMM",
    "b": "MMM",
    "A": "EEEE",
    "a": "EEE",
    "j": "DDD",
    "p": "a",
    "F": "yyyy-MM-dd",
    "T": "HH:mm:ss",
}

#: Template word -> strftime directive, longest words first.
TEMPLATE_WORDS = {
    "YYYY": "%Y",
    "MONTH": "%B",
    "HH24": "%H",
    "MON": "%b",
    "DAY": "%A",
    "DY": "%a",
    "MM": "%m",
    "DD": "%d",
    "HH": "%I",
    "MI": "%M",
    "SS": "%S",
    "YY": "%y",
}

#: Characters a template may contain between its words.
TEMPLATE_SEPARATORS = " -/:.,T_"

_TEMPLATE = re.compile(
    f"(?P<word>{'|'.join(TEMPLATE_WORDS)})|(?P<between>[{re.escape(TEMPLATE_SEPARATORS)}])",
    re.IGNORECASE,
)


def template_to_strftime(pattern: str) -> str | None:
    """Rewrite a template such as ``YYYY-MM-DD``, or return ``None`` if any part is unknown."""
    pieces, end = [], 0
    for match in _TEMPLATE.finditer(pattern):
        between = match["between"]
        if match.start() != end or between == "t":
            return None
        pieces.append(between or TEMPLATE_WORDS[match["word"].upper()])
        end = match.end()
    return "".join(pieces) if end == len(pattern) else None


def check_pattern(function: str, pattern: str) -> str:
    """Return ``pattern`` unless it is a template that strftime would not interpret."""
    if "%" in pattern or not any(c.isalpha() for c in pattern):
        return pattern
    rewrite = template_to_strftime(pattern)
    hint = f"; write {rewrite!r}" if rewrite else ""
    raise ValueError(
        f"{function} takes strftime patterns and {pattern!r} has no '%', "
        f"so nothing in it would be interpreted{hint}"
    )


def spark_pattern(pattern: str) -> str:
    """Translate a strftime pattern to Spark's datetime pattern letters."""

    def piece(match: re.Match) -> str:
        text, directive = match.groups()
        if text is not None:
            return "'" + text.replace("%%", "%").replace("'", "''") + "'"
        if directive not in DIRECTIVES:
            raise ValueError(f"directive %{directive} in {pattern!r} has no Spark equivalent")
        return DIRECTIVES[directive]

    return re.sub(r"((?:%%|[^%])+)|%(.?)", piece, pattern, flags=re.DOTALL)


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_char(value: str | Column, pattern: str) -> Column:
    """Format a date or timestamp."""
    return F.date_format(_col(value), spark_pattern(check_pattern("to_char", pattern)))


def date_format(value: str | Column, pattern: str) -> Column:
    return F.date_format(_col(value), spark_pattern(check_pattern("date_format", pattern)))


def to_date(value: str | Column, pattern: str) -> Column:
    """Parse a date; text that does not fit the pattern is an error."""
    return F.to_date(_col(value), spark_pattern(check_pattern("to_date", pattern)))


def to_timestamp(value: str | Column, pattern: str | None = None) -> Column:
    """Parse a timestamp without time zone."""
    if pattern is None:
        return _col(value).cast("timestamp_ntz")
    java = spark_pattern(check_pattern("to_timestamp", pattern))
    return F.to_timestamp_ntz(_col(value), F.lit(java))


def date_trunc(unit: str, value: str | Column) -> Column:
    """Truncate a timestamp, keeping it without time zone."""
    return F.date_trunc(unit, _col(value)).cast("timestamp_ntz")


def date_bin(width: str, value: str | Column) -> Column:
    """Return the start of the fixed-width bin a timestamp falls in, counted from 1970.

    NULL stays NULL: ``window`` would drop its row, so it is asked about a stand-in.
    """
    value = _col(value)
    known = F.coalesce(value, F.lit("1970-01-01").cast("timestamp_ntz"))
    return F.when(value.isNotNull(), F.window(known, width).getField("start"))
