"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(s) -> Column:
    """Python ``str.strip()``: removes all leading/trailing whitespace,
    TAB included (Spark ``trim`` removes spaces only, T12)."""
    return F.regexp_replace(_c(s), r"^\s+|\s+$", "")


def rstrip_tab(s) -> Column:
    """``rstrip('\\t')``."""
    return F.regexp_replace(_c(s), "\t+$", "")


def split_trim(s, sep: str = ",") -> Column:
    """Split on a separator and strip each piece; null input -> null."""
    return F.transform(F.split(_c(s), sep), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))


def slug(s) -> Column:
    """P6 column form: lower; space, '-', '/' -> '_'."""
    return F.translate(F.lower(_c(s)), " -/", "___")


def weather_file_name(bzn, start, end) -> Column:
    """``weather_{bzn}_{start}_to_{end}.json`` (zone lower-cased)."""
    return F.format_string("weather_%s_%s_to_%s.json", F.lower(_c(bzn)), _c(start), _c(end))
