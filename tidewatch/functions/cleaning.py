"""Column expressions that turn raw click-stream text into typed values.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Text shapes accepted as timestamps (after the " UTC" suffix is
# removed) and as prices.  Anything else becomes NULL, so results do not depend
# on how lenient one engine's string casts happen to be.  A zone after the time is
# read and left out (event times are zone-less).
TIMESTAMP_TEXT = (r"^\s*(\d{4})[-/](\d{1,2})[-/](\d{1,2})"
                  r"([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?\s*$")
_DIGITS = r"\d+(_\d+)*"
NUMBER_TEXT = (rf"^\s*[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?\d+)?"
               r"|(?i:inf|infinity|nan))\s*$")
# Separator of the surrogate-key input.
KEY_SEPARATOR = "|"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnOrName) -> Column:
    """``NULLIF(TRIM(x), '')``: trims spaces only (a tab is kept)."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))


def normalize_event_type(c: ColumnOrName) -> Column:
    """Lower-cased, trimmed event type; blank becomes NULL."""
    return F.lower(blank_to_null(c))


def parse_event_ts(c: ColumnOrName) -> Column:
    """Zone-less event time from text such as ``2019-11-01 00:00:00 UTC``.

    Text ending in ``UTC`` has every `` UTC`` removed first; the rest must look
    like a date or a date-time (one-digit parts, slashes, outer blanks and a zone
    are accepted), else the result is NULL.
    """
    text = _col(c).cast("string")
    stripped = F.when(text.endswith("UTC"), F.replace(text, F.lit(" UTC"), F.lit(""))).otherwise(text)
    plain = F.regexp_replace(stripped, TIMESTAMP_TEXT, "$1-$2-$3$4")
    return F.when(stripped.rlike(TIMESTAMP_TEXT), plain.try_cast("timestamp_ntz"))


def safe_price_cast(c: ColumnOrName) -> Column:
    """Price text to double; text that is not a number (digits may be grouped by ``_``) becomes NULL."""
    text = _col(c).cast("string")
    return F.when(text.rlike(NUMBER_TEXT), F.replace(F.trim(text), F.lit("_"), F.lit("")).try_cast("double"))


def event_id_md5(*raw: ColumnOrName) -> Column:
    """Surrogate key: MD5 of the raw values joined by one pipe, NULLs skipped."""
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[_col(c).cast("string") for c in raw]))
