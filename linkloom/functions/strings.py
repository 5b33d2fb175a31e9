"""String helpers as native column expressions (no Python in the row path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's ``str.strip()`` removes: the Unicode White_Space set
# plus the four information separators U+001C..U+001F.
PY_WHITESPACE_CLASS = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
)


def py_strip(c: Column) -> Column:
    """``str.strip()`` with Python's idea of whitespace (Spark ``trim`` only drops spaces)."""
    return F.regexp_replace(c, f"^{PY_WHITESPACE_CLASS}+|{PY_WHITESPACE_CLASS}+$", "")


def normalize_space(c: Column) -> Column:
    """XPath ``normalize-space``: runs of space/tab/CR/LF become one space, then trim.

    Empty result becomes NULL, as the link record stores no empty anchor text.
    """
    collapsed = F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " "))
    return F.when(collapsed == "", F.lit(None).cast("string")).otherwise(collapsed)


def starts_with_any(c: Column, prefixes) -> Column:
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | c.startswith(p)
    return cond


def py_bool_text(c: Column) -> Column:
    """Python's ``str(bool(x))``: NULL counts as False."""
    return F.when(F.coalesce(c, F.lit(False)), F.lit("True")).otherwise(F.lit("False"))
