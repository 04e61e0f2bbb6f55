"""String cleaning the way Python's ``str.strip`` does it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes Unicode whitespace; Spark's trim removes spaces
# only.  \s covers ASCII whitespace, \p{Z} the Unicode separators, and the
# explicit list the remaining characters str.isspace() accepts.
_WS = r"[\s\p{Z}\u001c-\u001f\u0085]"
_EDGE_WS = rf"^{_WS}+|{_WS}+$"


def strip_all(c: Column) -> Column:
    """Trim all leading and trailing whitespace (null stays null)."""
    return F.regexp_replace(c, _EDGE_WS, "")


def upper_strip(c: Column) -> Column:
    """``s.upper().strip()``."""
    return strip_all(F.upper(c))
