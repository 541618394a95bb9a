"""Vote-string parsing with the lenient rules of non-ANSI casts.

``"<helpful>,<non-helpful>"``: each part is an integer, possibly padded with
spaces or followed by a fraction, which is truncated (``'5.7'`` is 5, ``'.5'`` is 0).
Anything else -- text, an empty part, a missing part -- is null.  Spark 4's
ANSI ``cast`` and ``getItem`` would raise on those rows instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Integer text: optional sign, digits, optional fraction, optional padding.
INT_TEXT = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"
# A fraction without digits before the point.
FRACTION_TEXT = r"^\s*[+-]?\.\d+\s*$"


def lenient_int(text: Column) -> Column:
    """Integer value of ``text``, or null when it is not integer text."""
    whole = F.regexp_extract(text, INT_TEXT, 1).try_cast("int")
    return F.when(F.regexp_like(text, F.lit(FRACTION_TEXT)), F.lit(0)).otherwise(whole)


def vote_part(helpful_str: Column | str, index: int) -> Column:
    """Part ``index`` (0-based) of a comma-separated vote string, as int."""
    return lenient_int(F.get(F.split(F.col(helpful_str) if isinstance(helpful_str, str) else helpful_str, ","), index))
