"""Text functions (P-11, P-14), all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The e-mail mask of the reference (Java regex and replacement).
# Everything after the first two characters up to the last '@' becomes 'xxx';
# the pattern also matches the empty string just before '@', so 'xxx' is
# written twice when at least one character is hidden.
EMAIL_MASK_PATTERN = r"(?<=..).*(?=@)"
EMAIL_MASK_REPLACEMENT = "xxx"


def mask_email(c: Column) -> Column:
    """P-11: ``alice@x.org`` -> ``alxxxxxx@x.org``; ``ab@x.org`` -> ``abxxx@x.org``;
    shorter local parts, text without ``@`` and null are left as they are."""
    return F.regexp_replace(c, EMAIL_MASK_PATTERN, EMAIL_MASK_REPLACEMENT)


def basename(path: Column) -> Column:
    """P-14: last ``/``-separated part of a path or URL (replaces the Python UDF)."""
    return F.element_at(F.split(path, "/"), -1)
