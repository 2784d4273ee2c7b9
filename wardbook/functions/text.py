"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space characters. One-argument trim would only
# strip U+0020.
BLANKS = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def clean_text(text: Column) -> Column:
    """Strip blanks on both sides; blank text becomes NULL."""
    return F.nullif(F.btrim(text, F.lit(BLANKS)), F.lit(""))


def clean_upper(text: Column) -> Column:
    """clean_text in upper case."""
    return clean_text(F.upper(text))


def clean_with_default(text: Column, default: str) -> Column:
    """clean_text with NULL replaced by a default."""
    return F.coalesce(clean_text(text), F.lit(default))
