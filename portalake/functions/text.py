"""Text helpers shared by the parsers and the lookups."""

from __future__ import annotations

import unicodedata
from urllib.parse import quote, quote_plus

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what counts as white space at the ends of a vendor value (Unicode white space
# and the ASCII information separators). Trimming tries them in this order, usual ones first.
WHITE_SPACE = (" \u3000\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
               "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f")
_SPACE = f"[{WHITE_SPACE}]+"
#: Fixed value: no white space has a code point from here up.
_PAST_SPACE = "\u3001"


def strip(c: Column) -> Column:
    """Drop white space, Unicode included, at both ends. Most values begin and end with a plain
    character (printable ASCII, or past all white space), which is cheaper to see than to trim by
    the whole set."""
    # Texts compare by bytes, and so by their first character; a last byte in ASCII is a character.
    last = F.substring(c.cast("binary"), -1, 1)
    begins = ((c >= "!") & (c < "\x7f")) | (c >= _PAST_SPACE)
    ends = ((last >= F.lit(b"!")) & (last < F.lit(b"\x7f"))) | (F.substring(c, -1, 1) >= _PAST_SPACE)
    return F.when(begins & ends, c).otherwise(F.trim(c, F.lit(WHITE_SPACE)))


def words(c: Column) -> Column:
    """Split on runs of white space; no empty words."""
    return F.filter(F.split(c, _SPACE), lambda w: w != "")


@F.pandas_udf(T.StringType())
def nfc(values: pd.Series) -> pd.Series:
    """Compose Unicode to NFC. Spark has no built-in for this; callers apply it to distinct
    values only."""
    return values.map(lambda v: v if v is None else unicodedata.normalize("NFC", v))


def redact(c: Column, secret: str | None) -> Column:
    """Blank out a secret in its raw and URL-encoded spellings, longest first."""
    if not secret:
        return c
    for form in sorted({secret, quote_plus(secret), quote(secret)}, key=len, reverse=True):
        c = F.replace(c, F.lit(form), F.lit("[REDACTED]"))
    return c
