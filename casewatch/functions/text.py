"""String normalisation, masking and literal-map lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewatch.reference_data import DISEASE_TEXT_FIXES

# Characters with the Unicode White_Space property. A plain `trim` only strips
# spaces; the warehouse semantics being matched strip all of these.
UNICODE_WS = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The `\s` class of RE2 (no vertical tab), written out so Java regex agrees.
ASCII_WS_CLASS = "[\\t\\n\\f\\r ]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: Column | str) -> Column:
    """Strip leading and trailing Unicode whitespace (a character-set trim, no regex)."""
    return F.trim(_col(c), F.lit(UNICODE_WS))


def collapse_ws(c: Column | str) -> Column:
    """Replace each run of ASCII whitespace by one space."""
    return F.regexp_replace(_col(c), ASCII_WS_CLASS + "+", " ")


def norm_disease(c: Column | str) -> Column:
    """UPPER, trim, collapse whitespace, then the fixed spelling repairs."""
    out = collapse_ws(F.upper(trim_ws(c)))
    for bad, good in DISEASE_TEXT_FIXES:
        out = F.replace(out, F.lit(bad), F.lit(good))
    return out


def mask(c: Column | str) -> Column:
    """Lower-case hex MD5 of the text; null stays null."""
    return F.md5(_col(c).cast("string"))


def measure(c: Column | str) -> Column:
    """Text count -> double, missing -> 0. Bad text raises (ANSI cast)."""
    return F.coalesce(_col(c).cast("double"), F.lit(0.0))


def lookup(c: Column | str, table: Mapping[str, str]) -> Column:
    """Look a key up in a small fixed dict, null when absent.

    The dict becomes a literal map folded into the generated code, so the
    lookup is a projection: no join, no shuffle, no broadcast.
    """
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _col(c))
