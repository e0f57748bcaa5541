"""Deterministic hash surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewatch.reference_data import SURROGATE_NULL, SURROGATE_SEP


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 hex of the string forms joined by '-', a null part replaced by a placeholder.

    Because the key is a pure function of the natural key, a fact row can
    compute the key of its dimension row itself instead of joining for it.
    """
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(SURROGATE_NULL))
        for c in cols
    ]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))
