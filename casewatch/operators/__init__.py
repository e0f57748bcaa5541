"""Reusable DataFrame operators (DataFrame in, DataFrame out)."""

from casewatch.operators.dedup import anti_join_new, dedup_first, distinct_keys
from casewatch.operators.joins import bounded_broadcast
from casewatch.operators.watermark import (
    advance_watermark, has_newer, latest_watermark, watermark_from_raw,
)
from casewatch.operators.windows import period_change, running_total, with_change

__all__ = [
    "advance_watermark", "anti_join_new", "bounded_broadcast", "dedup_first", "distinct_keys",
    "has_newer", "latest_watermark", "period_change", "running_total", "watermark_from_raw", "with_change",
]
