"""Column-level building blocks: every function returns a pyspark Column."""

from casewatch.functions.calendar import (
    date_id, half_of, mmwr_period, quarter_of, season_of, sunday_week_of, week_label, week_stamp,
)
from casewatch.functions.keys import surrogate_key
from casewatch.functions.patterns import match_first, short_name
from casewatch.functions.text import (
    ASCII_WS_CLASS, UNICODE_WS, lookup, mask, measure, norm_disease, trim_ws,
)

__all__ = [
    "ASCII_WS_CLASS", "UNICODE_WS", "date_id", "half_of", "lookup", "mask", "match_first",
    "measure", "mmwr_period", "norm_disease", "quarter_of", "season_of", "short_name",
    "sunday_week_of", "surrogate_key", "trim_ws", "week_label", "week_stamp",
]
